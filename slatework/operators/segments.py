"""Splitting hot window partitions.

A window over one entity puts all its rows into one task. So the ordered rows of
every entity are cut into segments of about ``rows`` rows, and windows run per
(entity, segment); an entity below that size is one segment. What a window needs
from earlier segments is brought along: copies of the last few rows
(``rolling``), the last known value (``asof``) or a row count (``ordinal``).

There is one plan for every size. Entities are counted (combined before the
shuffle). Only rows of the large ones, reduced to key and order columns, are read
further: quantile sketches of the first order column bound the cuts, and where one
of its values alone is too large, sketches of the second column. Only sketched
buckets, a bounded number per entity, are planned by a window. A row finds its
bucket by a binary search in its entity's sketch and its segment by the bucket, so
the work per row does not grow with the number of segments. Sketches and planned
buckets belong to large entities alone and are broadcast. While no entity is large
the adaptive planner drops those joins and all that leads to them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEGMENT_ROWS = 1_000_000
# Rows of one task of a dealt table.
TASK_ROWS = 300_000
_QUANTILES = 200
_CODES = 1024  # above twice _QUANTILES
# Keys are counted together with others first: an entity is no larger than its bucket.
KEY_BUCKETS = 4096


def dealt(df: DataFrame, rows: int, *keys: str, task_rows: int | None = None) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by ``keys`` into tasks of about ``task_rows``, so that a task keeps its size."""
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / (task_rows or TASK_ROWS)))
    return df.repartition(tasks, *keys)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on all keys."""
    out = F.lit(True)
    for key in keys:
        out = out & left[key].eqNullSafe(right[key])
    return out


def attach(df: DataFrame, stats: DataFrame, by: list[str], bounded: bool = False) -> DataFrame:
    """Left join of one row per group onto the rows, null keys matching null keys.

    No broadcast hint unless ``stats`` is ``bounded``: the adaptive planner
    broadcasts it when it is small and splits hot groups of the row side when it
    is not.
    """
    renamed = stats.withColumnsRenamed({k: f"_key_{k}" for k in by})
    cond = F.lit(True)
    for key in by:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    right = F.broadcast(renamed) if bounded else renamed
    return df.join(right, cond, "left").drop(*[f"_key_{k}" for k in by])


def _scalar(df: DataFrame, name: str) -> tuple[Column, bool]:
    """A number that does not decrease along the column, and whether it keeps all values apart."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(F.col(name), "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint"), False
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int"), True
    return F.col(name), True


def key_bucket(*keys: str) -> Column:
    """One of ``KEY_BUCKETS`` numbers of an entity; so few are combined before a shuffle, entities of a large table are not."""
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))


def _only_large(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """The rows of groups with more than ``rows`` rows; entities are counted in large buckets only."""
    hashed = df.select(*by, key_bucket(*by).alias("_bucket"))
    buckets = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows)
    there = hashed.join(F.broadcast(buckets.select("_bucket")), "_bucket", "left_semi")
    counted = there.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > rows)
    large = counted.select(*[F.col(k).alias(f"_key_{k}") for k in by])
    cond = F.lit(True)
    for key in by:
        cond = cond & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    return df.join(F.broadcast(large), cond, "left_semi")


def _bounds(keyed: DataFrame, by: list[str], value: str, name: str, *more: Column) -> DataFrame:
    """Sketched quantiles of ``value`` per group, distinct and rising."""
    steps = [k / _QUANTILES for k in range(1, _QUANTILES)]
    return keyed.groupBy(*by).agg(F.array_distinct(F.percentile_approx(value, steps, 4 * _QUANTILES)).alias(name), *more)


def _bucket(bounds: Column, value: Column) -> Column:
    """Bucket of a value: even between two bounds, odd on a bound; 0 without bounds or value.

    A binary search: a few steps however many bounds there are.
    """
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(_QUANTILES.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(bounds, at + width - 1) < value, at + width).otherwise(at)

    below = F.aggregate(steps, F.lit(0), step)
    found = F.transform(F.array(below), lambda at: at * 2 + F.coalesce(F.get(bounds, at) == value, F.lit(False)).cast("int"))
    return F.when(bounds.isNotNull() & value.isNotNull(), F.get(found, 0)).otherwise(0)


def _sketches(df: DataFrame, by: list[str], order: list[str], rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Bounds of the first order column per large entity, and of the second per large bucket of one value."""
    first, exact = _scalar(df, order[0])
    narrow = df.select(*dict.fromkeys([*by, *order[:2]]))
    named = _only_large(narrow, by, rows).withColumn("_v0", first)
    bounds = _bounds(named.select(*by, "_v0"), by, "_v0", "_b0")
    if len(order) < 2 or not exact:
        return bounds, None
    out = attach(named, bounds, by, bounded=True).withColumn("_q0", _bucket(F.col("_b0"), F.col("_v0")))
    # A bucket on a bound holds one value, or the nulls; there the second column decides.
    single = out.withColumn("_v1", _scalar(df, order[1])[0]).filter(_single())
    pair = [*by, "_q0"]
    finer = _bounds(single, pair, "_v1", "_b1", F.count(F.lit(1)).alias("_rows"))
    return bounds, finer.filter(F.col("_rows") > rows).drop("_rows")


def _single() -> Column:
    return (F.col("_q0") % 2 == 1) | F.col("_v0").isNull()


def _with_code(df: DataFrame, sketches: tuple[DataFrame, DataFrame | None], by: list[str], order: list[str]) -> DataFrame:
    """Rows plus ``_code``, which does not decrease along ``order``; 0 for small entities."""
    bounds, finer = sketches
    out = attach(df, bounds, by, bounded=True).withColumn("_v0", _scalar(df, order[0])[0])
    out = out.withColumn("_q0", _bucket(F.col("_b0"), F.col("_v0")))
    low = F.lit(0)
    if finer is not None:
        out = attach(out, finer, [*by, "_q0"], bounded=True).withColumn("_v1", _scalar(df, order[1])[0])
        out = out.withColumn("_q1", _bucket(F.col("_b1"), F.col("_v1")))
        # Nulls come before all values of the lowest bucket.
        low = F.when(_single(), F.col("_q1")).when(F.col("_q0") == 0, F.lit(_CODES - 1)).otherwise(low)
    code = F.when(F.col("_b0").isNotNull(), F.col("_q0") * _CODES + low).otherwise(0)
    return out.withColumn("_code", code).drop("_v0", "_v1", "_b0", "_b1", "_q0", "_q1")


def _coded(df: DataFrame, by: list[str], order: list[str], rows: int) -> DataFrame:
    """Key and order columns of the large entities plus ``_code``."""
    narrow = _only_large(df.select(*dict.fromkeys([*by, *order[:2]])), by, rows)
    return _with_code(narrow, _sketches(df, by, order, rows), by, order)


def _plan(coded: DataFrame, by: list[str], rows: int, halo: int) -> DataFrame:
    """Per large entity and code: its segment, the next one if that needs its rows, and the rows before the segment."""
    counts = coded.groupBy(*by, "_code").agg(F.count(F.lit(1)).alias("_n"))
    entity = Window.partitionBy(*by)
    before = entity.orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    cut = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    cut = cut.withColumn("_seg", F.floor(F.col("_before") / rows))
    # Segments shorter than the halo join the one before, so only the next one needs rows of the current.
    size = F.sum("_n").over(Window.partitionBy(*by, "_seg"))
    start = F.when((size >= halo) | (F.col("_seg") == 0), F.col("_seg"))
    upto = entity.orderBy("_code").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_start", start).withColumn("_seg", F.last("_start", ignorenulls=True).over(upto))
    cut = cut.withColumn("_seg", F.dense_rank().over(entity.orderBy("_seg")) - 1)
    segment = Window.partitionBy(*by, "_seg")
    after = segment.orderBy(F.desc("_code")).rowsBetween(Window.unboundedPreceding, -1)
    tail = F.coalesce(F.sum("_n").over(after), F.lit(0)) < halo
    cut = cut.withColumns({"_tail": tail, "_last": F.max("_seg").over(entity), "_offset": F.min("_before").over(segment)})
    following = F.when(F.col("_tail") & (F.col("_seg") < F.col("_last")), F.col("_seg") + 1)
    return cut.select(*by, "_code", "_seg", following.alias("_next"), "_offset")


def with_segments(df: DataFrame, by: list[str], order: list[str], rows: int = SEGMENT_ROWS, halo: int = 1) -> DataFrame:
    """Rows plus ``_seg``, ``_next`` and ``_offset``; small entities are segment 0.

    ``_next`` is the following segment for rows among the last ``halo`` (or a few
    more) of a segment, else null. ``_offset`` counts the rows before a segment.
    Rows that agree in the first two order columns stay together.
    """
    sketches = _sketches(df, by, order, rows)
    plan = _plan(_coded(df, by, order, rows), by, rows, halo)
    joined = attach(_with_code(df, sketches, by, order), plan, [*by, "_code"], bounded=True).drop("_code")
    return joined.withColumns(
        {"_seg": F.coalesce("_seg", F.lit(0)), "_offset": F.coalesce("_offset", F.lit(0)).cast("bigint")}
    )
