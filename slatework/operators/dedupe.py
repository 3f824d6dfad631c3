"""One row per key, ordinals, top rows and repeatable samples.

``row_number() = 1`` and ``row_number() <= n`` are limited per task before the
shuffle by Spark's window group limit, so a hot key sends n rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatework.operators.segments import SEGMENT_ROWS, with_segments


def _numbered(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    spec = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter(F.col("_rn") <= n)


def last_per_key(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Last row per key in ascending order (nulls sort last, as newest)."""
    return _numbered(df, by, [F.desc_nulls_first(c) for c in order], 1).drop("_rn")


def first_per_key(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """First row per key in ascending order, nulls last."""
    return _numbered(df, by, [F.asc_nulls_last(c) for c in order], 1).drop("_rn")


def top_rows(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    """The first ``n`` rows per group with their rank as bigint."""
    return _numbered(df, by, order, n).withColumn(rank, F.col("_rn").cast("bigint")).drop("_rn")


def ordinal(
    df: DataFrame,
    by: list[str],
    order: list[str],
    name: str,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """1-based position within the group; ``order`` must be total."""
    cut = with_segments(df, by, order, segment_rows)
    spec = Window.partitionBy(*by, "_seg").orderBy(*[F.asc_nulls_first(c) for c in order])
    position = F.row_number().over(spec) + F.col("_offset")
    return cut.withColumn(name, position.cast("bigint")).drop("_seg", "_next", "_offset")


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows (all, if there are fewer) with the smallest seeded hash of their key.

    The same rows on every run. Hashes are counted by their top 16 bits to find
    the range the n-th smallest falls into; whole ranges below it are kept by a
    filter and only that one range is sorted.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key)).withColumn(
        "_range", F.shiftright("_hash", 48)
    )
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        counts.withColumn("_upto", F.sum("_n").over(upto))
        .filter(F.col("_upto") > n)
        .orderBy("_range")
        .select("_range", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_rest"))
        .first()
    )
    if edge is None:
        return df
    below = hashed.filter(F.col("_range") < edge["_range"])
    last = hashed.filter(F.col("_range") == edge["_range"]).orderBy("_hash", *key).limit(edge["_rest"])
    return below.unionByName(last).drop("_hash", "_range")
