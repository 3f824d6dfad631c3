"""Joins to the latest earlier row of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.operators.dedupe import last_per_key
from slatework.operators.segments import SEGMENT_ROWS, attach, dealt, key_bucket, with_segments


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    on: str,
    values: list[str],
    right_by: str | None = None,
    right_on: str | None = None,
    tie: list[str] = (),
    strict: bool = True,
    rename: dict[str, str] | None = None,
    segment_rows: int = SEGMENT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Each left row with ``values`` of the last right row before it.

    ``strict`` excludes right rows of the same date. Left rows without an
    entity or a date are dropped; entities the right side does not know keep
    null values. Of several right rows on one date the last by ``tie`` counts.

    The rows of both sides are stacked, dealt by entity into tasks of a fixed size,
    and one window carries the last right row forward: one shuffle, no range join.
    Rows are counted per entity first. If one holds more than ``segment_rows`` of
    them, the window sees the distinct (entity, date) pairs instead, two narrow rows
    per date at most; they carry the date found, and the values are fetched by an
    equi-join on (entity, date found). ``counted`` has the left side's entities and
    dates where those are cheaper to read; its row numbers stand for the left side's.
    """
    right_by, right_on, rename = right_by or by, right_on or on, rename or {}
    out = [rename.get(v, v) for v in values]
    kept = [c for c in left.columns if c not in out]
    rows = left.filter(F.col(by).isNotNull() & F.col(on).isNotNull()).select(*kept)
    right_rows = _known(right, left, by, on, values, right_by, right_on, tie)
    return _with_found(rows, right_rows, by, on, strict, segment_rows, counted).select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"_value{i}").alias(o) for i, o in enumerate(out)]
    )


def _known(right, left, by, on, values, right_by, right_on, tie) -> DataFrame:
    """(_key, _on, _tie0, ..., _value0, ...), key and date in the types of the left side."""
    # The date as the right side has it decides where the cast makes several of them equal.
    exact = [F.col(right_on).alias("_exact")] if right.schema[right_on].dataType != left.schema[on].dataType else []
    known = right.select(
        F.col(right_by).cast(left.schema[by].dataType).alias("_key"),
        F.col(right_on).cast(left.schema[on].dataType).alias("_on"),
        *exact,
        *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(tie)],
        *[F.col(v).alias(f"_value{i}") for i, v in enumerate(values)],
    )
    return known.filter(F.col("_key").isNotNull() & F.col("_on").isNotNull())


def _with_found(
    rows: DataFrame, known: DataFrame, by: str, on: str, strict: bool, segment_rows: int, counted: DataFrame | None = None
) -> DataFrame:
    """All ``rows`` with the values of the right row found; without an entity or a date they get nulls."""
    asking = rows if counted is None else counted
    both = asking.select(F.col(by).alias("_id"), F.col(on).isNotNull().alias("_dated")).unionByName(
        known.select(F.col("_key").alias("_id"), F.lit(True).alias("_dated"))
    )
    asked = F.col("_id").isNotNull() & F.col("_dated")

    def sizes(group: Column) -> tuple[int, int]:
        counts = both.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(asked).alias("_m"))
        return counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.max("_m"), F.lit(0))).first()

    total, most = sizes(key_bucket("_id").alias("_bucket"))
    if most > segment_rows:
        total, most = sizes(F.col("_id"))
    if most > segment_rows:
        return _by_pairs(rows, known, by, on, strict, segment_rows)
    return _by_rows(rows, known, by, on, strict, total)


def _by_rows(rows: DataFrame, known: DataFrame, by: str, on: str, strict: bool, total: int) -> DataFrame:
    """Both sides in one window per entity, the right row as a struct."""
    values = [c for c in known.columns if c.startswith("_value")]
    order = [c for c in known.columns if c == "_exact" or c.startswith("_tie")]
    # Rows that ask for nothing stay in groups of their own tasks.
    idle = F.when(F.col(by).isNull() | F.col(on).isNull(), F.spark_partition_id()).otherwise(-1)
    asking = rows.withColumns({"_idle": idle, "_asks": F.lit(True)})
    facts = known.select(
        F.col("_key").alias(by), F.col("_on").alias(on), F.lit(-1).alias("_idle"), F.lit(False).alias("_asks"),
        *order, F.struct(*[F.col(v) for v in values]).alias("_fact"),
    )
    both = dealt(asking.unionByName(facts, allowMissingColumns=True), total, by, "_idle")
    # Strict: at one date the question comes first, so it does not see the date's right rows.
    first = F.col("_asks") if not strict else ~F.col("_asks")
    spec = Window.partitionBy(by, "_idle").orderBy(on, first, *[F.asc_nulls_last(c) for c in order])
    last = F.last("_fact", ignorenulls=True).over(spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_found", last).filter("_asks")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], *[F.col("_found")[v].alias(v) for v in values])


def _by_pairs(rows: DataFrame, known: DataFrame, by: str, on: str, strict: bool, segment_rows: int) -> DataFrame:
    """Distinct (entity, date) pairs find the date of their right row, whose values are joined."""
    order = [c for c in known.columns if c == "_exact" or c.startswith("_tie")]
    reduced, dates = last_per_key(known, ["_key", "_on"], order or ["_on"]).drop(*order), known.select("_key", "_on").distinct()
    kind = rows.schema[on].dataType
    dated = rows.filter(F.col(by).isNotNull() & F.col(on).isNotNull())
    asked = dated.select(F.col(by).alias("_id"), F.col(on).alias("_at")).distinct()
    facts = dates.select(F.col("_key").alias("_id"), F.col("_on").alias("_at"), F.col("_on").alias("_right"))
    # Strict: at one date the question comes first, so it does not see the date's right row.
    side = F.col("_right").isNotNull().cast("int")
    both = asked.withColumn("_right", F.lit(None).cast(kind)).unionByName(facts).withColumn("_side", side if strict else 1 - side)
    if isinstance(kind, T.DateType):
        # Two rows per calendar day at most: an entity fits one task.
        order = Window.partitionBy("_id").orderBy("_at", "_side")
        carried = both.withColumn("_found", F.last("_right", ignorenulls=True).over(order))
    else:
        carried = _carried(both, segment_rows)
    found = carried.filter("_right is null").select("_id", "_at", "_found")
    placed = rows.join(found, (F.col(by) == F.col("_id")) & (F.col(on) == F.col("_at")), "left")
    return placed.join(reduced, (F.col("_id") == F.col("_key")) & (F.col("_found") == F.col("_on")), "left").drop(
        "_id", "_at", "_found", "_key", "_on"
    )


def _carried(both: DataFrame, segment_rows: int) -> DataFrame:
    """Rows plus ``_found``, the last right row so far; long entities are cut into segments."""
    cut = with_segments(both, ["_id"], ["_at", "_side"], segment_rows)
    inside = Window.partitionBy("_id", "_seg").orderBy("_at", "_side")
    last_of = (
        cut.filter("_right is not null")
        .groupBy("_id", "_seg")
        .agg(F.max_by("_right", F.col("_at")).alias("_end"))
    )
    # A segment without right rows still has to pass on what came before it.
    ends = attach(cut.select("_id", "_seg").distinct(), last_of, ["_id", "_seg"])
    earlier = Window.partitionBy("_id").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("_id", "_seg", F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    local = cut.withColumn("_local", F.last("_right", ignorenulls=True).over(inside))
    return attach(local, carry, ["_id", "_seg"]).withColumn(
        "_found", F.coalesce("_local", "_carry")
    )


def latest_rows(
    df: DataFrame,
    by: str,
    on: str,
    tie: list[str] = (),
    cutoff: Column | None = None,
    strict: bool = False,
) -> DataFrame:
    """Latest row per entity, optionally up to (``strict``: before) a cut-off date."""
    dated = df.filter(F.col(on).isNotNull())
    if cutoff is not None:
        dated = dated.filter(F.col(on) < cutoff if strict else F.col(on) <= cutoff)
    return last_per_key(dated, [by], [on, *tie])


def latest_by_row(
    left: DataFrame,
    right: DataFrame,
    left_by: str,
    by: str,
    on: str,
    values: list[str],
    tie: list[str] = (),
    strict: bool = False,
    prefix: str = "",
    counted: DataFrame | None = None,
) -> DataFrame:
    """All left rows with the latest right row up to (``strict``: before) their own date.

    Rows without an entity or a date, and entities that the right side does not
    know, get nulls. ``counted`` as for ``asof_join``.
    """
    right_rows = _known(right, left, left_by, on, values, by, on, tie)
    return _with_found(left, right_rows, left_by, on, strict, SEGMENT_ROWS, counted).withColumnsRenamed(
        {f"_value{i}": prefix + v for i, v in enumerate(values)}
    )


def latest_join(
    left: DataFrame,
    right: DataFrame,
    left_by: str,
    by: str,
    on: str,
    values: list[str],
    tie: list[str] = (),
    cutoff: Column | None = None,
    strict: bool = False,
    prefix: str = "",
) -> DataFrame:
    """Left join of the latest right row per entity, one cut-off for all rows."""
    latest = latest_rows(right, by, on, tie, cutoff, strict).select(
        F.col(by).alias("_latest_id"), *[F.col(v).alias(prefix + v) for v in values]
    )
    return left.join(latest, F.col(left_by) == F.col("_latest_id"), "left").drop("_latest_id")


def latest_with_fallback(
    ids: DataFrame,
    by: str,
    first: DataFrame,
    second: DataFrame,
    on: str,
    values: list[str],
    tie: list[str],
    cutoff: Column,
    labels: tuple[str, str] = ("rolling", "mart_fallback"),
    required: bool = False,
) -> DataFrame:
    """Latest earlier row of the first source, else of the second, with its label.

    Ids neither source knows keep nulls and a null ``_source``; with
    ``required`` the first of them stops the job.
    """

    def newest(df: DataFrame, alias: str) -> DataFrame:
        rows = latest_rows(df, by, on, tie, cutoff, strict=True)
        return rows.select(F.col(by).alias(f"_{alias}_id"), F.struct(*values).alias(f"_{alias}"))

    joined = ids.join(newest(first, "a"), F.col(by) == F.col("_a_id"), "left").join(
        newest(second, "b"), F.col(by) == F.col("_b_id"), "left"
    )
    chosen = F.coalesce(F.col("_a"), F.col("_b"))
    source = F.when(F.col("_a").isNotNull(), labels[0]).when(F.col("_b").isNotNull(), labels[1])
    if required:
        unknown = F.concat(F.lit(f"no earlier row for {by} "), F.coalesce(F.col(by).cast("string"), F.lit("null")))
        source = F.coalesce(source, F.raise_error(unknown).cast("string"))
    return joined.select(
        *ids.columns, *[chosen.getField(v).alias(v) for v in values], source.alias("_source")
    )
