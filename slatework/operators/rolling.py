"""Leakage-safe rolling windows over the previous rows of an entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatework.functions.coerce import ratio
from slatework.operators.segments import SEGMENT_ROWS, dealt, with_segments

# Window lengths in games.
WINDOWS = (3, 7, 15, 30)


def frame(spec, window: int, lag: int = 1):
    """The ``window`` rows that end ``lag`` rows before the current one."""
    return spec.rowsBetween(-(window + lag - 1), -lag)


def over_previous(
    df: DataFrame,
    by: str,
    order: list[str],
    build,
    windows=WINDOWS,
    lag: int = 1,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add the columns ``build(frame_of)`` where ``frame_of(w)`` is a window frame.

    All columns share one partitioning and ordering, so the plan has one
    shuffle and one sort. Entities of more than ``segment_rows`` rows are cut
    along the order; each segment gets copies of the rows before it. The rows are
    counted first and dealt into tasks of a fixed size.
    """
    halo = max(windows) + lag - 1
    cut = with_segments(df, [by], order, max(segment_rows, halo), halo)
    # A copy of each tail row also takes part in the following segment.
    parts = F.when(F.col("_next").isNotNull(), F.array("_seg", "_next")).otherwise(F.array("_seg"))
    copied = cut.select("*", F.posexplode(parts).alias("_copy", "_part"))
    spec = Window.partitionBy(by, "_part").orderBy(*order)
    copied = dealt(copied, df.count(), by, "_part")
    rolled = copied.withColumns(build(lambda w: frame(spec, w, lag)))
    return rolled.filter(F.col("_copy") == 0).drop("_seg", "_next", "_offset", "_copy", "_part")


def rolling(
    df: DataFrame,
    by: str,
    order: list[str],
    sums: list[str] = (),
    means: list[str] = (),
    windows=WINDOWS,
    lag: int = 1,
    name: str = "{col}_roll{w}",
    null_entity: bool = True,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Rolling sums and means named by ``name``.

    Nulls inside a window are skipped but occupy a row. ``null_entity`` False
    leaves rows without an entity null instead of rolling them as one group.
    """

    def build(frame_of):
        def keep(value: Column) -> Column:
            return value if null_entity else F.when(F.col(by).isNotNull(), value)

        out = {}
        for w in windows:
            for c in sums:
                out[name.format(col=c, w=w)] = keep(F.sum(c).over(frame_of(w)))
            for c in means:
                out[name.format(col=c, w=w)] = keep(F.avg(c).over(frame_of(w)))
        return out

    return over_previous(df, by, order, build, windows=windows, lag=lag, segment_rows=segment_rows)


def rolling_ratios(
    df: DataFrame, ratios: dict[str, tuple[str, str]], windows=WINDOWS, name: str = "{col}_roll{w}"
) -> DataFrame:
    """Quotients of rolled columns: ``{new: (numerator, denominator)}``."""
    return df.withColumns(
        {
            name.format(col=new, w=w): ratio(
                F.col(name.format(col=num, w=w)), F.col(name.format(col=den, w=w))
            )
            for w in windows
            for new, (num, den) in ratios.items()
        }
    )
