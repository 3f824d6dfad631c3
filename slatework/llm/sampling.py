"""Folds and bounded training samples, decided by hashes of the document id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RANGE = 1 << 31


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.encode(id_column.cast("string"), "UTF-8")), F.lit(folds).cast("long"))


def rank_hash(id_column: Column, salt: str) -> Column:
    """A uniform number below 2**31 per id."""
    return F.pmod(F.xxhash64(id_column.cast("string"), F.lit(salt)), F.lit(_RANGE).cast("long"))


def thresholds(rows: DataFrame, group: str, per_group: int) -> dict:
    """Per group value the hash limit under which about ``per_group`` rows lie.

    One entry per value: for columns of labels, which have few.
    """
    counts = rows.groupBy(group).count().orderBy(F.desc("count"), group)
    return {r[0]: min(_RANGE, int(_RANGE * per_group / r[1]) + 1) for r in counts.collect()}


def below(group: Column, rank: Column, limits: dict) -> Column:
    """True for the rows that ``thresholds`` selects."""
    chosen = F.lit(False)
    for value, limit in limits.items():
        chosen = chosen | ((group == F.lit(value)) & (rank < F.lit(limit)))
    return chosen


def free_name(base: str, columns: list[str]) -> str:
    """``base``, or a longer name, that none of ``columns`` has in any spelling."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base
