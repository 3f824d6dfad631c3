"""Column selection, renaming, conformance and reshaping."""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.functions.coerce import blank_to_null, null_of, num_of


def pick(columns: Iterable[str], candidates: list[str], required: bool = False) -> str | None:
    """First candidate that exists."""
    have = set(columns)
    for name in candidates:
        if name in have:
            return name
    if required:
        raise KeyError(f"none of the columns {candidates} exists")
    return None


def pick_column(df: DataFrame, candidates: list[str], default=None, dtype: str = "string") -> Column:
    """First candidate column that exists, else a constant."""
    name = pick(df.columns, candidates)
    return F.col(name) if name else F.lit(default).cast(dtype)


def first_numeric(df: DataFrame, candidates: list[str], default: float | None = None) -> Column:
    """First non-null numeric value across the candidate columns."""
    values = [num_of(df, c) for c in candidates if c in df.columns]
    if default is not None:
        values.append(F.lit(float(default)))
    return F.coalesce(*values) if values else null_of("double")


def with_numeric(df: DataFrame, names: list[str], default: float | None = None) -> DataFrame:
    """Make sure the columns exist and are double, nulls filled with ``default``."""
    return df.withColumns({n: first_numeric(df, [n], default) for n in names})


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    kept = set(keep)
    return df.select([F.col(c) if c in kept else F.col(c).alias(prefix + c) for c in df.columns])


def front(df: DataFrame, names: list[str]) -> DataFrame:
    """Named columns first (those that exist), the rest after."""
    head = [c for c in names if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def rename_missing(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename a column to its canonical name where that name is not taken."""
    have = set(df.columns)
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in have and b not in have})


def replace_columns(df: DataFrame, stale: list[str], promoted: dict[str, str]) -> DataFrame:
    """Drop stale columns, then give the promoted ones their canonical names."""
    return df.drop(*[c for c in stale if c in df.columns]).withColumnsRenamed(
        {a: b for a, b in promoted.items() if a in df.columns}
    )


def snake_name(name: str) -> str:
    words = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    return re.sub(r"[^A-Za-z0-9]+", "_", words).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])


def _text_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def strip_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in _text_fields(df)})


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Text of only white space becomes null, other text stays as it is."""
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in _text_fields(df)})


def clean(df: DataFrame, names: bool = True, text: bool = True, blanks: bool = True) -> DataFrame:
    """Standard clean-up: snake-case names, trimmed text, blanks as null."""
    out = snake_columns(df) if names else df
    if text and blanks:
        return out.withColumns({c: blank_to_null(F.col(c)) for c in _text_fields(out)})
    out = strip_text(out) if text else out
    return blanks_to_null(out) if blanks else out


def derive_if_empty(df: DataFrame, rules: list[tuple[str, list[tuple[list[str], Column]]]]) -> DataFrame:
    """Derive a column only where it is null in every row.

    ``rules`` lists (column, [(columns that must hold values, expression), ...]);
    the first usable expression is taken. One aggregate over the columns involved
    decides for all rules, before any of them is applied.
    """
    involved = {c for name, options in rules for c in [name] + [n for needs, _ in options for n in needs]}
    present = [c for c in sorted(involved) if c in df.columns]
    row = df.agg(*[F.max(F.col(c).isNotNull().cast("int")).alias(c) for c in present]).first()
    filled = {c for c in present if row[c]}
    out = df
    for name, options in rules:
        if name in filled:
            continue
        for needs, expression in options:
            if all(n in filled for n in needs):
                out = out.withColumn(name, expression)
                filled.add(name)
                break
    return out


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union by name, columns missing on one side null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_numbered(frames: list[DataFrame], name: str) -> DataFrame:
    """Distinct union of extracted tables, each row carrying its table's number."""
    return stack([f.withColumn(name, F.lit(i).cast("bigint")) for i, f in enumerate(frames)]).distinct()


def rows_of(df: DataFrame, keep: list[str], *rows: dict[str, Column]) -> DataFrame:
    """One input row to several output rows, in a single pass over the input."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return df.select(*keep, F.inline(F.array(*structs)))


def team_rows(games: DataFrame, keep: list[str], home: Column, away: Column) -> DataFrame:
    """Game with home and away team to one row per team."""
    return rows_of(
        games,
        keep,
        {"team": away, "opponent": home, "is_home": F.lit(False)},
        {"team": home, "opponent": away, "is_home": F.lit(True)},
    )


def game_columns(team_rows_df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Two team rows to one game row with home_ and away_ columns."""
    return team_rows_df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("is_home") == flag, F.col(v))).alias(f"{side}_{v}")
            for side, flag in (("home", True), ("away", False))
            for v in values
        ]
    )


def month_chunks(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Date range to calendar months, clipped to the range."""
    months = F.sequence(F.trunc(start, "month"), end, F.expr("interval 1 month"))
    return df.select("*", F.explode(months).alias("_m")).select(
        *df.columns,
        F.greatest(F.col("_m").cast("date"), start).alias("chunk_start"),
        F.least(F.last_day(F.col("_m").cast("date")), end).alias("chunk_end"),
    )


def non_null_terms(columns: Iterable[str]) -> list[Column]:
    return [F.avg(F.col(c).isNotNull().cast("double")).alias(c) for c in columns]
