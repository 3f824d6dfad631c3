"""Data-quality reports: each one aggregate over the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import num_of
from slatework.sources.contracts import Contract, contract


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls); a column that is missing counts every row as null."""
    have = set(df.columns)
    counts = [
        (F.count_if(F.col(c).isNull()) if c in have else F.count(F.lit(1))).alias(c) for c in columns
    ]
    return unpivot(df.agg(*counts), columns, "column", "nulls")


def unpivot(df: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def duplicate_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows beyond the first of their key, null keys counting as equal.

    Counted per key first, so a hot key is combined before the shuffle.
    """
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, key: list[str], label: str) -> None:
    """Stop if a key repeats: the guard of one-to-one and many-to-one joins."""
    repeated = df.groupBy(*key).count().filter("count > 1").limit(1).first()
    if repeated is not None:
        raise ValueError(f"{label}: repeated key {dict(zip(key, repeated))}")


def report(df: DataFrame, spec: Contract | str, all_columns: bool = False) -> DataFrame:
    """One-row validation report of a table against its contract."""
    spec = contract(spec) if isinstance(spec, str) else spec
    have = set(df.columns)
    missing = sorted(set(spec.required) - have)
    undeclared = sorted(set(spec.columns) - have) if all_columns else []
    present = [c for c in spec.key if c in have]
    if len(present) == len(spec.key):
        per_key = df.groupBy(*spec.key).agg(F.count(F.lit(1)).alias("_n"))
        rows, extra = F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
        weight = F.col("_n")
    else:
        per_key = df.select(*present, F.lit(1).cast("bigint").alias("_n"))
        rows = extra = F.count(F.lit(1))
        weight = F.col("_n")
    nulls = [
        (
            F.coalesce(F.sum(F.when(F.col(c).isNull(), weight)), F.lit(0)) if c in have else rows
        ).alias(f"null_{c}")
        for c in spec.key
    ]
    counted = per_key.agg(rows.alias("row_count"), extra.alias("duplicate_rows"), *nulls)
    valid = F.lit(not missing and not undeclared) & (F.col("duplicate_rows") == 0)
    for c in spec.key:
        valid = valid & (F.col(f"null_{c}") == 0)
    return counted.select(
        F.lit(spec.name).alias("table_name"),
        F.lit(",".join(missing)).alias("missing_required"),
        F.lit(",".join(undeclared)).alias("missing_declared"),
        *counted.columns,
        valid.alias("valid"),
    )


def validate(df: DataFrame, spec: Contract | str, all_columns: bool = False) -> None:
    """Raise if the report is not valid."""
    row = report(df, spec, all_columns).first()
    if not row["valid"]:
        raise ValueError(f"validation failed: {row.asDict()}")


def profile_state(df: DataFrame, key: list[str], date: str | None, nulls: list[str]) -> DataFrame:
    """What a profile needs of a part of a table: one row per key with its rows, dates and nulls.

    States merge: write the state of each part once, and the profile of any set
    of parts is that of their states, without reading the parts again.
    """
    inner = [F.count(F.lit(1)).alias("_n")]
    inner += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in nulls]
    if date:
        inner += [F.min(date).alias("_min"), F.max(date).alias("_max")]
    return df.groupBy(*key).agg(*inner)


def merged_state(states: list[DataFrame], key: list[str]) -> DataFrame:
    """One state of several parts; a key that occurs in several is one row."""
    if len(states) == 1:
        return states[0]
    every = reduce(lambda a, b: a.unionByName(b), states)
    how = {"_min": F.min, "_max": F.max}
    return every.groupBy(*key).agg(*[how.get(c, F.sum)(c).alias(c) for c in every.columns if c not in key])


def profile_of(states: list[DataFrame], key: list[str]) -> DataFrame:
    """(measure, value as text) of the parts behind ``states``; see ``profile``."""
    state = merged_state(states, key)
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    outer = [
        F.coalesce(F.sum("_n"), F.lit(0)).cast("string").alias("rows"),
        F.count_if(known).cast("string").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("string").alias("duplicates"),
    ]
    if "_min" in state.columns:
        outer += [
            F.min("_min").cast("date").cast("string").alias("min_date"),
            F.max("_max").cast("date").cast("string").alias("max_date"),
        ]
    outer += [F.sum(c).cast("string").alias(c) for c in state.columns if c.startswith("nulls_") and c not in key]
    totals = state.agg(*outer)
    return unpivot(totals, totals.columns, "measure", "value")


def profile(df: DataFrame, key: list[str], date: str | None, nulls: list[str]) -> DataFrame:
    """(measure, value as text): rows, distinct keys, date range, nulls, duplicates.

    Grouped by key first: row and null counts are sums over the groups.
    """
    return profile_of([profile_state(df, key, date, nulls)], key)


def share(condition: Column) -> Column:
    """Percentage of rows where the condition holds, unknown counting as false."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0)) * 100


def null_percent(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, null_pct) after numeric coercion."""
    terms = [(F.avg(num_of(df, c).isNull().cast("double")) * 100).alias(c) for c in columns]
    return unpivot(df.agg(*terms), columns, "column", "null_pct")


def filled_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean over the columns of their share of non-null values."""
    terms = [F.avg(F.col(c).isNotNull().cast("double")) for c in columns]
    return df.agg((sum(terms[1:], terms[0]) / len(terms)).alias("non_null_rate"))
