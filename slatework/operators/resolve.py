"""Identity resolution: name keys, unambiguous lookups and tiered joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.text import (
    initial_last_of,
    last_name_of,
    name_key,
    name_key_keep_suffix,
)
from slatework.operators.segments import dealt
from slatework.operators.shape import stack
from slatework.session import stage

# Rows of one task that makes name keys: a key costs far more than the bytes of a name tell.
NAME_TASK_ROWS = 20_000

EXACT, INITIAL, LAST, ANYWHERE = (
    "exact_full_name",
    "initial_last_team",
    "last_name_team",
    "exact_global",
)


def unambiguous(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Keys with exactly one distinct id.

    Smallest equals largest id says the same as a set of size one, without
    gathering the ids of a key.
    """
    return (
        df.filter(F.col(id_col).isNotNull())
        .groupBy(*keys)
        .agg(F.min(id_col).alias(id_col), F.max(id_col).alias("_max"))
        .filter(F.col(id_col) == F.col("_max"))
        .drop("_max")
    )


def key_rows(df: DataFrame, id_col: str, key: Column, tiers: list[str]) -> DataFrame:
    """(lookup_key, lookup_type, team, id) rows of one table with (name, team, id).

    ``key`` is the normalised name; the team-less tier carries a null team. It is made
    once per row: a filter on it would make it again, and a null key has no lookup key.
    """
    named = df.filter(F.col(id_col).isNotNull()).withColumn("_key", key)
    makers = {
        EXACT: (F.col("_key"), F.col("team")),
        ANYWHERE: (F.col("_key"), F.lit(None).cast("string")),
        INITIAL: (initial_last_of(F.col("_key")), F.col("team")),
        LAST: (last_name_of(F.col("_key")), F.col("team")),
    }
    rows = F.array(
        *[
            F.struct(
                makers[t][0].alias("lookup_key"), F.lit(t).alias("lookup_type"), makers[t][1].alias("team")
            )
            for t in tiers
        ]
    )
    return (
        named.select(F.inline(rows), F.col(id_col))
        .filter(F.col("lookup_key").isNotNull())
    )


def build_lookup(frames: list[DataFrame], id_col: str, name_col: str = "player_name") -> DataFrame:
    """Lookup table from history tables with (id, name, team): three key types."""
    base = stack(
        [
            f.select(
                F.col(id_col).cast("bigint").alias(id_col),
                F.trim(name_col).alias("name"),
                F.upper("team").alias("team"),
            )
            for f in frames
        ]
    ).distinct()
    base = dealt(base, sum(f.count() for f in frames), task_rows=NAME_TASK_ROWS)
    keyed = key_rows(base, id_col, name_key(F.col("name")), [EXACT, INITIAL, LAST])
    return unambiguous(keyed, ["lookup_key", "lookup_type", "team"], id_col).select(
        "lookup_key",
        "lookup_type",
        "team",
        id_col,
        F.lit("historical_statcast_name_lookup").alias("resolution_source"),
        F.lit(1).cast("bigint").alias("id_variant_count"),
    )


def master_lookup(lookup: DataFrame, histories: list[DataFrame], id_col: str = "pitcher_id") -> DataFrame:
    """Persisted lookup stacked with the keys of history tables, renormalised, distinct."""
    tiers = [EXACT, ANYWHERE, INITIAL, LAST]
    built = [
        key_rows(dealt(h.select(id_col, "name", "team"), h.count(), task_rows=NAME_TASK_ROWS), id_col, name_key_keep_suffix(F.col("name")), tiers)
        for h in histories
    ]
    persisted = lookup.select(
        name_key_keep_suffix(F.col("lookup_key")).alias("lookup_key"), "lookup_type", "team", id_col
    ).dropna(subset=["lookup_key", id_col])
    return stack([persisted, *built]).distinct()


def resolve_ids(
    df: DataFrame,
    lookup: DataFrame,
    name_col: str,
    id_col: str,
    method_col: str,
    tiers: list[tuple[str, str]],
    key: Column,
) -> DataFrame:
    """Fill missing ids tier by tier and record which tier did it.

    ``tiers`` lists (lookup type, method label). A null team matches a null
    team; the team-less type matches whatever the team. Ambiguous keys of the
    lookup are left out, so no row fans out.

    The distinct (name, team) pairs of the rows are written as one probe per
    tier and joined with the lookup once; the best tier of a pair is a minimum.
    The rows themselves are moved once, whatever the number of tiers. They are spread
    by their number and written with their key, so that it is made once for both uses.
    """
    kinds = [kind for kind, _ in tiers]

    def place(team: Column, anywhere) -> Column:
        """A team as text that is never null, so that joins stay plain equalities."""
        return F.when(anywhere, "").otherwise(F.coalesce(F.concat(F.lit("="), F.upper(team)), F.lit("-")))

    listed = lookup.filter(F.col("lookup_type").isin(kinds)).select(
        "lookup_key", "lookup_type", place(F.col("team"), F.col("lookup_type") == ANYWHERE).alias("_place"), id_col
    )
    unique = unambiguous(listed, ["lookup_key", "lookup_type", "_place"], id_col).withColumnRenamed(id_col, "_id")
    spread = dealt(df, df.count(), task_rows=NAME_TASK_ROWS)
    rows = stage(spread.withColumns({"_key": key, "_at": place(F.trim("team"), F.lit(False))}), "name-keys")
    pairs = rows.select("_key", "_at").filter(F.col("_key").isNotNull()).distinct()
    probes = [
        F.struct(
            F.lit(i).alias("_tier"),
            F.lit(kind).alias("lookup_type"),
            {INITIAL: initial_last_of, LAST: last_name_of}.get(kind, lambda k: k)(F.col("_key")).alias("lookup_key"),
            (F.lit("") if kind == ANYWHERE else F.col("_at")).alias("_place"),
        )
        for i, kind in enumerate(kinds)
    ]
    hits = pairs.select("_key", "_at", F.inline(F.array(*probes))).join(unique, ["lookup_key", "lookup_type", "_place"])
    best = hits.groupBy("_key", "_at").agg(F.min(F.struct("_tier", "_id")).alias("_best"))
    out = rows.join(best, ["_key", "_at"], "left")
    given = F.col(id_col).cast("bigint") if id_col in df.columns else F.lit(None).cast("bigint")
    labels = F.array(*[F.lit(label) for _, label in tiers])
    method = F.when(given.isNull() & F.col("_best").isNotNull(), F.get(labels, F.col("_best._tier")))
    return out.withColumns(
        {"_resolved": F.coalesce(given, F.col("_best._id")), method_col: F.coalesce(method, F.lit("unresolved"))}
    ).select(
        *[c for c in df.columns if c not in (id_col, method_col)],
        F.col("_resolved").alias(id_col),
        method_col,
    )


# Tiers of the general and of the starter resolution, in order.
GENERAL_TIERS = [
    (EXACT, "exact_full_name_team"),
    (INITIAL, "initial_last_team"),
    (LAST, "last_name_team"),
]
STARTER_TIERS = [
    (EXACT, "exact_team"),
    (ANYWHERE, "exact_global"),
    (INITIAL, "initial_last_team"),
    (LAST, "last_name_team"),
]
