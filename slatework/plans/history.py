"""Historical tables: pitches to plate appearances, enrichment, season bridge."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slatework.functions.coerce import date_of, date_text, int_of, null_of, text_of
from slatework.operators.dedupe import last_per_key
from slatework.operators.shape import pick, replace_columns, stack
from slatework.sources.records import plate_appearances
from slatework.sources.snapshots import Manifest, folder_fingerprints

# Contact columns and the names they are promoted to.
PROMOTED_CONTACT = {
    "launch_speed_sc": "launch_speed",
    "launch_angle_sc": "launch_angle",
    "hit_distance_sc_sc": "hit_distance_sc",
    "bb_type_sc": "bb_type",
    "hc_x_sc": "hc_x",
    "hc_y_sc": "hc_y",
}
# Columns a fresh enrichment replaces: both names, and what has no other name.
STALE_CONTACT = [
    *PROMOTED_CONTACT, *PROMOTED_CONTACT.values(), "sc_events", "sc_description", "barrels_sc",
    "hard_hit_sc", "bbe_sc", "barrel_rate_sc", "hard_hit_rate_sc",
]


def last_pitches(pitches: DataFrame, order: list[str]) -> DataFrame:
    """Pitch events to one row per at-bat: its last pitch holds the result."""
    for c in ("game_pk", "at_bat_number"):
        pick(pitches.columns, [c], required=True)
    rows = last_per_key(pitches, ["game_pk", "at_bat_number"], order)

    def get(name: str, read, dtype: str):
        return read(rows, name) if name in rows.columns else null_of(dtype)

    ints = {
        "game_pk": "game_pk", "batter_id": "batter", "pitcher_id": "pitcher", "inning": "inning",
        "pa_index": "at_bat_number", "rbi": "rbi", "outs_when_up": "outs_when_up", "balls": "balls",
        "strikes": "strikes",
    }
    texts = {
        "inning_topbot": "inning_topbot", "event_type": "events", "event_text": "description",
        "batting_team": "batting_team", "fielding_team": "fielding_team",
    }
    date = date_text(F.col("game_date")) if "game_date" in rows.columns else null_of("string")
    return rows.select(
        *[get(c, int_of, "bigint").alias(n) for n, c in ints.items()],
        *[get(c, text_of, "string").alias(n) for n, c in texts.items()],
        date.alias("game_date"),
    )


def dedupe_pas(pa: DataFrame) -> DataFrame:
    """One row per game and sequence number, the last by date and inning."""
    order = [c for c in ("game_date", "inning", "inning_topbot") if c in pa.columns]
    return last_per_key(pa, ["game_pk", "pa_index"], order)


def season_pas(pitches: DataFrame, season: int | None, order: list[str], source: str = "statcast") -> DataFrame:
    """Pitch events to the season's plate-appearance table.

    One job over the whole season; ``rebuild_season`` does it chunk by chunk.
    """
    pas = plate_appearances(last_pitches(pitches, order), source)
    if season is not None:
        pas = pas.withColumn("season", F.lit(season).cast("bigint"))
    return dedupe_pas(pas).withColumn("game_date", date_of(F.col("game_date")))


def rebuild_season(
    spark: SparkSession, source: str, target: str, season: int | None, order: list[str], by: str = "month", label: str = "statcast"
) -> tuple[DataFrame, list[str]]:
    """(the season's plate appearances, chunks built by this run) from pitches in ``by=...`` folders.

    ``target`` keeps a ledger of (chunk, fingerprint of its files) and, per
    chunk, the last pitch of every at-bat. A run builds the chunks that the
    ledger does not have, one after the other, and enters each when it is
    written: a run that was stopped goes on where it was, and later runs read
    what is new. Chunks that are gone from the source leave the ledger.

    The last pitch of an at-bat is the last of its chunks' last pitches, so
    at-bats over several chunks come out as by a full rebuild.
    """
    ledger = Manifest(spark, target)
    now, done = folder_fingerprints(spark, source, by), ledger.read()
    kept = {chunk: entry for chunk, entry in done.items() if chunk in now}
    unseen = sorted(c for c, mark in now.items() if kept.get(c, {}).get("fingerprint") != mark)
    for chunk in unseen:
        folder = f"{by}={chunk}-{uuid.uuid4().hex}"
        pitches = spark.read.parquet(f"{source.rstrip('/')}/{by}={chunk}")
        last_per_key(pitches, ["game_pk", "at_bat_number"], order).write.parquet(f"{target.rstrip('/')}/{folder}")
        kept[chunk] = {"fingerprint": now[chunk], "folder": folder}
        ledger.replace(kept)
    if kept.keys() != done.keys():
        ledger.replace(kept)
    if not kept:
        raise ValueError(f"no {by}=... folder in {source}")
    chunks = [spark.read.parquet(f"{target.rstrip('/')}/{entry['folder']}") for _, entry in sorted(kept.items())]
    return season_pas(stack(chunks), season, order, label), unseen


def enrich_pas(pa: DataFrame, daily: DataFrame) -> DataFrame:
    """Plate appearances with the batter-day contact summary under canonical names."""
    base = pa.withColumns({"game_date": date_of(F.col("game_date")), "batter_id": int_of(pa, "batter_id")})
    joined = replace_columns(base, STALE_CONTACT, {}).join(daily, ["game_date", "batter_id"], "left")
    return replace_columns(joined, [], PROMOTED_CONTACT)


def bridge(frames: list[DataFrame]) -> DataFrame:
    """Seasons stacked by name with date and season typed."""
    out = stack(frames)
    casts = {}
    if "game_date" in out.columns:
        casts["game_date"] = date_of(F.col("game_date"))
    if "season" in out.columns:
        casts["season"] = int_of(out, "season")
    return out.withColumns(casts) if casts else out


def load_seasons(frames: list[DataFrame]) -> DataFrame:
    """Seasons stacked, rows without a date dropped."""
    return bridge(frames).filter(F.col("game_date").isNotNull())
