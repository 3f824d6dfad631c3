"""Raw record tables normalised to the declared contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import (
    date_text,
    flag_of,
    int_of,
    null_of,
    num_of,
    text_of,
)
from slatework.functions.events import EVENT_FLAGS, EXPLICIT_FLAGS, event_flag
from slatework.functions.text import half_inning
from slatework.operators.dedupe import ordinal
from slatework.operators.shape import pick

# Source names per output column, in order of preference.
PA_NAMES = {
    "game_pk": ["game_pk", "game_id"],
    "game_date": ["game_date", "date", "official_date"],
    "season": ["season"],
    "inning": ["inning", "inning_number"],
    "inning_topbot": ["inning_topbot", "inning_half", "half_inning", "top_bottom"],
    "batting_team": ["batting_team", "offense_team", "team_at_bat", "posteam"],
    "fielding_team": ["fielding_team", "defense_team", "team_in_field"],
    "batter_id": ["batter_id", "batter", "hitter_id", "player_id"],
    "batter_name": ["batter_name", "batter", "hitter_name", "player_name"],
    "pitcher_id": ["pitcher_id", "pitcher"],
    "pitcher_name": ["pitcher_name", "pitcher"],
    "pa_index": ["pa_index", "plate_appearance_index", "at_bat_number", "ab_number"],
    "pitch_number_start": ["pitch_number_start", "pitch_index_start"],
    "pitch_number_end": ["pitch_number_end", "pitch_index_end", "pitch_number"],
    "outs_before_pa": ["outs_before_pa", "outs_when_up", "outs_before"],
    "outs_after_pa": ["outs_after_pa", "outs_after"],
    "base_state_before": ["base_state_before", "on_base_start", "base_state_start"],
    "base_state_after": ["base_state_after", "on_base_end", "base_state_end"],
    "runs_scored_on_pa": ["runs_scored_on_pa", "runs_scored", "runs_on_play"],
    "rbi": ["rbi", "rbi_on_play"],
    "event_type": ["event_type", "event", "events", "result", "pa_result"],
    "event_text": ["event_text", "description", "play_description", "result_text"],
    "launch_speed": ["launch_speed", "hit_speed"],
    "launch_angle": ["launch_angle", "hit_angle"],
    "hit_distance_sc": ["hit_distance_sc", "hit_distance"],
    "bb_type": ["bb_type", "batted_ball_type"],
    "hc_x": ["hc_x", "hit_coordinate_x"],
    "hc_y": ["hc_y", "hit_coordinate_y"],
}
_PA_INTS = [
    "game_pk", "season", "inning", "batter_id", "pitcher_id", "pa_index", "pitch_number_start",
    "pitch_number_end", "outs_before_pa", "outs_after_pa", "runs_scored_on_pa", "rbi",
]
_PA_NUMBERS = ["launch_speed", "launch_angle", "hit_distance_sc", "hc_x", "hc_y"]


def _read(df: DataFrame, candidates: list[str], read, dtype: str, default=None) -> Column:
    name = pick(df.columns, candidates)
    return read(df, name) if name else F.lit(default).cast(dtype)


def audit(df: DataFrame, source: str | None) -> list[Column]:
    """Source label and pull time, defaulted where the records have none."""
    label = F.col("source").cast("string") if "source" in df.columns else F.lit(source or "unknown")
    pulled = (
        F.col("source_pull_ts").try_cast("timestamp")
        if "source_pull_ts" in df.columns
        else F.current_timestamp()
    )
    return [label.alias("source"), pulled.alias("source_pull_ts")]


def event_flags(df: DataFrame) -> dict[str, Column]:
    """Thirteen event flags: an explicit column wins, else the event text decides."""
    event = F.lower(F.trim(_read(df, PA_NAMES["event_type"], text_of, "string")))
    rbi = _read(df, PA_NAMES["rbi"], int_of, "bigint", 0)
    out = {}
    for name in EVENT_FLAGS:
        explicit = pick(df.columns, EXPLICIT_FLAGS[name])
        out[name] = flag_of(df, explicit) if explicit else event_flag(name, event, rbi)
    return out


def plate_appearances(
    df: DataFrame, source: str | None = None, arrival: list[str] | None = None
) -> DataFrame:
    """One normalised row per plate appearance.

    Rows without a sequence number get their position among such rows of the
    game in ``arrival`` order; without ``arrival`` they keep a null number.
    """

    def value(name: str) -> Column:
        candidates = PA_NAMES[name]
        if name in _PA_INTS:
            default = 0 if name in ("runs_scored_on_pa", "rbi") else None
            return _read(df, candidates, int_of, "bigint", default)
        if name in _PA_NUMBERS:
            return _read(df, candidates, num_of, "double")
        text = _read(df, candidates, text_of, "string")
        if name == "game_date":
            return date_text(text)
        if name == "inning_topbot":
            return half_inning(text)
        return F.lower(F.trim(text)) if name == "event_type" else text

    names = list(PA_NAMES)
    split = names.index("launch_speed")
    rows = df.select(
        *[value(n).alias(n) for n in names[:split]],
        *[c.alias(n) for n, c in event_flags(df).items()],
        *[value(n).alias(n) for n in names[split:]],
        *audit(df, source),
        *[F.col(c).alias(f"_arrival{i}") for i, c in enumerate(arrival or [])],
    )
    if not arrival:
        return rows
    order = [f"_arrival{i}" for i in range(len(arrival))]
    missing = F.col("pa_index").isNull()
    numbered = ordinal(rows.withColumn("_open", missing), ["game_pk", "_open"], order, "_ordinal")
    return numbered.withColumn("pa_index", F.coalesce("pa_index", "_ordinal")).drop(
        "_open", "_ordinal", *order
    )


def _home(df: DataFrame) -> Column:
    name = pick(df.columns, ["is_home", "home_flag"])
    return flag_of(df, name) if name else F.lit(False)


def _game_fields(df: DataFrame) -> list[Column]:
    date = pick(df.columns, ["game_date", "date"], required=True)
    return [
        _read(df, ["game_pk", "game_id"], int_of, "bigint").alias("game_pk"),
        date_text(F.col(date)).alias("game_date"),
        _read(df, ["season"], int_of, "bigint").alias("season"),
        _read(df, ["team", "team_abbr"], text_of, "string").alias("team"),
        _read(df, ["opponent", "opp", "opponent_abbr"], text_of, "string").alias("opponent"),
        _home(df).alias("is_home"),
    ]


def lineups(df: DataFrame, status: str, source: str | None = None) -> DataFrame:
    """One normalised row per listed player."""
    starting = (
        flag_of(df, "is_starting_lineup") if "is_starting_lineup" in df.columns else F.lit(True)
    )
    return df.select(
        *_game_fields(df),
        F.lit(status).alias("lineup_status"),
        *audit(df, source),
        _read(df, ["batting_order", "lineup_slot", "order"], int_of, "bigint").alias("batting_order"),
        _read(df, ["player_id", "batter_id", "mlbam_id"], int_of, "bigint").alias("player_id"),
        _read(df, ["player_name", "name", "batter_name"], text_of, "string").alias("player_name"),
        _read(df, ["handedness_bat", "bats"], text_of, "string").alias("handedness_bat"),
        _read(df, ["handedness_throw", "throws"], text_of, "string").alias("handedness_throw"),
        _read(df, ["position", "pos"], text_of, "string").alias("position"),
        starting.alias("is_starting_lineup"),
    )


def starters(df: DataFrame, status: str, source: str | None = None) -> DataFrame:
    """One normalised row per starting pitcher."""
    return df.select(
        *_game_fields(df),
        _read(df, ["pitcher_id", "player_id", "mlbam_id"], int_of, "bigint").alias("pitcher_id"),
        _read(df, ["pitcher_name", "player_name", "name"], text_of, "string").alias("pitcher_name"),
        _read(df, ["throws", "handedness_throw"], text_of, "string").alias("throws"),
        F.lit(status).alias("starter_status"),
        *audit(df, source),
    )


# Source names per park column, in order of preference.
PARK_NAMES = {
    "venue_id": ["venue_id", "park_id", "stadium_id", "id"],
    "venue_name": ["venue_name", "park_name", "stadium_name", "name"],
    "team": ["team", "team_abbr", "home_team"],
    "team_name": ["team_name", "home_team_name"],
    "city": ["city"],
    "state": ["state", "state_code", "province"],
    "country": ["country"],
    "surface_type": ["surface_type", "surface", "turf_type"],
    "roof_type": ["roof_type", "roof"],
    "is_dome": ["is_dome", "dome_flag"],
    "is_retractable": ["is_retractable", "retractable_roof_flag"],
    "altitude_ft": ["altitude_ft", "elevation_ft", "altitude"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "lng"],
    "time_zone": ["time_zone", "timezone"],
    "weather_station_id": ["weather_station_id", "metar_station_id", "station_id"],
    "park_factor_runs": ["park_factor_runs", "pf_runs"],
    "park_factor_hr": ["park_factor_hr", "pf_hr"],
    "park_factor_hits": ["park_factor_hits", "pf_hits"],
    "park_factor_2b": ["park_factor_2b", "pf_2b"],
    "park_factor_3b": ["park_factor_3b", "pf_3b"],
    "park_factor_bb": ["park_factor_bb", "pf_bb"],
    "park_source": ["park_source"],
    "park_source_season": ["park_source_season", "season"],
}
_PARK_NUMBERS = ["altitude_ft", "latitude", "longitude"] + [n for n in PARK_NAMES if "factor" in n]
# Roof texts that imply a flag.
DOME_ROOFS = ["dome", "fixed", "fixed_roof", "closed"]
RETRACTABLE_ROOFS = ["retractable", "retractable_roof", "retractable roof"]


def parks(df: DataFrame, source: str | None = None) -> DataFrame:
    """One normalised row per venue; roof flags fall back to the roof text."""

    def value(name: str) -> Column:
        if name in ("venue_id", "park_source_season"):
            return _read(df, PARK_NAMES[name], int_of, "bigint")
        if name in _PARK_NUMBERS:
            return _read(df, PARK_NAMES[name], num_of, "double")
        default = {"country": "USA", "park_source": source or "unknown"}.get(name)
        return _read(df, PARK_NAMES[name], text_of, "string", default)

    roof = F.lower(value("roof_type"))

    def roof_flag(name: str, texts: list[str]) -> Column:
        source_name = pick(df.columns, PARK_NAMES[name])
        explicit = flag_of(df, source_name) if source_name else null_of("boolean")
        return F.coalesce(explicit, roof.isin(texts), F.lit(False))

    special = {
        "is_dome": roof_flag("is_dome", DOME_ROOFS),
        "is_retractable": roof_flag("is_retractable", RETRACTABLE_ROOFS),
    }
    return df.select(
        *[(special[n] if n in special else value(n)).alias(n) for n in PARK_NAMES],
        *audit(df, source),
    )


def confirmed_lineups(df: DataFrame, season: int, slate_date: str) -> DataFrame:
    """Final confirmed-lineup table: fills, fixed columns, rows without a name dropped."""
    have = set(df.columns)

    def text(name: str, default: str | None = None) -> Column:
        return F.col(name).cast("string") if name in have else F.lit(default).cast("string")

    date = date_text(F.col("game_date")) if "game_date" in have else null_of("string")
    slot = pick(df.columns, ["batting_order", "lineup_slot"])
    return df.select(
        _read(df, ["game_pk"], int_of, "bigint").alias("game_pk"),
        F.coalesce(date, F.lit(slate_date)).alias("game_date"),
        F.lit(season).cast("bigint").alias("season"),
        text("team").alias("team"),
        text("opponent").alias("opponent"),
        (F.col("is_home") if "is_home" in have else null_of("boolean")).alias("is_home"),
        text("lineup_status", "confirmed").alias("lineup_status"),
        text("source", "rotowire").alias("source"),
        F.current_timestamp().alias("source_pull_ts"),
        (int_of(df, slot) if slot else null_of("bigint")).alias("batting_order"),
        _read(df, ["player_id"], int_of, "bigint").alias("player_id"),
        F.trim(text("player_name")).alias("player_name"),
        text("handedness_bat").alias("handedness_bat"),
        null_of("string").alias("handedness_throw"),
        text("position").alias("position"),
        F.lit(True).alias("is_starting_lineup"),
        _read(df, ["rotowire_id"], int_of, "bigint").alias("rotowire_id"),
    ).dropna(subset=["team", "player_name"])
