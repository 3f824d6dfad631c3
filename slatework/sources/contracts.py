"""Declared table contracts and conformance to them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import int_of, null_of, text_of


@dataclass(frozen=True)
class Contract:
    name: str
    columns: list[str]
    required: list[str]
    key: list[str]
    bigint: list[str] = field(default_factory=list)
    string: list[str] = field(default_factory=list)


# Columns of both lineup contracts.
_LINEUP_COLUMNS = [
    "game_pk", "game_date", "season", "team", "opponent", "is_home", "lineup_status", "source",
    "source_pull_ts", "batting_order", "player_id", "player_name", "handedness_bat",
    "handedness_throw", "position", "is_starting_lineup",
]


def _lineups(name: str) -> Contract:
    return Contract(
        name,
        columns=_LINEUP_COLUMNS,
        required=[
            "game_pk", "game_date", "season", "team", "lineup_status", "batting_order", "player_name",
        ],
        key=["game_pk", "team", "lineup_status", "batting_order"],
        bigint=["game_pk", "season", "batting_order"],
        string=["game_date", "team", "lineup_status", "player_name"],
    )


# The eight table contracts.
CONTRACTS = {
    c.name: c
    for c in [
        Contract(
            "games_schedule",
            columns=[
                "game_pk", "game_date", "season", "game_type", "status", "status_detailed",
                "coded_game_state", "scheduled_start_time_utc", "scheduled_start_time_et", "away_team",
                "home_team", "away_team_name", "home_team_name", "away_team_id", "home_team_id",
                "venue_id", "venue_name", "doubleheader_flag", "game_number", "series_description",
                "day_night", "scheduled_innings", "if_necessary", "if_necessary_description",
                "resume_date", "resume_game_date", "public_facing",
            ],
            required=[
                "game_pk", "game_date", "season", "away_team", "home_team", "venue_id",
            ],
            key=["game_pk"],
            bigint=["game_pk", "season", "venue_id"],
            string=["game_date", "away_team", "home_team"],
        ),
        Contract(
            "games",
            columns=[
                "game_pk", "game_date", "season", "game_type", "status", "status_detailed",
                "coded_game_state", "away_team", "home_team", "away_team_name", "home_team_name",
                "away_team_id", "home_team_id", "venue_id", "venue_name", "away_score", "home_score",
                "winning_team", "losing_team", "home_win", "start_time_utc", "start_time_et",
                "resume_time_utc", "resume_time_et", "day_night", "doubleheader_flag", "game_number",
                "series_description", "scheduled_innings", "innings", "current_inning",
                "current_inning_ordinal", "inning_state", "inning_half", "is_tied", "balls", "strikes",
                "outs", "scheduled_start_time_utc", "scheduled_start_time_et", "if_necessary",
                "if_necessary_description", "resume_date", "resume_game_date", "public_facing",
                "series_game_number", "games_in_series", "abstract_game_code",
            ],
            required=[
                "game_pk", "game_date", "season", "away_team", "home_team", "venue_id", "status",
            ],
            key=["game_pk"],
            bigint=["game_pk", "season", "venue_id"],
            string=["game_date", "away_team", "home_team", "status"],
        ),
        Contract(
            "weather_game",
            columns=[
                "game_pk", "game_date", "season", "home_team", "away_team", "venue_id", "venue_name",
                "station_id", "observed_at_utc", "temperature_f", "temperature_c", "dewpoint_f",
                "dewpoint_c", "wind_mph", "wind_kt", "wind_gust_mph", "wind_gust_kt",
                "wind_direction_deg", "wind_dir_text", "pressure_hpa", "visibility_miles",
                "ceiling_ft", "weather_condition", "flight_category", "humidity", "precipitation_mm",
                "roof_status", "weather_wind_out", "weather_wind_in", "weather_crosswind", "raw_metar",
                "weather_source", "weather_pull_ts",
            ],
            required=[
                "game_pk", "game_date", "season", "home_team", "away_team", "venue_id",
            ],
            key=["game_pk"],
            bigint=["game_pk", "season", "venue_id"],
            string=["game_date", "home_team", "away_team", "station_id"],
        ),
        _lineups("projected_lineups"),
        _lineups("confirmed_lineups"),
        Contract(
            "starting_pitchers",
            columns=[
                "game_pk", "game_date", "season", "team", "opponent", "is_home", "pitcher_id",
                "pitcher_name", "throws", "starter_status", "source", "source_pull_ts",
            ],
            required=[
                "game_pk", "game_date", "season", "team", "starter_status", "pitcher_name",
            ],
            key=["game_pk", "team", "starter_status"],
            bigint=["game_pk", "season"],
            string=["game_date", "team", "starter_status", "pitcher_name"],
        ),
        Contract(
            "plate_appearances",
            columns=[
                "game_pk", "game_date", "season", "inning", "inning_topbot", "batting_team",
                "fielding_team", "batter_id", "batter_name", "pitcher_id", "pitcher_name", "pa_index",
                "pitch_number_start", "pitch_number_end", "outs_before_pa", "outs_after_pa",
                "base_state_before", "base_state_after", "runs_scored_on_pa", "rbi", "event_type",
                "event_text", "is_pa", "is_ab", "is_hit", "is_1b", "is_2b", "is_3b", "is_hr", "is_bb",
                "is_hbp", "is_so", "is_rbi", "is_sac_fly", "is_reached_on_error", "source",
                "source_pull_ts",
            ],
            required=["game_pk", "game_date", "pa_index", "event_type"],
            key=["game_pk", "pa_index"],
            bigint=["game_pk", "pa_index"],
            string=[
                "game_date", "event_type", "batter_name", "pitcher_name",
            ],
        ),
        Contract(
            "parks",
            columns=[
                "venue_id", "venue_name", "team", "team_name", "city", "state", "country",
                "surface_type", "roof_type", "is_dome", "is_retractable", "altitude_ft", "latitude",
                "longitude", "time_zone", "weather_station_id", "park_factor_runs", "park_factor_hr",
                "park_factor_hits", "park_factor_2b", "park_factor_3b", "park_factor_bb",
                "park_source", "park_source_season", "source", "source_pull_ts",
            ],
            required=["venue_id", "venue_name"],
            key=["venue_id"],
            bigint=["venue_id"],
            string=["venue_name", "team", "weather_station_id"],
        ),
    ]
}


def contract(name: str) -> Contract:
    if name not in CONTRACTS:
        raise KeyError(f"no contract {name!r}; known: {', '.join(sorted(CONTRACTS))}")
    return CONTRACTS[name]


def conform(df: DataFrame, columns: list[str], types: dict[str, str] | None = None) -> DataFrame:
    """Declared columns first (missing ones null), other columns after."""
    types = types or {}
    have = set(df.columns)
    declared = [
        F.col(c) if c in have else null_of(types.get(c, "string")).alias(c) for c in columns
    ]
    return df.select(*declared, *[c for c in df.columns if c not in set(columns)])


def conform_to(df: DataFrame, name: str) -> DataFrame:
    spec = contract(name)
    return conform(df, spec.columns, {c: "bigint" for c in spec.bigint})


def apply_types(df: DataFrame, bigint: list[str] = (), string: list[str] = ()) -> DataFrame:
    """Best-effort casts of the columns that exist; bad values become null."""
    casts = {c: int_of(df, c) for c in bigint if c in df.columns}
    casts.update({c: text_of(df, c) for c in string if c in df.columns})
    return df.withColumns(casts) if casts else df


def apply_contract_types(df: DataFrame, name: str) -> DataFrame:
    spec = contract(name)
    return apply_types(df, spec.bigint, spec.string)
