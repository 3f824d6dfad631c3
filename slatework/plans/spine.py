"""One row per game: schedule joined with games, weather, parks and team sides."""

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
from slatework.functions.teams import SPINE, roof_class, station_of, team_code
from slatework.functions.text import degrees_text
from slatework.operators.dedupe import last_per_key
from slatework.operators.quality import assert_unique, share
from slatework.operators.shape import pick, stack
from slatework.session import stage

_READ = {
    "i": (int_of, "bigint"),
    "f": (num_of, "double"),
    "s": (text_of, "string"),
    "b": (flag_of, "boolean"),
    "d": (lambda df, name: date_text(F.col(name)), "string"),
    "t": (lambda df, name: F.col(name).try_cast("timestamp"), "timestamp"),
}


def _select(df: DataFrame, fields: list[tuple[str, str, str]], extra: list[str] = ()) -> DataFrame:
    """``fields`` lists (output, kind, input); a missing input is null."""
    out = []
    for name, kind, source in fields:
        read, dtype = _READ[kind]
        out.append((read(df, source) if source in df.columns else null_of(dtype)).alias(name))
    return df.select(*out, *extra)


# Fixed values: (output column, kind of value, input column) of each part of the spine.
SCHEDULE = [
    ("game_pk", "i", "game_pk"), ("game_date", "d", "game_date"), ("season", "i", "season"),
    ("game_type", "s", "game_type"), ("status", "s", "status"),
    ("status_detailed", "s", "status_detailed"),
    ("scheduled_start_time_utc", "s", "scheduled_start_time_utc"),
    ("scheduled_start_time_et", "s", "scheduled_start_time_et"), ("away_team", "s", "away_team"),
    ("home_team", "s", "home_team"), ("away_team_id", "i", "away_team_id"),
    ("home_team_id", "i", "home_team_id"), ("away_team_name", "s", "away_team_name"),
    ("home_team_name", "s", "home_team_name"), ("venue_id", "i", "venue_id"),
    ("venue_name", "s", "venue_name"), ("doubleheader_flag", "b", "doubleheader_flag"),
    ("game_number", "i", "game_number"), ("series_description", "s", "series_description"),
    ("day_night", "s", "day_night"),
]
GAMES = [
    ("game_pk", "i", "game_pk"), ("game_status", "s", "status"),
    ("game_status_detailed", "s", "status_detailed"), ("away_score", "i", "away_score"),
    ("home_score", "i", "home_score"), ("home_win", "b", "home_win"), ("innings", "i", "innings"),
    ("start_time_utc", "s", "start_time_utc"), ("start_time_et", "s", "start_time_et"),
]
WEATHER = [
    ("game_pk", "i", "game_pk"), ("weather_station_id", "s", "station_id"),
    ("weather_observed_at_utc", "t", "observed_at_utc"), ("temperature_f", "f", "temperature_f"),
    ("temperature_c", "f", "temperature_c"), ("dewpoint_f", "f", "dewpoint_f"),
    ("dewpoint_c", "f", "dewpoint_c"), ("wind_mph", "f", "wind_mph"), ("wind_kt", "f", "wind_kt"),
    ("wind_gust_mph", "f", "wind_gust_mph"), ("wind_gust_kt", "f", "wind_gust_kt"),
    ("wind_direction_deg", "f", "wind_direction_deg"), ("wind_dir_text", "s", "wind_dir_text"),
    ("pressure_hpa", "f", "pressure_hpa"), ("visibility_miles", "f", "visibility_miles"),
    ("ceiling_ft", "i", "ceiling_ft"), ("weather_condition", "s", "weather_condition"),
    ("flight_category", "s", "flight_category"), ("humidity", "f", "humidity"),
    ("precipitation_mm", "f", "precipitation_mm"), ("roof_status_weather", "s", "roof_status"),
    ("weather_wind_out", "f", "weather_wind_out"), ("weather_wind_in", "f", "weather_wind_in"),
    ("weather_crosswind", "f", "weather_crosswind"), ("weather_source", "s", "weather_source"),
]
PARKS = [
    ("venue_id", "i", "venue_id"), ("park_team", "s", "team"), ("park_team_name", "s", "team_name"),
    ("park_city", "s", "city"), ("park_state", "s", "state"), ("park_country", "s", "country"),
    ("surface_type", "s", "surface_type"), ("roof_type", "s", "roof_type"),
    ("is_dome", "b", "is_dome"), ("is_retractable", "b", "is_retractable"),
    ("altitude_ft", "f", "altitude_ft"), ("park_latitude", "f", "latitude"),
    ("park_longitude", "f", "longitude"), ("park_time_zone", "s", "time_zone"),
    ("park_weather_station_id", "s", "weather_station_id"),
    ("park_factor_runs", "f", "park_factor_runs"), ("park_factor_hr", "f", "park_factor_hr"),
    ("park_factor_hits", "f", "park_factor_hits"), ("park_factor_2b", "f", "park_factor_2b"),
    ("park_factor_3b", "f", "park_factor_3b"), ("park_factor_bb", "f", "park_factor_bb"),
]
LINEUPS = [
    ("game_pk", "i", "game_pk"), ("team", "s", "team"), ("lineup_status", "s", "lineup_status"),
    ("batting_order", "i", "batting_order"), ("player_id", "i", "player_id"),
    ("player_name", "s", "player_name"),
]
STARTERS = [
    ("game_pk", "i", "game_pk"), ("team", "s", "team"), ("starter_status", "s", "starter_status"),
    ("starter_pitcher_id", "i", "pitcher_id"), ("starter_pitcher_name", "s", "pitcher_name"),
    ("starter_throws", "s", "throws"),
]


def prep_schedule(schedule: DataFrame, check: bool = True) -> DataFrame:
    """Base of the spine; a missing required column or a repeated game is an error."""
    for c in ("game_pk", "game_date", "season", "away_team", "home_team", "venue_id"):
        pick(schedule.columns, [c], required=True)
    base = _select(schedule, SCHEDULE)
    base = base.withColumn("doubleheader_flag", F.coalesce("doubleheader_flag", F.lit(False)))
    if check:
        assert_unique(base, ["game_pk"], "schedule")
    return base


def _last(df: DataFrame, fields, keys: list[str], order: list[str]) -> DataFrame:
    """Renamed and cast rows, the last one per key in ``order``."""
    names = [f"_o{i}" for i in range(len(order))]
    kept = df.withColumns({n: F.col(o) for n, o in zip(names, order)})
    return last_per_key(_select(kept, fields, names), keys, names).drop(*names)


def prep_side(df: DataFrame, fields: list[tuple[str, str, str]], key: str, order: list[str]) -> DataFrame:
    """Optional input; without an ``order`` its key must already be unique."""
    return _last(df, fields, [key], order) if order else _select(df, fields)


def lineup_summary(lineups: DataFrame, prefix: str) -> DataFrame:
    """One row per game and team: last status, slots, distinct players, end batters.

    First and last follow the batting order, null slots last.
    """
    df = _select(lineups, LINEUPS)
    slot = F.coalesce("batting_order", F.lit(2**31))

    def at(name: str, pick_by) -> Column:
        return pick_by(name, F.when(F.col(name).isNotNull(), F.struct(slot, "player_id")))

    return df.groupBy("game_pk", "team").agg(
        at("lineup_status", F.max_by).alias(f"{prefix}_lineup_status"),
        F.count("batting_order").alias(f"{prefix}_lineup_spots"),
        F.countDistinct("player_id").alias(f"{prefix}_distinct_players"),
        at("player_name", F.min_by).alias(f"{prefix}_first_batter"),
        at("player_name", F.max_by).alias(f"{prefix}_last_batter"),
        F.lit(True).alias(f"{prefix}_lineup_found"),
    )


def starter_summary(starters: DataFrame, order: list[str]) -> DataFrame:
    """Last starter row per game and team, with a found flag."""
    return _last(starters, STARTERS, ["game_pk", "team"], order).withColumn(
        "starter_found", F.lit(True)
    )


def _one_of(keys: list[str], parts: dict[str, tuple[DataFrame, list[str]]], check: bool) -> DataFrame:
    """One row per key with the columns of every part as ``part.column``: all parts stacked, one aggregate.

    A part is (rows with the keys, order columns). Of several rows of a key the
    last by the order counts; without an order a second row stops the job, which
    the same aggregate notices. Columns are folded singly, so that those nobody
    reads are never made. ``_n_part`` counts a part's rows.
    """
    stacked, aggregates, fine = [], [], F.lit(True)
    for label, (df, order) in parts.items():
        # Nulls sort last, as newest.
        newest = F.struct(*[x for o in order for x in (F.col(o).isNull().alias(f"{o}_null"), F.col(o).alias(o))]) if order else F.lit(0)
        names = [c for c in df.columns if c not in (*keys, *order)]
        stacked.append(df.select(*keys, *[F.col(c).alias(f"{label}.{c}") for c in names], newest.alias(f"_order_{label}")))
        aggregates += [F.max_by(f"`{label}.{c}`", f"_order_{label}").alias(f"{label}.{c}") for c in names]
        aggregates.append(F.count(f"_order_{label}").alias(f"_n_{label}"))
        if check and not order:
            texts = [F.concat(F.lit(f" {k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys]
            stop = F.raise_error(F.concat(F.lit(f"{label}: repeated key"), *texts)).cast("boolean")
            fine = fine & F.when(F.col(f"_n_{label}") > 1, stop).otherwise(True)
    return stack(stacked).groupBy(*keys).agg(*aggregates).filter(fine)


def _ordered(df: DataFrame, fields, order: list[str]) -> tuple[DataFrame, list[str]]:
    """Renamed and cast rows with their order columns under names of their own."""
    names = [f"_o{i}" for i in range(len(order))]
    return _select(df.withColumns({n: F.col(o) for n, o in zip(names, order)}), fields, names), names


def build_spine(
    schedule: DataFrame,
    games: DataFrame | None = None,
    weather: DataFrame | None = None,
    parks: DataFrame | None = None,
    projected: DataFrame | None = None,
    confirmed: DataFrame | None = None,
    starters: DataFrame | None = None,
    orders: dict[str, list[str]] | None = None,
    check: bool = True,
) -> DataFrame:
    """Unified pregame table, one row per scheduled game.

    ``orders`` names, per optional input, the columns that say which of several
    rows of a key is the last. Schedule, games and weather are stacked and folded
    per game, lineups and starters per game and team; each fold is one aggregate,
    which with ``check`` also verifies the declared cardinalities: a repeated key
    stops the job. Inputs that are dealt by game alike are not moved again. Only the
    fold of the parks runs before the plan is executed.
    """
    orders = {"games": [], "weather": [], "parks": [], "starters": ["pitcher_id"], **(orders or {})}
    base = prep_schedule(schedule, check=False)
    per_game = {"schedule": (base, [])}
    for name, df, fields in (("games", games, GAMES), ("weather", weather, WEATHER)):
        if df is not None:
            per_game[name] = _ordered(df, fields, orders[name])
    folded = _one_of(["game_pk"], per_game, check).filter(F.col("_n_schedule") > 0)
    inner = [f"{label}.{c}" for label, (df, order) in per_game.items() for c in df.columns if c not in ("game_pk", *order)]
    out = folded.select("game_pk", *[F.col(f"`{c}`").alias(c.split(".")[1]) for c in inner])
    columns = out.columns
    sides = {label: lineup_summary(df, label) for label, df in (("projected", projected), ("confirmed", confirmed)) if df is not None}
    if starters is not None:
        sides["starters"] = starter_summary(starters, orders["starters"])
    wide = {f"{w}_{c}": (f"{label}.{c}", w) for label, df in sides.items() for w in ("away", "home") for c in df.columns if c not in ("game_pk", "team")}
    if sides:
        per_team = {
            label: (df.withColumn("_norm", team_code(F.col("team"), SPINE)).drop("team"), []) for label, df in sides.items()
        }
        teams = _one_of(["game_pk", "_norm"], per_team, check).withColumnRenamed("game_pk", "_game_pk")
        named = out.withColumns({f"_{w}_norm": team_code(F.col(f"{w}_team"), SPINE) for w in ("away", "home")})
        # Joined and put beside each other by game alone, where the teams of a game already lie.
        plays = (F.col("_norm") == F.col("_away_norm")) | (F.col("_norm") == F.col("_home_norm"))
        both = named.join(teams, (F.col("game_pk") == F.col("_game_pk")) & plays, "left")
        out = both.groupBy("game_pk").agg(
            *[F.max(c).alias(c) for c in columns if c != "game_pk"],
            *[F.max(F.when(F.col("_norm") == F.col(f"_{w}_norm"), F.col(f"`{c}`"))).alias(n) for n, (c, w) in wide.items()],
        )
    if parks is not None:
        rows, order = _ordered(parks, PARKS, orders["parks"])
        side = _one_of(["venue_id"], {"parks": (rows, order)}, check)
        names = [c for c in rows.columns if c not in ("venue_id", *order)]
        # Written, so that its size is known and games are not moved to meet a few parks.
        side = stage(side.select("venue_id", *[F.col(f"`parks.{c}`").alias(c) for c in names]), "parks")
        out = out.join(side, "venue_id", "left").select(*columns, *names, *wide)
    flags = [f"{w}_{c}" for c in ("projected_lineup_found", "confirmed_lineup_found", "starter_found") for w in ("away", "home")]
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) if c in out.columns else F.lit(False) for c in flags})
    both = {
        "lineups_projected_both_found": "projected_lineup_found",
        "lineups_confirmed_both_found": "confirmed_lineup_found",
        "starters_both_found": "starter_found",
    }
    return out.withColumns(
        {name: F.col(f"away_{c}") & F.col(f"home_{c}") for name, c in both.items()}
    )


def coverage(spine: DataFrame) -> DataFrame:
    """Share of games with both starters and both projected lineups."""
    return spine.agg(
        share(F.col("away_starter_found") & F.col("home_starter_found")).alias("pct_both_starters"),
        share(F.col("away_projected_lineup_found") & F.col("home_projected_lineup_found")).alias(
            "pct_both_projected"
        ),
    )


def game_weather(
    schedule: DataFrame, observations: DataFrame, stations: dict[str, str] | None = None
) -> DataFrame:
    """Game to the latest observation of its home station."""
    latest = last_per_key(observations, ["station_id"], ["observed_at_utc"])
    games = schedule.withColumn("station_id", station_of(F.col("home_team"), stations))
    joined = games.join(latest, "station_id", "left")
    return joined.select(
        int_of(joined, "game_pk").alias("game_pk"),
        date_text(F.col("game_date")).alias("game_date"),
        int_of(joined, "season").alias("season"),
        "home_team",
        "away_team",
        int_of(joined, "venue_id").alias("venue_id"),
        (F.col("venue_name") if "venue_name" in joined.columns else null_of("string")).alias("venue_name"),
        "station_id",
        "observed_at_utc",
        "temperature_f",
        "temperature_c",
        "dewpoint_f",
        "dewpoint_c",
        F.col("wind_speed_mph").alias("wind_mph"),
        F.col("wind_speed_kt").alias("wind_kt"),
        "wind_gust_mph",
        "wind_gust_kt",
        F.col("wind_dir_degrees").alias("wind_direction_deg"),
        degrees_text(F.col("wind_dir_degrees")).alias("wind_dir_text"),
        "pressure_hpa",
        "visibility_miles",
        "ceiling_ft",
        "weather_condition",
        "flight_category",
        "humidity",
        "precipitation_mm",
        roof_class(F.col("home_team")).alias("roof_status"),
        "weather_wind_out",
        "weather_wind_in",
        "weather_crosswind",
        "raw_metar",
        F.coalesce("weather_source", F.lit("awc_metar")).alias("weather_source"),
        "weather_pull_ts",
    )
