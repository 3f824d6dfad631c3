"""Nested JSON feeds flattened to rows.

A feed is a text column holding one JSON document per row; the schema is
declared, so nothing is inferred and unused branches are not parsed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import date_text, number_text, whole
from slatework.functions.events import game_result
from slatework.functions.scoring import fahrenheit, mph, wind_sectors
from slatework.functions.teams import LIVE, team_code

_TEAM = "team: struct<id: bigint, abbreviation: string, name: string>"
_PROBABLE = "probablePitcher: struct<id: bigint, fullName: string>"
_SIDE = f"struct<score: bigint, {_TEAM}, {_PROBABLE}>"
_LINESCORE = (
    "linescore: struct<currentInning: bigint, currentInningOrdinal: string, inningState: string,"
    " inningHalf: string, scheduledInnings: bigint, isTie: boolean, balls: bigint, strikes: bigint,"
    " outs: bigint>"
)
_GAME = (
    "struct<gamePk: bigint, gameDate: string, officialDate: string, gameType: string,"
    " status: struct<abstractGameState: string, detailedState: string, codedGameState: string>,"
    f" teams: struct<away: {_SIDE}, home: {_SIDE}>, venue: struct<id: bigint, name: string>,"
    " doubleHeader: string, gameNumber: bigint, seriesDescription: string, dayNight: string,"
    " scheduledInnings: bigint, ifNecessary: string, ifNecessaryDescription: string,"
    " resumeDate: string, resumeGameDate: string, publicFacing: string,"
    f" seriesGameNumber: bigint, gamesInSeries: bigint, {_LINESCORE}>"
)
SCHEDULE_FEED = f"dates array<struct<date: string, games: array<{_GAME}>>>"
_PERSON = "struct<id: bigint, fullName: string>"
PLAY_FEED = (
    "gamePk bigint, gameData struct<datetime: struct<officialDate: string>>,"
    " liveData struct<plays: struct<allPlays: array<struct<"
    f"matchup: struct<batter: {_PERSON}, pitcher: {_PERSON}>,"
    " result: struct<eventType: string, description: string, rbi: bigint>,"
    " about: struct<inning: bigint, halfInning: string>>>>>"
)
VENUE_FEED = (
    "venues array<struct<id: bigint, name: string, location: struct<city: string,"
    " stateAbbrev: string, country: string, latitude: double, longitude: double>,"
    " timeZone: struct<id: string>, roofType: string, turfType: string>>"
)
_OBSERVATION_FIELDS = [
    "icaoId", "station_id", "station", "id", "obsTime", "observationTime", "observation_time", "temp",
    "tempC", "dewp", "dewpoint", "wdir", "windDir", "wspd", "windSpeed", "wgst", "windGust", "altim",
    "seaLevelPressure", "visib", "visibility", "rawOb", "raw_text", "rawText", "flight_category",
    "wxString", "wx", "ceil",
]
OBSERVATION_FEED = "array<struct<" + ", ".join(f"{f}: string" for f in _OBSERVATION_FIELDS) + ">>"


def parse(df: DataFrame, text: str, schema: str, name: str = "feed") -> DataFrame:
    return df.withColumn(name, F.from_json(text, schema))


def path_or(value: Column, default) -> Column:
    """Nested value with a default for a missing step."""
    return F.coalesce(value, F.lit(default))


def truthy(value: Column, default: bool) -> Column:
    """Truth of a JSON scalar read as text; any non-empty word counts as true."""
    return F.when(value.isNull(), F.lit(default)).otherwise(~value.isin("", "0", "false"))


def first_filled(*values: Column) -> Column:
    return F.coalesce(*[F.when(v != "", v) for v in values])


def zone_time(instant: Column, zone: str) -> Column:
    """Wall-clock time in a zone, independent of the session time zone."""
    return F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz"))


def iso_text(instant: Column, zone: str) -> Column:
    """ISO text with the UTC offset in force in that zone at that instant."""
    local, utc = zone_time(instant, zone), zone_time(instant, "UTC")
    clock = F.replace(local.cast("string"), F.lit(" "), F.lit("T"))
    clock = F.when(clock.contains("."), F.rpad(clock, 26, "0")).otherwise(clock)
    minutes = F.timestamp_diff("MINUTE", utc, local).cast("int")
    hours = F.abs(F.floor(F.abs(minutes) / 60)).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    return F.concat(clock, sign, F.format_string("%02d:%02d", hours, F.abs(minutes) % 60))


def _games(df: DataFrame, text: str) -> DataFrame:
    return (
        parse(df, text, SCHEDULE_FEED)
        .select(F.explode("feed.dates").alias("block"))
        .select(F.col("block.date").alias("block_date"), F.explode("block.games").alias("g"))
    )


def _start_times(prefix: str, source: Column) -> list[Column]:
    at = F.try_to_timestamp(source)
    return [
        iso_text(at, "UTC").alias(f"{prefix}_utc"),
        iso_text(at, "America/New_York").alias(f"{prefix}_et"),
    ]


def _teams() -> list[Column]:
    return [
        F.col(f"g.teams.{side}.team.{field}").alias(name)
        for field, suffix in (("abbreviation", "team"), ("name", "team_name"), ("id", "team_id"))
        for side in ("away", "home")
        for name in [f"{side}_{suffix}"]
    ]


def _flags() -> list[Column]:
    return [
        path_or(F.upper("g.doubleHeader") == "Y", False).alias("doubleheader_flag"),
        F.col("g.gameNumber").alias("game_number"),
        F.col("g.seriesDescription").alias("series_description"),
        F.col("g.dayNight").alias("day_night"),
        truthy(F.col("g.ifNecessary"), False).alias("if_necessary"),
        F.col("g.ifNecessaryDescription").alias("if_necessary_description"),
        F.col("g.resumeDate").alias("resume_date"),
        F.col("g.resumeGameDate").alias("resume_game_date"),
        truthy(F.col("g.publicFacing"), True).alias("public_facing"),
    ]


def _identity(date: Column, season: Column) -> list[Column]:
    return [
        F.col("g.gamePk").alias("game_pk"),
        date_text(date).alias("game_date"),
        season.cast("bigint").alias("season"),
        F.col("g.gameType").alias("game_type"),
        F.col("g.status.abstractGameState").alias("status"),
        F.col("g.status.detailedState").alias("status_detailed"),
        F.col("g.status.codedGameState").alias("coded_game_state"),
        F.col("g.venue.id").alias("venue_id"),
        F.col("g.venue.name").alias("venue_name"),
    ]


def schedule_rows(df: DataFrame, text: str, season: Column) -> DataFrame:
    """Schedule feed to one row per game."""
    return _games(df, text).select(
        *_identity(F.col("block_date"), season),
        *_start_times("scheduled_start_time", F.col("g.gameDate")),
        *_teams(),
        *_flags(),
        F.col("g.scheduledInnings").alias("scheduled_innings"),
    )


def game_rows(df: DataFrame, text: str, season: Column) -> DataFrame:
    """Game feed to one row per game with scores, result and line score."""
    line = F.col("g.linescore")

    def positive(value: Column) -> Column:
        return F.when(value != 0, value)

    home_score, away_score = F.col("g.teams.home.score"), F.col("g.teams.away.score")
    result = game_result(
        F.col("g.teams.home.team.abbreviation"),
        F.col("g.teams.away.team.abbreviation"),
        home_score,
        away_score,
    )
    rows = _games(df, text).select(
        *_identity(first_filled(F.col("g.officialDate"), F.col("block_date")), season),
        *_teams(),
        away_score.alias("away_score"),
        home_score.alias("home_score"),
        *[c.alias(n) for n, c in result.items()],
        *_start_times("start_time", F.col("g.gameDate")),
        *_start_times("resume_time", F.col("g.resumeDate")),
        *_flags(),
        F.coalesce(positive(F.col("g.scheduledInnings")), line["scheduledInnings"]).alias(
            "scheduled_innings"
        ),
        F.coalesce(positive(line["currentInning"]), line["scheduledInnings"]).alias("innings"),
        line["currentInning"].alias("current_inning"),
        line["currentInningOrdinal"].alias("current_inning_ordinal"),
        line["inningState"].alias("inning_state"),
        line["inningHalf"].alias("inning_half"),
        line["isTie"].alias("is_tied"),
        line["balls"].alias("balls"),
        line["strikes"].alias("strikes"),
        line["outs"].alias("outs"),
        F.col("g.seriesGameNumber").alias("series_game_number"),
        F.col("g.gamesInSeries").alias("games_in_series"),
        F.col("g.gamePk").alias("abstract_game_code"),
    )
    return rows.withColumns(
        {
            "scheduled_start_time_utc": F.col("start_time_utc"),
            "scheduled_start_time_et": F.col("start_time_et"),
        }
    )


def play_rows(df: DataFrame, text: str) -> DataFrame:
    """Play feed to one row per plate appearance with its 0-based ordinal."""
    return (
        parse(df, text, PLAY_FEED)
        .select("feed", F.posexplode("feed.liveData.plays.allPlays").alias("pos", "p"))
        .select(
            F.col("pos").cast("bigint").alias("pa_index"),
            F.col("feed.gamePk").alias("game_pk"),
            F.col("feed.gameData.datetime.officialDate").alias("game_date"),
            F.col("p.about.inning").alias("inning"),
            F.col("p.about.halfInning").alias("inning_topbot"),
            F.col("p.matchup.batter.id").alias("batter_id"),
            F.col("p.matchup.batter.fullName").alias("batter_name"),
            F.col("p.matchup.pitcher.id").alias("pitcher_id"),
            F.col("p.matchup.pitcher.fullName").alias("pitcher_name"),
            F.col("p.result.eventType").alias("event_type"),
            F.col("p.result.description").alias("event_text"),
            F.col("p.result.rbi").alias("rbi"),
        )
    )


def venue_rows(df: DataFrame, text: str) -> DataFrame:
    """Venue feed to one row per venue."""
    return (
        parse(df, text, VENUE_FEED)
        .select(F.explode("feed.venues").alias("v"))
        .select(
            F.col("v.id").alias("venue_id"),
            F.col("v.name").alias("venue_name"),
            F.col("v.location.city").alias("city"),
            F.col("v.location.stateAbbrev").alias("state"),
            F.col("v.location.country").alias("country"),
            F.col("v.location.latitude").alias("latitude"),
            F.col("v.location.longitude").alias("longitude"),
            F.col("v.timeZone.id").alias("time_zone"),
            F.col("v.roofType").alias("roof_type"),
            F.col("v.turfType").alias("turf_type"),
        )
    )


def probable_starter_rows(df: DataFrame, text: str) -> DataFrame:
    """Up to two rows per game, where both the team and its pitcher are named."""

    def side(me: str, other: str, is_home: bool) -> Column:
        return F.struct(
            F.col(f"g.teams.{me}.team.abbreviation").alias("team"),
            F.col(f"g.teams.{other}.team.abbreviation").alias("opponent"),
            F.lit(is_home).alias("is_home"),
            F.col(f"g.teams.{me}.probablePitcher").alias("pitcher"),
        )

    return (
        _games(df, text)
        .select(
            F.col("g.gamePk").alias("game_pk"),
            F.col("block_date").try_cast("date").alias("game_date"),
            F.inline(F.array(side("away", "home", False), side("home", "away", True))),
        )
        .filter((F.col("team") != "") & F.col("pitcher").isNotNull())
        .select(
            "game_pk",
            "game_date",
            team_code(F.col("team"), LIVE).alias("team"),
            team_code(F.col("opponent"), LIVE).alias("opponent"),
            "is_home",
            F.col("pitcher.id").alias("pitcher_id"),
            F.col("pitcher.fullName").alias("pitcher_name"),
            F.lit("probable").alias("starter_status"),
            F.lit("mlb").alias("source"),
        )
        .distinct()
    )


def observation_rows(df: DataFrame, text: str) -> DataFrame:
    """Weather observations to typed station rows."""
    r = {f: F.col(f"r.{f}") for f in _OBSERVATION_FIELDS}

    def num(*names: str) -> Column:
        return number_text(F.coalesce(*[r[n] for n in names]))

    degrees = num("wdir", "windDir")
    out, inward, cross = wind_sectors(degrees)
    temp, dew = num("temp", "tempC"), num("dewp", "dewpoint")
    wind, gust = num("wspd", "windSpeed"), num("wgst", "windGust")
    observed = first_filled(r["obsTime"], r["observationTime"], r["observation_time"])
    return (
        parse(df, text, OBSERVATION_FEED)
        .select(F.explode("feed").alias("r"))
        .select(
            first_filled(r["icaoId"], r["station_id"], r["station"], r["id"]).alias("station_id"),
            F.try_to_timestamp(observed).alias("observed_at_utc"),
            first_filled(r["rawOb"], r["raw_text"], r["rawText"]).alias("raw_metar"),
            r["flight_category"].alias("flight_category"),
            first_filled(r["wxString"], r["wx"]).alias("weather_condition"),
            temp.alias("temperature_c"),
            fahrenheit(temp).alias("temperature_f"),
            dew.alias("dewpoint_c"),
            fahrenheit(dew).alias("dewpoint_f"),
            degrees.alias("wind_dir_degrees"),
            wind.alias("wind_speed_kt"),
            mph(wind).alias("wind_speed_mph"),
            gust.alias("wind_gust_kt"),
            mph(gust).alias("wind_gust_mph"),
            num("altim", "seaLevelPressure").alias("pressure_hpa"),
            num("visib", "visibility").alias("visibility_miles"),
            number_text(r["ceil"]).cast("bigint").alias("ceiling_ft"),
            F.lit(None).cast("double").alias("humidity"),
            F.lit(None).cast("double").alias("precipitation_mm"),
            out.alias("weather_wind_out"),
            inward.alias("weather_wind_in"),
            cross.alias("weather_crosswind"),
            F.lit("awc_metar").alias("weather_source"),
            F.current_timestamp().alias("weather_pull_ts"),
        )
    )
