"""Provider tables (lineups, starters, park factors) mapped to one shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import date_text, home_flag, int_of, null_of, num_of, text_of
from slatework.functions.teams import LIVE, PAGE, team_code
from slatework.operators.shape import pick, snake_columns

DATE_NAMES = ["Date", "date", "GameDate", "game_date"]


def _picked(df: DataFrame, names: list[str], read, dtype: str) -> Column:
    name = pick(df.columns, names)
    return read(df, name) if name else null_of(dtype)


def _text(df: DataFrame, *names: str) -> Column:
    return _picked(df, list(names), text_of, "string")


def _int(df: DataFrame, *names: str) -> Column:
    return _picked(df, list(names), int_of, "bigint")


def _num(df: DataFrame, *names: str) -> Column:
    return _picked(df, list(names), num_of, "double")


def tidy_frame(df: DataFrame) -> DataFrame:
    """Trimmed column names, no all-null rows, date columns as text dates."""
    out = df.toDF(*[c.strip() for c in df.columns]).dropna(how="all")
    return out.withColumns({c: date_text(F.col(c)) for c in DATE_NAMES if c in out.columns})


def tidy_pitches(df: DataFrame) -> DataFrame:
    """Pitch feed: date as text, ids as bigint."""
    casts = {c: int_of(df, c) for c in ("game_pk", "batter", "pitcher") if c in df.columns}
    if "game_date" in df.columns:
        casts["game_date"] = date_text(F.col("game_date"))
    return df.withColumns(casts)


def _page_side(df: DataFrame, record_type: str) -> DataFrame:
    out = snake_columns(df)
    if "record_type" in out.columns:
        out = out.filter(F.col("record_type") == record_type)
    return out


def page_lineups(table: DataFrame, status: str = "confirmed") -> DataFrame:
    """Lineup rows of a page table; rows without a name or team are dropped."""
    df = _page_side(table, "lineup")
    player = pick(df.columns, ["player", "name", "batter", "hitter"], required=True)
    team = pick(df.columns, ["team", "tm"], required=True)
    opponent = pick(df.columns, ["opp", "opponent"])
    home = pick(df.columns, ["is_home", "home_away", "location", "venue"])
    date = pick(df.columns, ["game_date", "date"])
    return (
        df.select(
            F.trim(text_of(df, player)).alias("player_name"),
            team_code(F.col(team), PAGE).alias("team"),
            (team_code(F.col(opponent), PAGE) if opponent else null_of("string")).alias("opponent"),
            _int(df, "order", "batting_order", "lineup_slot", "slot").alias("lineup_slot"),
            _int(df, "player_id", "mlbam_id", "mlb_id", "id").alias("player_id"),
            _int(df, "rotowire_id").alias("rotowire_id"),
            (home_flag(F.col(home)) if home else null_of("boolean")).alias("is_home"),
            (date_text(F.col(date)) if date else null_of("string")).alias("game_date"),
            _text(df, "handedness_bat").alias("handedness_bat"),
            _text(df, "position").alias("position"),
            F.lit(status).alias("lineup_status"),
            F.lit("rotowire").alias("source"),
            F.lit(", ".join(table.columns)).alias("source_columns"),
        )
        .dropna(subset=["player_name", "team"])
        .distinct()
    )


def page_starters(table: DataFrame, status: str = "probable") -> DataFrame:
    """Starter rows of a page table; rows without a name or team are dropped."""
    df = _page_side(table, "starter")
    pitcher = pick(df.columns, ["pitcher", "starter", "player", "name"], required=True)
    team = pick(df.columns, ["team", "tm"], required=True)
    opponent = pick(df.columns, ["opp", "opponent"])
    home = pick(df.columns, ["is_home", "home_away", "location", "venue"])
    date = pick(df.columns, ["game_date", "date"])
    return (
        df.select(
            F.trim(text_of(df, pitcher)).alias("pitcher_name"),
            team_code(F.col(team), PAGE).alias("team"),
            (team_code(F.col(opponent), PAGE) if opponent else null_of("string")).alias("opponent"),
            _int(df, "pitcher_id", "player_id", "mlbam_id", "mlb_id", "id").alias("pitcher_id"),
            _int(df, "rotowire_id").alias("rotowire_id"),
            (home_flag(F.col(home)) if home else null_of("boolean")).alias("is_home"),
            (date_text(F.col(date)) if date else null_of("string")).alias("game_date"),
            _text(df, "throws").alias("throws"),
            F.lit(status).alias("starter_status"),
            F.lit("rotowire").alias("source"),
            F.lit(", ".join(table.columns)).alias("source_columns"),
        )
        .dropna(subset=["pitcher_name", "team"])
        .distinct()
    )


def export_lineups(df: DataFrame) -> DataFrame:
    """Projected-lineup export to the shared shape."""
    date = pick(df.columns, DATE_NAMES)
    return df.select(
        (date_text(F.col(date)) if date else null_of("string")).alias("game_date"),
        _text(df, "Team", "team", "Tm").alias("team"),
        _text(df, "Opp", "Opponent", "opponent").alias("opponent"),
        _text(df, "Player", "Name", "player_name").alias("player_name"),
        _int(df, "Order", "BatOrder", "batting_order", "LineupOrder").alias("batting_order"),
        _text(df, "Bat", "Bats", "handedness_bat").alias("handedness_bat"),
        _text(df, "Pos", "Position", "position").alias("position"),
        F.lit("fangraphs").alias("source"),
    )


def export_park_factors(df: DataFrame) -> DataFrame:
    """Park-factor export to the shared shape."""
    return df.select(
        _text(df, "Team", "team", "Tm").alias("team"),
        _text(df, "Park", "venue_name", "Venue", "Stadium").alias("venue_name"),
        _num(df, "R", "Runs", "park_factor_runs").alias("park_factor_runs"),
        _num(df, "HR", "park_factor_hr").alias("park_factor_hr"),
        _num(df, "H", "Hits", "park_factor_hits").alias("park_factor_hits"),
        _num(df, "2B", "park_factor_2b").alias("park_factor_2b"),
        _num(df, "3B", "park_factor_3b").alias("park_factor_3b"),
        _num(df, "BB", "park_factor_bb").alias("park_factor_bb"),
        F.lit("fangraphs").alias("source"),
    )


def provider_rows(df: DataFrame, slate_date: str) -> DataFrame:
    """Team codes, slate date where a row has none, home token as a flag."""
    casts = {c: team_code(F.col(c), LIVE) for c in ("team", "opponent") if c in df.columns}
    date = date_text(F.col("game_date")) if "game_date" in df.columns else null_of("string")
    casts["game_date"] = F.coalesce(date, F.lit(slate_date))
    if "is_home" in df.columns:
        casts["is_home"] = home_flag(F.col("is_home"))
    return df.withColumns(casts)


