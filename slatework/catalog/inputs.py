"""Sources and sinks."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.base import Tables, query, r
from slatework.functions.coerce import date_of
from slatework.session import stage_path
from slatework.sources import datasets, feeds, pages, providers, snapshots


@query("io01_parquet_scan", "select l_orderkey, l_partkey, l_quantity from lineitem")
def _(t: Tables) -> DataFrame:
    return datasets.read_parquet(
        t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"]
    )


@query(
    "io02_parquet_write",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority from orders",
)
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "orders")
    datasets.write_parquet(t.orders.drop("o_orderdate"), path)
    return datasets.read_parquet(t.spark, path)


@query("io03_csv_read", "select n_nationkey, n_name, n_regionkey from nation")
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "nation")
    t.nation.write.csv(path, header=True)
    return datasets.read_csv(t.spark, path, t.nation.schema)


@query("io04_csv_write", "select s_suppkey, s_name, s_nationkey, s_acctbal + 0.0 as s_acctbal from supplier")
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "supplier")
    datasets.write_csv(t.supplier, path)
    return datasets.read_csv(t.spark, path, t.supplier.schema)


@query(
    "io05_dataset_formats",
    """select r_regionkey, r_name, 'parquet' as file_format from region
    union all select r_regionkey, r_name, 'csv' as file_format from region""",
)
def _(t: Tables) -> DataFrame:
    root = stage_path(t.spark, "region")
    parts = []
    for name in ("parquet", "csv"):
        path = f"{root}.{name}"
        datasets.write_dataset(t.region, path)
        back = datasets.read_dataset(t.spark, path, schema=t.region.schema)
        parts.append(back.withColumn("file_format", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query("io06_optional_source", "select r_regionkey, r_name from region")
def _(t: Tables) -> DataFrame:
    schema = t.region.schema
    absent = datasets.read_if_exists(t.spark, stage_path(t.spark, "absent"), schema)
    return datasets.read_if_exists(t.spark, f"{t.sf_dir}/region.parquet", schema).unionByName(absent)


@query(
    "io07_partitioned_output",
    "select season, count(*) as n_games, sum(home_score) as runs from dt_games group by season",
)
def _(t: Tables) -> DataFrame:
    path = stage_path(t.spark, "mart")
    datasets.write_partitioned(t.dt_games, path, ["season"])
    datasets.write_partitioned(t.dt_games, path, ["season"], overwrite=True)
    back = t.spark.read.parquet(path).withColumn("season", F.col("season").cast("bigint"))
    return back.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_games"), F.sum(F.col("home_score").cast("bigint")).alias("runs")
    )


@query(
    "io08_latest_slice",
    """select o_orderkey, o_custkey from orders
    where cast(o_orderdate as date) = (select max(cast(o_orderdate as date)) from orders)""",
)
def _(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("day", date_of(F.col("o_orderdate")))
    return datasets.latest_slice(dated, "day").select("o_orderkey", "o_custkey")


@query(
    "io08_snapshots",
    """select case when year(o_orderdate) = 1997 then 'latest' else 'older' end as snapshot, o_orderkey, o_custkey from orders
    where year(o_orderdate) in (1996, 1997)""",
)
def _(t: Tables) -> DataFrame:
    """Two dated snapshots; the pointer outlives a write that fails."""
    root = stage_path(t.spark, "snapshots")
    dated = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    for season in (1996, 1997):
        snapshots.publish(dated.filter(F.col("season") == season), root, str(season))
    try:
        snapshots.publish(dated.select(F.raise_error(F.lit("no feed")).cast("bigint").alias("o_orderkey")), root, "1998")
    except PySparkException:
        pass
    latest = snapshots.read_snapshot(t.spark, root)
    older = snapshots.read_snapshot(t.spark, root, "1996")
    both = latest.withColumn("snapshot", F.lit("latest")).unionByName(older.withColumn("snapshot", F.lit("older")))
    return both.select("snapshot", "o_orderkey", "o_custkey")


def _team(side: str):
    return F.struct(
        F.col(f"{side}_score").cast("bigint").alias("score"),
        F.struct(
            F.col("venue_id").alias("id"),
            F.col(f"{side}_team").alias("abbreviation"),
            F.concat(F.lit("Team "), F.col(f"{side}_team")).alias("name"),
        ).alias("team"),
        F.when(
            F.col("game_pk") % 17 != 0,
            F.struct((F.col("game_pk") % 100).alias("id"), F.lit(f"{side} arm").alias("fullName")),
        ).alias("probablePitcher"),
    ).alias(side)


def _game_feed(t: Tables) -> DataFrame:
    """One feed document per game, as a live pull would land it."""
    game = F.struct(
        F.col("game_pk").alias("gamePk"),
        F.concat(F.col("game_date").cast("string"), F.lit("T23:05:00Z")).alias("gameDate"),
        F.when(F.col("game_pk") % 3 == 0, F.date_add("game_date", 1).cast("string")).alias("officialDate"),
        F.struct(
            F.col("status").alias("abstractGameState"), F.lit("d").alias("detailedState")
        ).alias("status"),
        F.struct(_team("away"), _team("home")).alias("teams"),
        F.struct(F.col("venue_id").alias("id"), F.lit("Park").alias("name")).alias("venue"),
        F.when(F.col("game_pk") % 2 == 0, "y").otherwise("N").alias("doubleHeader"),
        F.when(F.col("game_pk") % 5 != 0, F.lit("N")).alias("ifNecessary"),
        F.when(F.col("game_pk") % 7 == 0, F.lit(False)).alias("publicFacing"),
        F.struct(
            (F.col("game_pk") % 10).alias("currentInning"), F.lit(9).alias("scheduledInnings")
        ).alias("linescore"),
    )
    block = F.struct(F.col("game_date").cast("string").alias("date"), F.array(game).alias("games"))
    return t.dt_games.select("season", F.to_json(F.struct(F.array(block).alias("dates"))).alias("body"))


# Offset of New York in the years of the data: summer time from the first Sunday
# of April to the last Sunday of October, changing in the night before.
_SUMMER = """case when game_date >= make_date(year(game_date), 4, 1)
 + cast((7 - dayofweek(make_date(year(game_date), 4, 1))) % 7 as int)
 and game_date < make_date(year(game_date), 10, 31)
 - cast(dayofweek(make_date(year(game_date), 10, 31)) as int) then true else false end"""
_ET = f"case when {_SUMMER} then 'T19:05:00-04:00' else 'T18:05:00-05:00' end"


@query(
    "io09_schedule_feed",
    f"""select game_pk, cast(game_date as varchar) as game_date, season, status, away_team, home_team,
    concat('Team ', home_team) as home_team_name, venue_id, game_pk % 2 = 0 as doubleheader_flag,
    game_pk % 5 <> 0 as if_necessary, game_pk % 7 <> 0 as public_facing,
    concat(cast(game_date as varchar), 'T23:05:00+00:00') as scheduled_start_time_utc,
    concat(cast(game_date as varchar), {_ET}) as scheduled_start_time_et from dt_games""",
)
def _(t: Tables) -> DataFrame:
    return _with_season(feeds.schedule_rows, t).select(
        "game_pk", "game_date", "season", "status", "away_team", "home_team", "home_team_name",
        "venue_id", "doubleheader_flag", "if_necessary", "public_facing",
        "scheduled_start_time_utc", "scheduled_start_time_et",
    )


def _with_season(flatten, t: Tables) -> DataFrame:
    """Flatten each feed; here the season is that of the block date."""
    return flatten(_game_feed(t), "body", F.year(F.col("block_date").try_cast("date")))


@query(
    "io10_game_feed",
    """select game_pk, cast(case when game_pk % 3 = 0 then game_date + 1 else game_date end as varchar) as game_date,
    season, home_score, away_score,
    case when home_score > away_score then true when home_score < away_score then false end as home_win,
    case when home_score > away_score then home_team when home_score < away_score then away_team end as winning_team,
    case when home_score > away_score then away_team when home_score < away_score then home_team end as losing_team,
    case when game_pk % 10 = 0 then 9 else game_pk % 10 end as innings, cast(9 as bigint) as scheduled_innings
    from dt_games""",
)
def _(t: Tables) -> DataFrame:
    return _with_season(feeds.game_rows, t).select(
        "game_pk", "game_date", "season", "home_score", "away_score", "home_win", "winning_team",
        "losing_team", "innings", "scheduled_innings",
    )


def _play_feed(t: Tables) -> DataFrame:
    """One feed document per game; its plays are its line items, a bounded list."""
    play = F.struct(
        F.struct(
            F.struct(F.col("batter_id").alias("id"), F.col("batter_name").alias("fullName")).alias("batter"),
            F.struct(F.col("pitcher_id").alias("id"), F.col("pitcher_name").alias("fullName")).alias("pitcher"),
        ).alias("matchup"),
        F.struct(F.col("event_type").alias("eventType"), F.col("rbi").alias("rbi")).alias("result"),
        F.struct(F.col("inning").alias("inning"), F.col("inning_topbot").alias("halfInning")).alias("about"),
    )
    plays = F.transform(F.array_sort(F.collect_list(F.struct("pa_index", play.alias("p")))), lambda x: x["p"])
    return t.dt_pa.groupBy("game_pk", "game_date").agg(plays.alias("plays")).select(
        F.to_json(
            F.struct(
                F.col("game_pk").alias("gamePk"),
                F.struct(
                    F.struct(F.col("game_date").cast("string").alias("officialDate")).alias("datetime")
                ).alias("gameData"),
                F.struct(F.struct(F.col("plays").alias("allPlays")).alias("plays")).alias("liveData"),
            )
        ).alias("body")
    )


@query(
    "io11_play_feed",
    """select game_pk, cast(game_date as varchar) as game_date, pa_index - 1 as pa_index, inning, inning_topbot,
    batter_id, batter_name, pitcher_id, pitcher_name, event_type, cast(null as varchar) as event_text, rbi
    from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    return feeds.play_rows(_play_feed(t), "body")


@query(
    "io12_venue_feed",
    f"""select venue_id, venue_name, team as city, {r('park_factor_hr', 'latitude')}, roof_type from dt_parks""",
)
def _(t: Tables) -> DataFrame:
    venue = F.struct(
        F.col("venue_id").alias("id"),
        F.col("venue_name").alias("name"),
        F.struct(F.col("team").alias("city"), F.col("park_factor_hr").alias("latitude")).alias("location"),
        F.col("roof_type").alias("roofType"),
    )
    body = t.dt_parks.select(F.to_json(F.struct(F.array(venue).alias("venues"))).alias("body"))
    return feeds.venue_rows(body, "body").select("venue_id", "venue_name", "city", "latitude", "roof_type")


_LIVE = """case {0} when 'AZ' then 'ARI' when 'ATH' then 'OAK' when 'CWS' then 'CHW' when 'KCR' then 'KC'
 when 'SDP' then 'SD' when 'SFG' then 'SF' when 'TBR' then 'TB' when 'WAS' then 'WSH' else {0} end"""


@query(
    "io13_probable_starters",
    f"""select game_pk, game_date, {_LIVE.format('team')} as team, {_LIVE.format('opponent')} as opponent, is_home,
    game_pk % 100 as pitcher_id, case when is_home then 'home arm' else 'away arm' end as pitcher_name
    from dt_sides where game_pk % 17 <> 0""",
)
def _(t: Tables) -> DataFrame:
    return feeds.probable_starter_rows(_game_feed(t), "body").select(
        "game_pk", "game_date", "team", "opponent", "is_home", "pitcher_id", "pitcher_name"
    )


@query(
    "io14_weather_observations",
    f"""select concat('K', cast(game_pk as varchar)) as station_id, {r('temperature_f', 'temperature_c')},
    {r('temperature_f * 9.0 / 5.0 + 32.0', 'temperature_f')}, {r('wind_mph', 'wind_speed_kt')},
    {r('wind_mph * 1.15078', 'wind_speed_mph')}, {r('wind_direction_deg', 'wind_dir_degrees')},
    case when wind_direction_deg >= 315 or wind_direction_deg <= 45 then 1.0::double else 0.0 end as weather_wind_out,
    case when wind_direction_deg between 135 and 225 then 1.0::double else 0.0 end as weather_wind_in,
    game_pk % 5000 as ceiling_ft from dt_weather""",
)
def _(t: Tables) -> DataFrame:
    record = F.struct(
        F.when(F.col("game_pk") % 2 == 0, F.concat(F.lit("K"), "game_pk")).alias("icaoId"),
        F.when(F.col("game_pk") % 2 == 1, F.concat(F.lit("K"), "game_pk")).alias("station"),
        F.col("temperature_f").alias("temp"),
        F.when(F.col("wind_direction_deg").isNull(), "VRB")
        .otherwise(F.col("wind_direction_deg").cast("string"))
        .alias("wdir"),
        F.when(F.col("game_pk") % 3 == 0, F.col("wind_mph")).alias("wspd"),
        F.when(F.col("game_pk") % 3 != 0, F.col("wind_mph").cast("string")).alias("windSpeed"),
        (F.col("game_pk") % 5000).alias("ceil"),
    )
    body = t.dt_weather.select(F.to_json(F.array(record)).alias("body"))
    return feeds.observation_rows(body, "body").select(
        "station_id", "temperature_c", "temperature_f", "wind_speed_kt", "wind_speed_mph",
        "wind_dir_degrees", "weather_wind_out", "weather_wind_in", "ceiling_ft",
    )


_TOKENS = r"""select page_id, unnest(t) as token, cast(generate_subscripts(t, 1) - 1 as bigint) as pos from (
 select page_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '<!--(?:.|\n)*?-->', chr(1), 'g'), '<script[^>]*>(?:.|\n)*?</script\s*>', chr(1), 'g'),
  '<style[^>]*>(?:.|\n)*?</style\s*>', chr(1), 'g'), '<[^>]*>', chr(1), 'g'), chr(1)),
  lambda x: trim(regexp_replace(replace(replace(replace(x, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;?', '&', 'g'), ' ' || chr(10))),
  lambda x: x <> '') as t from pages)"""


@query("io15_page_tokens", _TOKENS)
def _(t: Tables) -> DataFrame:
    return pages.token_rows(t.pages, "page_id", "html")


@query(
    "io15_lineup_cards",
    f"""select game_pk, {_LIVE.format('team')} as team, {_LIVE.format('opponent')} as opponent, is_home, 'lineup' as record_type,
    player_name as player, batting_order as "order", 'CF' as position,
    case when player_id % 2 = 0 then 'R' end as hand, 'confirmed' as status from dt_lineups
    union all
    select game_pk, {_LIVE.format('team')}, {_LIVE.format('opponent')}, is_home, 'starter', pitcher_name, null, null, throws, 'probable'
    from dt_starters""",
)
def _(t: Tables) -> DataFrame:
    """Cards rendered from lineups and starters, then read back."""
    player = F.concat(
        F.lit("<li>cf</li><a>"), "player_name", F.lit("</a>"),
        F.when(F.col("player_id") % 2 == 0, "<i>r</i>").otherwise("<i>-</i>"),
    )
    teams = t.dt_lineups.groupBy("game_pk", "team").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("batting_order", player.alias("h")))), lambda x: x["h"]
            ),
            "",
        ).alias("list")
    )
    # Merged, not broadcast: the planner takes a rendered list for no larger than the schedule's file.
    sides = t.dt_starters.join(teams.hint("merge"), ["game_pk", "team"]).withColumn(
        "h",
        F.concat(
            F.lit("<p>"), "pitcher_name", F.lit("</p><b>"), "throws",
            F.lit("</b><u>1-0 2.5 ERA</u><h2>Confirmed  Lineup</h2>"), "list",
        ),
    )
    games = (
        t.dt_games.select("game_pk", "away_team", "home_team")
        .join(sides.select("game_pk", F.col("team").alias("away_team"), F.col("h").alias("away")).hint("merge"), ["game_pk", "away_team"])
        .join(sides.select("game_pk", F.col("team").alias("home_team"), F.col("h").alias("home")).hint("merge"), ["game_pk", "home_team"])
    )
    html = F.concat(
        F.lit("<title>Starting MLB lineups for May 1, 2001</title><div>7:05 PM ET</div><div>"),
        "away_team", F.lit("</div><div>"), "home_team", F.lit("</div>"), "away", "home",
        F.lit("<div>Home Run Odds</div><li>C</li><a>nobody</a>"),
    )
    cards = pages.card_rows(games.select("game_pk", html.alias("html")), "game_pk", "html")
    return cards.drop("game_date")


@query(
    "io16_link_ids",
    r"""select page_id, name, max_by(link_id, pos) as link_id from (
     select page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">', 1)) as name,
      page_id * 10 + len(unnest(regexp_extract_all(html, '<a href="/([^"]*)">', 1))) as link_id,
      generate_subscripts(regexp_extract_all(html, '<a href="/([^"]*)">', 1), 1) as pos from pages)
    group by page_id, name""",
)
def _(t: Tables) -> DataFrame:
    """Links renamed to player addresses whose number is page * 10 + length of the text."""
    names = F.regexp_extract_all("html", F.lit('<a href="/([^"]*)">'), F.lit(1))
    links = F.transform(
        names,
        lambda n: F.concat(
            F.lit('<a class=x href="/baseball/player/x-'),
            (F.col("page_id") * 10 + F.length(n)).cast("string"),
            F.lit('"> <b>'), n, F.lit("</b></a>"),
        ),
    )
    return pages.link_ids(t.pages.select("page_id", F.concat_ws("\n", links).alias("html")), "page_id", "html")


@query(
    "io17_provider_lineups",
    f"""select distinct trim(player_name) as player_name, {_LIVE.format('team')} as team, {_LIVE.format('opponent')} as opponent,
    batting_order as lineup_slot, player_id, is_home, cast(game_date as varchar) as game_date, 'confirmed' as lineup_status
    from dt_lineups where player_id % 50 <> 7""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_lineups.select(
        F.when(F.col("player_id") % 50 != 7, F.concat(F.lit(" "), "player_name")).alias("Player"),
        F.concat(F.lower("team"), F.lit(" ")).alias("Tm"),
        F.col("opponent").alias("Opp"),
        F.col("batting_order").cast("string").alias("Order"),
        F.col("player_id").cast("double").alias("MLB ID"),
        F.when(F.col("is_home"), "Home").otherwise("@").alias("Home/Away"),
        F.col("game_date").alias("Date"),
    )
    return providers.page_lineups(raw).select(
        "player_name", "team", "opponent", "lineup_slot", "player_id", "is_home", "game_date", "lineup_status"
    )


@query(
    "io17_export_lineups",
    """select cast(game_date as varchar) as game_date, team, opponent, player_name, batting_order,
    case when player_id % 2 = 0 then 'L' end as handedness_bat, 'CF' as position, 'fangraphs' as source from dt_projected""",
)
def _(t: Tables) -> DataFrame:
    """Projected lineups as an export has them: its own names, slashed dates, text numbers."""
    raw = t.dt_projected.select(
        F.date_format("game_date", "M/d/yyyy").alias("Date"),
        F.col("team").alias("Team"),
        F.col("opponent").alias("Opp"),
        F.col("player_name").alias("Name"),
        F.col("batting_order").cast("string").alias("BatOrder"),
        F.when(F.col("player_id") % 2 == 0, "L").alias("Bats"),
        F.lit("CF").alias("Pos"),
    )
    return providers.export_lineups(raw)


@query(
    "io18_provider_starters",
    f"""select distinct pitcher_name, {_LIVE.format('team')} as team, {_LIVE.format('opponent')} as opponent, pitcher_id,
    is_home, cast(game_date as varchar) as game_date, throws, 'probable' as starter_status, 'rotowire' as source
    from dt_starters""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_starters.select(
        F.col("pitcher_name").alias("Pitcher"), F.col("team").alias("Team"), F.col("opponent").alias("Opp"),
        F.col("pitcher_id").cast("string").alias("Player ID"), F.col("is_home").alias("Is Home"),
        F.col("game_date").alias("Game Date"), F.col("throws").alias("Throws"),
    )
    return providers.page_starters(raw).drop("rotowire_id", "source_columns")


@query(
    "io19_provider_park_factors",
    f"""select team, venue_name, {r('park_factor_hr')}, cast(null as double) as park_factor_runs,
    cast(null as double) as park_factor_hits, {r('park_factor_hr / 2', 'park_factor_2b')},
    cast(null as double) as park_factor_3b, cast(null as double) as park_factor_bb, 'fangraphs' as source
    from dt_parks""",
)
def _(t: Tables) -> DataFrame:
    return providers.export_park_factors(
        t.dt_parks.select(
            F.col("team").alias("Team"), F.col("venue_name").alias("Park"),
            F.col("park_factor_hr").cast("string").alias("HR"), (F.col("park_factor_hr") / 2).alias("2B"),
        )
    )


@query(
    "io20_tidy_frames",
    """select c_custkey as "Player Key", c_name as "Name",
    case when c_custkey % 3 = 0 then null else '2024-01-05' end as "Date" from customer""",
)
def _(t: Tables) -> DataFrame:
    blank = F.lit(None)
    raw = t.customer.select(
        F.col("c_custkey").alias(" Player Key "),
        F.col("c_name").alias("Name "),
        F.when(F.col("c_custkey") % 3 == 0, "soon").otherwise("2024-01-05 10:00:00").alias("Date"),
    )
    empty = t.nation.select(
        blank.cast("bigint").alias(" Player Key "), blank.cast("string").alias("Name "), blank.cast("string").alias("Date")
    )
    return providers.tidy_frame(raw.unionByName(empty))


@query(
    "io20_tidy_pitches",
    """select o_orderkey as game_pk, case when o_custkey % 2 = 0 then o_custkey end as batter,
    cast(cast(o_orderdate as date) as varchar) as game_date from orders""",
)
def _(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("game_pk"),
        (F.col("o_custkey") + F.when(F.col("o_custkey") % 2 == 0, 0.0).otherwise(0.5)).alias("batter"),
        F.col("o_orderdate").cast("string").alias("game_date"),
    )
    return providers.tidy_pitches(raw)
