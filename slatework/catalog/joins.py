"""Joins and identity resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.base import Tables, query, r
from slatework.functions.coerce import date_of
from slatework.functions.teams import LIVE, STATIONS, team_code
from slatework.functions.text import name_key, name_key_keep_suffix
from slatework.operators import asof, joins, resolve
from slatework.operators.quality import assert_unique
from slatework.plans import inputs, spine


@query(
    "j01_one_to_one",
    f"""select o_orderkey, o_custkey, n_lines, {r('quantity')} from orders left join (
    select l_orderkey, count(*) as n_lines, sum(l_quantity) as quantity from lineitem group by l_orderkey) on o_orderkey = l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    orders = t.orders.select("o_orderkey", "o_custkey")
    return joins.left_checked(orders, lines, ["o_orderkey"], "1:1")


@query(
    "j02_many_to_one",
    "select c_custkey, n_name, n_regionkey from customer left join nation on c_nationkey = n_nationkey",
)
def _(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return joins.left_checked(customers, t.nation, ["n_nationkey"], "m:1").drop("n_nationkey")


@query(
    "j03_composite_key_after_dedupe",
    """select l.l_orderkey, l.l_linenumber, l.l_partkey, d.p as last_part from lineitem l left join (
    select l_orderkey, l_linenumber, max(l_partkey) as p from lineitem group by all) d
    on l.l_orderkey = d.l_orderkey and l.l_linenumber = d.l_linenumber""",
)
def _(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    side = t.lineitem.select(*keys, F.col("l_partkey").alias("last_part"))
    return joins.left_last(t.lineitem.select(*keys, "l_partkey"), side, keys, ["last_part"])


def _events(t: Tables, kind: str) -> DataFrame:
    return t.events.filter(F.col("event_type") == kind)


@query(
    "j04_asof_strict",
    f"""select p.event_id, p.user_id, v.event_id as last_view, {r('v.value', 'last_value')}
    from (select * from events where event_type = 'purchase') p asof left join
    (select user_id, cast(ts as date) as day, max_by(event_id, ts) as event_id, max_by(value, ts) as value
     from events where event_type = 'view' group by all) v
    on p.user_id = v.user_id and cast(p.ts as date) > v.day""",
)
def _(t: Tables) -> DataFrame:
    left = _events(t, "purchase").select("event_id", "user_id", date_of(F.col("ts")).alias("day"))
    right = _events(t, "view").select(
        "user_id", date_of(F.col("ts")).alias("day"), "ts", F.col("event_id").alias("last_view"),
        F.col("value").alias("last_value"),
    )
    return asof.asof_join(left, right, "user_id", "day", ["last_view", "last_value"], tie=["ts"]).drop("day")


@query(
    "j04_asof_inclusive",
    """select p.event_id, v.event_id as last_view from (select * from events where event_type = 'purchase') p asof left join
    (select user_id, cast(ts as date) as day, max_by(event_id, ts) as event_id
     from events where event_type = 'view' group by all) v on p.user_id = v.user_id and cast(p.ts as date) >= v.day""",
)
def _(t: Tables) -> DataFrame:
    left = _events(t, "purchase").select("event_id", "user_id", date_of(F.col("ts")).alias("day"))
    right = _events(t, "view").select(
        "user_id", date_of(F.col("ts")).alias("day"), "ts", F.col("event_id").alias("last_view")
    )
    return asof.asof_join(
        left, right, "user_id", "day", ["last_view"], tie=["ts"], strict=False
    ).select("event_id", "last_view")


@query(
    "j05_latest_row_join",
    f"""select p.event_id, v.event_id as last_view, {r('v.value', 'last_value')} from (select * from events where event_type = 'purchase') p
    left join (select user_id, max_by(event_id, ts) as event_id, max_by(value, ts) as value from events
     where event_type = 'view' and cast(ts as date) <= date '2024-01-20' group by user_id) v on p.user_id = v.user_id""",
)
def _(t: Tables) -> DataFrame:
    right = _events(t, "view").select(
        F.col("user_id").alias("view_user"), "ts", date_of(F.col("ts")).alias("day"),
        F.col("event_id").alias("last_view"), F.col("value").alias("last_value"),
    )
    left = _events(t, "purchase").select("event_id", "user_id")
    return asof.latest_join(
        left, right, "user_id", "view_user", "day", ["last_view", "last_value"], ["ts"],
        F.lit("2024-01-20").cast("date"),
    ).drop("user_id")


@query(
    "j06_role_playing_dimension",
    """select game_pk, h.n_name as home_n_name, a.n_name as away_n_name from (
    select o_orderkey as game_pk, o_custkey % 25 as hk, o_orderkey % 25 as ak from orders)
    left join nation h on hk = h.n_nationkey left join nation a on ak = a.n_nationkey""",
)
def _(t: Tables) -> DataFrame:
    games = t.orders.select(
        F.col("o_orderkey").alias("game_pk"), (F.col("o_custkey") % 25).cast("int").alias("home_key"),
        (F.col("o_orderkey") % 25).cast("int").alias("away_key"),
    )
    names = t.nation.select(F.col("n_nationkey").alias("key"), "n_name")
    return joins.both_sides(games, names, {"home": "home_key", "away": "away_key"}, "key").drop(
        "home_key", "away_key"
    )


@query(
    "j07_conditional_side_key",
    """select l.game_pk, l.batting_order, l.is_home,
    case when l.is_home then away_starter_pitcher_id else home_starter_pitcher_id end as opp_pitcher_id, s_name
    from dt_lineups l left join dt_spine s on l.game_pk = s.game_pk
    left join supplier on s_suppkey = case when l.is_home then away_starter_pitcher_id else home_starter_pitcher_id end""",
)
def _(t: Tables) -> DataFrame:
    ids = t.dt_spine.select("game_pk", "home_starter_pitcher_id", "away_starter_pitcher_id")
    rows = t.dt_lineups.select("game_pk", "batting_order", "is_home").join(ids, "game_pk", "left")
    opposing = F.when(F.col("is_home"), F.col("away_starter_pitcher_id")).when(
        ~F.col("is_home"), F.col("home_starter_pitcher_id")
    )
    names = t.supplier.select(F.col("s_suppkey").alias("opp_pitcher_id"), "s_name")
    return rows.select("game_pk", "batting_order", "is_home", opposing.alias("opp_pitcher_id")).join(
        names, "opp_pitcher_id", "left"
    )


KEY_SQL = r"""nullif(trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim(name))),
 '\b(jr|sr|ii|iii|iv|v)\b\.?', '', 'g'), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')), '')"""
KEEP_SQL = r"""nullif(trim(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(trim(name)), '[^\x00-\x7F]', '', 'g')),
 '[^a-z0-9_\s]', ' ', 'g'), '\s+', ' ', 'g')), '')"""
KEYED = f"""select person_id, upper(team) as team, name, k, split_part(k, ' ', -1) as last_k,
 case when contains(k, ' ') then concat(k[1], ' ', split_part(k, ' ', -1)) end as init_k from (
 select *, {KEY_SQL} as k from dt_people)"""


def lookup_sql(key: str, source: str = "keyed", team: str = "team") -> str:
    return (
        f"select {key} as key, {team} as team, min(person_id) as id from {source} where {key} is not null"
        f" group by 1, 2 having min(person_id) = max(person_id)"
    )


def _tiers(tiers: list[tuple[str, str]], source: str, any_tier: bool) -> str:
    e, a, i, n = [f"({lookup_sql(k, source)})" for k in ("k", "k", "init_k", "last_k")]
    a = f"({lookup_sql('k', source, 'cast(null as varchar)')})"
    glob = f"left join {a} a on p.k = a.key" if any_tier else ""
    picks = [("e", tiers[0]), *([("a", tiers[1])] if any_tier else []), ("i", tiers[-2]), ("n", tiers[-1])]
    method = " ".join(f"when {al}.id is not null then '{label}'" for al, (_, label) in picks)
    ids = ", ".join(f"{al}.id" for al, _ in picks)
    return f"""select p.person_id as row_id, case when given is not null then given else coalesce({ids}) end as player_id,
    case when given is not null then 'unresolved' {method} else 'unresolved' end as method
    from (select *, case when person_id % 10 = 0 then person_id end as given from wanted) p
    left join {e} e on p.k = e.key and p.team is not distinct from e.team {glob}
    left join {i} i on p.init_k = i.key and p.team is not distinct from i.team
    left join {n} n on p.last_k = n.key and p.team is not distinct from n.team"""


# Rows to resolve: everybody, every third name reduced to its last word.
_WANTED = """wanted as (select person_id, team, k, last_k, init_k from keyed where person_id % 3 <> 0
 union all select person_id, team, last_k, last_k, null from keyed where person_id % 3 = 0)"""


def _wanted(t: Tables, key) -> DataFrame:
    people = t.dt_people.withColumn("_k", key(F.col("name")))
    name = F.when(F.col("person_id") % 3 != 0, F.col("name")).otherwise(F.element_at(F.split("_k", " "), -1))
    return people.select(
        F.col("person_id").alias("row_id"), "team", name.alias("player_name"),
        F.when(F.col("person_id") % 10 == 0, F.col("person_id").cast("double")).alias("player_id"),
    )


def _history(t: Tables) -> DataFrame:
    return t.dt_people.select(F.col("person_id").alias("player_id"), F.col("name").alias("player_name"), "team")


@query(
    "j08_tiered_resolution",
    f"with keyed as ({KEYED}), {_WANTED} " + _tiers(resolve.GENERAL_TIERS, "keyed", False),
)
def _(t: Tables) -> DataFrame:
    lookup = resolve.build_lookup([_history(t)], "player_id")
    rows = _wanted(t, name_key)
    return resolve.resolve_ids(
        rows, lookup, "player_name", "player_id", "method", resolve.GENERAL_TIERS, name_key(F.col("player_name"))
    ).select("row_id", "player_id", "method")


@query(
    "j09_tiered_resolution_global",
    f"with keyed as ({KEYED.replace(KEY_SQL, KEEP_SQL)}), {_WANTED} " + _tiers(resolve.STARTER_TIERS, "keyed", True),
)
def _(t: Tables) -> DataFrame:
    history = t.dt_people.select(
        F.col("person_id").alias("player_id"), "name", F.upper("team").alias("team")
    )
    tiers = [kind for kind, _ in resolve.STARTER_TIERS]
    lookup = resolve.key_rows(history, "player_id", name_key_keep_suffix(F.col("name")), tiers)
    rows = _wanted(t, name_key_keep_suffix)
    return resolve.resolve_ids(
        rows, lookup, "player_name", "player_id", "method", resolve.STARTER_TIERS,
        name_key_keep_suffix(F.col("player_name")),
    ).select("row_id", "player_id", "method")


_LIVE = """case {0} when 'AZ' then 'ARI' when 'ATH' then 'OAK' when 'CWS' then 'CHW' when 'KCR' then 'KC'
 when 'SDP' then 'SD' when 'SFG' then 'SF' when 'TBR' then 'TB' when 'WAS' then 'WSH' else {0} end"""
_SCHED = f"select game_pk, game_date, season, {_LIVE.format('team')} as team, {_LIVE.format('opponent')} as opponent, is_home from dt_sides"


@query(
    "j10_strongest_key_join",
    f"""with sched as ({_SCHED}) select l.player_name, l.batting_order, s.team, s.game_date, g.game_pk
    from (select *, {_LIVE.format('team')} as tm, {_LIVE.format('opponent')} as opp from dt_lineups) l
    join sched s on l.game_pk = s.game_pk and l.is_home = s.is_home
    left join sched g on g.game_date = l.game_date and g.team = l.tm and g.opponent = l.opp""",
)
def _(t: Tables) -> DataFrame:
    lineups = t.dt_lineups.select("player_name", "batting_order", "game_date", "team", "opponent")
    schedule = joins.schedule_teams(t.dt_games)
    provider = lineups.withColumns({c: team_code(F.col(c), LIVE) for c in ("team", "opponent")})
    return joins.strongest_key_join(provider, schedule).select(
        "player_name", "batting_order", "team", "game_date", "game_pk"
    )


@query(
    "j11_two_stage_enrichment",
    f"""with s as (select o_orderkey, o_custkey, cast(o_orderdate as date) as d, o_orderstatus as st from orders),
    strong as (select o_custkey, d, st, max(o_orderkey) as k from s group by all),
    weak as (select o_custkey, max(o_orderkey) as k from s group by all)
    select s.o_orderkey, coalesce(a.k, b.k) as matched, case when a.k is not null then 'strong' else 'weak' end as stage
    from (select o_orderkey, o_custkey, d, case when o_orderkey % 2 = 0 then st else 'X' end as st from s) s
    left join strong a on s.o_custkey = a.o_custkey and s.d = a.d and s.st = a.st left join weak b on s.o_custkey = b.o_custkey""",
)
def _(t: Tables) -> DataFrame:
    base = t.orders.select(
        "o_orderkey", "o_custkey", date_of(F.col("o_orderdate")).alias("d"), F.col("o_orderstatus").alias("st")
    )
    strong = base.groupBy("o_custkey", "d", "st").agg(F.max("o_orderkey").alias("matched"))
    weak = base.groupBy("o_custkey").agg(F.max("o_orderkey").alias("matched"))
    rows = base.withColumn("st", F.when(F.col("o_orderkey") % 2 == 0, F.col("st")).otherwise("X"))
    return joins.two_stage_join(
        rows, strong, ["o_custkey", "d", "st"], weak, ["o_custkey"], ["matched"], "stage"
    ).select("o_orderkey", "matched", "stage")


@query(
    "j12_two_source_fallback",
    f"""with ids as (select distinct user_id from events),
    a as (select user_id, max_by(value, ts) as v from events where event_type = 'signup' and cast(ts as date) < date '2024-01-04' group by user_id),
    b as (select user_id, max_by(value, ts) as v from events where event_type = 'view' and cast(ts as date) < date '2024-01-04' group by user_id)
    select ids.user_id, {r('case when a.user_id is not null then a.v else b.v end', 'value')},
    case when a.user_id is not null then 'rolling' when b.user_id is not null then 'mart_fallback' end as _source
    from ids left join a on ids.user_id = a.user_id left join b on ids.user_id = b.user_id""",
)
def _(t: Tables) -> DataFrame:
    dated = t.events.withColumn("day", date_of(F.col("ts")))
    kinds = [dated.filter(F.col("event_type") == k) for k in ("signup", "view")]
    ids = t.events.select("user_id").distinct()
    return asof.latest_with_fallback(
        ids, "user_id", kinds[0], kinds[1], "day", ["value"], ["ts"], F.lit("2024-01-04").cast("date")
    )


_SPINE_TEAM = _LIVE


def _summary(table: str, label: str) -> str:
    return f"""(select game_pk, {_SPINE_TEAM.format('team')} as tn, count(batting_order) as spots, count(distinct player_id) as players,
     min_by(player_name, batting_order) as first_batter from {table} group by all)"""


@query(
    "j13_spine_assembly",
    f"""select g.game_pk, cast(g.game_date as varchar) as game_date, g.home_team, g.away_team, {r('w.temperature_f', 'temperature_f')},
    {r('p.park_factor_hr', 'park_factor_hr')}, g.home_score, hp.spots as home_projected_lineup_spots, hp.players as home_projected_distinct_players,
    ac.first_batter as away_confirmed_first_batter, hs.pitcher_id as home_starter_pitcher_id, aw.pitcher_id as away_starter_pitcher_id,
    true as lineups_projected_both_found, true as starters_both_found
    from dt_games g left join dt_weather w on g.game_pk = w.game_pk left join dt_parks p on g.venue_id = p.venue_id
    left join {_summary('dt_projected', 'p')} hp on hp.game_pk = g.game_pk and hp.tn = {_SPINE_TEAM.format('g.home_team')}
    left join {_summary('dt_confirmed', 'c')} ac on ac.game_pk = g.game_pk and ac.tn = {_SPINE_TEAM.format('g.away_team')}
    left join dt_starters hs on hs.game_pk = g.game_pk and hs.is_home left join dt_starters aw on aw.game_pk = g.game_pk and not aw.is_home""",
)
def _(t: Tables) -> DataFrame:
    parks = t.dt_parks
    t.deal_games()
    out = spine.build_spine(
        t.dt_games, t.dt_games, t.dt_weather, parks, t.dt_projected, t.dt_confirmed, t.dt_starters
    )
    return out.select(
        "game_pk", "game_date", "home_team", "away_team", "temperature_f", "park_factor_hr", "home_score",
        "home_projected_lineup_spots", "home_projected_distinct_players", "away_confirmed_first_batter",
        "home_starter_pitcher_id", "away_starter_pitcher_id", "lineups_projected_both_found", "starters_both_found",
    )


_STATION = "case home_team " + " ".join(f"when '{k}' then '{v}'" for k, v in {**STATIONS, "COL": "K5280"}.items()) + " end"


@query(
    "j14_game_weather",
    f"""select g.game_pk, g.station_id, {r('o.t', 'temperature_f')}, cast(cast(floor(o.d) as int) as varchar) || '°' as wind_dir_text,
    case when g.home_team in ('AZ', 'HOU', 'MIA', 'MIL', 'SEA', 'TOR', 'TEX') then 'unknown_retractable' else 'open_air' end as roof_status
    from (select game_pk, home_team, {_STATION} as station_id, home_team as h from dt_games) g
    left join (select station_id, max_by(t, ts) as t, max_by(d, ts) as d from (
      select case user_id % 4 when 0 then 'KATL' when 1 then 'KBOS' when 2 then 'K5280' else 'KLGA' end as station_id, ts, value as t,
      value * 10 as d from events) group by station_id) o on o.station_id = g.station_id
    """,
)
def _(t: Tables) -> DataFrame:
    kind = F.col("user_id") % 4
    station = F.when(kind == 0, "KATL").when(kind == 1, "KBOS").when(kind == 2, "K5280").otherwise("KLGA")
    empty = F.lit(None).cast("double")
    names = [
        "temperature_c", "dewpoint_f", "dewpoint_c", "wind_speed_mph", "wind_speed_kt",
        "wind_gust_mph", "wind_gust_kt", "pressure_hpa", "visibility_miles", "humidity",
        "precipitation_mm", "weather_wind_out", "weather_wind_in", "weather_crosswind",
    ]
    texts = [
        "weather_condition", "flight_category", "raw_metar", "weather_source", "weather_pull_ts",
        "ceiling_ft",
    ]
    observed = t.events.select(
        station.alias("station_id"), F.col("ts").alias("observed_at_utc"), F.col("value").alias("temperature_f"),
        (F.col("value") * 10).alias("wind_dir_degrees"), *[empty.alias(n) for n in names],
        *[F.lit(None).cast("string").alias(n) for n in texts],
    )
    games = spine.game_weather(t.dt_games, observed, {"COL": "k5280"})
    return games.select("game_pk", "station_id", "temperature_f", "wind_dir_text", "roof_status")


@query(
    "q09_join_cardinality",
    "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1",
)
def _(t: Tables) -> DataFrame:
    from slatework.operators.quality import repeated_keys

    assert_unique(t.orders, ["o_orderkey"], "orders")
    return repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])
