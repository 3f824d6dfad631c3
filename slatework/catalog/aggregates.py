"""Aggregations and data-quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.base import Tables, query, r
from slatework.functions.coerce import date_of
from slatework.operators import quality, resolve, shape, slates
from slatework.operators.rolling import rolling
from slatework.plans import features, gametables, inputs, spine
from slatework.session import stage
from slatework.sources.contracts import Contract, conform


def _div(num: str, den: str) -> str:
    return f"{num} / nullif({den}, 0)"


_FLAG = "cast({0} as bigint)"
_TB = "cast(is_1b as bigint) + 2 * cast(is_2b as bigint) + 3 * cast(is_3b as bigint) + 4 * cast(is_hr as bigint)"
_CONTACT = """select *, cast(coalesce(launch_speed >= 98 and launch_angle between 26 and 30, false) as bigint) as is_barrel,
 cast(coalesce(launch_speed >= 95, false) as bigint) as is_hard_hit from dt_flags"""


def _sum(flag: str, name: str) -> str:
    return f"cast(sum(cast({flag} as bigint)) as bigint) as {name}"


BATTER_COUNT = f"""select game_pk, game_date, batter_id, max(batter_name) as batter_name, count(batter_id) as pa,
 {_sum('is_hit', 'hits')}, {_sum('is_hr', 'hr')}, {_sum('is_rbi', 'rbi')}, {_sum(_TB, 'tb')},
 avg(coalesce(launch_speed, 0)) as ev_mean, max(coalesce(launch_speed, 0)) as ev_max, avg(coalesce(launch_angle, 0)) as la_mean,
 {_sum('is_barrel', 'barrels')}, {_sum('is_hard_hit', 'hardhit')}, {_sum('is_bb', 'bb')}, {_sum('is_so', 'so')}
 from ({_CONTACT}) group by game_pk, game_date, batter_id"""
PITCHER_COUNT = f"""select game_pk, game_date, pitcher_id, max(pitcher_name) as pitcher_name, count(pitcher_id) as bf,
 {_sum('is_hit', 'hits_allowed')}, {_sum('is_hr', 'hr_allowed')}, {_sum('is_bb', 'bb')}, {_sum('is_so', 'so')},
 avg(coalesce(launch_speed, 0)) as ev_mean, max(coalesce(launch_speed, 0)) as ev_max,
 {_sum('is_barrel', 'barrels')}, {_sum('is_hard_hit', 'hardhit')}
 from ({_CONTACT}) group by game_pk, game_date, pitcher_id"""
BATTER_CONTACT = f"""select *, barrels / pa as barrel_rate, hardhit / pa as hardhit_rate, so / pa as k_rate, bb / pa as bb_rate,
 ev_mean as avg_ev, la_mean as avg_la, hardhit / pa as hard_hit_rate, (tb - hits) / pa as iso, hr / pa as hr_per_pa, tb / pa as tb_per_pa,
 cast(null as double) as fb_rate, cast(null as double) as pulled_air_rate from (
 select game_pk, game_date, batter_id, batter_name, team, count(*) as pa, {_sum('is_hit', 'hits')}, {_sum('is_hr', 'hr')},
 {_sum('is_rbi', 'rbi')}, {_sum(_TB, 'tb')}, avg(launch_speed) as ev_mean, max(launch_speed) as ev_max, avg(launch_angle) as la_mean,
 {_sum('is_barrel', 'barrels')}, {_sum('is_hard_hit', 'hardhit')}, {_sum('is_bb', 'bb')}, {_sum('is_so', 'so')}
 from (select *, case batting_team when 'AZ' then 'ARI' when 'WAS' then 'WSN' else batting_team end as team from ({_CONTACT})) group by all)"""
PITCHER_CONTACT = f"""select *, bb_allowed / batters_faced as bb_rate, so / batters_faced as k_rate, barrels_allowed / batters_faced as barrel_rate,
 hardhit_allowed / batters_faced as hard_hit_rate, hr_allowed / batters_faced as hr_per_bf, hr_allowed / batters_faced * 27.0 as hr9 from (
 select game_pk, game_date, pitcher_id, pitcher_name, '' as team, count(*) as batters_faced, {_sum('is_bb', 'bb_allowed')}, {_sum('is_so', 'so')},
 {_sum('is_hr', 'hr_allowed')}, {_sum('is_barrel', 'barrels_allowed')}, {_sum('is_hard_hit', 'hardhit_allowed')} from ({_CONTACT}) group by all)"""
_SUMS_B = {
    "pa": "is_pa", "ab": "is_ab", "hits": "is_hit", "singles": "is_1b", "doubles": "is_2b", "triples": "is_3b",
    "hr": "is_hr", "bb": "is_bb", "hbp": "is_hbp", "so": "is_so", "sac_fly": "is_sac_fly", "roe": "is_reached_on_error",
}
BATTER_FLAGS = f"""select season, game_date, game_pk, batter_id, batter_name, {', '.join(_sum(f, n) for n, f in _SUMS_B.items())},
 cast(sum(rbi) as double) as rbi, {_sum(_TB, 'tb')}, cast(sum(runs_scored_on_pa) as double) as runs_scored,
 count(distinct pitcher_id) as pitcher_id_nunique from dt_flags group by all"""
_SUMS_P = {
    "batters_faced": "is_pa", "ab_allowed": "is_ab", "hits_allowed": "is_hit", "singles_allowed": "is_1b",
    "doubles_allowed": "is_2b", "triples_allowed": "is_3b", "hr_allowed": "is_hr", "bb_allowed": "is_bb",
    "hbp_allowed": "is_hbp", "so": "is_so",
}
PITCHER_FLAGS = f"""select season, game_date, game_pk, pitcher_id, pitcher_name, {', '.join(_sum(f, n) for n, f in _SUMS_P.items())},
 cast(sum(rbi) as double) as rbi_allowed, {_sum(_TB, 'tb_allowed')}, cast(sum(runs_scored_on_pa) as double) as runs_allowed,
 count(distinct batter_id) as batter_id_nunique from dt_flags group by all"""


def contact_flags(t: Tables) -> DataFrame:
    """Plate appearances with given barrel and hard-hit flags."""
    speed, angle = F.col("launch_speed"), F.col("launch_angle")
    return t.dt_flags.withColumns(
        {
            "is_barrel": F.coalesce((speed >= 98) & angle.between(26, 30), F.lit(False)),
            "is_hard_hit": F.coalesce(speed >= 95, F.lit(False)),
        }
    )


@query(
    "a01_batter_game_count",
    f"""select game_pk, game_date, batter_id, batter_name, pa, hits, hr, rbi, {r('tb')} , {r('ev_mean')}, {r('ev_max')}, {r('la_mean')},
    barrels, hardhit, bb, so, {r('barrels / pa', 'barrel_rate')}, {r('hardhit / pa', 'hardhit_rate')}, {r('so / pa', 'k_rate')}, {r('bb / pa', 'bb_rate')}
    from ({BATTER_COUNT})""".replace(r("tb"), "tb"),
)
def _(t: Tables) -> DataFrame:
    return gametables.batter_game(contact_flags(t))


@query(
    "a02_pitcher_game_count",
    f"""select game_pk, game_date, pitcher_id, pitcher_name, bf, hits_allowed, hr_allowed, bb, so, {r('ev_mean')}, {r('ev_max')}, barrels, hardhit,
    {r('barrels / bf', 'barrel_rate_allowed')}, {r('hardhit / bf', 'hardhit_rate_allowed')}, {r('so / bf', 'k_rate')}, {r('bb / bf', 'bb_rate')}
    from ({PITCHER_COUNT})""",
)
def _(t: Tables) -> DataFrame:
    return gametables.pitcher_game(contact_flags(t))


_B_RATES = [
    "ev_mean", "ev_max", "la_mean", "barrel_rate", "hardhit_rate", "k_rate", "bb_rate", "avg_ev",
    "avg_la", "hard_hit_rate", "iso", "hr_per_pa", "tb_per_pa",
]


@query(
    "a03_batter_game_contact",
    f"""select game_pk, game_date, batter_id, batter_name, team, pa, hits, hr, rbi, tb, barrels, hardhit, bb, so, fb_rate, pulled_air_rate,
    {', '.join(r(c) for c in _B_RATES)} from ({BATTER_CONTACT})""",
)
def _(t: Tables) -> DataFrame:
    return gametables.batter_contact_game(t.dt_flags)


@query(
    "a04_pitcher_game_contact",
    f"""select game_pk, game_date, pitcher_id, pitcher_name, team, batters_faced, bb_allowed, so, hr_allowed, barrels_allowed, hardhit_allowed,
    {', '.join(r(c) for c in [
        "bb_rate", "k_rate", "barrel_rate", "hard_hit_rate", "hr_per_bf", "hr9",
    ])} from ({PITCHER_CONTACT})""",
)
def _(t: Tables) -> DataFrame:
    return gametables.pitcher_contact_game(t.dt_flags)


@query(
    "a05_batter_game_flags",
    f"""select *, (hits > 0)::bigint as hit_1_plus, (tb >= 2)::bigint as tb_2_plus, (hr > 0)::bigint as hr_1_plus, (rbi > 0)::bigint as rbi_1_plus
    from ({BATTER_FLAGS})""",
)
def _(t: Tables) -> DataFrame:
    return gametables.batter_flag_game(t.dt_flags)


@query("a06_pitcher_game_flags", PITCHER_FLAGS)
def _(t: Tables) -> DataFrame:
    return gametables.pitcher_flag_game(t.dt_flags)


CONTACT_DAY = f"""select game_date, batter_id, avg(launch_speed) as launch_speed_sc, avg(launch_angle) as launch_angle_sc,
 min_by(bb_type, (game_pk, pa_index)) filter (bb_type is not null) as bb_type_sc, min_by(event_type, (game_pk, pa_index)) as sc_events,
 cast(sum(is_barrel) as bigint) as barrels_sc, cast(sum(is_hard_hit) as bigint) as hard_hit_sc, count(launch_speed) as bbe_sc
 from (select *, case when launch_angle > 20 then 'fly' when launch_angle is not null then 'ground' end as bb_type from ({_CONTACT}))
 group by game_date, batter_id"""


def contact_day(t: Tables) -> DataFrame:
    angle = F.col("launch_angle")
    pitches = t.dt_pa.select(
        "game_date", F.col("batter_id").alias("batter"), "game_pk", "pa_index", "launch_speed", "launch_angle",
        F.when(angle > 20, "fly").when(angle.isNotNull(), "ground").alias("bb_type"), F.col("event_type").alias("events"),
    )
    return gametables.contact_day(pitches, ["game_pk", "pa_index"])


@query(
    "a07_entity_day_contact",
    f"""select game_date, batter_id, {r('launch_speed_sc')}, {r('launch_angle_sc')}, bb_type_sc, sc_events, barrels_sc, hard_hit_sc, bbe_sc,
    {r(_div('barrels_sc', 'bbe_sc'), 'barrel_rate_sc')}, {r(_div('hard_hit_sc', 'bbe_sc'), 'hard_hit_rate_sc')} from ({CONTACT_DAY})""",
)
def _(t: Tables) -> DataFrame:
    return contact_day(t).drop("hit_distance_sc_sc", "hc_x_sc", "hc_y_sc", "sc_description")


@query(
    "a08_lineup_summary",
    """select game_pk, team, 'confirmed' as c_lineup_status, count(batting_order) as c_lineup_spots, count(distinct player_id) as c_distinct_players,
    min_by(player_name, batting_order) as c_first_batter, max_by(player_name, batting_order) as c_last_batter, true as c_lineup_found
    from dt_confirmed group by game_pk, team""",
)
def _(t: Tables) -> DataFrame:
    return spine.lineup_summary(t.dt_confirmed, "c")


@query(
    "a09_starter_summary",
    """select l_orderkey as game_pk, l_linestatus as team, max(l_suppkey) as starter_pitcher_id, 'probable' as starter_status,
    cast(null as varchar) as starter_pitcher_name, cast(null as varchar) as starter_throws, true as starter_found from lineitem group by all""",
)
def _(t: Tables) -> DataFrame:
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("game_pk"), F.col("l_linestatus").alias("team"), F.col("l_suppkey").alias("pitcher_id"),
        F.lit("probable").alias("starter_status"),
    )
    return spine.starter_summary(raw, ["pitcher_id"])


_ROLL = """select batter_id, game_date, game_pk, avg(pa) over w as pa_roll7, avg(hits) over w as hits_roll7 from (
 select game_pk, game_date, batter_id, count(*) as pa, sum(cast(is_hit as int)) as hits from dt_flags group by all)
 window w as (partition by batter_id order by game_date, game_pk rows between 7 preceding and 1 preceding)"""


def _short_roll(t: Tables) -> DataFrame:
    games = t.dt_flags.groupBy("game_pk", "game_date", "batter_id").agg(
        F.count(F.lit(1)).alias("pa"), F.sum(F.col("is_hit").cast("int")).alias("hits")
    )
    return rolling(games, "batter_id", ["game_date", "game_pk"], means=["pa", "hits"], windows=(7,)).drop("pa", "hits")


def _form(top: str) -> str:
    return f"""with latest as (select batter_id, max_by(pa_roll7, (game_date, game_pk)) as pa_roll7, max_by(hits_roll7, (game_date, game_pk)) as hits_roll7,
    max_by((pa_roll7, hits_roll7), (game_date, game_pk)) as both_roll from ({_ROLL}) where game_date <= date '2000-06-30' group by batter_id)
    select l.game_pk, l.game_date, l.team, {r('avg(both_roll[1])', 'pa_roll7')}, {r('avg(both_roll[2])', 'hits_roll7')}, count(l.player_id) as n
    from dt_lineups l left join latest r on l.player_id = r.batter_id {top} group by l.game_pk, l.game_date, l.team"""


@query("a10_team_means", _form("where batting_order <= 3"))
def _(t: Tables) -> DataFrame:
    cutoff = F.lit("2000-06-30").cast("date")
    return features.team_form(t.dt_lineups, _short_roll(t), "n", 3, cutoff)


@query("a11_plain_group_size", "select game_pk, game_date, team, count(*) as n from dt_lineups group by all")
def _(t: Tables) -> DataFrame:
    return features.team_form(t.dt_lineups, t.dt_pa.select("batter_id", "game_date"), "n", cutoff=F.lit("2001-01-01"))


@query(
    "a12_team_expectation",
    f"""select game_pk, game_date, team, count(*) as lineup_count, {r('sum(w)', 'expected_pa')}, {r('sum(w * 0.1)', 'expected_hr_neutral')},
    {r('sum(w * 0.2)', 'expected_hr_today')}, {r('sum(w * 0.3)', 'env_hr_delta')}, {r('avg(batting_order)', 'avg_barrel_rate')},
    {r('avg(player_id)', 'avg_iso')}, cast(null as double) as avg_hr_per_pa, cast(null as double) as avg_hard_hit_rate,
    cast(null as double) as avg_flyball, cast(null as double) as avg_pulled_air
    from (select *, cast(lineup_weight as double) as w from dt_lineups) group by game_pk, game_date, team""",
)
def _(t: Tables) -> DataFrame:
    w, none = F.col("lineup_weight").cast("double"), F.lit(None).cast("double")
    players = t.dt_lineups.select(
        "game_pk", "game_date", "team", "player_name", w.alias("expected_pa"), (w * 0.1).alias("expected_hr_neutral_player"),
        (w * 0.2).alias("expected_hr_today_player"), (w * 0.3).alias("env_hr_delta_player"),
        F.col("batting_order").alias("barrel_rate"), F.col("player_id").alias("iso"), none.alias("hr_per_pa"),
        none.alias("hard_hit_rate"), none.alias("flyball"), none.alias("pulled_air"),
    )
    return features.team_expectation(players)


@query(
    "a13_group_profile",
    f"""select grp, {r('avg(v)', 'pit_value')}, cast(-999 as bigint) as pitcher_id, count(*) as bullpen_pitcher_count from (
    select user_id % 7 as grp, user_id, max_by(value, ts) filter (cast(ts as date) < date '2024-01-20') as v from events group by user_id) group by grp""",
)
def _(t: Tables) -> DataFrame:
    mart = t.events.select(
        F.col("user_id").alias("pitcher_id"), date_of(F.col("ts")).alias("game_date"), "ts", F.col("value").alias("pit_value")
    )
    members = t.events.select(F.col("user_id").alias("pitcher_id"), (F.col("user_id") % 7).alias("grp")).distinct()
    return inputs.bullpen_profile(members, mart, ["grp"], F.lit("2024-01-20").cast("date"), ["ts"])


@query(
    "a14_unambiguous_keys",
    "select c_nationkey, c_mktsegment, min(c_custkey % 7) as id from customer group by all having count(distinct c_custkey % 7) = 1",
)
def _(t: Tables) -> DataFrame:
    return resolve.unambiguous(
        t.customer.select("c_nationkey", "c_mktsegment", (F.col("c_custkey") % 7).alias("id")),
        ["c_nationkey", "c_mktsegment"], "id",
    )


@query(
    "a15_group_median",
    f"""select l_orderkey, {r('median(l_extendedprice)', 'price')}, {r("median(case when l_linenumber > 2 then l_quantity end)", 'quantity')}
    from lineitem group by l_orderkey""",
)
def _(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linenumber") > 2, F.col("l_quantity")).alias("quantity"),
    )
    return slates.group_medians(df, ["l_orderkey"], ["price", "quantity"])


_MEDIAN_SEASON = f"""select year(o_orderdate) as season, {r('median(o_totalprice)', 'price')},
 {r('median(case when o_custkey % 3 = 0 then o_totalprice end)', 'some')}, {r("median(cast(null as double))", 'empty')} from orders group by 1"""


def _seasons(t: Tables) -> DataFrame:
    return t.orders.select(
        F.year("o_orderdate").cast("bigint").alias("season"), F.col("o_totalprice").alias("price"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("o_totalprice")).alias("some"), F.lit(None).cast("double").alias("empty"),
    )


@query("a15_group_median_hot_group", _MEDIAN_SEASON)
def _(t: Tables) -> DataFrame:
    """Groups large enough for the selection by leading bits, and a column without values."""
    return slates.group_medians(_seasons(t), ["season"], ["price", "some", "empty"], group_rows=100)


@query(
    "a15_fill_with_median",
    f"""select o_orderkey, {r('coalesce(v, median(v) over (partition by d), 1.5)', 'v')} from (
    select o_orderkey, cast(o_orderdate as date) as d, case when o_custkey % 3 = 0 then o_totalprice end as v from orders)""",
)
def _(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", date_of(F.col("o_orderdate")).alias("d"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("o_totalprice")).alias("v"),
    )
    return slates.fill_with_median(df, ["d"], {"v": 1.5}).drop("d")


@query(
    "a16_slate_moments",
    f"""select o_orderpriority, {r('avg(o_totalprice)', '_mean')}, {r('stddev_samp(o_totalprice)', '_std')},
    {r('stddev_pop(o_totalprice)', 'pop')} from orders group by 1""",
)
def _(t: Tables) -> DataFrame:
    sample = slates.group_moments(t.orders, ["o_orderpriority"], "o_totalprice", 1)
    whole = slates.group_moments(t.orders, ["o_orderpriority"], "o_totalprice").select("o_orderpriority", F.col("_std").alias("pop"))
    return sample.join(whole, "o_orderpriority")


@query(
    "a17_outcome_summary",
    f"""select season, count(*) as n_sims, {r('avg((h > a)::int)', 'home_win_pct')}, {r('avg((h < a)::int)', 'away_win_pct')},
    {r('avg(h)', 'mean_home_runs_scored')}, {r('avg(a)', 'mean_away_runs_scored')}, {r('avg(h + a)', 'mean_total_runs')},
    {r('median(h + a)', 'median_total_runs')}, {r('avg((h + a <= 7)::int)', 'p_total_le_7_5')}, {r('avg((h + a >= 9)::int)', 'p_total_ge_8_5')}
    from (select season, coalesce(home_score, 0) as h, coalesce(away_score, 1) as a from dt_games) group by season""",
)
def _(t: Tables) -> DataFrame:
    home, away = F.coalesce("home_score", F.lit(0)), F.coalesce("away_score", F.lit(1))
    results = t.dt_games.select(
        "season", (home > away).alias("home_win"), (home < away).alias("away_win"), home.alias("score_home"),
        away.alias("score_away"), (home + away).alias("total_runs"),
    )
    return inputs.outcome_summary(results, ["season"])


@query("a18_value_counts", "select kind, count(*) as n from (select case when value > 10 then event_type end as kind from events) group by kind")
def _(t: Tables) -> DataFrame:
    kind = F.when(F.col("value") > 10, F.col("event_type")).alias("kind")
    return t.events.select(kind).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("a19_filled_share", f"select {r('(1.0 + avg((o_custkey % 4 <> 0)::int)) / 2', 'non_null_rate')} from orders")
def _(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 4 != 0, 1).alias("x"))
    return quality.filled_share(df, ["o_orderkey", "x"])


@query("a20_slate_date", "select max(cast(o_orderdate as date)) as slate_date from orders")
def _(t: Tables) -> DataFrame:
    return features.slate_date(t.orders.select(date_of(F.col("o_orderdate")).alias("game_date")))


@query("a21_distinct_seasons", "select distinct season from dt_games")
def _(t: Tables) -> DataFrame:
    return t.dt_games.select("season").distinct().orderBy("season")


_ORDER_SPEC = Contract("orders", ["o_orderkey", "o_custkey", "o_note"], ["o_orderkey", "o_clerk"], ["o_custkey", "o_orderstatus"])


def _gapped(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus")
    return t.orders.select("o_orderkey", "o_custkey", status, "o_orderdate", "o_totalprice")


@query(
    "q02_key_nulls",
    """select 'o_orderkey' as "column", 0::bigint as nulls union all select 'o_orderstatus', count(*) filter (o_orderstatus = 'P') from orders
    union all select 'absent', count(*) from orders""",
)
def _(t: Tables) -> DataFrame:
    return quality.null_counts(_gapped(t), ["o_orderkey", "o_orderstatus", "absent"])


@query(
    "q03_key_duplicates",
    "select cast(count(*) - count(distinct (l_orderkey, l_linenumber)) as bigint) as duplicate_rows from lineitem",
)
def _(t: Tables) -> DataFrame:
    return quality.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "q04_validation_report",
    """select 'orders' as table_name, 'o_clerk' as missing_required, 'o_note' as missing_declared, count(*) as row_count,
    cast(count(*) - count(distinct (o_custkey, case when o_orderstatus <> 'P' then o_orderstatus end)) as bigint) as duplicate_rows,
    0::bigint as null_o_custkey, count(*) filter (o_orderstatus = 'P') as null_o_orderstatus, false as valid from orders""",
)
def _(t: Tables) -> DataFrame:
    return quality.report(_gapped(t), _ORDER_SPEC, all_columns=True)


@query(
    "q05_table_validators",
    """select 'games_schedule' as table_name, '' as missing_required, (select count(*) from dt_games) as row_count, 0::bigint as duplicate_rows, true as valid
    union all select 'games', '', (select count(*) from dt_games), 0, true
    union all select 'weather_game', 'away_team,game_date,home_team,season,venue_id', (select count(*) from dt_weather), 0, false
    union all select 'parks', '', (select count(*) from dt_parks), 0, true
    union all select 'confirmed_lineups', '', (select count(*) from dt_lineups), 0, true
    union all select 'projected_lineups', '', (select count(*) from dt_lineups), 0, true
    union all select 'starting_pitchers', '', (select count(*) from dt_starters), 0, true
    union all select 'plate_appearances', '', (select count(*) from dt_pa), 0, true""",
)
def _(t: Tables) -> DataFrame:
    tables = {
        "games_schedule": t.dt_games, "games": t.dt_games, "weather_game": t.dt_weather, "parks": t.dt_parks,
        "confirmed_lineups": t.dt_confirmed, "projected_lineups": t.dt_projected,
        "starting_pitchers": t.dt_starters, "plate_appearances": t.dt_pa,
    }
    reports = [quality.report(df, name) for name, df in tables.items()]
    return shape.stack([x.select("table_name", "missing_required", "row_count", "duplicate_rows", "valid") for x in reports])


_PROFILE_ORDERS = """select unnest(['rows', 'distinct_keys', 'duplicates', 'min_date', 'max_date', 'nulls_o_orderstatus']) as measure,
    unnest([cast(count(*) as varchar), cast(count(distinct o_custkey) as varchar), cast(count(*) - count(distinct o_custkey) as varchar),
    cast(cast(min(o_orderdate) as date) as varchar), cast(cast(max(o_orderdate) as date) as varchar),
    cast(count(*) filter (o_orderstatus = 'P') as varchar)]) as value from orders"""


@query("q06_table_profile", _PROFILE_ORDERS)
def _(t: Tables) -> DataFrame:
    return quality.profile(_gapped(t), ["o_custkey"], "o_orderdate", ["o_orderstatus"])


@query("q06_merged_profile", _PROFILE_ORDERS)
def _(t: Tables) -> DataFrame:
    """Each season profiled alone; the written states give the profile of the whole."""
    key, orders = ["o_custkey"], _gapped(t).withColumn("_season", F.year("o_orderdate") % 3)
    parts = [orders.filter(F.col("_season").eqNullSafe(F.lit(k))) for k in (0, 1, 2, None)]
    return quality.profile_of([stage(quality.profile_state(p, key, "o_orderdate", ["o_orderstatus"]), "profile-state") for p in parts], key)


@query(
    "q07_coverage",
    f"""select {r('avg((home_starter_pitcher_id is not null and away_starter_pitcher_id is not null)::int) * 100', 'pct_both_starters')},
    {r('avg((game_pk % 5 <> 0)::int) * 100', 'pct_both_projected')} from dt_spine""",
)
def _(t: Tables) -> DataFrame:
    found = {
        "home_starter_found": F.when(F.col("home_starter_pitcher_id").isNotNull(), True),
        "away_starter_found": F.when(F.col("away_starter_pitcher_id").isNotNull(), True),
        "home_projected_lineup_found": F.when(F.col("game_pk") % 5 != 0, True),
        "away_projected_lineup_found": F.lit(True),
    }
    return spine.coverage(t.dt_spine.withColumns(found))


@query(
    "q08_null_percent",
    f"""select 'l_quantity' as "column", 0.0::double as null_pct union all
    select 'text', {r("avg((l_linenumber = 3)::int) * 100", 'null_pct')} from lineitem""",
)
def _(t: Tables) -> DataFrame:
    text = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_partkey").cast("string"))
    return quality.null_percent(t.lineitem.select("l_quantity", text.alias("text")), ["l_quantity", "text"])
