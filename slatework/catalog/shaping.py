"""Projection, coercion, filters, ordering, deduplication and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.base import PA_ORDER, Tables, query, r
from slatework.functions.coerce import (
    any_null,
    date_of,
    flag,
    flag_int,
    home_flag,
    int_of,
    num_of,
    number_text,
    text_of,
)
from slatework.functions.events import OUTCOMES, barrel
from slatework.functions.teams import park_factor_columns
from slatework.operators import dedupe, shape
from slatework.plans import gametables, history, inputs, mart, spine
from slatework.plans.model import split_seasons
from slatework.sources import contracts, providers, records

LINE_KEY = [c.strip() for c in PA_ORDER.split(",")]


@query(
    "p01_conform_columns",
    """select c_custkey, c_name, cast(null as bigint) as c_rank, cast(null as varchar) as c_note,
    c_nationkey, c_acctbal + 0.0 as c_acctbal, c_mktsegment from customer""",
)
def _(t: Tables) -> DataFrame:
    return contracts.conform(t.customer, ["c_custkey", "c_name", "c_rank", "c_note"], {"c_rank": "bigint"})


@query("p02_first_existing_column", "select o_orderkey, o_orderstatus as status, 'none' as note from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        shape.pick_column(t.orders, ["status", "o_orderstatus", "o_orderpriority"]).alias("status"),
        shape.pick_column(t.orders, ["o_note"], "none").alias("note"),
    )


_NULLED = """select {k}, case when l_linenumber % 2 = 0 then null else l_quantity end as a,
 case when l_linenumber % 3 = 0 then 'x' else cast(l_suppkey as varchar) end as b,
 case when l_linenumber = 6 then null else l_extendedprice end as c from lineitem"""


def _nulled(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey",
        F.when(line % 2 != 0, F.col("l_quantity")).alias("a"),
        F.when(line % 3 == 0, "x").otherwise(F.col("l_suppkey").cast("string")).alias("b"),
        F.when(line != 6, F.col("l_extendedprice")).alias("c"),
    )


@query(
    "p03_first_non_null_numeric",
    f"""select l_orderkey, {r('coalesce(a, try_cast(b as double), -1.0)', 'value')}
    from ({_NULLED.format(k='l_orderkey')})""",
)
def _(t: Tables) -> DataFrame:
    df = _nulled(t)
    return df.select("l_orderkey", shape.first_numeric(df, ["z", "a", "b"], -1.0).alias("value"))


@query(
    "p04_type_hints",
    """select o_orderkey, case when o_custkey % 2 = 0 then o_custkey end as o_custkey,
    cast(o_orderstatus as varchar) as o_orderstatus from orders""",
)
def _(t: Tables) -> DataFrame:
    texts = t.orders.select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("o_orderkey"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string"))
        .otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit("x")))
        .alias("o_custkey"),
        "o_orderstatus",
    )
    return contracts.apply_types(texts, ["o_orderkey", "o_custkey", "absent"], ["o_orderstatus"])


@query(
    "p05_nullable_casts",
    f"""select l_orderkey, cast(l_quantity as bigint) as as_int, {r('l_extendedprice', 'as_float')},
    cast(l_linenumber as varchar) as as_text,
    case when l_linenumber % 2 = 0 then cast(l_linenumber as bigint) end as whole_only from lineitem""",
)
def _(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey",
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")).alias("q"),
        F.col("l_extendedprice").cast("string").alias("p"),
        "l_linenumber",
        (F.col("l_linenumber") + F.when(F.col("l_linenumber") % 2 == 0, 0.0).otherwise(0.25)).alias("w"),
    )
    return df.select(
        "l_orderkey",
        int_of(df, "q").alias("as_int"),
        num_of(df, "p").alias("as_float"),
        text_of(df, "l_linenumber").alias("as_text"),
        int_of(df, "w").alias("whole_only"),
    )


_TOKEN_SQL = """case l_linenumber when 1 then '1' when 2 then 'yes' when 3 then 'FALSE' when 4 then 'n'
 when 5 then 'Maybe' when 6 then '3.7' else null end"""


def _tokens(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    words = {1: "1", 2: "yes", 3: "FALSE", 4: "n", 5: "Maybe", 6: "3.7"}
    token = F.lit(None).cast("string")
    for number, word in words.items():
        token = F.when(line == number, word).otherwise(token)
    return t.lineitem.select("l_orderkey", "l_linenumber", token.alias("token"))


@query(
    "p06_boolean_tokens",
    f"""select l_orderkey, case when token in ('1', 'yes') then true when token in ('FALSE', 'n') then false end as f,
    case when token in ('1', 'yes') then true when token is null or token in ('FALSE', 'n') then false end as f_default
    from (select l_orderkey, {_TOKEN_SQL} as token from lineitem)""",
)
def _(t: Tables) -> DataFrame:
    token = F.col("token")
    return _tokens(t).select("l_orderkey", flag(token).alias("f"), flag(token, False).alias("f_default"))


@query(
    "p07_flag_to_int",
    f"""select l_orderkey, cast(case when token in ('1', 'yes') then 1 when token = '3.7' then 3 else 0 end as bigint) as f
    from (select l_orderkey, {_TOKEN_SQL} as token from lineitem)""",
)
def _(t: Tables) -> DataFrame:
    return _tokens(t).select("l_orderkey", flag_int(F.col("token")).alias("f"))


@query(
    "p08_numeric_default",
    f"""select l_orderkey, {r('coalesce(a, 0.0)', 'a')}, {r('coalesce(try_cast(b as double), 0.0)', 'b')}, 0.0::double as extra
    from ({_NULLED.format(k='l_orderkey')})""",
)
def _(t: Tables) -> DataFrame:
    return shape.with_numeric(_nulled(t), ["a", "b", "extra"], 0.0).select("l_orderkey", "a", "b", "extra")


@query(
    "p09_home_token",
    """select l_orderkey, case when l_linenumber % 4 = 0 then true when l_linenumber % 4 = 1 then false
    when l_linenumber % 4 = 2 then true end as is_home from lineitem""",
)
def _(t: Tables) -> DataFrame:
    kind = F.col("l_linenumber") % 4
    token = F.when(kind == 0, " HOME").when(kind == 1, "@").when(kind == 2, "vs ").otherwise("neutral")
    return t.lineitem.select("l_orderkey", home_flag(token).alias("is_home"))


@query("p10_snake_case_columns", "select c_custkey as cust_key, c_name as customer_name, c_mktsegment as mkt_segment_2 from customer")
def _(t: Tables) -> DataFrame:
    renamed = t.customer.select(
        F.col("c_custkey").alias("custKey"), F.col("c_name").alias(" Customer  Name"),
        F.col("c_mktsegment").alias("MktSegment (2)"),
    )
    return shape.snake_columns(renamed)


def _padded(t: Tables) -> DataFrame:
    name = F.when(F.col("c_custkey") % 3 == 0, F.lit("   ")).otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    return t.customer.select("c_custkey", name.alias("c_name"))


@query(
    "p11_strip_strings",
    "select c_custkey, case when c_custkey % 3 = 0 then '' else c_name end as c_name from customer",
)
def _(t: Tables) -> DataFrame:
    return shape.strip_text(_padded(t))


@query(
    "p12_blank_to_null",
    "select c_custkey, case when c_custkey % 3 <> 0 then concat('  ', c_name, ' ') end as c_name from customer",
)
def _(t: Tables) -> DataFrame:
    return shape.blanks_to_null(_padded(t))


@query(
    "p13_standard_cleanup",
    "select c_custkey as cust_key, case when c_custkey % 3 <> 0 then c_name end as full_name from customer",
)
def _(t: Tables) -> DataFrame:
    return shape.clean(_padded(t).toDF("CustKey", "Full Name"))


@query(
    "p14_prefix_rename",
    """select h.n_nationkey, h.n_name as home_n_name, h.n_regionkey as home_n_regionkey, a.n_name as away_n_name,
    a.n_regionkey as away_n_regionkey from nation h join nation a on h.n_nationkey = a.n_nationkey""",
)
def _(t: Tables) -> DataFrame:
    home = shape.prefixed(t.nation, "home_", ["n_nationkey"])
    return home.join(shape.prefixed(t.nation, "away_", ["n_nationkey"]), "n_nationkey")


@query("p15_select_by_name_part", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus from lineitem")
def _(t: Tables) -> DataFrame:
    keys = shape.containing(t.lineitem, "key")
    return t.lineitem.select(*keys, *shape.starting_with(t.lineitem, "l_line"))


@query("p16_preview_order", "select o_orderstatus, o_orderkey, o_custkey, o_orderpriority from orders")
def _(t: Tables) -> DataFrame:
    return shape.front(t.orders.drop("o_totalprice", "o_orderdate"), ["o_orderstatus", "absent", "o_orderkey"])


@query("p17_replace_stale_columns", "select l_orderkey, l_partkey as launch_speed, l_suppkey as hc_x from lineitem")
def _(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", F.lit(0).alias("launch_speed"), F.lit(0).alias("hc_x"),
        F.col("l_partkey").alias("launch_speed_sc"), F.col("l_suppkey").alias("hc_x_sc"),
    )
    return shape.replace_columns(df, ["launch_speed", "hc_x"], history.PROMOTED_CONTACT)


@query(
    "p18_park_factor_lookup",
    """select game_pk,
    case home_team when 'COL' then 1.30 when 'CIN' then 1.18 when 'BOS' then 1.04 else 1.0 end::double as park_hr_factor,
    case home_team when 'COL' then 1.18 when 'CIN' then 1.07 when 'BOS' then 1.02 else 1.0 end::double as park_run_factor,
    case home_team when 'COL' then 1.08 when 'CIN' then 0.98 when 'BOS' then 1.01 else 1.0 end::double as park_1b_factor,
    case home_team when 'COL' then 1.15 when 'CIN' then 0.97 when 'BOS' then 1.08 else 1.0 end::double as park_2b3b_factor
    from (select game_pk, case when venue_id = 8 then 'COL' when venue_id = 6 then 'CIN' when venue_id = 3 then 'BOS' else 'none' end as home_team from dt_games)""",
)
def _(t: Tables) -> DataFrame:
    known = F.col("home_team").isin("COL", "CIN", "BOS")
    return t.dt_games.select("game_pk", *park_factor_columns(F.when(known, F.col("home_team"))))


@query(
    "p19_lineup_records",
    """select game_pk, cast(game_date as varchar) as game_date, season, team, opponent, is_home, 'confirmed' as lineup_status,
    'feed' as source, batting_order, player_id, player_name, cast(null as varchar) as handedness_bat,
    cast(null as varchar) as handedness_throw, 'CF' as position, true as is_starting_lineup from dt_lineups""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_lineups.select(
        F.col("game_pk").cast("string").alias("game_id"), F.col("game_date").alias("date"), "season",
        F.col("team").alias("team_abbr"), F.col("opponent").alias("opp"), F.col("is_home").alias("home_flag"),
        F.col("batting_order").alias("lineup_slot"), F.col("player_id").cast("double").alias("mlbam_id"),
        F.col("player_name").alias("name"), F.lit("CF").alias("pos"),
    )
    return records.lineups(raw, "confirmed", "feed").drop("source_pull_ts")


@query(
    "p20_starter_records",
    """select game_pk, cast(game_date as varchar) as game_date, season, team, opponent, is_home, pitcher_id, pitcher_name,
    throws, 'probable' as starter_status, 'unknown' as source from dt_starters""",
)
def _(t: Tables) -> DataFrame:
    return records.starters(t.dt_starters, "probable").drop("source_pull_ts")


@query(
    "p21_plate_appearance_records",
    f"""select game_pk, cast(game_date as varchar) as game_date, inning, case when inning_topbot = 'Top' then 'TOP' else 'BOT' end as inning_topbot,
    batter_id, pitcher_id, case when pa_index <= 2 then null else pa_index end as given_index, pa_index,
    event_type, rbi, true as is_pa, event_type in ('single', 'double', 'triple', 'home_run') as is_hit,
    event_type = 'home_run' as is_hr, event_type = 'walk' as is_bb, rbi > 0 as is_rbi, {r('launch_speed')}, 'statcast' as source
    from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    """The first two rows of every game arrive without a sequence number."""
    given = F.when(F.col("pa_index") > 2, F.col("pa_index"))
    raw = t.dt_pa.select(
        F.col("game_pk").alias("game_id"), F.col("game_date").cast("string").alias("date"),
        F.col("inning").cast("string").alias("inning_number"), F.col("inning_topbot").alias("half_inning"),
        F.col("batter_id").alias("batter"), F.col("pitcher_id").alias("pitcher"),
        given.alias("at_bat_number"), F.concat(F.lit(" "), F.upper("event_type")).alias("events"),
        F.col("rbi").alias("rbi_on_play"), F.col("launch_speed").cast("string").alias("hit_speed"),
        F.col("pa_index").alias("arrived"),
    )
    out = records.plate_appearances(raw, "statcast", arrival=["arrived"])
    return out.select(
        "game_pk", "game_date", "inning", "inning_topbot", "batter_id", "pitcher_id",
        F.when(F.col("pa_index") > 2, F.col("pa_index")).alias("given_index"), "pa_index", "event_type", "rbi",
        "is_pa", "is_hit", "is_hr", "is_bb", "is_rbi", "launch_speed", "source",
    )


@query(
    "p22_park_records",
    f"""select venue_id, venue_name, team, 'USA' as country, roof_type, roof_type = 'Dome' as is_dome,
    roof_type = 'Retractable' as is_retractable, {r('park_factor_hr')}, 'unknown' as park_source from dt_parks""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_parks.select(
        F.col("venue_id").cast("string").alias("park_id"), F.col("venue_name").alias("name"), "team",
        F.col("roof_type").alias("roof"), F.col("park_factor_hr").alias("pf_hr"),
    )
    return records.parks(raw).select(
        "venue_id", "venue_name", "team", "country", "roof_type", "is_dome", "is_retractable", "park_factor_hr",
        "park_source",
    )


@query(
    "p23_schedule_prep",
    """select game_pk, cast(game_date as varchar) as game_date, season, status, away_team, home_team, venue_id,
    false as doubleheader_flag, cast(null as varchar) as day_night from dt_games""",
)
def _(t: Tables) -> DataFrame:
    return spine.prep_schedule(t.dt_games).select(
        "game_pk", "game_date", "season", "status", "away_team", "home_team", "venue_id", "doubleheader_flag",
        "day_night",
    )


@query(
    "p24_spine_side_prep",
    """select o_custkey as game_pk, max(o_orderkey) as innings, max_by(o_orderstatus, o_orderkey) as game_status,
    cast(null as varchar) as start_time_utc from orders group by o_custkey""",
)
def _(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_custkey").alias("game_pk"), F.col("o_orderkey").alias("innings"), F.col("o_orderstatus").alias("status")
    )
    return spine.prep_side(raw, spine.GAMES, "game_pk", ["innings"]).select(
        "game_pk", "innings", "game_status", "start_time_utc"
    )


_LIVE_TEAM = """case team when 'AZ' then 'ARI' when 'ATH' then 'OAK' when 'CWS' then 'CHW' when 'KCR' then 'KC'
 when 'SDP' then 'SD' when 'SFG' then 'SF' when 'TBR' then 'TB' when 'WAS' then 'WSH' else team end"""


@query(
    "p25_provider_row_prep",
    f"""select game_pk, {_LIVE_TEAM} as team, is_home,
    case when game_pk % 2 = 0 then cast(game_date as varchar) else '2001-07-04' end as game_date from dt_sides""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_sides.select(
        "game_pk", F.lower("team").alias("team"),
        F.when(F.col("is_home"), "HOME").otherwise("away").alias("is_home"),
        F.when(F.col("game_pk") % 2 == 0, F.col("game_date").cast("string")).otherwise("tba").alias("game_date"),
    )
    return providers.provider_rows(raw, "2001-07-04")


@query("p26_rename_if_missing", "select l_orderkey, l_partkey as avg_ev, l_suppkey as avg_la, l_linenumber as avg_launch_angle from lineitem")
def _(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("avg_exit_velocity"), F.col("l_suppkey").alias("avg_la"),
        F.col("l_linenumber").alias("avg_launch_angle"),
    )
    return shape.rename_missing(df, {"avg_exit_velocity": "avg_ev", "avg_launch_angle": "avg_la"})


@query("p27_audit_columns", "select o_orderkey, 'feed' as source, true as stamped from orders")
def _(t: Tables) -> DataFrame:
    """The pull time differs from run to run, so only that it is set, and not ahead of the clock, is compared."""
    audited = t.orders.select("o_orderkey", *records.audit(t.orders, "feed"))
    stamped = F.col("source_pull_ts").isNotNull() & (F.col("source_pull_ts") <= F.current_timestamp())
    return audited.select("o_orderkey", "source", stamped.alias("stamped"))


@query(
    "p28_required_base_columns",
    f"""select game_pk, batter_id, is_hit::bigint as is_hit, cast(0 as bigint) as is_barrel, {r('coalesce(launch_speed, 0.0)', 'launch_speed')},
    cast(is_1b as bigint) + 2 * cast(is_2b as bigint) + 3 * cast(is_3b as bigint) + 4 * cast(is_hr as bigint) as total_bases from dt_flags""",
)
def _(t: Tables) -> DataFrame:
    return gametables.base_columns(t.dt_flags).select(
        "game_pk", "batter_id", "is_hit", "is_barrel", "launch_speed", "total_bases"
    )


@query(
    "p29_plate_appearance_prep",
    """select game_pk, batter_id, season, cast(is_hit as bigint) as is_hit, cast(is_so as bigint) as is_so, cast(rbi as double) as rbi,
    cast(is_1b as bigint) + 2 * cast(is_2b as bigint) + 3 * cast(is_3b as bigint) + 4 * cast(is_hr as bigint) as tb from dt_flags""",
)
def _(t: Tables) -> DataFrame:
    return gametables.flagged(t.dt_flags).select("game_pk", "batter_id", "season", "is_hit", "is_so", "rbi", "tb")


@query(
    "p30_derive_if_all_null",
    f"""select l_orderkey, {r('l_discount / nullif(l_quantity, 0)', 'rate')}, {r('l_tax', 'kept')} from lineitem""",
)
def _(t: Tables) -> DataFrame:
    df = t.lineitem.select(
        "l_orderkey", "l_discount", "l_quantity", F.lit(None).cast("double").alias("rate"),
        F.col("l_tax").alias("kept"),
    )
    rate = F.try_divide(F.col("l_discount"), F.col("l_quantity"))
    rules = [("rate", [(["kept"], rate)]), ("kept", [([], F.lit(0.0))])]
    return shape.derive_if_empty(df, rules).select("l_orderkey", "rate", "kept")


@query(
    "f01_not_null_keys",
    """select l_orderkey, l_partkey, o_custkey from lineitem join orders on l_orderkey = o_orderkey
    where o_orderstatus <> 'P' and l_linenumber <> 3""",
)
def _(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    nulled = joined.select(
        "l_orderkey", F.when(F.col("l_linenumber") != 3, F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
    )
    return nulled.dropna(subset=["l_partkey", "o_custkey"])


@query("f02_flag_filter", "select event_id, user_id from events where event_type = 'purchase'")
def _(t: Tables) -> DataFrame:
    flagged = t.events.withColumn("is_pa", F.col("event_type") == "purchase")
    return flagged.filter("is_pa").select("event_id", "user_id")


@query(
    "f03_cutoff_date",
    """select event_id, cast(ts as date) < date '2024-01-15' as strictly_before from events
    where cast(ts as date) <= date '2024-01-15'""",
)
def _(t: Tables) -> DataFrame:
    day, cutoff = date_of(F.col("ts")), F.lit("2024-01-15").cast("date")
    return t.events.filter(day <= cutoff).select("event_id", (day < cutoff).alias("strictly_before"))


@query("f04_top_slots", "select l_orderkey, l_linenumber, l_partkey from lineitem where l_linenumber <= 3")
def _(t: Tables) -> DataFrame:
    return t.lineitem.filter(F.col("l_linenumber") <= 3).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "f05_season_split",
    """select o_orderkey, case when year(o_orderdate) = 2001 then 'test' else 'train' end as part from orders
    where year(o_orderdate) in (1998, 1999, 2000, 2001)""",
)
def _(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("season", F.year("o_orderdate"))
    train, test = split_seasons(dated, [1998, 1999, 2000], [2001])
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part"))
    )


@query("f06_known_classes", "select game_pk, pa_index from dt_pa where event_type in ('single', 'double', 'triple', 'home_run')")
def _(t: Tables) -> DataFrame:
    return t.dt_pa.filter(F.col("event_type").isin([c for c in OUTCOMES if c not in ("out", "walk_hbp")])).select(
        "game_pk", "pa_index"
    )


@query(
    "f07_closed_range",
    """select game_pk, pa_index, coalesce(launch_speed >= 98 and launch_angle >= 26 and launch_angle <= 30, false) as barrel
    from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    return t.dt_pa.select("game_pk", "pa_index", barrel(F.col("launch_speed"), F.col("launch_angle")).alias("barrel"))


@query("f08_regex_filter", "select p_partkey, p_type from part where coalesce(regexp_matches(p_type, 'Y$'), false)")
def _(t: Tables) -> DataFrame:
    return t.part.filter(F.coalesce(F.col("p_type").rlike("Y$"), F.lit(False))).select("p_partkey", "p_type")


@query(
    "f09_any_missing",
    """select game_pk, home_starter_pitcher_id is null or away_starter_pitcher_id is null as missing_starter from dt_spine""",
)
def _(t: Tables) -> DataFrame:
    ids = [F.col("home_starter_pitcher_id"), F.col("away_starter_pitcher_id")]
    return t.dt_spine.select("game_pk", any_null(ids).alias("missing_starter"))


@query("t01_multi_key_sort", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus").orderBy("o_orderstatus", "o_custkey", "o_orderkey")


@query("t02_mixed_direction_sort", f"select o_orderkey, {r('abs(o_totalprice / 500000 - 0.5)', 'edge')} from orders")
def _(t: Tables) -> DataFrame:
    edge = F.abs(F.col("o_totalprice") / 500000 - 0.5)
    return t.orders.select("o_orderkey", edge.alias("edge")).orderBy(F.desc("edge"), "o_orderkey")


@query(
    "t03_top_rows_per_slate",
    """select o_orderkey, day, rank from (select o_orderkey, cast(o_orderdate as date) as day, row_number() over
    (partition by cast(o_orderdate as date) order by o_totalprice desc, o_orderkey) as rank from orders) where rank <= 25""",
)
def _(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("day", date_of(F.col("o_orderdate")))
    return dedupe.top_rows(dated, ["day"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 25, "rank").select(
        "o_orderkey", "day", "rank"
    )


_LINE_ROWS = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity + 0.0 as l_quantity from (select *, row_number() over
 (partition by l_orderkey, l_linenumber order by l_partkey {d}, l_suppkey {d}, l_quantity {d}, l_extendedprice {d}) as rn from lineitem) where rn = 1"""


@query("t04_keep_last", _LINE_ROWS.format(d="desc"))
def _(t: Tables) -> DataFrame:
    return dedupe.last_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_KEY[1:]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query("t05_keep_first", _LINE_ROWS.format(d="asc"))
def _(t: Tables) -> DataFrame:
    return dedupe.first_per_key(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_KEY[1:]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query("t06_distinct_rows", "select distinct l_partkey, l_returnflag, l_linestatus from lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus").distinct()


@query("t07_repeatable_sample")
def _(t: Tables) -> DataFrame:
    return dedupe.sample_rows(t.lineitem, 5000, LINE_KEY + ["l_orderkey"])


@query("t08_first_rows")
def _(t: Tables) -> DataFrame:
    return t.lineitem.limit(50)


@query(
    "u01_union_by_name",
    """select o_orderkey, cast(o_orderdate as date) as game_date, year(o_orderdate)::bigint as season,
    case when year(o_orderdate) >= 1998 then o_orderstatus end as status from orders""",
)
def _(t: Tables) -> DataFrame:
    dated = t.orders.select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("game_date"), F.year("o_orderdate").alias("season"),
        F.col("o_orderstatus").alias("status"),
    )
    old = dated.filter("season < 1998").drop("status")
    return history.bridge([old, dated.filter("season >= 1998")])


@query(
    "u02_load_seasons",
    """select o_orderkey, cast(o_orderdate as date) as game_date, year(o_orderdate)::bigint as season from orders
    where o_orderstatus <> 'P'""",
)
def _(t: Tables) -> DataFrame:
    dated = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("string")).otherwise("?").alias("game_date"),
        F.year("o_orderdate").alias("season"),
    )
    return history.load_seasons([dated.filter("season <= 1998"), dated.filter("season > 1998")])


@query("u03_wide_to_long", "select game_pk, team, opponent, is_home from dt_sides")
def _(t: Tables) -> DataFrame:
    return shape.team_rows(t.dt_games, ["game_pk"], F.col("home_team"), F.col("away_team"))


@query("u04_long_to_wide", "select game_pk, home_team, away_team from dt_games")
def _(t: Tables) -> DataFrame:
    return shape.game_columns(t.dt_sides, ["game_pk"], ["team"])


@query(
    "u05_stack_lookups",
    """select c_custkey as id, lower(c_name) as lookup_key, 'exact' as lookup_type from customer
    union all select c_custkey, lower(c_mktsegment), 'segment' from customer""",
)
def _(t: Tables) -> DataFrame:
    return shape.rows_of(
        t.customer.withColumnRenamed("c_custkey", "id"),
        ["id"],
        {"lookup_key": F.lower("c_name"), "lookup_type": F.lit("exact")},
        {"lookup_key": F.lower("c_mktsegment"), "lookup_type": F.lit("segment")},
    )


@query(
    "u06_stack_tables",
    """select distinct n_name, n_regionkey, 0::bigint as source_table_idx from nation where n_regionkey < 2
    union all select distinct n_name, n_regionkey, 1::bigint from nation where n_regionkey >= 1""",
)
def _(t: Tables) -> DataFrame:
    names = t.nation.select("n_name", "n_regionkey")
    low, high = names.filter("n_regionkey < 2"), names.filter("n_regionkey >= 1")
    return shape.stack_numbered([low.union(low), high], "source_table_idx")


@query(
    "u07_month_chunks",
    """select o_custkey, cast(greatest(m, lo) as date) as chunk_start, cast(least(last_day(cast(m as date)), hi) as date) as chunk_end from (
    select *, unnest(generate_series(date_trunc('month', lo), hi, interval 1 month)) as m from (
     select o_custkey, min(cast(o_orderdate as date)) as lo, max(cast(o_orderdate as date)) as hi from orders group by o_custkey))""",
)
def _(t: Tables) -> DataFrame:
    day = date_of(F.col("o_orderdate"))
    ranges = t.orders.groupBy("o_custkey").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return shape.month_chunks(ranges, F.col("lo"), F.col("hi")).drop("lo", "hi")


_ORDERED = """select game_pk, team, string_agg(cast(player_id as varchar), ',' order by rn) as ids from (
 select *, row_number() over (partition by game_pk, team order by batting_order, player_id) as rn from {0}
 where player_id is not null) where rn <= 9 group by game_pk, team"""


@query("u08_ordered_id_list", _ORDERED.format("dt_confirmed"))
def _(t: Tables) -> DataFrame:
    return inputs.ordered_ids(t.dt_confirmed)


@query(
    "u09_list_to_rows",
    """select game_pk, team, row_number() over (partition by game_pk, team order by batting_order, player_id) as lineup_slot, player_id
    from dt_confirmed where player_id is not null""",
)
def _(t: Tables) -> DataFrame:
    return inputs.id_rows(inputs.ordered_ids(t.dt_confirmed), ["game_pk", "team"], "ids")
