"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.base import Tables, query, r
from slatework.catalog.joins import KEEP_SQL, KEY_SQL
from slatework.functions import scoring as sc
from slatework.functions import text
from slatework.functions.coerce import date_of, date_text, null_of, ratio
from slatework.functions.events import (
    EVENT_FLAGS,
    bases_held,
    game_result,
    inning_bucket,
    total_bases,
)
from slatework.functions.teams import (
    CONTACT,
    FEATURE,
    LIVE,
    PAGE,
    SPINE,
    roof_class,
    station_of,
    team_code,
    team_code_letters,
)
from slatework.operators.shape import first_numeric
from slatework.plans import mart
from slatework.sources import feeds, records

LINE = "l_orderkey, l_partkey, l_linenumber"


def _line(t: Tables, **columns) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", *[c.alias(n) for n, c in columns.items()])


@query("s01_name_key", f"select person_id, {KEY_SQL} as k from dt_people")
def _(t: Tables) -> DataFrame:
    return t.dt_people.select("person_id", text.name_key(F.col("name")).alias("k"))


@query("s02_name_key_keep_suffix", f"select person_id, {KEEP_SQL} as k from dt_people")
def _(t: Tables) -> DataFrame:
    return t.dt_people.select("person_id", text.name_key_keep_suffix(F.col("name")).alias("k"))


@query(
    "s03_last_and_initial",
    """select p_partkey, split_part(p_name, ' ', -1) as last_name,
    case when contains(p_name, ' ') then concat(p_name[1], ' ', split_part(p_name, ' ', -1)) end as initial_last from part""",
)
def _(t: Tables) -> DataFrame:
    key = text.name_key(F.col("p_name"))
    return t.part.select(
        "p_partkey", text.last_name_of(key).alias("last_name"), text.initial_last_of(key).alias("initial_last")
    )


def _case(column: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in pairs.items())
    return f"case {column} {whens} else {column} end"


_COMMON = {"AZ": "ARI", "ATH": "OAK", "CWS": "CHW", "KCR": "KC", "SDP": "SD", "SFG": "SF", "TBR": "TB", "WAS": "WSH"}
_RETRO = {
    "AZ": "ARI", "CWS": "CHA", "KCR": "KCA", "LAD": "LAN", "NYM": "NYN", "NYY": "NYA", "ATH": "OAK", "SDP": "SDN",
    "SFG": "SFN", "STL": "SLN", "TBR": "TBA",
}


@query(
    "s04_team_codes",
    f"""select game_pk, {_case('home_team', _COMMON)} as spine, {_case('home_team', _COMMON)} as live, {_case('home_team', _COMMON)} as page,
    {_case('home_team', _RETRO)} as retro, {_case('home_team', {'AZ': 'ARI', 'WAS': 'WSN'})} as contact,
    {_case('home_team', {'AZ': 'ARI', 'ATH': 'OAK', 'CWS': 'CHW', 'WAS': 'WSH'})} as feature from dt_games""",
)
def _(t: Tables) -> DataFrame:
    messy = F.concat(F.lit(" "), F.lower("home_team"))
    forms = {"spine": SPINE, "live": LIVE, "page": PAGE, "contact": CONTACT, "feature": FEATURE}
    return t.dt_games.select(
        "game_pk", *[team_code(messy, m).alias(n) for n, m in forms.items()],
        team_code_letters(F.concat(messy, F.lit(".1"))).alias("retro"),
    )


@query("s05_snake_case", "select p_partkey, concat('size_', lower(p_type), '_', cast(p_size as varchar)) as k from part")
def _(t: Tables) -> DataFrame:
    raw = F.concat(F.lit(" size"), F.initcap(F.lower("p_type")), F.lit("--("), F.col("p_size").cast("string"), F.lit(")"))
    return t.part.select("p_partkey", text.snake(raw).alias("k"))


@query("s06_half_inning", "select game_pk, pa_index, case when inning_topbot = 'Top' then 'TOP' else 'BOT' end as half from dt_pa")
def _(t: Tables) -> DataFrame:
    return t.dt_pa.select("game_pk", "pa_index", text.half_inning(F.concat(F.col("inning_topbot"), F.lit(" "))).alias("half"))


@query(
    "s07_bases_held",
    """select game_pk, pa_index, contains(base_state_before, '1')::bigint as on_1b, contains(base_state_before, '2')::bigint as on_2b,
    contains(base_state_before, '3')::bigint as on_3b from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    held = bases_held(F.col("base_state_before"))
    return t.dt_pa.select("game_pk", "pa_index", *[c.alias(f"on_{i}b") for i, c in enumerate(held, 1)])


@query(
    "s08_date_parse",
    """select o_orderkey, case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as day,
    case when o_orderkey % 7 <> 0 then cast(cast(o_orderdate as date) as varchar) end as day_text from orders""",
)
def _(t: Tables) -> DataFrame:
    """ISO text, every declared form, and text that is no date."""
    shapes = ["MM/dd/yyyy", "M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyyMMdd"]
    raw = F.when(F.col("o_orderkey") % 7 == 0, "not a date")
    for k, shape in enumerate(shapes, 1):
        raw = raw.when(F.col("o_orderkey") % 7 == k, F.date_format("o_orderdate", shape))
    raw = raw.otherwise(F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", date_of(raw).alias("day"), date_text(raw).alias("day_text"))


@query(
    "s09_utc_to_new_york",
    """select event_id, concat(strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S'), '+00:00') as utc,
    concat(strftime(date_trunc('second', ts) - interval 5 hour, '%Y-%m-%dT%H:%M:%S'), '-05:00') as et from events""",
)
def _(t: Tables) -> DataFrame:
    at = F.try_to_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return t.events.select("event_id", feeds.iso_text(at, "UTC").alias("utc"), feeds.iso_text(at, "America/New_York").alias("et"))


@query(
    "s10_year_and_title_date",
    """select o_orderkey, year(o_orderdate)::bigint as season, cast(o_orderdate as date) as title_date from orders""",
)
def _(t: Tables) -> DataFrame:
    title = F.concat(F.lit("x Starting MLB lineups for "), F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(" - y"))
    pattern = r"(?i)Starting MLB lineups for ([A-Za-z]+ \d{1,2}, \d{4})"
    return t.orders.select(
        "o_orderkey", F.year("o_orderdate").cast("bigint").alias("season"), text.page_title_date(title, pattern).alias("title_date")
    )


@query("s11_safe_ratio", f"select {LINE}, {r('l_extendedprice / nullif(l_linenumber - 3, 0)', 'v')} from lineitem")
def _(t: Tables) -> DataFrame:
    return _line(t, v=ratio(F.col("l_extendedprice"), F.col("l_linenumber") - 3))


@query(
    "s12_clip",
    f"select {LINE}, case when l_linenumber <> 2 then {r('greatest(least(l_quantity, 40.0), 10.0)', 'q').split(' as ')[0]} end as v from lineitem",
)
def _(t: Tables) -> DataFrame:
    return _line(t, v=sc.clip(F.when(F.col("l_linenumber") != 2, F.col("l_quantity")), 10, 40))


@query("s13_logistic", f"select {LINE}, {r('1 / (1 + exp(-greatest(least(l_quantity - 25, 20), -20)))', 'v')} from lineitem")
def _(t: Tables) -> DataFrame:
    return _line(t, v=sc.logistic(F.col("l_quantity") - 25))


@query("s14_poisson_zero", f"select {LINE}, {r('exp(-greatest(least(l_discount * 100, 6.0), 0.02))', 'v')} from lineitem")
def _(t: Tables) -> DataFrame:
    return _line(t, v=sc.poisson_zero(F.col("l_discount") * 100))


@query(
    "s15_shrink_to_half",
    f"select {LINE}, {r('greatest(least(0.5 + (l_quantity / 50.0 - 0.5) * 0.58, 0.68), 0.32)', 'v')} from lineitem",
)
def _(t: Tables) -> DataFrame:
    return _line(t, v=sc.clip(sc.shrink_to_half(F.col("l_quantity") / 50.0), 0.32, 0.68))


@query("s16_units", f"select {LINE}, {r('l_quantity * 9.0 / 5.0 + 32.0', 'f')}, {r('l_quantity * 1.15078', 'w')} from lineitem")
def _(t: Tables) -> DataFrame:
    return _line(t, f=sc.fahrenheit(F.col("l_quantity")), w=sc.mph(F.col("l_quantity")))


@query(
    "s17_wind_sectors",
    f"""select {LINE}, case when d >= 315 or d <= 45 then 1.0::double else 0.0 end as o, case when d between 135 and 225 then 1.0::double else 0.0 end as i,
    case when d is null or d >= 315 or d <= 45 or d between 135 and 225 then 0.0::double else 1.0 end as c
    from (select *, case when l_linenumber <> 7 then fmod(l_quantity * 37.5, 360) end as d from lineitem)""",
)
def _(t: Tables) -> DataFrame:
    out, inward, cross = sc.wind_sectors(F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 37.5))
    return _line(t, o=out, i=inward, c=cross)


@query(
    "s18_bands",
    """select o_orderkey, case when p > 1 then null when p <= 0.52 then 'C' when p <= 0.55 then 'B-' when p <= 0.58 then 'B+' when p <= 0.62 then 'A' else 'A+' end as open,
    case when p <= 0.3 or p > 0.9 then null when p <= 0.6 then 'low' else 'high' end as closed from (select o_orderkey, round(o_totalprice / 400000, 2) as p from orders)""",
)
def _(t: Tables) -> DataFrame:
    p = F.round(F.col("o_totalprice") / 400000, 2)
    return t.orders.select(
        "o_orderkey", sc.band(p, [0.0, 0.52, 0.55, 0.58, 0.62, 1.0], ["C", "B-", "B+", "A", "A+"]).alias("open"),
        sc.band(p, [0.3, 0.6, 0.9], ["low", "high"], include_lowest=False).alias("closed"),
    )


@query(
    "s19_case_table",
    f"""select {LINE}, case l_linenumber when 1 then 4.85::double when 2 then 4.70 when 3 then 4.60 when 4 then 4.50 when 5 then 4.35 when 6 then 4.20 when 7 then 4.05 else 4.15 end as pa,
    case when l_linenumber <= 2 then 0.05::double when l_linenumber = 3 then 0.10 when l_linenumber >= 6 then -0.12 else 0.0 end as bonus from lineitem""",
)
def _(t: Tables) -> DataFrame:
    slot = F.col("l_linenumber")
    return _line(t, pa=sc.expected_pa(slot), bonus=sc.case_table([(slot <= 2, 0.05), (slot == 3, 0.10), (slot >= 6, -0.12)], 0.0))


@query(
    "s20_cumulative_multipliers",
    f"""select {LINE}, {r("l_quantity * case when l_linenumber >= 5 then 0.92 else 1 end * case when l_linenumber >= 6 then 0.84 else 1 end * case when l_linenumber >= 7 then 0.76 else 1 end", 'v')} from lineitem""",
)
def _(t: Tables) -> DataFrame:
    slot = F.col("l_linenumber")
    return _line(t, v=sc.multiply_where(F.col("l_quantity"), [(slot >= 5, 0.92), (slot >= 6, 0.84), (slot >= 7, 0.76)]))


@query(
    "s21_weighted_sum",
    f"select {LINE}, {r('l_quantity * 0.55 + coalesce(case when l_linenumber > 2 then l_discount end, 0) * -0.45', 'v')} from lineitem",
)
def _(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("d", F.when(F.col("l_linenumber") > 2, F.col("l_discount")))
    score = sc.weighted_sum(df.columns, {"l_quantity": 0.55, "d": -0.45, "absent": 9.0})
    return df.select("l_orderkey", "l_partkey", "l_linenumber", score.alias("v"))


@query(
    "s22_pair_features",
    f"select {LINE}, {r('l_discount - l_tax', 'matchup_hr_rate_diff')}, {r('l_discount * l_tax', 'matchup_hr_pressure_x')} from lineitem",
)
def _(t: Tables) -> DataFrame:
    df = _line(t, bat_hr_rate_roll30=F.col("l_discount"), pit_hr_rate_roll30=F.col("l_tax"))
    return mart.matchups(df).drop("bat_hr_rate_roll30", "pit_hr_rate_roll30")


@query(
    "s23_workload_cap",
    f"""select {LINE}, cast(case when a > 0 then least(greatest(round_even(a, 0), 18), 30) when b > 0 then least(greatest(round_even(b + 2, 0), 18), 30)
    when c > 0 then least(greatest(round_even(c + 6, 0), 18), 30) when s >= 7.5 then 27 when s >= 5.5 then 25 when s >= 3.5 then 23 when s >= 1.5 then 21 else 19 end as bigint) as cap
    from (select *, case when l_linenumber in (1, 2) then l_quantity / 2 end as a, case when l_linenumber = 3 then l_quantity - 10.5 end as b,
    case when l_linenumber = 4 then l_quantity - 20.5 end as c, 20.0 * l_discount * 4 - 12.0 * l_tax as s from lineitem)""",
)
def _(t: Tables) -> DataFrame:
    line, q = F.col("l_linenumber"), F.col("l_quantity")
    cap = sc.workload_cap(
        F.when(line.isin(1, 2), q / 2), F.when(line == 3, q - 10.5), F.when(line == 4, q - 20.5),
        [(F.col("l_discount") * 4, 20.0), (F.col("l_tax"), -12.0), (null_of("double"), 3.0)],
    )
    return _line(t, cap=cap)


@query("s24_tie_noise")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", sc.tie_noise(F.col("c_name"), F.col("c_mktsegment")).alias("noise"))


@query(
    "s25_map_lookup",
    """select game_pk, case home_team when 'ATL' then 'KATL' when 'TOR' then 'CYYZ' when 'COL' then 'KAPA' end as station
    from (select game_pk, case when home_team in ('ATL', 'TOR', 'COL') then home_team end as home_team from dt_games)""",
)
def _(t: Tables) -> DataFrame:
    team = F.when(F.col("home_team").isin("ATL", "TOR", "COL"), F.col("home_team"))
    return t.dt_games.select("game_pk", station_of(team, {"COL": "kapa"}).alias("station"))


@query(
    "s26_distinct_per_group",
    """select c_nationkey, c_mktsegment, count(distinct c_custkey % 7) as id_variant_count,
    case when count(distinct c_custkey % 7) = 1 then min(c_custkey % 7) end as only_id from customer group by all""",
)
def _(t: Tables) -> DataFrame:
    value = F.col("c_custkey") % 7
    lowest, highest = F.min(value), F.max(value)
    return t.customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.countDistinct(value).alias("id_variant_count"), F.when(lowest == highest, lowest).alias("only_id")
    )


@query(
    "s27_nested_path",
    "select event_id, coalesce(cast(json_extract(props, '$.k') as bigint), -1) as k, 'none' as missing from events",
)
def _(t: Tables) -> DataFrame:
    parsed = feeds.parse(t.events, "props", "k bigint, a struct<b: string>")
    return parsed.select(
        "event_id", feeds.path_or(F.col("feed.k"), -1).alias("k"), feeds.path_or(F.col("feed.a.b"), "none").alias("missing")
    )


@query(
    "s28_game_result",
    """select game_pk, case when home_score > away_score then true when home_score < away_score then false end as home_win,
    case when home_score > away_score then home_team when home_score < away_score then away_team end as winning_team,
    case when home_score > away_score then away_team when home_score < away_score then home_team end as losing_team from dt_games""",
)
def _(t: Tables) -> DataFrame:
    result = game_result(*[F.col(c) for c in ("home_team", "away_team", "home_score", "away_score")])
    return t.dt_games.select("game_pk", *[c.alias(n) for n, c in result.items()])


@query(
    "s29_event_flags",
    "select game_pk, pa_index, " + ", ".join(f if f != "is_bb" else "batter_id % 2 = 0 as is_bb" for f in EVENT_FLAGS) + " from dt_flags",
)
def _(t: Tables) -> DataFrame:
    """Walks come from an explicit column, every other flag from the event text."""
    raw = t.dt_pa.withColumn("walk_flag", F.when(F.col("batter_id") % 2 == 0, "Y").otherwise("no"))
    return raw.select("game_pk", "pa_index", *[c.alias(n) for n, c in records.event_flags(raw).items()])


@query(
    "s30_target_class",
    """select game_pk, pa_index, case when event_type in ('home_run', 'triple', 'double', 'single') then event_type
    when event_type in ('walk', 'hit_by_pitch') then 'walk_hbp' else 'out' end as target from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    return t.dt_flags.select("game_pk", "pa_index", mart.target(t.dt_flags).alias("target"))


@query(
    "s31_context_flags",
    """select game_pk, pa_index, length(base_state_before)::bigint as base_runner_count, contains(base_state_before, '3')::bigint as risp_flag,
    (base_state_before = '')::bigint as bases_empty_flag, (inning_topbot = 'Top')::bigint as is_top_inning, 0::bigint as is_bot_inning,
    case when inning <= 3 then 'early' when inning <= 6 then 'mid' else 'late' end as inning_bucket, (outs_before_pa = 2)::bigint as two_out_flag from dt_pa""",
)
def _(t: Tables) -> DataFrame:
    return mart.context(t.dt_pa).select(
        "game_pk", "pa_index", "base_runner_count", "risp_flag", "bases_empty_flag", "is_top_inning", "is_bot_inning",
        "inning_bucket", "two_out_flag",
    )


@query(
    "s31_inning_bucket",
    f"select {LINE}, case when q <= 3 then 'early' when q <= 6 then 'mid' when q <= 99 then 'late' end as b from (select *, l_quantity * 3 as q from lineitem)",
)
def _(t: Tables) -> DataFrame:
    return _line(t, b=inning_bucket(F.col("l_quantity") * 3))


@query(
    "s32_total_bases",
    "select game_pk, pa_index, case event_type when 'single' then 1 when 'double' then 2 when 'triple' then 3 when 'home_run' then 4 else 0 end::bigint as tb from dt_pa",
)
def _(t: Tables) -> DataFrame:
    flags = [F.col(c) for c in ("is_1b", "is_2b", "is_3b", "is_hr")]
    return t.dt_flags.select("game_pk", "pa_index", total_bases(*flags).alias("tb"))


@query(
    "s33_roof_class",
    """select game_pk, case when home_team in ('AZ', 'HOU', 'MIA', 'MIL', 'SEA', 'TOR', 'TEX') then 'unknown_retractable' else 'open_air' end as roof from dt_games""",
)
def _(t: Tables) -> DataFrame:
    return t.dt_games.select("game_pk", roof_class(F.col("home_team")).alias("roof"))


@query("s34_pick_label", "select o_orderkey, case when o_totalprice / 400000 >= 0.5 then 'HOME' else 'AWAY' end as pick from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", sc.pick_label(F.col("o_totalprice") / 400000, "HOME", "AWAY").alias("pick"))


@query("s35_row_maximum", f"select {LINE}, {r('greatest(l_discount * 5, 1 - l_discount * 5) - 0.5', 'edge')} from lineitem")
def _(t: Tables) -> DataFrame:
    p = F.col("l_discount") * 5
    return _line(t, edge=F.greatest(p, 1 - p) - 0.5)


@query("s36_degrees_text", f"select {LINE}, case when l_linenumber > 1 then concat(cast(cast(trunc(l_quantity * 1.5) as int) as varchar), '°') end as v from lineitem")
def _(t: Tables) -> DataFrame:
    return _line(t, v=text.degrees_text(F.when(F.col("l_linenumber") > 1, F.col("l_quantity") * 1.5)))


@query(
    "s37_fill_chain",
    f"""select l_orderkey, l_partkey, l_linenumber, {r("coalesce(case when l_linenumber > 5 then l_discount end, case when l_linenumber > 3 then l_tax end, 0.9)", 'v')} from lineitem""",
)
def _(t: Tables) -> DataFrame:
    line = F.col("l_linenumber")
    df = _line(t, a=F.when(line > 5, F.col("l_discount")), b=F.when(line > 3, F.col("l_tax")))
    return df.select("l_orderkey", "l_partkey", "l_linenumber", first_numeric(df, ["a", "b"], 0.9).alias("v"))
