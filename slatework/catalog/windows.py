"""Window functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.aggregates import (
    BATTER_CONTACT,
    BATTER_FLAGS,
    PITCHER_CONTACT,
    PITCHER_FLAGS,
)
from slatework.catalog.base import PA_ORDER, Tables, query, r
from slatework.functions.coerce import date_of
from slatework.functions.scoring import band
from slatework.operators import dedupe, slates
from slatework.operators.rolling import WINDOWS, rolling
from slatework.plans import gametables
from slatework.session import stage

LINE_KEY = [c.strip() for c in PA_ORDER.split(",")]


def over(w: int, by: str, order: str, lag: int = 1) -> str:
    return f"over (partition by {by} order by {order} rows between {w + lag - 1} preceding and {lag} preceding)"


@query(
    "w01_rolling_mean",
    "select event_id, user_id, "
    + ", ".join(
        r(f"avg({c}) {over(w, 'user_id', 'ts, event_id')}", f"{n}_roll{w}") for w in WINDOWS for c, n in (("v", "value"), ("g", "gap"))
    )
    + " from (select event_id, ts, value as v, case when value > 5 then value end as g, case when user_id % 40 <> 0 then user_id end as user_id from events)",
)
def _(t: Tables) -> DataFrame:
    """Null users roll as one group of their own."""
    df = t.events.select(
        "event_id", "ts", "value", F.when(F.col("value") > 5, F.col("value")).alias("gap"),
        F.when(F.col("user_id") % 40 != 0, F.col("user_id")).alias("user_id"),
    )
    return rolling(df, "user_id", ["ts", "event_id"], means=["value", "gap"]).drop("ts", "value", "gap")


@query(
    "w01_rolling_mean_hot_entity",
    "select event_id, kind, "
    + ", ".join(r(f"avg(value) {over(w, 'kind', 'day, event_id', 2)}", f"value_roll{w}") for w in WINDOWS)
    + " from (select event_id, value, cast(ts as date) as day, case when event_type in ('view', 'click') then event_type end as kind from events)",
)
def _(t: Tables) -> DataFrame:
    """Entities of thousands of rows, cut into segments of about 200."""
    df = t.events.select(
        "event_id", "value", date_of(F.col("ts")).alias("day"),
        F.when(F.col("event_type").isin("view", "click"), F.col("event_type")).alias("kind"),
    )
    return rolling(
        df, "kind", ["day", "event_id"], means=["value"], lag=2, segment_rows=200
    ).drop("day", "value")


@query(
    "w02_rolling_sum",
    "select event_id, " + ", ".join(r(f"case when u is not null then sum(value) {over(w, 'u', 'ts, event_id')} end", f"value_roll{w}") for w in WINDOWS)
    + " from (select *, case when user_id % 40 <> 0 then user_id end as u from events)",
)
def _(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "ts", "value", F.when(F.col("user_id") % 40 != 0, F.col("user_id")).alias("u"))
    return rolling(df, "u", ["ts", "event_id"], sums=["value"], null_entity=False).drop("ts", "value", "u")


@query("w03_rolling_mean_helper", "select event_id, " + r(f"avg(value) {over(7, 'user_id', 'ts, event_id')}", "value_roll7") + " from events")
def _(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "user_id", "ts", "value")
    return rolling(df, "user_id", ["ts", "event_id"], means=["value"], windows=(7,)).select("event_id", "value_roll7")


def flag_rolls(source: str, by: str, sums: list[str], rates: dict[str, tuple[str, str]], windows=WINDOWS) -> str:
    """SQL of the rolled sums and their rates of a game table."""
    at = {w: over(w, by, "game_date, game_pk") for w in windows}
    out = [f"sum({c}) {at[w]} as {c}_roll{w}" for w in windows for c in sums]
    out += [f"sum({n}) {at[w]} / nullif(sum({d}) {at[w]}, 0) as {rate}_roll{w}" for w in windows for rate, (n, d) in rates.items()]
    return f"select *, {', '.join(out)} from ({source})"


B_SUMS = ["pa", "ab", "hits", "hr", "rbi", "tb", "bb", "so"]
B_RATES = {
    "hit_rate": ("hits", "ab"), "hr_rate": ("hr", "ab"), "rbi_pa_rate": ("rbi", "pa"), "tb_pa_rate": ("tb", "pa"),
    "bb_rate": ("bb", "pa"), "so_rate": ("so", "pa"),
}
P_SUMS = ["batters_faced", "hits_allowed", "hr_allowed", "bb_allowed", "so", "runs_allowed", "tb_allowed"]
P_RATES = {
    n: (c, "batters_faced")
    for n, c in (("k_rate", "so"), ("bb_rate", "bb_allowed"), ("hr_rate", "hr_allowed"), ("hit_rate", "hits_allowed"), ("runs_rate", "runs_allowed"))
}
BATTER_FLAG_ROLLS = flag_rolls(BATTER_FLAGS, "batter_id", B_SUMS, B_RATES)
PITCHER_FLAG_ROLLS = flag_rolls(PITCHER_FLAGS, "pitcher_id", P_SUMS, P_RATES)


def _rates(names) -> list[str]:
    return [f"{n}_roll{w}" for w in WINDOWS for n in names]


@query(
    "w04_rolling_ratios_batter",
    f"select game_pk, batter_id, cast(pa_roll7 as bigint) as pa_roll7, {r('rbi_roll30')}, {', '.join(r(c) for c in _rates(B_RATES))} from ({BATTER_FLAG_ROLLS})",
)
def _(t: Tables) -> DataFrame:
    rolled = gametables.add_flag_batter_rolls(stage(gametables.batter_flag_game(t.dt_flags), "batter_games"))
    return rolled.select("game_pk", "batter_id", "pa_roll7", "rbi_roll30", *_rates(B_RATES))


@query(
    "w04_rolling_ratios_pitcher",
    f"select game_pk, pitcher_id, {', '.join(r(c) for c in _rates(P_RATES))} from ({PITCHER_FLAG_ROLLS})",
)
def _(t: Tables) -> DataFrame:
    rolled = gametables.add_flag_pitcher_rolls(stage(gametables.pitcher_flag_game(t.dt_flags), "pitcher_games"))
    return rolled.select("game_pk", "pitcher_id", *_rates(P_RATES))


def contact_rolls(source: str, by: str, prefix: str, sums: list[str], means: list[str], extra: dict[str, tuple[str, str]]) -> str:
    at = {w: over(w, by, "game_date, game_pk") for w in WINDOWS}
    out = [f"cast(sum({c}) {at[w]} as double) as {prefix}{c}_roll{w}" for w in WINDOWS for c in sums]
    out += [f"sum({n}) {at[w]} / nullif(sum({d}) {at[w]}, 0) as {prefix}{x}_roll{w}" for w in WINDOWS for x, (n, d) in extra.items()]
    out += [f"avg({c}) {at[w]} as {prefix}{c}_roll{w}" for w in WINDOWS for c in means]
    return f"select game_pk, game_date, {by}, {', '.join(out)} from ({source})"


BAT_NAMES = gametables._BATTER_SUMS + ["ba"] + gametables._BATTER_MEANS
PIT_NAMES = gametables._PITCHER_SUMS + gametables._PITCHER_MEANS
BATTER_CONTACT_ROLLS = contact_rolls(
    BATTER_CONTACT, "batter_id", "bat_", gametables._BATTER_SUMS, gametables._BATTER_MEANS, {"ba": ("hits", "pa")}
)
PITCHER_CONTACT_ROLLS = contact_rolls(
    PITCHER_CONTACT, "pitcher_id", "pit_", gametables._PITCHER_SUMS, gametables._PITCHER_MEANS, {}
)


@query(
    "w05_batter_rolling_table",
    f"select game_pk, batter_id, {', '.join(r('bat_' + c) for c in _rates(BAT_NAMES))} from ({BATTER_CONTACT_ROLLS})",
)
def _(t: Tables) -> DataFrame:
    rolled = gametables.add_contact_batter_rolls(stage(gametables.batter_contact_game(t.dt_flags), "batter_games"))
    return rolled.select("game_pk", "batter_id", *["bat_" + c for c in _rates(BAT_NAMES)])


@query(
    "w05_pitcher_rolling_table",
    f"select game_pk, pitcher_id, {', '.join(r('pit_' + c) for c in _rates(PIT_NAMES))} from ({PITCHER_CONTACT_ROLLS})",
)
def _(t: Tables) -> DataFrame:
    rolled = gametables.add_contact_pitcher_rolls(stage(gametables.pitcher_contact_game(t.dt_flags), "pitcher_games"))
    return rolled.select("game_pk", "pitcher_id", *["pit_" + c for c in _rates(PIT_NAMES)])


_ORDINAL = f"row_number() over (partition by {{0}} order by {PA_ORDER}{{1}})"


@query("w06_ordinal_in_group", f"select l_orderkey, l_partkey, l_linenumber, {_ORDINAL.format('l_orderkey', '')} as pa_index from lineitem")
def _(t: Tables) -> DataFrame:
    return dedupe.ordinal(t.lineitem, ["l_orderkey"], LINE_KEY, "pa_index").select(
        "l_orderkey", "l_partkey", "l_linenumber", "pa_index"
    )


@query(
    "w06_ordinal_hot_group",
    "select event_id, row_number() over (partition by event_type order by cast(ts as date), event_id) as n from events",
)
def _(t: Tables) -> DataFrame:
    """Groups of thousands of rows, cut into segments of about 100."""
    df = t.events.withColumn("day", date_of(F.col("ts")))
    return dedupe.ordinal(df, ["event_type"], ["day", "event_id"], "n", segment_rows=100).select("event_id", "n")


@query(
    "w07_last_row_per_key",
    f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber from (select *, row_number() over (partition by l_orderkey
    order by {', '.join(c + ' desc' for c in LINE_KEY)}) as rn from lineitem) where rn = 1""",
)
def _(t: Tables) -> DataFrame:
    return dedupe.last_per_key(t.lineitem, ["l_orderkey"], LINE_KEY).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


Z_BANDS = """case when z <= -1.0 then 'F' when z <= -0.20 then 'D' when z <= 0.45 then 'C' when z <= 1.10 then 'B' when z <= 1.80 then 'A' else 'A+' end"""


def zscore(value: str, by: str, bound: float | None, spread: str = "stddev_pop") -> str:
    """SQL of the standard score; 0 without spread."""
    z = f"({value} - avg({value}) over (partition by {by})) / {spread}({value}) over (partition by {by})"
    z = f"greatest(least({z}, {bound}), -{bound})" if bound else z
    return f"case when coalesce({spread}({value}) over (partition by {by}), 0) > 1e-12 then {z} else 0.0 end"


@query(
    "w08_rank_within_slate",
    f"""with rolled as (select user_id, ts, event_id, cast(ts as date) as day, avg(value) {over(7, 'user_id', 'ts, event_id')} as form from events),
    latest as (select user_id, day, max_by(form, (ts, event_id)) as form from rolled where form is not null group by all),
    scored as (select *, {zscore('form', 'day', 3.0)} as z from latest)
    select day, user_id, rank, {r('form')}, {r('z', 'z_score')}, {Z_BANDS} as confidence from (
     select *, row_number() over (partition by day order by z desc, user_id) as rank from scored) where rank <= 25""",
)
def _(t: Tables) -> DataFrame:
    """Flagship: recent form per user, latest per day, standard score, band and top 25."""
    events = t.events.select("user_id", "ts", "event_id", "value", date_of(F.col("ts")).alias("day"))
    rolled = rolling(events, "user_id", ["ts", "event_id"], means=["value"], windows=(7,), name="form")
    latest = dedupe.last_per_key(rolled.filter("form is not null"), ["user_id", "day"], ["ts", "event_id"])
    scored = slates.zscore_by(latest.select("user_id", "day", "form"), ["day"], "form", "z_score", 3.0)
    banded = scored.withColumn("confidence", band(F.col("z_score"), [-10, -1.0, -0.20, 0.45, 1.10, 1.80, 10], ["F", "D", "C", "B", "A", "A+"]))
    return dedupe.top_rows(banded, ["day"], [F.desc("z_score"), F.asc("user_id")], 25, "rank")


@query(
    "w09_zscore_within_slate",
    f"""select o_orderkey, {r('a', 'z_bounded')}, {r('b', 'z_sample')}, {r('c', 'z_flat')} from (
    select o_orderkey, {zscore('p', 'day', 2.5)} as a, {zscore('p', 'day', None, 'stddev_samp')} as b, {zscore('flat', 'day', 3.0)} as c
    from (select o_orderkey, cast(o_orderdate as date) as day, coalesce(case when o_custkey % 9 <> 0 then o_totalprice end, 0.0) as p, 5.0::double as flat from orders))""",
)
def _(t: Tables) -> DataFrame:
    df = t.orders.select(
        "o_orderkey", date_of(F.col("o_orderdate")).alias("day"),
        F.when(F.col("o_custkey") % 9 != 0, F.col("o_totalprice")).alias("p"), F.lit(5.0).alias("flat"),
    )
    df = slates.zscore_by(df, ["day"], "p", "z_bounded", 2.5)
    df = slates.zscore_by(df, ["day"], "p", "z_sample", None, ddof=1)
    return slates.zscore_by(df, ["day"], "flat", "z_flat", 3.0).select("o_orderkey", "z_bounded", "z_sample", "z_flat")
