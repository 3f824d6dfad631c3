"""Composed feature views, boards, mart and slate inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatework.catalog.aggregates import (
    BATTER_COUNT,
    CONTACT_DAY,
    PITCHER_COUNT,
    contact_day,
    contact_flags,
)
from slatework.catalog.base import EVENT_SQL, PA_ORDER, Tables, define, query, r
from slatework.catalog.joins import KEEP_SQL, KEY_SQL, KEYED, lookup_sql
from slatework.catalog.windows import (
    BATTER_CONTACT_ROLLS,
    BATTER_FLAG_ROLLS,
    LINE_KEY,
    PITCHER_CONTACT_ROLLS,
    PITCHER_FLAG_ROLLS,
    Z_BANDS,
    over,
    zscore,
)
from slatework.functions.coerce import ratio
from slatework.functions.teams import PARK_COLUMNS, PARK_FACTORS
from slatework.operators import resolve
from slatework.operators.rolling import rolling
from slatework.plans import boards, features, gametables, history, inputs, mart
from slatework.session import stage, stage_path
from slatework.sources import records

define("dt_bat_rolls", BATTER_CONTACT_ROLLS)
define("dt_pit_rolls", PITCHER_CONTACT_ROLLS)
_PROFILE = {
    "barrel_rate": "barrel_rate", "iso": "iso", "hr_per_pa": "hr_per_pa", "hard_hit_rate": "hard_hit_rate",
    "flyball": "fb_rate", "pulled_air": "pulled_air_rate", "ev": "avg_ev", "la": "avg_la", "tb_per_pa": "tb_per_pa",
    "bb_rate": "bb_rate", "k_rate": "k_rate",
}
_ARMS = {"hr9": "hr9", "barrel_rate": "barrel_rate", "hard_hit_rate": "hard_hit_rate", "bb_rate": "bb_rate", "k_rate": "k_rate"}


def _best(stem: str) -> str:
    return "coalesce(" + ", ".join(f"{stem}_roll{w}" for w in (30, 15, 7, 3)) + ")"


_PROFILE_SQL = ", ".join(f"{_best('bat_' + c)} as {n}" for n, c in _PROFILE.items())
_ARM_SQL = ", ".join(f"{_best('pit_' + c)} as arm_{n}" for n, c in _ARMS.items())
_FEATURE = "case {0} when 'AZ' then 'ARI' when 'ATH' then 'OAK' when 'CWS' then 'CHW' when 'WAS' then 'WSH' else {0} end"
_PARKS = "values " + ", ".join(f"('{team}', {', '.join(f'{x}::double' for x in fs)})" for team, fs in PARK_FACTORS.items())
define("dt_park_factors", f"select * from ({_PARKS}) v(park_team, {', '.join(PARK_COLUMNS)})")
_FACTORS = ", ".join(f"coalesce(f.{c}, 1.0) as {c}" for c in PARK_COLUMNS)
_SLOT_GAMES = f"""select l.*, coalesce(temperature_f, 72.0) as temperature_f, wind_mph, weather_wind_out, weather_wind_in, weather_crosswind,
 case when is_home then away_starter_pitcher_id else home_starter_pitcher_id end as opp_pitcher_id, {_FEATURE.format('s.home_team')} as park_team
 from dt_lineups l left join dt_spine s on l.game_pk = s.game_pk"""
define("dt_slot_games", _SLOT_GAMES)
define(
    "dt_history",
    f"""select l.*, {_FACTORS}, {_PROFILE_SQL}, {_ARM_SQL}, greatest(least((temperature_f - 70.0) / 15.0, 2.0), -2.0) as tb,
 wind_mph * weather_wind_out as wo, wind_mph * weather_wind_in as wi, wind_mph * weather_crosswind as cw
 from (select * from dt_slot_games where opp_pitcher_id is not null) l left join dt_park_factors f on l.park_team = f.park_team
 asof left join (select * from dt_bat_rolls qualify row_number() over (partition by batter_id, game_date order by game_pk desc) = 1) b
  on l.player_id = b.batter_id and l.game_date > b.game_date
 asof left join (select * from dt_pit_rolls qualify row_number() over (partition by pitcher_id, game_date order by game_pk desc) = 1) p
  on l.opp_pitcher_id = p.pitcher_id and l.game_date > p.game_date""",
)
_CARRY = "0.08 * tb + 0.018 * wo - 0.022 * wi - 0.006 * cw + 0.60 * (park_hr_factor - 1)"
_HR_DELTA = f"""{_CARRY} + coalesce(flyball, 0) * (0.020 * wo - 0.024 * wi) + 0.45 * coalesce(pulled_air, 0) * (park_hr_factor - 1)
 + 0.12 * coalesce(barrel_rate, 0) * tb + 0.003 * greatest(least(coalesce(la, 12.0), 28), 8)"""
_TB2_BOOST = "0.05 * tb + 0.010 * wo - 0.010 * wi - 0.004 * cw + 0.20 * (park_1b_factor - 1) + 0.50 * (park_2b3b_factor - 1)"
_TB2_DELTA = f"""{_TB2_BOOST} + 0.45 * coalesce(tb_per_pa, 0) * (park_2b3b_factor - 1) + 0.25 * coalesce(hard_hit_rate, 0) * (park_2b3b_factor - 1)
 + 0.20 * coalesce(iso, 0) * (park_hr_factor - 1)"""
_RUN_BOOST = "0.05 * tb + 0.008 * wo - 0.010 * wi - 0.003 * cw + 0.55 * (park_run_factor - 1)"
_RBI_DELTA = f"""{_RUN_BOOST} + 0.40 * coalesce(tb_per_pa, 0) * (park_run_factor - 1) + 0.30 * coalesce(hr_per_pa, 0) * (park_hr_factor - 1)
 + 0.20 * coalesce(bb_rate, 0) * coalesce(arm_bb_rate, 0)"""
_IDS = ["game_pk", "player_id", "batting_order", "opp_pitcher_id"]


def bat_rolls(t: Tables, profile: list[str] = tuple(features.BATTER_PROFILE)) -> DataFrame:
    """Profile of the rolling table; like the game table below it, written once and read by several passes."""
    games = stage(gametables.batter_contact_game(t.dt_flags), "batter_games")
    return stage(features.batter_profile_rolls(games, profile), "batter_rolls")


def pit_rolls(t: Tables) -> DataFrame:
    games = stage(gametables.pitcher_contact_game(t.dt_flags), "pitcher_games")
    return stage(features.pitcher_profile_rolls(games), "pitcher_rolls")


def player_history(t: Tables, reads: tuple[list[str], list[str]] = features.HR_READS) -> DataFrame:
    return features.player_history(t.dt_spine, t.dt_lineups, bat_rolls(t, reads[0]), pit_rolls(t), reads=reads)


def _view_sql(profile: list[str], arms: list[str], boost: tuple[str, str], delta: tuple[str, str]) -> str:
    cols = [r(c) for c in profile] + [r(f"arm_{a}", f"opp_pitcher_{a}") for a in arms]
    cols += [r(c) for c in PARK_COLUMNS] + [r("tb", "env_temp_boost"), r(*boost), r(*delta)]
    return f"select {', '.join(_IDS)}, {', '.join(cols)} from dt_history"


def _view_columns(profile, arms, boost: str, delta: str) -> list[str]:
    return [*_IDS, *profile, *[f"opp_pitcher_{a}" for a in arms], *PARK_COLUMNS, "env_temp_boost", boost, delta]


_HR = (list(_PROFILE), ["hr9", "barrel_rate", "hard_hit_rate", "bb_rate"])
_TB2 = (["tb_per_pa", "iso", "hard_hit_rate", "barrel_rate", "hr_per_pa", "ev", "la"], ["hard_hit_rate", "barrel_rate", "hr9"])
_RBI = (["tb_per_pa", "hr_per_pa", "bb_rate", "hard_hit_rate", "barrel_rate", "iso"], ["bb_rate", "hr9", "hard_hit_rate", "barrel_rate"])


@query("b01_hr_view", _view_sql(*_HR, (_CARRY, "env_hr_carry"), (_HR_DELTA, "hr_weather_delta")))
def _(t: Tables) -> DataFrame:
    return features.hr_view(player_history(t)).select(*_view_columns(*_HR, "env_hr_carry", "hr_weather_delta"))


@query("b02_tb2_view", _view_sql(*_TB2, (_TB2_BOOST, "env_tb2_boost"), (_TB2_DELTA, "tb2_weather_delta")))
def _(t: Tables) -> DataFrame:
    return features.tb2_view(player_history(t, features.TB2_READS)).select(*_view_columns(*_TB2, "env_tb2_boost", "tb2_weather_delta"))


@query("b03_rbi_view", _view_sql(*_RBI, (_RUN_BOOST, "env_run_boost"), (_RBI_DELTA, "rbi_weather_delta")))
def _(t: Tables) -> DataFrame:
    return features.rbi_view(player_history(t, features.RBI_READS)).select(*_view_columns(*_RBI, "env_run_boost", "rbi_weather_delta"))


# Game views use rolling means of the game tables, without a prefix.
_FORM_BAT = [
    "rbi", "tb", "barrel_rate", "hardhit_rate", "ev_mean", "bb_rate", "k_rate",
]
_FORM_PIT = [
    "k_rate", "bb_rate", "hr_rate", "barrel_rate_allowed", "hardhit_rate_allowed", "ev_mean",
]


def _form_sql(source: str, by: str, names: list[str]) -> str:
    cols = ", ".join(f"avg({c}) {over(w, by, 'game_date, game_pk')} as {c}_roll{w}" for w in (7, 15) for c in names)
    return f"select game_pk, game_date, {by}, {cols} from ({source})"


define(
    "dt_bat_form",
    _form_sql(
        f"select *, barrels / pa as barrel_rate, hardhit / pa as hardhit_rate, bb / pa as bb_rate, so / pa as k_rate from ({BATTER_COUNT})",
        "batter_id", _FORM_BAT,
    ),
)
define(
    "dt_pit_form",
    _form_sql(
        f"""select *, so / bf as k_rate, bb / bf as bb_rate, hr_allowed / bf as hr_rate, barrels / bf as barrel_rate_allowed,
        hardhit / bf as hardhit_rate_allowed from ({PITCHER_COUNT})""",
        "pitcher_id", _FORM_PIT,
    ),
)
_LAST = "select * from {0} qualify row_number() over (partition by {1}, game_date order by game_pk desc) = 1"


def _game_form(t: Tables) -> tuple[DataFrame, DataFrame]:
    order, windows = ["game_date", "game_pk"], (7, 15)
    flags = contact_flags(t)
    games = stage(gametables.batter_game(flags), "batter_games")
    bat = rolling(games.select("batter_id", *order, *_FORM_BAT), "batter_id", order, means=_FORM_BAT, windows=windows)
    arms = stage(gametables.pitcher_game(flags), "pitcher_games").withColumn("hr_rate", ratio(F.col("hr_allowed"), F.col("bf")))
    pit = rolling(arms, "pitcher_id", order, means=_FORM_PIT, windows=windows)
    return bat, pit


def _week_form(t: Tables) -> list[DataFrame]:
    """What the winner views read of the form: its shortest window."""
    return [
        form.select(by, "game_date", "game_pk", *[f"{c}_roll7" for c in names])
        for form, by, names in zip(_game_form(t), ("batter_id", "pitcher_id"), (_FORM_BAT, _FORM_PIT))
    ]


def _early_form(t: Tables) -> list[DataFrame]:
    """What the first-inning views read of the form: two weeks of three measures of the hitters."""
    bat, pit = _game_form(t)
    key = ["game_date", "game_pk"]
    return [
        bat.select("batter_id", *key, *[f"{c}_roll15" for c in ("bb_rate", "barrel_rate", "hardhit_rate")]),
        pit.select("pitcher_id", *key, *[f"{c}_roll7" for c in _FORM_PIT], "k_rate_roll15"),
    ]


def _side_cols(side: str, alias: str, names: list[str], label: str, windows=(7, 15)) -> str:
    return ", ".join(f"{alias}.{c}_roll{w} as {side}_{label}_{c}_roll{w}" for w in windows for c in names)


def _game_view_sql(label: str, where: str, count: str) -> str:
    means = ", ".join(f"avg({c}_roll{w}) as {c}_roll{w}" for w in (7, 15) for c in _FORM_BAT)
    form = f"(select l.game_pk, l.team, {means}, count(l.player_id) as {count} from dt_lineups l asof left join last_bat b on l.player_id = b.batter_id and b.game_date <= l.game_date {where} group by all)"
    return f"""select s.*, {_side_cols('home', 'hp', _FORM_PIT, 'sp')}, {_side_cols('away', 'ap', _FORM_PIT, 'sp')},
    {_side_cols('home', 'hf', _FORM_BAT, label)}, {_side_cols('away', 'af', _FORM_BAT, label)}, hf.{count} as home_{label}_{count}, af.{count} as away_{label}_{count}
    from dt_spine s asof left join last_pit hp on hp.pitcher_id = s.home_starter_pitcher_id and hp.game_date <= s.game_date
    asof left join last_pit ap on ap.pitcher_id = s.away_starter_pitcher_id and ap.game_date <= s.game_date
    left join {form} hf on hf.game_pk = s.game_pk and hf.team = s.home_team left join {form} af on af.game_pk = s.game_pk and af.team = s.away_team"""


define("dt_nrfi", f"with last_bat as ({_LAST.format('dt_bat_form', 'batter_id')}), last_pit as ({_LAST.format('dt_pit_form', 'pitcher_id')}) {_game_view_sql('top3', 'where batting_order <= 3', 'top3_count')}")
define("dt_moneyline", f"with last_bat as ({_LAST.format('dt_bat_form', 'batter_id')}), last_pit as ({_LAST.format('dt_pit_form', 'pitcher_id')}) {_game_view_sql('team', '', 'lineup_count')}")
_SP_DIFFS = [f"{c}_roll7" for c in ("k_rate", "bb_rate", "hr_rate", "barrel_rate_allowed", "hardhit_rate_allowed", "ev_mean")]
_OFF_DIFFS = [f"{c}_roll7" for c in ("rbi", "tb", "barrel_rate", "hardhit_rate", "ev_mean", "bb_rate", "k_rate")]
_TOP3 = [f"{s}_top3_{c}_roll15" for s in ("home", "away") for c in ("bb_rate", "barrel_rate", "hardhit_rate")]


@query(
    "b04_nrfi_view",
    f"""select game_pk, home_top3_top3_count, away_top3_top3_count, {', '.join(r(c) for c in _TOP3)}, {r('home_sp_k_rate_roll15')},
    {', '.join(r(f'home_sp_{c} - away_sp_{c}', f'sp_diff_{c}') for c in _SP_DIFFS)} from dt_nrfi""",
)
def _(t: Tables) -> DataFrame:
    view = features.nrfi_view(t.dt_spine, t.dt_lineups, *_early_form(t))
    return view.select(
        "game_pk", "home_top3_top3_count", "away_top3_top3_count", *_TOP3, "home_sp_k_rate_roll15",
        *[f"sp_diff_{c}" for c in _SP_DIFFS],
    )


@query(
    "b05_moneyline_view",
    f"""select game_pk, home_team_lineup_count, away_team_lineup_count, {', '.join(r(f'home_sp_{c} - away_sp_{c}', f'sp_diff_{c}') for c in _SP_DIFFS)},
    {', '.join(r(f'home_team_{c} - away_team_{c}', f'off_diff_{c}') for c in _OFF_DIFFS)} from dt_moneyline""",
)
def _(t: Tables) -> DataFrame:
    view = features.moneyline_view(t.dt_spine, t.dt_lineups, *_week_form(t))
    return view.select(
        "game_pk", "home_team_lineup_count", "away_team_lineup_count", *[f"sp_diff_{c}" for c in _SP_DIFFS],
        *[f"off_diff_{c}" for c in _OFF_DIFFS],
    )


_FILLS = {
    "barrel_rate": 0.055, "iso": 0.155, "hr_per_pa": 0.028, "hard_hit_rate": 0.38, "flyball": 0.35, "pulled_air": 0.11,
    "ev": 89.0, "la": 13.0, "arm_hr9": 1.10, "arm_barrel_rate": 0.08, "arm_hard_hit_rate": 0.40, "arm_bb_rate": 0.08,
    "arm_k_rate": 0.22,
}


def _fill(names: dict[str, float]) -> str:
    return ", ".join(f"coalesce({n}, median({n}) over (partition by game_date), {v}::double) as {n}" for n, v in names.items())


def _clip(value: str, low, high) -> str:
    return f"greatest(least({value}, {high}), {low})"


define(
    "dt_profiles",
    f"""select l.*, {_FACTORS}, {_PROFILE_SQL}, {_ARM_SQL}, {_clip('(temperature_f - 70.0) / 15.0', -2.0, 2.0)} as tb,
 wind_mph * weather_wind_out as wo, wind_mph * weather_wind_in as wi, wind_mph * weather_crosswind as cw
 from dt_slot_games l left join dt_park_factors f on l.park_team = f.park_team
 asof left join ({_LAST.format('dt_bat_rolls', 'batter_id')}) b on l.player_id = b.batter_id and b.game_date < l.game_date
 asof left join ({_LAST.format('dt_pit_rolls', 'pitcher_id')}) p on l.opp_pitcher_id = p.pitcher_id and p.game_date < l.game_date""",
)
_NEUTRAL = f"""6.2 * barrel_rate + 2.4 * iso + 9.0 * hr_per_pa + 1.4 * hard_hit_rate + 1.1 * flyball + 0.9 * pulled_air
 + 0.06 * {_clip('ev - 88', -5, 10)} + 0.03 * {_clip('la - 12', -10, 18)}
 + 0.55 * arm_hr9 + 3.5 * arm_barrel_rate + 1.4 * arm_hard_hit_rate + 0.35 * arm_bb_rate - 0.90 * arm_k_rate
 + case when batting_order <= 2 then 0.08 when batting_order = 3 then 0.14 when batting_order = 4 then 0.16 when batting_order = 5 then 0.08
   when batting_order = 7 then -0.10 when batting_order >= 8 then -0.18 else 0 end"""
_ENV = f"""tb * (0.020 + 0.18 * barrel_rate) + wo * (0.006 + 0.030 * flyball + 0.018 * pulled_air) - wi * (0.008 + 0.032 * flyball)
 - cw * (0.002 + 0.010 * flyball) + (park_hr_factor - 1) * (0.35 + 0.60 * flyball + 0.55 * pulled_air + 0.75 * barrel_rate)
 + 0.10 * (park_run_factor - 1) + 0.18 * hard_hit_rate * (park_hr_factor - 1) + 0.01 * {_clip('ev - 90', -8, 10)} + 0.006 * {_clip('la - 14', -10, 18)}"""
_SLOT_PA = "case batting_order when 1 then 4.85 when 2 then 4.70 when 3 then 4.60 when 4 then 4.50 when 5 then 4.35 when 6 then 4.20 when 7 then 4.05 when 8 then 3.95 when 9 then 3.85 else 4.15 end::double"
define(
    "dt_expected",
    f"""select *, p0 * epa as e_neutral, {_clip('p0 * (1 + env)', 0.0005, 0.35)} as p1, {_clip('p0 * (1 + env)', 0.0005, 0.35)} * epa as e_today from (
 select *, 1 / (1 + exp(-({_clip('-5.10 + 0.33 * neutral', -20, 20)}))) as p0 from (
 select *, {_NEUTRAL} as neutral, {_ENV} as env, {_SLOT_PA} as epa from (
 select * replace ({_fill(_FILLS)}) from dt_profiles)))""",
)


def _expectation(t: Tables, keep: list[str]) -> DataFrame:
    return features.hr_expectation(t.dt_spine, t.dt_lineups, bat_rolls(t), pit_rolls(t), keep)


@query(
    "b06_player_hr_expectation",
    f"""select game_pk, player_id, batting_order, {r('neutral', 'neutral_hr_score')}, {r('p0', 'p_hr_neutral_pa')}, {r('env', 'env_hr_delta_player')},
    {r('p1', 'p_hr_today_pa')}, {r('epa', 'expected_pa')}, {r('e_neutral', 'expected_hr_neutral_player')}, {r('e_today', 'expected_hr_today_player')} from dt_expected""",
)
def _(t: Tables) -> DataFrame:
    return _expectation(t, ["game_pk", "player_id", "batting_order"]).select(
        "game_pk", "player_id", "batting_order", "neutral_hr_score", "p_hr_neutral_pa", "env_hr_delta_player",
        "p_hr_today_pa", "expected_pa", "expected_hr_neutral_player", "expected_hr_today_player",
    )


_TEAM_SUM = "(select game_pk, is_home, count(player_name) as n, sum(e_neutral) as en, sum(e_today) as et, avg(iso) as iso from dt_expected group by all)"


@query(
    "b07_no_hr_view",
    f"""select game_pk, {r('en', 'expected_hr_neutral')}, {r('et', 'expected_hr_today')}, {r('et - en', 'env_hr_delta')}, {r('adj', 'expected_hr_today_adj')},
    {r('exp(-greatest(least(adj, 6.0), 0.02))', 'p_no_hr_game_est')}, {r('home_iso', 'home_avg_iso')} from (
    select s.game_pk, h.en + a.en as en, h.et + a.et as et, h.iso as home_iso, greatest(h.et + a.et + case when h.n < 7 then 0.08 else 0 end + case when a.n < 7 then 0.08 else 0 end
     + case when home_starter_pitcher_id is null then 0.05 else 0 end + case when away_starter_pitcher_id is null then 0.05 else 0 end, 0.02) as adj
    from dt_spine s left join {_TEAM_SUM} h on h.game_pk = s.game_pk and h.is_home left join {_TEAM_SUM} a on a.game_pk = s.game_pk and not a.is_home)""",
)
def _(t: Tables) -> DataFrame:
    return features.no_hr_view(t.dt_spine, _expectation(t, ["game_pk", "team", "player_name"])).select(
        "game_pk", "expected_hr_neutral", "expected_hr_today", "env_hr_delta", "expected_hr_today_adj",
        "p_no_hr_game_est", "home_avg_iso",
    )


_MATCHUPS = {
    "matchup_hit_rate_diff": "b.hit_rate_roll30 - p.hit_rate_roll30", "matchup_hr_rate_diff": "b.hr_rate_roll30 - p.hr_rate_roll30",
    "matchup_bb_rate_diff": "b.bb_rate_roll30 - p.bb_rate_roll30", "matchup_k_pressure_diff": "b.so_rate_roll30 - p.k_rate_roll30",
    "matchup_hr_pressure_x": "b.hr_rate_roll30 * p.hr_rate_roll30", "matchup_hit_pressure_x": "b.hit_rate_roll30 * p.hit_rate_roll30",
    "matchup_walk_pressure_x": "b.bb_rate_roll30 * p.bb_rate_roll30", "matchup_k_pressure_x": "b.so_rate_roll30 * p.k_rate_roll30",
}


def build_mart(t: Tables) -> DataFrame:
    games = stage(gametables.batter_flag_game(t.dt_flags), "batter_games")
    batters = gametables.add_flag_batter_rolls(games)
    pitchers = gametables.add_flag_pitcher_rolls(stage(gametables.pitcher_flag_game(t.dt_flags), "pitcher_games"))
    return mart.build_mart(t.dt_flags, batters, pitchers)


@query(
    "b08_outcome_mart",
    f"""select f.game_date, f.season, f.game_pk, f.pa_index, f.batter_id, f.pitcher_id, f.inning, f.event_type, length(base_state_before)::bigint as base_runner_count,
    case when event_type in ('home_run', 'triple', 'double', 'single') then event_type when event_type in ('walk', 'hit_by_pitch') then 'walk_hbp' else 'out' end as pa_outcome_target,
    {r('b.hit_rate_roll7', 'bat_hit_rate_roll7')}, {r('p.k_rate_roll15', 'pit_k_rate_roll15')}, {', '.join(r(e, n) for n, e in _MATCHUPS.items())}
    from dt_flags f left join ({BATTER_FLAG_ROLLS}) b on f.game_pk = b.game_pk and f.batter_id = b.batter_id
    left join ({PITCHER_FLAG_ROLLS}) p on f.game_pk = p.game_pk and f.pitcher_id = p.pitcher_id""",
)
def _(t: Tables) -> DataFrame:
    return build_mart(t).select(
        "game_date", "season", "game_pk", "pa_index", "batter_id", "pitcher_id", "inning", "event_type",
        "base_runner_count", "pa_outcome_target", "bat_hit_rate_roll7", "pit_k_rate_roll15", *_MATCHUPS,
    )


def _board_sql(fills: dict[str, float], score: str, raw: str, prob: str, a: float, b: float, low: float, high: float) -> str:
    return f"""select game_date, rank, team, opponent, player_name, {r('s', raw)}, {r('p', prob)}, confidence from (
    select *, row_number() over (partition by game_date order by z + tie_break_noise / 1000 desc, p desc, player_name, team) as rank from (
    select *, {_clip(f'1 / (1 + exp(-({a} + {b} * z)))', low, high)} as p, {Z_BANDS} as confidence from (
    select *, {zscore('s', 'game_date', 3.0)} as z from (
    select *, {score} as s from (select * replace ({_fill(fills)}), coalesce(lineup_weight::double, 1.0) as w,
     hr_delta, tb2_delta, rbi_delta from (select * exclude (team, opponent), {_FEATURE.format('team')} as team, {_FEATURE.format('opponent')} as opponent,
     {_HR_DELTA} as hr_delta, {_TB2_DELTA} as tb2_delta, {_RBI_DELTA} as rbi_delta from dt_history)))))) where rank <= 25"""


_BOARD_FILLS = {
    **{k: v for k, v in _FILLS.items() if k not in ("arm_k_rate",)}, "hr_per_pa": 0.025, "pulled_air": 0.10,
    "tb_per_pa": 0.45, "bb_rate": 0.08, "k_rate": 0.22,
}
_HR_SCORE = f"""(2.20 * barrel_rate + 1.50 * iso + 1.80 * hr_per_pa + 0.90 * hard_hit_rate + 0.020 * greatest(ev - 88, 0) + 0.010 * {_clip('la - 12', -10, 18)}
 + 0.35 * arm_hr9 + 0.55 * arm_barrel_rate + 0.40 * arm_hard_hit_rate + 0.06 * arm_bb_rate + hr_delta)
 * case when batting_order <= 2 then 1.02 when batting_order = 3 then 1.05 when batting_order = 4 then 1.07 when batting_order = 5 then 1.03
   when batting_order = 7 then 0.92 when batting_order = 8 then 0.92 * 0.84 when batting_order >= 9 then 0.92 * 0.84 * 0.76 else 1.0 end
 * {_clip('w', 0.80, 1.15)} * case when barrel_rate >= 0.055 or iso >= 0.150 or hr_per_pa >= 0.022 then 1.0 else 0.92 end
 - (case when barrel_rate < 0.050 then 0.08 else 0 end + case when iso < 0.140 then 0.06 else 0 end + case when hard_hit_rate < 0.34 then 0.05 else 0 end)
 + (case when barrel_rate >= 0.12 then 0.18 else 0 end + case when iso >= 0.25 then 0.14 else 0 end + case when hr_per_pa >= 0.050 then 0.14 else 0 end)"""


def _bonus(two, three, four, five, late, other) -> str:
    return f"case when batting_order <= 2 then {two} when batting_order = 3 then {three} when batting_order = 4 then {four} when batting_order = 5 then {five} when batting_order >= 8 then {late} else {other} end"


_TB2_SCORE = f"""(1.80 * tb_per_pa + 0.80 * iso + 0.70 * hard_hit_rate + 0.30 * barrel_rate + 0.35 * {_clip('(ev - 88) / 10', -1.5, 1.5)}
 + 0.15 * {_clip('(la - 12) / 12', -1.5, 1.5)} + 0.20 * arm_hard_hit_rate + 0.15 * arm_barrel_rate + 0.12 * arm_hr9 + tb2_delta
 + {_bonus(0.05, 0.10, 0.12, 0.08, -0.12, 0.0)}) * {_clip('w', 0.82, 1.15)}"""
_RBI_SCORE = f"""(1.40 * tb_per_pa + 1.00 * hr_per_pa + 0.50 * hard_hit_rate + 0.30 * bb_rate + 0.22 * arm_bb_rate + 0.28 * arm_hr9
 + 0.18 * arm_hard_hit_rate + 0.18 * arm_barrel_rate + rbi_delta + {_bonus(0.0, 0.16, 0.20, 0.10, -0.18, -0.04)}) * {_clip('w', 0.82, 1.15)}"""


def _staged_view(view: DataFrame, label: str, board: boards.PlayerBoard | None = None) -> DataFrame:
    """A view for its board, written without the columns that its features were made of, or with what ``board`` reads."""
    if board is not None:
        return stage(view.select(*boards.columns_read(view, board)), label)
    sources = ("bat_", "opp_pit_", "env_", "park_", "weather_")
    return stage(view.drop(*[c for c in view.columns if c.startswith(sources)]), label)


@query("b09_hr_board", _board_sql(_BOARD_FILLS, _HR_SCORE, "hr_score_raw", "p_hr", -2.05, 0.72, 0.05, 0.24))
def _(t: Tables) -> DataFrame:
    return boards.hr_board(_staged_view(features.hr_view(player_history(t)), "hr_view", boards.HR_BOARD))


@query("b10_tb2_board", _board_sql(_BOARD_FILLS, _TB2_SCORE, "tb2_score_raw", "p_tb2", -0.72, 0.82, 0.15, 0.78))
def _(t: Tables) -> DataFrame:
    return boards.tb2_board(_staged_view(features.tb2_view(player_history(t, features.TB2_READS)), "tb2_view", boards.TB2_BOARD))


@query("b11_rbi_board", _board_sql(_BOARD_FILLS, _RBI_SCORE, "rbi_score_raw", "p_rbi", -0.95, 0.78, 0.12, 0.75))
def _(t: Tables) -> DataFrame:
    return boards.rbi_board(_staged_view(features.rbi_view(player_history(t, features.RBI_READS)), "rbi_view", boards.RBI_BOARD))


def _weights(weights: dict[str, float], penalty: float) -> str:
    terms = " + ".join(f"{w} * coalesce({c}, 0)" for c, w in weights.items())
    return f"{terms} - case when home_starter_pitcher_id is null or away_starter_pitcher_id is null then {penalty} else 0 end"


_NRFI_W = {
    f"{side}_{c}": w
    for side in ("home", "away")
    for c, w in {
        "sp_k_rate_roll7": 0.55, "sp_bb_rate_roll7": -0.45, "sp_hr_rate_roll7": -0.50, "sp_barrel_rate_allowed_roll7": -0.45,
        "sp_hardhit_rate_allowed_roll7": -0.35, "top3_bb_rate_roll15": -0.25, "top3_barrel_rate_roll15": -0.30,
        "top3_hardhit_rate_roll15": -0.25,
    }.items()
}
_BANDS = "case when q <= 0.52 then 'C' when q <= {0} then 'B-' when q <= {1} then 'B+' when q <= {2} then 'A' else 'A+' end"


@query(
    "b12_nrfi_board",
    f"""select game_pk, game_date, away_team, home_team, {r('z', 'nrfi_score_raw')}, {r('p', 'nrfi_prob')}, {r('1 - p', 'yrfi_prob')},
    case when p >= 0.5 then 'NRFI' else 'YRFI' end as pick, {_BANDS.format(0.55, 0.58, 0.61)} as confidence from (select *, greatest(p, 1 - p) as q from (
    select *, {_clip('0.5 + (1 / (1 + exp(-0.72 * z)) - 0.5) * 0.58', 0.32, 0.68)} as p from (
    select *, {zscore('s', 'game_date', 2.5)} as z from (
    select *, {_weights({**_NRFI_W, 'weather_wind_out': -0.08, 'weather_wind_in': 0.04, 'temperature_f': -0.0015}, 0.20)} as s from dt_nrfi))))""",
)
def _(t: Tables) -> DataFrame:
    view = stage(features.nrfi_view(t.dt_spine, t.dt_lineups, *_early_form(t)), "nrfi_view")
    return boards.nrfi_board(view)


_ML_W = {
    **{f"(home_sp_{c}_roll7 - away_sp_{c}_roll7)": w for c, w in (("k_rate", 0.55), ("bb_rate", -0.45), ("hr_rate", -0.50), ("barrel_rate_allowed", -0.45), ("hardhit_rate_allowed", -0.35))},
    **{f"(home_team_{c}_roll7 - away_team_{c}_roll7)": w for c, w in (("rbi", 0.30), ("tb", 0.32), ("barrel_rate", 0.28), ("hardhit_rate", 0.22), ("ev_mean", 0.015), ("bb_rate", 0.10), ("k_rate", -0.12))},
    "weather_wind_out": -0.03, "weather_wind_in": 0.02, "temperature_f": 0.001,
}


@query(
    "b13_moneyline_board",
    f"""select game_pk, game_date, away_team, home_team, {r('z', 'home_win_score_raw')}, {r('p', 'home_win_prob')}, {r('1 - p', 'away_win_prob')},
    case when p >= 0.5 then 'HOME' else 'AWAY' end as pick, {_BANDS.format(0.55, 0.58, 0.62)} as confidence from (select *, greatest(p, 1 - p) as q from (
    select *, 1 / (1 + exp(-1.10 * z)) as p from (select *, {zscore('s', 'game_date', None, 'stddev_samp')} as z from (
    select *, {_weights(_ML_W, 0.25)} as s from dt_moneyline))))""",
)
def _(t: Tables) -> DataFrame:
    view = stage(features.moneyline_view(t.dt_spine, t.dt_lineups, *_week_form(t)), "moneyline_view")
    return boards.moneyline_board(view)


_GAPS = """select game_pk, game_date, away_team, home_team, home_starter_pitcher_id, away_starter_pitcher_id,
 case when day(game_date) = 1 or game_pk % 7 = 0 then null else 0.5 + game_pk % 10 / 10.0 end::double as n,
 case when day(game_date) = 2 or game_pk % 5 = 0 then null else 0.6 + game_pk % 9 / 10.0 end::double as t,
 case when day(game_date) = 3 or game_pk % 3 = 0 then null else 0.7 + game_pk % 8 / 10.0 end::double as a,
 case when game_pk % 2 = 0 then exp(-(0.7 + game_pk % 8 / 10.0)) end as e from dt_spine"""
_MED = "median({0}) over (partition by game_date)"
_NO_HR_SQL = f"""with g as ({_GAPS}), m as (select *, {_MED.format('n')} as mn, {_MED.format('t')} as mt, {_MED.format('a')} as ma from g),
 f as (select *, coalesce(n, mn, 0.90) as fn from m), h as (select *, case when mt is null then fn else coalesce(t, mt) end as ft from f),
 k as (select *, case when ma is null then greatest(ft + case when home_starter_pitcher_id is null then 0.05 else 0 end + case when away_starter_pitcher_id is null then 0.05 else 0 end, 0.02)
  else coalesce(a, ma) end as fa from h), z as (select *, {zscore('(-fa)', 'game_date', None)} as z from k),
 p as (select *, {_clip("0.78 * coalesce(e, exp(-greatest(least(fa, 6.0), 0.02))) + 0.22 / (1 + exp(-0.90 * z))", 0.02, 0.98)} as p from z)
 select game_pk, game_date, away_team, home_team, {r('fn', 'expected_hr_neutral')}, {r('ft', 'expected_hr_today')}, {r('ft - fn', 'env_hr_delta')},
 {r('fa', 'expected_hr_today_adj')}, {r('-fa', 'no_hr_game_score_raw')}, {r('p', 'p_no_hr_game')}, {r('1 - p', 'p_yes_hr_game')},
 case when p >= 0.5 then 'NO_HR' else 'HR_YES' end as pick, {_BANDS.format(0.58, 0.66, 0.75)} as confidence from (select *, greatest(p, 1 - p) as q from p)"""


@query("b14_no_hr_board", _NO_HR_SQL)
def _(t: Tables) -> DataFrame:
    """Gaps of single games and of whole slates are repaired first."""
    pk, day = F.col("game_pk"), F.day("game_date")

    def gap(slate: int, every: int, base: float, spread: int):
        value = base + (pk % spread).cast("double") / 10.0
        return F.when((day != slate) & (pk % every != 0), value)

    view = t.dt_spine.withColumns(
        {
            "expected_hr_neutral": gap(1, 7, 0.5, 10),
            "expected_hr_today": gap(2, 5, 0.6, 9),
            "expected_hr_today_adj": gap(3, 3, 0.7, 8),
            "p_no_hr_game_est": F.when(pk % 2 == 0, F.exp(-(0.7 + (pk % 8).cast("double") / 10.0))),
        }
    )
    return boards.no_hr_board(view)


_IDS_SQL = """(select game_pk, team, string_agg(cast(player_id as varchar), ',' order by batting_order) as ids from {0}
 where player_id is not null group by all having count(*) >= 9)"""
_CHOSEN = f"""(select game_pk, team, coalesce(c.ids, p.ids) as ids, case when c.ids is not null then 'confirmed' else 'projected' end as src
 from {_IDS_SQL.format('dt_confirmed')} c full join {_IDS_SQL.format('dt_projected')} p using (game_pk, team))"""


@query(
    "b15_slate_selection",
    f"""select s.game_pk, s.game_date, s.away_team, s.home_team, a.ids as away_batters, h.ids as home_batters, ap.pitcher_id as away_pitcher_id,
    hp.pitcher_id as home_pitcher_id, a.src as away_lineup_source, h.src as home_lineup_source from dt_spine s
    join {_CHOSEN} a on a.game_pk = s.game_pk and a.team = s.away_team join {_CHOSEN} h on h.game_pk = s.game_pk and h.team = s.home_team
    join dt_starters ap on ap.game_pk = s.game_pk and ap.team = s.away_team and ap.pitcher_id is not null
    join dt_starters hp on hp.game_pk = s.game_pk and hp.team = s.home_team and hp.pitcher_id is not null""",
)
def _(t: Tables) -> DataFrame:
    t.deal_games()
    return inputs.slate_games(t.dt_spine, t.dt_projected, t.dt_confirmed, t.dt_starters)


@query(
    "b16_lineup_by_rows",
    """select game_pk, team, case when game_pk % 3 = 0 then 'projected' else 'confirmed' end as lineup_source, count(*) as n_rows
    from dt_projected group by game_pk, team""",
)
def _(t: Tables) -> DataFrame:
    known = t.dt_confirmed.filter("player_id is not null")
    return inputs.choose_by_rows(t.dt_projected, known)


_CUTOFF = "date '2000-01-01'"


@query(
    "b17_pregame_inputs",
    f"""with rolls as (select batter_id, game_date, game_pk, avg(pa) {over(7, 'batter_id', 'game_date, game_pk')} as v from ({BATTER_COUNT})),
    a as (select batter_id, max_by(v, (game_date, game_pk)) as v from rolls where game_date < {_CUTOFF} and v > 1.0 group by 1),
    b as (select batter_id, max_by(v, (game_date, game_pk)) as v from rolls where game_date < {_CUTOFF} and v is not null group by 1)
    select l.game_pk, l.batting_order as lineup_slot, l.player_id as batter_id, {r('case when a.batter_id is not null then a.v else b.v end', 'bat_pa_roll7')},
    case when a.batter_id is not null then 'rolling' when b.batter_id is not null then 'mart_fallback' end as _source
    from dt_lineups l left join a on a.batter_id = l.player_id left join b on b.batter_id = l.player_id""",
)
def _(t: Tables) -> DataFrame:
    """The rolling source knows batters with more than one appearance per game, the mart all with a past."""
    games = gametables.batter_game(contact_flags(t)).select("batter_id", "game_date", "game_pk", "pa")
    rolls = rolling(games, "batter_id", ["game_date", "game_pk"], means=["pa"], windows=(7,), name="bat_{col}_roll{w}")
    rolls = stage(rolls, "batter_rolls")
    slots = t.dt_lineups.select("game_pk", F.col("batting_order").alias("lineup_slot"), F.col("player_id").alias("batter_id"))
    first, second = rolls.filter("bat_pa_roll7 > 1.0"), rolls.filter("bat_pa_roll7 is not null")
    return inputs.batter_inputs(slots, first, second, F.lit("2000-01-01").cast("date"), ["game_pk"])


@query(
    "b17_pregame_pitchers",
    f"""with rolls as (select pitcher_id, game_date, game_pk, avg(bf) {over(7, 'pitcher_id', 'game_date, game_pk')} as v from ({PITCHER_COUNT})),
    a as (select pitcher_id, max_by(v, (game_date, game_pk)) as v from rolls where game_date < {_CUTOFF} and v > 1.0 group by 1),
    b as (select pitcher_id, max_by(v, (game_date, game_pk)) as v from rolls where game_date < {_CUTOFF} and v is not null group by 1)
    select s.game_pk, s.is_home, s.pitcher_id, {r('case when a.pitcher_id is not null then a.v else b.v end', 'pit_bf_roll7')},
    case when a.pitcher_id is not null then 'rolling' when b.pitcher_id is not null then 'mart_fallback' end as _source
    from dt_starters s left join a on a.pitcher_id = s.pitcher_id left join b on b.pitcher_id = s.pitcher_id""",
)
def _(t: Tables) -> DataFrame:
    """Starters with the latest earlier workload; sources as for the batters."""
    games = gametables.pitcher_game(contact_flags(t)).select("pitcher_id", "game_date", "game_pk", "bf")
    rolls = rolling(games, "pitcher_id", ["game_date", "game_pk"], means=["bf"], windows=(7,), name="pit_{col}_roll{w}")
    rolls = stage(rolls, "pitcher_rolls")
    starters = t.dt_starters.select("game_pk", "is_home", "pitcher_id")
    first, second = rolls.filter("pit_bf_roll7 > 1.0"), rolls.filter("pit_bf_roll7 is not null")
    return inputs.pitcher_inputs(starters, first, second, F.lit("2000-01-01").cast("date"), ["game_pk"])


_B18_SQL = f"""select l_orderkey as game_pk, l_linenumber::bigint as pa_index, 1998::bigint as season, l_partkey as batter_id, l_suppkey as pitcher_id, {EVENT_SQL} as event_type,
    {EVENT_SQL} in ('single', 'double', 'triple', 'home_run') as is_hit, cast(l_shipdate as date) as game_date, 'statcast' as source
    from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in LINE_KEY[1:])}) = 1"""
_B18_COLUMNS = ["game_pk", "pa_index", "season", "batter_id", "pitcher_id", "event_type", "is_hit", "game_date", "source"]


def _pitches(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("game_pk"), F.col("l_linenumber").alias("at_bat_number"), F.col("l_partkey").alias("batter"),
        F.col("l_suppkey").alias("pitcher"), F.upper(F.expr(EVENT_SQL)).alias("events"), F.col("l_shipdate").alias("game_date"),
        *LINE_KEY[1:],
    )


@query("b18_pitches_to_plate_appearances", _B18_SQL)
def _(t: Tables) -> DataFrame:
    return history.season_pas(_pitches(t), 1998, LINE_KEY[1:]).select(*_B18_COLUMNS)


@query("b18_restartable_rebuild", _B18_SQL)
def _(t: Tables) -> DataFrame:
    """By chunks in two runs: the second finds one chunk changed and one added, and reads those alone."""
    source, target = stage_path(t.spark, "pitches"), stage_path(t.spark, "season")
    dealt = _pitches(t).withColumn("month", F.pmod(F.xxhash64("batter"), F.lit(4)))
    dealt.filter("month < 2 or month = 2 and batter % 2 = 0").write.partitionBy("month").parquet(source)
    history.rebuild_season(t.spark, source, target, 1998, LINE_KEY[1:])
    dealt.filter("month > 2 or month = 2 and batter % 2 = 1").write.mode("append").partitionBy("month").parquet(source)
    rebuilt, chunks = history.rebuild_season(t.spark, source, target, 1998, LINE_KEY[1:])
    if chunks != ["2", "3"]:
        raise AssertionError(f"chunks built: {chunks}")
    return rebuilt.select(*_B18_COLUMNS)


@query(
    "b19_contact_enrichment",
    f"""select p.game_pk, p.pa_index, p.batter_id, p.game_date, {r('d.launch_speed_sc', 'launch_speed')}, {r('d.launch_angle_sc', 'launch_angle')},
    d.bb_type_sc as bb_type, d.bbe_sc, {r('d.barrels_sc / nullif(d.bbe_sc, 0)', 'barrel_rate_sc')}
    from dt_pa p left join ({CONTACT_DAY}) d on p.game_date = d.game_date and p.batter_id = d.batter_id""",
)
def _(t: Tables) -> DataFrame:
    return history.enrich_pas(t.dt_pa, contact_day(t)).select(
        "game_pk", "pa_index", "batter_id", "game_date", "launch_speed", "launch_angle", "bb_type", "bbe_sc", "barrel_rate_sc"
    )


def _typed(kind: str, key: str) -> str:
    return f"select key as lookup_key, '{kind}' as lookup_type, team, id as player_id, 'historical_statcast_name_lookup' as resolution_source, 1::bigint as id_variant_count from ({lookup_sql(key)})"


@query(
    "b20_player_lookup",
    f"with keyed as ({KEYED}) {_typed('exact_full_name', 'k')} union all {_typed('initial_last_team', 'init_k')} union all {_typed('last_name_team', 'last_k')}",
)
def _(t: Tables) -> DataFrame:
    people = t.dt_people.select(F.col("person_id").alias("player_id"), F.col("name").alias("player_name"), "team")
    return resolve.build_lookup([people, people], "player_id")


_KEEP_KEYED = KEYED.replace(KEY_SQL, KEEP_SQL)


def _plain(kind: str, key: str, team: str = "team") -> str:
    return f"select {key} as lookup_key, '{kind}' as lookup_type, {team} as team, person_id as pitcher_id from kept where {key} is not null"


@query(
    "b21_master_lookup",
    f"""with keyed as ({KEYED}), kept as ({_KEEP_KEYED}) select distinct * from (
    select lookup_key, lookup_type, team, player_id as pitcher_id from ({_typed('exact_full_name', 'k')} union all {_typed('initial_last_team', 'init_k')}
     union all {_typed('last_name_team', 'last_k')}) union all {_plain('exact_full_name', 'k')} union all {_plain('exact_global', 'k', 'cast(null as varchar)')}
    union all {_plain('initial_last_team', 'init_k')} union all {_plain('last_name_team', 'last_k')})""",
)
def _(t: Tables) -> DataFrame:
    history_table = t.dt_people.select(F.col("person_id").alias("pitcher_id"), "name", F.upper("team").alias("team"))
    named = t.dt_people.select(F.col("person_id").alias("pitcher_id"), F.col("name").alias("player_name"), "team")
    lookup = resolve.build_lookup([named], "pitcher_id")
    return resolve.master_lookup(lookup, [history_table, history_table])


@query(
    "b22_confirmed_lineup_table",
    """select game_pk, case when game_pk % 2 = 0 then cast(game_date as varchar) else '2001-07-04' end as game_date, 2001::bigint as season, team, opponent, is_home,
    'confirmed' as lineup_status, 'rotowire' as source, batting_order, player_id, player_name, cast(null as varchar) as handedness_bat, cast(null as varchar) as handedness_throw,
    cast(null as varchar) as position, true as is_starting_lineup, game_pk as rotowire_id from dt_confirmed where player_id is not null""",
)
def _(t: Tables) -> DataFrame:
    raw = t.dt_confirmed.select(
        "game_pk", F.when(F.col("game_pk") % 2 == 0, F.col("game_date").cast("string")).alias("game_date"), "team", "opponent",
        "is_home", F.col("batting_order").cast("string").alias("lineup_slot"), "player_id",
        F.when(F.col("player_id").isNotNull(), F.concat("player_name", F.lit("  "))).alias("player_name"),
        F.col("game_pk").cast("double").alias("rotowire_id"),
    )
    return records.confirmed_lineups(raw, 2001, "2001-07-04").drop("source_pull_ts")
