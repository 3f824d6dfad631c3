"""Plate appearances to entity-game and entity-day tables, and their rollings.

Aggregates are plain hash aggregates, so a hot entity is combined in the map
tasks before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.functions.coerce import flag_int_of, flag_of, int_of, null_of, num_of, ratio
from slatework.functions.events import barrel, hard_hit, total_bases
from slatework.functions.teams import CONTACT, team_code
from slatework.operators.rolling import WINDOWS, over_previous, rolling, rolling_ratios
from slatework.operators.shape import (
    derive_if_empty,
    pick,
    pick_column,
    rename_missing,
    with_numeric,
)

FLAGS = [
    "is_pa", "is_ab", "is_hit", "is_1b", "is_2b", "is_3b", "is_hr", "is_bb", "is_hbp", "is_so",
    "is_rbi", "is_sac_fly", "is_reached_on_error",
]


def _sum(name: str) -> Column:
    return F.sum(name)


def _max_of(df: DataFrame, name: str) -> Column:
    return F.max(name) if name in df.columns else F.max(F.lit(None).cast("string"))


def base_columns(pa: DataFrame) -> DataFrame:
    """Keys required; flags 0 and speed/angle 0.0 where missing; total bases derived."""
    for key in ("game_pk", "game_date", "batter_id", "pitcher_id"):
        pick(pa.columns, [key], required=True)
    flags = [
        "is_hit", "is_hr", "is_rbi", "is_bb", "is_so", "is_barrel", "is_hard_hit", "is_1b", "is_2b",
        "is_3b",
    ]
    have = set(pa.columns)
    zero = F.lit(0).cast("bigint")
    out = pa.withColumns(
        {f: F.coalesce(num_of(pa, f).cast("bigint"), zero) if f in have else zero for f in flags}
    )
    out = with_numeric(out, ["launch_speed", "launch_angle"], 0.0)
    if "total_bases" in have:
        return with_numeric(out, ["total_bases"], 0.0)
    hits = [F.col(c) for c in ("is_1b", "is_2b", "is_3b", "is_hr")]
    return out.withColumn("total_bases", total_bases(*hits))


def batter_game(pa: DataFrame) -> DataFrame:
    """Batter-game table; denominators count rows with an id, missing speed is 0."""
    df = base_columns(pa)
    grouped = df.groupBy("game_pk", "game_date", "batter_id").agg(
        _max_of(df, "batter_name").alias("batter_name"),
        F.count("batter_id").alias("pa"),
        _sum("is_hit").alias("hits"),
        _sum("is_hr").alias("hr"),
        _sum("is_rbi").alias("rbi"),
        _sum("total_bases").alias("tb"),
        F.avg("launch_speed").alias("ev_mean"),
        F.max("launch_speed").alias("ev_max"),
        F.avg("launch_angle").alias("la_mean"),
        _sum("is_barrel").alias("barrels"),
        _sum("is_hard_hit").alias("hardhit"),
        _sum("is_bb").alias("bb"),
        _sum("is_so").alias("so"),
    )
    rates = {"barrel_rate": "barrels", "hardhit_rate": "hardhit", "k_rate": "so", "bb_rate": "bb"}
    return grouped.withColumns({r: ratio(F.col(n), F.col("pa")) for r, n in rates.items()})


def pitcher_game(pa: DataFrame) -> DataFrame:
    """Pitcher-game table, the counterpart of ``batter_game``."""
    df = base_columns(pa)
    grouped = df.groupBy("game_pk", "game_date", "pitcher_id").agg(
        _max_of(df, "pitcher_name").alias("pitcher_name"),
        F.count("pitcher_id").alias("bf"),
        _sum("is_hit").alias("hits_allowed"),
        _sum("is_hr").alias("hr_allowed"),
        _sum("is_bb").alias("bb"),
        _sum("is_so").alias("so"),
        F.avg("launch_speed").alias("ev_mean"),
        F.max("launch_speed").alias("ev_max"),
        _sum("is_barrel").alias("barrels"),
        _sum("is_hard_hit").alias("hardhit"),
    )
    rates = {
        "barrel_rate_allowed": "barrels",
        "hardhit_rate_allowed": "hardhit",
        "k_rate": "so",
        "bb_rate": "bb",
    }
    return grouped.withColumns({r: ratio(F.col(n), F.col("bf")) for r, n in rates.items()})


def _contact(pa: DataFrame) -> DataFrame:
    """Speed, angle and contact events with missing values left null."""

    def measured(names: list[str]) -> Column:
        name = pick(pa.columns, names)
        return num_of(pa, name) if name else null_of("double")

    speed = measured(["launch_speed", "launch_speed_angle", "hit_speed"])
    angle = measured(["launch_angle", "hit_angle"])
    return pa.withColumns(
        {
            "_speed": speed,
            "_angle": angle,
            "_barrel": barrel(speed, angle).cast("bigint"),
            "_hard": hard_hit(speed).cast("bigint"),
        }
    )


def _flag_or_zero(df: DataFrame, name: str) -> Column:
    return flag_int_of(df, name) if name in df.columns else F.lit(0).cast("bigint")


def _label(df: DataFrame, names: list[str]) -> Column:
    return pick_column(df, names, "")


def batter_contact_game(pa: DataFrame) -> DataFrame:
    """Batter-game table; denominators count all rows, missing speed stays null."""
    df = _contact(pa)
    single, double, triple, homer = (_flag_or_zero(df, c) for c in ("is_1b", "is_2b", "is_3b", "is_hr"))
    hit = flag_int_of(df, "is_hit") if "is_hit" in df.columns else F.least(single + double + triple + homer, F.lit(1))
    df = df.withColumns(
        {
            "_hit": hit,
            "_hr": homer,
            "_rbi": _flag_or_zero(df, "is_rbi"),
            "_bb": _flag_or_zero(df, "is_bb"),
            "_so": _flag_or_zero(df, "is_so"),
            "_tb": total_bases(single, double, triple, homer),
            "_game": F.col("game_pk"),
            "_date": F.col("game_date"),
            "_id": F.col(pick(df.columns, ["batter_id", "batter"], required=True)),
            "_name": _label(df, ["batter_name", "player_name"]),
            "_team": _label(df, ["batting_team", "team", "batter_team", "offense_team"]),
        }
    )
    grouped = df.groupBy(
        F.col("_game").alias("game_pk"),
        F.col("_date").alias("game_date"),
        F.col("_id").alias("batter_id"),
        F.col("_name").alias("batter_name"),
        F.col("_team").alias("team"),
    ).agg(
        F.count(F.lit(1)).alias("pa"),
        _sum("_hit").alias("hits"),
        _sum("_hr").alias("hr"),
        _sum("_rbi").alias("rbi"),
        _sum("_tb").alias("tb"),
        F.avg("_speed").alias("ev_mean"),
        F.max("_speed").alias("ev_max"),
        F.avg("_angle").alias("la_mean"),
        _sum("_barrel").alias("barrels"),
        _sum("_hard").alias("hardhit"),
        _sum("_bb").alias("bb"),
        _sum("_so").alias("so"),
    )
    per_pa = {
        "barrel_rate": F.col("barrels"),
        "hardhit_rate": F.col("hardhit"),
        "k_rate": F.col("so"),
        "bb_rate": F.col("bb"),
        "iso": F.col("tb") - F.col("hits"),
        "hr_per_pa": F.col("hr"),
        "tb_per_pa": F.col("tb"),
    }
    return grouped.withColumns(
        {
            "team": team_code(F.col("team"), CONTACT),
            **{name: ratio(value, F.col("pa")) for name, value in per_pa.items()},
            "avg_ev": F.col("ev_mean"),
            "avg_la": F.col("la_mean"),
            "hard_hit_rate": ratio(F.col("hardhit"), F.col("pa")),
            "fb_rate": null_of("double"),
            "pulled_air_rate": null_of("double"),
        }
    )


def pitcher_contact_game(pa: DataFrame) -> DataFrame:
    """Pitcher-game table, the counterpart of ``batter_contact_game``."""
    df = _contact(pa)
    df = df.withColumns(
        {
            "_bb": _flag_or_zero(df, "is_bb"),
            "_so": _flag_or_zero(df, "is_so"),
            "_hr": _flag_or_zero(df, "is_hr"),
            "_game": F.col("game_pk"),
            "_date": F.col("game_date"),
            "_id": F.col(pick(df.columns, ["pitcher_id", "pitcher"], required=True)),
            "_name": _label(df, ["pitcher_name"]),
            "_team": _label(df, ["pitching_team", "defense_team", "team_allowed"]),
        }
    )
    grouped = df.groupBy(
        F.col("_game").alias("game_pk"),
        F.col("_date").alias("game_date"),
        F.col("_id").alias("pitcher_id"),
        F.col("_name").alias("pitcher_name"),
        F.col("_team").alias("team"),
    ).agg(
        F.count(F.lit(1)).alias("batters_faced"),
        _sum("_bb").alias("bb_allowed"),
        _sum("_so").alias("so"),
        _sum("_hr").alias("hr_allowed"),
        _sum("_barrel").alias("barrels_allowed"),
        _sum("_hard").alias("hardhit_allowed"),
    )
    rates = {
        "bb_rate": "bb_allowed",
        "k_rate": "so",
        "barrel_rate": "barrels_allowed",
        "hard_hit_rate": "hardhit_allowed",
        "hr_per_bf": "hr_allowed",
    }
    return grouped.withColumns(
        {
            "team": team_code(F.col("team"), CONTACT),
            **{r: ratio(F.col(n), F.col("batters_faced")) for r, n in rates.items()},
            "hr9": ratio(F.col("hr_allowed"), F.col("batters_faced")) * 27.0,
        }
    )


def flagged(pa: DataFrame) -> DataFrame:
    """Plate appearances with bigint ids, 0/1 flags (null is 0) and total bases."""
    have = set(pa.columns)
    zero = F.lit(0).cast("bigint")
    casts = {c: int_of(pa, c) for c in ("season", "game_pk", "batter_id", "pitcher_id")}
    casts.update(
        {f: F.coalesce(flag_of(pa, f).cast("bigint"), zero) if f in have else zero for f in FLAGS}
    )
    for c in ("runs_scored_on_pa", "rbi"):
        casts[c] = F.coalesce(num_of(pa, c), F.lit(0.0)) if c in have else F.lit(0.0)
    out = pa.withColumns(casts)
    return out.withColumn("tb", total_bases(*[F.col(c) for c in ("is_1b", "is_2b", "is_3b", "is_hr")]))


def _targets() -> dict[str, Column]:
    return {
        "hit_1_plus": (F.col("hits") > 0).cast("bigint"),
        "tb_2_plus": (F.col("tb") >= 2).cast("bigint"),
        "hr_1_plus": (F.col("hr") > 0).cast("bigint"),
        "rbi_1_plus": (F.col("rbi") > 0).cast("bigint"),
    }


def batter_flag_game(pa: DataFrame) -> DataFrame:
    """Batter-game sums of flags with target columns."""
    sums = {
        "pa": "is_pa", "ab": "is_ab", "hits": "is_hit", "singles": "is_1b", "doubles": "is_2b",
        "triples": "is_3b", "hr": "is_hr", "bb": "is_bb", "hbp": "is_hbp", "so": "is_so",
        "rbi": "rbi", "tb": "tb", "runs_scored": "runs_scored_on_pa", "sac_fly": "is_sac_fly",
        "roe": "is_reached_on_error",
    }
    return (
        flagged(pa)
        .groupBy("season", "game_date", "game_pk", "batter_id", "batter_name")
        .agg(
            *[_sum(c).alias(n) for n, c in sums.items()],
            F.countDistinct("pitcher_id").alias("pitcher_id_nunique"),
        )
        .withColumns(_targets())
    )


def pitcher_flag_game(pa: DataFrame) -> DataFrame:
    """Pitcher-game sums of flags."""
    sums = {
        "batters_faced": "is_pa", "ab_allowed": "is_ab", "hits_allowed": "is_hit",
        "singles_allowed": "is_1b", "doubles_allowed": "is_2b", "triples_allowed": "is_3b",
        "hr_allowed": "is_hr", "bb_allowed": "is_bb", "hbp_allowed": "is_hbp", "so": "is_so",
        "rbi_allowed": "rbi", "tb_allowed": "tb", "runs_allowed": "runs_scored_on_pa",
    }
    return (
        flagged(pa)
        .groupBy("season", "game_date", "game_pk", "pitcher_id", "pitcher_name")
        .agg(
            *[_sum(c).alias(n) for n, c in sums.items()],
            F.countDistinct("batter_id").alias("batter_id_nunique"),
        )
    )


def contact_day(pitches: DataFrame, order: list[str]) -> DataFrame:
    """Batter-day contact summary; rates over measured events only.

    Texts are the first non-null value in ``order``.
    """
    have = set(pitches.columns)

    def measured(name: str) -> Column:
        return num_of(pitches, name) if name in have else null_of("double")

    def first_text(name: str) -> Column:
        if name not in have:
            return F.max(null_of("string"))
        present = F.when(F.col(name).isNotNull(), F.struct(*order))
        return F.min_by(name, present)

    speed, angle = measured("launch_speed"), measured("launch_angle")
    return (
        pitches.groupBy("game_date", F.col("batter").cast("bigint").alias("batter_id"))
        .agg(
            F.avg(speed).alias("launch_speed_sc"),
            F.avg(angle).alias("launch_angle_sc"),
            F.avg(measured("hit_distance_sc")).alias("hit_distance_sc_sc"),
            F.avg(measured("hc_x")).alias("hc_x_sc"),
            F.avg(measured("hc_y")).alias("hc_y_sc"),
            first_text("bb_type").alias("bb_type_sc"),
            first_text("events").alias("sc_events"),
            first_text("description").alias("sc_description"),
            F.count_if(barrel(speed, angle)).alias("barrels_sc"),
            F.count_if(hard_hit(speed)).alias("hard_hit_sc"),
            F.count(speed).alias("bbe_sc"),
        )
        .withColumns(
            {
                "barrel_rate_sc": ratio(F.col("barrels_sc"), F.col("bbe_sc")),
                "hard_hit_rate_sc": ratio(F.col("hard_hit_sc"), F.col("bbe_sc")),
            }
        )
    )


def add_flag_batter_rolls(games: DataFrame, windows=WINDOWS) -> DataFrame:
    """Rolling sums of batter-game counts and their rates; null ids stay null."""
    sums = ["pa", "ab", "hits", "hr", "rbi", "tb", "bb", "so"]
    rolled = rolling(
        games, "batter_id", ["game_date", "game_pk"], sums=sums, windows=windows,
        null_entity=False,
    )
    return rolling_ratios(
        rolled,
        {
            "hit_rate": ("hits", "ab"),
            "hr_rate": ("hr", "ab"),
            "rbi_pa_rate": ("rbi", "pa"),
            "tb_pa_rate": ("tb", "pa"),
            "bb_rate": ("bb", "pa"),
            "so_rate": ("so", "pa"),
        },
        windows,
    )


def add_flag_pitcher_rolls(games: DataFrame, windows=WINDOWS) -> DataFrame:
    """Rolling sums of pitcher-game counts and their rates; null ids stay null."""
    sums = ["batters_faced", "hits_allowed", "hr_allowed", "bb_allowed", "so", "runs_allowed", "tb_allowed"]
    rolled = rolling(
        games, "pitcher_id", ["game_date", "game_pk"], sums=sums, windows=windows,
        null_entity=False,
    )
    faced = "batters_faced"
    return rolling_ratios(
        rolled,
        {
            "k_rate": ("so", faced),
            "bb_rate": ("bb_allowed", faced),
            "hr_rate": ("hr_allowed", faced),
            "hit_rate": ("hits_allowed", faced),
            "runs_rate": ("runs_allowed", faced),
        },
        windows,
    )


def _batter_rules() -> list:
    def per(num: str, den: str) -> Column:
        return ratio(F.col(num), F.col(den))

    extra = sum(
        [F.coalesce(F.col(c), F.lit(0.0)) * k for c, k in (("3b", 2.0), ("hr", 3.0))],
        F.coalesce(F.col("2b"), F.lit(0.0)),
    )
    return [
        (
            "hard_hit_rate",
            [(["hard_hit"], per("hard_hit", "bip")), ([], per("hardhit", "pa"))],
        ),
        ("barrel_rate", [([], per("barrels", "pa"))]),
        ("hr_per_pa", [([], per("hr", "pa"))]),
        ("tb_per_pa", [([], per("tb", "pa"))]),
        ("bb_rate", [([], per("bb", "pa"))]),
        ("k_rate", [([], per("so", "pa"))]),
        (
            "iso",
            [(["ab"], ratio(extra, F.col("ab"))), ([], ratio(F.col("tb") - F.col("hits"), F.col("pa")))],
        ),
        ("fb_rate", [(["fb"], per("fb", "bip"))]),
        ("pulled_air_rate", [(["pull_air"], per("pull_air", "bip"))]),
        ("avg_ev", [(["ev_mean"], F.col("ev_mean").cast("double"))]),
        ("avg_la", [(["la_mean"], F.col("la_mean").cast("double"))]),
    ]


_BATTER_INPUTS = [
    "pa", "hits", "hr", "rbi", "tb", "bb", "so", "barrels", "barrel_rate", "hardhit", "hard_hit_rate",
    "avg_ev", "avg_la", "iso", "hr_per_pa", "tb_per_pa", "bb_rate", "k_rate", "fb_rate",
    "pulled_air_rate", "ab", "1b", "2b", "3b", "bip", "fb", "pull_air", "hard_hit",
]
_BATTER_SUMS = ["hits", "hr", "rbi", "tb", "bb", "so"]
_BATTER_MEANS = [
    "hr_per_pa", "tb_per_pa", "bb_rate", "k_rate", "barrel_rate", "hard_hit_rate", "fb_rate",
    "pulled_air_rate", "avg_ev", "avg_la", "iso",
]
_PITCHER_INPUTS = [
    "batters_faced", "bb_allowed", "so", "hr_allowed", "barrels_allowed", "hardhit_allowed",
    "barrel_rate", "hard_hit_rate", "bb_rate", "k_rate", "hr_per_bf", "hr9",
]
_PITCHER_SUMS = ["hr_allowed", "bb_allowed", "so"]
_PITCHER_MEANS = ["hr9", "bb_rate", "k_rate", "barrel_rate", "hard_hit_rate"]


def _prefixed_rolls(df: DataFrame, by: str, prefix: str, sums, means, windows, extra) -> DataFrame:
    def build(frame_of):
        def keep(value: Column) -> Column:
            return F.when(F.col(by).isNotNull(), value)

        out = {}
        for w in windows:
            at = frame_of(w)
            out.update({f"{prefix}{c}_roll{w}": keep(F.sum(c).over(at)) for c in sums})
            out.update({f"{prefix}{n}_roll{w}": keep(v(at)) for n, v in extra.items()})
            out.update({f"{prefix}{c}_roll{w}": keep(F.avg(c).over(at)) for c in means})
        return out

    return over_previous(
        df, by, ["game_date", "game_pk"], build, windows=windows
    )


def add_contact_batter_rolls(games: DataFrame, windows=WINDOWS) -> DataFrame:
    """Full batter rolling table with ``bat_`` columns."""
    by = pick(games.columns, ["batter_id", "batter"], required=True)
    df = rename_missing(
        games,
        {
            "avg_exit_velocity": "avg_ev",
            "avg_launch_angle": "avg_la",
            "hardhit_rate": "hard_hit_rate",
        },
    )
    df = derive_if_empty(with_numeric(df, _BATTER_INPUTS), _batter_rules())
    has_ab = "ab" in games.columns and df.filter(F.col("ab").isNotNull()).limit(1).first() is not None
    at_bats = "ab" if has_ab else "pa"
    average = {"ba": lambda at: ratio(F.sum("hits").over(at), F.sum(at_bats).over(at))}
    return _prefixed_rolls(df, by, "bat_", _BATTER_SUMS, _BATTER_MEANS, windows, average)


def add_contact_pitcher_rolls(games: DataFrame, windows=WINDOWS) -> DataFrame:
    """Full pitcher rolling table with ``pit_`` columns."""
    by = pick(games.columns, ["pitcher_id", "pitcher"], required=True)

    def per(num: str) -> Column:
        return ratio(F.col(num), F.col("batters_faced"))

    rules = [
        ("bb_rate", [([], per("bb_allowed"))]),
        ("k_rate", [([], per("so"))]),
        ("barrel_rate", [([], per("barrels_allowed"))]),
        ("hard_hit_rate", [([], per("hardhit_allowed"))]),
        ("hr_per_bf", [([], per("hr_allowed"))]),
        ("hr9", [([], F.col("hr_per_bf") * 27.0)]),
    ]
    df = derive_if_empty(with_numeric(games, _PITCHER_INPUTS), rules)
    return _prefixed_rolls(df, by, "pit_", _PITCHER_SUMS, _PITCHER_MEANS, windows, {})
