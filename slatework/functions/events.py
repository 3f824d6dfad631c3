"""Plate-appearance event flags, targets and base context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slatework.functions.scoring import band

# Outcome classes in id order.
OUTCOMES = ["out", "walk_hbp", "single", "double", "triple", "home_run"]

# Event names behind each flag.
EVENT_SETS = {
    "is_ab": [
        "single", "double", "triple", "home_run", "strikeout", "field_out", "force_out",
        "grounded_into_double_play", "fielders_choice", "field_error", "double_play",
        "triple_play", "lineout", "flyout", "pop_out",
    ],
    "is_hit": ["single", "double", "triple", "home_run"],
    "is_1b": ["single"],
    "is_2b": ["double"],
    "is_3b": ["triple"],
    "is_hr": ["home_run", "home run"],
    "is_bb": ["walk", "intent_walk", "intentional_walk"],
    "is_hbp": ["hit_by_pitch"],
    "is_so": ["strikeout", "strikeout_double_play"],
    "is_sac_fly": ["sac_fly"],
    "is_reached_on_error": ["field_error", "reached_on_error"],
}
# Source columns that override a derived flag, in order.
EXPLICIT_FLAGS = {
    "is_pa": ["is_pa"],
    "is_ab": ["is_ab"],
    "is_hit": ["is_hit"],
    "is_1b": ["is_1b", "single_flag"],
    "is_2b": ["is_2b", "double_flag"],
    "is_3b": ["is_3b", "triple_flag"],
    "is_hr": ["is_hr", "home_run_flag"],
    "is_bb": ["is_bb", "walk_flag"],
    "is_hbp": ["is_hbp", "hit_by_pitch_flag"],
    "is_so": ["is_so", "strikeout_flag"],
    "is_rbi": ["is_rbi", "rbi_flag"],
    "is_sac_fly": ["is_sac_fly", "sac_fly_flag"],
    "is_reached_on_error": ["is_reached_on_error", "roe_flag", "reached_on_error_flag"],
}
EVENT_FLAGS = list(EXPLICIT_FLAGS)
# Flags left unknown, not false, when there is no event text.
UNKNOWN_WITHOUT_EVENT = ["is_1b", "is_2b", "is_3b", "is_sac_fly"]


def event_flag(name: str, event: Column, rbi: Column) -> Column:
    """Flag derived from the event text (and runs batted in)."""
    if name == "is_pa":
        return F.lit(True)
    if name == "is_rbi":
        return F.coalesce(rbi > 0, F.lit(False))
    found = event.isin(EVENT_SETS[name])
    return found if name in UNKNOWN_WITHOUT_EVENT else F.coalesce(found, F.lit(False))


def total_bases(single: Column, double: Column, triple: Column, homer: Column) -> Column:
    return (
        single.cast("bigint")
        + 2 * double.cast("bigint")
        + 3 * triple.cast("bigint")
        + 4 * homer.cast("bigint")
    )


def outcome_class(
    walk: Column, hit_by_pitch: Column, single: Column, double: Column, triple: Column, homer: Column
) -> Column:
    """Class of a plate appearance; the biggest event wins."""
    return (
        F.when(homer, "home_run")
        .when(triple, "triple")
        .when(double, "double")
        .when(single, "single")
        .when(walk | hit_by_pitch, "walk_hbp")
        .otherwise("out")
    )


def outcome_id(name: Column) -> Column:
    """Class id; null counts as ``out`` and an unknown class stops the job."""
    known = F.array_position(F.array(*[F.lit(c) for c in OUTCOMES]), F.coalesce(name, F.lit("out")))
    unknown = F.raise_error(F.concat(F.lit("unknown outcome class: "), name)).cast("bigint")
    return F.when(known > 0, known - 1).otherwise(unknown)


def outcome_name(class_id: Column) -> Column:
    return F.get(F.array(*[F.lit(c) for c in OUTCOMES]), class_id.cast("int"))


def bases_held(state: Column) -> list[Column]:
    """0/1 per base from a text such as ``13``."""
    text = F.coalesce(state, F.lit(""))
    return [text.contains(base).cast("bigint") for base in ("1", "2", "3")]


def inning_bucket(inning: Column) -> Column:
    return band(inning, [0, 3, 6, 99], ["early", "mid", "late"], include_lowest=False)


def barrel(speed: Column, angle: Column) -> Column:
    return F.coalesce((speed >= 98) & angle.between(26, 30), F.lit(False))


def hard_hit(speed: Column) -> Column:
    return F.coalesce(speed >= 95, F.lit(False))


def game_result(home: Column, away: Column, home_score: Column, away_score: Column) -> dict[str, Column]:
    """home_win, winner and loser; all null on a tie or a missing score."""
    won, lost = home_score > away_score, home_score < away_score
    return {
        "home_win": F.when(won, True).when(lost, False),
        "winning_team": F.when(won, home).when(lost, away),
        "losing_team": F.when(won, away).when(lost, home),
    }
