"""Lineup choice per game and entity inputs for a slate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatework.operators.asof import latest_rows, latest_with_fallback
from slatework.operators.dedupe import top_rows
from slatework.operators.shape import stack, starting_with

LINEUP_SIZE = 9


def _ids(lineups: DataFrame, n: int, name: str) -> DataFrame:
    """First ``n`` known ids per game and team in slot order, and how many there are."""
    known = lineups.filter(F.col("player_id").isNotNull())
    order = [F.asc_nulls_last("batting_order"), F.asc("player_id")]
    first = top_rows(known, ["game_pk", "team"], order, n, "_slot")
    gathered = F.array_sort(F.collect_list(F.struct("_slot", "player_id")))
    ids = F.transform(gathered, lambda s: s["player_id"].cast("string"))
    return first.groupBy("game_pk", "team").agg(F.concat_ws(",", ids).alias(name), F.count(F.lit(1)).alias("_n"))


def ordered_ids(lineups: DataFrame, n: int = LINEUP_SIZE, name: str = "ids") -> DataFrame:
    """First ``n`` ids per game and team in slot order, comma-joined.

    Rows are limited to ``n`` per team before they are gathered.
    """
    return _ids(lineups, n, name).drop("_n")


def id_rows(df: DataFrame, keep: list[str], ids: str) -> DataFrame:
    """Comma-joined ids back to rows with their 1-based slot."""
    return (
        df.select(*keep, F.posexplode(F.split(ids, ",")).alias("_pos", "_id"))
        .filter(F.trim("_id") != "")
        .select(
            *keep,
            (F.col("_pos") + 1).cast("bigint").alias("lineup_slot"),
            F.trim("_id").cast("bigint").alias("player_id"),
        )
    )


def _stacked(*frames: DataFrame) -> DataFrame:
    """Union by name, columns named anew: of frames with a common origin a union does not see that they are dealt alike."""
    return stack([df.toDF(*df.columns) for df in frames])


def _complete(lineups: DataFrame, label: str) -> DataFrame:
    """Teams with a full lineup of known ids: its first ids are as many as a lineup has."""
    named = lineups.filter(F.col("game_pk").isNotNull() & F.col("team").isNotNull())
    return _ids(named, LINEUP_SIZE, label).filter(F.col("_n") == LINEUP_SIZE).drop("_n")


def choose_lineups(projected: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Per team the confirmed lineup if complete, else the projected one, with its source.

    Both sources are stacked and folded, so lineups dealt by game stay where they are.
    """
    both = _stacked(_complete(confirmed, "_confirmed"), _complete(projected, "_projected"))
    folded = both.groupBy("game_pk", "team").agg(*[F.max(c).alias(c) for c in ("_confirmed", "_projected")])
    return folded.select(
        "game_pk",
        "team",
        F.coalesce("_confirmed", "_projected").alias("batters"),
        F.when(F.col("_confirmed").isNotNull(), "confirmed").otherwise("projected").alias("lineup_source"),
    )


def choose_by_rows(projected: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Per team the source whose lineup has at least nine rows, confirmed first."""

    def sized(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("game_pk", "team").agg(F.count(F.lit(1)).alias(name))

    both = sized(confirmed, "_c").join(sized(projected, "_p"), ["game_pk", "team"], "full")
    source = F.when(F.col("_c") >= LINEUP_SIZE, "confirmed").when(F.col("_p") >= LINEUP_SIZE, "projected")
    rows = F.when(F.col("_c") >= LINEUP_SIZE, F.col("_c")).otherwise(F.col("_p"))
    return both.select(
        "game_pk", "team", source.alias("lineup_source"), rows.alias("n_rows")
    ).filter(F.col("lineup_source").isNotNull())


def slate_games(
    spine: DataFrame, projected: DataFrame, confirmed: DataFrame, starters: DataFrame
) -> DataFrame:
    """Games ready to be played through: both lineups and both starters known.

    Teams are folded, joined and put beside each other by game alone: inputs that are
    dealt by game alike are not moved again, and lineups are chosen once for both sides.
    """
    lineups = choose_lineups(projected, confirmed)
    teams = _stacked(lineups, starters.select("game_pk", "team", "pitcher_id")).groupBy("game_pk", "team")
    known = teams.agg(*[F.max(c).alias(c) for c in ("batters", "lineup_source")], F.min("pitcher_id").alias("pitcher_id"))
    ready = known.filter(F.col("batters").isNotNull() & F.col("pitcher_id").isNotNull())
    ready = ready.withColumnsRenamed({"game_pk": "_game_pk", "team": "_name"})
    game = ["game_pk", "game_date", "away_team", "home_team"]
    sides = [F.struct(F.lit(s).alias("_side"), F.col(f"{s}_team").alias("_team")) for s in ("away", "home")]
    # The team is compared as a range, since an equal key would be dealt by, too.
    same = (F.col("game_pk") == F.col("_game_pk")) & F.col("_team").between(F.col("_name"), F.col("_name"))
    found = spine.select(*game, F.inline(F.array(*sides))).join(ready, same)
    values = ["batters", "pitcher_id", "lineup_source"]
    out = found.groupBy(*game).agg(
        *[F.max(F.when(F.col("_side") == s, F.col(v))).alias(f"{s}_{v}") for v in values for s in ("away", "home")],
        *[F.count_if(F.col("_side") == s).alias(f"_{s}") for s in ("away", "home")],
    )
    # A game that the spine lists several times comes as often.
    times = F.explode(F.sequence(F.lit(1), F.col("_away").cast("int"))).alias("_time")
    return out.filter("_away > 0 and _home > 0").select("*", times).drop("_away", "_home", "_time")


def batter_inputs(
    slots: DataFrame, rolls: DataFrame, mart: DataFrame, cutoff: Column, tie: list[str]
) -> DataFrame:
    """Latest earlier batter profile per lineup slot, with where it came from."""
    values = [c for c in starting_with(rolls, "bat_") if c in mart.columns]
    return latest_with_fallback(slots, "batter_id", rolls, mart, "game_date", values, tie, cutoff)


def pitcher_inputs(
    starters: DataFrame, rolls: DataFrame, mart: DataFrame, cutoff: Column, tie: list[str]
) -> DataFrame:
    """Latest earlier pitcher profile per starter, with where it came from."""
    values = [c for c in starting_with(rolls, "pit_") if c in mart.columns]
    return latest_with_fallback(starters, "pitcher_id", rolls, mart, "game_date", values, tie, cutoff)


def bullpen_profile(
    members: DataFrame, mart: DataFrame, by: list[str], cutoff: Column, tie: list[str]
) -> DataFrame:
    """Mean profile of the latest rows of a group of pitchers, one row per group."""
    values = starting_with(mart, "pit_")
    latest = latest_rows(mart, "pitcher_id", "game_date", tie, cutoff, strict=True)
    joined = members.join(latest.select("pitcher_id", *values), "pitcher_id", "left")
    return joined.groupBy(*by).agg(
        *[F.avg(v).alias(v) for v in values],
        F.lit(-999).cast("bigint").alias("pitcher_id"),
        F.count("pitcher_id").alias("bullpen_pitcher_count"),
    )


# Flag columns a result table may carry and the name of their mean.
_RESULT_MEANS = {
    "home_win": "home_win_pct", "away_win": "away_win_pct", "is_tie_cap": "tie_cap_pct",
    "score_home": "mean_home_runs_scored", "score_away": "mean_away_runs_scored",
    "total_runs": "mean_total_runs", "cache_size": "mean_cache_size",
    "used_bullpen_away": "bullpen_used_pct_away", "used_bullpen_home": "bullpen_used_pct_home",
    "bf_starter_away": "mean_bf_starter_away", "bf_starter_home": "mean_bf_starter_home",
    "starter_bf_cap_away": "mean_starter_bf_cap_away",
    "starter_bf_cap_home": "mean_starter_bf_cap_home", "top1_runs": "mean_top1_runs",
    "bot1_runs": "mean_bot1_runs", "first_inning_runs": "mean_first_inning_runs",
    "top1_run": "p_top1_run", "bot1_run": "p_bot1_run", "yrfi": "p_yrfi", "nrfi": "p_nrfi",
}


def outcome_summary(results: DataFrame, by: list[str]) -> DataFrame:
    """Means, median and total-run shares of a table of played-out games.

    The median is taken over the distinct totals with their counts, so a group
    of any size needs one pass.
    """
    means = [
        F.avg(F.col(c).cast("double")).alias(n) for c, n in _RESULT_MEANS.items() if c in results.columns
    ]
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_sims"),
        *means,
        F.median("total_runs").alias("median_total_runs"),
        F.avg((F.col("total_runs") <= 7).cast("double")).alias("p_total_le_7_5"),
        F.avg((F.col("total_runs") >= 9).cast("double")).alias("p_total_ge_8_5"),
    )
