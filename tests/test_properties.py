"""Leakage, input order and partitioning, and the ways taken for hot groups."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from slatework.functions.coerce import date_of
from slatework.operators import asof, dedupe, slates
from slatework.operators.rolling import rolling
from slatework.plans import features

N = 4000


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity holds well over a third of the rows, one date a third of those."""
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-02-01")).otherwise(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).cast("string")
    )
    return spark.range(N).select(
        F.col("id").alias("game"),
        F.when(F.col("id") % 5 < 3, F.lit(0)).when(F.col("id") % 10 == 4, None).otherwise(F.col("id") % 40).alias("who"),
        date_of(day).alias("day"),
        (F.xxhash64("id") % 1000).cast("double").alias("v"),
    ).cache()


def collected(df, *keys):
    return {tuple(r[k] for k in keys): tuple(r) for r in df.collect()}


@pytest.mark.parametrize("segment_rows", [40, 333])
@pytest.mark.parametrize("lag", [1, 3])
def test_rolling_in_segments_equals_one_window(skewed, segment_rows, lag):
    order = Window.partitionBy("who").orderBy("day", "game")
    plain = skewed.withColumns(
        {
            f"v_{w}_{kind}": fn("v").over(order.rowsBetween(-(w + lag - 1), -lag))
            for w in (3, 30)
            for kind, fn in (("sum", F.sum), ("mean", F.avg))
        }
    )
    cut = rolling(
        skewed, "who", ["day", "game"], sums=["v"], windows=(3, 30), lag=lag, name="v_{w}_sum", segment_rows=segment_rows
    )
    cut = rolling(
        cut, "who", ["day", "game"], means=["v"], windows=(3, 30), lag=lag, name="v_{w}_mean", segment_rows=segment_rows
    )
    assert collected(plain, "game") == collected(cut.select(plain.columns), "game")


def test_segments_and_their_planning_are_bounded(skewed):
    """No window holds more than a few segments' rows of the hot entity, the planning one included."""
    from slatework.operators import segments

    rows = 100
    cut = segments.with_segments(skewed, ["who"], ["day", "game"], rows, 30)
    largest = cut.groupBy("who", "_seg").count().agg(F.max("count")).first()[0]
    planned = segments._coded(skewed, ["who"], ["day", "game"], rows).groupBy("who").agg(F.countDistinct("_code"))
    most = planned.agg(F.max("count(DISTINCT _code)")).first()[0]
    hot = skewed.filter("who = 0").count()
    assert largest < 3 * rows < hot
    assert 1 < most <= 4 * segments._QUANTILES < hot


def test_segments_follow_the_order(skewed):
    from slatework.operators.segments import with_segments

    cut = with_segments(skewed, ["who"], ["day", "game"], 70).withColumn(
        "before", F.max("_seg").over(Window.partitionBy("who").orderBy("day", "game"))
    )
    assert cut.filter("_seg < before").count() == 0


@pytest.mark.parametrize("as_time", [False, True])
def test_asof_equals_scan(skewed, as_time):
    kind = "timestamp" if as_time else "date"
    left = skewed.filter("game % 2 = 0").select("game", "who", F.col("day").cast(kind).alias("day"))
    right = skewed.filter("game % 7 = 1").select("who", F.col("day").cast(kind).alias("day"), F.col("game").alias("g"), "v")
    facts = sorted((r.who, r.day, r.g, r.v) for r in right.collect() if r.who is not None)
    for strict in (True, False):
        got = asof.asof_join(left, right, "who", "day", ["g", "v"], tie=["g"], strict=strict, segment_rows=50)
        expected = {}
        for r in left.filter("who is not null").collect():
            found = [f for f in facts if f[0] == r.who and (f[1] < r.day or not strict and f[1] == r.day)]
            expected[r.game,] = (r.game, r.who, r.day, *(found[-1][2:] if found else (None, None)))
        assert collected(got, "game") == expected and expected


def test_ordinal_equals_row_number(skewed):
    order = Window.partitionBy("who").orderBy("day", "game")
    plain = skewed.withColumn("n", F.row_number().over(order).cast("bigint"))
    for segment_rows in (70, 10**6):
        got = dedupe.ordinal(skewed, ["who"], ["day", "game"], "n", segment_rows=segment_rows)
        assert collected(plain, "game") == collected(got, "game")


def test_ordinal_over_text_and_nulls(skewed):
    named = skewed.withColumn("name", F.when(F.col("game") % 11 > 0, F.concat(F.lit("player "), F.col("game") % 97)))
    order = Window.partitionBy("who").orderBy("name", "game")
    plain = named.withColumn("n", F.row_number().over(order).cast("bigint"))
    assert collected(plain, "game") == collected(dedupe.ordinal(named, ["who"], ["name", "game"], "n", segment_rows=60), "game")


def test_medians_equal_sorted_middle(skewed):
    df = skewed.withColumn("w", F.when(F.col("game") % 4 == 0, F.col("v") / 7)).withColumn("x", F.lit(None).cast("double"))
    plain = df.groupBy("who").agg(*[F.median(c).alias(c) for c in ("v", "w", "x")])
    for group_rows in (10**6, 50, 1):
        got = slates.group_medians(df, ["who"], ["v", "w", "x"], group_rows=group_rows)
        assert collected(plain, "who") == collected(got, "who")


@pytest.mark.parametrize("seed", range(4))
def test_selected_medians_of_odd_values(spark, seed):
    """Signs, zeros, neighbours in the last bit, denormal, huge, infinite and NaN values; null keys."""
    rng = random.Random(seed)
    pool = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 2.0, 8.0, -8.0, 1e300, -1e300, 0.1]
    pool += [float("inf"), float("nan")] if seed % 2 else []
    pool += [rng.uniform(-3, 3) for _ in range(6)] + [1 + k * 2.0**-52 for k in range(5)] + [None]
    rows = [(rng.choice(["a", "b", None]), rng.choice(pool), float(rng.randrange(3))) for _ in range(400)]
    df = spark.createDataFrame(rows, "who string, v double, w double").repartition(5)
    plain = df.groupBy("who").agg(F.median("v").alias("v"), F.median("w").alias("w"))
    want = {r.who: (repr(r.v), r.w) for r in plain.collect()}
    got = {r.who: (repr(r.v), r.w) for r in slates.group_medians(df, ["who"], ["v", "w"], group_rows=10).collect()}
    # A median that is zero may have either sign.
    assert {k: (v.replace("-0.0", "0.0"), w) for k, (v, w) in got.items()} == {k: (v.replace("-0.0", "0.0"), w) for k, (v, w) in want.items()}


def test_later_form_never_reaches_an_earlier_game(spark):
    """Game views over two dates: each game sees the form up to its own date, and one date alone gives the same row."""
    days = [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]
    spine = spark.createDataFrame(
        [(k + 1, d, "A", "B", 1, 2) for k, d in enumerate(days)],
        "game_pk int, game_date date, home_team string, away_team string, home_sp_id int, away_sp_id int",
    )
    lineups = spark.createDataFrame(
        [(k + 1, d, team, 10 + slot, slot) for k, d in enumerate(days) for team in "AB" for slot in (1, 2, 3)],
        "game_pk int, game_date date, team string, player_id int, batting_order int",
    )
    form = [(0, dt.date(2024, 4, 30), 1.0), (1, days[0], 2.0), (2, days[1], 3.0)]
    bat = spark.createDataFrame([(*f[:2], 10 + i, f[2]) for f in form for i in (1, 2, 3)], "game_pk int, game_date date, batter_id int, rbi_roll7 double")
    pit = spark.createDataFrame([(*f[:2], i, f[2]) for f in form for i in (1, 2)], "game_pk int, game_date date, pitcher_id int, k_rate_roll7 double")
    for view, label in ((features.nrfi_view, "top3"), (features.moneyline_view, "team")):
        both = {r.game_pk: r for r in view(spine, lineups, bat, pit).collect()}
        assert [both[k].home_sp_k_rate_roll7 for k in (1, 2)] == [2.0, 3.0]
        assert [both[k][f"away_{label}_rbi_roll7"] for k in (1, 2)] == [2.0, 3.0]
        one = view(spine.where("game_pk = 1"), lineups.where("game_pk = 1"), bat, pit).collect()
        assert one == [both[1]]
        early = view(spine, lineups, bat.where("game_pk < 2"), pit.where("game_pk < 2")).where("game_pk = 1").collect()
        assert early == [both[1]]


def test_no_leak_from_the_same_or_later_dates(spark, skewed):
    cut = dt.date(2024, 2, 1)
    changed = skewed.withColumn("v", F.when(F.col("day") >= cut, F.col("v") + 1000).otherwise(F.col("v")))
    per_day = [
        df.groupBy("who", "day").agg(F.sum("v").alias("v")) for df in (skewed, changed)
    ]
    early = [
        collected(rolling(df, "who", ["day"], means=["v"], windows=(7,)).filter(F.col("day") <= cut).select("who", "day", "v_roll7"), "who", "day")
        for df in per_day
    ]
    assert early[0] == early[1]
    left = spark.createDataFrame([(0, cut)], "who long, day date")
    seen = [asof.asof_join(left, df, "who", "day", ["v"]).first()["v"] for df in per_day]
    assert seen[0] == seen[1] is not None


def test_input_order_and_partitions_do_not_matter(skewed):
    shuffled = skewed.orderBy(F.rand(7)).repartition(11)
    got = []
    for df in (skewed, shuffled):
        rolled = rolling(df, "who", ["day", "game"], sums=["v"], windows=(7,))
        got.append(collected(dedupe.last_per_key(rolled, ["who"], ["day", "game"]), "who"))
    assert got[0] == got[1]
