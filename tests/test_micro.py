"""Hand-written cases: nulls, ties, edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slatework.functions import scoring as sc
from slatework.functions import text
from slatework.functions.coerce import date_of, flag, int_of, number, ratio
from slatework.operators import asof, dedupe, joins, quality, resolve, shape, slates
from slatework.operators.rolling import rolling
from slatework.plans import gametables, inputs, mart
from slatework.sources import datasets, pages

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_rolling_first_row_null_and_gap_occupies_a_row(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("a", 4, 9.0)], "id string, d int, v double"
    )
    out = rolling(df, "id", ["d"], means=["v"], sums=["v"], windows=(2,), name="{col}{w}")
    means = rolling(df, "id", ["d"], means=["v"], windows=(2,)).select("d", "v_roll2")
    assert rows(means) == [(1, None), (2, 1.0), (3, 1.0), (4, 3.0)]
    assert out.columns[-1] == "v2"


def test_null_entity_sum_masked_mean_is_a_group(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 5.0)], "id string, d int, v double")
    assert rows(rolling(df, "id", ["d"], sums=["v"], windows=(3,), null_entity=False).select("d", "v_roll3")) == [
        (1, None), (2, None),
    ]
    assert rows(rolling(df, "id", ["d"], means=["v"], windows=(3,)).select("d", "v_roll3")) == [(1, None), (2, 1.0)]


def test_ratio_and_clip(spark):
    assert value(spark, ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, ratio(F.lit(1), F.lit(None))) is None
    assert value(spark, sc.clip(F.lit(None).cast("double"), 0, 1)) is None
    assert value(spark, number(F.lit(float("nan")))) is None


def test_asof_strict_ties_and_dropped_rows(spark):
    left = spark.createDataFrame(
        [(1, "a", D(2024, 1, 5)), (2, "a", D(2024, 1, 1)), (3, None, D(2024, 1, 5)), (4, "a", None), (5, "z", D(2024, 1, 5))],
        "k int, id string, d date",
    )
    right = spark.createDataFrame(
        [("a", D(2024, 1, 1), 1, "x"), ("a", D(2024, 1, 4), 1, "old"), ("a", D(2024, 1, 4), 2, "new"), ("a", D(2024, 1, 5), 1, "same")],
        "id string, d date, g int, v string",
    )
    got = asof.asof_join(left, right, "id", "d", ["v"], tie=["g"]).select("k", "v")
    assert rows(got) == [(1, "new"), (2, None), (5, None)]
    same = asof.asof_join(left, right, "id", "d", ["v"], tie=["g"], strict=False).select("k", "v")
    assert rows(same) == [(1, "same"), (2, "x"), (5, None)]


def test_lookup_keeps_only_unambiguous_keys_and_null_team_matches(spark):
    history = spark.createDataFrame(
        [(1, "José Ruiz Jr.", "nyy"), (2, "Jose Ruiz", "NYY"), (3, "Al Poe", None)],
        "player_id long, player_name string, team string",
    )
    lookup = resolve.build_lookup([history], "player_id")
    assert rows(lookup.select("lookup_key", "player_id")) == [("a poe", 3), ("al poe", 3), ("poe", 3)]
    wanted = spark.createDataFrame([("AL POE", None), ("Jose Ruiz", "NYY")], "player_name string, team string")
    got = resolve.resolve_ids(
        wanted, lookup, "player_name", "player_id", "how", resolve.GENERAL_TIERS, text.name_key(F.col("player_name"))
    )
    assert rows(got.select("player_name", "player_id", "how")) == [
        ("AL POE", 3, "exact_full_name_team"), ("Jose Ruiz", None, "unresolved"),
    ]


@pytest.mark.parametrize(
    "raw, key",
    [
        ("  José  O'Neil Jr. ", "jose o neil"), ("ﬁn ＡＢ", "fin ab"), ("Ken Griffey III", "ken griffey"), ("...", None),
        ("", None), ("Łukasz V", "ukasz"), ("Éric", "eric"),
    ],
)
def test_name_key(spark, raw, key):
    assert value(spark, text.name_key(F.lit(raw))) == key


def test_median_fallbacks_and_single_row_slate(spark):
    df = spark.createDataFrame([("s", 1.0, None), ("s", 3.0, None), ("s", None, None), ("t", 5.0, 2.0)], "d string, a double, b double")
    got = slates.fill_with_median(df, ["d"], {"a": 9.0, "b": 7.0})
    assert rows(got) == [("s", 1.0, 7.0), ("s", 2.0, 7.0), ("s", 3.0, 7.0), ("t", 5.0, 2.0)]
    z = slates.zscore_by(df, ["d"], "b", "z")
    assert {r[-1] for r in rows(z)} == {0.0}


def test_band_edges(spark):
    edges, labels = [0.0, 0.52, 0.55], ["C", "B"]
    got = [value(spark, sc.band(F.lit(v), edges, labels)) for v in (0.0, 0.52, 0.53, 0.56, -0.1)]
    assert got == ["C", "C", "B", None, None]


def test_integers_and_flags_from_text(spark):
    df = spark.createDataFrame([("12.0",), (" 5 ",), ("x",), ("1.5",), ("9007199254740993",)], "s string")
    assert [r[0] for r in df.select(int_of(df, "s")).collect()] == [12, 5, None, None, 9007199254740993]
    assert [value(spark, flag(F.lit(s))) for s in ("YES", "n", "Yes", "2")] == [True, False, None, None]


def test_lineup_falls_back_to_projected(spark):
    def lineup(n):
        return spark.createDataFrame([(1, "A", i, 100 + i) for i in range(1, n + 1)], "game_pk long, team string, batting_order long, player_id long")

    got = inputs.choose_lineups(lineup(9), lineup(8)).first()
    assert got["lineup_source"] == "projected" and got["batters"].split(",")[0] == "101"
    assert inputs.choose_lineups(lineup(9), lineup(10)).first()["lineup_source"] == "confirmed"


def test_cardinality_is_enforced(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, r string")
    assert joins.left_checked(left, right, ["k"], "m:1").count() == 2
    with pytest.raises(ValueError):
        joins.left_checked(left, right, ["k"], "1:1")
    with pytest.raises(ValueError):
        joins.left_checked(right, left, ["k"], "m:1")
    with pytest.raises(ValueError):
        quality.validate(left, "parks")


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    first = {r[0] for r in dedupe.sample_rows(df, 777, ["k"]).collect()}
    second = {r[0] for r in dedupe.sample_rows(df.repartition(13), 777, ["k"]).collect()}
    assert len(first) == 777 and first == second
    assert dedupe.sample_rows(df, 30000, ["k"]).count() == 20000


def test_derive_only_empty_columns_in_order(spark):
    df = spark.createDataFrame([(4.0, 2.0, None, None)], "a double, b double, r double, s double")
    rules = [("r", [(["s"], F.lit(0.0)), (["a"], F.col("a") / F.col("b"))]), ("s", [(["r"], F.col("r") * 10)])]
    assert rows(shape.derive_if_empty(df, rules)) == [(4.0, 2.0, 2.0, 20.0)]


def test_outcome_priority_and_unknown_season(spark):
    df = spark.createDataFrame(
        [(1, "2024-05-01", 7, 8, True, True, True), (1, "2024-05-01", 7, 8, False, None, True)],
        "game_pk long, game_date string, batter_id long, pitcher_id long, is_pa boolean, is_hr boolean, is_1b boolean",
    )
    got = mart.prep_pa(df).select("season", "pa_outcome_target").collect()
    assert [tuple(r) for r in got] == [(2024, "home_run")]


def test_batting_average_uses_at_bats_where_known(spark):
    games = spark.createDataFrame(
        [(1, 9, D(2024, 4, 1), 5.0, 4.0, 2.0), (2, 9, D(2024, 4, 2), 4.0, 4.0, 1.0)],
        "game_pk long, batter_id long, game_date date, pa double, ab double, hits double",
    )
    got = gametables.add_contact_batter_rolls(games).orderBy("game_pk").collect()
    assert got[1]["bat_ba_roll3"] == 0.5 and got[0]["bat_ba_roll3"] is None


def test_partitioned_output_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 2020), (2, 2021)], "v int, season int")
    datasets.write_partitioned(df, path, ["season"])
    with pytest.raises(Exception):
        datasets.write_partitioned(df, path, ["season"])
    datasets.write_partitioned(df.filter("season = 2021").withColumn("v", F.lit(9)), path, ["season"], overwrite=True)
    assert rows(spark.read.parquet(path).select("v", "season")) == [(1, 2020), (9, 2021)]


def test_page_tokens_and_entities(spark):
    html = "<p>a &amp; b &#233;&#x41; &nosuch; &notin;</p><!-- x -->tail<script>no</script>"
    assert value(spark, pages.page_tokens(F.lit(html))) == ["a & b éA &nosuch; ∉", "tail"]


def test_lineup_card_scan_stops_at_nine_and_terminator(spark):
    def card(players, stop=""):
        spots = "".join(f"<i>CF</i><a>p{i}</a><b>R</b>" for i in range(players))
        return f"<a>arm</a><b>L</b><u>3.1 ERA</u><h2>Expected Lineup</h2>{spots}{stop}"

    html = "<div>1:10 PM ET</div><b>AZ</b><b>NYY</b>" + card(10) + card(2, "<p>Home Run Odds</p><i>C</i><a>x</a>")
    df = spark.createDataFrame([(1, html)], "page long, html string")
    got = pages.card_rows(df, "page", "html")
    counts = {(r["team"], r["record_type"]): r["count"] for r in got.groupBy("team", "record_type").count().collect()}
    assert counts == {("ARI", "lineup"): 9, ("ARI", "starter"): 1, ("NYY", "lineup"): 2, ("NYY", "starter"): 1}


@pytest.mark.parametrize(
    "raw, shown",
    [
        ("&#x110000;", "�"), ("&#xD800;", "�"), ("&#0;", "�"), ("&#150;", "–"), ("&amp", "&"),
        ("&#0000000065;", "A"), ("&#99999999999;", "�"), ("a &lt;b&gt; &amp;amp; c", "a <b> &amp; c"),
        ("&notit; &bogus; & &#; &#x;", "¬it; &bogus; & &#; &#x;"), ("&eacute&Eacute;", "éÉ"), ("&#x1F600", "😀"), (None, None),
    ],
)
def test_character_references(spark, raw, shown):
    assert value(spark, pages.unescape(F.lit(raw).cast("string"))) == shown


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2024-01-05", D(2024, 1, 5)), ("2024-01-05 10:00:00", D(2024, 1, 5)), ("04/03/2026", D(2026, 4, 3)),
        ("4/3/2026", D(2026, 4, 3)), ("April 3, 2026", D(2026, 4, 3)), ("Apr 3, 2026", D(2026, 4, 3)),
        ("20240105", D(2024, 1, 5)), ("13/13/2024", None), ("soon", None), ("", None), (None, None),
    ],
)
def test_date_forms(spark, raw, day):
    assert value(spark, date_of(F.lit(raw).cast("string"))) == day


def test_partitioned_output_has_few_files_and_no_single_writer(spark, tmp_path):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 5).alias("season")).repartition(40)
    # Adaptive planning would merge partitions as small as these.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        datasets.write_partitioned(df, str(tmp_path / "out"), ["season"], files=4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for folder in (tmp_path / "out").glob("season=*"):
        assert 1 <= len(list(folder.glob("*.parquet"))) <= 4
    assert len(list((tmp_path / "out" / "season=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20_000


def test_required_source_names_the_unknown_entity(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    facts = spark.createDataFrame([(1, D(2024, 1, 1), 5.0)], "id int, d date, v double")
    args = (ids, "id", facts, facts.where("false"), "d", ["v"], [], F.lit("2024-02-01").cast("date"))
    assert rows(asof.latest_with_fallback(*args).select("id", "v")) == [(1, 5.0), (2, None)]
    with pytest.raises(Exception, match="no earlier row for id 2"):
        asof.latest_with_fallback(*args, required=True).collect()


def test_factors_multiply_in_order(spark):
    steps = [(F.lit(True), 1.1), (F.lit(False), 5.0), (F.lit(None).cast("boolean"), 7.0), (F.lit(True), 0.5)]
    assert value(spark, sc.multiply_where(F.lit(2.0), steps)) == 2.0 * 1.1 * 0.5
    assert value(spark, sc.multiply_where(F.lit(None).cast("double"), steps)) is None


def test_spine_verifies_its_keys_in_the_plan(spark):
    from slatework.plans import spine

    schedule = spark.createDataFrame(
        [(1, "2024-05-01", 2024, "NYY", "BOS", 3), (2, "2024-05-01", 2024, "LAD", "SFG", 4)],
        "game_pk int, game_date string, season int, away_team string, home_team string, venue_id int",
    )
    weather = spark.createDataFrame([(1, 70.0, 1), (1, 75.0, 2), (1, 60.0, None), (9, 1.0, 1)], "game_pk int, temperature_f double, n int")
    lineups = spark.createDataFrame(
        [(1, "BOS", 1, 11, "a"), (1, "BOS", 2, 12, "b"), (1, "NYY", 1, 13, "c")],
        "game_pk int, team string, batting_order int, player_id int, player_name string",
    )
    starters = spark.createDataFrame([(1, "NYY", 5), (1, "NYY", 6), (1, None, 7)], "game_pk int, team string, pitcher_id int")
    out = spine.build_spine(schedule, weather=weather, projected=lineups, starters=starters, orders={"weather": ["n"]})
    first, second = out.orderBy("game_pk").collect()
    # Nulls sort last, as newest.
    assert (first.temperature_f, first.away_starter_pitcher_id, first.home_starter_found) == (60.0, 6, False)
    assert (first.home_projected_lineup_spots, first.away_projected_last_batter, first.lineups_projected_both_found) == (2, "c", True)
    assert second.temperature_f is None and not second.away_projected_lineup_found and not second.lineups_confirmed_both_found
    repeated = spine.build_spine(schedule, weather=weather)
    with pytest.raises(Exception, match="weather: repeated key game_pk=1"):
        repeated.collect()
    with pytest.raises(Exception, match="schedule: repeated key game_pk=2"):
        spine.build_spine(schedule.union(schedule.filter("game_pk = 2"))).collect()
    assert spine.build_spine(schedule, weather=weather, check=False).count() == 2
