"""Plans whose tasks and rows keep their size as tables grow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from slatework.catalog import base, views
from slatework.operators import asof, resolve, segments, slates
from slatework.operators.rolling import rolling
from slatework.plans import boards, features, inputs, model
from slatework.plans import mart as marts
from slatework.plans import spine as spines


def test_rows_carry_no_list_of_all_segments(spark, capsys):
    df = spark.range(300).select((F.col("id") % 2).alias("who"), (F.col("id") % 7).alias("day"), "id")
    cut = segments.with_segments(df, ["who"], ["day", "id"], 20)
    cut.explain()
    assert "_segments" not in capsys.readouterr().out


def test_derived_tables_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(10.0).alias("o_totalprice"), F.lit("2001-05-01").cast("timestamp").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(30).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(base, "TASK_ROWS", 100, raising=False)
    lineups = base.Tables(spark, str(tmp_path)).dt_lineups
    assert lineups.count() == 18 * 400
    assert lineups.select(F.spark_partition_id().alias("task")).groupBy("task").count().agg(F.max("count")).first()[0] < 800


def largest_task(df):
    return df.select(F.spark_partition_id().alias("task")).groupBy("task").count().agg(F.max("count")).first()[0]


def test_rolled_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(segments, "TASK_ROWS", 100, raising=False)
    df = spark.range(6000).select((F.col("id") % 900).alias("who"), F.col("id").alias("day"), F.lit(1.0).alias("v"))
    rolled = rolling(df, "who", ["day"], sums=["v"], windows=(3,))
    assert largest_task(rolled) < 400 and rolled.count() == 6000
    assert rolled.filter("who = 7").agg(F.sum("v_roll3")).first()[0] == 0 + 1 + 2 + 3 * 4


def facts(spark):
    rows = [("a", 1, 1, 5.0), ("a", 1, 2, None), ("a", 3, 3, 7.0), ("b", 2, 4, 8.0), (None, 1, 5, 9.0), ("b", None, 6, 1.0)]
    return spark.createDataFrame([(who, day and dt.date(2024, 1, day), g, v) for who, day, g, v in rows], "who string, day date, g int, v double")


@pytest.mark.parametrize("segment_rows", [1, 100])
def test_both_ways_of_the_asof_join_agree(spark, segment_rows, monkeypatch):
    monkeypatch.setattr(asof, "SEGMENT_ROWS", segment_rows)
    asks = [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 2), ("b", 3), ("z", 3), (None, 3), ("a", None), ("a", 4)]
    left = spark.createDataFrame([(i, who, day and dt.date(2024, 1, day)) for i, (who, day) in enumerate(asks)], "k int, who string, day date")
    strict = asof.asof_join(left, facts(spark), "who", "day", ["g", "v"], tie=["g"], segment_rows=segment_rows)
    assert sorted(tuple(r) for r in strict.select("k", "g", "v").fillna(-1).collect()) == [
        (0, -1, -1), (1, 2, -1), (2, 2, -1), (3, 3, 7), (4, -1, -1), (5, 4, 8), (6, -1, -1), (9, 3, 7),
    ]
    upto = asof.latest_by_row(left, facts(spark), "who", "who", "day", ["g"], ["g"], prefix="x_")
    assert sorted(tuple(r) for r in upto.select("k", "x_g").fillna(-1).collect()) == [
        (0, 2), (1, 2), (2, 3), (3, 3), (4, 4), (5, 4), (6, -1), (7, -1), (8, -1), (9, 3),
    ]


def test_asof_rows_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(segments, "TASK_ROWS", 100, raising=False)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("day")
    df = spark.range(6000).select("id", (F.col("id") % 900).alias("who"), day)
    assert largest_task(asof.asof_join(df, df, "who", "day", ["id"], rename={"id": "found"})) < 400


def players(spark):
    """Spine, lineups of both sides dealt by game, batter and pitcher rollings."""
    day = F.lit("2024-05-01").cast("date").alias("game_date")
    spine = spark.range(700).select(
        F.col("id").alias("game_pk"), day, F.lit("NYY").alias("home_team"), F.lit("BOS").alias("away_team"),
        F.lit(1).alias("home_starter_pitcher_id"), F.lit(2).alias("away_starter_pitcher_id"),
        *[F.lit(1.0).alias(c) for c in features.WEATHER_DEFAULTS],
    )
    lineups = spark.range(7000).select(
        (F.col("id") % 700).alias("game_pk"), day, F.lit("NYY").alias("team"), (F.col("id") % 2 == 0).alias("is_home"),
        F.col("id").alias("player_id"),
    )
    early = F.lit("2024-04-01").cast("date").alias("game_date")
    bat = spark.range(7000).select(F.col("id").alias("batter_id"), early, F.lit(1).alias("game_pk"), F.lit(0.25).alias("bat_iso_roll30"))
    pit = spark.range(3).select(F.col("id").alias("pitcher_id"), early, F.lit(1).alias("game_pk"), F.col("id").cast("double").alias("pit_hr9_roll30"))
    return spine, lineups, bat, pit


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_player_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "TASK_ROWS", 100, raising=False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        day = F.lit("2024-05-01").cast("date").alias("game_date")
        spine = spark.range(700).select(
            F.col("id").alias("game_pk"), day, F.lit("NYY").alias("home_team"), F.lit("BOS").alias("away_team"),
            F.lit(1).alias("home_starter_pitcher_id"), F.lit(2).alias("away_starter_pitcher_id"),
            *[F.lit(1.0).alias(c) for c in features.WEATHER_DEFAULTS],
        )
        lineups = spark.range(7000).select(
            (F.col("id") % 700).alias("game_pk"), day, F.lit("NYY").alias("team"), (F.col("id") % 2 == 0).alias("is_home"),
            F.col("id").alias("player_id"),
        )
        early = F.lit("2024-04-01").cast("date").alias("game_date")
        bat = spark.range(7000).select(F.col("id").alias("batter_id"), early, F.lit(1).alias("game_pk"), F.lit(0.25).alias("bat_iso_roll30"))
        pit = spark.range(3).select(F.col("id").alias("pitcher_id"), early, F.lit(1).alias("game_pk"), F.col("id").cast("double").alias("pit_hr9_roll30"))
        history = features.player_history(spine, lineups, bat, pit)
        assert largest_task(history) < 600
        found = history.groupBy("is_home", "opp_pitcher_id", "opp_pit_hr9", "bat_iso").count().collect()
        assert sorted(tuple(r) for r in found) == [(False, 1, 1.0, 0.25, 3500), (True, 2, 2.0, 0.25, 3500)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lineup_rows_move_once_and_carry_what_the_view_reads(spark, monkeypatch, capsys):
    monkeypatch.setattr(segments, "TASK_ROWS", 100, raising=False)
    spine, lineups, bat, pit = players(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = features.player_history(spine, segments.dealt(lineups, 7000, "game_pk"), bat, pit, reads=features.TB2_READS)
        plan = plan_of(history, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Lineups to the games' tasks, sides to their starter and back, rows to their batter; the facts of both.
    assert "hashpartitioning(game_pk" in plan and not any("game_date" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    assert "bat_tb_per_pa" in history.columns and "bat_k_rate" not in history.columns and "opp_pit_bb_rate" not in history.columns


def test_a_row_without_a_side_keeps_its_game_but_no_starter(spark):
    spine, lineups, _, pit = players(spark)
    rows = lineups.filter("player_id in (3, 4)").withColumn("is_home", F.when(F.col("player_id") == 4, True))
    other_day = rows.withColumn("game_date", F.date_add("game_date", 1))
    got = features._with_games(rows.unionByName(other_day), 4, spine.union(spine.limit(0)), pit, ["pit_hr9_roll30"], "opp_")
    found = got.select("player_id", F.day("game_date").alias("day"), "home_team", "wind_mph", "opp_pitcher_id", "opp_pit_hr9_roll30").collect()
    assert sorted(tuple(r) for r in found) == [
        (3, 1, "NYY", 1.0, None, None), (3, 2, None, None, None, None), (4, 1, "NYY", 1.0, 2, 2.0), (4, 2, None, None, None, None),
    ]


def test_statistics_of_a_slate_do_not_move_its_rows(spark, capsys):
    df = spark.range(4000).select((F.col("id") % 9).alias("day"), F.when(F.col("id") % 5 > 0, F.col("id") * 1.0).alias("v"))
    filled = slates.fill_with_median(df, ["day"], {"v": 0.0})
    scored = slates.zscore_by(filled, ["day"], "v", "z")
    repaired = boards._repaired(df.withColumn("expected_hr_neutral", F.col("v")), "day")
    for frame in (filled, scored, repaired):
        plan = plan_of(frame, capsys)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert filled.filter("v is null").count() == 0 and filled.count() == scored.count() == 4000


def test_entities_are_counted_in_large_buckets_only(spark, monkeypatch):
    asked = []
    real = segments.key_bucket
    monkeypatch.setattr(asof, "key_bucket", lambda *keys: asked.append(keys) or real(*keys))
    df = spark.range(50).select("id", (F.col("id") % 5).alias("who"), F.lit("2024-01-01").cast("date").alias("day"))
    assert asof.asof_join(df, df, "who", "day", ["id"], rename={"id": "found"}).count() == 50 and asked == [("_id",)]
    large = segments._only_large(df.unionByName(df.filter("who = 3")), ["who"], 15).distinct()
    assert {r["who"] for r in large.collect()} == {3}


def test_winner_views_read_the_shortest_window(spark, monkeypatch):
    names = [f"{c}_roll{w}" for c in views._FORM_BAT + views._FORM_PIT for w in (7, 15)]
    form = spark.range(1).select(*[F.lit(1).alias(c) for c in ("batter_id", "pitcher_id", "game_date", "game_pk")], *[F.lit(0.5).alias(c) for c in dict.fromkeys(names)])
    monkeypatch.setattr(views, "_game_form", lambda t: (form, form))
    assert not any(c.endswith("roll15") for part in views._week_form(None) for c in part.columns)


def test_only_what_is_read_is_written(spark):
    mart = spark.createDataFrame([(1, 1, 2001, "out", 0.1, 0.2, "x")], "game_pk int, pa_index int, season int, pa_outcome_target string, bat_pa_roll30 double, bat_pa_roll3 double, batter_name string")
    assert model.columns_read(mart) == ["game_pk", "pa_index", "season", "pa_outcome_target", "bat_pa_roll30"]
    view = spark.createDataFrame([("n", 0.1, 0.1, 1.0)], "player_name string, iso double, bat_iso double, env_temp_boost double")
    assert views._staged_view(view, "view").columns == ["player_name", "iso"]


def test_name_keys_are_made_once_and_in_tasks_of_bounded_size(spark, monkeypatch, capsys):
    monkeypatch.setattr(resolve, "NAME_TASK_ROWS", 100, raising=False)
    people = spark.range(0, 3000, 1, 1).select(
        F.col("id").alias("player_id"), F.concat(F.lit("x n"), F.col("id").cast("string")).alias("player_name"), F.lit("t").alias("team")
    )
    key = F.reverse(F.reverse(F.lower("player_name")))
    rows = resolve.key_rows(people, "player_id", key, [resolve.EXACT, resolve.LAST])
    assert plan_of(rows, capsys).count("reverse(reverse(") == 1 and rows.count() == 6000
    assert "RoundRobinPartitioning(30)" in plan_of(resolve.build_lookup([people], "player_id"), capsys)
    spread = []
    monkeypatch.setattr(resolve, "stage", lambda df, label: spread.append(largest_task(df)) or df, raising=False)
    lookup = resolve.key_rows(people.withColumn("team", F.lit("T")), "player_id", key, [resolve.EXACT])
    found = resolve.resolve_ids(people.drop("player_id"), lookup, "player_name", "player_id", "how", [(resolve.EXACT, "exact")], key)
    assert found.filter("how = 'exact' and player_name = concat('x n', player_id)").count() == 3000
    assert spread and spread[0] <= 110


def teams_dealt_by_game(spark):
    """Games, lineups and starters of both sides, all dealt by game alike."""
    day = F.lit("2024-05-01").cast("date").alias("game_date")
    games = spark.range(40).select(
        F.col("id").alias("game_pk"), day, F.lit(2024).alias("season"), F.lit("NYY").alias("home_team"), F.lit("BOS").alias("away_team"),
        (F.col("id") % 3).alias("venue_id"),
    ).repartition(6, "game_pk")
    sides = games.select("game_pk", F.explode(F.array(F.lit("NYY"), F.lit("BOS"))).alias("team"))
    lineups = sides.select("*", F.explode(F.sequence(F.lit(1), F.lit(9))).alias("batting_order")).select(
        "*", (F.col("game_pk") * 10 + F.col("batting_order")).alias("player_id"), F.lit("n").alias("player_name")
    )
    return games, lineups, sides.withColumn("pitcher_id", F.col("game_pk") + 1)


def rows_moved(df, capsys):
    return sum("Exchange hashpartitioning" in line and "ENSURE_REQUIREMENTS" in line for line in plan_of(df, capsys).splitlines())


def test_games_of_a_slate_are_put_together_where_they_lie(spark, capsys):
    games, lineups, starters = teams_dealt_by_game(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        short = lineups.filter("game_pk % 2 = 0 or batting_order < 9")
        chosen = inputs.slate_games(games, lineups, short, starters.filter("game_pk <> 8"))
        assert rows_moved(chosen, capsys) == 0
        found = chosen.groupBy("home_lineup_source", "away_lineup_source").count().collect()
        assert sorted(tuple(r) for r in found) == [("confirmed", "confirmed", 19), ("projected", "projected", 20)]
        assert chosen.filter("game_pk = 3").first()["home_batters"] == ",".join(str(30 + k) for k in range(1, 10))
        # A game listed twice comes twice, one whose teams are unknown not at all.
        listed = games.filter("game_pk = 3").unionByName(games.filter("game_pk in (3, 4)").withColumn("away_team", F.when(F.col("game_pk") == 3, "BOS")))
        assert [r["game_pk"] for r in inputs.slate_games(listed, lineups, short, starters).collect()] == [3, 3]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_spine_is_assembled_where_games_lie(spark, capsys):
    games, lineups, starters = teams_dealt_by_game(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spines.build_spine(games, games, None, None, lineups, lineups, starters)
        # Columns that nobody reads are not folded either.
        read = out.select("game_pk", "home_projected_distinct_players", "away_starter_pitcher_id", "starters_both_found")
        assert rows_moved(read, capsys) == 0 and "first_batter" not in plan_of(read, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {tuple(r)[1:] for r in read.select("game_pk", "home_projected_distinct_players", F.col("away_starter_pitcher_id") - F.col("game_pk"), "starters_both_found").collect()} == {(9, 1, True)}


def test_lineup_cards_broadcast_no_rendered_list(spark, tmp_path, capsys):
    orders = spark.range(40).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.lit(10.0).alias("o_totalprice"), F.lit("2001-05-01").cast("timestamp").alias("o_orderdate"),
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(30).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(30).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    cards = base.registered()["io15_lineup_cards"](spark, str(tmp_path))
    cards.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert cards.filter("record_type = 'lineup'").count() == 18 * 40


@pytest.fixture
def unhinted(spark):
    """No table is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_mart_joins_where_the_games_lie(spark, unhinted, capsys):
    day = F.lit("2001-05-01").cast("date")
    pa = spark.range(60).select(
        (F.col("id") % 6).alias("game_pk"), (F.col("id") % 4).alias("batter_id"), (F.col("id") % 3).alias("pitcher_id"),
        day.alias("game_date"), F.col("id").alias("pa_index"), F.lit(True).alias("is_pa"),
    )
    pa = segments.dealt(pa, 60, "game_pk")
    games = spark.range(24).select((F.col("id") % 6).alias("game_pk"), (F.col("id") % 5).alias("batter_id"), F.col("id").alias("hits_roll7"))
    games = games.dropDuplicates(["game_pk", "batter_id"]).filter("batter_id <> 2")
    arms = games.withColumnsRenamed({"batter_id": "pitcher_id", "hits_roll7": "outs_roll7"})
    built = marts.build_mart(pa, games, arms)
    plain = pa.join(games, ["game_pk", "batter_id"], "left").join(arms, ["game_pk", "pitcher_id"], "left")
    got = built.select("pa_index", "bat_hits_roll7", "pit_outs_roll7").collect()
    assert sorted(map(str, got)) == sorted(
        map(str, plain.select("pa_index", F.col("hits_roll7").alias("bat_hits_roll7"), F.col("outs_roll7").alias("pit_outs_roll7")).collect())
    )
    capsys.readouterr()
    mart_only = marts.build_mart(pa, spark.createDataFrame(games.collect(), games.schema), spark.createDataFrame(arms.collect(), arms.schema))
    mart_only.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 3


def test_first_inning_views_read_part_of_the_form(spark, monkeypatch):
    names = [f"{c}_roll{w}" for c in views._FORM_BAT + views._FORM_PIT for w in (7, 15)]
    form = spark.range(1).select(*[F.lit(1).alias(c) for c in ("batter_id", "pitcher_id", "game_date", "game_pk")], *[F.lit(0.5).alias(c) for c in dict.fromkeys(names)])
    monkeypatch.setattr(views, "_game_form", lambda t: (form, form))
    assert [len(part.columns) for part in views._early_form(None)] == [6, 10]


def test_game_views_ask_both_starters_at_once(spark, monkeypatch):
    asked, real = [], features.latest_by_row
    monkeypatch.setattr(features, "latest_by_row", lambda left, *a, **k: asked.append(left.columns) or real(left, *a, **k))
    day = dt.date(2024, 5, 1)
    spine = spark.createDataFrame(
        [(1, day, "A", "B", 1, 2), (None, day, "A", "B", 2, None), (2, day, "A", None, None, 1), (2, dt.date(2024, 5, 2), "C", "A", 1, 1)],
        "game_pk int, game_date date, home_team string, away_team string, home_sp_id int, away_sp_id int",
    )
    lineups = spark.createDataFrame(
        [(g, day, team, who, 1) for g in (1, 2) for team, who in (("A", 11), ("B", 12), (None, 11))],
        "game_pk int, game_date date, team string, player_id int, batting_order int",
    )
    bat = spark.createDataFrame([(0, dt.date(2024, 4, 30), 11, 1.0)], "game_pk int, game_date date, batter_id int, rbi_roll7 double")
    pit = spark.createDataFrame([(0, dt.date(2024, 4, 30), k, k / 4) for k in (1, 2)], "game_pk int, game_date date, pitcher_id int, k_rate_roll7 double")
    view = features.moneyline_view(spine, lineups, bat, pit)
    assert asked[0] == ["game_pk", "game_date", "_side", "_arm"] and len(asked) == 2
    got = {r.game_pk: (r.game_date, r.home_sp_k_rate_roll7, r.away_sp_k_rate_roll7, r.home_team_rbi_roll7, r.away_team_lineup_count) for r in view.collect()}
    assert got == {1: (day, 0.25, 0.5, 1.0, 1), None: (day, 0.5, None, None, None), 2: (day, None, 0.25, 1.0, None)}


def test_boards_get_the_columns_they_read(spark):
    view = spark.createDataFrame(
        [("n", "A", 0.1, 1, 0.2, 3.0, 9)], "player_name string, team string, iso double, season int, rbi_weather_delta double, lineup_spot double, home_starter_pitcher_id int"
    )
    assert views._staged_view(view, "view", boards.RBI_BOARD).columns == ["player_name", "team", "iso", "rbi_weather_delta", "lineup_spot"]


def test_teams_of_a_game_are_added_up_once(spark, unhinted, capsys):
    day = dt.date(2024, 5, 1)
    spine = spark.createDataFrame(
        [(1, day, "A", "B", 5, None), (2, day, "A", None, 5, 6), (None, day, "A", "B", 5, 6)],
        "game_pk int, game_date date, home_team string, away_team string, home_sp_id int, away_sp_id int",
    )
    columns = ["expected_pa", "expected_hr_neutral_player", "expected_hr_today_player", "env_hr_delta_player", "barrel_rate", "iso", "hr_per_pa", "hard_hit_rate", "flyball", "pulled_air"]
    names = [(1, "A", "x"), (1, "A", None), (1, "B", "y"), (2, "A", "x"), (2, None, "z")]
    players = spark.createDataFrame(names, "game_pk int, team string, player_name string").select(
        "*", F.lit(day).alias("game_date"), *[F.lit(0.25).alias(c) for c in columns]
    )
    view = features.no_hr_view(spine, players)
    assert plan_of(view, capsys).count("Exchange hashpartitioning") == 2
    got = {r.game_pk: (r.home_lineup_count, r.away_lineup_count, r.expected_hr_today, r.home_avg_iso, r.away_avg_iso, f"{r.expected_hr_today_adj:.2f}") for r in view.collect()}
    assert got == {
        1: (1, 1, 0.75, 0.25, 0.25, "0.96"), 2: (1, 0, 0.25, 0.25, None, "0.41"), None: (0, 0, 0.0, None, None, "0.16"),
    }
