"""Snapshots, chunk ledgers and mergeable profiles: what a second or a stopped run finds."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from slatework.operators import quality
from slatework.plans import history
from slatework.sources import snapshots


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_snapshots_follow_the_pointer(spark, tmp_path):
    root = str(tmp_path / "schedule")
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, root)
    snapshots.publish(spark.range(3), root, "2024-05-01")
    snapshots.publish(spark.range(5), root, "2024-05-02")
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2, 3, 4]
    assert ids(snapshots.read_snapshot(spark, root, "2024-05-01")) == [0, 1, 2]
    held = snapshots.read_snapshot(spark, root)
    with pytest.raises(PySparkException):
        snapshots.publish(spark.range(9).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint")), root, "2024-05-03")
    assert snapshots.labels(spark, root) == ["2024-05-01", "2024-05-02"]
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2, 3, 4]
    # A label published again: new readers see the new rows, a plan made before still has its files.
    snapshots.publish(spark.range(2), root, "2024-05-02")
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1] and ids(held) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        snapshots.read_snapshot(spark, root, "2024-06-01")


PITCHES = [
    # game, at-bat, pitch, month, event: at-bat 1 of game 7 goes on in the next month.
    (7, 1, 1, "2024-04", None), (7, 1, 2, "2024-05", "SINGLE"), (7, 2, 1, "2024-04", "WALK"),
    (8, 1, 1, "2024-05", None), (8, 1, 2, "2024-05", "HOME_RUN"), (9, 1, 1, "2024-06", "STRIKEOUT"),
]


def pitches(spark, months):
    rows = [(g, a, p, m, e, 100 + g, 200 + a, f"{m}-03") for g, a, p, m, e in PITCHES if m in months]
    names = "game_pk long, at_bat_number long, pitch long, month string, events string, batter long, pitcher long, game_date string"
    return spark.createDataFrame(rows, names)


def outcome(df):
    return sorted((r.game_pk, r.pa_index, r.event_type, str(r.game_date)) for r in df.collect())


def test_a_second_run_reads_new_chunks_only(spark, tmp_path):
    source, target, order = str(tmp_path / "pitches"), str(tmp_path / "season"), ["game_date", "pitch"]
    months = ["2024-04", "2024-05", "2024-06"]
    pitches(spark, months[:2]).write.partitionBy("month").parquet(source)
    first, built = history.rebuild_season(spark, source, target, 2024, order)
    assert built == months[:2]
    assert outcome(first) == outcome(history.season_pas(pitches(spark, months[:2]).drop("month"), 2024, order))
    assert history.rebuild_season(spark, source, target, 2024, order)[1] == []
    pitches(spark, months[2:]).write.mode("append").partitionBy("month").parquet(source)
    # Files of finished chunks may be unreadable by now: nothing opens them.
    for name in (tmp_path / "pitches" / "month=2024-04").glob("*.parquet"):
        held = name.stat()
        name.write_bytes(b"x" * held.st_size)
        import os

        os.utime(name, ns=(held.st_atime_ns, held.st_mtime_ns))
    for crc in (tmp_path / "pitches" / "month=2024-04").glob(".*.crc"):
        crc.unlink()
    whole, built = history.rebuild_season(spark, source, target, 2024, order)
    assert built == ["2024-06"]
    assert outcome(whole) == outcome(history.season_pas(pitches(spark, months).drop("month"), 2024, order))
    assert (7, 1, "single", "2024-05-03") in outcome(whole)


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    source, target, order = str(tmp_path / "pitches"), str(tmp_path / "season"), ["game_date", "pitch"]
    months = ["2024-04", "2024-05", "2024-06"]
    pitches(spark, months).write.partitionBy("month").parquet(source)
    real, calls = history.last_per_key, []

    def stops(df, by, order):
        calls.append(by)
        if len(calls) == 3:
            raise RuntimeError("executor gone")
        return real(df, by, order)

    monkeypatch.setattr(history, "last_per_key", stops)
    with pytest.raises(RuntimeError):
        history.rebuild_season(spark, source, target, 2024, order)
    monkeypatch.setattr(history, "last_per_key", real)
    whole, built = history.rebuild_season(spark, source, target, 2024, order)
    assert built == ["2024-06"]
    assert outcome(whole) == outcome(history.season_pas(pitches(spark, months).drop("month"), 2024, order))


def test_chunks_that_are_gone_leave_the_ledger(spark, tmp_path):
    source, target, order = tmp_path / "pitches", str(tmp_path / "season"), ["game_date", "pitch"]
    pitches(spark, ["2024-05", "2024-06"]).write.partitionBy("month").parquet(str(source))
    history.rebuild_season(spark, str(source), target, 2024, order)
    (source / "month=2024-06").rename(tmp_path / "elsewhere")
    left, built = history.rebuild_season(spark, str(source), target, 2024, order)
    assert built == [] and {r.game_pk for r in left.collect()} == {7, 8}


def test_profiles_of_parts_merge(spark):
    rows = [(k % 7 if k % 5 else None, f"2024-01-{1 + k % 20:02}", None if k % 3 else "x") for k in range(60)]
    df = spark.createDataFrame(rows, "k int, d string, v string").withColumn("d", F.to_date("d"))
    whole = {tuple(r) for r in quality.profile(df, ["k"], "d", ["v"]).collect()}
    parts = [df.filter(F.dayofmonth("d") % 3 == n) for n in range(3)] + [df.filter("false")]
    states = [quality.profile_state(p, ["k"], "d", ["v"]) for p in parts]
    assert {tuple(r) for r in quality.profile_of(states, ["k"]).collect()} == whole
    # In any grouping.
    two = [quality.merged_state(states[:2], ["k"]), quality.merged_state(states[2:], ["k"])]
    assert {tuple(r) for r in quality.profile_of(two, ["k"]).collect()} == whole
    empty = quality.profile_of([quality.profile_state(df.filter("false"), ["k"], "d", ["v"])], ["k"])
    assert {tuple(r) for r in empty.collect()} == {tuple(r) for r in quality.profile(df.filter("false"), ["k"], "d", ["v"]).collect()}
