import math
import random

import pytest
from pyspark.sql import functions as F

from slatework.llm import topk_search
from tests.llm import cases


def brute(rows, k=5, scale=256):
    usable = [
        (n, i, [math.floor(x * scale) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, q in usable:
        if i % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, j, v in usable if m != n)
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, uid string")
    found = topk_search.search(df.repartition(3), F.col("vec_id") % 50 == 0, **options)
    mine = sorted(tuple(r) for r in found.collect())
    assert mine == brute(rows)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(300)]
    rows += [(900, None), (950, [1.0, None]), (1000, [float("nan")]), (1050, [float("inf"), 1.0]), (None, [1.0])]
    rows += [(1100, [0.0] * 6), (1150, []), (1200, [1.0, 2.0]), (1250, [3.0] * 9)]
    rows += [(100, [0.5] * 6), (100, [0.5] * 6)] + [(2000 + i, [2.0] * 6) for i in range(60)]
    check(spark, rows, bucket=16)


def test_fewer_rows_than_k(spark):
    check(spark, [(0, [1.0, -1.0]), (50, [-1.0, 2.0]), (7, [3.0, 3.0])])
    check(spark, [(0, [1.0])])


def test_large_numbers_stay_exact(spark):
    rows = [(50 * i, [1e6 + i, 3e5 - i, 1.0]) for i in range(12)]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk_search.search(df, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("bucket", [32, 1024])
def test_embeddings(spark, bucket):
    table = cases.table(spark, "embeddings", "/root/testdata/sf0.01")
    found = topk_search.search(table, F.col("vec_id") % 50 == 0, bucket=bucket)
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_pruning_skips_rows_but_no_answer():
    import numpy as np

    rng = np.random.default_rng(4)
    numbers = rng.integers(-200, 200, (400, 8))
    row = dict(zip(topk_search._NAMES, topk_search._packed(np.arange(400), np.arange(400), list(numbers))))
    bucket, query = topk_search.Bucket(row), topk_search.Block(row)
    bucket.meet(query)
    skipped = 0
    for q in range(50):
        scores = numbers @ numbers[q]
        edge = np.sort(np.delete(scores, q))[-5]
        left = bucket.remaining(query.vectors[q], query.norms[q], edge)
        assert set(np.flatnonzero(scores >= edge)) <= set(left)
        skipped += 400 - len(left)
    assert skipped > 2000


def _shapes():
    import numpy as np

    rng = np.random.default_rng(7)
    sparse = rng.normal(0, 1, (600, 64)) * (rng.random((600, 64)) < 0.04)
    peaked = rng.normal(0, 0.1, (600, 12))
    peaked[np.arange(600), rng.integers(0, 12, 600)] = rng.choice([-1.0, 1.0], 600) * rng.uniform(0.5, 2, 600)
    return {"sparse": sparse, "peaked": peaked, "low-dimensional": rng.normal(0, 1, (600, 3)), "line": rng.normal(0, 1, (600, 1))}


@pytest.mark.parametrize("shape", ["sparse", "peaked", "low-dimensional", "line"])
def test_rows_near_an_axis_are_found_over_buckets(spark, shape):
    check(spark, list(enumerate(_shapes()[shape].tolist())), bucket=64)


@pytest.mark.parametrize("shape", ["sparse", "peaked", "low-dimensional"])
def test_pruning_keeps_rows_near_an_axis(shape):
    import numpy as np

    numbers = np.floor(_shapes()[shape] * 256).astype(np.int64)
    row = dict(zip(topk_search._NAMES, topk_search._packed(np.arange(600), np.arange(600), list(numbers))))
    bucket, query = topk_search.Bucket(row), topk_search.Block(row)
    bucket.meet(query)
    for q in range(600):
        scores = numbers @ numbers[q]
        for edge in np.sort(scores)[[-1, -3, -6]]:
            assert set(np.flatnonzero(scores >= edge)) <= set(bucket.remaining(query.vectors[q], query.norms[q], edge))


def test_a_copy_of_a_peaked_query_is_not_pruned():
    import numpy as np

    numbers = np.array([[905, 425], [-905, -425]])
    row = dict(zip(topk_search._NAMES, topk_search._packed(np.arange(2), np.arange(2), list(numbers))))
    bucket, query = topk_search.Bucket(row), topk_search.Block(row)
    bucket.meet(query)
    for q in range(2):
        edge = 0.6 * query.norms[q] ** 2
        assert list(bucket.remaining(query.vectors[q], query.norms[q], edge)) == [q]


def test_queries_and_vectors_meet_as_small_rows(spark, capsys):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = topk_search.search(df, F.col("vec_id") % 2 == 0, bucket=16)
    capsys.readouterr()
    found.explain()
    plan = capsys.readouterr().out
    # No row that a task reads holds a packed block, and no table of vectors or queries is broadcast.
    assert "numbers" not in plan and plan.count("BroadcastExchange") == 1 and "start#" in plan


def test_groups_of_buckets_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "GROUP", 64)
    rng = random.Random(5)
    check(spark, [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(500)], bucket=8)
