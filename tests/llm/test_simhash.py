import random

from slatework.llm import simhash
from slatework.llm.components import components
from tests.llm import brute, cases


def check(docs):
    assert cases.result(simhash.near_duplicates(docs)) == brute.near_duplicates(cases.pairs(docs))


def test_odd_rows(spark):
    check(cases.frame(spark, cases.odd_texts()).repartition(3))


def test_documents(spark):
    check(cases.table(spark, "documents"))


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.frame(spark, [])).count() == 0


def flipped(rng, value):
    for bit in rng.sample(range(64), rng.randint(0, 4)):
        value ^= 1 << bit
    return value


def test_split_shards_lose_no_link(spark):
    """Clusters of close fingerprints, with trees of four: every part meets every other."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({flipped(rng, rng.choice(centres)) for _ in range(300)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), tree_size=4)
    mine = {r.node: r.component for r in components(edges).collect()}
    label = {v: mine.get(s, s) for v, s in zip(values, signed)}
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 3:
                parent[root(a)] = root(b)
    for a in values:
        for b in values:
            assert (root(a) == root(b)) == (label[a] == label[b])


def test_chain_of_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(60, 61), (61, 60), (70, 70)]
    mine = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert mine == {**{i: 0 for i in range(51)}, 60: 60, 61: 60}


def test_tree_search_equals_scan():
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = [flipped(rng, centre) for _ in range(200)] + [rng.getrandbits(64) for _ in range(200)]
    tree = simhash.BKTree()
    for value in values:
        tree.add(value)
    for value in values:
        found = sorted(tree.within(value, 3))
        assert found == [i for i, other in enumerate(values) if (value ^ other).bit_count() <= 3]
