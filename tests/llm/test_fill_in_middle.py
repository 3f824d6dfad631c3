import hashlib
import random
import re

import numpy as np
import pytest

from slatework.llm import fill_in_middle as fim
from tests.llm import cases

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        units = UNIT.findall(text)
        h = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
        n = len(units)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((doc_id, n, "plain", None, None, sha(text), sha(text)))
        elif h4 % 100 < 20:
            out.append((doc_id, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)))
        else:
            out.append((doc_id, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)))
    return sorted(out, key=repr)


def check(docs):
    assert cases.result(fim.digest(docs)) == brute(cases.pairs(docs))


MARKS = [(k, text) for k in range(20, 60) for text in ("<P", "a<S> b", "<<P<M", "P><S<S", "<M>", "x <<S <<M <", "é1😀 ab" * k)]


def test_odd_rows(spark):
    check(cases.frame(spark, cases.odd_texts() + MARKS).repartition(3))


def test_documents(spark):
    check(cases.table(spark, "documents"))


def test_empty_table_and_kept_columns(spark):
    assert fim.digest(cases.frame(spark, [])).count() == 0
    kept = fim.transform(cases.frame(spark, [(1, "a b c")]), keep=["uid", "fp"])
    assert kept.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "uid", "fp"]
    assert kept.first()["fp"] == "x"
    with pytest.raises(ValueError):
        fim.transform(cases.frame(spark, [(1, "a")]), keep=["doc_id"])


@pytest.mark.parametrize("size", [0, 1, 2, 7, 8, 9, 100, 5000])
def test_every_rank_is_reached(size):
    rng = np.random.default_rng(size)
    widths = rng.integers(1, 9, size)
    index = fim.SkipList(widths)
    before = np.r_[0, np.cumsum(widths)]
    assert len(index) == size
    assert [index.reach(r) for r in range(size + 1)] == before.tolist()
    for bad in (-1, size + 1):
        with pytest.raises(IndexError):
            index.reach(bad)
    # Express lanes thin out and each spans everything.
    assert all(u.sum() == size and p.sum() == widths.sum() for u, p in zip(index.units, index.points))
    if size == 5000:
        assert 5 <= len(index.units) <= 9 and len(index.units[-1]) <= 2 * fim.RISE


def test_units_are_those_of_the_pattern():
    random.seed(5)
    for _ in range(300):
        text = "".join(random.choice("abZ @[`{é\x00😀1\n") for _ in range(random.randrange(40)))
        widths = fim.unit_widths(np.frombuffer(text.encode("utf-32-le"), "<u4"))
        assert widths.tolist() == [len(u) for u in UNIT.findall(text)]
