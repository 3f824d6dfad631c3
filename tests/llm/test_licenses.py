import re

from slatework.llm import licenses
from tests.llm import cases

TEMPLATES = licenses.TEMPLATES


def brute(text, template, coverage=0.8, stretch=2):
    """Leftmost matches by aligning at every word of the text."""
    words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", text or "")]
    target = [w.lower() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", template)]
    found, k = [], 0
    while k < len(words):
        part = words[k : k + stretch * len(target)]
        pairs = licenses.align(target, [w for w, _, _ in part])
        if words[k][0] in target and pairs and pairs[0][1] == 0 and len(pairs) >= coverage * len(target) - 1e-9:
            end = pairs[-1][1]
            found.append((words[k][1], part[end][2], len(pairs) / len(target)))
            k += end + 1
        else:
            k += 1
    return found


def check(docs):
    mine = cases.result(licenses.scan(docs))
    expected = [
        (doc_id, name, *match)
        for doc_id, text in cases.pairs(docs)
        for name, template in TEMPLATES.items()
        for match in brute(text, template)
    ]
    assert mine == sorted(expected, key=repr)
    return mine


def test_odd_rows(spark):
    mit = TEMPLATES["MIT text"]
    extra = [
        (30, "é😀 " + TEMPLATES["MIT"] + " " + TEMPLATES["MIT"].upper() + " tail"),
        (31, "Licensed, friends, under the APACHE license (version 2.0)"),
        (32, mit.replace("free of charge, ", "").replace("merge", "MERGE,")),
        (33, " ".join(mit.split()[:40])),
        (34, TEMPLATES["GPL-3.0"] * 3 + "This work is licensed under something else, version 3"),
        (35, "word " * 500_000 + TEMPLATES["CC-BY-NC-4.0"]),
    ]
    rows = [r for r in cases.odd_texts() if r[1] is None or len(r[1]) < 10_000]
    assert len(check(cases.frame(spark, rows + extra[:-1]).repartition(3))) == 7
    (only,) = licenses.scan(cases.frame(spark, extra[-1:])).collect()
    assert (only.license, only.start) == ("CC-BY-NC-4.0", 2_500_000)


def test_documents(spark):
    docs = cases.table(spark, "documents")
    short = docs.where("length(text) < 3000")
    check(short)


def test_empty_table(spark):
    assert licenses.scan(cases.frame(spark, [])).count() == 0


def test_alignment_rises_and_matches():
    import random

    rng = random.Random(2)
    for _ in range(300):
        a = [rng.choice("abcdefg") for _ in range(rng.randint(0, 12))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < u and j < v for (i, j), (u, v) in zip(pairs, pairs[1:]))
        if a == b:
            assert len(pairs) == len(a)
