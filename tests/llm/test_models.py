"""Language identification, toxicity and the language model: odd rows, held-out accuracy, brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from slatework.llm import language_id, ngram_lm, toxicity
from tests.llm import brute, cases

DATA = "/root/testdata/sf0.01"


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


# -- language --------------------------------------------------------------


def test_language_on_documents(spark):
    docs = cases.table(spark, "documents", DATA)
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = language_id.predictions(docs).collect()
    assert len(out) == len(truth)
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_of_odd_rows(spark):
    learned = [(1000 + k, f"hello world number {k} of the words", "en") for k in range(40)]
    learned += [(2000 + k, f"bonjour le monde numéro {k} des mots", "fr") for k in range(40)]
    odd = [(d, t, None) for d, t in cases.odd_texts()] + [(50, "12 34 !!", "en"), (51, "日本語", None), (52, "°°", "fr")]
    df = spark.createDataFrame([(*r, "x", 1.5) for r in learned + odd], "doc_id bigint, text string, lang string, score string, lang_pred double")
    out = {(r.doc_id, r.lang_pred) for r in language_id.predictions(df).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (50, "und"), (52, "und"), (None, "und")} <= out
    assert not {(51, "und"), (4, "und"), (9, "und")} & out
    assert all(lang == "en" for d, lang in out if d and 1000 <= d < 2000)
    assert all(lang == "fr" for d, lang in out if d and d >= 2000)


def test_language_without_anything_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in language_id.predictions(df).collect()] == [(1, crc(1, 3) == 1, "und", 0.0)]
    assert language_id.predictions(df.where("false")).count() == 0


def test_presence_kernel_equals_sets():
    texts = [b"abcabc", b"abd", b"xyz", b"a"]
    grams = [np.unique(np.concatenate([language_id._codes(t, n) for t in texts])) for n in (1, 2, 3)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    rows = language_id.Features(grams).presence(data, np.r_[0, ends[:-1]], ends)

    def of(t):
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}

    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            expected = len(of(a) & of(b)) / math.sqrt(len(of(a)) * len(of(b)))
            assert rows[i] @ rows[j] == pytest.approx(expected, abs=1e-5)


# -- toxicity --------------------------------------------------------------


def toxic_rows():
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(600):
        text = list(rng.choice(words, rng.integers(20, 200)))
        toxic = k % 3 == 0
        for _ in range(max(2, len(text) // 20) if toxic else 0):
            text[rng.integers(len(text))] = str(rng.choice(["vile", "scorn", "venom"]))
        docs.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_toxicity_held_out(spark):
    docs, labels = toxic_rows()
    marks = spark.createDataFrame([(*r, 1) for r in labels] + [(None, 1, 1), (3, None, 1)], "doc_id bigint, toxic int, quality int")
    out = toxicity.predictions(cases.frame(spark, docs + cases.odd_texts()), marks).collect()
    assert len(out) == len(docs) + len(cases.odd_texts())
    truth = dict(labels)
    held = [r for r in out if r.doc_id is not None and r.doc_id >= 20 and crc(r.doc_id, 5) == 0]
    assert all(r.held_out for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_toxicity_without_a_class(spark):
    docs = cases.frame(spark, [(1, "a"), (2, None)])
    marks = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.predictions(docs, marks).collect()} == {(0.0, 0)}
    assert toxicity.predictions(docs.where("false"), marks.where("false")).count() == 0


def test_class_models_sum_to_one(spark):
    """What the listed expressions of a level or context take, and what is left to the backoff, are one."""
    import pyarrow as pa

    docs, labels = toxic_rows()
    truth = dict(labels)
    rows = spark.createDataFrame([(truth[i], text) for i, text in docs], "toxic int, text string")
    levels, pairs, contexts = toxicity.count(rows)
    parts = [toxicity.expressions(pa.array([text])) for _, text in docs]
    found = [x for part in parts for x in part]
    kinds = len(np.unique(np.concatenate([x[1][0] for x in found])))
    forms = {}
    for number in range(len(toxicity.STEMS)):
        of = {}
        for x in found:
            for stem, word in zip(x[1][number + 1].tolist(), x[1][0].tolist()):
                of.setdefault(stem, set()).add(word)
        forms[number + 1] = of
    assert len(levels[0].keys)  # the toxic words have lifts of their own
    for number, level in enumerate(levels):
        shared = [len(forms[number][k]) if number else 1 for k in level.keys.tolist()]
        taken = (level.lifts * (np.array(shared) + 0.5) / (kinds + 1)).sum(axis=1)
        assert taken + level.rest == pytest.approx([1, 1], abs=1e-9)
        assert (level.rest > 0).all() and (level.lifts >= 0).all()
    first = {p: b for x in found for p, b in zip(x[3].tolist(), x[2].tolist())}
    total = pairs.rest.copy()
    for k, key in enumerate(pairs.keys.tolist()):
        total[:, np.searchsorted(contexts, np.uint64(first[key]))] += pairs.lifts[:, k] * 1.5 / (kinds + 1)
    assert total == pytest.approx(np.ones_like(total), abs=1e-9)


# -- language model --------------------------------------------------------


def lm_brute(rows, folds=10):
    tokens = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(brute.ASCII)) + ["</s>"]) for i, t in rows]
    learned = [t for i, t in tokens if i is not None and crc(i, folds) != 0]
    words = Counter(w for t in learned for w in t)
    contexts = Counter(c for t in learned for c in ["<s>", *t[:-1]])
    bigrams = Counter(b for t in learned for b in zip(["<s>", *t], t))
    kinds = Counter(a for a, _ in bigrams)
    n, v = sum(words.values()), len(words)
    gone = (sum(c == 1 for c in words.values()) + 0.5) / (v + 1)

    def single(w):
        return 1.0 if not n else (words[w] - gone) / n if words[w] else gone * v / n

    out = []
    for i, t in tokens:
        base = sum(math.log10((words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = 0.0
        for a, b in zip(["<s>", *t], t):
            p = single(b)
            if contexts[a]:
                p = max(bigrams[a, b] - 0.75, 0) / contexts[a] + 0.75 * kinds[a] / contexts[a] * p
            score += math.log10(p)
        held = i is not None and crc(i, folds) == 0
        out.append((i, held, len(t), sum(words[w] > 0 for w in t), n, base, score))
    return out


def lm_check(df):
    mine = sorted((tuple(r) for r in ngram_lm.scores(df).collect()), key=lambda r: repr(r[:4]))
    theirs = sorted(lm_brute(cases.pairs(df)), key=lambda r: repr(r[:4]))
    assert [r[:5] for r in mine] == [r[:5] for r in theirs]
    for a, b in zip(mine, theirs):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        # Two quantised factors of at most half a step each.
        assert a[6] == pytest.approx(b[6], rel=0.02, abs=0.02 * a[2])


def test_lm_odd_rows(spark):
    lm_check(cases.frame(spark, cases.odd_texts()).repartition(3))


def test_lm_documents(spark):
    lm_check(cases.table(spark, "documents"))


def test_lm_held_out_is_better_than_base(spark):
    out = [r for r in ngram_lm.scores(cases.table(spark, "documents", DATA)).collect() if r.held_out]
    assert sum(r.score for r in out) > 0.8 * sum(r.base_score for r in out)


def test_lm_small_tables(spark):
    assert ngram_lm.scores(cases.frame(spark, [])).count() == 0
    held = next(i for i in range(100) if crc(i, 10) == 0)
    (only,) = ngram_lm.scores(cases.frame(spark, [(held, "nothing learned")])).collect()
    assert (only.n_tokens, only.n_known, only.train_tokens) == (3, 0, 0)
    assert only.base_score == pytest.approx(0) and only.score == pytest.approx(0)


def test_elias_fano_successor():
    rng = np.random.default_rng(1)
    for size, top in ((0, 10), (1, 1 << 63), (1000, 2000), (5000, 1 << 62), (300, 1 << 20)):
        values = np.unique(rng.integers(0, top, size).astype(np.uint64)) if size else np.zeros(0, np.uint64)
        coded = ngram_lm.EliasFano(values)
        region = ngram_lm.Region(coded.parts())
        coded.open(*region.arrays)
        asked = np.r_[values, rng.integers(0, 1 << 63, 500).astype(np.uint64), np.array([0, 2**64 - 1], np.uint64)]
        at, equal = coded.successor(asked)
        assert np.array_equal(at, np.searchsorted(values, asked))
        assert np.array_equal(equal, np.isin(asked, values))


def test_payload_round_trip():
    arrays = [np.arange(5, dtype=np.uint64) << np.uint64(50), np.zeros(0, np.int32), np.array([1, 2], np.uint8)]
    back = ngram_lm.unpack(ngram_lm.pack(*arrays))
    assert all(a.dtype == b.dtype and np.array_equal(a, b) for a, b in zip(arrays, back))
