"""Toxicity by class-conditional Kneser-Ney models.

A word bigram model of toxic and one of ordinary documents give each text two
log-likelihoods; their difference, normalised by length, is the evidence. The
models are hierarchies: a bigram backs off to its word, a word to its beginnings
of ``STEMS`` bytes, and the shortest beginning to a model that both classes
share, built from continuation counts (how many different words a beginning
forms). A class keeps for itself only what an expression occurs more often than
its share of both classes explains: the discount is the expected count, a
multiple of its standard deviation, and ``DISCOUNT``. Everything else is shared,
so rare and everyday expressions say nothing.

Expressions are counted once per document, so that a long document does not
speak for its class. All levels are kept as lifts over the shared model; only
expressions with a lift of their own are listed. Their number is bounded by the
words of the sample, of which only those far above their share have one.

The counts come from at most about ``PER_CLASS`` labelled documents of each
class, chosen by hash of the id; a quarter of them is kept out of the counts and
fits the logistic curve that turns evidence into a score, classes weighted as
they occur.

Defined results: null text is empty and gets the score of no evidence; several
labels of one id count as toxic if one of them is; a null label or id is not
learned from; if a class has no documents every score is 0; repeated rows are
returned each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.bytesio import LOWER, blocks, hash_spans, mix, text_bytes, word_spans
from slatework.llm.sampling import below, fold, rank_hash, thresholds
from slatework.session import stage

STEMS = (8, 6, 4)
DISCOUNT = 0.75
DEVIATIONS = 4.0
PER_CLASS = 8000
_WORD, _PAIR = 0, len(STEMS) + 1
_START = np.uint64(0x57A2700000000001)


@dataclass
class Level:
    """Listed expressions, rising, with their lift per class, and what is left to the backoff."""

    keys: np.ndarray
    lifts: np.ndarray  # 2 x keys
    rest: np.ndarray  # per class; for bigrams per listed context, see ``contexts``


@dataclass
class Model:
    levels: list[Level]  # words, then ever shorter beginnings
    pairs: Level
    contexts: np.ndarray  # hashes of first words that have listed bigrams, rising
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def expressions(column: pa.Array) -> Iterator[tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Per block: (row, hashes of words and beginnings, hash of the word before, hash of the bigram)."""
    data, offsets = text_bytes(column)
    last_row, last = -1, _START
    for at, end in blocks(data, offsets):
        part = LOWER[data[at:end]]
        starts, ends = word_spans(part, offsets - at)
        if not len(starts):
            continue
        row = np.searchsorted(offsets, starts + at, "right") - 1
        words = hash_spans(part, starts, ends)
        stems = [hash_spans(part, starts, np.minimum(ends, starts + size)) for size in STEMS]
        before = np.empty_like(words)
        before[1:] = np.where(row[1:] == row[:-1], words[:-1], _START)
        before[0] = last if row[0] == last_row else _START
        last_row, last = row[-1], words[-1]
        yield row, [words, *stems], before, mix(before + np.uint64(3) * words)


def _place(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the values that are listed, their places)."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    own = np.flatnonzero(keys[at] == values)
    return own, at[own]


def lifts(model: Model, levels: list[np.ndarray], before: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of each token over the shared model's, per class."""
    lift = np.ones((2, len(before)))
    for level, hashes in zip(reversed(model.levels), reversed(levels)):
        lift *= level.rest[:, None]
        own, at = _place(level.keys, hashes)
        lift[:, own] += level.lifts[:, at]
    own, at = _place(model.contexts, before)
    lift[:, own] *= model.pairs.rest[:, at]
    own, at = _place(model.pairs.keys, pairs)
    lift[:, own] += model.pairs.lifts[:, at]
    return lift


def evidence(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(log-likelihood of toxic minus that of ordinary, number of tokens) per row."""
    total, tokens = np.zeros(len(column)), np.zeros(len(column))
    for row, levels, before, pairs in expressions(column):
        ordinary, toxic = np.log(lifts(model, levels, before, pairs))
        total += np.bincount(row, toxic - ordinary, len(column))
        tokens += np.bincount(row, minlength=len(column))
    return total, tokens


def inputs(total: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Evidence normalised by the length and by its square root, and the length."""
    n = np.maximum(tokens, 1)
    return np.stack([total / n, total / np.sqrt(n), np.log1p(tokens)], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40):
    """(centre, scale, weights): weighted logistic regression by Newton steps with a small ridge."""
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + 1e-2 * w
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return centre, scale, w


def count_table(rows: DataFrame) -> DataFrame:
    """(level, key, n0, n1, s0.., before, word): documents of each class that hold an expression.

    ``s0..`` are a word's beginnings; ``before`` and ``word`` are a bigram's words.
    """
    names = ["level", "key", "n0", "n1", *[f"s{k}" for k in range(len(STEMS))], "before", "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, levels, before, pairs in _whole_rows(batch.column(1)):
                for number, keys in enumerate([*levels, pairs]):
                    # Each expression once per document.
                    order = np.lexsort((row, keys))
                    k, r = keys[order], row[order]
                    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])])
                    k, kind, source = k[first], toxic[r[first]], order[first]
                    start = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
                    n1 = np.add.reduceat(kind, start)
                    n = np.diff(np.r_[start, len(k)])
                    nothing = np.zeros(len(start), np.uint64)
                    at = source[start]
                    stems = [s[at] if number == _WORD else nothing for s in levels[1:]]
                    ends = [before[at], levels[0][at]] if number == _PAIR else [nothing, nothing]
                    columns = [np.full(len(start), number), k[start], n - n1, n1, *stems, *ends]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.uint64).view(np.int64)) for c in columns], names)

    counted = rows.select("toxic", "text").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    rest = [F.min(n).alias(n) for n in names[4:]]
    return counted.groupBy("level", "key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), *rest)


def _whole_rows(column: pa.Array):
    """``expressions`` with all blocks of a document together, a few documents at a time."""
    sizes = text_bytes(column)[1]
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + (2 << 20), "right")) - 1)
        parts, start, at = list(expressions(column.slice(at, end - at))), at, end
        if parts:
            rows, levels, before, pairs = zip(*parts)
            yield start + np.concatenate(rows), [np.concatenate(x) for x in zip(*levels)], np.concatenate(before), np.concatenate(pairs)


def _excess(k: int, totals: tuple[float, float]) -> Column:
    """What a class's count has beyond its expected share; at least 0."""
    count, both = F.col(f"n{k}"), F.col("n0") + F.col("n1")
    expected = both * F.lit(totals[k] / max(sum(totals), 1.0))
    return F.greatest(count - expected - F.lit(DEVIATIONS) * F.sqrt(expected) - F.lit(DISCOUNT), F.lit(0.0))


def count(rows: DataFrame) -> tuple[list[Level], Level, np.ndarray]:
    """Word and beginning levels, the bigram level and its contexts."""
    table = stage(count_table(rows), "expression-counts")
    sums = {r["level"]: (float(r["a"]), float(r["b"])) for r in table.groupBy("level").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b")).collect()}
    words = table.where(F.col("level") == _WORD)
    kinds = words.count()  # different words

    def listed(level: int, with_kinds: DataFrame | None, *more: str):
        totals = sums.get(level, (0.0, 0.0))
        rows = table.where(F.col("level") == level).withColumns({"e0": _excess(0, totals), "e1": _excess(1, totals)})
        rows = rows.where("e0 > 0 or e1 > 0")
        if with_kinds is not None:
            rows = rows.join(with_kinds, "key", "left")
        found = rows.select("key", "e0", "e1", *more).toPandas()
        keys = found["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        excess = np.stack([found[c].to_numpy(float)[order] for c in ("e0", "e1")])
        return keys[order], excess, found.iloc[order], np.maximum(np.array(totals), 1)

    levels = []
    for number in range(len(STEMS) + 1):
        forms = None
        if number:
            forms = words.groupBy(F.col(f"s{number - 1}").alias("key")).agg(F.count(F.lit(1)).alias("forms"))
        keys, excess, found, totals = listed(number, forms, *(["forms"] if number else []))
        shared = (found["forms"].fillna(1).to_numpy(float) if number else np.ones(len(keys))) + 0.5
        share = excess / totals[:, None]
        levels.append(Level(keys, share / (shared / (kinds + 1)), 1 - share.sum(axis=1)))
    keys, excess, found, _ = listed(_PAIR, None, "before", "word")
    before = found["before"].to_numpy(np.int64).view(np.uint64)
    contexts = np.unique(before)
    # A context occurs in as many documents as its word; the start of a text in every document.
    seen = np.ones((2, len(contexts)))
    if len(contexts):
        wanted = rows.sparkSession.createDataFrame([(int(k),) for k in contexts.view(np.int64)], "key bigint")
        for r in words.join(F.broadcast(wanted), "key").select("key", "n0", "n1").collect():
            at = np.searchsorted(contexts, np.int64(r["key"]).view(np.uint64))
            seen[:, at] = np.maximum([r["n0"], r["n1"]], 1)
        if _START in contexts:
            for r in rows.groupBy("toxic").count().collect():
                seen[r["toxic"], np.searchsorted(contexts, _START)] = max(r["count"], 1)
    place = np.searchsorted(contexts, before)
    # A document may hold several bigrams of one context: no more than its whole mass is given away.
    given = np.stack([np.bincount(place, e, len(contexts)) if len(e) else np.zeros(len(contexts)) for e in excess])
    seen = np.maximum(seen, given / 0.95)
    pairs = Level(keys, excess / seen[:, place] * (kinds + 1) / 1.5, 1 - given / seen)
    return levels, pairs, contexts


def fit(docs: DataFrame, labels: DataFrame, learn, per_class: int = PER_CLASS) -> Model | None:
    """Model of the labelled rows for which ``learn`` (over doc_id) holds."""
    marks = labels.where(learn & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    limits = thresholds(marks, "toxic", per_class)
    if len(limits) < 2:
        return None
    chosen = marks.where(below(F.col("toxic"), rank_hash(F.col("doc_id"), "toxicity"), limits))
    chosen = chosen.select("doc_id", "toxic", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("curve"))
    # About 2 * per_class short rows, so they travel to the documents.
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    levels, pairs, contexts = count(joined.where("not curve"))
    blank = Model(levels, pairs, contexts, np.zeros(3), np.ones(3), np.zeros(4))
    shared = docs.sparkSession.sparkContext.broadcast(_plain(blank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for batch in batches:
            total, tokens = evidence(model, batch.column(1))
            columns = [batch.column(0).cast(pa.float64()), pa.array(total), pa.array(tokens)]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "total", "tokens"])

    kept = joined.where("curve").select("toxic", "text").mapInArrow(run, "toxic double, total double, tokens double")
    found = kept.toPandas().sort_values(["toxic", "total", "tokens"]).to_numpy()
    if len(set(found[:, 0])) < 2:
        return None
    # Rows of a thinned class stand for as many as they were.
    weight = np.array([max(limits.values()) / limits[int(k)] for k in found[:, 0]])
    blank.centre, blank.scale, blank.weights = fit_curve(inputs(found[:, 1], found[:, 2]), found[:, 0], weight)
    return blank


def _plain(model: Model | None):
    """Arrays only, as executors may lack this package."""
    if model is None:
        return None
    return [vars(x) for x in model.levels], vars(model.pairs), model.contexts, model.centre, model.scale, model.weights


def _model(plain) -> Model | None:
    return plain and Model([Level(**x) for x in plain[0]], Level(**plain[1]), *plain[2:])


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(_plain(model))  # bounded by the sample
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(shared.value)
        for batch in batches:
            values = np.zeros(batch.num_rows)
            if own:
                x = (inputs(*evidence(own, batch.column(1))) - own.centre) / own.scale
                values = 1 / (1 + np.exp(-np.clip(np.c_[np.ones(len(x)), x] @ own.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def predictions(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of the held-out fold are never learned from."""
    model = fit(docs, labels, fold(F.col("doc_id"), folds) != held)
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
