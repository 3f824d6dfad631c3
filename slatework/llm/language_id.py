"""Language identification with a string kernel.

Two texts are compared by the byte n-grams (n = 1 to 3, lower-cased A-Z) that
both contain: presence, not counts, blended over n and divided by the norms.
``LANDMARKS`` excerpts of training documents span the Nyström approximation;
one-versus-rest kernel ridge regression is solved on it. Only n-grams that occur
in a landmark can matter, so they are the features.

Scoring cuts a whole text into equal segments of at most ``SEGMENT`` bytes (the
length of the training excerpts), multiplies batches of presence rows with the
landmark matrix, and averages the class values by segment length.

The fit uses at most about ``PER_LANGUAGE`` excerpts of every language that has
labelled texts, chosen by hash of the document id.

Defined results: ``und`` with score 0 if the text is null or has no letter, or
if nothing could be learned (``has_letter`` of ``identify`` tells the two apart); a tie goes to the alphabetically first language;
repeated rows are returned each; a null ``doc_id`` is never learned from and
not held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.bytesio import LOWER, text_bytes
from slatework.llm.sampling import below, fold, rank_hash, thresholds

PER_LANGUAGE = 400
LANDMARKS = 160
SEGMENT = 2048
RIDGE = 1e-2
UNDETERMINED = "und"
_AT_ONCE = 256
#: Lengths of training excerpts in characters, so that short texts are learned too.
_EXCERPTS = (2000, 400, 60)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


@dataclass
class Model:
    languages: list[str]
    grams: list[np.ndarray]  # per n, the sorted codes of its features
    landmarks: np.ndarray  # features x landmarks, divided by the landmarks' norms
    weights: np.ndarray  # landmarks x languages


class Features:
    """Presence rows over the n-grams of the landmarks."""

    def __init__(self, grams: list[np.ndarray]):
        self.size = sum(map(len, grams))
        self._tables, at = [], 0
        for n, codes in enumerate(grams, 1):
            table = np.full(1 << (8 * n), -1, np.int16 if self.size < 1 << 15 else np.int32)
            table[codes] = np.arange(at, at + len(codes))
            at += len(codes)
            self._tables.append(table)

    def presence(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One row per span, divided by its norm. Spans follow one another in lower-cased ``data``."""
        rows = np.zeros((len(starts), self.size), np.float32)
        lengths = ends - starts
        if lengths.sum():
            part = data[starts[0] : ends[-1]]
            base = np.repeat(np.arange(len(starts)) * self.size, lengths)
            left = np.repeat(ends - starts[0], lengths) - np.arange(len(part))
            flat, code = rows.ravel(), part.astype(np.int32)
            for n, table in enumerate(self._tables, 1):
                if n > 1:
                    code = (code[:-1] << 8) | part[n - 1 :]
                feature = table[code]
                known = (feature >= 0) & (left[: len(code)] >= n)
                flat[base[: len(code)][known] + feature[known]] = 1
        norms = np.sqrt(rows.sum(axis=1, keepdims=True))
        return rows / np.maximum(norms, 1)


def _codes(text: bytes, n: int) -> np.ndarray:
    part = LOWER[np.frombuffer(text, np.uint8)].astype(np.int32)
    code = part
    for k in range(1, n):
        code = (code[:-1] << 8) | part[k:]
    return np.unique(code)


def fit_excerpts(excerpts: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Nyström kernel ridge regression on (language, text) pairs, taken in the given order."""
    excerpts = [(lang, text.encode()) for lang, text in excerpts if text]
    languages = sorted({lang for lang, _ in excerpts})
    if not languages:
        return None
    by_language = {lang: [t for name, t in excerpts if name == lang] for lang in languages}
    chosen: list[bytes] = []
    # Round about through the languages, longest excerpts first.
    queues = {lang: iter(sorted(texts, key=len, reverse=True)) for lang, texts in by_language.items()}
    while queues and len(chosen) < max(landmarks, len(languages)):
        for lang in list(queues):
            text = next(queues[lang], None)
            if text is None:
                del queues[lang]
            else:
                chosen.append(text)
    grams = [np.unique(np.concatenate([_codes(t, n) for t in chosen])) for n in (1, 2, 3)]
    features = Features(grams)

    def rows(texts: list[bytes]) -> np.ndarray:
        data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
        ends = np.cumsum([len(t) for t in texts])
        return features.presence(data, np.r_[0, ends[:-1]], ends)

    points = rows(chosen)
    kernel = (points @ points.T).astype(np.float64)
    gram, target = np.zeros_like(kernel), np.zeros((len(chosen), len(languages)))
    for at in range(0, len(excerpts), _AT_ONCE):
        part = excerpts[at : at + _AT_ONCE]
        values = (rows([t for _, t in part]) @ points.T).astype(np.float64)
        labels = np.array([[1.0 if lang == name else -1.0 for name in languages] for lang, _ in part])
        gram += values.T @ values
        target += values.T @ labels
    system = gram + ridge * len(excerpts) / len(chosen) * kernel + 1e-6 * np.trace(gram) / len(chosen) * np.eye(len(chosen))
    return Model(languages, grams, np.ascontiguousarray(points.T), np.linalg.solve(system, target).astype(np.float32))


def sample(docs: DataFrame, id_column: str, text_column: str, label_column: str, learn, per_language: int) -> list:
    """(language, excerpt) rows in a repeatable order; at most about ``per_language`` of each."""
    rank = rank_hash(F.col(id_column), "language")
    usable = docs.where(learn & F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    limits = thresholds(usable.select(F.col(label_column).alias("label")), "label", per_language)
    size = F.element_at(F.array(*[F.lit(n) for n in _EXCERPTS]), (rank % len(_EXCERPTS) + 1).cast("int"))
    spare = F.greatest(F.char_length(text_column) - size, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.col(id_column), F.lit("start")), spare.cast("long")).cast("int") + 1
    rows = usable.where(below(F.col(label_column), rank, limits)).select(
        F.col(label_column).alias("label"), F.col(text_column).substr(start, size).alias("text"), rank.alias("rank")
    )
    found = sorted((r["label"], r["rank"], r["text"]) for r in rows.collect())
    return [(label, text) for label, _, text in found]


def score_batch(
    model: Model | None, features: Features | None, column: pa.Array
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, has a letter) per row of a text column; without a model only letters are sought."""
    data, offsets = text_bytes(column)
    count = len(offsets) - 1
    lengths = np.diff(offsets)
    parts = np.maximum(-(-lengths // SEGMENT), 0)
    row = np.repeat(np.arange(count), parts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = offsets[row] + within * lengths[row] // parts[row]
    ends = offsets[row] + (within + 1) * lengths[row] // parts[row]
    totals = np.zeros((count, len(model.languages) if model else 1))
    letters = np.zeros(count, bool)
    for at in range(0, len(row), _AT_ONCE):
        s, e, r = starts[at : at + _AT_ONCE], ends[at : at + _AT_ONCE], row[at : at + _AT_ONCE]
        part = data[s[0] : e[-1]]
        np.logical_or.at(letters, r, np.logical_or.reduceat(_LETTER[part], s - s[0]))
        if not model:
            continue
        presence = features.presence(LOWER[part], s - s[0], e - s[0])
        values = (presence @ model.landmarks) @ model.weights
        np.add.at(totals, r, values * (e - s)[:, None])
    for k in np.flatnonzero(~letters & (lengths > 0)):
        letters[k] = any(c.isalpha() for c in column[int(k)].as_py())
    if not model:
        return [UNDETERMINED] * count, np.zeros(count), letters
    means = totals / np.maximum(lengths, 1)[:, None]
    best = means.argmax(axis=1)
    scores = np.where(letters, np.clip((means[np.arange(count), best] + 1) / 2, 0, 1), 0.0)
    names = [model.languages[b] if has else UNDETERMINED for b, has in zip(best, letters)]
    return names, scores, letters


def identify(
    docs: DataFrame,
    learn=None,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = PER_LANGUAGE,
    answer: str | None = None,
) -> DataFrame:
    """(doc_id, lang_pred, score) per input row, learned from the rows where ``learn`` holds.

    With ``answer``, all columns of ``docs`` come back and a struct of this name:
    lang_pred, score and ``has_letter``, which is false for a null text and for
    one without a letter, whether or not anything could be learned.
    """
    learn = F.col(id_column).isNotNull() if learn is None else F.coalesce(learn, F.lit(False))
    model = fit_excerpts(sample(docs, id_column, text_column, label_column, learn, per_language))
    spark = docs.sparkSession
    # Bounded: landmarks x their n-grams. A plain dictionary, as executors may lack this package.
    shared = spark.sparkContext.broadcast(model and vars(model))
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def predicted(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        own = shared.value and Model(**shared.value)
        features = Features(own.grams) if own else None
        for column in columns:
            found, scores, letters = score_batch(own, features, column)
            yield [pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(letters)]

    if answer is not None:
        # Only the text goes to Python and only the answer comes back.
        def answers(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for three in predicted(columns):
                yield pa.StructArray.from_arrays(three, ["lang_pred", "score", "has_letter"])

        call = F.arrow_udf(answers, "lang_pred string, score double, has_letter boolean")
        return docs.withColumn(answer, call(F.col(text_column)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def texts():
            for batch in batches:
                held.append(batch.column(0))
                yield batch.column(1)

        for found, scores, _ in predicted(texts()):
            yield pa.RecordBatch.from_arrays([held.pop(), found, scores], ["doc_id", "lang_pred", "score"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema)


def predictions(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score; rows of the held-out fold are never learned from."""
    found = identify(docs, learn=fold(F.col("doc_id"), folds) != held)
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
