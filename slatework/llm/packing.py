"""Packing by power-of-two decomposition.

A document's token ids (with the closing id) are cut into pieces of 1024 and
then into the binary digits of what remains, longest first. Every piece is a
sequence of its own: its length is a power of two, so nothing is padded and no
sequence crosses documents. Pieces of one length form a bucket.

Defined results: a null or empty text is the closing id alone; repeated rows
are packed each for itself; a null ``doc_id`` is kept; other columns are not
read; an empty table gives no pieces.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.pretokens import PreTokens, default_vocabulary

LONGEST = 1024
CLOSING_ID = 0
#: Words whose ids an encoder remembers, and the most characters of one on average. It does so
#: twice: for the words lately used, and for those used before them.
REMEMBERED = 200_000
REMEMBERED_LASTING = 600_000
_CHARACTERS = 40


class _Words(dict):
    """Places of words, and the ids at each place. A new word gets a place when asked for."""

    def __init__(self):
        self.asked: list[str] = []  # new words whose ids are not known yet
        self.characters = 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.asked.append(word)
        return place

    def places(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64)

    def learn(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        """``flat`` holds the ids of ``words`` one after the other."""
        more = len(self) - len(self.starts)
        self.starts, self.lengths = (np.append(x, np.zeros(more, np.int64)) for x in (self.starts, self.lengths))
        places = self.places(words)
        self.starts[places] = len(self.flat) + np.cumsum(lengths) - lengths
        self.lengths[places] = lengths
        self.flat = np.append(self.flat, flat)
        self.characters += sum(map(len, words))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, number of ids at each place)."""
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[places] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))], lengths

    def full(self, words: int) -> bool:
        return len(self) > words or self.characters > _CHARACTERS * words


class Encoder:
    """Token ids of whole texts as packed little-endian unsigned 32-bit numbers.

    The byte-level vocabulary never merges across pre-tokens, so the ids of a
    text are those of its pre-tokens in order. A distinct pre-token is encoded
    once by ``tokenizers`` and remembered.
    """

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED):
        self._cut, self._remembered = PreTokens(vocabulary), remembered
        self._known, self._before = _Words(), _Words()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (end == at or size + len(texts[end]) < 1 << 20):
                size += len(texts[end])
                end += 1
            found = [self._cut(text) for text in texts[at:end]]
            if self._known.full(self._remembered):
                self._known, self._before = _Words(), self._known
            known, before = self._known, self._before
            places = known.places(chain.from_iterable(found))
            asked, known.asked = known.asked, []
            again = [word for word in asked if word in before]
            known.learn(again, *before.ids(before.places(again)))
            missing = [word for word in asked if word not in before]
            known.learn(missing, *self._cut.ids(missing))
            flat, lengths = known.ids(places)
            stops = np.append(0, np.cumsum(lengths))[np.cumsum([0, *map(len, found)])]
            for start, stop in zip(stops[:-1].tolist(), stops[1:].tolist()):
                yield flat[start:stop].tobytes()
            at = end


def worker_encoder(vocabulary: str) -> Encoder:
    """The Python worker's encoder of this vocabulary: what it remembers serves later tasks too."""
    # Functions travel by value, so only a module of the interpreter outlives a task.
    kept = sys.modules.setdefault("slatework_worker_encoders", types.ModuleType("slatework_worker_encoders"))
    encoder = getattr(kept, "by_vocabulary", {}).get(vocabulary)
    if encoder is None:
        encoder = Encoder(vocabulary, REMEMBERED_LASTING)
        kept.by_vocabulary = {vocabulary: encoder}
    return encoder


def piece_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """``longest`` as often as it fits, then the binary digits of the rest, largest first."""
    rest = tokens % longest
    bits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return [longest] * (tokens // longest) + bits


def split_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = LONGEST,
    lasting: bool = False,
) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, ids); ``ids`` are packed little-endian uint32.

    ``lasting``: what a Python worker remembers of words serves its later tasks
    too, and more of them: that saves a fifth of the time and keeps some 250 MB.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest piece must be a power of two")
    path = vocabulary or default_vocabulary()
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_column].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    names = [f.name for f in schema]
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path) if lasting else Encoder(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column(0), batch.column(1).fill_null("").to_pylist()
            rows, starts, lengths, totals, packed, held = [], [], [], [], [], 0

            def flush():
                columns = [
                    ids.take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(packed, pa.binary()),
                ]
                for gathered in (rows, starts, lengths, totals, packed):
                    gathered.clear()
                return pa.RecordBatch.from_arrays(columns, names)

            for row, body in enumerate(encoder(texts)):
                body += closing
                total = len(body) // 4
                at = 0
                for length in piece_lengths(total, longest):
                    rows.append(row)
                    starts.append(at)
                    lengths.append(length)
                    totals.append(total)
                    packed.append(body[4 * at : 4 * (at + length)])
                    at += length
                held += len(body)
                if held > 8 << 20:
                    yield flush()
                    held = 0
            if rows:
                yield flush()

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(pieces, schema)


def assign_sequences(pieces: DataFrame) -> DataFrame:
    """Adds ``sequence_id`` (unique) and ``offset`` (0: a piece is a whole sequence).

    Pieces are numbered where they were made, sorted by length, the bucket,
    inside a partition, so no id is shuffled. All columns take part in the sort,
    so a task that runs again numbers the same rows alike; rows that agree
    everywhere are interchangeable.
    """
    first = ["length", "doc_id", "start"]
    rest = [c for c in pieces.columns if c not in first]
    return (
        pieces.sortWithinPartitions(*first, *rest)
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def pack(docs: DataFrame, **options) -> DataFrame:
    """All sequences with their ids: doc_id, start, length, doc_tokens, ids, sequence_id, offset."""
    return assign_sequences(split_documents(docs, **options))


def write_buckets(sequences: DataFrame, path: str) -> None:
    """One folder per length, so that a batch reads sequences of equal length."""
    sequences.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)


def digest(docs: DataFrame, **options) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = split_documents(docs, lasting=True, **options).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign_sequences(pieces).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
