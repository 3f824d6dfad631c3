"""Language-model scores from an Elias-Fano bigram trie, split over shards.

The trie has two levels. Level one holds the sorted hashes of all training words
and their counts. Level two holds, for every word as context, the words seen
after it: the successors' 32-bit codes are sorted inside their context, so
(context rank, code) is one rising sequence. Rising sequences are stored by
Elias-Fano: low bytes as they are, high parts in unary. In level two the low
bytes are the codes, and the unary part is the rising pointers from contexts to
their successors. Level two keeps one byte per bigram, its discounted
probability on a logarithmic scale, and one byte per context, its backoff
weight. The levels of a shard are laid out in one memory-mapped temporary file
of the task, and a bigram is found by successor search inside its context.

No task holds the whole model. Words belong to the shard of their hash, bigrams
to the shard of their context; the bigrams of a context that would outgrow a
shard are dealt over all shards, and its number of different successors is added
up afterwards. Texts are read in chunks; a chunk asks every shard once about
its distinct words and bigrams, counts included, and the answers return to the
chunk. What is sent grows with the distinct words and bigrams of the input.
Chunks are written once as word numbers; questions are derived from them when
asked and again when answered, so they are sent but never stored.

Probabilities: a known word has (c - d) / N, all unknown words together d V / N
with d = n1 / V (n1: words seen once). A bigram has max(c - D, 0) / c(context)
plus D kinds / c(context) times the probability of its word, D = 0.75.

Words are told apart by 64-bit hashes, successors of one context by 32 bits.

Defined results: null text is empty and is the end token alone; repeated rows
are returned and learned from each; a null ``doc_id`` is kept, never learned
from and not held out; if nothing is learned every token is unknown; an empty
table gives no rows.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.bytesio import hashed_words, mix
from slatework.llm.sampling import fold
from slatework.session import stage

CHUNK_BYTES = 4 << 20
DISCOUNT = 0.75
CODE_BITS = 32
END = np.uint64(0xE2D0000000000001)
START = np.uint64(0x57A2700000000001)
#: A context with more than this share of a shard's average tokens is dealt over all shards.
_HOT_SHARE = 0.25
_STEP = 8  # quantisation steps per power of two


# -- packed arrays ---------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed payload; bytes of equal weight lie together."""
    import zstandard

    parts = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = a.dtype.str.encode().ljust(4)
        planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b""
        parts += [kind, np.array([len(a)], "<u4").tobytes(), planes]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(payload: bytes) -> list[np.ndarray]:
    import zstandard

    body = zstandard.ZstdDecompressor().decompress(payload)
    count, at, out = int(np.frombuffer(body, "<u4", 1)[0]), 4, []
    for _ in range(count):
        kind = np.dtype(body[at : at + 4].decode().strip())
        size = int(np.frombuffer(body, "<u4", 1, at + 4)[0])
        at += 8
        planes = np.frombuffer(body, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if size else np.zeros(0, kind))
        at += size * kind.itemsize
    return out


# -- Elias-Fano levels -----------------------------------------------------


class Region:
    """Arrays laid out in one memory-mapped temporary file, which goes with the object."""

    def __init__(self, arrays: list[np.ndarray]):
        sizes = [(a.nbytes + 7) // 8 * 8 for a in arrays]
        self._file = tempfile.TemporaryFile()
        self._file.truncate(max(8, sum(sizes)))
        self._map = mmap.mmap(self._file.fileno(), max(8, sum(sizes)))
        self.arrays, at = [], 0
        for a, size in zip(arrays, sizes):
            self._map[at : at + a.nbytes] = a.tobytes()
            self.arrays.append(np.frombuffer(self._map, a.dtype, a.size, at).reshape(a.shape))
            at += size


class EliasFano:
    """A rising sequence of 64-bit numbers: low bytes, and high parts in unary."""

    def __init__(self, values: np.ndarray, low_bytes: int | None = None):
        n = len(values)
        spread = max(1, (int(values[-1]) if n else 0) // max(n, 1))
        self.low_bytes = low_bytes or min(7, max(1, -(-(spread.bit_length() - 1) // 8)))
        self.size = n
        shift = np.uint64(8 * self.low_bytes)
        low = values & np.uint64((1 << (8 * self.low_bytes)) - 1)
        planes = low.astype("<u8").view(np.uint8).reshape(n, 8)[:, : self.low_bytes]
        high = (values >> shift).astype(np.int64)
        bits = np.zeros(n + (int(high[-1]) if n else 0) + 1, np.uint8)
        bits[high + np.arange(n)] = 1
        self._parts = [np.ascontiguousarray(planes), np.packbits(bits, bitorder="little"), np.array([len(bits)])]

    def parts(self) -> list[np.ndarray]:
        return self._parts

    def open(self, planes: np.ndarray, unary: np.ndarray, length: np.ndarray) -> EliasFano:
        """Reads from these (mapped) arrays; the directory of high parts is rebuilt from the unary bits."""
        bits = np.unpackbits(unary, bitorder="little")[: int(length[0])]
        zeros = np.flatnonzero(bits == 0)
        # starts[h]: how many values have a smaller high part.
        self._starts = np.r_[0, zeros - np.arange(len(zeros)), self.size].astype(np.int64)
        self._planes = planes
        return self

    def _low(self, at: np.ndarray) -> np.ndarray:
        low = self._planes[at, self.low_bytes - 1].astype(np.uint64)
        for k in range(self.low_bytes - 2, -1, -1):
            low = (low << np.uint64(8)) | self._planes[at, k]
        return low

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first number not below each value, whether it is equal)."""
        high = np.minimum((values >> np.uint64(8 * self.low_bytes)).astype(np.int64), len(self._starts) - 2)
        beyond = (values >> np.uint64(8 * self.low_bytes)).astype(np.int64) > len(self._starts) - 2
        low = values & np.uint64((1 << (8 * self.low_bytes)) - 1)
        left, right = self._starts[high].copy(), self._starts[high + 1].copy()
        left[beyond] = right[beyond] = self.size
        stop = right.copy()
        while True:
            active = np.flatnonzero(left < right)
            if not len(active):
                break
            middle = (left[active] + right[active]) >> 1
            less = self._low(middle) < low[active]
            left[active[less]] = middle[less] + 1
            right[active[~less]] = middle[~less]
        equal = left < stop
        equal[equal] = self._low(left[equal]) == low[equal]
        return left, equal


def quantised(probability: np.ndarray) -> np.ndarray:
    """One byte on a logarithmic scale; 0 stands for nothing."""
    with np.errstate(divide="ignore"):
        level = np.rint(255 + _STEP * np.log2(np.minimum(probability, 1.0)))
    return np.where(probability > 0, np.clip(level, 1, 255), 0).astype(np.uint8)


_LEVELS = np.r_[0.0, 2.0 ** ((np.arange(1, 256) - 255) / _STEP)]


class Trie:
    """The two levels of one shard."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, keys: np.ndarray, bigrams: np.ndarray, hot: np.ndarray):
        """``words`` rise, with ``counts``; ``keys`` (context rank, code) rise, with counts ``bigrams``.

        Ranks from ``len(words)`` on stand for contexts dealt over all shards,
        which occur ``hot`` times.
        """
        occurs = np.r_[counts, hot].astype(float)
        rank = (keys >> np.uint64(CODE_BITS)).astype(np.int64)
        self.kinds = np.bincount(rank, minlength=len(occurs))
        weight = np.where(occurs > 0, DISCOUNT * self.kinds / np.maximum(occurs, 1), 1.0)
        levels = [EliasFano(words), EliasFano(keys, CODE_BITS // 8)]
        flat = [a for level in levels for a in level.parts()]
        value = quantised(np.maximum(bigrams - DISCOUNT, 0) / np.maximum(occurs[rank], 1))
        region = Region([*flat, counts, value, quantised(weight)])
        mapped = region.arrays
        self._region = region
        self._words, self._keys = (level.open(*mapped[3 * k : 3 * k + 3]) for k, level in enumerate(levels))
        self._counts, self._value, self._weight = mapped[6:]
        self.word_total = len(words)

    def word(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or -1, count) of each hash."""
        at, equal = self._words.successor(hashes)
        rank = np.where(equal, at, -1)
        return rank, np.where(equal, self._counts[np.minimum(at, max(len(self._counts) - 1, 0))] if len(self._counts) else 0, 0)

    def bigram(self, rank: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Quantised discounted probability; 0 if the context or the bigram is unknown."""
        out = np.zeros(len(rank), np.uint8)
        known = np.flatnonzero(rank >= 0)
        at, equal = self._keys.successor((rank[known].astype(np.uint64) << np.uint64(CODE_BITS)) | code[known])
        out[known[equal]] = self._value[at[equal]]
        return out

    def backoff(self, rank: np.ndarray) -> np.ndarray:
        """Quantised backoff weight; 255 (one) for unknown contexts."""
        if not len(self._weight):
            return np.full(len(rank), 255, np.uint8)
        return np.where(rank >= 0, self._weight[np.maximum(rank, 0)], 255).astype(np.uint8)


# -- shards ----------------------------------------------------------------


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash; rising hashes have rising shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, with the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(values, first)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, learn flags, row of each token, hash of each token), about CHUNK_BYTES of text at a time.

    Rows are (doc_id, learn, text); the end token of a row follows its words.
    """
    for batch in batches:
        lengths = pc.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False)
        sizes = np.r_[0, np.cumsum(lengths, dtype=np.int64)]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + CHUNK_BYTES, "right")) - 1)
            part = batch.slice(at, end - at)
            found = list(hashed_words(part.column(2)))
            row = np.concatenate([np.zeros(0, np.int64), *[r for r, _ in found]])
            value = np.concatenate([np.zeros(0, np.uint64), *[v for _, v in found]])
            row = np.r_[row, np.arange(part.num_rows)]
            value = np.r_[value, np.repeat(END, part.num_rows)]
            order = np.argsort(row, kind="stable")
            learn = part.column(1).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            yield part.column(0), learn, row[order], value[order]
            at = end


def word_counts(docs: DataFrame, shards: int) -> DataFrame:
    """Level one: (shard, payload of word hashes and counts, tokens, words, once)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, learn, row, value in _chunks(batches):
            words, counts = np.unique(value[learn[row]], return_counts=True)
            cuts = np.searchsorted(shard_of(words, shards), np.arange(shards + 1))
            rows = [
                (s, pack(np.diff(words[a:b], prepend=np.uint64(0)), counts[a:b].astype(np.uint32)))
                for s, (a, b) in enumerate(zip(cuts, cuts[1:]))
                if b > a
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                ["shard", "payload"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches, "shard"):
            parts = [unpack(r["payload"]) for r in rows]
            words, counts = _sums(
                np.concatenate([np.cumsum(p[0]) for p in parts]),
                np.concatenate([p[1] for p in parts]).astype(np.int64),
            )
            values = [[shard], [pack(np.diff(words, prepend=np.uint64(0)), counts)], [int(counts.sum())], [len(words)], [int((counts == 1).sum())]]
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds)], _LEVEL_ONE)

    sent = docs.mapInArrow(partial, "shard bigint, payload binary")
    dealt = sent.repartition(shards, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(merged, "shard bigint, payload binary, tokens bigint, words bigint, once bigint")


_LEVEL_ONE = ["shard", "payload", "tokens", "words", "once"]


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of consecutive equal keys."""
    held, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row[key] != held:
                yield held, rows
                rows = []
            held = row[key]
            rows.append(row)
    if rows:
        yield held, rows


def hot_contexts(level_one: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the words that occur more than ``least`` times: at most tokens / least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                steps, counts = unpack(payload)
                words, many = np.cumsum(steps), counts > least
                columns = [pa.array(words[many].view(np.int64)), pa.array(counts[many])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    found = level_one.select("payload").mapInArrow(run, "word bigint, n bigint").toPandas().sort_values("word")
    hashes = found["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found["n"].to_numpy(np.int64)[order]


def _code(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - CODE_BITS)


_ROW = "kind int, chunk bigint, shard bigint, payload binary"
_TEXT, _REQUEST, _ANSWER, _KINDS = 0, 1, 2, 3


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, ["kind", "chunk", "shard", "payload"])


def chunk_texts(docs: DataFrame) -> DataFrame:
    """Texts as word numbers: one row per chunk with its ids, lengths, rising word hashes and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for ids, learn, row, value in _chunks(batches):
            words, local = np.unique(value, return_inverse=True)
            ids = ids.cast(pa.int64())
            payload = pack(
                ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                learn.astype(np.uint8),
                np.bincount(row, minlength=len(ids)).astype(np.uint32),
                np.diff(words, prepend=np.uint64(0)),
                local.astype(np.uint32),
            )
            yield _batch([(_TEXT, chunk, -1, payload)])
            chunk += 1

    return docs.mapInArrow(run, _ROW)


class Chunk:
    """A chunk's texts and the bigrams in the order in which shards answer.

    Contexts and words are places in the rising ``words``; the place behind the
    last word is the start of a text.
    """

    def __init__(self, payload: bytes, shards: int, hot: np.ndarray):
        self.ids, self.nulls, learn, self.lengths, steps, local = unpack(payload)
        self.words = np.cumsum(steps)
        self.row = np.repeat(np.arange(len(self.ids)), self.lengths)
        local, end = local.astype(np.int64), len(self.words)
        before = np.empty_like(local)
        before[0], before[1:] = end, np.where(self.row[1:] == self.row[:-1], local[:-1], end)
        before *= end + 1
        before += local
        key, place = np.unique(before, return_inverse=True)
        del before, local
        seen = np.bincount(place[learn.astype(bool)[self.row]], minlength=len(key))
        first, second = key // (end + 1), key % (end + 1)
        del key
        hashes = np.r_[self.words, START]
        self.hot_at = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
        self.is_hot = (hot[self.hot_at] == hashes) if len(hot) else np.zeros(len(hashes), bool)
        # A context's shard is its word's; a hot context's bigrams go everywhere.
        home = np.r_[shard_of(self.words, shards), 0]
        to = home[first]
        spread = np.flatnonzero(self.is_hot[first])
        to[spread] = shard_of(mix(hashes[first[spread]] + np.uint64(3) * self.words[second[spread]]), shards)
        order = np.argsort(to, kind="stable")
        self.limits = np.searchsorted(to[order], np.arange(shards + 1))
        self.cuts = np.searchsorted(home[:-1], np.arange(shards + 1))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.place = back[place]
        self.first, self.second, self.seen = first[order], second[order], seen[order]
        # Sent contexts: a word of the shard by its place in the shard's slice, a hot one by -1 - number.
        own = np.r_[np.arange(end) - self.cuts[home[:-1]], 0]
        self.sent = np.where(self.is_hot, -1 - self.hot_at, own)

    def request(self, shard: int) -> bytes | None:
        words = self.words[self.cuts[shard] : self.cuts[shard + 1]]
        some = slice(self.limits[shard], self.limits[shard + 1])
        context = self.sent[self.first[some]]
        if not len(words) and not len(context):
            return None
        change = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
        return pack(
            np.diff(words, prepend=np.uint64(0)),
            context[change].astype(np.int32),
            np.diff(np.r_[change, len(context)]).astype(np.uint32),
            self.seen[some].astype(np.uint32),
            _code(self.words[self.second[some]]).astype(np.uint32),
        )


def requests(texts: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    """Per chunk and shard one request row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = Chunk(payload.as_py(), shards, hot)
                rows = [(_REQUEST, number, s, chunk.request(s)) for s in range(shards)]
                yield _batch([r for r in rows if r[3] is not None])

    return texts.select("chunk", "payload").mapInArrow(run, _ROW)


def _read_request(payload: bytes):
    steps, contexts, runs, seen, code = unpack(payload)
    return np.cumsum(steps), contexts, runs.astype(np.int64), seen, code.astype(np.uint64)


def answers(level_one: DataFrame, asked: DataFrame, shards: int, hot_counts: np.ndarray) -> DataFrame:
    """Per request one answer row, and per shard the successors of hot contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches, "shard"):
            level = [r for r in rows if r["kind"] == -1]
            words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if level:
                steps, counts = unpack(level[0]["payload"])
                words = np.cumsum(steps)
            mine = [r for r in rows if r["kind"] == _REQUEST]
            small = Trie(words, counts, np.zeros(0, np.uint64), np.zeros(0), hot_counts)
            keys, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            waiting = 0
            parts: list = [(keys, seen)]
            for r in mine:
                asked_words, contexts, runs, n, code = _read_request(r["payload"])
                rank = _ranks(small, asked_words, contexts)
                many = np.repeat(rank, runs)
                learned = (n > 0) & (many >= 0)
                key = (many[learned].astype(np.uint64) << np.uint64(CODE_BITS)) | code[learned]
                parts.append((key, n[learned].astype(np.int64)))
                waiting += len(key)
                if waiting > 1 << 20:
                    parts, waiting = [_sums(*[np.concatenate(c) for c in zip(*parts)])], 0
            keys, seen = _sums(*[np.concatenate(c) for c in zip(*parts)])
            trie = Trie(words, counts, keys, seen, hot_counts)
            for r in mine:
                asked_words, contexts, runs, n, code = _read_request(r["payload"])
                rank = _ranks(trie, asked_words, contexts)
                value = trie.bigram(np.repeat(rank, runs), code)
                _, count = trie.word(asked_words)
                own, _ = trie.word(asked_words)
                payload = pack(count.astype(np.uint32), trie.backoff(own), value)
                yield _batch([(_ANSWER, r["chunk"], shard, payload)])
            yield _batch([(_KINDS, -1, shard, pack(trie.kinds[len(words) :].astype(np.int64)))])

    level = level_one.select(F.lit(-1).alias("kind"), F.lit(-1).cast("long").alias("chunk"), "shard", "payload")
    both = level.unionByName(asked)
    dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "chunk")
    return dealt.mapInArrow(run, _ROW)


def _ranks(trie: Trie, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Rank of each context: its word's rank, or a hot context's number behind the words; -1 if unknown."""
    own, _ = trie.word(words)
    rank = np.full(len(contexts), -1, np.int64)
    plain = contexts >= 0
    rank[plain] = own[contexts[plain]]
    rank[~plain] = trie.word_total + (-1 - contexts[~plain].astype(np.int64))
    return rank


def score(
    docs: DataFrame,
    learn,
    id_column: str = "doc_id",
    text_column: str = "text",
    shards: int | None = None,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per input row.

    ``learn`` is a condition on the rows that the model is made from.
    """
    spark = docs.sparkSession
    shards = shards or max(8, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.col(text_column).alias("text"),
    )
    level_one = stage(word_counts(rows, shards), "lm-words")
    texts = rows.where("learn").count()
    total = level_one.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "words", "once")]).first()
    tokens, words, once = (int(x) for x in total)
    hot, hot_counts = hot_contexts(level_one, _HOT_SHARE * tokens / shards)
    # The start of a text is a context that no shard of words owns.
    place = int(np.searchsorted(hot, START))
    hot, hot_counts = np.insert(hot, place, START), np.insert(hot_counts, place, texts)
    chunked = stage(chunk_texts(rows), "lm-texts")
    answered = stage(answers(level_one, requests(chunked, shards, hot), shards, hot_counts), "lm-answers")

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                (n,) = unpack(payload)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["hot", "n"])

    successors = answered.where(F.col("kind") == _KINDS).select("payload").mapInArrow(kinds, "hot bigint, n bigint")
    hot_kinds = np.zeros(len(hot))
    for r in successors.groupBy("hot").agg(F.sum("n").alias("n")).collect():  # one row per hot context
        hot_kinds[r["hot"]] = r["n"]
    hot_weight = np.where(hot_counts > 0, DISCOUNT * hot_kinds / np.maximum(hot_counts, 1), 1.0)

    def base_log(count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (tokens + 0.1 * (words + 1)))

    def word_probability(count: np.ndarray) -> np.ndarray:
        if not tokens:
            return np.ones(len(count))
        gone = (once + 0.5) / (words + 1)  # between 0 and 1, so that no word gets nothing
        known = (count - gone) / tokens
        return np.where(count > 0, known, gone * words / tokens)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches, "chunk"):
            chunk = Chunk(rows[0]["payload"], shards, hot)
            parts = [unpack(r["payload"]) for r in rows[1:]]
            count, backoff, value = (np.concatenate(c) for c in zip(*parts))
            weight = np.r_[_LEVELS[backoff], 1.0]
            weight[chunk.is_hot] = hot_weight[chunk.hot_at[chunk.is_hot]]
            smooth = weight[chunk.first] * word_probability(count)[chunk.second]
            bigram = np.log10(_LEVELS[value] + smooth)
            word, size = chunk.second[chunk.place], len(chunk.ids)
            columns = [
                pa.array(chunk.ids, mask=chunk.nulls.astype(bool)),
                pa.array(chunk.lengths.astype(np.int64)),
                pa.array(np.bincount(chunk.row, (count > 0)[word], size).astype(np.int64)),
                pa.array(np.full(size, tokens)),
                pa.array(np.bincount(chunk.row, base_log(count)[word], size)),
                pa.array(np.bincount(chunk.row, bigram[chunk.place], size)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])

    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    both = chunked.unionByName(answered.where(F.col("kind") == _ANSWER))
    return both.repartition(shards, "chunk").sortWithinPartitions("chunk", "kind", "shard").mapInArrow(finish, schema)


def scores(docs: DataFrame, folds: int = 10, held: int = 0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    found = score(docs, fold(F.col("doc_id"), folds) != held)
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held, F.lit(False))
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
