"""SimHash near-duplicates by BK-trees over shards of fingerprints.

Fingerprints that differ in at most three of 64 bits agree wholly on at least
two of five bit blocks. Each of the ten pairs of blocks is a table of shards:
fingerprints with the same bits in both blocks. A shard becomes a BK-tree
(children keyed by their Hamming distance to the parent); a search follows only
the edges whose distance lies within the radius. Trees of a shard with many
fingerprints are split, and each part is sent to all parts of the shard that
must search it, so no task holds more than two parts.

Only distinct fingerprints enter the shards, so exact copies cost nothing, and
a tree reports a spanning forest instead of all pairs. Components are found by
star contraction over written tables.

Defined results: null or wordless text has fingerprint zero and is linked like
any other; repeated rows are returned each; rows with a null ``doc_id`` link
others but never name a component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.llm.components import components
from slatework.session import stage

RADIUS = 3
WIDTH = 3
SEED = 42
#: Fingerprints of one tree; a larger shard is split.
TREE_SIZE = 2048
_BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
_SHINGLES_AT_ONCE = 1 << 17


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """Majority bits of the XXH64 hashes of all word shingles of lower-cased UTF-8 text."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total = len(words) - width + 1
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(width))))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _SHINGLES_AT_ONCE):
        part = np.fromiter(hashes, np.dtype("<u8"), min(_SHINGLES_AT_ONCE, total - at))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > total, bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_column].dataType), T.StructField("fp", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            values = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(run, schema)


def _shard_keys(fp: Column) -> Column:
    """Ten keys: the number of the block pair above the bits of both blocks."""
    keys = []
    for i in range(len(_BLOCKS)):
        for j in range(i + 1, len(_BLOCKS)):
            (a, na), (b, nb) = _BLOCKS[i], _BLOCKS[j]
            first = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << na) - 1).cast("long"))
            second = F.shiftrightunsigned(fp, b).bitwiseAND(F.lit((1 << nb) - 1).cast("long"))
            number = F.lit(len(keys) << 26).cast("long")
            keys.append(number + first * F.lit(1 << nb).cast("long") + second)
    return F.array(*keys)


class BKTree:
    """Children keyed by Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` bits away."""
        if not self.values:
            return []
        found, waiting = [], [0]
        values, children = self.values, self.children
        while waiting:
            node = waiting.pop()
            distance = (values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            edges = children[node]
            if len(edges) <= 2 * radius + 1:
                waiting += [c for d, c in edges.items() if -radius <= d - distance <= radius]
            else:
                for d in range(max(0, distance - radius), distance + radius + 1):
                    if d in edges:
                        waiting.append(edges[d])
        return found

    def add(self, value: int) -> int:
        number = len(self.values)
        if number:
            node = 0
            while True:
                distance = (self.values[node] ^ value).bit_count()
                child = self.children[node].get(distance)
                if child is None:
                    self.children[node][distance] = number
                    break
                node = child
        self.values.append(value)
        self.children.append({})
        return number


class _Forest:
    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    def link(self, x: int, y: int) -> bool:
        a, b = self.root(x), self.root(y)
        if a == b:
            return False
        self.parent[b] = a
        return True


def _links(tree_values: list[int], query_values: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside the tree, or between tree and queries."""
    tree, forest, links = BKTree(), _Forest(), []
    for value in tree_values:
        if query_values is None:
            for node in tree.within(value, radius):
                if forest.link(tree.values[node], value):
                    links.append((tree.values[node], value))
        tree.add(value)
    for value in query_values or ():
        for node in tree.within(value, radius):
            if forest.link(tree.values[node], value):
                links.append((tree.values[node], value))
    return links


def near_links(distinct: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (a, b) that connect all of ``distinct.fp`` lying within ``radius`` (3 at most)."""
    if radius > 3:
        raise ValueError("five blocks prove links of three bits at most")
    keyed = distinct.select("fp", F.explode(_shard_keys(F.col("fp"))).alias("key"))
    sizes = keyed.groupBy("key").count().where(F.col("count") > 1)
    parts = F.ceil(F.col("count") / F.lit(tree_size)).cast("int")
    placed = keyed.join(sizes, "key").select(
        "key", "fp", parts.alias("n"), F.pmod(F.xxhash64("fp"), parts.cast("long")).cast("int").alias("part")
    )
    # Part i's tree is searched by its own members and by the members of every later part.
    as_tree = F.transform(
        F.sequence("part", F.col("n") - 1),
        lambda j: F.struct(F.col("part").alias("i"), j.alias("j"), F.lit(False).alias("q")),
    )
    as_query = F.transform(
        F.slice(F.sequence(F.lit(0), F.col("n")), F.lit(1), F.col("part")),
        lambda i: F.struct(i.alias("i"), F.col("part").alias("j"), F.lit(True).alias("q")),
    )
    units = placed.select("key", "fp", F.inline(F.concat(as_tree, as_query)))
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "q", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(key, i, j, query, fps):
            out = []
            starts = np.flatnonzero(
                np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
            )
            for s, e in zip(starts, np.r_[starts[1:], len(key)]):
                if e - s < 2:
                    continue
                values = fps[s:e].view(np.uint64).tolist()
                if i[s] == j[s]:
                    out += _links(values, None, radius)
                else:
                    queries = int(query[s:e].sum())
                    cut = len(values) - queries
                    out += _links(values[:cut], values[cut:], radius)
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            named = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "i", "j", "q", "fp")}
            columns = [named[n] for n in ("key", "i", "j", "q", "fp")]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            key, i, j = columns[:3]
            last = (key == key[-1]) & (i == i[-1]) & (j == j[-1])
            cut = int(np.argmax(last))
            if cut:
                yield edges(*(c[:cut] for c in columns))
            held = [c[cut:] for c in columns]
        if held is not None:
            yield edges(*held)

    return dealt.mapInArrow(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    marked = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    linked = components(near_links(distinct.select("fp")))
    whole = distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = whole.groupBy("component").agg(F.min("least").alias("component_id"))
    named = whole.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
