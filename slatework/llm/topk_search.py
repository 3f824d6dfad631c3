"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of ``BUCKET`` rows. A query's
k-th best product with the longest vectors is its threshold. A bucket is skipped
if even its longest vector, pointing the query's way, stays below the threshold.
In each other bucket the threshold becomes a local cosine threshold: from
``COSINE`` on, rows are pruned by coordinates (two large coordinates of the
query bound the same coordinates of any row within that angle; a coordinate
beyond the cosine bounds one side only), below it by length alone. Products of the remaining rows are computed exactly.

Queries go to groups of buckets by the group's number and pass a task in small
batches; the driver reads three numbers per group and one bucket. Nothing is cut off: ties at the k-th place are
decided by the smaller id inside every bucket and again over all buckets.

Defined results: vectors that are null or hold null or non-finite components
take no part; components are floor(scale * x); a shorter vector counts as
padded with zeros; repeated rows are candidates and queries each for itself; a
null id takes no part; a score beyond 64 bits is clipped to that range; an empty
table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slatework.session import stage

BUCKET = 1024
#: Most numbers of a group; its buckets are held by one task.
GROUP = 4 << 20
COSINE = 0.55
SCALE = 256
_NAMES = ["rows", "width", "longest", "uids", "ids", "numbers"]


def usable(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(uid, vec_id, v, norm) of the rows that take part; ``v`` holds whole numbers."""
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector_column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    rows = vectors.where(F.col(vector_column).isNotNull() & F.col(id_column).isNotNull() & finite)
    rows = rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).cast("long").alias("vec_id"), whole.alias("v")
    )
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def _packed(uids, ids, lists) -> list:
    widths = [len(x) for x in lists]
    numbers = np.zeros((len(lists), max(widths)), np.int64)
    for k, x in enumerate(lists):
        numbers[k, : widths[k]] = x
    norms = np.sqrt((numbers.astype(float) ** 2).sum(axis=1))
    return [len(lists), numbers.shape[1], float(norms.max()), uids.tobytes(), ids.tobytes(), numbers.tobytes()]


class Block:
    """Unpacked rows: ids, whole-number vectors, lengths and directions."""

    def __init__(self, row: dict, prefix: str = ""):
        shape = (row[prefix + "rows"], row[prefix + "width"])
        self.uids = np.frombuffer(row[prefix + "uids"], np.int64)
        self.ids = np.frombuffer(row[prefix + "ids"], np.int64)
        self.numbers = np.frombuffer(row[prefix + "numbers"], np.int64).reshape(shape)
        self.vectors = self.numbers.astype(np.float64)
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))

    def widen(self, width: int) -> None:
        """Pads shorter vectors with zeros."""
        extra = width - self.vectors.shape[1]
        if extra > 0:
            self.vectors = np.pad(self.vectors, ((0, 0), (0, extra)))
            self.numbers = np.pad(self.numbers, ((0, 0), (0, extra)))


def products(numbers: np.ndarray, vectors: np.ndarray, query: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products; doubles are exact as long as no sum can reach 2**53."""
    if bound < 2.0**52:
        return (vectors @ query.astype(np.float64)).astype(np.int64)
    if bound < 2.0**62:
        return numbers @ query
    whole = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in numbers]
    return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in whole], np.int64)


class Bucket(Block):
    """A bucket prepared for pruning: rows by length, and each coordinate's order of directions."""

    def __init__(self, row: dict, prefix: str = ""):
        super().__init__(row, prefix)
        self._orders: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def meet(self, query: Block) -> None:
        """Brings both to one width."""
        width = max(self.vectors.shape[1], query.vectors.shape[1])
        self.widen(width)
        query.widen(width)
        self.directions = self.vectors / np.maximum(self.norms, 1e-300)[:, None]

    def forget(self) -> None:
        """Drops what was made for pruning; it is larger than the rows."""
        self._orders, self.directions = {}, None

    def _range(self, coordinate: int, low: float, high: float) -> np.ndarray:
        if coordinate not in self._orders:
            order = np.argsort(self.directions[:, coordinate], kind="stable")
            self._orders[coordinate] = order, self.directions[order, coordinate]
        order, sorted_values = self._orders[coordinate]
        return order[np.searchsorted(sorted_values, low, "left") : np.searchsorted(sorted_values, high, "right")]

    def remaining(self, query: np.ndarray, norm: float, threshold: float, cosine: float = COSINE) -> np.ndarray:
        """Numbers of rows that may reach the threshold."""
        if not norm > 0 or threshold <= 0 or not len(self.norms):
            return np.arange(len(self.norms))
        longest = self.norms.max()
        slack = 1 - 1e-9
        local = threshold / (norm * longest) * slack if longest > 0 else np.inf
        if local > 1:
            return np.zeros(0, np.int64)
        if local < cosine:
            return np.flatnonzero(self.norms >= threshold / norm * slack)
        unit = query / norm
        kept = None
        for coordinate in np.argsort(-np.abs(unit), kind="stable")[:2]:
            middle = unit[coordinate] * local
            reach = np.sqrt(max(0.0, (1 - local**2) * (1 - unit[coordinate] ** 2))) + 1e-9
            # Within that angle of the axis itself a row may point along it, up to 1 or -1.
            low = -np.inf if unit[coordinate] <= -local else middle - reach
            high = np.inf if unit[coordinate] >= local else middle + reach
            rows = self._range(coordinate, low, high)
            kept = rows if kept is None else np.intersect1d(kept, rows, assume_unique=True)
        return kept[self.norms[kept] >= threshold / norm * slack]

    def best(self, query: Block, q: int, threshold: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the k best by score, then id; the query's own row is left out."""
        rows = self.remaining(query.vectors[q], query.norms[q], threshold)
        rows = rows[self.uids[rows] != query.uids[q]]
        if not len(rows):
            return rows, np.zeros(0, np.int64)
        bound = query.norms[q] * self.norms.max()
        scores = products(self.numbers[rows] if bound >= 2.0**52 else self.numbers, self.vectors[rows], query.numbers[q], bound)
        if len(scores) > k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[scores >= edge], scores[scores >= edge]
        order = np.lexsort((self.uids[rows], self.ids[rows], -scores))[:k]
        return rows[order], scores[order]


def _places(rows: DataFrame, bucket: int) -> tuple[DataFrame, int]:
    """Rows by falling length with the number of their group, a bounded stretch of that order; and the number of groups."""
    # The id breaks ties of the length, so copies of one vector spread over partitions.
    ordered = rows.repartitionByRange(F.desc("norm"), "uid").sortWithinPartitions(F.desc("norm"), "uid")
    spot = F.monotonically_increasing_id()
    kept = stage(ordered.select("*", F.shiftright(spot, 33).alias("part"), spot.bitwiseAND(2**33 - 1).alias("spot")), "ordered-vectors")
    counts = sorted(tuple(r) for r in kept.groupBy("part").agg(F.count(F.lit(1)), F.max(F.size("v"))).collect())
    before = dict(zip([p for p, *_ in counts], np.cumsum([0] + [n for _, n, _ in counts]).tolist()))
    total, width = sum(n for _, n, _ in counts), max([w for *_, w in counts] + [1])
    tasks = 8 * rows.sparkSession.sparkContext.defaultParallelism
    size = max(bucket, min(GROUP // width, math.ceil(total / tasks)))
    starts = rows.sparkSession.createDataFrame([*before.items()] if counts else [], "part bigint, start bigint")
    placed = kept.join(F.broadcast(starts), "part")
    place = F.floor((F.col("start") + F.col("spot")) / F.lit(size)).cast("int")
    return placed.select(place.alias("place"), "uid", "vec_id", "v", "norm"), math.ceil(total / size)


def _block(uids, ids, lists) -> dict:
    """A packed row of the given rows."""
    return dict(zip(_NAMES, _packed(np.asarray(uids, np.int64), np.asarray(ids, np.int64), lists)))


def _lists(column: pa.Array) -> list[np.ndarray]:
    """Numbers of each row of a list column."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(ends) else []


def _pieces(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
    bucket: int = BUCKET,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row where ``is_query`` holds.

    A group of buckets and the queries that it can still serve meet in one task. The
    group's rows stay there, the queries go by one Arrow batch after the other, so a
    task's memory depends on ``GROUP`` and not on the number of queries or vectors.
    """
    rows = stage(usable(vectors, id_column, vector_column, scale), "vectors")
    placed, groups = _places(rows, bucket)
    directory = placed.groupBy("place").agg(F.max("norm").alias("longest"), F.count(F.lit(1)).alias("rows")).orderBy("place").collect()
    # Lengths fall along the groups: what a query can reach are the first ones.
    longest = np.array([r["longest"] for r in directory], float)
    enough = [r["place"] for r in directory if r["rows"] > k]
    # The seed is one bucket, so its size is bounded.
    top = placed.where(F.col("place") == enough[0]).orderBy(F.desc("norm"), "uid").limit(bucket).collect() if enough else []
    seed = _block([r["uid"] for r in top], [r["vec_id"] for r in top], [r["v"] for r in top]) if top else None

    def prime(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with their threshold and the number of groups within it."""
        bucket_of = Bucket(seed) if seed else None
        for whole in batches:
            for batch in _pieces(whole, bucket):
                query = Block(_block(batch.column("uid"), batch.column("vec_id"), _lists(batch.column("v"))))
                thresholds = np.full(batch.num_rows, -np.inf)
                if bucket_of is not None:
                    bucket_of.meet(query)
                    for q in range(batch.num_rows):
                        scores = bucket_of.best(query, q, -np.inf, k)[1]
                        if len(scores) == k:
                            thresholds[q] = scores[-1]
                reach = query.norms[:, None] * longest[None, :] * (1 + 1e-9) >= thresholds[:, None]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid"), batch.column("vec_id"), batch.column("v"), pa.array(thresholds), pa.array(reach.sum(axis=1).astype(np.int32))],
                    ["uid", "vec_id", "v", "threshold", "groups"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, buckets = None, [], []
        for whole in batches:
            start, places, asks = 0, whole.column("place").to_numpy(), whole.column("threshold").is_valid().to_numpy(zero_copy_only=False)
            ends = [*(np.flatnonzero((np.diff(places) != 0) | (np.diff(asks.astype(int)) != 0)) + 1).tolist(), whole.num_rows]
            for end in ends:
                batch, start = whole.slice(start, end - start), end
                if not batch.num_rows:
                    continue
                if place != batch.column("place")[0].as_py():
                    place, held, buckets = batch.column("place")[0].as_py(), [], []
                if not batch.column("threshold")[0].is_valid:
                    held.append(batch.select(["uid", "vec_id", "v"]))
                    continue
                if held:
                    own = pa.Table.from_batches(held).combine_chunks().to_batches()
                    buckets, held = [Bucket(_block(b.column("uid"), b.column("vec_id"), _lists(b.column("v")))) for o in own for b in _pieces(o, bucket)], []
                for piece in _pieces(batch, bucket):
                    yield served(piece, buckets)

    def served(batch: pa.RecordBatch, buckets: list[Bucket]) -> pa.RecordBatch:
        """The k best rows of a group for each query; what one bucket offers raises the threshold for the next."""
        query = Block(_block(batch.column("uid"), batch.column("vec_id"), _lists(batch.column("v"))))
        thresholds = batch.column("threshold").to_numpy(zero_copy_only=False).copy()
        best = [np.zeros((0, 3), np.int64)] * batch.num_rows
        for own in buckets:
            own.meet(query)
            for q in np.flatnonzero(query.norms * own.norms.max() * (1 + 1e-9) >= thresholds):
                found, scores = own.best(query, q, thresholds[q], k)
                if not len(found):
                    continue
                both = np.concatenate([best[q], np.stack([scores, own.ids[found], own.uids[found]], axis=1)])
                best[q] = both[np.lexsort((both[:, 2], both[:, 1], -both[:, 0]))[:k]]
                if len(best[q]) == k:
                    thresholds[q] = max(thresholds[q], best[q][-1, 0])
            own.forget()
        sizes = [len(b) for b in best]
        flat = np.concatenate(best)
        columns = [np.repeat(query.uids, sizes), np.repeat(query.ids, sizes), flat[:, 2], flat[:, 1], flat[:, 0]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_uid", "query_id", "uid", "vec_id", "score"])

    asked = rows.where(is_query).select("uid", "vec_id", "v").repartition("uid")
    primed = asked.mapInArrow(prime, "uid bigint, vec_id bigint, v array<bigint>, threshold double, groups int")
    routed = primed.where("groups > 0").select(
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("place"), "uid", "vec_id", "v", F.lit(None).cast("double").alias("norm"), "threshold"
    )
    # Rows of a group come first, by falling length, then its queries.
    met = placed.withColumn("threshold", F.lit(None).cast("double")).unionByName(routed)
    dealt = met.repartition(max(groups, 1), "place").sortWithinPartitions("place", F.col("threshold").isNotNull(), F.desc("norm"), "uid")
    found = dealt.drop("norm").mapInArrow(
        answer, "query_uid bigint, query_id bigint, uid bigint, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id", "uid")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
