"""Embedding whitening by Jacobi-Davidson.

The covariance matrix is never formed. ``Products`` multiplies it with a few
vectors by one Spark pass over the distinct vectors: blocks are centred, then
multiplied, and only sums of the size of the result come back. The driver holds
a subspace of at most ``WIDEST`` vectors of the embedding's dimension.

Rayleigh-Ritz on the subspace gives the leading pairs. For each pair that is
not yet exact, MINRES solves the correction equation, projected onto what is
orthogonal to locked and current vectors, matrix-free; all solvers advance in
step, so that one pass serves them all. Pairs whose residual is at the level
of double precision are locked, until all are.

Entries c become x = floor(256 c). Sums and deviations are exact integers.

Defined results: vectors that are null, hold null or non-finite entries, or
entries whose x does not fit a long take no part; of vectors of several lengths
the commonest length takes part (the longest of equally common ones); repeated
vectors count once for the fit and get a row each; null and repeated ids are
kept; a component without variance (fewer distinct vectors or dimensions than
components) has a null ``whitened`` and stays out of ``identity_error``, which
is null without any variance, as is ``explained``; a deviation beyond a long is
null; vectors of fewer dimensions than ``components`` have one component per
dimension; equal eigenvalues give some orthonormal pair of their space; extra
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatework.session import stage

SCALE = 256
COMPONENTS = 4
#: Vectors of the search space at first, and before it is restarted.
FIRST = 24
WIDEST = 48
#: Further pairs that are corrected along, and the most MINRES steps of one correction. Both cost
#: columns of a pass rather than passes.
GUARDS = 4
INNER_STEPS = 4
#: Entries that one task of a pass reads (32 MB as doubles), so that partial sums stay fewer than entries.
TASK_ENTRIES = 4 << 20
_EPS = float(np.finfo(float).eps)
_LONG = float(2**63)


def integer_vectors(rows: DataFrame, vector_column: str = "embedding", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., x): the usable rows with their integer vectors."""
    entries = F.transform(vector_column, lambda c: c.cast("double") * SCALE)

    def usable(c):
        return c.isNotNull() & ~F.isnan(c) & (c >= -_LONG) & (c < _LONG)

    found = rows.select(*keep, entries.alias("entries"))
    found = found.where(F.col("entries").isNotNull() & F.forall("entries", usable))
    return found.select(*keep, F.transform("entries", lambda c: F.floor(c).cast("long")).alias("x"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimensions)


@dataclass
class Fit:
    """The distinct vectors as a written table, their number and their exact sums."""

    vectors: DataFrame
    n: int
    sums: list[int]

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def _total(vectors: DataFrame, block, rows: int, columns: int) -> np.ndarray:
    """Sum over all tasks of ``block`` (a function of an integer matrix), an array of this shape."""
    size = rows * columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += block(batch.column(0)).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["place", "value"])

    parts = vectors.select("x").mapInArrow(run, "place int, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for r in found:
        out[r["place"]] = r["value"]
    return out.reshape(rows, columns)


class Products:
    """Covariance (divisor n) times vectors, by one pass over the vectors per call."""

    def __init__(self, fit: Fit):
        self.fit = fit
        self.mean = np.array([s / max(fit.n, 1) for s in fit.sums])
        self.passes = 0

    def _sum(self, block, rows: int, columns: int) -> np.ndarray:
        self.passes += 1
        return _total(self.fit.vectors, block, rows, columns) / max(self.fit.n, 1)

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        mean, d = self.mean, self.fit.dimensions

        def block(column):
            centred = _matrix(column, d) - mean
            return centred.T @ (centred @ vectors)

        return self._sum(block, *vectors.shape)

    def trace(self) -> float:
        mean, d = self.mean, self.fit.dimensions
        return float(self._sum(lambda column: np.square(_matrix(column, d) - mean).sum(), 1, 1)[0, 0])

    def moments(self, axes: np.ndarray) -> np.ndarray:
        """Covariance of the vectors' coordinates on ``axes``, which already hold the scaling."""
        mean, d, k = self.mean, self.fit.dimensions, axes.shape[1]

        def block(column):
            w = (_matrix(column, d) - mean) @ axes
            return np.r_[w.T @ w, w.sum(axis=0)[None, :]]

        found = self._sum(block, k + 1, k)
        return found[:k] - np.outer(found[k], found[k])


def fit_list(vectors: DataFrame) -> Fit | None:
    """Distinct vectors, written once; each later pass reads that table."""
    distinct = stage(vectors.select("x").distinct(), "distinct-vectors")
    sums = (
        distinct.select(F.posexplode("x").alias("place", "entry"))
        .groupBy("place")
        .agg(F.sum(F.col("entry").cast("decimal(38,0)")).alias("total"))
    )
    found = {r["place"]: int(r["total"]) for r in sums.collect()}  # one row a dimension
    if not found:
        return None
    n = distinct.count()
    return Fit(distinct.coalesce(-(-n * len(found) // TASK_ENTRIES)), n, [found[k] for k in range(len(found))])


def _without(basis: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``v`` less its part in the orthonormal columns of ``basis``; twice, for rounding."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def minres(
    shift: float, basis: np.ndarray, right: np.ndarray, steps: int, tolerance: float
) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Solves (I-QQ')(A - shift)(I-QQ') t = right for t orthogonal to Q = ``basis``.

    A generator: it yields each vector that A is to be multiplied with and is
    sent the product, so that several solvers can share passes.
    """
    right = _without(basis, right)
    solution = np.zeros_like(right)
    beta = first = float(np.linalg.norm(right))
    if beta == 0:
        return solution
    older, new = np.zeros_like(right), right / beta
    # Lanczos with the QR factors of its tridiagonal matrix, by Givens rotations.
    far, before = np.zeros_like(right), np.zeros_like(right)
    cosines, sines, residual, step = (1.0, 1.0), (0.0, 0.0), beta, 0.0
    for _ in range(min(steps, len(right) - basis.shape[1])):
        product = yield new
        image = _without(basis, product - shift * new)
        alpha = float(new @ image)
        image = image - alpha * new - step * older
        following = float(np.linalg.norm(image))
        epsilon = sines[0] * step
        turned = cosines[0] * step
        delta = cosines[1] * turned + sines[1] * alpha
        gamma = -sines[1] * turned + cosines[1] * alpha
        rho = float(np.hypot(gamma, following))
        if rho <= _EPS * first:
            break
        cosine, sine = gamma / rho, following / rho
        direction = (new - delta * before - epsilon * far) / rho
        solution = solution + cosine * residual * direction
        residual *= -sine
        far, before = before, direction
        cosines, sines = (cosines[1], cosine), (sines[1], sine)
        if following <= _EPS * first or abs(residual) <= tolerance * first:
            break
        older, new, step = new, _without(basis, image / following), following
    return solution


def _corrections(multiply, solvers: list[Generator]) -> list[np.ndarray]:
    """Runs the solvers in step; each round is one block product."""
    done: list[np.ndarray | None] = [None] * len(solvers)
    waiting: dict[int, np.ndarray] = {}

    def advance(k, value):
        try:
            waiting[k] = solvers[k].send(value)
        except StopIteration as end:
            done[k] = end.value

    for k in range(len(solvers)):
        advance(k, None)
    while waiting:
        order = list(waiting)
        products = multiply(np.stack([waiting.pop(k) for k in order], axis=1))
        for column, k in enumerate(order):
            advance(k, products[:, column])
    return done


def _extended(space: np.ndarray, more: list[np.ndarray], rng: np.random.Generator) -> np.ndarray:
    """The new orthonormal columns that ``more`` adds; a random one where a vector adds nothing."""
    d, new = space.shape[0], np.zeros((space.shape[0], 0))
    for v in more:
        every = np.c_[space, new]
        if every.shape[1] >= d:
            break
        size = np.linalg.norm(v)
        v = _without(every, v / size) if size else np.zeros(d)
        while np.linalg.norm(v) < 1e-8:
            v = rng.standard_normal(d)
            v = _without(every, v / np.linalg.norm(v))
        v = _without(every, v / np.linalg.norm(v))
        new = np.c_[new, v / np.linalg.norm(v)]
    return new


def leading_pairs(multiply, dimensions: int, count: int = COMPONENTS, most_rounds: int = 500):
    """(eigenvalues falling, eigenvectors as columns, residual norms) of a symmetric matrix.

    ``multiply`` gives its product with a block of columns. Raises if the
    residuals do not reach double precision within ``most_rounds``.
    """
    d, count = dimensions, min(count, dimensions)
    wanted = count + GUARDS
    first, widest = max(FIRST, 2 * wanted), max(WIDEST, 4 * wanted)
    rng = np.random.default_rng(11)
    space = _extended(np.zeros((d, 0)), [rng.standard_normal(d) for _ in range(min(d, first))], rng)
    images = multiply(space)
    best, stalled = np.inf, 0
    for _ in range(most_rounds):
        small = space.T @ images
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        pairs, axes = ritz[:wanted], space @ turn[:, :wanted]
        residuals = images @ turn[:, :wanted] - axes * pairs
        norms = np.linalg.norm(residuals, axis=0)
        values, vectors = pairs[:count], axes[:, :count]
        # Rounding of a product is of the order of the largest eigenvalue times the unit.
        level = 4 * _EPS * max(float(np.abs(ritz).max()), np.finfo(float).tiny) * np.sqrt(d)
        open_pairs, worst = np.flatnonzero(norms > level), norms[:count].max()
        if worst <= level or space.shape[1] == d:
            return values, vectors, norms[:count]
        # Sums of a very long table round a little more: no gain in three rounds at that level ends it too.
        stalled, best = (0, worst) if worst < 0.5 * best else (stalled + 1, best)
        if stalled >= 3 and worst <= 1e3 * level:
            return values, vectors, norms[:count]
        if space.shape[1] + len(open_pairs) > widest:
            # Restart with the leading Ritz vectors.
            kept = turn[:, : widest // 2]
            space, images = space @ kept, images @ kept
        locked = [k for k in range(len(pairs)) if k not in open_pairs]
        solvers = []
        for k in open_pairs:
            basis = np.linalg.qr(np.c_[axes[:, locked], axes[:, k]])[0]
            solvers.append(minres(float(pairs[k]), basis, -residuals[:, k], INNER_STEPS, 0.1))
        more = _extended(space, _corrections(multiply, solvers), rng)
        space, images = np.c_[space, more], np.c_[images, multiply(more)]
    raise ArithmeticError(f"residuals {norms} above {level} after {most_rounds} rounds")


@dataclass
class Whitening:
    """What whitening a row needs: centre, unit axes as columns, eigenvalues, and the exact sums."""

    n: int
    sums: list[int]
    mean: np.ndarray
    axes: np.ndarray
    values: np.ndarray  # 0 for a component without variance
    trace: float
    identity_error: float | None
    residuals: np.ndarray
    passes: int


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fits on the distinct ``x`` of ``vectors``; None if there is none."""
    found = fit_list(vectors)
    if found is None:
        return None
    products = Products(found)
    trace = products.trace()
    values, axes, residuals = leading_pairs(products, found.dimensions, components)
    # Either sign is right; the entry of largest size is made positive.
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    values = np.where(values > 64 * _EPS * found.dimensions * trace, values, 0.0)
    some = values > 0
    error = None
    if some.any():
        covariance = products.moments(axes[:, some] / np.sqrt(values[some]))
        error = float(np.abs(covariance - np.eye(int(some.sum()))).max())
    return Whitening(found.n, found.sums, products.mean, axes, values, trace, error, residuals, products.passes)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; None beyond a long."""
    largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    bound = n * largest + max(map(abs, sums))
    if len(sums) * bound * bound < 2**63:
        return np.square(n * x - np.array(sums, np.int64)).sum(axis=1).tolist()
    exact = [sum((n * int(e) - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whiten(
    rows: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    usable = integer_vectors(rows, vector_column, (id_column,)).where(F.size("x") > 0)
    lengths = usable.groupBy(F.size("x").alias("length")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    schema = T.StructType([T.StructField("vec_id", rows.schema[id_column].dataType)])
    schema = schema.add("component", T.IntegerType()).add("n", T.LongType()).add("deviation", T.LongType())
    for name in ("whitened", "explained", "identity_error"):
        schema = schema.add(name, T.DoubleType())
    if not common:
        return rows.sparkSession.createDataFrame([], schema)
    usable = usable.where(F.size("x") == common[0]["length"]).select(F.col(id_column).alias("vec_id"), "x")
    model = fit(usable, components)
    names, d, k = schema.names, common[0]["length"], len(model.values)
    some = model.values > 0
    axes = model.axes / np.sqrt(np.where(some, model.values, 1.0))
    explained = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    n, sums, mean, error = model.n, model.sums, model.mean, model.identity_error
    deviations = _deviations

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            deviation = pa.array(deviations(x, n, sums), pa.int64())
            whitened = (x - mean) @ axes
            for c in range(k):
                own = pa.array(whitened[:, c]) if some[c] else pa.nulls(len(x), pa.float64())
                columns = [
                    batch.column(0),
                    pa.array(np.full(len(x), c + 1, np.int32)),
                    pa.array(np.full(len(x), n)),
                    deviation,
                    own,
                    pa.array([explained[c]] * len(x), pa.float64()),
                    pa.array([error] * len(x), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return usable.mapInArrow(run, schema)
