"""Whitening of embeddings by spectrum slicing.

Vectors become whole numbers; sums over the distinct ones give their mean and, after centring, their
covariance. The number of eigenvalues above a shift is read from the signs of an LDL' factorisation of
the shifted covariance, so bisection isolates each leading eigenvalue by counts alone; Rayleigh quotient
iteration then converges cubically to its vector, and counts on both sides certify its number.

Spark does all that grows with the rows; the driver factors one matrix of the vectors' dimension.
"""

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from listwise.llm.common import written

COMPONENTS = 4
SCALE = 256
_LONGEST = (1 << 63) - 1


class Whitening(NamedTuple):
    """``n`` distinct vectors, ``sums`` by dimension (exact), covariance, leading eigenvalues (falling) and their unit vectors (rows)."""

    n: int
    sums: list
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


def inertia(a: np.ndarray) -> tuple[int, int]:
    """(positive, negative) eigenvalues of a symmetric matrix, from the pivots of its LDL' factorisation.

    Pivots are single entries or 2 x 2 blocks, chosen by Bunch and Kaufman's rule; a block has one sign of each.
    """
    a = np.array(a, dtype=float)
    positive = negative = 0
    bound = (1 + 17 ** 0.5) / 8
    while len(a):
        column = np.abs(a[1:, 0])
        r = 1 + int(column.argmax()) if len(column) else 0
        big = column[r - 1] if r else 0.0
        size, first = 1, 0
        if abs(a[0, 0]) < bound * big:
            others = np.abs(np.delete(a[r], r)).max()
            if abs(a[0, 0]) * others < bound * big * big:
                if abs(a[r, r]) >= bound * others:
                    first = r
                else:
                    size = 2
        order = np.arange(len(a))
        if size == 2:
            order[[1, r]] = r, 1
        else:
            order[[0, first]] = first, 0
        a = a[np.ix_(order, order)]
        pivot = a[:size, :size]
        if size == 2:
            positive, negative = positive + 1, negative + 1
        elif pivot[0, 0] > 0:
            positive += 1
        elif pivot[0, 0] < 0:
            negative += 1
        below = a[size:, :size]
        if size == 2:
            step = below @ np.linalg.solve(pivot, below.T)
        else:
            step = below @ below.T / pivot[0, 0] if pivot[0, 0] else 0.0
        a = a[size:, size:] - step
        a = (a + a.T) / 2
    return positive, negative


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above a shift."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as rows.

    Eigenvalues that rounding cannot tell from 0 are left out. Equal ones get vectors at right angles. A
    vector's greatest entry in size is positive.
    """
    d, trace = len(matrix), float(np.trace(matrix))
    norm = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    eps = np.finfo(float).eps
    tiny = d * eps * norm
    values, vectors, windows = [], np.zeros((0, d)), []
    rng = np.random.default_rng(13)
    while len(values) < min(k, d) and trace > 0:
        number = len(values) + 1
        low, high = tiny, norm * (1 + 4 * eps) + tiny
        if above(matrix, low) < number:
            break
        at_low, at_high = above(matrix, low), 0
        found = None
        while found is None:
            # Isolated, or as narrow as rounding allows: a start for the iteration, which the counts then judge.
            if (at_low == number and at_high == number - 1) or high - low <= 4 * tiny:
                found = _iterated(matrix, (low + high) / 2, vectors, rng, eps * norm)
                value = found @ matrix @ found
                slack = max(8 * tiny, 64 * eps * norm)
                narrow = high - low <= 4 * tiny
                certain = above(matrix, value - slack) >= number and above(matrix, value + slack) < number
                if not narrow and not (low <= value <= high and certain):
                    found = None
            if found is None:
                middle = (low + high) / 2
                count = above(matrix, middle)
                low, at_low, high, at_high = (middle, count, high, at_high) if count >= number else (low, at_low, middle, count)
        values.append(float(value))
        vectors = np.vstack([vectors, found])
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)]) if len(vectors) else np.zeros(0)
    return np.array(values), vectors * signs[:, None]


def _iterated(matrix, shift, known, rng, goal):
    """A unit eigenvector near a shift, at right angles to the known ones: inverse steps at the shift, then Rayleigh quotients."""
    d = len(matrix)
    scale = max(float(np.abs(matrix).max()), np.finfo(float).tiny)

    def turned(x):
        for _ in range(2):
            x = x - known.T @ (known @ x)
        return x / np.linalg.norm(x)

    x = turned(rng.standard_normal(d))
    best, least = x, np.inf
    for step in range(40):
        rho = shift if step < 3 else float(x @ matrix @ x)
        shifted = matrix - rho * np.eye(d)
        try:
            y = np.linalg.solve(shifted, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(shifted + np.finfo(float).eps * scale * np.eye(d), x)
        if not np.isfinite(y).all() or not y.any():
            break
        x = turned(y / np.abs(y).max())
        residual = float(np.linalg.norm(matrix @ x - (x @ matrix @ x) * x))
        if residual < least:
            best, least = x, residual
        elif step > 6:
            break
    return best


def whole(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(key, x) of the rows whose vector has finite entries only: x = floor(scale * entry) as longs.

    Rows of a null vector, or with a null, infinite or undefined entry, go. Of vectors of several lengths those of the
    most frequent length stay (of equally frequent ones the greatest), as the others have no place in its space.
    """
    entries = F.col(vector).cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = df.select(F.col(key).alias("key"), entries.alias("v")).where(F.coalesce(fine, F.lit(False)) & (F.size("v") > 0))
    rows = rows.select("key", F.transform("v", lambda c: F.floor(c * float(scale)).cast("long")).alias("x"))
    common = rows.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d")).alias("m")).select(F.col("m.d").alias("d"))
    return rows.join(common, F.size("x") == F.col("d"), "left_semi")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _summed(df: DataFrame, partial, kind: str) -> dict:
    """{(i, j): sum} of what ``partial`` adds up in each task, a dict of numbers per task; the sums are as many as its keys."""
    def run(batches):
        total = {}
        for batch in batches:
            if batch.num_rows:
                for k, v in partial(_matrix(batch.column(0))).items():
                    total[k] = v if k not in total else total[k] + v
        rows = [(int(i), int(j), v) for i, block in total.items() for j, v in enumerate(np.ravel(block).tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([str(r[2]) if kind != "double" else r[2] for r in rows], pa.string() if kind != "double" else pa.float64())],
                                         names=["i", "j", "v"])

    rows = df.select("x").mapInArrow(run, f"i int, j int, v {'double' if kind == 'double' else 'string'}")
    out = rows.groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v"))
    return {(r.i, r.j): r.v for r in out.collect()}


def _deviations(x: np.ndarray, n: int, sums: list) -> np.ndarray:
    """n * x - S of every entry, exact: longs, or whole numbers of any size where longs could overflow."""
    reach = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(s) for s in sums)
    if x.shape[1] * reach * reach <= _LONGEST:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def fit(vectors: DataFrame, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (``x``); None without any. Sums are exact, the covariance is of centred vectors, divisor n."""
    n = vectors.count()
    if not n:
        return None
    found = _summed(vectors, lambda x: {0: x.astype(object).sum(axis=0) if np.abs(x.astype(float)).max() * len(x) > 2 ** 62 else x.sum(axis=0)}, "decimal(38,0)")
    sums = [int(found[0, j]) for j in range(len(found))]
    d = len(sums)

    def products(x):
        y = (_deviations(x, n, sums) / n).astype(float)
        y = y.T @ y / n
        return {i: y[i] for i in range(d)}

    found = _summed(vectors, products, "double")
    covariance = np.array([[found[i, j] for j in range(d)] for i in range(d)])
    covariance = (covariance + covariance.T) / 2
    return Whitening(n, sums, covariance, *leading(covariance, k))


def projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened coordinates: centred rows on the components, over the roots of the eigenvalues."""
    centred = (_deviations(x, model.n, model.sums) / model.n).astype(float)
    return centred @ model.vectors.T / np.sqrt(model.values)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The greatest absolute entry of the whitened vectors' covariance minus the identity, measured over the vectors."""
    k = len(model.values)

    def moments(x):
        z = projected(x, model)
        return {0: z.sum(axis=0), **{i + 1: z.T[i] @ z for i in range(k)}}

    found = _summed(vectors, moments, "double")
    mean = np.array([found[0, j] for j in range(k)]) / model.n
    second = np.array([[found[i + 1, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: key, component, n, deviation, whitened, explained, identity_error.

    Rows are dropped as ``whole`` says. Repeated rows each get their rows; a vector counts once in the fit. Components
    whose eigenvalue is 0 cannot be scaled and are left out, so rows of a single vector give none; an empty
    table gives none. A deviation beyond the range of a long is null. Columns not named are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = whole(df, key, vector)
    # The distinct vectors; rows of one vector meet as partial groups, so no number of copies fills a task.
    distinct = written(rows.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, components)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    error = identity_error(distinct, model)
    explained = model.values / np.trace(model.covariance)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            z = projected(x, model)
            y = _deviations(x, model.n, model.sums)
            total = [v if v <= _LONGEST else None for v in (y * y).sum(axis=1).tolist()]
            each = np.repeat(np.arange(len(x)), k)
            same = lambda v, t: pa.array([v] * len(each), t)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), same(model.n, pa.int64()),
                 pa.array(total, pa.int64()).take(pa.array(each)), pa.array(z.ravel()), pa.array(np.tile(explained, len(x))), same(error, pa.float64())],
                names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
