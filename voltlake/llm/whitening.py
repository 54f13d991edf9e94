"""Whitening of embeddings by shifted CholeskyQR.

Entries are kept as whole numbers, so that sums and the distances to the mean are exact however
far from zero the vectors lie. The centred rows A are made orthogonal in passes over the data:
each pass sums the Gram matrix of the rows as they stand after the triangular solves of the
passes before, and its Cholesky factor is the next triangle. The first factor is of the Gram
matrix plus a small shift, which succeeds however badly conditioned A is. The product R of all factors has the
singular values and right vectors of A; the covariance itself is never formed.

Only matrices of dimension x dimension numbers come to the driver. Partial sums of tasks meet in
two rounds, so that no task adds up more than a share of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import written

SCALE, OFFSET = 64, 1_000_000
LARGEST = 1 << 40  # of scaled entries, so that sums over a million million vectors fit
ROUND = 1024  # partial sums of the first round
DEPENDENT = 1e-9  # squared length, in the scale of orthogonal rows, of a column that others make up
Sums = Callable[[np.ndarray], np.ndarray]


def whole_numbers(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as floor(64 * c) + 1000000, of the rows that have a vector.

    Rows whose vector is null or holds an entry that is null, not finite or beyond 2**40 when scaled are
    left out; so are those of another length than most rows have (of equally many, the longer).
    """
    scaled = F.transform(F.col(vector_col), lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    fits = F.forall(
        F.col(vector_col),
        lambda c: F.coalesce(F.abs(c.cast("double")) * SCALE < LARGEST, F.lit(False)) & ~F.isnan(c.cast("double")),
    )
    usable = rows.filter(F.col(vector_col).isNotNull() & fits).select(
        F.col(id_col).alias("vec_id"), F.transform(scaled, lambda c: c + OFFSET).alias("x")
    )
    usable = written(usable, "whitening-rows")
    lengths = usable.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return usable.filter(F.size("x") == (usual.length if usual else 0))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The x of a batch, one row each."""
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, part: Sums, kind: str) -> np.ndarray | None:
    """The sum over all rows of ``part`` of their matrices, None without rows.

    Each task adds up its own rows; the sums of tasks meet in ``ROUND`` groups and those in one.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                more = part(matrix(batch))
                total = more if total is None else total + more
        if total is not None:
            at = TaskContext.get().partitionId() % ROUND
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()])], ["part", "total"])

    def met(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_buffer(), dtype=kind) for v in table.column("total"))
        return pa.table([table.column("part")[:1], pa.array([total.tobytes()])], names=["part", "total"])

    schema = "part int, total binary"
    sums = rows.select("x").mapInArrow(local, schema).groupBy("part").applyInArrow(met, schema)
    one = sums.withColumn("part", F.lit(0)).groupBy("part").applyInArrow(met, schema).collect()
    return np.frombuffer(one[0].total, dtype=kind) if one else None


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x minus the mean; the difference is exact before the division."""
    return (n * x - sums).astype(np.float64) / n


def solved(rows: np.ndarray, triangle: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangle, column by column."""
    out = np.empty((len(rows), len(triangle)))
    for j in range(len(triangle)):
        out[:, j] = (rows[:, j] - out[:, :j] @ triangle[:j, j]) / triangle[j, j]
    return out


def pivoted_cholesky(gram: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Upper factor with a row per independent column, and which columns those are: the largest
    remaining one each time, until what is left of all others is below ``least``."""
    rest, rows, pivots = gram.copy(), [], []
    for _ in range(len(gram)):
        left = np.diag(rest).copy()
        left[pivots] = -1.0
        j = int(np.argmax(left))
        if left[j] < least:
            break
        row = rest[j] / np.sqrt(rest[j, j])
        row[pivots] = 0.0
        rows.append(row)
        pivots.append(j)
        rest = rest - np.outer(row, row)
    return np.array(rows).reshape(len(rows), len(gram)), np.array(pivots, dtype=np.int64)


def orthogonalised(rows: DataFrame, n: int, sums: np.ndarray, most_passes: int = 8) -> np.ndarray:
    """R of the centred rows, one line per independent direction: A = QR with orthonormal Q."""
    d = len(sums)
    steps: list[tuple[np.ndarray, np.ndarray]] = []  # columns to keep, and the triangle to solve

    def gram(x: np.ndarray) -> np.ndarray:
        q = centred(x, n, sums)
        for kept, triangle in steps:
            q = solved(q[:, kept], triangle)
        return q.T @ q

    whole = np.arange(d)
    g = summed(rows, gram, "float64").reshape(d, d)
    largest = float(np.linalg.eigvalsh(g)[-1])
    if largest <= 0:
        return np.zeros((0, d))
    # Sums of many rows are made of sums of few, so that rounding does not grow with n beyond this.
    shift = 11 * (min(n, 1 << 20) * d + d * (d + 1)) * np.finfo(float).eps / 2 * largest
    r = np.linalg.cholesky(g + shift * np.eye(d)).T
    steps.append((whole, r))
    # Rows are now close enough to orthogonal to tell dependent columns from independent ones.
    g = summed(rows, gram, "float64").reshape(d, d)
    factor, kept = pivoted_cholesky(g, DEPENDENT)
    steps.append((kept, factor[:, kept]))
    r = factor @ r
    for _ in range(most_passes):
        g = summed(rows, gram, "float64").reshape(len(kept), len(kept))
        factor = np.linalg.cholesky(g).T
        steps.append((np.arange(len(kept)), factor))
        r = factor @ r
        if np.abs(g - np.eye(len(g))).max() < 1e-8:  # what is left is its square
            return r
    raise ArithmeticError(f"rows are not orthogonal after {most_passes + 2} passes")


def fit(rows: DataFrame, most: int = 32) -> dict | None:
    """n, sums, components (one column each), eigenvalues and explained shares of the rows of
    :func:`whole_numbers`; None without rows."""
    first = summed(rows, lambda x: np.concatenate(([len(x)], x.sum(axis=0))), "int64")
    if first is None:
        return None
    n, sums = int(first[0]), first[1:]
    r = orthogonalised(rows, n, sums) if len(sums) else np.zeros((0, 0))
    if not len(r):
        return {"n": n, "sums": sums, "components": np.zeros((len(sums), 0)), "values": np.zeros(0), "explained": np.zeros(0)}
    _, lengths, right = np.linalg.svd(r)
    values = lengths**2 / n
    components = right[: min(most, len(r))].T
    strongest = np.abs(components).argmax(axis=0)
    components = components * np.sign(components[strongest, range(components.shape[1])])
    k = components.shape[1]
    return {"n": n, "sums": sums, "components": components, "values": values[:k], "explained": values[:k] / values.sum()}


def whitened_rows(x: np.ndarray, model: dict) -> np.ndarray:
    return centred(x, model["n"], model["sums"]) @ (model["components"] / np.sqrt(model["values"]))


def identity_error(rows: DataFrame, model: dict) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""

    def moments(x: np.ndarray) -> np.ndarray:
        w = whitened_rows(x, model)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    k = len(model["values"])
    if not k:
        return 0.0
    found = summed(rows, moments, "float64").reshape(k + 1, k) / model["n"]
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n * x - sums) ** 2 of each row, exact; None beyond the range of a long."""
    off = n * x - sums
    if x.size and float(np.abs(off).max()) ** 2 * x.shape[1] >= 2.0**62:
        exact = (sum(v * v for v in row) for row in off.tolist())
        return [v if v < 1 << 63 else None for v in exact]
    return (off * off).sum(axis=1).tolist()


def whiten(
    embeddings: DataFrame, most: int = 32, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each row of
    :func:`whole_numbers` and each of the ``most`` strongest components, numbered from 1.

    Components are eigenvectors of the covariance of all rows, by falling eigenvalue, each with
    its largest entry positive. Only directions in which the rows differ are components: of
    dependent or constant columns, or of fewer rows than columns, there are fewer of them, and of
    rows that are all equal (or one row, or vectors without entries) none, so no result. Rows that share or lack an
    id are all fitted and returned. An empty table gives no rows; other columns play no part.
    """
    rows = whole_numbers(embeddings, id_col, vector_col)
    model = fit(rows, most)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double"
    error = identity_error(rows, model) if model else 0.0
    k = len(model["values"]) if model else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x, rows_in = matrix(batch), batch.num_rows
            of = pa.array(np.repeat(np.arange(rows_in), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(of),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_in)),
                    pa.array(np.full(rows_in * k, model["n"], dtype=np.int64)),
                    pa.array(deviations(x, model["n"], model["sums"]), pa.int64()).take(of),
                    pa.array(whitened_rows(x, model).ravel()),
                    pa.array(np.tile(model["explained"], rows_in)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained"],
            )

    return rows.mapInArrow(run, schema).withColumn("identity_error", F.lit(error))
