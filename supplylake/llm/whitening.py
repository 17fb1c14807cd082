"""Whitening of embeddings by their leading principal components.

Entries become whole numbers (``floor(256 * entry)``), so that the mean and every
deviation from it are exact.  The covariance is never formed: a product with it is
one pass over stored blocks of the distinct vectors, each block centred, multiplied
and summed by its task, for a few directions at a time.  Jacobi-Davidson finds the
leading eigenpairs from such products alone: Rayleigh-Ritz in a small subspace gives
approximations and residuals, MINRES solves the projected correction equations of all
open pairs in step (one pass a step), and a pair is locked once its residual is
rounding error.  The driver holds some tens of vectors as long as an embedding.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, scan_tasks

SCALE = 256
COMPONENTS = 4
#: Vectors in a stored block.
BLOCK = 8192
#: Partial sums of more tasks than this are summed in tasks before the driver reads them.
TO_DRIVER = 64
#: The subspace restarts from its best vectors beyond so many.
SUBSPACE = 32
#: Steps of MINRES a correction, and the fall of its residual that ends it.
STEPS = 12
FALL = 0.02
#: Outer rounds after which the method is taken to fail.
ROUNDS = 300
EPS = float(np.finfo(float).eps)
#: Whole numbers below this can be summed once more in 64 bits.
SAFE = 2 ** 62


def whole_entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of all vectors end to end as whole numbers, where each vector ends,
    and which vectors are neither null nor empty and hold finite entries only.  What
    exceeds 64 bits becomes the nearest 64-bit number."""
    size = pc.fill_null(column.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(size)
    fine = np.isfinite(flat)
    faults = np.concatenate(([0], np.cumsum(~fine)))
    with np.errstate(over="ignore"):
        scaled = np.floor(np.where(fine, flat, 0.0) * SCALE)
    whole = np.clip(scaled, -2.0 ** 63, 2.0 ** 62).astype(np.int64)
    big = scaled >= 2.0 ** 62
    whole[big] = [min(int(v), 2 ** 63 - 1) if np.isfinite(v) else 2 ** 63 - 1 for v in scaled[big]]
    return whole, ends, (size > 0) & (faults[ends] == faults[ends - size])


def packed(vector: np.ndarray) -> bytes:
    """Little-endian numbers of the fewest bytes that hold all of them."""
    most = max(int(vector.max()), -int(vector.min()) - 1)
    return vector.astype("<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<i8").tobytes()


def unpacked(vectors: pa.Array, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the packed vectors of each width."""
    size = pc.binary_length(vectors).to_numpy(zero_copy_only=False) // dim
    for width in np.unique(size):
        at = np.flatnonzero(size == width)
        data = b"".join(vectors.take(pa.array(at)).to_pylist())
        yield at, np.frombuffer(data, f"<i{width}").reshape(-1, dim)


def packed_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``vector`` (packed whole entries) and ``dim`` of each row that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, ends, kept = whole_entries(batch.column("embedding"))
            at = np.flatnonzero(kept)
            begin = np.concatenate(([0], ends))[at]
            vectors = [packed(whole[a:b]) for a, b in zip(begin.tolist(), ends[at].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), pa.array(vectors, pa.binary()),
                 pa.array((ends[at] - begin).astype(np.int32))], ["vec_id", "vector", "dim"])

    kind = embeddings.schema["vec_id"].dataType.simpleString()
    return (embeddings.select("vec_id", F.col("embedding").cast("array<double>"))
            .mapInArrow(run, f"vec_id {kind}, vector binary, dim int"))


def blocks_of(vectors: DataFrame, dim: int) -> DataFrame:
    """The packed vectors as ``block`` (numbers of many vectors end to end) and ``width``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                for _, matrix in unpacked(batch.column("vector").slice(at, BLOCK), dim):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([matrix.tobytes()], pa.binary()), pa.array([matrix.itemsize], pa.int32())],
                        ["block", "width"])

    return vectors.mapInArrow(run, "block binary, width int")


def folded(blocks: DataFrame, dim: int, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """The sum of ``work`` over the matrices of all blocks, in the order of the tasks;
    None without blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block, width in zip(batch.column("block"), batch.column("width").to_pylist()):
                got = work(np.frombuffer(block.as_buffer(), f"<i{width}").reshape(-1, dim))
                total = got if total is None else total + got
        if total is not None:
            yield part(TaskContext.get().partitionId(), total)

    def part(number: int, value: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([pickle.dumps(value)], pa.binary())],
                                          ["part", "value"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((n, v) for b in batches for n, v in zip(b.column("part").to_pylist(), b.column("value").to_pylist()))
        if rows:
            yield part(rows[0][0], sum(pickle.loads(v) for _, v in rows))

    parts = blocks.mapInArrow(run, "part int, value binary")
    tasks = scan_tasks(blocks)
    while tasks > TO_DRIVER:
        tasks = math.isqrt(tasks - 1) + 1
        parts = parts.repartition(tasks, "part").mapInArrow(add, "part int, value binary")
    rows = sorted((r.part, r.value) for r in parts.collect())
    return sum(pickle.loads(v) for _, v in rows) if rows else None


def exact_sums(matrix: np.ndarray) -> np.ndarray:
    """The number of rows and the sums of the columns, as unbounded whole numbers."""
    most = max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0
    sums = matrix.sum(axis=0, dtype=np.int64 if most * len(matrix) < SAFE else object)
    return np.array([len(matrix), *(int(s) for s in sums)], object)


class Centre:
    """The mean ``sums / n`` of whole vectors, taken from them without rounding."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.most = max(abs(s) for s in sums)

    def scaled(self, matrix: np.ndarray) -> np.ndarray:
        """``n * x - sums`` as 64-bit numbers where they fit, else as unbounded ones."""
        most = max(int(matrix.max()), -int(matrix.min())) if matrix.size else 0
        if most * self.n + self.most < SAFE:
            return matrix.astype(np.int64) * self.n - np.array(self.sums, np.int64)
        return matrix.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        return (self.scaled(matrix) / self.n).astype(float)

    def deviations(self, matrix: np.ndarray) -> list[int | None]:
        """The sums of squares of ``scaled``, exactly; None beyond 64 bits."""
        scaled = self.scaled(matrix)
        most = max(int(scaled.max()), -int(scaled.min())) if scaled.size else 0
        if most * most * matrix.shape[1] < SAFE:
            return (scaled * scaled).sum(axis=1).tolist()
        squares = [sum(int(v) ** 2 for v in row) for row in scaled]
        return [s if s < 2 ** 63 else None for s in squares]


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The directions of ``new`` that ``against`` does not hold, as unit columns."""
    kept: list[np.ndarray] = []
    for v in new.T:
        size = np.linalg.norm(v)
        if not size:
            continue
        v = v / size
        for _ in range(3):
            for held in (*against, np.array(kept).T.reshape(len(v), -1)):
                v = v - held @ (held.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-8:
                break
            v = v / size
        else:
            kept.append(v)
    return np.array(kept).T.reshape(len(new), -1)


def minres(b: np.ndarray) -> Iterator[np.ndarray]:
    """Solves ``B t = b`` for a symmetric ``B``: yields vectors, is sent their products
    with ``B``, and returns ``t``."""
    first = left = float(np.linalg.norm(b))
    t, before, direction, older = (np.zeros(len(b)) for _ in range(4))
    v = b / first
    beta = epsilon = bar = sine = 0.0
    cosine = -1.0
    for _ in range(STEPS):
        y = yield v
        alpha = float(v @ y)
        y = y - alpha * v - beta * before
        new = float(np.linalg.norm(y))
        delta, gap = cosine * bar + sine * alpha, sine * bar - cosine * alpha
        passed, epsilon, bar = epsilon, sine * new, -cosine * new
        gamma = max(math.hypot(gap, new), EPS * first)
        cosine, sine = gap / gamma, new / gamma
        older, direction = direction, (v - passed * older - delta * direction) / gamma
        t = t + cosine * left * direction
        left *= sine
        if left <= FALL * first or new <= EPS * abs(alpha):
            break
        before, v, beta = v, y / new, new
    return t


def corrections(product: Callable, held: np.ndarray, values: np.ndarray, residuals: np.ndarray) -> np.ndarray:
    """For each value and residual the solution of the correction equation
    ``(1 - QQ')(A - value)(1 - QQ') t = -residual`` with ``Q = held``, all in step."""
    def outside(x: np.ndarray) -> np.ndarray:
        return x - held @ (held.T @ x)

    solvers = [minres(b) for b in -outside(residuals).T]
    asked = {i: next(s) for i, s in enumerate(solvers)}
    found = np.zeros_like(residuals)
    while asked:
        order = list(asked)
        ask = outside(np.array([asked[i] for i in order]).T)
        got = outside(product(ask) - ask * values[order])
        for i, column in zip(order, got.T):
            try:
                asked[i] = solvers[i].send(column)
            except StopIteration as end:
                found[:, i] = end.value
                del asked[i]
    return outside(found)


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], dim: int, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``want`` eigenvalues, falling, and unit eigenvectors (columns) of a
    symmetric positive semidefinite operator known by its products with matrices; those
    that are zero up to rounding are left out."""
    want = min(want, dim)
    start = np.random.default_rng(11).standard_normal((dim, min(dim, want + 4)))
    basis = orthonormal(product(orthonormal(start)))
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    if not basis.size:
        return values, locked
    image = product(basis)
    least, stalled = np.inf, 0
    for _ in range(ROUNDS):
        projected = basis.T @ image
        theta, turn = np.linalg.eigh((projected + projected.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        largest = max([*values, *theta, 0.0])
        open_ = min(want - len(values), len(theta))
        residuals = image[:, :open_] - basis[:, :open_] * theta[:open_]
        residuals -= locked @ (locked.T @ residuals)
        size = np.linalg.norm(residuals, axis=0)
        worst = size.max(initial=0.0)
        stalled = stalled + 1 if worst > least / 2 else 0
        least = min(least, worst)
        fine = size <= (8 if stalled < 4 else 512) * EPS * math.sqrt(dim) * largest
        done = int(np.argmin(fine)) if not fine.all() else open_
        if done:
            locked, values = np.hstack([locked, basis[:, :done]]), np.append(values, theta[:done])
            basis, image = basis[:, done:], image[:, done:]
            residuals, theta, open_ = residuals[:, done:], theta[done:], open_ - done
            least, stalled = np.inf, 0
        if len(values) == want or not basis.size:
            break
        if basis.shape[1] + open_ > max(SUBSPACE, 2 * want):
            basis, image = basis[:, :want + 4], image[:, :want + 4]
        if not open_:
            break
        held = np.hstack([locked, basis[:, :open_]])
        new = orthonormal(corrections(product, held, theta[:open_], residuals), locked, basis)
        if not new.size:  # the space is exhausted or the corrections are rounding
            new = orthonormal(np.random.default_rng(len(values)).standard_normal((dim, 1)), locked, basis)
        if new.size:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    else:
        raise RuntimeError(f"residuals stay above rounding after {ROUNDS} rounds: {size}")
    order = np.argsort(-values, kind="stable")
    kept = order[values[order] > dim * EPS * values.max(initial=0.0)]
    return values[kept], locked[:, kept]


def whiten_embeddings(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per row of ``embeddings`` (``vec_id``, ``embedding``) that counts and component:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Dropped are rows whose vector is null or empty or holds a null or non-finite entry,
    and vectors whose length is not that of most rows (on a tie, the longer).  Entries
    count as ``floor(256 * entry)``; what exceeds 64 bits counts as the nearest 64-bit
    number, and a deviation beyond 64 bits is null.  Repeated rows count once for the
    components and are each returned; a null id stays null.  Components without variance
    are not returned, so one distinct vector, or none, gives no rows.  Equal eigenvalues
    leave their directions open.  Very long vectors cost some tens of their length on
    the driver.  Other columns are never read.
    """
    rows = saved(packed_vectors(embeddings), "white-rows")
    lengths = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    schema = ("vec_id {}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double").format(embeddings.schema["vec_id"].dataType.simpleString())
    nothing = rows.sparkSession.createDataFrame([], schema)
    if not lengths:
        return nothing
    dim = lengths[0].dim
    rows = rows.filter(F.col("dim") == dim)
    fit = saved(blocks_of(rows.select("vector").distinct(), dim), "white-fit")
    n, *sums = folded(fit, dim, exact_sums).tolist()
    centre = Centre(n, sums)

    def product(directions: np.ndarray) -> np.ndarray:
        def work(matrix: np.ndarray) -> np.ndarray:
            x = centre.centred(matrix)
            return x.T @ (x @ directions)
        return folded(fit, dim, work) / n

    trace = float(folded(fit, dim, lambda m: np.array([(centre.centred(m) ** 2).sum()]))[0]) / n
    values, vectors = leading_pairs(product, dim, components)
    if not len(values):
        return nothing
    root = np.sqrt(values)
    mean = folded(fit, dim, lambda m: (centre.centred(m) @ vectors / root).sum(axis=0)) / n

    def squares(matrix: np.ndarray) -> np.ndarray:
        white = centre.centred(matrix) @ vectors / root - mean
        return white.T @ white

    error = float(np.abs(folded(fit, dim, squares) / n - np.eye(len(values))).max())
    k = len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK):
                part = batch.slice(begin, BLOCK)
                for at, matrix in unpacked(part.column("vector"), dim):
                    white = centre.centred(matrix) @ vectors / root
                    ids = part.column("vec_id").take(pa.array(np.repeat(at, k)))
                    deviation = [v for v in centre.deviations(matrix) for _ in range(k)]
                    m = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                         pa.array(np.full(m * k, n)), pa.array(deviation, pa.int64()), pa.array(white.ravel()),
                         pa.array(np.tile(values / trace, m)), pa.array(np.full(m * k, error))],
                        ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "vector").mapInArrow(run, schema)
