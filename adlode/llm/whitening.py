"""Whitening of vectors from the singular values of their centred rows.

Blocks of centred rows are reduced by QR to small triangles, in every task and then over the
tasks in a tree, so neither rows nor their products are ever gathered and the condition of the
data is not squared. The last triangle R has the size of a vector's dimension. Householder
reflections make it bidiagonal, dqds (the quotient-difference algorithm in its differential form
with shifts) finds the singular values to high relative accuracy, and twisted factorisations give
the vector of each value, which the reflections carry back to a whitening direction.

Components are long integers floor(256 * c). The estimate uses every distinct integer vector
once; vectors travel as packed bytes of the least width that holds them. Centred entries are
(n * x - S) / n from exact integers.

Defined results: vectors that are NULL or hold a NULL or non-finite entry are dropped; entries
beyond 64 bits stop at its bounds; missing trailing entries count as 0; rows without an id and
rows of equal id or vector are kept, each with its own results; components whose variance is
within rounding of 0 cannot be whitened and are not returned, so equal vectors alone, or a single
one, give no rows, like an empty table; a deviation beyond 64 bits is NULL. Further columns of the
input are left out.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlode.llm.common import record_batch, slices, table
from adlode.session import settle

SCALE, COMPONENTS = 256.0, 4
#: Rows of a block that is reduced at once, and triangles that one task of the tree stacks.
BLOCK, FAN_IN = 2048, 32
#: Sums of numbers below this bound stay in 64 bits.
SAFE = 1 << 62
EPS = np.finfo(float).eps
#: Singular values below this part of the largest count as rounding.
RANK_PART = 1e-12


def pack(numbers: np.ndarray) -> bytes:
    """A vector of 64-bit integers without trailing zeros in the least width that holds it: equal vectors, equal bytes."""
    used = np.flatnonzero(numbers)
    numbers = numbers[: used[-1] + 1] if len(used) else numbers[:0]
    low, high = (int(numbers.min()), int(numbers.max())) if len(numbers) else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + numbers.astype(f"<i{width}").tobytes()


def unpack(packed: list[bytes], size: int) -> np.ndarray:
    """Packed vectors as rows of ``size`` entries."""
    out = np.zeros((len(packed), size), np.int64)
    groups: dict[tuple[int, int], list[int]] = {}
    for row, raw in enumerate(packed):
        groups.setdefault((raw[0], len(raw)), []).append(row)
    for (width, length), rows in groups.items():
        flat = np.frombuffer(b"".join([packed[row][1:] for row in rows]), f"<i{width}")
        out[rows, : (length - 1) // width] = flat.reshape(len(rows), -1)
    return out


def integer_rows(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = SCALE) -> DataFrame:
    """vec_id, x (packed), size (entries of x) of every usable vector."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    low, high = -(1 << 63), (1 << 63) - 1

    def run(batches):
        for batch in slices(batches, 1024):
            column = batch.column(1)
            flat = column.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(float)  # a missing entry becomes nan
            sizes = np.array([n or 0 for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
            ends = np.cumsum(sizes)
            good = np.isfinite(values)
            scaled = np.floor(np.where(good, values, 0.0) * scale)
            fits = np.abs(scaled) < 2.0 ** 63
            numbers = np.where(fits, scaled, 0.0).astype(np.int64)
            numbers[~fits] = np.where(scaled[~fits] < 0, low, high)
            bad = np.concatenate([[0], np.cumsum(~good)])
            usable = (bad[ends] == bad[ends - sizes]) & column.is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(usable)
            packed = [pack(numbers[ends[i] - sizes[i]: ends[i]]) for i in at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(packed, pa.binary()),
                 pa.array([(len(x) - 1) // x[0] for x in packed], pa.int32())], names=["vec_id", "x", "size"])

    return rows.mapInArrow(run, rows.select("vec_id").schema.add("x", "binary").add("size", "integer"))


def column_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Rows and exact sums per dimension of the packed vectors of ``fit``."""
    def run(batches):
        n, halves = 0, np.zeros((2, size), np.int64)
        for batch in slices(batches, BLOCK):
            x = unpack(batch.column(0).to_pylist(), size)
            n += len(x)
            halves += [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]
        yield record_batch(schema, [np.arange(size), *halves, np.full(size, n)])

    schema = pa.schema([(name, pa.int64()) for name in ("at", "high", "low", "n")])
    kinds = "at long, high long, low long, n long"
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.select("x").mapInArrow(run, kinds).groupBy("at").agg(wide("high"), wide("low"), F.sum("n").alias("n"))
    found = sorted(rows.collect())  # one row per dimension
    return found[0]["n"], [(int(r.high) << 32) + int(r.low) for r in found]


class Centre:
    """n * x - S of integer rows, in 64 bits where that is certain to hold, with Python's integers elsewhere."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.bound = max(map(abs, sums), default=0)
        self.narrow = np.array(sums, np.int64) if self.bound < SAFE else None

    def numerators(self, x: np.ndarray) -> np.ndarray:
        largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
        if self.narrow is not None and largest * self.n + self.bound < SAFE:
            return x * self.n - self.narrow
        return x.astype(object) * self.n - np.array(self.sums, object)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        top = self.numerators(x)
        if top.dtype != object:
            # The sum of squares in doubles is off by far less than the factor of two kept free.
            rough = (top.astype(float) ** 2).sum(axis=1)
            if not len(rough) or rough.max() < SAFE:
                return (top * top).sum(axis=1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in top]
        return [v if v < 1 << 63 else None for v in exact]


def triangle(fit: DataFrame, centre: Centre, size: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows: blockwise in the tasks, then in a tree over them."""
    kinds = "part long, r binary"
    schema = pa.schema([("part", pa.int64()), ("r", pa.binary())])

    def blocks(batches):
        r = np.zeros((0, size))
        for batch in slices(batches, BLOCK):
            x = unpack(batch.column(0).to_pylist(), size)
            r = np.linalg.qr(np.vstack([r, centre(x)]), mode="r")
        if r.size:
            yield record_batch(schema, [[TaskContext.get().partitionId()], [r.tobytes()]])

    def stacked(rows: pa.Table) -> pa.Table:
        some = rows.sort_by("part").to_pydict()
        r = np.linalg.qr(np.vstack([np.frombuffer(x).reshape(-1, size) for x in some["r"]]), mode="r")
        return pa.Table.from_batches([record_batch(schema, [some["part"][:1], [r.tobytes()]])])

    level = settle(fit.select("x").mapInArrow(blocks, kinds))
    while (n := level.count()) > FAN_IN:
        groups = -(-n // FAN_IN)
        level = settle(level.groupBy(F.pmod("part", F.lit(groups))).applyInArrow(stacked, kinds))
    last = [row.r for row in level.orderBy("part").collect()]  # at most FAN_IN triangles
    return np.linalg.qr(np.vstack([np.zeros((1, size)), *[np.frombuffer(bytes(x)).reshape(-1, size) for x in last]]), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and upper diagonal of U' R W and the reflectors of W, by Householder reflections from both sides."""
    size = r.shape[1]
    a = np.zeros((size, size))
    a[: len(r)] = r
    right = []
    for k in range(size):
        _reflect(a[k:, k:])
        if k < size - 1:
            v = _reflect(a[k:, k + 1:].T)
            right.append(np.concatenate([np.zeros(k + 1), v]))
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflect(a: np.ndarray) -> np.ndarray:
    """Reflect the rows of ``a`` so that its first column keeps its first entry alone; the unit reflector."""
    v = a[:, 0].copy()
    norm = math.hypot(*v) if len(v) < 64 else float(np.linalg.norm(v))
    v[0] += math.copysign(norm, v[0])
    length = np.linalg.norm(v)
    if length == 0:
        return v
    v /= length
    a -= np.outer(2 * v, v @ a)
    return v


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling.

    A step takes the squares q, e of the matrix to those of another one whose squared values are
    less by the shift. The shift is a lower bound of the least squared value that the step before
    gives away: its d are the reciprocal diagonal of an inverse, whose trace is the sum of the
    reciprocal squared values. It never goes too far but for rounding, in which case the step is
    repeated without shift.
    """
    values: list[float] = []
    blocks = [(np.square(diagonal), np.square(upper), 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        bound = 0.0
        while len(q):
            small = np.flatnonzero(e <= EPS * EPS * (shifted + np.minimum(q[:-1], q[1:])) + np.finfo(float).tiny)
            if len(small):
                cut = int(small[-1]) + 1  # the matrix falls apart
                if cut < len(q) - 1:
                    blocks.append((q[:cut], e[: cut - 1], shifted))
                    q, e = q[cut:], e[cut:]
                    bound = 0.0
                    continue
                values.append(shifted + q[-1])
                q, e = q[:-1], e[:-1]
                e = e[: max(0, len(q) - 1)]
                continue
            if len(q) == 1:
                values.append(shifted + q[0])
                break
            for shift in (bound, 0.0):
                step = _step(q, e, shift)
                if step is not None:
                    break
            q, e, d = step
            shifted += shift
            with np.errstate(divide="ignore"):
                bound = float((1 - 4 * len(d) * EPS) / np.sum(1 / d)) if d.min() > 0 else 0.0
    return np.sqrt(np.sort(np.array(values))[::-1])


def _step(q: np.ndarray, e: np.ndarray, shift: float):
    """One step of dqds; None if a shift was too large."""
    new_q, new_e, ds, d = [], [], [], q[0] - shift
    for here, after in zip(e.tolist(), q[1:].tolist()):
        if d < 0 and shift:
            return None
        ds.append(d)
        top = d + here
        if top == 0:
            top = np.finfo(float).tiny
        ratio = after / top
        new_q.append(top)
        new_e.append(here * ratio)
        d = d * ratio - shift
    if d < 0:
        if shift:
            return None
        d = 0.0
    return np.array([*new_q, d]), np.array(new_e), np.array([*ds, d])


def twisted_vector(diagonal: np.ndarray, upper: np.ndarray, value: float, others: list[np.ndarray]) -> np.ndarray:
    """The unit right singular vector of a bidiagonal matrix for ``value``, orthogonal to ``others``.

    B'B minus the squared value is factorised from the top and from the bottom; where the two meet
    with the least remainder the factorisation is twisted, and its vector follows by products
    alone. ``others`` are the vectors of values that cannot be told from this one: the twist then moves on
    to the place that leaves most of a vector after theirs is taken out.
    """
    n, lam = len(diagonal), value * value
    floor = np.finfo(float).tiny ** 0.5 * max(1.0, lam)
    d, low = diagonal * diagonal, upper / diagonal[:-1]
    down, up = np.zeros(max(0, n - 1)), np.zeros(max(0, n - 1))
    s, p = np.zeros(n), np.zeros(n)
    s[0], p[-1] = -lam, d[-1] - lam
    for i in range(n - 1):
        pivot = s[i] + d[i]
        pivot = pivot if abs(pivot) > floor else math.copysign(floor, pivot)
        down[i] = d[i] * low[i] / pivot
        s[i + 1] = down[i] * low[i] * s[i] - lam
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] * low[i] + p[i + 1]
        pivot = pivot if abs(pivot) > floor else math.copysign(floor, pivot)
        ratio = d[i] / pivot
        up[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - lam
    best = None
    for k in np.argsort(np.abs(s + p + lam), kind="stable")[: 1 + 8 * len(others)]:
        z = np.zeros(n)
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -down[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -up[i] * z[i]
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for other in others:
                left = left - (other @ left) * other
        length = float(np.linalg.norm(left))
        if best is None or length > best[0] * 1.5:
            best = length, left
        if length > 0.5:
            break
    return best[1] / best[0] if best[0] > 0 else best[1]


def directions(r: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of R, falling, and their right singular vectors as columns."""
    diagonal, upper, right = bidiagonal(r)
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if norm == 0:
        return np.zeros(0), np.zeros((size, 0))
    scale = 2.0 ** -math.frexp(norm)[1]
    diagonal, upper = diagonal * scale, upper * scale
    values = dqds(diagonal, upper)
    values = values[: min(components, size)]
    values = values[values > RANK_PART * values[0]]
    # The matrix falls apart at negligible entries; a value's vector lives in the part that has it.
    diagonal = np.where(np.abs(diagonal) < EPS * EPS, EPS * EPS, diagonal)
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= EPS * EPS) + 1).tolist(), size]
    parts = [(a, b, dqds(diagonal[a:b], upper[a: b - 1])) for a, b in zip(cuts, cuts[1:])]
    owners = sorted(((v, a, b) for a, b, some in parts for v in some), key=lambda x: -x[0])
    found = []
    for v, a, b in owners[: len(values)]:
        close = [z for w, z in found if w - v <= 1e-3 * v]
        z = np.zeros(size)
        z[a:b] = twisted_vector(diagonal[a:b], upper[a: b - 1], v, [y[a:b] for y in close if np.any(y[a:b])])
        found.append((v, z))
    basis = np.array([z for _, z in found]).T.reshape(size, len(found))
    for v in reversed(right):
        basis -= np.outer(2 * v, v @ basis)
    return values / scale, basis


class Whitener:
    """Projects centred rows on the directions, over the standard deviation of each."""

    def __init__(self, centre: Centre, r: np.ndarray, components: int = COMPONENTS):
        values, basis = directions(r, components)
        self.centre = centre
        self.variances = values ** 2 / centre.n
        self.matrix = basis / np.sqrt(self.variances)
        total = float(np.square(r).sum()) / centre.n
        self.explained = self.variances / total if total else self.variances

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.centre(x) @ self.matrix


def identity_error(fit: DataFrame, whitener: Whitener, size: int) -> float:
    """The largest absolute entry of the covariance of all whitened vectors of ``fit``, minus the identity."""
    k = whitener.matrix.shape[1]
    schema = pa.schema([("at", pa.int32()), ("total", pa.float64())])

    def run(batches):
        sums = np.zeros((k + 1, k))
        for batch in slices(batches, BLOCK):
            w = whitener(unpack(batch.column(0).to_pylist(), size))
            sums += np.vstack([w.sum(axis=0), w.T @ w])
        yield record_batch(schema, [list(range(sums.size)), sums.ravel()])

    rows = fit.select("x").mapInArrow(run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros((k + 1) * k)
    sums[[row["at"] for row in rows]] = [row.total for row in rows]
    mean, *products = sums.reshape(k + 1, k) / whitener.centre.n
    return float(np.abs(np.array(products) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, **names) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row per usable vector and component."""
    rows = settle(integer_rows(vectors, **names))
    fit = settle(rows.select("x").distinct())
    size = rows.agg(F.max("size")).first()[0] or 0
    kinds = rows.select("vec_id").schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
                       ("explained", "double"), ("identity_error", "double")):
        kinds = kinds.add(name, kind)
    if not size:
        return vectors.sparkSession.createDataFrame([], kinds)
    n, sums = column_sums(fit, size)
    centre = Centre(n, sums)
    whitener = Whitener(centre, triangle(fit, centre, size), components)
    k = len(whitener.variances)
    if not k:
        return vectors.sparkSession.createDataFrame([], kinds)
    error = identity_error(fit, whitener, size)

    def run(batches):
        for batch in slices(batches, 1024):
            x = unpack(batch.column(1).to_pylist(), size)
            m = len(x)
            each = np.repeat(np.arange(m), k)
            deviation = centre.deviations(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                 pa.array(np.full(m * k, n), pa.int64()), pa.array([deviation[i] for i in each], pa.int64()),
                 pa.array(whitener(x).ravel()), pa.array(np.tile(whitener.explained, m)), pa.array(np.full(m * k, error))],
                names=kinds.names)

    return rows.select("vec_id", "x").mapInArrow(run, kinds)


def query(spark, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
