"""Embedding whitening: leading components of a covariance by Jacobi-Davidson.

The covariance is never formed. A product with it is one distributed pass over the fit list (each distinct
vector once): every task centres its vectors, multiplies them with the block of directions and back, and
the sums of all tasks are added by Spark, one row per dimension. What reaches the driver is a block of
directions, whatever the number of vectors.

The search space grows by corrections. For each leading Ritz pair (u, theta) of residual r the equation
(I - QQ')(V - theta)(I - QQ') t = -r, Q being u and the locked components, is solved roughly by ``INNER`` steps of MINRES,
for all pairs of the block in the same passes. Rayleigh-Ritz over the space follows. A component is locked once its
residual is within ``ROUNDING`` roundings of the largest eigenvalue and all before it are locked; those after it are sought at right
angles to it. ``BLOCK`` pairs are corrected at a time, more than wanted, so that close eigenvalues are found in their order.

Centring is exact: an entry x of n vectors with sum S becomes n * x - S before it turns into a double.

Defined cases: a vector that is null or holds null or non-finite entries is left out; shorter vectors are
filled up with zeros; rows count once each in the result, and equal ones once together in the fit list; ids
may be null or repeated and go through as they are; a component of eigenvalue zero (fewer distinct vectors than components, a
constant dimension, no spread at all) is not returned, so a table of one distinct vector has no rows; a
``deviation`` beyond the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knownby.llm.tables import stored
from knownby.llm.vectors import matrix, whole_vectors

SCALE = 256
COMPONENTS = 4
BLOCK = 8
INNER = 5
#: The search space is cut back to its best 2 * BLOCK directions beyond this size.
SPACE = 96
ROUNDING = 64
MAX_ROUNDS = 200
_EPS = float(np.finfo(np.float64).eps)
_LONG = 2**63

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Sums:
    """Number of vectors and exact sum per dimension."""

    n: int
    totals: tuple[int, ...]

    @property
    def width(self) -> int:
        return len(self.totals)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exactly: as longs, or as Python integers where these might not do."""
        reach = int(np.abs(x.astype(np.float64)).max(initial=0.0)) * self.n + max(map(abs, self.totals), default=0)
        if 2 * reach < _LONG:
            return x * np.int64(self.n) - np.array(self.totals, np.int64)
        return x.astype(object) * self.n - np.array(self.totals, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.spread(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sum of squares of each row of ``spread``."""
        y = self.spread(x)
        top = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
        if top * top * max(1, self.width) < _LONG:
            y = y.astype(np.int64)
            return (y * y).sum(1).tolist()
        found = (y.astype(object) ** 2).sum(1)
        return [int(v) if v < _LONG else None for v in found]


def _sums(fit: DataFrame, width: int) -> Sums:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * width
        for b in batches:
            x = matrix(b["x"], width)
            n += len(x)
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            totals = [t + (int(h) << 32) + int(w) for t, h, w in zip(totals, high, low)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, width), pa.int32()), pa.array([n, *totals], pa.decimal128(38, 0))], ["at", "total"]
        )

    rows = fit.mapInArrow(run, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total")).collect()
    found = {r["at"]: int(r["total"]) for r in rows}
    return Sums(found.get(-1, 0), tuple(found.get(i, 0) for i in range(width)))


def _added(fit: DataFrame, partial: Callable[[np.ndarray], np.ndarray], sums: Sums, shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``partial(centred rows)`` over all batches of the fit list."""
    width, names = sums.width, [f"w{k}" for k in range(shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for b in batches:
            total += partial(sums.centred(matrix(b["x"], width)))
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), *map(pa.array, total.T)], ["at", *names])

    schema = ", ".join(["at int", *[f"{w} double" for w in names]])
    rows = fit.mapInArrow(run, schema).groupBy("at").agg(*[F.sum(w).alias(w) for w in names]).collect()
    out = np.zeros(shape)
    for r in rows:
        out[r["at"]] = r[1:]
    return out


def minres(product: Product, shift: np.ndarray, project: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions, by columns, of project(product(t) - shift * t) = right, t in the range of ``project``.

    One product serves the step of all columns.
    """
    norm = lambda a: np.sqrt(np.einsum("ij,ij->j", a, a))
    over = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=np.abs(b) > 1e-300)
    t = np.zeros_like(right)
    before, beta = np.zeros_like(right), norm(right)
    v = over(right, np.broadcast_to(beta, right.shape))
    w_before, w_now = np.zeros_like(right), np.zeros_like(right)
    cos0, cos1, sin0, sin1, eta = np.ones_like(beta), np.ones_like(beta), 0 * beta, 0 * beta, beta
    for _ in range(steps):
        image = project(product(v) - shift * v)
        alpha = np.einsum("ij,ij->j", v, image)
        after = project(image - alpha * v - beta * before)
        beta_after = norm(after)
        diagonal = cos1 * alpha - cos0 * sin1 * beta
        r1 = np.hypot(diagonal, beta_after)
        r2, r3 = sin1 * alpha + cos0 * cos1 * beta, sin0 * beta
        cos0, cos1, sin0, sin1 = cos1, over(diagonal, r1), sin1, over(beta_after, r1)
        w = over(v - r3 * w_before - r2 * w_now, np.broadcast_to(r1, v.shape))
        t += cos1 * eta * w
        eta = -sin1 * eta
        w_before, w_now, before, beta = w_now, w, v, beta_after
        v = over(after, np.broadcast_to(beta, after.shape))
    return t


def _fresh(directions: np.ndarray, *spaces: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``directions`` add to the orthonormal ``spaces``."""
    known = np.hstack(spaces)
    kept: list[np.ndarray] = []
    for d in directions.T:
        size = np.linalg.norm(d)
        if not size:
            continue
        d = d / size
        for _ in range(3):
            d = d - known @ (known.T @ d)
            for k in kept:
                d = d - k * (k @ d)
            left = np.linalg.norm(d)
            if left < 1e-10:
                break
            d = d / left
        else:
            kept.append(d)
    return np.array(kept).reshape(len(kept), len(directions)).T


def leading_pairs(product: Product, width: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, of a symmetric positive operator, and their unit vectors by columns."""
    count = min(count, width)
    none = np.zeros((width, 0))
    locked, values = none, []
    start = np.random.default_rng(20240229)
    space = _fresh(start.standard_normal((width, min(width, BLOCK))), none)
    image = product(space)
    largest = 0.0
    for _ in range(MAX_ROUNDS):
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        largest = max(largest, *values, *theta[:1], 0.0)
        lead = min(BLOCK, len(theta))
        u, image_u = space @ turn[:, :lead], image @ turn[:, :lead]
        residual = image_u - u * theta[:lead]
        residual -= locked @ (locked.T @ residual)
        done = np.linalg.norm(residual, axis=0) <= ROUNDING * _EPS * np.sqrt(width) * largest
        ready = int(np.argmin(np.append(done, False)))
        if ready:
            taken = min(ready, count - len(values))
            locked, values = np.hstack([locked, u[:, :taken]]), values + theta[:taken].tolist()
            if len(values) == count:
                order = np.argsort(-np.array(values), kind="stable")
                return np.array(values)[order], locked[:, order]
            space, image = space @ turn[:, taken:], image @ turn[:, taken:]
            continue
        if space.shape[1] + lead > SPACE:
            keep = min(2 * BLOCK, space.shape[1])
            space, image = space @ turn[:, :keep], image @ turn[:, :keep]

        def project(a: np.ndarray) -> np.ndarray:
            a = a - locked @ (locked.T @ a)
            return a - u[:, open_] * np.einsum("ij,ij->j", u[:, open_], a)

        open_ = np.flatnonzero(~done)
        t = minres(product, theta[open_], project, -project(residual[:, open_]), INNER)
        new = _fresh(t, locked, space)
        if not new.shape[1]:
            # Nothing is left to add: what remains is rounding in the images.
            space = _fresh(space, locked)
            image = product(space)
            continue
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    raise RuntimeError(f"no convergence to double precision within {MAX_ROUNDS} rounds")


@dataclass(frozen=True)
class Whitening:
    """Exact sums of the fit list, falling eigenvalues, unit components by columns, and the trace."""

    sums: Sums
    values: np.ndarray
    components: np.ndarray
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.sums.centred(x) @ self.components / np.sqrt(self.values)


def fit_components(fit: DataFrame, width: int, count: int) -> Whitening:
    """``fit``: distinct x, all of ``width`` entries; read once per product."""
    sums = _sums(fit, width)
    if not sums.n or not width:
        return Whitening(sums, np.zeros(0), np.zeros((width, 0)), 0.0)
    trace = _added(fit, lambda c: np.array([[np.einsum("ij,ij->", c, c)]]), sums, (1, 1))[0, 0] / sums.n
    if trace <= 0:
        return Whitening(sums, np.zeros(0), np.zeros((width, 0)), 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        return _added(fit, lambda c: c.T @ (c @ block), sums, block.shape) / sums.n

    values, components = leading_pairs(product, width, count)
    real = values > width * _EPS * values[0] * 16
    components = components * np.where(components[np.abs(components).argmax(0), range(len(values))] < 0, -1.0, 1.0)
    return Whitening(sums, values[real], components[:, real], float(trace))


def identity_error(fit: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity), from the values themselves."""
    k = len(w.values)

    def partial(c: np.ndarray) -> np.ndarray:
        z = c @ w.components / np.sqrt(w.values)
        return np.vstack([z.T @ z, z.sum(0)])

    found = _added(fit, partial, w.sums, (k + 1, k)) / w.sums.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def whiten(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, count: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row of ``rows`` (vec_id, vector)."""
    x = whole_vectors(rows.select("vec_id", vector), vector, scale).select("vec_id", "x")
    fit = stored(x.select("x").distinct())
    first = fit.select(F.size("x")).first()
    width = first[0] if first else 0
    w = fit_components(fit, width, count)
    k = len(w.values)
    error = identity_error(fit, w) if k else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches if k else ():
            own = matrix(b["x"], width)
            n = len(own)
            again = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [
                    b["vec_id"].take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, w.sums.n, np.int64)), pa.array(w.sums.deviations(own), pa.int64()).take(again),
                    pa.array(w.whitened(own).reshape(-1)), pa.array(np.tile(w.values / w.trace, n)), pa.array(np.full(n * k, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(
        run,
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double",
    )
