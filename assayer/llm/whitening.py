"""Whitening of embeddings by spectrum slicing of their covariance.

Vectors become integers, ``floor(256 c)``. The fit list holds each integer vector once. Its sums, its
covariance (centred on the exact mean before multiplying) and the covariance of its whitened vectors are
partial sums of tasks, which are added up key by key in Spark; the driver receives one matrix.

The leading eigenpairs come from that matrix by **spectrum slicing**: the pivots of an LDL' factorisation
of ``V - s I`` (symmetric pivoting, blocks of one or two) have as many positive eigenvalues as V has
eigenvalues above s. Bisection on these counts isolates each leading eigenvalue in an interval of its own;
Rayleigh quotient iteration, begun by inverse iteration in the middle of the interval, converges cubically;
counts just above and just below the result certify its number. Eigenvalues that agree to rounding cannot
be told apart: their interval holds several, and any orthonormal basis of their space is taken.

Vectors that are null or hold a null or non-finite entry are dropped, also entries whose integer exceeds a
long. Vectors of different lengths are different tables: each length has its own fit list and components.
Null ids and rows that repeat stay; each row comes out once per component. Components without variance
don't exist: one vector, equal vectors, empty vectors and an empty table give no rows, and a table of rank
2 gives two components. ``deviation`` is null where it exceeds a long. Other columns are not read. A task
holds one batch of rows and a matrix of the dimension squared, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.llm.linededup import stored

LONG_MAX = 2**63 - 1


# --- eigenpairs ---------------------------------------------------------------------------------


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``v`` exceed ``shift``: positive pivots of LDL' of ``v - shift I``.

    Bunch and Kaufman's pivoting keeps the factors bounded, so the count belongs to a matrix that
    differs from ``v`` by rounding only. A pivot of exactly 0 counts as not above.
    """
    a = v - shift * np.eye(len(v))
    alpha = (1 + math.sqrt(17)) / 8
    above, at, n = 0, 0, len(a)
    while at < n:
        rest = np.abs(a[at + 1 :, at])
        size, r = 1, at
        if len(rest) and rest.max() > 0:
            r = at + 1 + int(rest.argmax())
            largest = rest.max()
            if abs(a[at, at]) < alpha * largest:
                row = np.abs(a[r, at:])
                row[r - at] = 0
                if abs(a[at, at]) * row.max() >= alpha * largest**2:
                    r = at
                elif abs(a[r, r]) < alpha * row.max():
                    size = 2
            else:
                r = at
        to = at + size - 1
        if r != to:
            a[[to, r]] = a[[r, to]]
            a[:, [to, r]] = a[:, [r, to]]
        if size == 1:
            pivot = a[at, at]
            above += pivot > 0
            if pivot != 0:
                column = a[at + 1 :, at].copy()
                a[at + 1 :, at + 1 :] -= np.outer(column / pivot, column)
        else:
            above += 1  # a block of two has a negative determinant here: one eigenvalue of each sign
            block, columns = a[at : to + 1, at : to + 1], a[to + 1 :, at : to + 1].copy()
            a[to + 1 :, to + 1 :] -= columns @ np.linalg.solve(block, columns.T)
        at += size
    return int(above)


@dataclass(frozen=True)
class Interval:
    """``low`` and ``high`` with ``first - 1`` eigenvalues above ``high`` and ``last`` above ``low``."""

    low: float
    high: float
    first: int
    last: int


def isolate(v: np.ndarray, number: int, low: float, high: float, tolerance: float) -> Interval:
    """An interval that holds eigenvalue ``number`` alone, or with others closer than ``tolerance``."""
    above_high, above_low = 0, len(v)
    while above_low - above_high > 1 and high - low > tolerance:
        middle = (low + high) / 2
        above = eigenvalues_above(v, middle)
        if above >= number:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return Interval(low, high, above_high + 1, above_low)


def _solve(v: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    """``(v - shift I)^-1 right``; an exactly singular matrix is moved by its rounding error."""
    try:
        return np.linalg.solve(v - shift * np.eye(len(v)), right)
    except np.linalg.LinAlgError:
        return np.linalg.solve(v - (shift + 4 * np.finfo(float).eps * scale) * np.eye(len(v)), right)


def _rayleigh(v: np.ndarray, place: Interval, start: np.ndarray, scale: float) -> tuple[float, np.ndarray] | None:
    """The eigenpair of an isolating interval by Rayleigh quotient iteration; None if it left the interval."""
    x, shift, last = start, (place.low + place.high) / 2, False
    for step in range(60):
        x = _solve(v, shift, x, scale)
        x = x / np.linalg.norm(x)
        value = float(x @ v @ x)
        if last:
            break
        residual = float(np.linalg.norm(v @ x - value * x))
        # One more step of a cubic iteration leaves rounding only.
        last = residual <= 8 * len(v) * np.finfo(float).eps * scale
        # An eigenvalue lies within the residual of the quotient; until then the middle stays the shift.
        inside = place.low <= value - residual and value + residual <= place.high
        shift = value if inside or last or step > 20 else shift
    margin = 8 * len(v) * np.finfo(float).eps * scale
    return (value, x) if place.low - margin <= value <= place.high + margin else None


def _basis(v: np.ndarray, place: Interval, scale: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of an interval too narrow to part: inverse iteration with as many vectors."""
    several = place.last - place.first + 1
    x = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(v), several)))[0]
    for _ in range(6):
        x = np.linalg.qr(_solve(v, place.high + (place.high - place.low), x, scale))[0]
    values = np.array([column @ v @ column for column in x.T])
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above 0, falling, and their unit vectors as columns, by spectrum slicing."""
    n = len(v)
    reach = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    low, high = float((np.diag(v) - reach).min(initial=0.0)), float((np.diag(v) + reach).max(initial=0.0))
    scale = max(abs(low), abs(high))
    if not n or scale == 0:
        return np.zeros(0), np.zeros((n, 0))
    tiny = 16 * n * np.finfo(float).eps * scale
    k = min(k, eigenvalues_above(v, tiny))  # what lies below is rounding, not variance
    low, high = low - tiny, high + tiny
    values: list[float] = []
    vectors = np.zeros((n, 0))
    while len(values) < k:
        number = len(values) + 1
        place = isolate(v, number, low, high, tiny)
        found = None
        while place.first == place.last and found is None:
            start = np.random.default_rng(number).standard_normal(n)
            found = _rayleigh(v, place, start - vectors @ (vectors.T @ start), scale)
            if found is None and place.high - place.low <= tiny:
                break
            if found is None:  # a neighbour drew the iteration away: start in the half that holds the eigenvalue
                middle = (place.low + place.high) / 2
                upper = eigenvalues_above(v, middle) >= number
                place = Interval(*((middle, place.high) if upper else (place.low, middle)), number, number)
        if found is not None:
            new_values, new = np.array([found[0]]), found[1][:, None]
        else:
            new_values, new = _basis(v, place, scale, number)
        # Rounding leaves neighbours almost orthogonal; the rest is taken out.
        new = np.linalg.qr(new - vectors @ (vectors.T @ new))[0]
        for at, value in enumerate(new_values):
            certify(v, float(value), len(values) + 1, len(values) - at + len(new_values), tiny)
            values.append(float(value))
        vectors = np.hstack([vectors, new])
    return np.array(values[:k]), vectors[:, :k]


def certify(v: np.ndarray, value: float, first: int, last: int, tolerance: float) -> None:
    """Fail unless ``value`` has a number from ``first`` to ``last``: fewer above it, and as many from it on."""
    above, from_it = eigenvalues_above(v, value + 2 * tolerance), eigenvalues_above(v, value - 2 * tolerance)
    if above >= last or from_it < first:
        raise ArithmeticError(f"{value} is not eigenvalue {first}: {above} above, {from_it} from it on")


# --- partial sums -------------------------------------------------------------------------------


def quantised(vector: Column, scale: int) -> Column:
    """The vector of longs, or null if it is null or holds an entry without a long."""
    wide = vector.cast("array<double>")
    ints = F.transform(wide, lambda c: F.floor(c * F.lit(float(scale))))
    bad = F.exists(wide, lambda c: F.coalesce(F.isnan(c) | (F.abs(c * F.lit(float(scale))) >= F.lit(2.0**63)), F.lit(True)))
    return F.when(~bad, ints)


def _matrix(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: places in the batch and their vectors as one matrix."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    starts = np.concatenate([[0], np.cumsum(sizes)])
    out = {}
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        out[int(size)] = rows, flat[(starts[rows][:, None] + np.arange(size)).ravel()].reshape(len(rows), size)
    return out


def _added(partials: DataFrame, value: str) -> DataFrame:
    """Sums of equal-length lists by ``dim`` and ``line``: first by groups of tasks, then of these."""
    integer = value == "bigint"

    def add(batch: pa.Table) -> pa.Table:
        lists = batch.column("x").combine_chunks()
        rows = lists.flatten().to_numpy().reshape(batch.num_rows, -1)
        if integer:  # exact, and an error rather than a wrap
            total = [int(t) for t in rows.astype(object).sum(axis=0)]
            if any(abs(t) > LONG_MAX for t in total):
                raise OverflowError("a sum of components exceeds a long")
        else:
            total = rows.sum(axis=0).tolist()
        first = {c: batch.column(c)[:1] for c in batch.column_names if c != "x"}
        return pa.table({**first, "x": pa.array([total], pa.list_(pa.int64() if integer else pa.float64()))})

    schema = f"dim int, line int, part int, x array<{value}>"
    some = partials.groupBy("dim", "line", "part").applyInArrow(add, schema)
    return some.groupBy("dim", "line").applyInArrow(add, schema).drop("part")


def _partials(fit: DataFrame, value: str, add) -> DataFrame:
    """One task's ``add(dim, rows) -> matrix`` summed over all its batches, as rows ``dim, line, part, x``."""
    schema = f"dim int, line int, part int, x array<{value}>"
    kind = pa.int64() if value == "bigint" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, (_, rows) in _matrix(batch.column("x")).items():
                part = add(dim, rows)
                sums[dim] = sums[dim] + part if dim in sums else part
        # Tasks are dealt into at most 64 groups.
        group = TaskContext.get().partitionId() % 64
        for dim, total in sums.items():
            yield pa.record_batch({
                "dim": pa.array([dim] * len(total), pa.int32()), "line": pa.array(range(len(total)), pa.int32()),
                "part": pa.array([group] * len(total), pa.int32()), "x": pa.array(total.tolist(), pa.list_(kind)),
            })

    return fit.select("x").mapInArrow(run, schema)


def _collected(sums: DataFrame) -> dict[int, np.ndarray]:
    """By dimension, the lines as one matrix."""
    out: dict[int, dict] = {}
    for row in sums.collect():
        out.setdefault(row["dim"], {})[row["line"]] = row["x"]
    return {dim: np.array([lines[i] for i in sorted(lines)]) for dim, lines in out.items()}


@dataclass(frozen=True)
class Whitening:
    """The fitted components of one dimension."""

    n: int
    sums: np.ndarray
    total: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.sums / float(self.n)

    def apply(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) @ self.vectors) / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sums of squares of ``n x - S``, exact: in longs where they provably fit, else in Python's integers."""
        largest = max((abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))) * self.n
        largest += max((abs(int(s)) for s in self.sums), default=0)
        if largest**2 * max(1, rows.shape[1]) <= LONG_MAX:
            apart = rows * np.int64(self.n) - self.sums
            return (apart * apart).sum(axis=1).tolist()
        apart = rows.astype(object) * self.n - self.sums.astype(object)
        return [d if d <= LONG_MAX else None for d in (apart * apart).sum(axis=1).tolist()]


def fit_whitening(distinct: DataFrame, components: int) -> dict[int, Whitening]:
    """One model per dimension, from rows ``x`` that hold each integer vector once."""

    def counted(dim: int, rows: np.ndarray) -> np.ndarray:
        exact = rows.astype(object).sum(axis=0) if np.abs(rows).max(initial=0) > 2**31 else rows.sum(axis=0)
        if any(abs(int(s)) > LONG_MAX for s in exact):
            raise OverflowError("a sum of components exceeds a long")
        return np.concatenate([[len(rows)], exact.astype(np.int64)]).astype(np.int64)[None, :]

    facts = {d: (int(m[0][0]), m[0][1:]) for d, m in _collected(_added(_partials(distinct, "bigint", counted), "bigint")).items()}
    means = {d: sums / float(n) for d, (n, sums) in facts.items()}

    def products(dim: int, rows: np.ndarray) -> np.ndarray:
        apart = rows - means[dim]
        return apart.T @ apart

    found = _collected(_added(_partials(distinct.filter(F.size("x") > 0), "double", products), "double"))
    models = {}
    for dim, product in found.items():
        n, sums = facts[dim]
        v = product / n
        v = (v + v.T) / 2
        values, vectors = leading_eigenpairs(v, components)
        models[dim] = Whitening(n, sums, float(np.trace(v)), values, vectors)
    return models


def identity_errors(distinct: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """Largest entry of the whitened fit list's covariance minus the identity, measured over all of it."""
    used = {d: m for d, m in models.items() if len(m.values)}
    if not used:
        return {}
    known = distinct.filter(F.size("x").isin(*used))

    def summed(dim: int, rows: np.ndarray) -> np.ndarray:
        return used[dim].apply(rows).sum(axis=0)[None, :]

    means = {d: m[0] / used[d].n for d, m in _collected(_added(_partials(known, "double", summed), "double")).items()}

    def products(dim: int, rows: np.ndarray) -> np.ndarray:
        apart = used[dim].apply(rows) - means[dim]
        return apart.T @ apart

    found = _collected(_added(_partials(known, "double", products), "double"))
    return {d: float(np.abs(m / used[d].n - np.eye(len(m))).max()) for d, m in found.items()}


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: a row per vector and component."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), quantised(F.col(f"`{vector_col}`"), scale).alias("x")).filter(
        "x is not null"
    )
    distinct = stored(rows.select("x").distinct())
    models = fit_whitening(distinct, components)
    errors = identity_errors(distinct, models)
    fields = "array<struct<component: int, n: bigint, deviation: bigint, whitened: double, explained: double, identity_error: double>>"
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(x: pa.Array) -> pa.Array:
        found = {d: part for d, part in _matrix(x).items() if d in errors}
        sizes = np.zeros(len(x), np.int64)
        for dim, (places, _) in found.items():
            sizes[places] = len(models[dim].values)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ints, doubles, fits = np.zeros((3, ends[-1]), np.int64), np.zeros((3, ends[-1])), np.ones(ends[-1], bool)
        for dim, (places, rows) in found.items():
            model = models[dim]
            k = len(model.values)
            at = ends[places][:, None] + np.arange(k)
            deviations = model.deviations(rows)
            ints[0][at], ints[1][at] = np.arange(1, k + 1), model.n
            ints[2][at] = np.array([d or 0 for d in deviations], np.int64)[:, None]
            fits[at] = np.array([d is not None for d in deviations])[:, None]
            doubles[0][at], doubles[1][at], doubles[2][at] = model.apply(rows), model.values / model.total, errors[dim]
        columns = [pa.array(ints[0].astype(np.int32)), pa.array(ints[1]), pa.array(ints[2], mask=~fits), *map(pa.array, doubles)]
        return pa.ListArray.from_arrays(ends.astype(np.int32), pa.StructArray.from_arrays(columns, names=names))

    project.__annotations__ = {"x": pa.Array, "return": pa.Array}
    done = rows.select(F.col("id").alias(id_col), F.explode(F.arrow_udf(project, fields)("x")).alias("_w"))
    return done.select(id_col, "_w.*")
