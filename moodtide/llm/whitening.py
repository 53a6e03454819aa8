"""Whitening of embeddings on their distinct vectors.

Components become whole numbers, equal vectors become one row with its count, means are exact sums, the
covariance is a weighted product of centred blocks added up in a tree, and each distinct vector is
projected once and joined back to its rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import written

SCALE = 256
_FAN_IN = 32
_HOT_PARTS = 1000


def usable(vector: Column) -> Column:
    """Not null, every component present, finite, and within a long after scaling."""
    limit = float(2**62 // SCALE)
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < limit))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """floor(256 * c) of each component, as a long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, without copying single values."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _exact(total: int, values: np.ndarray) -> bool:
    """Whether ``total`` such numbers can be added up in a long."""
    return int(np.abs(values).max(initial=0)) * max(total, 1) < 2**62


@dataclass(frozen=True)
class Model:
    """Sums per dimension of the fit list (exact), its size, components as columns, eigenvalues, trace."""

    n: int
    weight: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.weight)) for s in self.sums])


def _summed(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows (i, part, cells) with one row an ``i``: cells are added up in a tree, ``_FAN_IN`` at a time."""

    def add(group: pa.Table) -> pa.Table:
        cells = sum(np.frombuffer(c, "<f8") for c in group.column("cells").to_pylist())
        head = [pa.array([group.column(c)[0].as_py()], pa.int32()) for c in ("i", "part")]
        return pa.table({"i": head[0], "part": head[1], "cells": pa.array([cells.astype("<f8").tobytes()], pa.binary())})

    while True:
        tasks = max(1, -(-tasks // _FAN_IN))
        rows = rows.withColumn("part", F.pmod("part", F.lit(tasks)).cast("int"))
        rows = rows.groupBy("i", "part").applyInArrow(add, "i int, part int, cells binary")
        if tasks == 1:
            return rows


def fit(distinct: DataFrame, dims: int, components: int, by_count: bool) -> Model | None:
    """Means and the first ``components`` eigenvectors of the covariance of ``distinct(x, n)``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight, n = np.zeros(dims, object), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch.column("x")), batch.column("n").to_numpy() if by_count else np.ones(batch.num_rows, np.int64)
            weight, n = weight + int(w.sum()), n + len(x)
            products = x * w[:, None] if _exact(int(w.sum()), x) else x.astype(object) * w.astype(object)[:, None]
            total = total + products.sum(axis=0).astype(object)
        wide = pa.decimal128(38)
        columns = [*total.tolist(), weight, n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 2), pa.int32()), pa.array([int(c) for c in columns], wide)], names=["i", "s"]
        )

    totals = distinct.mapInArrow(sums, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    got = {r["i"]: int(r["s"]) for r in totals.collect()}  # one row a dimension
    weight, n = got.get(dims, 0), got.get(dims + 1, 0)
    if not weight or not dims:
        return None
    whole = Model(n, weight, tuple(got[i] for i in range(dims)), np.zeros((dims, 0)), np.zeros(0), 0.0)
    mean = whole.mean

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                c = _matrix(batch.column("x")) - mean
                w = batch.column("n").to_numpy()[:, None] if by_count else 1
                total += c.T @ (c * w)
        name = TaskContext.get().partitionId()  # the same when a task runs again
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(dims), pa.int32()),
                pa.array([name] * dims, pa.int32()),
                pa.array([row.astype("<f8").tobytes() for row in total], pa.binary()),
            ],
            names=["i", "part", "cells"],
        )

    tasks = distinct.rdd.getNumPartitions()
    rows = _summed(distinct.mapInArrow(products, "i int, part int, cells binary"), tasks).collect()
    covariance = np.stack([np.frombuffer(r["cells"], "<f8") for r in sorted(rows, key=lambda r: r["i"])]) / weight
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    top = np.argsort(-values, kind="stable")[: min(components, dims)]
    vectors = vectors[:, top]
    # a fixed sign: the largest entry of a component is positive
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, range(len(top))] < 0, -1.0, 1.0)
    return Model(n, weight, whole.sums, vectors, values[top], float(np.trace(covariance)))


def whiten(
    vectors: DataFrame,
    components: int = 4,
    weights: str = "one",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per row and component.

    ``weights``: in the fit each distinct vector counts ``"one"`` or its ``"count"`` of rows. ``n`` is the
    number of distinct vectors, ``deviation`` the exact sum of (n * x - S)^2 (with counts, of the rows), null
    where that is no long. ``explained`` is the component's share of the trace, ``identity_error`` the largest
    entry by which the covariance of the whitened vectors differs from the identity.

    Rows whose vector is null, or holds null or non-finite entries or such as give no long after
    scaling, are dropped, and so are vectors of another length than the most common (ties: the shorter).
    Null and repeated ids, and repeated rows, each give their rows. Fewer dimensions give
    fewer components. A component without variance has no direction: its ``whitened`` is null; without any
    variance ``explained`` is null, and ``identity_error`` covers the components that have one. An empty
    table, and vectors of no dimension, give no rows.
    """
    if weights not in ("one", "count"):
        raise ValueError(f"weights are 'one' or 'count', not {weights!r}")
    by_count = weights == "count"
    kind = vectors.schema[vec_id].dataType.simpleString()
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).alias("v")).filter(usable(F.col("v")))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = lengths["d"] if lengths else 0
    x = rows.filter(F.size("v") == dims).select("id", whole_numbers(F.col("v")).alias("x"))
    # 128 bits name a vector: what is joined back is narrow
    names = [F.xxhash64("x").alias("k"), F.xxhash64(F.lit(1), "x").alias("l")]
    # copies are combined before the shuffle, so a vector of a third of all rows is one row a task
    distinct = written(x.groupBy("x").agg(F.count(F.lit(1)).alias("n")).select(*names, "x", "n"), "vectors")
    model = fit(distinct, dims, components, by_count)
    out = f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return vectors.sparkSession.createDataFrame([], out)

    found = model.values > max(model.trace, 0.0) * 1e-13
    scale = np.where(found, 1.0 / np.sqrt(np.where(found, model.values, 1.0)), np.nan)
    count, total = model.weight, np.array(model.sums, object)
    project, mean = model.vectors * scale, model.mean
    small = int(np.abs(total).max(initial=0)) < 2**61

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            w = (x - mean) @ project
            furthest = int(np.abs(x).max()) * count + int(np.abs(total).max())
            if small and furthest**2 * dims < 2**63:
                deviation = ((count * x - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                deviation = [int(d) if d < 2**63 else None for d in ((count * x.astype(object) - total) ** 2).sum(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k"),
                    batch.column("l"),
                    batch.column("n"),
                    pa.array(deviation, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32()), pa.array(w.reshape(-1))),
                ],
                names=["k", "l", "n", "deviation", "w"],
            )

    white = written(distinct.mapInArrow(projected, "k long, l long, n long, deviation long, w array<double>"), "whitened")
    error = _identity_error(white, found, by_count)
    shares = [float(v / model.trace) if model.trace > 0 else None for v in model.values]

    # vectors of a thousandth of all rows or more (a thousand at most) are sent to all tasks, the others joined
    ids = written(x.select("id", *names), "vector-ids")
    hot = F.col("n") * _HOT_PARTS >= F.lit(ids.count())
    common = F.broadcast(white.filter(hot))
    rare = ids.join(F.broadcast(white.filter(hot).select("k", "l")), ["k", "l"], "left_anti")
    cells = ["id", "deviation", "w"]
    joined = ids.join(common, ["k", "l"]).select(*cells).union(rare.join(white.filter(~hot), ["k", "l"]).select(*cells))
    numbered = joined.select("id", "deviation", F.posexplode("w").alias("p", "z"))
    explained = F.get(F.array(*[F.lit(s).cast("double") for s in shares]), F.col("p"))
    return numbered.select(
        F.col("id").alias(vec_id),
        (F.col("p") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.when(~F.isnan("z"), F.col("z")).alias("whitened"),
        explained.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(white: DataFrame, found: np.ndarray, by_count: bool) -> float | None:
    """Largest entry of the whitened covariance minus the identity, over the components with variance.

    Each task centres its vectors before multiplying; the means and products of two tasks are then joined
    by the pairwise formula, in a tree.
    """
    use = np.flatnonzero(found)
    if not len(use):
        return None
    m = len(use)

    def pack(n: float, mean: np.ndarray, products: np.ndarray) -> bytes:
        return np.concatenate([[n], mean, products.reshape(-1)]).astype("<f8").tobytes()

    def join(a: tuple, b: tuple) -> tuple:
        n = a[0] + b[0]
        if not n:
            return a
        gap = b[1] - a[1]
        return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)

    def unpack(cells: bytes) -> tuple:
        flat = np.frombuffer(cells, "<f8")
        return flat[0], flat[1 : m + 1], flat[m + 1 :].reshape(m, m)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (0.0, np.zeros(m), np.zeros((m, m)))
        for batch in batches:
            if batch.num_rows:
                z = _matrix(batch.column("w"))[:, use]
                w = batch.column("n").to_numpy().astype(float) if by_count else np.ones(len(z))
                mean = np.average(z, axis=0, weights=w)
                state = join(state, (w.sum(), mean, (z - mean).T @ ((z - mean) * w[:, None])))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pack(*state)], pa.binary())], names=["part", "cells"])

    def merge(group: pa.Table) -> pa.Table:
        state = (0.0, np.zeros(m), np.zeros((m, m)))
        for cells in group.column("cells").to_pylist():
            state = join(state, unpack(cells))
        return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "cells": pa.array([pack(*state)], pa.binary())})

    tasks = white.rdd.getNumPartitions()
    rows = white.mapInArrow(first, "part int, cells binary")
    while True:
        tasks = math.ceil(tasks / _FAN_IN)
        rows = rows.withColumn("part", F.pmod("part", F.lit(max(tasks, 1))).cast("int"))
        rows = rows.groupBy("part").applyInArrow(merge, "part int, cells binary")
        if tasks <= 1:
            break
    got = rows.collect()
    if not got:
        return None
    n, _, products = unpack(got[0]["cells"])
    return float(np.abs(products / n - np.eye(m)).max())
