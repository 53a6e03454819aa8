"""Topics by non-negative matrix factorisation, with the text-by-term matrix kept distributed.

Only arrays of at most (terms x topics) numbers visit the driver: the topic matrix, and sums
over the texts. Text rows stay in Spark; each sweep updates them where they are and adds up what
the topic matrix needs.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.mining import term_weights
from moodtide.session import checkpoint_dir

_OVERSAMPLE = 10
_POWER_SWEEPS = 7


def _flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, term number and value of every cell of a batch of sparse rows."""
    sizes = pdf["idx"].map(len).to_numpy(dtype="int64")
    if not sizes.sum():
        return np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
    terms = np.concatenate([np.asarray(a, "int64") for a in pdf["idx"]])
    values = np.concatenate([np.asarray(a, "float64") for a in pdf["val"]])
    return np.repeat(np.arange(len(pdf)), sizes), terms, values


def _sparse_product(cells: tuple, n_rows: int, right: np.ndarray) -> np.ndarray:
    """Batch times a dense (terms x p) matrix."""
    row, term, value = cells
    cols = [np.bincount(row, value * right[term, j], n_rows) for j in range(right.shape[1])]
    return np.stack(cols, axis=1)


def _transposed_product(cells: tuple, n_terms: int, left: np.ndarray) -> np.ndarray:
    """Transposed batch times a dense (rows x p) matrix."""
    row, term, value = cells
    cols = [np.bincount(term, value * left[row, j], n_terms) for j in range(left.shape[1])]
    return np.stack(cols, axis=1)


# Partial matrices that may reach the driver at once; more are added up in a tree first.
_MAX_PARTIALS = 16

_ROWS_PER_TASK = 20_000

Partial = Callable[[Iterator[pd.DataFrame]], np.ndarray]


def _tree_sum(rows: DataFrame, partial: Partial) -> np.ndarray:
    """Sum of one fixed-size matrix per task. ``partial`` folds the batches of a task into it."""

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield _packed(partial(frames))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = _unpacked_sum(block for pdf in frames for block in zip(pdf["width"], pdf["cells"]))
        if total is not None:
            yield _packed(total)

    n = rows.rdd.getNumPartitions()
    out = rows.mapInPandas(first, "width int, cells binary")
    while n > _MAX_PARTIALS:
        n = max(_MAX_PARTIALS, int(np.ceil(np.sqrt(n))))
        out = out.repartition(n).mapInPandas(merge, "width int, cells binary")
    return _unpacked_sum((r["width"], r["cells"]) for r in out.collect())


def _packed(total: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"width": [total.shape[1]], "cells": [total.astype("<f8").tobytes()]})


def _unpacked_sum(blocks: Iterable[tuple[int, bytes]]) -> np.ndarray | None:
    total = None
    for width, cells in blocks:
        block = np.frombuffer(cells, "<f8").reshape(-1, width)
        total = block.copy() if total is None else total + block
    return total


def _right_vectors(matrix: DataFrame, n_terms: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors and singular values, by block power iteration."""
    p = min(n_terms, k + _OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(n_terms, p)))[0]

    def apply(block: np.ndarray) -> np.ndarray:
        def partial(frames: Iterator[pd.DataFrame]) -> np.ndarray:
            total = np.zeros((n_terms, p))
            for pdf in frames:
                cells = _flat(pdf)
                total += _transposed_product(cells, n_terms, _sparse_product(cells, len(pdf), block))
            return total

        return _tree_sum(matrix, partial)

    for _ in range(_POWER_SWEEPS):
        basis = np.linalg.qr(apply(basis))[0]
    small = basis.T @ apply(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(-values)[:k]
    return basis @ vectors[:, top], np.sqrt(np.maximum(values[top], 0.0))


def _start(
    matrix: DataFrame, n_docs: int, n_terms: int, k: int, seed: int, mean: float
) -> tuple[DataFrame, np.ndarray]:
    """Non-negative double-SVD start, zeros filled with the matrix mean."""
    right, sigma = _right_vectors(matrix, n_terms, k, seed)
    scale = np.where(sigma > 0, 1.0 / np.where(sigma > 0, sigma, 1.0), 0.0)
    project = right * scale

    def squares(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros((2, k))
        for pdf in frames:
            u = _sparse_product(_flat(pdf), len(pdf), project)
            total[0] += (np.maximum(u, 0) ** 2).sum(axis=0)
            total[1] += (np.minimum(u, 0) ** 2).sum(axis=0)
        return total

    norms = np.sqrt(_tree_sum(matrix, squares))
    topics = np.zeros((k, n_terms))
    sign, factor = np.ones(k), np.zeros(k)
    topics[0] = np.sqrt(sigma[0]) * np.abs(right[:, 0])
    for j in range(1, k):
        pos, neg = np.maximum(right[:, j], 0), np.maximum(-right[:, j], 0)
        size_pos, size_neg = norms[0, j] * np.linalg.norm(pos), norms[1, j] * np.linalg.norm(neg)
        sign[j] = 1.0 if size_pos > size_neg else -1.0
        part, size = (pos, size_pos) if sign[j] > 0 else (neg, size_neg)
        side_norm = norms[0 if sign[j] > 0 else 1, j]
        if size > 0:
            strength = np.sqrt(sigma[j] * size)
            topics[j] = strength * part / np.linalg.norm(part)
            factor[j] = strength / side_norm
    topics[topics < 1e-6] = 0.0
    topics[topics == 0] = mean
    first = np.sqrt(sigma[0])

    def weights(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            u = _sparse_product(_flat(pdf), len(pdf), project)
            w = np.maximum(u * sign, 0) * factor
            w[:, 0] = first * np.abs(u[:, 0])
            w[w < 1e-6] = 0.0
            w[w == 0] = mean
            yield pdf.assign(w=list(w))

    return matrix.mapInPandas(weights, _STATE), topics


def _descend(rows: np.ndarray, gram: np.ndarray, target: np.ndarray) -> float:
    """One coordinate-descent sweep over the columns of ``rows``, in place; returns the violation."""
    violation = 0.0
    for t in range(rows.shape[1]):
        grad = rows @ gram[:, t] - target[:, t]
        violation += float(np.abs(np.where(rows[:, t] == 0, np.minimum(grad, 0), grad)).sum())
        if gram[t, t] != 0:
            rows[:, t] = np.maximum(rows[:, t] - grad / gram[t, t], 0)
    return violation


def factorise(
    matrix: DataFrame,
    n_docs: int,
    n_terms: int,
    k: int,
    *,
    seed: int = 42,
    max_iter: int = 400,
    tol: float = 1e-4,
    sweeps_per_table: int = 10,
) -> np.ndarray:
    """Topic matrix (k x terms) of ``matrix`` (rows ``idx array<int>, val array<double>``).

    Coordinate descent. Given the topics, every text row is updated on its own; the topics then
    need only W'W and V'W, which Spark adds up. Row weights are written to a table in the shared
    checkpoint folder every few sweeps; the sweeps in between replay the few small topic
    matrices since then, so no lineage builds up and a lost executor costs one table read.
    """
    spark = matrix.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/topics-{uuid.uuid4().hex}"
    total = matrix.agg(F.sum(F.aggregate("val", F.lit(0.0), lambda a, x: a + x))).first()[0] or 0.0
    start, topics = _start(matrix, n_docs, n_terms, k, seed, float(total) / (n_docs * n_terms))
    state = _written(start, f"{folder}/0")
    since: list[np.ndarray] = []
    first_violation = None

    for sweep in range(1, max_iter + 1):
        since.append(topics)
        sums = _tree_sum(state, _sweep_sums(since, n_terms, k))
        gram, target, violation = sums[n_terms : n_terms + k], sums[:n_terms], sums[n_terms + k, 0]
        columns = topics.T.copy()
        violation += _descend(columns, gram, target)
        topics = columns.T.copy()
        if first_violation is None:
            first_violation = violation
        if first_violation == 0 or violation / first_violation <= tol:
            break
        if len(since) == sweeps_per_table:
            state = _written(state.mapInPandas(_replayed(since, k), _STATE), f"{folder}/{sweep}")
            since = []
    else:
        warnings.warn(
            f"topics did not settle in {max_iter} sweeps: violation {violation:g}, at first {first_violation:g}",
            stacklevel=2,
        )
    return topics


_STATE = "idx array<int>, val array<double>, w array<double>"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(_STATE).parquet(path)


def _replay(pdf: pd.DataFrame, since: Sequence[np.ndarray], k: int) -> tuple[tuple, np.ndarray, float]:
    """Row weights of a batch after the sweeps in ``since``, and the violation of the last one."""
    cells = _flat(pdf)
    w = np.array(pdf["w"].tolist(), dtype=float).reshape(len(pdf), k)
    violation = 0.0
    for h in since:
        violation = _descend(w, h @ h.T, _sparse_product(cells, len(pdf), h.T))
    return cells, w, violation


def _replayed(since: Sequence[np.ndarray], k: int):
    since = list(since)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            _, w, _ = _replay(pdf, since, k)
            yield pdf.assign(w=list(w))

    return rows


def _sweep_sums(since: Sequence[np.ndarray], n_terms: int, k: int) -> Partial:
    """Partial V'W (one row per term), then W'W (k rows), then the violation."""
    since = list(since)

    def sums(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        out = np.zeros((n_terms + k + 1, k))
        for pdf in frames:
            cells, w, violation = _replay(pdf, since, k)
            out[:n_terms] += _transposed_product(cells, n_terms, w)
            out[n_terms : n_terms + k] += w.T @ w
            out[n_terms + k, 0] += violation
        return out

    return sums


def text_term_rows(weights: DataFrame, corpus: DataFrame, id_col: str) -> tuple[DataFrame, list[str]]:
    """One sparse row per text (terms in alphabetical order) and the list of terms.

    The terms are at most the vocabulary limit of ``term_weights``.
    """
    terms = [r[0] for r in weights.select("term").distinct().orderBy("term").collect()]
    spark = weights.sparkSession
    index = spark.createDataFrame(
        [(t, i) for i, t in enumerate(terms)], "term string, i int"
    )
    rows = (
        weights.join(F.broadcast(index), "term")
        .groupBy(id_col)
        .agg(F.array_sort(F.collect_list(F.struct("i", "weight"))).alias("cells"))
    )
    every = corpus.select(id_col).join(rows, id_col, "left")
    empty_i, empty_w = F.array().cast("array<int>"), F.array().cast("array<double>")
    return (
        every.select(
            F.coalesce(F.col("cells.i"), empty_i).alias("idx"),
            F.coalesce(F.col("cells.weight"), empty_w).alias("val"),
        ),
        terms,
    )


def _topics_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), "id int, top_words string")


def nmf_topics(
    corpus: DataFrame,
    n_topics: int = 5,
    n_top_words: int = 8,
    *,
    text_col: str = "review_text",
    id_col: str = "review_id",
    max_terms: int = 2000,
    max_df: float = 0.95,
    seed: int = 42,
    max_iter: int = 400,
    tol: float = 1e-4,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """Topics of a corpus as ``id, top_words``; empty when there are too few texts or terms.

    Iterative, so it runs jobs when called. The corpus is persisted meanwhile.
    """
    spark = corpus.sparkSession
    corpus = corpus.select(id_col, text_col).persist(StorageLevel.MEMORY_AND_DISK)
    matrix = weights = None
    try:
        n_docs = corpus.count()
        k = min(n_topics, n_docs // 2)
        if n_docs < max(8, n_topics * 2) or k < 2:
            return _topics_frame(spark, [])
        weights = term_weights(
            corpus, text_col=text_col, id_col=id_col, max_df=max_df, max_terms=max_terms, stop_words=stop_words
        ).persist(StorageLevel.MEMORY_AND_DISK)
        matrix, terms = text_term_rows(weights, corpus, id_col)
        if len(terms) < k:
            return _topics_frame(spark, [])
        tasks = -(-n_docs // _ROWS_PER_TASK)
        matrix = matrix.repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
        topics = factorise(
            matrix, n_docs, len(terms), k, seed=seed, max_iter=max_iter, tol=tol
        )
        out = []
        for t in range(k):
            best = np.argsort(-topics[t], kind="stable")[:n_top_words]
            out.append((t, ", ".join(terms[j] for j in best if topics[t, j] > 0)))
        return _topics_frame(spark, out)
    finally:
        for df in (matrix, weights, corpus):
            if df is not None:
                df.unpersist()
