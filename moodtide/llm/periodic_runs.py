"""Periodic runs of words, found over a dictionary of basic factors.

Stretches of 2^k words get a number for every k, equal for equal stretches of a text. Where a stretch occurs
again within twice its length, and again after the same gap, that gap is proposed as a period; the proposal is
extended to both sides by jumps of powers of two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import Words, pieces

AS_IS = bytes(range(256))


def basic_factors(names: np.ndarray, owner: np.ndarray) -> Iterator[np.ndarray]:
    """For k = 0, 1, ...: the number of the stretch of 2^k words at each place.

    Equal numbers mean equal stretches of one text. A place whose stretch occurs once in its text, or
    would reach beyond the text, has -1; the sequence ends when no stretch occurs twice. So only places that
    may still matter are sorted again.
    """
    n = len(names)
    _, level = np.unique(owner * (names.max(initial=0) + 1) + names, return_inverse=True)
    size = 1
    while True:
        counts = np.bincount(level[level >= 0], minlength=1)
        level = np.where((level >= 0) & (counts[level] > 1), level, -1)
        if not (level >= 0).any():
            return
        yield level
        both = np.flatnonzero((level[: n - size] >= 0) & (level[size:] >= 0) & (owner[: n - size] == owner[size:])) if size < n else []
        deeper = np.full(n, -1, np.int64)
        if len(both):
            pair = level[both] * (level.max() + 1) + level[both + size]
            deeper[both] = np.unique(pair, return_inverse=True)[1]
        level, size = deeper, 2 * size


def _proposals(level: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): first places of progressions of three equal stretches, gaps up to twice their size."""
    at = np.flatnonzero(level >= 0)
    order = at[np.argsort(level[at], kind="stable")]  # places of one stretch in a row, ascending
    gap = np.zeros(len(level), np.int64)
    same = level[order[1:]] == level[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    near = np.flatnonzero((gap > 0) & (gap <= 2 * size))
    steady = near[gap[near + gap[near]] == gap[near]]
    # neighbours with the same gap belong to the same run
    first = np.ones(len(steady), bool)
    first[1:] = (np.diff(steady) > 1) | (np.diff(gap[steady]) != 0)
    return steady[first], gap[steady[first]]


def _extended(levels: list[np.ndarray], names: np.ndarray, owner: np.ndarray, place: np.ndarray, period: np.ndarray):
    """(start, end) of the longest stretch around ``place`` whose words ``period`` apart are equal."""
    n = len(names)

    def equal(k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        inside = (a >= 0) & (b + (1 << k) <= n)
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        return inside & (levels[k][a] == levels[k][b]) & (levels[k][a] >= 0)

    end, start = place.copy(), place.copy()
    top = len(levels) - 1
    # a long stretch takes several jumps of the largest size, then at most one of each smaller size
    for k in range(top, -1, -1):
        todo = np.arange(len(place))
        while len(todo):
            todo = todo[equal(k, end[todo], end[todo] + period[todo])]
            end[todo] += 1 << k
            if k < top:
                break
        todo = np.arange(len(place))
        while len(todo):
            step = start[todo] - (1 << k)
            todo = todo[equal(k, step, step + period[todo])]
            start[todo] -= 1 << k
            if k < top:
                break
    return start, end + period


def runs_of(names: np.ndarray, owner: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (owner, start, length, period) of all runs, by place in the batch, then period.

    ``names`` are word numbers, ``owner`` the ascending text numbers. A run has ``times`` periods and ``least``
    words at least; ``start`` counts over the whole batch.
    """
    levels, found = [], []
    for k, level in enumerate(basic_factors(names, owner)):
        levels.append(level)
        place, period = _proposals(level, 1 << k)
        found.append(np.stack([place, period], axis=1))
    if not levels:
        return np.zeros((0, 4), np.int64)
    place, period = np.unique(np.concatenate(found), axis=0).T
    start, end = _extended(levels, names, owner, place, period)
    rows = np.stack([start, end - start, period], axis=1)
    rows = rows[rows[:, 1] >= np.maximum(least, times * rows[:, 2])]
    # the same stretch under several periods: the smallest is its period, the others are multiples
    rows = np.unique(rows, axis=0)
    first = np.ones(len(rows), bool)
    first[1:] = (np.diff(rows[:, :2], axis=0) != 0).any(axis=1)
    rows = rows[first]
    return np.concatenate([owner[rows[:, 0]][:, None], rows], axis=1)


def find_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = 6,
    times: int = 4,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``, and ``keep``.

    Words are split at white space. A run is a stretch of words with smallest period q, of ``least``
    words and ``times`` periods at least, that cannot be extended; runs are ordered by start, then period.
    ``collapsed`` is the text with the first q words of every run left of it: a word that some run
    contains after its first q words goes; the others are joined by one blank.

    Null and empty texts have no words, no runs and an empty ``collapsed``; each row is judged by itself,
    so repeated rows and ids repeat results; an empty table gives no rows. Long texts are one unit:
    memory is about a hundred bytes a word of a text.
    """
    extra = [c for c in dict.fromkeys(keep) if c not in (doc_id, text)]
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), *(F.col(c).alias(f"_keep{i}") for i, c in enumerate(extra)))
    carried = [f"_keep{i}" for i in range(len(extra))]
    kinds = {f.name: f.dataType.simpleString() for f in own.schema.fields}
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text"):
            words = Words(batch.column("_text"), AS_IS)
            names, owner = words.codes.astype(np.int64), words.owners()
            runs = runs_of(names, owner, least, times)
            inside = np.zeros(len(names) + 1, np.int64)
            np.add.at(inside, runs[:, 1] + runs[:, 3], 1)
            np.add.at(inside, runs[:, 1] + runs[:, 2], -1)
            stays = np.cumsum(inside[:-1]) == 0
            before = np.zeros(len(names) + 1, np.int32)
            np.cumsum(stays, out=before[1:])
            left = pa.DictionaryArray.from_arrays(pa.array(names[stays]), pa.array(words.dictionary, pa.binary()))
            lists = pa.ListArray.from_arrays(pa.array(before[words.starts]), left.cast(pa.binary()).cast(pa.string()))
            ends = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
            fields = [runs[:, 1] - words.starts[runs[:, 0]], runs[:, 2], runs[:, 3]]
            structs = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], fields=list(run))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    pc.binary_join(lists, " "),
                    *map(batch.column, carried),
                ],
                names=["_id", "n_words", "runs", "collapsed", *carried],
            )

    schema = f"_id {kinds['_id']}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    schema += "".join(f", {c} {kinds[c]}" for c in carried)
    return own.mapInArrow(find, schema).select(
        F.col("_id").alias(doc_id), "n_words", "runs", "collapsed", *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(extra))
    )


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; null without runs.

    Ties go to the smallest start, then period, which is the order of ``runs``.
    """
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")

    def better(best: Column, x: Column) -> Column:
        higher = x["length"] * best["period"] > best["length"] * x["period"]
        return F.when(best.isNull() | higher, x).otherwise(best)

    return F.aggregate(runs, none, better)
