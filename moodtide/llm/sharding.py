"""Sharding along a Hilbert curve over quantised metadata: runs of equal row counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType
from pyspark.sql.window import Window

from moodtide.llm.common import written

BITS = 5


def hilbert_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Index along the curve of points (rows) with coordinates below 2**bits."""
    x = coordinates.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations of the curve, from the largest cell down
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


@F.pandas_udf(LongType())
def _curve(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    points = np.stack([s.to_numpy() for s in (a, b, c, d)], axis=1)
    return pd.Series(hilbert_index(points, BITS))


def _starts(docs: DataFrame, column: str) -> list:
    """Least values of up to 2**BITS runs of distinct values, in their order; one row a run reaches the driver."""
    values = docs.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct()
    runs = values.repartitionByRange(1 << BITS, "v").groupBy(F.spark_partition_id().alias("run")).agg(F.min("v").alias("v"))
    return sorted(r["v"] for r in runs.collect())


def _category(c: Column, starts: list) -> Column:
    """Cell of the run that a value lies in, runs being spread over all cells; null lies in the first."""
    first = F.lit(0).cast("long")
    out = None
    for i in range(len(starts) - 1, 0, -1):
        at = F.lit(i * (1 << BITS) // len(starts)).cast("long")
        out = F.when(c >= F.lit(starts[i]), at) if out is None else out.when(c >= F.lit(starts[i]), at)
    return first if out is None else out.otherwise(first)


def _scale(c: Column, low, high) -> Column:
    """Linear cell of a number between the bounds of the table; null lies in the first cell."""
    if low is None or high == low:
        return F.lit(0).cast("long")
    cells = 1 << BITS
    cell = F.floor((c - low).cast("double") * cells / float(high - low + 1))
    return F.coalesce(F.greatest(F.lit(0), F.least(cell, F.lit(cells - 1))), F.lit(0)).cast("long")


def plan(
    docs: DataFrame,
    shards: int = 40,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    whole_rows: bool = False,
) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot): rows in the order of the curve, cut into equal runs.

    ``whole_rows`` adds ``row``, a struct of all columns of ``docs``.

    Dimensions: language and source (distinct values in their order, cut into runs, so that bounds per
    shard are narrow), size (half powers of two) and id (linear between the smallest and largest;
    ids that are no whole numbers are cut like sources). Rows of one cell go by id, checksum and size, so a hot source or a
    repeated text spreads over tasks and shards, and counts of shards differ by one at most. Sorted
    rows, without texts, are written to the shared folder; ranks come from counts per partition.

    Null texts have size 16 and the checksum of no bytes; null ids, languages and sources lie in
    the first cell; rows that repeat get a slot each; no rows, no shards.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_rows else []),
    )
    row = ["row"] if whole_rows else []
    if isinstance(docs.schema[doc_id].dataType, IntegralType):
        low, high = docs.agg(F.min(doc_id), F.max(doc_id)).first()
        id_cell = _scale(F.col("doc_id"), low, high)
    else:
        id_cell = _category(F.col("doc_id"), _starts(docs, doc_id))
    lang_cell = _category(F.col("lang"), _starts(docs, lang))
    source_cell = _category(F.col("source"), _starts(docs, source))
    half_powers = F.least(F.lit((1 << BITS) - 1), F.floor(2 * F.log2("size"))).cast("long")
    placed = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        _curve(lang_cell, source_cell, half_powers, id_cell).alias("curve"),
        *row,
    )
    order = ["curve", "doc_id", "text_crc32", "size"]
    dealt = written(
        placed.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "curve-order"
    )
    counts = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}  # one row a partition
    total, before, offset = sum(counts.values()), 0, []
    for part in sorted(counts):
        offset.append((part, before))
        before += counts[part]
    offsets = docs.sparkSession.createDataFrame(offset, "part int, before long")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    ranked = dealt.withColumn("rank", rank).join(F.broadcast(offsets), "part")
    place = F.col("rank") + F.col("before")
    shard = F.expr(f"cast((rank + before) * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard)
        .withColumn("slot", place - first)
        .select("doc_id", "size", "text_crc32", "curve", "shard", "slot", *row)
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, **columns: str) -> None:
    """All rows of ``docs`` as one folder per shard, ``shard=0`` on, in the order of ``plan``.

    Rows travel with their place, so repeated ids and rows stay as they are; ``columns`` are those of
    ``plan``. A column of ``docs`` may be called ``shard``: the files hold it, the folders' names are apart.
    """
    placed = plan(docs, shards, whole_rows=True, **columns)
    sorted_rows = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    names = {c.lower() for c in docs.columns}
    folder = "shard" if "shard" not in names else next(f"shard_{i}" for i in range(len(names) + 1) if f"shard_{i}" not in names)
    own = [F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    sorted_rows.select(*own, F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)


def shard_bounds(docs: DataFrame, placed: DataFrame, columns: list[str], doc_id: str = "doc_id") -> DataFrame:
    """Smallest and largest value of ``columns`` per shard, by which readers leave out whole shards."""
    joined = docs.select(doc_id, *[c for c in columns if c != doc_id]).join(
        placed.select(F.col("doc_id").alias(doc_id), "shard"), doc_id
    )
    aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return joined.groupBy("shard").agg(*aggs)
