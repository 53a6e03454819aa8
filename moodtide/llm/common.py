"""Shared helpers: tables in the cluster's shared folder, Arrow word splitting, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.session import checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())

# Byte tables: both lower-case A-Z; the second also turns all ASCII but digits and letters into blanks.
BLANK_WORDS = _ASCII_LOWER
ALNUM_WORDS = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in _ASCII_LOWER
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts lineage, outlives executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def pieces(
    batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``max_bytes`` of ``column``; a longer text stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(size, dtype=np.int64) // max_bytes
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))
        del batch
        pa.default_memory_pool().release_unused()
    _trim()


def _trim() -> None:
    """Workers are reused by later stages: give back what this one took, where the C library can."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words:
    """Words of a column of texts: ``codes`` into ``dictionary``; text i owns starts[i]:starts[i+1]."""

    def __init__(self, texts: pa.Array, byte_table: bytes):
        col = pa.concat_arrays([pc.fill_null(texts.cast(pa.string()), "").cast(pa.binary())])
        _, offsets, data = col.buffers()
        raw = data.to_pybytes().translate(byte_table) if data is not None else b""
        lowered = pa.StringArray.from_buffers(len(col), offsets, pa.py_buffer(raw))
        lists = pc.ascii_split_whitespace(lowered)
        words = lists.values
        keep = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
        encoded = words.filter(pa.array(keep)).cast(pa.binary()).dictionary_encode()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False)
        self.dictionary: list[bytes] = encoded.dictionary.to_pylist()
        before = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        self.starts = before[lists.offsets.to_numpy()]
        self.counts = np.diff(self.starts)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


def connected_components(edges: DataFrame, name: str, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges(src, dst)``; nodes of one component share their root.

    Each round every node moves to the neighbour with the smallest hash of that round, edges are
    rewritten and those inside a node go. The number of nodes falls by a constant factor a round, so
    long chains take logarithmically many rounds. Edges and labels are written to the shared folder
    in each round; minima are combined before the shuffle, so a hub is no hot group. Null ends and
    self-loops are ignored.
    """
    src, dst = F.col("src"), F.col("dst")
    edges = written(
        edges.filter(src.isNotNull() & dst.isNotNull() & (src != dst)).select("src", "dst").distinct(),
        f"{name}-edges",
    )
    labels = written(
        edges.select(src.alias("node")).union(edges.select(dst)).distinct().withColumn("root", F.col("node")),
        f"{name}-labels",
    )
    for n in range(max_rounds):
        if edges.isEmpty():
            return labels

        def key(c: Column, n: int = n) -> Column:
            return F.struct(F.xxhash64(F.lit(n), c).alias("h"), c.alias("v"))

        both = edges.union(edges.select("dst", "src"))
        moves = written(
            both.groupBy("src")
            .agg(F.min(key(dst)).alias("to"))
            .select(
                src.alias("node"),
                F.least(F.col("to"), key(src))["v"].alias("to"),
            ),
            f"{name}-moves",
        )
        labels = written(
            labels.join(moves.withColumnRenamed("node", "root"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            ),
            f"{name}-labels",
        )
        a, b = moves.toDF("src", "a"), moves.toDF("dst", "b")
        moved = edges.join(a, "src").join(b, "dst").filter("a <> b")
        edges = written(
            moved.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct(),
            f"{name}-edges",
        )
    raise RuntimeError("components did not settle")
