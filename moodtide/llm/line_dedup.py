"""Lines that repeat across documents, found by probing a sharded minimal perfect hash.

Hashes of distinct lines are counted by document. Those found often enough are dealt to shards by their
hash; each shard becomes a minimal perfect hash (bit arrays by level, a rank gives the slot) over arrays of
fingerprints, counts and keepers: about 21 bytes a line. Documents probe these arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import pieces, written

BLANKS = " \t\n\x0b\x0c\r"
_GAMMA, _LEVELS = 2, 32
_INDEX = "shard int, sizes binary, bits binary, rest binary, marks binary, counts binary, keepers binary"


# -- minimal perfect hash ----------------------------------------------------------------


def _place(h: np.ndarray, mark: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each key at a level: both hashes mixed with the level, modulo the level's size."""
    x = h ^ ((mark << np.uint64(1 + level % 31)) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) % np.uint64(size)


class PerfectHash:
    """Slots 0 .. n-1 for n keys, each a pair of 64-bit hashes.

    At each level keys that meet no other key set their bit and are done; the others go on. A key's slot
    is the number of bits before its own. Keys left over after all levels are kept in a list.
    """

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.before = np.zeros(len(bits) + 1, np.int64)
        np.cumsum(np.bitwise_count(bits), out=self.before[1:])
        self.starts = np.cumsum(sizes // 64) - sizes // 64

    @classmethod
    def build(cls, h: np.ndarray, mark: np.ndarray) -> PerfectHash:
        sizes, words = [], []
        while len(h) and len(sizes) < _LEVELS:
            size = -(-_GAMMA * len(h) // 64) * 64
            at = _place(h, mark, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = ~alone[at]
            h, mark = h[left], mark[left]
        none = np.zeros(0, "<u8")
        rest = np.stack([h, mark], axis=1).astype("<u8").reshape(-1)
        return cls(np.array(sizes, "<i8"), np.concatenate([*words, none]), rest)

    def slots(self, h: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Slot of each key; some slot or -1 for a key that is not of the set."""
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for level, (size, start) in enumerate(zip(self.sizes, self.starts, strict=True)):
            at = _place(h[todo], mark[todo], level, size).astype(np.int64)
            word, bit = start + (at >> 6), (at & 63).astype(np.uint64)
            there = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word[there]] & ((np.uint64(1) << bit[there]) - np.uint64(1))
            out[todo[there]] = self.before[word[there]] + np.bitwise_count(below)
            todo = todo[~there]
        for n, (a, b) in enumerate(self.rest.reshape(-1, 2)):
            out[todo[(h[todo] == a) & (mark[todo] == b)]] = self.before[-1] + n
        return out


class Shard:
    """Counts and keepers of the lines of one shard; ``row`` is one of ``_INDEX``."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(
            np.frombuffer(row["sizes"], "<i8"), np.frombuffer(row["bits"], "<u8"), np.frombuffer(row["rest"], "<u8")
        )
        self.marks = np.frombuffer(row["marks"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<u4")
        self.keepers = np.frombuffer(row["keepers"], "<i8")

    @staticmethod
    def row(shard: int, h: np.ndarray, mark: np.ndarray, n: np.ndarray, keeper: np.ndarray) -> dict:
        made = PerfectHash.build(h, mark)
        order = np.empty(len(h), np.int64)
        order[made.slots(h, mark)] = np.arange(len(h))
        counts = np.minimum(n, 2**32 - 1)
        arrays = (made.sizes, made.bits, made.rest, mark[order].astype("<u8"), counts[order].astype("<u4"), keeper[order].astype("<i8"))
        names = ("sizes", "bits", "rest", "marks", "counts", "keepers")
        return {"shard": shard, **{k: a.tobytes() for k, a in zip(names, arrays, strict=True)}}

    def probe(self, h: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, keeper) of each line; a line whose fingerprint differs is not in the index: count 0."""
        slot = self.hash.slots(h, mark)
        found = (slot >= 0) & (self.marks[slot] == mark)
        return np.where(found, self.counts[slot], 0), self.keepers[slot]


# -- lines of documents -------------------------------------------------------------------


class Lines:
    """Lines of a batch of texts, and the two hashes of the keys that are long enough to count."""

    def __init__(self, texts: pa.Array, min_chars: int):
        texts = pa.concat_arrays([pc.fill_null(texts.cast(pa.string()), "")])
        lists = pc.split_pattern(texts, "\n")
        self.lines, self.starts = lists.values, lists.offsets.to_numpy().astype(np.int64)
        keys = pc.ascii_lower(pc.ascii_trim(self.lines, characters=BLANKS))
        self.long = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
        counted = keys.take(pa.array(self.long)).cast(pa.binary()).to_pylist()
        both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, counted)), "<u8").reshape(-1, 2)
        self.h, self.mark = both[:, 0].copy(), both[:, 1].copy()
        self.owner = np.searchsorted(self.starts, self.long, side="right") - 1

    def distinct(self) -> np.ndarray:
        """Places among the counted lines of each document's first of equal keys."""
        order = np.lexsort((self.mark, self.h, self.owner))
        new = np.ones(len(order), bool)
        if len(order):
            same = [x[order][1:] == x[order][:-1] for x in (self.owner, self.h, self.mark)]
            new[1:] = ~(same[0] & same[1] & same[2])
        return order[new]

    def without(self, dropped: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(texts without the counted lines marked in ``dropped``, lines before, lines dropped)."""
        keep = np.ones(len(self.lines), bool)
        keep[self.long[dropped]] = False
        before = np.zeros(len(keep) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        offsets = before[self.starts]
        kept = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), self.lines.filter(pa.array(keep)))
        n = np.diff(self.starts)
        return pc.binary_join(kept, "\n"), n, n - np.diff(offsets)


# -- operator ----------------------------------------------------------------------------


def line_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 20) -> DataFrame:
    """(own, body, h, mark, id): the hashes of each document's distinct long lines.

    ``own`` and ``body`` are hashes of the id and the text, which name the document later on.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    named = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(doc_id).alias("own"), F.xxhash64(text).alias("body")
    )

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            lines = Lines(batch.column("text"), min_chars)
            first = lines.distinct()
            who = pa.array(lines.owner[first])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("own").take(who),
                    batch.column("body").take(who),
                    pa.array(lines.h[first].view(np.int64)),
                    pa.array(lines.mark[first].view(np.int64)),
                    batch.column("id").take(who),
                ],
                names=["own", "body", "h", "mark", "id"],
            )

    return named.mapInArrow(hashes, f"own long, body long, h long, mark long, id {kind}")


def build_index(lines: DataFrame, least: int = 3, shard_keys: int = 1 << 16) -> tuple[DataFrame, int]:
    """(index, number of shards): one row a shard over the lines found in ``least`` documents or more.

    Counts are combined before they are shuffled, so a line of a third of all documents is no hot
    group. The keeper of a line is the hash of the largest id that holds it.
    """
    counted = (
        lines.groupBy("h", "mark")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"))
        .filter(F.col("n") >= least)
        .select("h", "mark", "n", F.xxhash64("id").alias("keeper"))
    )
    counted = written(counted, "line-counts")
    shards = max(1, -(-counted.count() // shard_keys))

    def build(rows: pa.Table) -> pa.Table:
        h, mark, n, keeper, shard = (rows.column(c).to_numpy() for c in ("h", "mark", "n", "keeper", "shard"))
        made = Shard.row(int(shard[0]), h.view(np.uint64), mark.view(np.uint64), n, keeper)
        return pa.table({k: pa.array([v], pa.int32() if k == "shard" else pa.binary()) for k, v in made.items()})

    dealt = counted.withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    return written(dealt.groupBy("shard").applyInArrow(build, _INDEX), "line-index"), shards


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    keep: tuple[str, ...] = (),
    broadcast_bytes: int = 64 << 20,
    rows_per_task: int = 1 << 20,
) -> DataFrame:
    """``doc_id``, ``text`` without repeated lines, ``n_lines`` before and ``n_dropped``, and ``keep``.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of
    ``min_chars`` code points or more that ``min_docs`` documents hold lose all their lines except in the
    document with the largest id. Other lines stay, joined by line feeds.

    An index of up to ``broadcast_bytes`` is sent to all tasks and texts are not moved. Beyond it, the
    hashes of lines go to the shards, hot shards in several parts, and what is to go is joined with the
    documents. A null text is an empty one: one empty line. Each row is a document, also where ids
    or whole rows repeat; rows with the largest id all keep a line; a null id is smaller than any other. An
    empty table gives no rows. Column names of ``docs`` never clash, as only those asked for are read.
    """
    lines = written(line_rows(docs, doc_id, text, min_chars), "line-hashes")
    index, shards = build_index(lines, min_docs)
    size = sum((F.octet_length(c) for c in ("sizes", "bits", "rest", "marks", "counts", "keepers")), F.lit(0))
    total = index.agg(F.sum(size)).first()[0] or 0

    extra = [c for c in dict.fromkeys(keep) if c not in (doc_id, text)]
    own = docs.select(
        F.col(doc_id).alias("_id"),
        F.col(text).alias("_text"),
        F.xxhash64(doc_id).alias("_own"),
        F.xxhash64(text).alias("_body"),
        *(F.col(c).alias(f"_keep{i}") for i, c in enumerate(extra)),
    )
    kinds = {f.name: f.dataType.simpleString() for f in own.schema.fields}
    carried = [f"_keep{i}" for i in range(len(extra))]
    schema = f"_id {kinds['_id']}, _text string, n_lines long, n_dropped long"
    schema += "".join(f", {c} {kinds[c]}" for c in carried)

    def result(batch: pa.RecordBatch, lines: Lines, dropped: np.ndarray) -> pa.RecordBatch:
        texts, n, gone = lines.without(dropped)
        columns = [batch.column("_id"), texts, pa.array(n), pa.array(gone), *map(batch.column, carried)]
        return pa.RecordBatch.from_arrays(columns, names=["_id", "_text", "n_lines", "n_dropped", *carried])

    if total <= broadcast_bytes:
        rows = [r.asDict() for r in index.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loaded = {r["shard"]: Shard(r) for r in shared.value}
            for batch in pieces(batches, "_text"):
                lines = Lines(batch.column("_text"), min_chars)
                me = batch.column("_own").to_numpy()[lines.owner]
                dropped = np.zeros(len(me), bool)
                shard = lines.h.view(np.int64) % shards
                order = np.argsort(shard, kind="stable")
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                for s, found in loaded.items():
                    at = order[bounds[s] : bounds[s + 1]]
                    count, keeper = found.probe(lines.h[at], lines.mark[at])
                    dropped[at] = (count >= min_docs) & (keeper != me[at])
                yield result(batch, lines, dropped)

        out = own.mapInArrow(probe, schema)
    else:
        go = _to_drop(lines, index, shards, min_docs, rows_per_task)
        go = go.groupBy("own", "body").agg(F.collect_set(F.struct("h", "mark")).alias("_go"))  # lines of one text
        go = go.withColumnsRenamed({"own": "_own", "body": "_body"})

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, "_text"):
                lines = Lines(batch.column("_text"), min_chars)
                go = [{(x["h"], x["mark"]) for x in g or ()} for g in batch.column("_go").to_pylist()]
                keys = zip(lines.owner.tolist(), lines.h.view(np.int64).tolist(), lines.mark.view(np.int64).tolist(), strict=True)
                yield result(batch, lines, np.fromiter(((h, m) in go[i] for i, h, m in keys), bool, len(lines.h)))

        # a null text has no line to drop
        out = own.join(go, ["_own", "_body"], "left").mapInArrow(cut, schema)
    return out.select(
        F.col("_id").alias(doc_id),
        F.col("_text").alias(text),
        "n_lines",
        "n_dropped",
        *(F.col(f"_keep{i}").alias(c) for i, c in enumerate(extra)),
    )


def _to_drop(lines: DataFrame, index: DataFrame, shards: int, min_docs: int, rows_per_task: int) -> DataFrame:
    """(own, body, h, mark) of the lines that go, found where their shard is."""
    dealt = lines.drop("id").distinct().withColumn("shard", F.pmod("h", F.lit(shards)).cast("int"))
    parts = dealt.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / rows_per_task).cast("int").alias("parts"))
    # shards of many rows only: at most one for every ``rows_per_task`` lines
    split = F.broadcast(written(parts.filter("parts > 1"), "line-parts"))
    part = F.pmod(F.xxhash64("own", "body"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = dealt.join(split, "shard", "left").withColumn("part", part).drop("parts")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    copies = index.join(split, "shard", "left").select(*index.columns, every)

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("own", "body", "h", "mark")
        if not left.num_rows or not right.num_rows:
            return left.select(names).slice(0, 0)
        h, mark = (left.column(c).to_numpy().view(np.uint64) for c in ("h", "mark"))
        count, keeper = Shard(right.slice(0, 1).to_pylist()[0]).probe(h, mark)
        return left.select(names).filter(pa.array((count >= min_docs) & (keeper != left.column("own").to_numpy())))

    both = dealt.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part"))
    return both.applyInArrow(probe, "own long, body long, h long, mark long")
