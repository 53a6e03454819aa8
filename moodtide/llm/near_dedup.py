"""Near-duplicates by bottom-k sketches of word shingles, confirmed on full sets.

One hash function gives every text its set of shingle hashes; the ``K`` smallest are its sketch.
Inverted lists of the retained values yield candidates, the sketch of the union estimates their
similarity, and exact intersections of the full sets decide.

Texts with equal sets are one vertex from the start. A text enters only the lists of its rarest
values: a pair that passes the estimate shares at least ``SHARE`` of a sketch, hence one of those
(prefix filter), so passages that many texts hold open long lists only for texts made of them. In a
list, members are first compared with one leader; what this links needs no further comparison. Texts
of lists that still hold several components then meet by the rarest quarter of their full sets, and every
such pair of two components is compared: no link between components is missed, while a group of
thousands of copies, or a passage in thousands of texts, costs comparisons in proportion to its size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import BLANK_WORDS, Words, connected_components, pieces, written

K = 32
# Least estimate of a pair whose sets are compared. At a true similarity of 0.75 the estimate from 32
# values falls below with a chance of about four in a million.
SHARE = 0.375


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): the sorted distinct shingle hashes of each text, as signed 64-bit numbers."""
    words = Words(texts, BLANK_WORDS)
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary), np.uint64, len(words.dictionary))
    h = names[words.codes] if len(names) else np.zeros(0, np.uint64)
    counts, owner = words.counts, words.owners()
    at = np.arange(len(h)) - words.starts[owner]
    length = np.minimum(counts, size)[owner]
    first = np.flatnonzero(at + length <= counts[owner])
    length, owner = length[first], owner[first]
    x = length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(size):
        more = length > j
        y = (x[more] ^ h[first[more] + j]) * np.uint64(0xD6E8FEB86659FD93)
        y ^= y >> np.uint64(32)
        y *= np.uint64(0xD6E8FEB86659FD93)
        x[more] = y ^ (y >> np.uint64(29))
    x = x.view(np.int64)
    starts = np.searchsorted(owner, np.arange(len(counts) + 1))
    for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False):
        x[a:b].sort()
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
    before = np.concatenate([[0], np.cumsum(new)])
    return x[new], before[starts]


def _lists(values: np.ndarray, starts: np.ndarray, most: int | None = None) -> pa.Array:
    if most is not None:
        at = np.arange(len(values)) - np.repeat(starts[:-1], np.diff(starts))
        values = values[at < most]
        starts = np.concatenate([[0], np.cumsum(np.minimum(np.diff(starts), most))])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int64()))


def sketches(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, set_id, sketch); set_id is a 128-bit digest of the set, null for an empty one."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def sketch(batches):
        for batch in pieces(batches, text):
            values, starts = shingles(batch.column(text), size)
            digests = [
                xxhash.xxh3_128_digest(values[a:b].tobytes()) if b > a else None
                for a, b in zip(starts, starts[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(doc_id),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(values, starts, K),
                ],
                names=["doc_id", "n", "set_id", "sketch"],
            )

    return docs.select(doc_id, text).mapInArrow(sketch, f"doc_id {kind}, n long, set_id binary, sketch array<long>")


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(id, c, set) of documents (id, c, text)."""

    def build(batches):
        for batch in pieces(batches, "text"):
            values, starts = shingles(batch.column("text"), size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), _lists(values, starts)], names=["id", "set"]
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(build, f"id {kind}, set array<long>")


def posting_lists(holders: DataFrame, values: str, share: float) -> DataFrame:
    """(v, id, n): each of ``holders(id, c, n, values)`` in the lists of its rarest values that others hold too.

    Two holders with ``share`` of their values in common meet in a list (prefix filter).
    """
    entries = holders.select("id", "c", "n", F.size(values).alias("m"), F.explode(values).alias("v"))
    # written, so that the join deals both sides anew and Spark can split the rows of a hot value
    shared = written(entries.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1"), "shared")
    per_holder = (
        entries.join(shared, "v")
        .groupBy("id", "c", "n", "m")
        .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"))  # those of one text
    )
    # the prefix counts values nobody shares first; they open no list
    slots = F.col("m") - F.greatest(F.lit(1), F.ceil(F.col("m") * share)).cast("int") + 1
    slots = slots - (F.col("m") - F.size("values"))
    return (
        per_holder.withColumn("slots", slots)
        .filter("slots > 0")
        .select("id", "n", F.explode(F.slice("values", F.lit(1), F.col("slots"))).alias("s"))
        .select(F.col("s.v").alias("v"), "id", "n")
    )


def _rooted(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """``lists`` with the root of each member and the commonest of the list, where there are several."""
    named = roots.withColumnRenamed("node", "id")
    placed = lists.join(named, "id", "left").withColumn("root", F.coalesce("root", "id"))
    main = (
        placed.groupBy("v", "root")
        .agg(F.count("*").alias("k"))
        .groupBy("v")
        .agg(F.max(F.struct("k", "root")).alias("main"), F.count("*").alias("roots"))
        .filter("roots > 1")
        .select("v", F.col("main.root").alias("main"))
    )
    return placed.join(written(main, "main-roots"), "v")


def _similar_sizes(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def confirmed(pairs: DataFrame, vertices: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough, after the estimate from their sketches."""

    def side(df: DataFrame, as_: str, *columns: str) -> DataFrame:
        return df.select(F.col("id").alias(as_), *(F.col(c).alias(f"{c}_{as_}") for c in columns))

    def within(array: str) -> Column:
        return F.filter(array, lambda x: x <= F.col("top"))

    known = pairs.join(side(vertices, "a", "sketch"), "a").join(side(vertices, "b", "sketch"), "b")
    largest = F.lit((1 << 63) - 1)
    end = [F.when(F.size(f"sketch_{x}") < K, largest).otherwise(F.element_at(f"sketch_{x}", -1)) for x in "ab"]
    known = known.withColumn("top", F.least(*end))
    known = known.select(
        "a",
        "b",
        F.size(F.filter(F.array_intersect("sketch_a", "sketch_b"), lambda x: x <= F.col("top"))).alias("both"),
        F.size(within("sketch_a")).alias("p"),
        F.size(within("sketch_b")).alias("q"),
    )
    likely = known.filter(F.col("both") >= SHARE * (F.col("p") + F.col("q") - F.col("both"))).select("a", "b")
    likely = written(likely.distinct(), f"{name}-likely")
    full = likely.join(side(sets, "a", "set"), "a").join(side(sets, "b", "set"), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    counted = full.select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b") - both).alias("either"))
    return counted.filter(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")


def _joins(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between two blocks (id, root, set) that join roots, one for each two roots that they join."""
    found, parent = [], {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    if len(left) and len(right):
        size = right["set"].map(len).to_numpy()
        values, owner = np.concatenate(right["set"].to_numpy()), np.repeat(np.arange(len(right)), size)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        ids, roots = right["id"].tolist(), right["root"].tolist()
        for a, root, own in zip(left["id"].tolist(), left["root"].tolist(), left["set"], strict=True):
            first, last = np.searchsorted(values, own), np.searchsorted(values, own, side="right")
            held = last - first
            at = np.repeat(first - (np.cumsum(held) - held), held) + np.arange(held.sum())
            both = np.bincount(owner[at], minlength=len(right))
            for j in np.flatnonzero(both * 100 >= (len(own) + size - both) * percent).tolist():
                x, y = find(root), find(roots[j])
                if x != y:
                    parent[x] = y
                    found.append((a, ids[j]))
    return pd.DataFrame(found, columns=["a", "b"]) if found else pd.DataFrame({"a": [], "b": []})


# Shingles in a block of the texts that are compared with a component, and of those compared with them.
LEFT_BLOCK, RIGHT_BLOCK = 100_000, 400_000


def across_roots(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the roots of each list of ``mixed``.

    Texts outside a list's commonest root are compared with those inside and with one another, block
    against block; pairs are not written out. Lists of one commonest root are taken together, so that
    texts that meet in many lists are compared once.
    """
    members = mixed.select("main", "id", "root", "n").distinct()
    outside = F.col("root") != F.col("main")
    blocks = members.groupBy("main").agg(
        F.ceil(F.sum(F.when(outside, F.col("n")).otherwise(0)) / LEFT_BLOCK).cast("int").alias("lefts"),
        F.ceil(F.sum("n") / RIGHT_BLOCK).cast("int").alias("rights"),
    )
    placed = members.join(blocks, "main").join(sets, "id")
    count = F.greatest(F.lit(1), F.col("lefts"))
    own = F.xxhash64("id")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    left = placed.filter(outside).select(
        "main", "id", "root", "set", F.pmod(own, count).cast("int").alias("i"), every(F.col("rights")).alias("j")
    )
    again = [F.col(c).alias(c) for c in ("main", "id", "root", "set")]  # new attributes, as for a self-join
    right = placed.select(
        *again, every(count).alias("i"), F.pmod(own, F.col("rights")).cast("int").alias("j")
    )
    keys = ["main", "i", "j"]
    kind = sets.schema["id"].dataType.simpleString()

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        return _joins(a, b, percent)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, f"a {kind}, b {kind}")


def components(docs: DataFrame, size: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Texts are linked whose sets of ``size``-word shingles have ``percent`` per cent or more of their
    union in common; component_id is the smallest id that links reach. Fewer words than ``size`` are
    one shingle.

    Null and empty texts have an empty set and are linked with nothing; rows of one id are one vertex,
    whatever their texts; a row without id is linked with nothing, has no component and is kept.
    """
    own = written(sketches(docs, size, doc_id, text), "sketches")
    usable = own.filter("doc_id IS NOT NULL AND set_id IS NOT NULL")
    vertices = written(
        usable.groupBy("set_id")
        .agg(F.min(F.struct("doc_id", "n", "sketch")).alias("s"))
        .select(
            "set_id", F.col("s.doc_id").alias("id"), F.xxhash64("set_id").alias("c"), F.col("s.n").alias("n"), F.col("s.sketch").alias("sketch")
        ),
        "vertices",
    )
    lists = written(posting_lists(vertices, "sketch", SHARE), "lists")
    chosen = lists.select("id").distinct()
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen, "id", "left_semi")
    sets = written(full_sets(texts, size), "sets")

    # links between an id's own texts, where ids repeat
    spare = usable.join(vertices.select("set_id", "id"), "set_id").filter("id <> doc_id")
    repeated = spare.join(vertices.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    links = written(repeated.select(F.col("id").alias("a"), F.col("doc_id").alias("b")).distinct(), "links")

    leaders = written(lists.groupBy("v").agg(F.min(F.struct("id", "n")).alias("leader")), "leaders")
    star = (
        lists.join(leaders, "v")
        .filter((F.col("id") != F.col("leader.id")) & _similar_sizes(F.col("n"), F.col("leader.n"), percent))
        .select(F.col("leader.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    links = written(links.union(confirmed(star, vertices, sets, percent, "star")), "links")
    roots = connected_components(links.toDF("src", "dst"), "near-star")

    # Texts that still share a list across components, which a passage in many texts brings about, meet
    # again by their full sets, where the prefix is exact and such a passage opens no list.
    left = _rooted(lists, roots).select("id").distinct()
    unsettled = sets.join(left, "id", "left_semi").select(
        "id", F.xxhash64("set").alias("c"), F.size("set").cast("long").alias("n"), "set"
    )
    exact_lists = written(posting_lists(unsettled, "set", percent / 100), "exact-lists")
    mixed = written(_rooted(exact_lists, roots), "mixed")
    more = across_roots(mixed, sets, percent)
    roots = connected_components(links.union(more).toDF("src", "dst"), "near")
    smallest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    named = roots.join(smallest, "root").select(F.col("node").alias("id"), "component_id")
    of_set = vertices.join(named, "id", "left").select("set_id", F.coalesce("component_id", "id").alias("component_id"))
    joined = own.join(of_set, "set_id", "left").withColumn(
        "component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    )
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
