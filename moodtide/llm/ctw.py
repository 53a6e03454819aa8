"""Language-model scores: context-tree weighting over binary-decomposed bytes, and word counts.

A node of the tree is a context of the last 0 to ``DEPTH`` bytes; within it every bit of the next byte,
given the bits before it, has a Krichevsky-Trofimov estimate. Bottom-up, each node weighs its own
estimate against the product of its children; top-down, these weights mix the estimates of all depths
into one probability. The tree holds every context of the training texts. It is kept as a table: subtrees
below contexts of two bytes are weighed in tasks, the two levels above, 257 contexts at most, on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import BLANK_WORDS, Words, pieces, written

DEPTH = 4
TOP = 2  # depth from which on subtrees are weighed in tasks
WORD, GRAM, TEXTS, OTHER = 0, 1, 2, 3  # kinds of counts


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, lengths): lower-cased texts, each with DEPTH zeros before and an end symbol, zero."""
    raw = [(t or "").encode().translate(BLANK_WORDS) for t in texts.to_pylist()]
    pad = bytes(DEPTH)
    symbols = np.frombuffer(pad + (b"\0" + pad).join(raw) + b"\0", np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    starts = np.cumsum(lengths + DEPTH) - lengths
    return symbols, starts, lengths


def _contexts(symbols: np.ndarray) -> np.ndarray:
    """Context of every symbol from the DEPTH-th on, the latest byte lowest."""
    x, n = symbols.astype(np.uint64), len(symbols) - DEPTH
    out = np.zeros(n, np.uint64)
    for j in range(DEPTH):
        out = out << np.uint64(8) | x[j : j + n]
    return out


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Context and symbol as one number, for every symbol from the DEPTH-th on."""
    return (_contexts(symbols) << np.uint64(8) | symbols[DEPTH:]).astype(np.int64)


def _real(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which symbols from the DEPTH-th on are not the zeros before a text."""
    real = np.ones(len(symbols) - DEPTH, bool)
    for j in range(DEPTH):
        real[(starts[1:] - 1 - j) - DEPTH] = False
    return real


def _hashes(words: Words) -> np.ndarray:
    names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary), np.uint64, len(words.dictionary))
    return names.view(np.int64)


class _Tally:
    def __init__(self, most: int = 1_500_000):
        self.parts, self.held, self.most = [], 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        """True if what is held should be emitted."""
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > self.most:
            self.parts = [self.sums()]
            self.held = len(self.parts[0][0])
        return self.held > self.most // 2

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in self.parts]), len(keys)).astype(np.int64)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out, self.parts, self.held = self.sums(), [], 0
        return out


def count(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """(kind, key, n): words by hash, byte sequences and number of texts where ``training`` holds, and byte
    sequences of the other texts.

    Words are named by 64-bit hashes. Counts are added up within a task first.
    """

    def tally(batches):
        tallies = {WORD: _Tally(), GRAM: _Tally(), OTHER: _Tally()}
        total = 0

        def rows(kind, keys, n):
            return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(keys), kind, np.int32)), "key": keys, "n": n})

        def counted(texts, kind):
            symbols, starts, _ = _bytes(texts)
            keys, n = np.unique(_grams(symbols)[_real(symbols, starts)], return_counts=True)
            return kind, keys, n

        for batch in pieces(batches, text):
            chosen = batch.column("training")
            learnt, other = (batch.filter(c).column(text) for c in (chosen, pc.invert(chosen)))
            found = []
            if len(learnt):
                words = Words(learnt, BLANK_WORDS)
                found += [(WORD, _hashes(words), np.bincount(words.codes, minlength=len(words.dictionary)))]
                found += [counted(learnt, GRAM)]
            if len(other):
                found += [counted(other, OTHER)]
            total += len(learnt)
            for kind, k, c in found:
                if tallies[kind].add(k, c):
                    yield rows(kind, *tallies[kind].take())
        for kind, t in tallies.items():
            yield rows(kind, *t.take())
        yield rows(TEXTS, np.zeros(1, np.int64), np.array([total], np.int64))

    chosen = docs.select(text, F.coalesce(training, F.lit(False)).alias("training"))
    parts = chosen.mapInArrow(tally, "kind int, key long, n long")
    return written(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability of a zeros and b ones under the Krichevsky-Trofimov estimator."""
    f = _lgamma
    return f(a + 0.5) + f(b + 0.5) - 2 * lgamma(0.5) - f(a + b + 1.0)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of x > 0: Stirling's series after shifting small arguments up by eight."""
    low = x < 8
    shift = np.where(low, x + 8, x)
    s = (shift - 0.5) * np.log(shift) - shift + 0.9189385332046727
    s += 1 / (12 * shift) - 1 / (360 * shift**3) + 1 / (1260 * shift**5)
    below = np.zeros_like(shift)
    for j in range(8):
        below += np.log(np.where(low, x + j, 1.0))
    return s - below


def _bits(counts: np.ndarray) -> np.ndarray:
    """(contexts, 256, 2): zeros and ones at every bit node (1 to 255) of byte counts (contexts, 256)."""
    out = np.zeros((len(counts), 256, 2))
    for level in range(8):
        parts = counts.reshape(len(counts), 1 << level, 2, -1).sum(axis=3)
        out[:, 1 << level : 2 << level] = parts
    return out


@dataclass
class Tree:
    contexts: list[np.ndarray]  # known contexts of each depth, sorted
    log2: np.ndarray  # log2 of the chance of each byte, a row for each context, by depth


def weighted_tree(levels: list[tuple[np.ndarray, np.ndarray]]) -> Tree:
    """Tree from (contexts, byte counts) of each depth, contexts sorted, the empty one at depth 0.

    The undivided form of ``chances``, for tables that fit in memory.
    """
    bits = [_bits(n) for _, n in levels]
    parents = [None] + [
        np.searchsorted(levels[d - 1][0], levels[d][0] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, len(levels))
    ]
    estimate = [_log_kt(b[..., 0], b[..., 1]) for b in bits]
    weighted = [None] * len(levels)
    weighted[-1] = estimate[-1]
    for d in range(len(levels) - 2, -1, -1):
        rest, product = bits[d].copy(), np.zeros_like(estimate[d])
        np.subtract.at(rest, parents[d + 1], bits[d + 1])
        np.add.at(product, parents[d + 1], weighted[d + 1])
        product += _log_kt(rest[..., 0], rest[..., 1])  # contexts too rare for a node share one
        weighted[d] = np.logaddexp(estimate[d], product) - np.log(2)
    table, got, left = [], np.zeros((1, 256)), np.ones((1, 256))
    for d, b in enumerate(bits):
        if d:
            got, left = got[parents[d]], left[parents[d]]
        one = (b[..., 1] + 0.5) / (b.sum(axis=2) + 1)
        table.append(_byte_log2(got + left * one))
        own = np.exp(np.minimum(estimate[d] - np.log(2) - weighted[d], 0)) if d < len(bits) - 1 else np.ones_like(one)
        got, left = got + left * own * one, left * (1 - own)
    return Tree([c for c, _ in levels], np.concatenate(table))


def _byte_log2(one: np.ndarray) -> np.ndarray:
    out = np.zeros((len(one), 256), np.float32)
    byte = np.arange(256)
    for level in range(8):
        node, bit = (1 << level) | (byte >> (8 - level)), (byte >> (7 - level)) & 1
        p = one[:, node]
        out += np.log2(np.where(bit == 1, p, 1 - p))
    return out


@dataclass
class _Level:
    """Bit nodes (context << 8 | node) of one depth that some byte sequence passes, with their weights."""

    names: np.ndarray
    parent: np.ndarray  # of each node of the level below (or bit of a sequence): its row here
    zeros: np.ndarray
    ones: np.ndarray
    estimate: np.ndarray
    weighted: np.ndarray

    def one(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def own(self) -> np.ndarray:
        return np.exp(np.minimum(self.estimate - np.log(2) - self.weighted, 0))


def _subtrees(keys: np.ndarray, n: np.ndarray) -> list[_Level]:
    """Levels DEPTH to TOP, the deepest first, over whole subtrees of byte sequences counted ``n``."""
    j = np.arange(8)
    context, byte = keys[:, None] >> 8, keys[:, None] & 255
    name = (context << 8 | 1 << j | byte >> (8 - j)).reshape(-1)
    bit = (byte >> (7 - j) & 1).reshape(-1)
    zeros, ones = np.repeat(n, 8) * (1.0 - bit), np.repeat(n, 8) * bit.astype(float)
    below, levels = None, []
    for d in range(DEPTH, TOP - 1, -1):
        name = (name >> 8 & ((1 << 8 * d) - 1)) << 8 | name & 255
        names, at = np.unique(name, return_inverse=True)
        zeros, ones = np.bincount(at, zeros, len(names)), np.bincount(at, ones, len(names))
        estimate = _log_kt(zeros, ones)
        weighted = estimate
        if below is not None:
            weighted = np.logaddexp(estimate, np.bincount(at, below, len(names))) - np.log(2)
        levels.append(_Level(names, at, zeros, ones, estimate, weighted))
        name, below = names, weighted
    return levels


def _whole_subtrees(batches, least: int = 1 << 17):
    """(keys, n, m) in groups of whole subtrees, from rows sorted by the subtree."""
    held = []
    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n", "m")])
        if sum(len(k) for k, _, _ in held) < least:
            continue
        keys, n, m = (np.concatenate(x) for x in zip(*held, strict=True))
        tree = keys >> 8 & ((1 << 8 * TOP) - 1)
        cut = int(np.flatnonzero(tree != tree[-1])[-1]) + 1 if (tree != tree[-1]).any() else 0
        if cut:
            yield keys[:cut], n[:cut], m[:cut]
        held = [[keys[cut:], n[cut:], m[cut:]]]
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def chances(counts: DataFrame) -> DataFrame:
    """(key, m, log2): log2 of the chance of every byte sequence that any text has, ``m`` times in all texts.

    A context that no training text has counts as the longest one of its ends that one has.
    """
    learnt = F.when(F.col("kind") == GRAM, F.col("n")).otherwise(F.lit(0))
    subtree = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1))
    grams = counts.filter(F.col("kind").isin(GRAM, OTHER)).groupBy("key").agg(F.sum(learnt).alias("n"), F.sum("n").alias("m"))
    grams = written(grams, "sequences").repartition(subtree).sortWithinPartitions(subtree)

    def up(batches):
        for keys, n, _ in _whole_subtrees(batches):
            top = _subtrees(keys, n)[-1]
            context = keys >> 8 & 255
            yield pa.RecordBatch.from_pydict(
                {
                    "name": pa.array(np.concatenate([top.names & 0xFFFF, context << 8 | keys & 255])),
                    "n": pa.array(np.concatenate([np.zeros(len(top.names), np.int64), n])),
                    "weighted": pa.array(np.concatenate([top.weighted, np.zeros(len(keys))])),
                }
            )

    # one row for each byte before and bit node or byte: 65,536 at most
    sums = grams.mapInArrow(up, "name long, n long, weighted double").groupBy("name")
    sums = sums.agg(F.sum("n").alias("n"), F.sum("weighted").alias("weighted")).toPandas()
    n, product = np.zeros(1 << 16), np.zeros(1 << 16)
    n[sums["name"].to_numpy(np.int64)] = sums["n"].to_numpy()
    product[sums["name"].to_numpy(np.int64)] = sums["weighted"].to_numpy()
    n = n.reshape(256, 256)
    got, left, leaf = np.zeros((1, 256)), np.ones((1, 256)), []
    bits = [_bits(n.sum(axis=0, keepdims=True)), _bits(n)]
    estimate = [_log_kt(b[..., 0], b[..., 1]) for b in bits]
    one_byte = np.logaddexp(estimate[1], product.reshape(256, 256)) - np.log(2)
    weighted = [np.logaddexp(estimate[0], one_byte.sum(axis=0)) - np.log(2), one_byte]
    for b, e, w in zip(bits, estimate, weighted, strict=True):
        one, own = (b[..., 1] + 0.5) / (b.sum(axis=2) + 1), np.exp(np.minimum(e - np.log(2) - w, 0))
        leaf.append(got + left * one)
        got, left = got + left * own * one, left * (1 - own)
    leaf = np.where(n.sum(axis=1, keepdims=True) > 0, leaf[1], leaf[0])
    shared = counts.sparkSession.sparkContext.broadcast((got, left, leaf))

    def down(batches):
        for keys, n, m in _whole_subtrees(batches):
            levels = _subtrees(keys, n)
            context, node = levels[-1].names >> 8 & 255, levels[-1].names & 255
            got, left, p = (x[context, node] for x in shared.value)
            for d, level in zip(range(TOP, DEPTH + 1), reversed(levels), strict=True):
                contexts, at = np.unique(level.names >> 8, return_inverse=True)
                first = level.names & 255 == 1  # every sequence of a context passes its first node
                seen = np.bincount(at[first], (level.zeros + level.ones)[first], len(contexts))[at] > 0
                p = np.where(seen, got + left * level.one(), p)
                if d < DEPTH:
                    got, left = got + left * level.own() * level.one(), left * (1 - level.own())
                got, left, p = got[level.parent], left[level.parent], p[level.parent]
            bit = (keys[:, None] >> (7 - np.arange(8)) & 1).reshape(-1)
            log2 = np.log2(np.where(bit == 1, p, 1 - p)).reshape(-1, 8).sum(axis=1)
            yield pa.RecordBatch.from_pydict({"key": keys, "m": m, "log2": log2})

    return written(grams.mapInArrow(down, "key long, m long, log2 double"), "chances")


class Lookup:
    """Hash table of numbers by whole numbers, from 0 on, in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.slots, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits)
        at, rest = self._first(keys), np.arange(len(keys))
        while len(rest):
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[rest[free]]
            won = self.slots[at] == keys[rest]
            self.values[at[won]] = values[rest[won]]
            at, rest = at[~won] + 1 & len(self.slots) - 1, rest[~won]

    def _first(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, 0 for unknown keys; which keys are known)."""
        at, rest = self._first(keys), np.arange(len(keys))
        out, known = np.zeros(len(keys)), np.zeros(len(keys), bool)
        while len(rest):
            there = self.slots[at]
            hit = there == keys[rest]
            out[rest[hit]], known[rest[hit]] = self.values[at[hit]], True
            more = ~hit & (there >= 0)
            at, rest = at[more] + 1 & len(self.slots) - 1, rest[more]
        return out, known


def _sums(texts: pa.Array, often: Lookup):
    """(log2 chance of the frequent sequences of each text, symbols, (text, key, count) of its other ones)."""
    symbols, starts, lengths = _bytes(texts)
    grams, real = _grams(symbols), _real(symbols, starts)
    p, known = often.get(grams)
    total = np.concatenate([[0.0], np.cumsum(np.where(real, p, 0.0))])
    a = starts - DEPTH
    at = np.flatnonzero(real & ~known)
    owner = np.searchsorted(a, at, side="right") - 1
    order = np.lexsort((grams[at], owner))
    owner, keys = owner[order], grams[at][order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(keys) != 0)])[: len(keys)])
    k = np.diff(np.append(first, len(keys)))
    return total[a + lengths] - total[a], lengths, (owner[first], keys[first], k)


def _band(m: Column) -> Column:
    return F.floor(F.log2(m) * 4)


def _frequent_band(model: DataFrame, most: int) -> int:
    """The least band of counts from which on there are no more than ``most`` rows."""
    sizes = model.groupBy(_band(F.col("m")).alias("band")).count().orderBy(F.desc("band")).collect()
    least = sizes[0]["band"] + 1 if sizes else 0
    for r in sizes:
        most -= r["count"]
        if most < 0:
            break
        least = r["band"]
    return least


def score(
    docs: DataFrame,
    training: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    max_frequent: int = 1 << 16,
    max_sequences: int = 1 << 20,
) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every whole text.

    The model learns from the rows where ``training`` holds. ``score`` is the log10 probability of the
    lower-cased text and its end; bits_per_byte its code length by byte, the end included. The base
    adds log10((c + 1) / (N + V + 1)) over words and one end.

    Words that make up one part in ``max_frequent`` of the training tokens or more, so at most that
    many, are looked up in memory; all others are joined with their counts, of which none is hot. Byte
    sequences likewise: the most frequent, ``max_sequences`` at most, in memory, all others by the join.

    Null and empty texts are the end alone; repeated rows are scored each; without training rows
    counts are 0 and every bit has chance one half; an empty table gives no rows.
    """
    counts = count(docs, F.lit(True) if training is None else training, text)
    model = chances(counts)
    of_words = counts.filter(F.col("kind") == WORD)
    tokens, types = of_words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    texts = counts.filter(F.col("kind") == TEXTS).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, types = tokens + texts, types + (texts > 0)
    head = of_words.filter(F.col("n") * max_frequent >= tokens).orderBy("key").select("key", "n").toPandas()
    head_keys, head_n = head["key"].to_numpy(np.int64), head["n"].to_numpy(np.int64)
    least = _frequent_band(model, max_sequences)
    often = model.filter(_band(F.col("m")) >= least).select("key", "log2").toPandas()
    often = often["key"].to_numpy(np.int64), often["log2"].to_numpy(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast((often, head_keys, head_n))
    kind = docs.schema[doc_id].dataType.simpleString()
    ends = np.log10(texts + 1)

    def read(batches):
        often, keys, n = shared.value
        often = Lookup(*often)
        logs = np.append(np.log10(n + 1), 0.0)
        next_row = TaskContext.get().partitionId() << 33
        for batch in pieces(batches, text):
            log2, length, sequences = _sums(batch.column(text), often)
            words = Words(batch.column(text), BLANK_WORDS)
            h = _hashes(words)
            at = np.searchsorted(keys, h)
            frequent = keys[np.minimum(at, len(keys) - 1)] == h if len(keys) else np.zeros(len(h), bool)
            at = np.where(frequent, at, len(n))
            owner, rows = words.owners(), batch.num_rows
            head_sum = np.bincount(owner, logs[at][words.codes], minlength=rows) + ends
            head_known = np.bincount(owner, frequent[words.codes], minlength=rows).astype(np.int64) + (texts > 0)
            rare = ~frequent[words.codes]
            pair, k = np.unique(owner[rare] * np.int64(len(h) + 1) + words.codes[rare], return_counts=True)
            who, what = pair // (len(h) + 1), pair % (len(h) + 1)
            row = next_row + np.arange(rows)
            next_row += rows
            # a row for each text, which nothing joins, and one for each of its rare words and sequences
            own = pa.StructArray.from_arrays(
                [
                    batch.column(doc_id),
                    pa.array(words.counts + 1, pa.int64()),
                    pa.array(head_known),
                    pa.array(head_sum),
                    pa.array(log2),
                    pa.array(length, pa.int64()),
                ],
                names=["doc_id", "n_tokens", "known", "base", "log2", "symbols"],
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "row": pa.array(row),
                    "kind": pa.array(np.full(rows, TEXTS, np.int32)),
                    "key": pa.array(row),
                    "k": pa.array(np.zeros(rows, np.int32)),
                    "own": own,
                }
            )
            for part, who, key, k in ((WORD, who, h[what], k), (GRAM, *sequences)):
                if len(who):
                    yield pa.RecordBatch.from_pydict(
                        {
                            "row": pa.array(row[who]),
                            "kind": pa.array(np.full(len(who), part, np.int32)),
                            "key": pa.array(key),
                            "k": pa.array(k.astype(np.int32)),
                            "own": pa.nulls(len(who), own.type),
                        }
                    )

    own_type = f"struct<doc_id:{kind},n_tokens:long,known:long,base:double,log2:double,symbols:long>"
    uses = docs.select(doc_id, text).mapInArrow(read, f"row long, kind int, key long, k int, own {own_type}")
    rare = of_words.filter(F.col("n") * max_frequent < tokens).select("kind", "key", "n", F.lit(0.0).alias("log2"))
    rarely = model.filter(_band(F.col("m")) < least).select(F.lit(GRAM).alias("kind"), "key", F.lit(0).cast("long"), "log2")
    joined = uses.join(rare.union(rarely), ["kind", "key"], "left")
    n = F.coalesce("n", F.lit(0))
    per_text = joined.groupBy("row").agg(
        F.max("own").alias("own"),
        F.sum(F.col("k") * F.log10(n + 1)).alias("logs"),
        F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("known"),
        F.coalesce(F.sum(F.col("k") * F.col("log2")), F.lit(0.0)).alias("log2"),
    )
    log2 = F.col("own.log2") + F.col("log2")
    return per_text.select(
        F.col("own.doc_id").alias("doc_id"),
        F.col("own.n_tokens").alias("n_tokens"),
        (F.col("own.known") + F.col("known")).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("own.base") + F.col("logs") - F.col("own.n_tokens") * float(np.log10(tokens + types + 1))).alias("base_score"),
        (log2 * float(np.log10(2))).alias("score"),
        (-log2 / F.col("own.symbols")).alias("bits_per_byte"),
    )
