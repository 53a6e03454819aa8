"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learnt from document labels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import ALNUM_WORDS, Words, pieces, written

_END = 1  # byte that closes a sentence
_TABLE = bytearray(ALNUM_WORDS)
for _c in b".!?":
    _TABLE[_c] = _END
_TABLE = bytes(_TABLE)
_KEEP = bytes(range(256))
SEGMENT = 32  # a sentence of more words is cut into stretches of this many


STEMS = (4, 5, 6)  # bytes of the word stems that are features beside the word itself
WIDTH = 1 + len(STEMS)


class Sentences:
    """Words of some texts with their features, cut into sentences that are counted through the texts."""

    def __init__(self, texts: pa.Array, bits: int):
        marked = [(t or "").encode().translate(_TABLE).replace(b"\x01", b"\x01 ") for t in texts.to_pylist()]
        self.words = words = Words(pa.array(marked, pa.binary()), _KEEP)
        hashed = np.zeros((len(words.dictionary), WIDTH), np.uint64)
        for i, w in enumerate(words.dictionary):
            name = w.rstrip(b"\x01")
            hashed[i] = [xxhash.xxh3_64_intdigest(x) for x in (name, *(b"^" + name[:n].ljust(n, b"^") for n in STEMS))]
        self.features = (hashed & np.uint64((1 << bits) - 1)).astype(np.int64)  # of each dictionary word
        closes = np.fromiter((w.endswith(b"\x01") for w in words.dictionary), bool, len(words.dictionary))
        self.owner = words.owners()
        at = np.arange(len(words.codes)) - words.starts[self.owner]
        ends = closes[words.codes] | (at % SEGMENT == SEGMENT - 1)
        ends[words.starts[1:][words.counts > 0] - 1] = True
        self.sentence = np.cumsum(ends) - ends


@dataclass(frozen=True)
class Model:
    bits: int
    weights: np.ndarray  # of 2**bits word features
    bias: float
    leak: float  # chance that a document is marked without any toxic sentence

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        """Noisy-or of each text, and its sentences of 0.5 or more as word ranges."""
        cut = Sentences(texts, self.bits)
        words, sentence = cut.words, cut.sentence
        n = len(words.counts)
        if not len(sentence):
            return np.full(n, self.leak), [[] for _ in range(n)]
        weights = self.weights[cut.features]
        z = np.bincount(sentence, weights.sum(axis=1)[words.codes]) + self.bias
        known = (weights != 0).any(axis=1)[words.codes]
        z[np.bincount(sentence, known) == 0] = -60.0  # no weighted word, as in the fit
        p = 1 / (1 + np.exp(-z))
        first = np.flatnonzero(np.diff(sentence, prepend=-1))
        owner = cut.owner[first]
        clean = np.bincount(owner, -np.logaddexp(0, z), minlength=n)
        found: list[list[dict]] = [[] for _ in range(n)]
        ends = np.append(first[1:], len(sentence))
        for s in np.flatnonzero(p >= 0.5):
            start = words.starts[owner[s]]
            found[owner[s]].append({"first": int(first[s] - start), "last": int(ends[s] - 1 - start), "p": float(p[s])})
        return 1 - (1 - self.leak) * np.exp(clean), found


def labelled(docs: DataFrame, labels: DataFrame, usable: Column, limit: int, doc_id: str, text: str, label: str) -> DataFrame:
    """(text, y) of at most ``limit`` labelled documents, in the order of a hash of the id.

    An id with several rows is one document, with the text of the smallest hash.
    """
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
        .groupBy(doc_id)
        .agg(F.max(label).alias("_y"))
        .filter(usable)
        .orderBy(F.xxhash64(doc_id), doc_id)
        .limit(limit)
    )
    # the limit bounds the broadcast side
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    joined = own.join(F.broadcast(known.withColumnRenamed(doc_id, "_id")), "_id")
    one = joined.groupBy("_id").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), F.col("_text").alias("text"), "_y")).alias("d"))
    return one.select("d.text", (F.col("d._y") > 0).cast("int").alias("y"))


def telling_features(sample: DataFrame, bits: int) -> tuple[np.ndarray, int, int]:
    """(features, documents, marked documents): features of five documents or more that are over twice
    as frequent in marked ones (chi square over 10)."""

    def count(batches):
        for batch in pieces(batches, "text"):
            cut = Sentences(batch.column("text"), bits)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            pairs = np.unique(cut.owner * np.int64(len(cut.features) + 1) + cut.words.codes)
            doc, word = pairs // (len(cut.features) + 1), pairs % (len(cut.features) + 1)
            once = np.unique((cut.features[word] + (doc[:, None] << bits)).ravel())
            feature, marked = once & ((1 << bits) - 1), y[once >> bits]
            names, at = np.unique(feature, return_inverse=True)
            n, pos = np.bincount(at, minlength=len(names)), np.bincount(at, marked, minlength=len(names))
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": np.append(names, -1),
                    "n": np.append(n, len(y)),
                    "pos": np.append(pos.astype(np.int64), int(y.sum())),
                }
            )

    counts = sample.mapInArrow(count, "feature long, n long, pos long").groupBy("feature")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    total = counts.filter("feature = -1").first()
    n, marked = (total["n"], total["pos"]) if total else (0, 0)
    if not 0 < marked < n:
        return np.zeros(0, np.int64), n, marked
    rate = marked / n
    telling = counts.filter("feature >= 0 and n >= 5").filter(
        (F.col("pos") / marked > 2 * (F.col("n") - F.col("pos")) / (n - marked))
        & ((F.col("pos") - F.col("n") * rate) ** 2 > 10 * F.col("n") * rate * (1 - rate))
    )
    return np.sort(np.array([r["feature"] for r in telling.select("feature").collect()], np.int64)), n, marked


def telling_words(sample: DataFrame, features: np.ndarray, bits: int) -> list:
    """(y, packed) of each document: feature << 32 | sentence of its telling features."""

    def pick(batches):
        for batch in pieces(batches, "text"):
            cut = Sentences(batch.column("text"), bits)
            used = np.isin(cut.features, features)
            at = np.flatnonzero(used.any(axis=1)[cut.words.codes])
            code = cut.words.codes[at]
            row, column = np.nonzero(used[code])
            packed = cut.features[code[row], column] << 32 | cut.sentence[at[row]]
            ends = np.searchsorted(cut.owner[at[row]], np.arange(batch.num_rows + 1))
            parts = [packed[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_pydict({"y": batch.column("y"), "packed": pa.array(parts, pa.binary())})

    return sample.mapInArrow(pick, "y int, packed binary").collect()


def fit(rows: list, bits: int, steps: int = 200, rate: float = 0.15, decay: float = 1e-4) -> Model:
    """Gradient ascent on the likelihood of document labels under noisy-or with a leak."""
    weights = np.zeros(1 << bits)
    y = np.array([r["y"] for r in rows], float)
    packed = [np.frombuffer(r["packed"], np.int64) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(p) for p in packed])
    packed = np.concatenate([*packed, np.zeros(0, np.int64)])
    names, feature = np.unique(packed >> 32, return_inverse=True)
    pairs, sentence = np.unique(doc << 32 | (packed & 0xFFFFFFFF), return_inverse=True)
    owner = pairs >> 32
    # sentences without a telling word have probability 0: the leak stands for them
    w, bias, leak = np.full(len(names), 1.0), -3.0, -3.0
    m, v = np.zeros(len(names) + 2), np.zeros(len(names) + 2)
    for t in range(1, steps + 1):
        z = np.bincount(sentence, w[feature], minlength=len(owner)) + bias
        p = 1 / (1 + np.exp(-z))
        clean = np.bincount(owner, -np.logaddexp(0, z), minlength=len(y))
        spill = 1 / (1 + np.exp(-leak))
        q = np.clip(1 - (1 - spill) * np.exp(clean), 1e-9, 1 - 1e-9)  # chance of the label 1
        by_clean = y * (1 - q) / q - (1 - y)  # minus d log-likelihood / d log(1 - q)
        gz = by_clean[owner] * p
        g = np.concatenate([np.bincount(feature, gz[sentence], minlength=len(names)), [gz.sum(), (by_clean * spill).sum()]])
        g = g / len(y) - decay * np.concatenate([w, [0, 0]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, bias, leak = w + step[:-2], bias + step[-2], leak + step[-1]
    weights[names] = w
    return Model(bits, weights, float(bias), float(1 / (1 + np.exp(-leak))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column | None = None,
    max_documents: int = 12_000,
    bits: int = 20,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """Model from the labels of rows where ``usable`` holds (an expression over ``doc_id``).

    ``max_documents`` bounds the sample the weights are fitted on. Without labelled documents, or
    with one label only, no word weighs anything. Repeated labels of a document count as its largest.
    """
    usable = F.lit(True) if usable is None else usable
    sample = written(labelled(docs, labels, usable, max_documents, doc_id, text, label), "labelled")
    features, n, marked = telling_features(sample, bits)
    if not len(features):
        return Model(bits, np.zeros(1 << bits), -30.0, min(max(marked / n, 0.01), 0.99) if n else 0.01)
    return fit(telling_words(sample, features, bits), bits)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, score, offending, *keep): noisy-or of every whole text, and its toxic sentences as word ranges.

    Null and empty texts get the leak of the model; repeated rows are scored alike.
    """
    own = docs.select(doc_id, *(c for c in dict.fromkeys([text, *keep]) if c != doc_id))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits weights

    def rate(batches):
        for batch in pieces(batches, text):
            scores, found = shared.value.score(batch.column(text))
            spans = pa.array(found, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("p", pa.float64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(doc_id), pa.array(scores), spans, *(batch.column(c) for c in extra)],
                names=[doc_id, "score", "offending", *extra],
            )

    extra = [c for c in keep if c != doc_id]
    carried = "".join(f", `{c}` {own.schema[c].dataType.simpleString()}" for c in extra)
    kind = own.schema[doc_id].dataType.simpleString()
    return own.mapInArrow(
        rate, f"`{doc_id}` {kind}, score double, offending array<struct<first:int,last:int,p:double>>{carried}"
    )
