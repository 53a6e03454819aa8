"""Packing by best-fit decreasing: tokenised documents into sequences of fixed length."""

from __future__ import annotations

import base64
import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import pieces, written

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
END_ID = 1
# Different units and ids that a task remembers before it starts afresh.
_MOST_UNITS, _MOST_IDS = 300_000, 4_000_000

# White space as the vocabulary's pattern knows it. That pattern always cuts before a unit: a word with the one
# blank before it, white space up to the last character of a run, that character unless it is a blank
# before a word.
_SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_IN_RUNS = rf"^$|^[{_SPACE}]|[{_SPACE}][{_SPACE}]|[{_SPACE}]$"
_PLAIN_SPACE = re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), _SPACE)
_UNIT = re.compile(rf" ?[^{_PLAIN_SPACE}]+|[{_PLAIN_SPACE}]+(?![^{_PLAIN_SPACE}])|[{_PLAIN_SPACE}]")


class Encoder:
    """Ids of whole texts by the byte-level vocabulary, each different unit encoded once.

    The ids are those of the tokenizer file, which takes four times as long: the same ranks, and the
    special token's string as its one id. What is remembered lies in flat arrays and is bounded.
    """

    def __init__(self, vocabulary: str):
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._forget()

    def _forget(self) -> None:
        # numbers 0 and 1 are the closing id and the special token, 2 is a line feed
        self.numbers = {"\n": 2}
        self.line_feed = self.fast.encode_ordinary("\n")[0]
        self.ids = np.array([END_ID, SPECIAL_ID, self.line_feed], np.uint32)
        self.length = np.ones(3, np.int64)
        self.waiting: list[list[int]] = []

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts in one array, each text closed by ``END_ID``."""
        if len(self.numbers) > _MOST_UNITS or len(self.ids) > _MOST_IDS:
            self._forget()
        units, last = self._units(pa.concat_arrays([pc.fill_null(texts.cast(pa.string()), "")]))
        size = self.length[units]
        ends = np.cumsum(size)
        begin = (np.cumsum(self.length) - self.length)[units]
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(begin - (ends - size), size)]
        return ids, ends[last - 1]

    def _units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(unit numbers of all texts, each closed by the closing id's; end of each text among them).

        Texts in which words are parted by one blank or one line feed are cut for the whole batch at
        once; those with longer white space, or the special token's string, one by one.
        """
        lists = pc.split_pattern(texts, "\n")
        words = pc.split_pattern(lists.values, " ")
        coded = words.values.dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False)
        line_ends = words.offsets.to_numpy()[1:].astype(np.int64)
        line_of = np.repeat(np.arange(len(line_ends)), np.diff(line_ends, prepend=0))
        text_ends = lists.offsets.to_numpy()[1:].astype(np.int64)  # in lines
        text_of = np.repeat(np.arange(len(texts)), np.diff(text_ends, prepend=0))
        single = pc.or_(pc.match_substring(texts, SPECIAL), pc.match_substring_regex(texts, _IN_RUNS))
        single = single.to_numpy(zero_copy_only=False)

        # a place for every word, and one after every line for the line feed or the closing id
        units = np.full(len(code) + len(line_ends), 2, np.int64)
        first = np.ones(len(code), bool)
        first[1:] = line_of[1:] != line_of[:-1]
        whole = ~single[text_of[line_of]]
        at = np.arange(len(code)) + line_of
        for lead, mask in (("", first & whole), (" ", ~first & whole)):
            used = np.flatnonzero(np.bincount(code[mask], minlength=1))
            if mask.any():
                own = np.zeros(used[-1] + 1, np.int64)
                own[used] = self._numbered(coded.dictionary.take(pa.array(used)), lead)
                units[at[mask]] = own[code[mask]]
        last = line_ends[text_ends - 1] + text_ends
        units[last - 1] = 0
        if not single.any():
            return units, last
        parts = np.split(units, last[:-1])
        for i in np.flatnonzero(single).tolist():
            own = []
            for n, part in enumerate(texts[i].as_py().split(SPECIAL)):
                if n:
                    own.append(1)
                own += [self._number(u) for u in _UNIT.findall(part)]
            parts[i] = np.array([*own, 0], np.int64)
        ids = [np.array(x, np.uint32) for x in self.waiting]
        self._remember(np.concatenate([*ids, np.zeros(0, np.uint32)]), np.array(list(map(len, ids)), np.int64))
        self.waiting = []
        return np.concatenate(parts), np.cumsum(list(map(len, parts)))

    def _numbered(self, words: pa.Array, lead: str) -> list[int]:
        """Numbers of different ``words`` behind ``lead``, none of them with white space at an end.

        New ones are encoded in one go, a line each, and parted by the id of the line feed.
        """
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n" + lead)[0].as_py()
        units = (lead + lines).split("\n")
        numbers = self.numbers
        got = list(map(numbers.get, units))
        new = [i for i, x in enumerate(got) if x is None]
        if new:
            ids = np.array(self.fast.encode_ordinary("\n".join([units[i] for i in new])), np.uint32)
            feed = ids == self.line_feed
            cuts = np.flatnonzero(feed)
            length = np.diff(cuts, prepend=-1, append=len(ids)) - 1
            self._remember(ids[~feed], length)
            for n, i in enumerate(new, len(self.length) - len(new)):
                got[i] = numbers[units[i]] = n
        return got

    def _number(self, unit: str) -> int:
        n = self.numbers.get(unit)
        if n is None:
            n = self.numbers[unit] = len(self.length) + len(self.waiting)
            self.waiting.append(self.fast.encode_ordinary(unit))
        return n

    def _remember(self, ids: np.ndarray, length: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.length = np.concatenate([self.length, length])


@cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def token_pieces(
    docs: DataFrame,
    window: int = 2048,
    vocabulary: str = VOCABULARY,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Ids of every text, closed by ``END_ID``, cut into full windows and a rest."""
    kind = docs.schema[doc_id].dataType.simpleString()
    ids_type = ", ids array<int>" if with_ids else ""

    def cut(batches):
        enc = encoder(vocabulary)
        for batch in pieces(batches, text):
            ids, ends = enc.encode(batch.column(text))
            total = np.diff(ends, prepend=0)
            parts = -(-total // window)
            owner = np.repeat(np.arange(len(total)), parts)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * window
            length = np.minimum(window, total[owner] - start)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            first = 4 * ((ends - total)[owner] + start)
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + 4 * length).tolist(), strict=True)]
            columns = {
                "doc_id": batch.column(doc_id).take(pa.array(owner)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": pa.array(total[owner]),
            }
            if with_ids:
                bounds = np.append(0, np.cumsum(length)).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{ids_type}"
    return docs.select(doc_id, text).mapInArrow(cut, schema)


class _Open:
    """Open sequences by remaining capacity, under a segment tree of their numbers."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(self.leaves)]

    def put(self, capacity: int, sequence: int) -> None:
        self.at[capacity].append(sequence)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the tightest open sequence with room for ``least``."""
        node = least + self.leaves
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):  # up, until a right neighbour has one
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.at[capacity].pop()

    def _add(self, capacity: int, n: int) -> None:
        node = capacity + self.leaves
        while node:
            self.tree[node] += n
            node >>= 1


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by best-fit decreasing; ties in length in the given order."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    spaces, n = _Open(window), 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        got = spaces.take(size)
        if got is None:
            got, n = (window, n), n + 1
        room, sequence[i] = got
        offset[i] = window - room
        if room > size:
            spaces.put(room - size, got[1])
    return sequence, offset


def pack(pieces_: DataFrame, window: int = 2048, group: int = 8192) -> DataFrame:
    """``pieces_`` with sequence_id and offset.

    Full windows and rests are dealt by hash to groups of about ``group`` pieces; each group is
    packed by itself, which costs at most a sequence or two in some thousand.
    """
    pieces_ = written(pieces_, "pieces")
    groups = max(1, -(-pieces_.count() // group))
    schema = pieces_.schema
    key = F.pmod(F.xxhash64(*[F.col(c) for c in ("doc_id", "start", "ids_crc32", "length")], F.lit(7)), F.lit(groups))
    # copies of a row with one id would meet in one group: deal them by their place in the table too
    place = F.pmod(key + F.monotonically_increasing_id(), F.lit(groups))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["bucket"].iloc[0])
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        sequence, offset = best_fit(pdf["length"].to_numpy(), window)
        return pdf.drop(columns="bucket").assign(sequence_id=(g << 32) + sequence, offset=offset)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return (
        pieces_.withColumn("bucket", place)
        .groupBy("bucket")
        .applyInPandas(fit, f"{fields}, sequence_id long, offset long")
    )


def pack_documents(docs: DataFrame, window: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece of every document: where its ids lie in its text and in which sequence.

    Null and empty texts are one piece of the closing id; a repeated row is packed again; very long
    texts are cut into full windows first; an empty table gives no pieces.
    """
    return pack(token_pieces(docs, window, doc_id=doc_id, text=text), window)


def sequences(docs: DataFrame, window: int = 2048, pad_id: int = 50256, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences themselves, padded to ``window``."""
    packed = pack(token_pieces(docs, window, doc_id=doc_id, text=text, with_ids=True), window)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))  # at most ``window`` pieces
    whole = packed.groupBy("sequence_id").agg(parts.alias("p"))
    ids = F.flatten(F.col("p.ids"))
    return whole.select(
        "sequence_id",
        F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(window) - F.size(ids))).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"),
    )
