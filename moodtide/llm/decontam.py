"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

The index stores where in each document the words of the test items stand. Of every window of an
item the rarest words look up their postings; lists shifted by the word's offset must meet in one
start. What is left is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import ascii_lower, written

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""  # no word; its posting holds the number of words of a document
# Rows, or other units, up to which a table that has been counted is sent to every task; beyond, Spark
# shuffles.
SMALL_ROWS = 200_000
SMALL_CHARACTERS = 4_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def small(df: DataFrame, weight: Column | None = None, most: int = SMALL_ROWS) -> DataFrame:
    """``df``, a written table, marked for broadcast if its rows weigh ``most`` at most, one each by default."""
    total = df.agg(F.sum(F.lit(1) if weight is None else weight)).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def test_items(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, words) of items that have words; ``item`` numbers them, as ids may be null or repeat."""
    own = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("words"))
    own = own.filter(F.size("words") > 0).distinct()
    return written(own.select(F.monotonically_increasing_id().alias("item"), "item_id", "words"), "test-items")


def vocabulary(items: DataFrame) -> DataFrame:
    """(word, term): numbers of the words of ``items``; -1 marks the end of a document."""
    terms = items.select(F.explode("words").alias("word")).distinct()
    numbered = terms.withColumn("term", F.monotonically_increasing_id())
    end = items.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(-1).cast("long").alias("term"))
    return written(numbered.unionByName(end), "vocabulary")


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, pos, term) postings of ``terms``; ``h`` tells texts of one id apart.

    Postings stay in the partition of their document: a frequent word is no hot group.
    """
    tokens = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("h"),
        F.posexplode(F.concat(words(F.col(text)), F.array(F.lit(END)))).alias("pos", "word"),
    )
    return written(tokens.join(small(terms, F.length("word") + 1, SMALL_CHARACTERS), "word").select("doc_id", "h", "pos", "term"), "postings")


def _windows(items: DataFrame, index: DataFrame, terms: DataFrame, size: int, rare: int) -> DataFrame:
    """(item, item_id, words, start, len, rare): windows whose words all occur, with their rarest positions."""
    counts = index.groupBy("term").agg(F.count("*").alias("cf"))
    word_counts = terms.join(counts, "term").select("word", "cf")
    placed = items.select("item", "item_id", "words", F.posexplode("words").alias("i", "word"))
    counted = (
        placed.join(word_counts, "word", "left")
        .groupBy("item", "item_id", "words")
        .agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("cf", F.lit(0)).alias("cf")))).alias("at"))
    )
    length = F.least(F.size("words"), F.lit(size))
    starts = F.explode(F.sequence(F.lit(0), F.size("words") - length))
    windows = counted.select("item", "item_id", "words", "at", length.alias("len"), starts.alias("start"))
    by_count = F.array_sort(
        F.transform(F.slice("at", F.col("start") + 1, F.col("len")), lambda x: F.struct(x["cf"].alias("cf"), x["i"].alias("i")))
    )
    windows = windows.withColumn("rarest", F.slice(by_count, 1, rare))
    possible = windows.filter(F.col("rarest")[0]["cf"] > 0)
    return written(
        possible.select("item", "item_id", "words", "start", "len", F.sort_array(F.col("rarest.i")).alias("rare")), "windows"
    )


def occurrences(
    docs: DataFrame,
    items: DataFrame,
    index: DataFrame,
    terms: DataFrame,
    size: int = 13,
    rare: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, h, hits, item_ids): positions inside windows, and items with such windows, per text."""
    windows = _windows(items, index, terms, size, rare)
    looked_up = (
        windows.select("item", "words", F.explode("rare").alias("i"))
        .distinct()
        .select("item", "i", F.element_at("words", F.col("i") + 1).alias("word"))
        .join(terms, "word")
        .select("item", "i", "term")
    )
    looked_up = written(looked_up, "lookups")
    met = (
        index.join(small(looked_up), "term")
        .groupBy("doc_id", "h", "item", (F.col("pos") - F.col("i")).alias("shift"))
        .agg(F.collect_set("i").alias("met"))  # words of an item at most
    )
    by_item = windows.groupBy("item", "item_id", "words", "len").agg(F.collect_list(F.struct("start", "rare")).alias("windows"))
    by_item = written(by_item, "windows-by-item")
    kept = F.filter("windows", lambda w: (F.size(F.array_except(w["rare"], F.col("met"))) == 0) & (w["start"] + F.col("shift") >= 0))
    starts = F.transform(kept, lambda w: w["start"])
    candidates = (
        met.join(small(by_item, F.size("words") + F.size("windows")), "item")
        .select("doc_id", "h", F.struct("item_id", "words", "len", "shift", starts.alias("starts")).alias("c"))
        .filter(F.size("c.starts") > 0)
        .groupBy("doc_id", "h")
        .agg(F.collect_list("c").alias("candidates"))  # of one document
    )
    candidates = written(candidates, "candidates")
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    found = small(candidates.select(F.col("doc_id").alias("d"), F.col("h").alias("g")))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))
    texts = written(
        own.join(found, same, "left_semi").select("doc_id", "h", words(F.col("text")).alias("own")), "texts"
    ).dropDuplicates(["doc_id", "h"])
    paired = texts.join(candidates.withColumnsRenamed({"doc_id": "d", "h": "g"}), same)

    def stands(c: Column) -> Column:
        return F.filter(
            c["starts"],
            lambda s: F.slice(F.col("own"), s + c["shift"] + 1, c["len"]) == F.slice(c["words"], s + 1, c["len"]),
        )

    exact = F.transform(
        "candidates",
        lambda c: F.struct(
            c["item_id"].alias("item_id"),
            F.flatten(
                F.transform(stands(c), lambda s: F.sequence(s + c["shift"], s + c["shift"] + c["len"] - 1))
            ).alias("hits"),
        ),
    )
    real = paired.select("doc_id", "h", F.filter(exact, lambda c: F.size(c["hits"]) > 0).alias("real"))
    return real.select(
        "doc_id",
        "h",
        F.sort_array(F.array_distinct(F.flatten(F.col("real.hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.col("real.item_id").cast("array<string>"))).alias("item_ids"),
    )


def judge(
    docs: DataFrame,
    items: DataFrame,
    size: int = 13,
    percent: int = 5,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, h, n_words, n_hit, n_items, items_sha256, contaminated) of every row.

    A window is ``size`` consecutive words of an item, all of them if it has fewer; a document word
    inside an occurrence of a window is hit; contaminated from ``percent`` per cent hit words on.

    Null texts have no words; items without words no windows; null ids are kept; items without id are
    matched, count as one item together and are left out of items_sha256; repeated rows are judged alike; without items or documents nothing is hit.
    """
    items = test_items(items, item_id, item_text)
    terms = vocabulary(items)
    index = build_index(docs, terms, doc_id, text)
    hits = occurrences(docs, items, index, terms, size, doc_id=doc_id, text=text)
    per_text = hits.select(
        F.col("doc_id").alias("d"), F.col("h").alias("g"), F.size("hits").cast("long").alias("n_hit"), "item_ids"
    )
    whole = index.filter("term = -1").select("doc_id", "h", F.col("pos").cast("long").alias("n_words"))
    joined = whole.join(per_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g")), "left")
    listed = F.coalesce("item_ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id",
        "h",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )


def proximity_matches(index: DataFrame, terms: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(phrase_id, doc_id, h, pos): places of a phrase's rarest word with all its other words within ``slop``.

    ``phrases(phrase_id, words)``: their words must be in ``terms``, else nothing matches.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("cf"))
    wanted = (
        phrases.select("phrase_id", F.explode(F.array_distinct("words")).alias("word"))
        .join(terms, "word", "left")
        .join(counts, "term", "left")
        .select("phrase_id", F.coalesce("term", F.lit(-2)).alias("term"), F.coalesce("cf", F.lit(0)).alias("cf"))
    )
    per_phrase = wanted.groupBy("phrase_id").agg(
        F.min(F.struct("cf", "term")).alias("rarest"), F.countDistinct("term").alias("n")
    )
    wanted, per_phrase = written(wanted, "wanted"), written(per_phrase, "phrases")
    cell = F.floor(F.col("pos") / (slop + 1))
    anchors = index.join(
        small(per_phrase.select("phrase_id", "n", F.col("rarest.term").alias("term"))), "term"
    ).select("phrase_id", "n", "doc_id", "h", F.col("pos").alias("anchor"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    near = index.join(small(wanted.select("phrase_id", "term")), "term").select(
        "phrase_id", "doc_id", "h", "term", "pos", cell.alias("cell")
    )
    return (
        anchors.join(near, ["phrase_id", "doc_id", "h", "cell"])
        .filter(F.abs(F.col("pos") - F.col("anchor")) <= slop)
        .groupBy("phrase_id", "doc_id", "h", "anchor", "n")
        .agg(F.countDistinct("term").alias("met"))
        .filter("met = n")
        .select("phrase_id", "doc_id", "h", F.col("anchor").alias("pos"))
    )
