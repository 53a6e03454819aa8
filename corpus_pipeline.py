"""A training corpus in five stages over a table of documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
their input. Null and empty texts pass every filter; a null id is never linked with another document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import decontam, near_dedup, packing, secret_scan, toxicity
from moodtide.llm.common import written

TOXIC_FROM = 0.7
BATCH_ROWS = 1000


def _masked(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """``docs`` with all columns but id and text renamed, so that no column of an operator clashes."""
    names = {c: f"_column{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), tuple(names.get(c, c) for c in docs.columns)


def _small_batches(spark: SparkSession) -> None:
    """Rows of whole texts cross to Python in small batches, which bounds both sides' buffers."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows, "10000")) > BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under ``TOXIC_FROM``; the model learns from all labels."""
    _small_batches(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    masked, names = _masked(docs)
    scored = toxicity.score(masked, model, keep=names)
    return scored.filter(F.col("score") < TOXIC_FROM).select(*names).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    A document is an id and a text: different texts under one id are judged each by itself (the smaller
    hash first), rows that repeat both become one.
    """
    masked, names = _masked(docs)
    texts = masked.filter("doc_id IS NOT NULL").groupBy("doc_id", F.xxhash64("text").alias("_h"))
    texts = written(texts.agg(F.count("*").alias("_rows")), "texts-of-ids")
    if texts.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        keyed = masked.withColumn("_key", F.col("doc_id"))
        texts = texts.withColumn("_key", F.col("doc_id"))
    else:
        # numbers in the order of ids: those of a sorted table ascend from part to part
        texts = written(texts.orderBy("doc_id", "_h").withColumn("_key", F.monotonically_increasing_id()), "numbered")
        keyed = masked.withColumn("_h", F.xxhash64("text")).join(texts.drop("_rows"), ["doc_id", "_h"], "left").drop("_h")
        keyed = written(keyed, "numbered-texts")
    _small_batches(spark)
    groups = near_dedup.components(keyed, doc_id="_key")
    dropped = written(groups.filter(~F.col("kept")).select(F.col("doc_id").alias("_key")).distinct(), "dropped")
    kept = keyed.join(decontam.small(dropped), "_key", "left_anti")
    repeated = written(texts.filter("_rows > 1").select("_key"), "repeated")
    if not repeated.isEmpty():
        ids = decontam.small(repeated)
        once = kept.join(ids, "_key", "left_semi").dropDuplicates(["_key"])
        kept = kept.join(ids, "_key", "left_anti").unionByName(once)
    return kept.select(*names).toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 per cent of the words stand in passages of the benchmark."""
    masked, names = _masked(docs)
    judged = decontam.judge(masked, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = judged.filter("contaminated").select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct()
    bad = decontam.small(written(bad, "contaminated"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))
    return masked.join(bad, same, "left_anti").select(*names).toDF(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and the number of characters set anew."""
    _small_batches(spark)
    masked, names = _masked(docs)
    found = secret_scan.scan(masked, keep=tuple(n for n in names if n != "text"), redacted="text")
    out = found.select(*names).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the ids of each document lie in sequences of 2048."""
    _small_batches(spark)
    return packing.pack_documents(docs, window=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]
ORACLE_SQL = None  # tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
