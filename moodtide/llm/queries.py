"""One query per operator, with production parameters, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from moodtide.llm import (
    ann,
    ctw,
    decontam,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    periodic_runs,
    secret_scan,
    sharding,
    toxicity,
    url_filter,
    whitening,
)
from moodtide.llm.common import id_remainder, table

# The rules of the url query.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op1_near_dedup(spark, d):
    return near_dedup.components(table(spark, d, "documents"), size=5, percent=75)


def op2_toxicity(spark, d):
    docs = table(spark, d, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, d, "labels"), ~held_out))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def op3_decontamination(spark, d):
    return decontam.judge(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("h")


def op4_license_scan(spark, d):
    return license_scan.scan(table(spark, d, "documents"))


def op5_sharding(spark, d):
    placed = sharding.plan(table(spark, d, "documents"), 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op6_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"))


def op7_context_tree(spark, d):
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    scored = ctw.score(table(spark, d, "documents"), ~held_out)
    return scored.withColumn("held_out", held_out)


def op8_nearest(spark, d):
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_secret_scan(spark, d):
    return secret_scan.scan(table(spark, d, "documents"))


def op10_url_filter(spark, d):
    pages = table(spark, d, "pages")
    judged = url_filter.judge(pages.select("page_id", "url"), URL_RULES, url_filter.link_edges(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def planted(text, doc_id):
    """``text``, in a tenth of the documents with words from some place on replaced by a repeating stretch."""
    w = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    n, g = F.size(w).cast("long"), F.floor(h / 10)
    a = g % F.greatest(n, F.lit(1))
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    block = F.slice(w, a.cast("int") + 1, p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(block, times)), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def op11_periodic_runs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.find_runs(docs)
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_line_dedup(spark, d):
    out = line_dedup.drop_repeated_lines(table(spark, d, "documents"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_whitening(spark, d):
    return whitening.whiten(table(spark, d, "embeddings"), components=4, weights="one")


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup,
        op2_toxicity,
        op3_decontamination,
        op4_license_scan,
        op5_sharding,
        op6_packing,
        op7_context_tree,
        op8_nearest,
        op9_secret_scan,
        op10_url_filter,
        op11_periodic_runs,
        op12_line_dedup,
        op13_whitening,
    )
}
