"""Registered queries against their SQL in a second engine, and the pipeline's stages against brute force."""

from __future__ import annotations

import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from .test_operators import SCHEMA, _shingles, _texts, brute_components, brute_hits, brute_ids, brute_secrets

import __spark_entry__ as entry
import corpus_pipeline
from moodtide.llm import secret_scan, toxicity
from moodtide.llm.oracles import ORACLES
from moodtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def same(spark, name, folder):
    con = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f / '*.parquet' if f.is_dir() else f}'")
    df = QUERIES[name](spark, str(folder))
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(cursor.fetchall()) == Counter(tuple(r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, name):
    same(spark, name, SF)


def test_url_query_with_links(spark, tmp_path):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "https://a.com/x", link.format("http://b.net/y")),
        (2, "https://c.com/z", link.format("https://a.com/x#part")),
        (3, "https://d.com/q/r", '<META HTTP-EQUIV=refresh content="3; URL=//m.org/fr/1">' + link.format("/q/s")),
        (4, "https://d.com/q/s", link.format("../up")),
        (5, "https://e.com/1", link.format("http://b.net/y?a=1&amp;b=2")),
        (6, "http://b.net/y?a=1&b=2", None),
        (7, "http://Sub.B.NET", link.format("")),
        (8, None, link.format("http://b.net/y")),
        (9, "mailto:x", None),
        (10, "https://f.com/2", link.format("mailto:x")),
        (11, "https://g.com/2", link.format("http://example.com/en/../de/x")),
        (12, "http://example.com/a/b", link.format("./.././de/y")),
        (13, "http://example.com/a/c", "<!--" + link.format("/de/z") + "-->"),
        (14, "http://example.com?a", link.format("?p=2")),
        (15, "https://h.com/", link.format("http://example.com?p=2") + link.format("/de/")),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    same(spark, "op10_url_filter", tmp_path)
    verdicts = {r.page_id: r.verdict for r in QUERIES["op10_url_filter"](spark, str(tmp_path)).collect()}
    assert [verdicts[i] for i in range(1, 11)] == ["block", "block", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow"]
    assert [verdicts[i] for i in range(11, 16)] == ["block", "block", "allow", "allow", "allow"]


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with nulls, repeats and columns named like those of the operators."""
    at = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", 0.5, 1, "x", None) for i, t in enumerate(_texts())]
    rows += [rows[7], (None, *rows[7][1:]), (900, "you idiot clown. " + rows[17][1], *rows[7][2:])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(at / "documents.parquet"))
    bench = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (2, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(at / "benchmark.parquet"))
    spark.createDataFrame([(0, 0), (3, 0)], "doc_id long, toxic int").write.parquet(str(at / "labels.parquet"))
    return at


def test_stages(spark, folder):
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "secret_scan", "packing"]
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]

    kept = stages["toxicity"](spark, docs, str(folder))
    assert kept.columns == columns and Counter(map(tuple, kept.collect())) == Counter(rows)  # labels without a toxic one

    kept = stages["near_dedup"](spark, docs, str(folder))
    smallest = brute_components([r[:2] for r in rows])
    expected = Counter({r: 1 for r in rows if r[0] is None or smallest[r[0]] == r[0]})
    assert kept.columns == columns and Counter(map(tuple, kept.collect())) == expected

    kept = stages["decontamination"](spark, docs, str(folder))
    items = [tuple(r) for r in spark.read.parquet(str(folder / "benchmark.parquet")).collect()]
    clean = [r for r in rows if not brute_hits(r[1], items)[-1]]
    assert kept.columns == columns and Counter(map(tuple, kept.collect())) == Counter(clean)
    assert len(rows) > len(clean) > len(rows) - 6

    kept = stages["secret_scan"](spark, docs, str(folder)).collect()
    assert len(kept) == len(rows)
    for r in kept:
        original = [t for i, t, *_ in rows if i == r.doc_id]
        base = [",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in brute_secrets(t)) for t in original]
        if not any(base):
            assert r.text in original
        else:
            assert "[SECRET]" in r.text and not brute_secrets(r.text)

    packed = stages["packing"](spark, docs, str(folder)).collect()
    ids = Counter()
    for i, t, *_ in rows:
        own = np.array(brute_ids(t), "<u4")
        for a in range(0, len(own), 2048):
            ids[(i, a, zlib.crc32(own[a : a + 2048].tobytes()))] += 1
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in packed) == ids


def test_stages_lose_no_text_of_a_repeated_id(spark, folder):
    """Different texts under one id are documents of their own; columns may be named as those of the stages."""
    texts = [t for t in _texts() if t and len(t.split()) > 40][:6]
    first, other, third = texts[0], texts[3], "a quite different text of its own " * 4
    rows = [(1, first), (1, third), (2, other), (2, third + "end"), (3, first + " and"), (3, first), (None, first), (None, first), (4, None), (4, None)]
    rows = [(i, t, n, "a", "b", 7, "c") for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _h string, _key string, _rows int, h string")
    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "decontamination", "secret_scan"):
        kept = stages[name](spark, docs, str(folder))
        assert kept.columns == docs.columns and Counter(map(tuple, kept.collect())) == Counter(rows), name
    kept = stages["near_dedup"](spark, docs, str(folder))
    ids = Counter((r.doc_id, r.text) for r in kept.collect())
    assert kept.columns == docs.columns
    expected = [(1, first), (None, first), (None, first), (4, None)]
    near = _near(third, third + "end")
    expected += [(1, third)] + ([] if near else [(2, third + "end")]) + ([] if _near(first, other) else [(2, other)])
    assert ids == Counter(expected)
    plain = spark.createDataFrame([(1, third), (2, other), (3, third), (3, third)], "doc_id long, text string")
    assert {tuple(r) for r in stages["near_dedup"](spark, plain, str(folder)).collect()} == {(1, third), (2, other)}


def _near(a, b):
    x, y = _shingles(a), _shingles(b)
    return 100 * len(x & y) >= 75 * len(x | y)


def test_one_document_an_id_in_the_sample_of_labels(spark):
    docs = spark.createDataFrame([(i % 5, f"text {i}") for i in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    got = toxicity.labelled(docs, labels, F.lit(True), 10_000, "doc_id", "text", "toxic").collect()
    assert len(got) == 5 and sum(r.y for r in got) == 2
    assert toxicity.labelled(docs, labels, F.lit(True), 3, "doc_id", "text", "toxic").count() <= 3


def test_pipeline_runs_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, str(folder))
    assert "sequence_id" in out.columns and out.count() > 20


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(str(folder / f"{name}.parquet")).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
