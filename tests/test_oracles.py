"""Every registered query against its SQL in a second engine, at the smallest scale."""

import math
from pathlib import Path

import duckdb
import pytest

from moodtide.operators.mining import default_stop_words
from workload.oracles import ORACLES, STOP_WORDS
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def canonical(rows):
    clean = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows]
    return sorted(clean, key=lambda r: tuple(str(v) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, sql, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert cols == sorted(names)
    want = canonical([tuple(r[names.index(c)] for c in cols) for r in cursor.fetchall()])
    got = canonical([tuple(r[c] for c in cols) for r in df.collect()])
    assert got == want


def test_queries_without_sql_still_run(spark):
    rest = set(QUERIES) - set(ORACLES)
    assert rest == {"nmf_topics_corpus", "snapshot_json"}
    for name in rest:
        assert QUERIES[name](spark, SF).count() == 5


def test_stop_word_list(spark):
    assert set(STOP_WORDS) == {w for w in default_stop_words() if len(w) > 1 and w.isalpha() and w.isascii()}
