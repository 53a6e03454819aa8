"""Line de-duplication, periodic runs and whitening against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodtide.llm import line_dedup, periodic_runs, whitening
from moodtide.llm.queries import QUERIES

from .test_operators import SCHEMA, _texts

BLANKS = r"[\x20\x09-\x0D]"


def frame(spark, rows):
    """(id, text) rows under columns that are named like those of the operators."""
    return spark.createDataFrame([(i, t, "en", "s", 0.5, 1, "x", None) for i, t in rows], SCHEMA).repartition(3)


# -- lines -------------------------------------------------------------------------------


def brute_lines(docs, min_chars=20, min_docs=3):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(rf"\A{BLANKS}+|{BLANKS}+\Z", "", line))

    holders = defaultdict(list)
    for i, text in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(-1 if i is None else i)

    def goes(line, i):
        k = key(line)
        return len(k) >= min_chars and len(holders[k]) >= min_docs and (-1 if i is None else i) != max(holders[k])

    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not goes(x, i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return Counter(out)


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(11)
    shared = [f"Shared line number {n} of ümlauts and more" for n in range(40)] + ["short", "", " \t ", "twenty code points é"]
    rows = [(i, t) for i, t in enumerate(_texts())]
    for i in range(100, 260):
        lines = [rng.choice(shared) for _ in range(rng.randint(0, 6))] + [f"own line {rng.random()} of a document"]
        rng.shuffle(lines)
        odd = [rng.choice([x, x.upper(), f"\t{x} \r", f" \x0b{x}\x0c"]) for x in lines]
        rows.append((i, "\n".join(odd)))
    long = "\n".join(rng.choice([*shared, f"line {n} of a long text, which is only here"]) for n in range(60_000))
    assert len(long) > 2 << 20  # beyond one slice of a batch
    hot = [(1000 + i, "a line that a third of all documents hold\n" + f"and {i % 7} of few lines of the same kind") for i in range(90)]
    ties = [(7, "one text under a repeated id, twice\nShared line number 1 of ümlauts and more")] * 2
    nulls = [(None, "a line that only rows without id hold"), (None, "a line that only rows without id hold\nx")] * 2
    return rows + hot + ties + nulls + [(300, long), (301, long), (302, None), (303, "\n\n"), (5_000_000_000, shared[0])]


@pytest.mark.parametrize("limits", [{}, {"broadcast_bytes": -1, "rows_per_task": 300}], ids=["sent", "shuffled"])
def test_lines(spark, line_rows, limits):
    docs = frame(spark, line_rows)
    got = line_dedup.drop_repeated_lines(docs, **limits)
    want = brute_lines(line_rows)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert sum(n * c for (_, _, _, n), c in want.items()) > 200
    kept = line_dedup.drop_repeated_lines(docs, keep=("lang", "score", "v"), **limits)
    assert kept.columns == ["doc_id", "text", "n_lines", "n_dropped", "lang", "score", "v"] and kept.count() == len(line_rows)
    none = line_dedup.drop_repeated_lines(frame(spark, [(1, "x")]).limit(0), **limits)
    assert none.columns == ["doc_id", "text", "n_lines", "n_dropped"] and none.count() == 0


def test_perfect_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 5000):
        h, mark = rng.integers(0, 2**64, (2, n), dtype=np.uint64)
        made = line_dedup.PerfectHash.build(h, mark)
        assert sorted(made.slots(h, mark).tolist()) == list(range(n))
        counts, keepers = rng.integers(3, 1000, n), rng.integers(-(2**63), 2**63, n)
        shard = line_dedup.Shard(line_dedup.Shard.row(0, h, mark, counts, keepers))
        count, keeper = shard.probe(h, mark)
        assert (count == counts).all() and (keeper == keepers).all()
        others = rng.integers(0, 2**64, (2, 2000), dtype=np.uint64)
        assert not shard.probe(*others)[0].any()
        assert len(made.bits) * 64 < 5 * n + 64 * line_dedup._LEVELS
    # equal first hashes are kept apart by the second; keys that no level separates are listed
    same = np.full(300, 5, np.uint64)
    marks = np.arange(300, dtype=np.uint64)
    assert sorted(line_dedup.PerfectHash.build(same, marks).slots(same, marks).tolist()) == list(range(300))
    few = line_dedup.PerfectHash(np.zeros(0, "<i8"), np.zeros(0, "<u8"), np.array([1, 2, 3, 4], "<u8"))
    assert few.slots(np.array([3, 1, 9], np.uint64), np.array([4, 2, 9], np.uint64)).tolist() == [1, 0, -1]


def test_shards_are_small_and_lines_combine_before_the_shuffle(spark, line_rows):
    lines = line_dedup.line_rows(frame(spark, line_rows))
    index, shards = line_dedup.build_index(lines, 3, shard_keys=8)
    assert shards > 3 and index.count() == shards
    plan = lines.groupBy("h", "mark").count()._sc._jvm.PythonSQLUtils.explainString(
        lines.groupBy("h", "mark").count()._jdf.queryExecution(), "simple"
    )
    assert "partial_count" in plan


# -- runs --------------------------------------------------------------------------------


def brute_runs(words, least=6, times=4):
    n, out = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in out.items())


def brute_collapsed(words, runs):
    gone = {j for s, length, q in runs for j in range(s + q, s + length)}
    return " ".join(w for j, w in enumerate(words) if j not in gone)


def brute_row(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(("" if i is None else str(i)).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, brute_collapsed(w, runs))]
    return (i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests)


@given(st.lists(st.sampled_from("ab"), max_size=70), st.lists(st.sampled_from("abc"), min_size=1, max_size=9), st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_runs_of_small_alphabets(words, block, times):
    texts = [words + block * times + words[:3], block * times, [], words]
    code = {c: i for i, c in enumerate("abc")}
    names = np.array([code[w] for t in texts for w in t], np.int64)
    owner = np.repeat(np.arange(4), [len(t) for t in texts])
    starts = np.cumsum([0, *map(len, texts)])
    got = [(o, s - starts[o], length, q) for o, s, length, q in periodic_runs.runs_of(names, owner).tolist()]
    assert got == [(o, *r) for o, t in enumerate(texts) for r in brute_runs(t)]


def run_texts():
    rng = random.Random(4)
    texts = _texts()
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 4)):
            block = [rng.choice("abcde") for _ in range(rng.randint(1, 12))]
            parts += block * rng.randint(1, 9) + block[: rng.randint(0, len(block))]
        texts.append(rng.choice([" ", "\n", "\x0b\t"]).join(parts))
    return texts


def test_runs_query(spark, tmp_path):
    rows = [*enumerate(run_texts()), (None, "a b " * 9), (None, None), (7, "x " * 30), (7, "x " * 30), (5_000_000_000, "é é é é é é é")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    want = [brute_row(i, t) for i, t in rows]
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(want)
    assert sum(w[1] for w in want) > 200


def test_runs_of_a_long_text(spark):
    rng = random.Random(9)
    block = [f"w{rng.randrange(9000)}" for _ in range(40_000)]
    words = [f"v{rng.randrange(9000)}" for _ in range(200_000)] + block * 5 + block[:77] + ["end"] * 6 + block[:50_000]
    text = "  ".join(words)
    assert len(text) > 2 << 20
    got = periodic_runs.find_runs(frame(spark, [(1, text), (2, "b " * 8)]), keep=("lang", "n")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got[0].runs] == [(200_000, 200_077, 40_000), (400_077, 6, 1)]
    assert got[0].collapsed == " ".join(words[:240_000] + ["end"] + block[:50_000])
    assert (got[0].n_words, got[1].collapsed, got[1].lang, got[1].n) == (len(words), "b", "en", 1)
    assert periodic_runs.find_runs(frame(spark, [(1, "")]).limit(0)).count() == 0


def test_strongest_compares_exactly_and_takes_the_first_of_ties(spark):
    runs = [(0, 8, 2), (3, 12, 3), (9, 4 * 10**9 + 1, 10**9), (20, 13, 3), (30, 26, 6)]
    kind = "array<struct<start:long,length:long,period:long>>"
    df = spark.createDataFrame([(runs,), (runs[:2],), ([],), (None,)], f"r {kind}")
    got = [x.b and tuple(x.b) for x in df.select(periodic_runs.strongest(F.col("r")).alias("b")).collect()]
    assert got == [(20, 13, 3), (0, 8, 2), None, None]


# -- whitening ---------------------------------------------------------------------------


def brute_whitening(rows, components=4, by_count=False):
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(256 * np.float64(c))) for c in v) for _, v in rows]
    distinct = Counter(x)
    weight = {k: (c if by_count else 1) for k, c in distinct.items()}
    n, total = len(distinct), sum(weight.values())
    sums = [sum(k[j] * w for k, w in weight.items()) for j in range(len(x[0]))]
    keys = list(distinct)
    centred = np.array([[float(Fraction(total * a - s, total)) for a, s in zip(k, sums, strict=True)] for k in keys])
    w = np.array([weight[k] for k in keys], float)
    cov = (centred * w[:, None]).T @ centred / total
    values, vectors = np.linalg.eigh(cov)
    top = np.argsort(-values)[:components]
    white = {k: c @ vectors[:, top] / np.sqrt(values[top]) for k, c in zip(keys, centred, strict=True)}
    deviation = {k: sum((total * a - s) ** 2 for a, s in zip(k, sums, strict=True)) for k in keys}
    return rows, x, n, deviation, white, values[top] / np.trace(cov)


def vector_rows():
    rng = np.random.default_rng(3)
    spread = np.array([3.0, 2.0, 1.5, 1.0, 0.5, 0.2])
    rows = [(int(i), [float(np.float32(c)) for c in rng.normal(size=6) * spread + 0.3]) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(250)]  # a vector of more than a third of the rows
    rows += [(2000 + i, [c + 1e-4 for c in rows[i][1]]) for i in range(40)]  # mostly equal once they are whole numbers
    odd = [(3000, None), (3001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (3002, [float("nan")] * 6), (3003, [float("-inf")] * 6)]
    return rows + odd + [(None, rows[9][1]), rows[3], rows[3], (3004, [0.0] * 6), (3005, [-0.0] * 6)]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening(spark, weights):
    rows = vector_rows()
    schema = "vec_id long, embedding array<float>, n long, x string, k int"
    df = spark.createDataFrame([(i, v, 1, "a", 2) for i, v in rows], schema).repartition(5)
    got = whitening.whiten(df, weights=weights).collect()
    used, x, n, deviation, white, explained = brute_whitening(
        [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows], by_count=weights == "count"
    )
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in got) == Counter(
        (i, c, n, deviation[k]) for (i, _), k in zip(used, x, strict=True) for c in range(1, 5)
    )
    by = {(r.vec_id, r.component): r.whitened for r in got}
    sign = [np.sign(by[0, c + 1] * white[x[0]][c]) for c in range(4)]
    for (i, _), k in zip(used, x, strict=True):
        assert np.allclose([by[i, c + 1] * sign[c] for c in range(4)], white[k], atol=1e-8)
    assert all(abs(r.explained / explained[r.component - 1] - 1) < 1e-9 for r in got)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_of_odd_tables(spark):
    def run(rows, **options):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id string, embedding array<double>"), **options).collect()

    assert run([]) == [] and run([("a", None)]) == [] and run([("a", [])]) == []
    # a single distinct vector has no variance and no direction
    flat = run([("a", [1.0, 2.0]), ("b", [1.0, 2.0])])
    assert Counter(map(tuple, flat)) == Counter((i, c, 1, 0, None, None, None) for i in "ab" for c in (1, 2))
    # variance along one line only: the second component has no direction
    line = run([("a", [1.0, 2.0]), ("b", [2.0, 4.0]), ("c", [3.0, 6.0]), ("d", [9.0])])
    assert {r.vec_id for r in line} == {"a", "b", "c"} and all((r.whitened is None) == (r.component == 2) for r in line)
    assert line[0].identity_error < 1e-12
    # exact sums beyond a double; a deviation that no long holds is null, as is a vector's row beyond a long
    big = run([("a", [2.0**48, 1.0]), ("b", [-(2.0**48), 3.0]), ("c", [1e300, 1.0])], components=1)
    assert {(r.vec_id, r.n, r.deviation) for r in big} == {("a", 2, None), ("b", 2, None)}
    assert all(abs(abs(r.whitened) - 1) < 1e-12 for r in big)
    near = run([("a", [2.0**22 + i / 256]) for i in range(3)])
    assert sorted(r.deviation for r in near) == [0, 9, 9]
    with pytest.raises(ValueError):
        run([], weights="two")


def test_whitening_needs_no_second_row_of_a_vector(spark):
    """Adding copies changes no result where each distinct vector counts once."""
    rows = [(i, v) for i, v in vector_rows() if i is not None and i < 400]
    schema = "vec_id long, embedding array<float>"

    def results(more):
        out = whitening.whiten(spark.createDataFrame(rows + more, schema)).collect()
        return {(r.vec_id, r.component): (r.n, r.deviation, round(r.whitened, 9)) for r in out}

    once, again = results([]), results([(5000 + i, rows[0][1]) for i in range(300)])
    assert {k: again[k] for k in once} == once and all(again[5000, c] == once[0, c] for c in range(1, 5))
