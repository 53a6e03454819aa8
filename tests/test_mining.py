import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtide.functions import text
from moodtide.operators import mining as M
from moodtide.operators import topics as T


def corpus_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "review_id long, review_text string")


def test_bigrams_bridge_stop_words(spark):
    docs = corpus_of(spark, ["Support for the app!", "the app support", "x 12 support and a app2 app"])
    got = {r.phrase: r["count"] for r in M.top_bigrams(docs).collect()}
    assert got == {"support app": 2, "app support": 1}
    assert M.top_bigrams(docs.limit(2)).isEmpty()
    assert {r.phrase for r in M.top_bigrams(docs, min_df=2).collect()} == {"support app"}
    assert {r.phrase for r in M.top_bigrams(docs, stop_words=[]).collect()} >= {"support for", "the app"}


def test_tokens(spark):
    df = spark.createDataFrame([("It's naïve_x: ab2 ÉTÉ été ab, b CD",)], "t string")
    assert df.select(text.tokens(F.col("t"))).first()[0] == ["it", "ab", "cd"]


def test_substance(spark):
    docs = corpus_of(spark, ["  12345 ", "123456", None])
    assert [r.review_id for r in M.substantial(docs).collect()] == [1]


def dense_weights(docs, max_df=0.95, max_terms=2000):
    terms = sorted({w for d in docs for w in d})
    tf = np.array([[d.count(t) for t in terms] for d in docs], float)
    df = (tf > 0).sum(axis=0)
    keep = [i for i in np.lexsort((terms, -tf.sum(axis=0))) if df[i] <= max_df * len(docs)][:max_terms]
    keep = sorted(keep)
    w = tf[:, keep] * (np.log((1 + len(docs)) / (1 + df[keep])) + 1)
    norm = np.linalg.norm(w, axis=1, keepdims=True)
    return np.divide(w, norm, out=np.zeros_like(w), where=norm > 0), [terms[i] for i in keep]


WORDS = [["alpha", "beta", "gamma"], ["delta", "epsilon", "zeta"], ["eta", "theta", "iota", "kappa"]]


def topical_docs(n=30, seed=0):
    rng = np.random.default_rng(seed)
    docs = []
    for i in range(n):
        own, other = WORDS[i % 3], WORDS[rng.integers(3)]
        docs.append([*rng.choice(own, 6), *rng.choice(other, 2), "shared"])
    docs.append([])
    return [[str(w) for w in d] for d in docs]


def test_term_weights_match_dense(spark):
    docs = topical_docs()
    df = corpus_of(spark, [" ".join(d) for d in docs])
    for limit in (2000, 5):
        want, terms = dense_weights(docs, max_terms=limit)
        got = M.term_weights(df, max_terms=limit, stop_words=[]).toPandas()
        assert set(got["term"]) == set(terms) and len(got) == (want > 0).sum()
        for r in got.itertuples():
            assert r.weight == pytest.approx(want[r.review_id, terms.index(r.term)])


def dense_nmf(x, w, h, tol=1e-4, max_iter=400):
    """Undivided coordinate descent from a given start."""

    def sweep(a, gram, target):
        total = 0.0
        for t in range(a.shape[1]):
            for i in range(a.shape[0]):
                g = a[i] @ gram[:, t] - target[i, t]
                total += abs(min(0.0, g) if a[i, t] == 0 else g)
                if gram[t, t]:
                    a[i, t] = max(0.0, a[i, t] - g / gram[t, t])
        return total

    first = None
    ht = h.T.copy()
    for _ in range(max_iter):
        v = sweep(w, ht.T @ ht, x @ ht)
        v += sweep(ht, w.T @ w, x.T @ w)
        first = first or v
        if v / first <= tol:
            break
    return ht.T


def test_topics_match_undivided_algorithm(spark, monkeypatch):
    docs = topical_docs()
    df = corpus_of(spark, [" ".join(d) for d in docs])
    x, terms = dense_weights(docs)
    k = 3
    weights = M.term_weights(df, stop_words=[])
    matrix, names = T.text_term_rows(weights, df, "review_id")
    assert names == terms
    matrix = matrix.repartition(40).persist()  # more tasks than partial sums fetched at once
    # Start by the exact SVD.
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    w, h = np.zeros((len(x), k)), np.zeros((k, x.shape[1]))
    w[:, 0], h[0] = np.sqrt(s[0]) * abs(u[:, 0]), np.sqrt(s[0]) * abs(vt[0])
    for j in range(1, k):
        pairs = [(np.maximum(sg * u[:, j], 0), np.maximum(sg * vt[j], 0)) for sg in (1, -1)]
        a, b = max(pairs, key=lambda p: np.linalg.norm(p[0]) * np.linalg.norm(p[1]))
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        w[:, j], h[j] = np.sqrt(s[j] * na * nb) * a / na, np.sqrt(s[j] * na * nb) * b / nb
    for m in (w, h):
        m[m < 1e-6] = 0
        m[m == 0] = x.mean()
    want = dense_nmf(x, w, h)
    got = T.factorise(matrix, len(docs), len(terms), k, sweeps_per_table=3)
    np.testing.assert_allclose(got, want, atol=2e-3)
    topics = [set(r.top_words.split(", ")[:3]) for r in T.nmf_topics(df, 3, 4, stop_words=[]).collect()]
    assert len(topics) == 3 and all(any(t <= {*g, "shared"} for g in WORDS) for t in topics)


def test_topics_need_enough_texts(spark):
    assert T.nmf_topics(corpus_of(spark, ["alpha beta"] * 9)).isEmpty()


@pytest.mark.parametrize(
    "phrases, themes",
    [
        (["great support", "love it"], ["support"]),
        (["great love", "day one"], ["positive"]),
        (["app-crash loop", "worth money", "hard menu"], ["usability", "value", "stability"]),
        (["blue sky"], []),
        ([], []),
    ],
)
def test_themes(spark, phrases, themes):
    df = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    assert [r.theme for r in M.theme_clusters(df).collect()] == themes
