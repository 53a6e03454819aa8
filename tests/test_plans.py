import pytest

from moodtide.operators import mining as M
from moodtide.operators import panel as P
from moodtide.operators import reviews as R
from moodtide.operators import scoring as N
from moodtide.operators import stats as S
from moodtide.sources import detect as D
from workload import fixtures as X
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"nmf_topics_corpus"}))
def test_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    single = [i for i, line in enumerate(text.splitlines()) if "Exchange SinglePartition" in line]
    lines = text.splitlines()
    # one task gathers partial sums, the heads of a top-k, or one row a day only
    few = ("partial_", "Limit", "keys=[]", "HashAggregate(keys=[date")
    assert all(any(x in lines[i + 1] for x in few) for i in single), text


def test_columns_are_profiled_without_copying_rows(spark):
    text = plan(D.column_scores(X.table(spark, SF, "documents")))
    assert "Expand" not in text and "partial_theta_sketch_agg" in text


def test_texts_are_weighed_with_one_scan_and_one_shuffle_of_words(spark):
    text = plan(M.term_weights(X.text_reviews(spark, SF)))
    assert text.count("regexp_extract_all(lower(") == 2  # once in each use of the counts, which share their shuffle
    text = plan(M.top_bigrams(X.text_reviews(spark, SF), min_df=2))
    assert text.count("regexp_extract_all(lower(") == 1 and "partial_sum" in text


def test_pairs_of_text_and_term_are_counted_in_the_text_and_not_sorted_by_term(spark):
    text = plan(M.term_weights(X.text_reviews(spark, SF)))
    # the vocabulary, the pairs by term, the weighted pairs by text
    assert text.count("Exchange hashpartitioning(") == 3 and "hashpartitioning(__id" not in text
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" in text


def test_top_k_texts_are_digested_after_the_join(spark):
    scores = R.score_table(X.text_scored(spark, SF)).persist()
    text = plan(R.top_disagreement(scores, 5, texts=X.text_reviews(spark, SF)))
    scores.unpersist()
    reading = text[: text.index("InMemoryTableScan")] if "InMemoryTableScan" in text else text
    # rows that meet by their keys are digested in the join's own condition, no others below it
    joined, below = reading[reading.index("BroadcastHashJoin") :].split("\n", 1)
    assert "sha2" in joined and "sha2" not in below


def test_scoring_stays_in_the_jvm_and_reads_two_columns(spark):
    text = plan(P.daily_means(X.text_scored(spark, SF)))
    assert "Python" not in text and "MapInPandas" not in text
    assert "FileScan parquet [doc_id" in text and "n_chars" not in text.split("ReadSchema")[1]
    assert text.count("regexp_extract_all(lower(") == 1 and "partial_avg" in text


def test_verdicts_and_lexicons_need_no_python_workers(spark):
    assert "Python" not in plan(QUERIES["verdict_facts"](spark, SF))
    text = plan(QUERIES["verdict_facts_text"](spark, SF))
    assert "erfc" not in text and text.count("ArrowEvalPython") == text.count("ArrowEvalPython [_nfkc")  # keys of texts
    assert "ExistingRDD" not in plan(X.lexicon(spark, 0))  # rows of a Python list


def test_queue_is_a_top_k_without_full_sort(spark):
    text = plan(R.disagreement_queue(X.text_scored(spark, SF)))
    assert text.count("TakeOrderedAndProject") == 2 and "partial_min" in text
    assert "rangepartitioning" not in text and text.count("regexp_extract_all(lower(") == 1


def test_statistics_have_no_python_before_the_p_value(spark):
    reg = X.long_reg(spark, SF)
    assert "Python" not in plan(S.ols_hc3(reg, p_value=False))
    assert "Python" not in plan(S.stability_frame(reg))
    assert plan(S.stability_frame(reg)).split("InMemoryTableScan")[0].count("Window") <= 2


def test_building_a_selection_starts_no_job(spark):
    reg, scored, reviews = X.long_reg(spark, SF), X.long_scored(spark, SF), X.text_reviews(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")  # opening a table reads its schema in a job
    R.tail_reviews(scored, reg)
    R.day_excerpts(reviews, P.worst_day(reg))
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lexicon_scores_move_no_text(spark):
    scored = N.lexicon_scorer(X.derived_lexicon(spark, SF))(X.text_reviews(spark, SF), "s")
    text = plan(scored.groupBy("ticker").agg({"s": "avg"}))
    assert "Python" not in text and text.count("Exchange") == 1 and text.count("regexp_extract_all(lower(") == 1


def test_first_per_key_thins_before_the_shuffle(spark):
    docs = X.table(spark, SF, "documents")
    text = plan(R.first_per_key(docs, ["text"], [docs["doc_id"]]))
    assert "row_number(), 1, Partial" in text
