"""Invariants of sampling, vectorizing, Naive Bayes and evaluation."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textsieve.operators import evaluate, rank, sampling, vectorize
from textsieve.operators import prepare as P


def test_prepare_fa(spark):
    rows = [("ham", "This is a test message", None, None), ("spam", "Buy now!", None, None),
            ("ham", "Hello, how are you?", None, None), ("spam", "Win a prize!", None, None)]
    df = spark.createDataFrame(rows, "v1 string, v2 string, _c2 string, _c3 string")
    out = P.preprocess_data(df)
    assert out.columns == ["label", "message"]
    assert [r[0] for r in out.collect()] == [0, 1, 0, 1]
    ft = P.split_features_target(out)
    assert [r[0] for r in ft.collect()] == [r[1] for r in rows]


def test_unknown_label_dropped(spark):
    df = spark.createDataFrame([("Spam", "a"), ("other", "b"), (None, "c"), ("ham", "d")], "v1 string, v2 string")
    out = P.preprocess_data(df)
    assert [tuple(r) for r in out.collect()] == [(0, "d")]
    prof = {r[0]: r[1] for r in P.null_profile(P.encode_labels(P.rename_columns(df))).collect()}
    assert prof == {"label": 3}


def test_label_without_message_is_error(spark):
    df = spark.createDataFrame([(None,)], "label string")
    with pytest.raises(ValueError):
        P.drop_null_rows(df)


def test_balance_fd(spark):
    rows = [(i, i * 3 + 1, i * 3 + 2, i * 3 + 3, 0 if i < 4 else 1) for i in range(8)]
    df = spark.createDataFrame(rows, "row_id bigint, f1 int, f2 int, f3 int, label int")
    bal = sampling.balance_classes(df)
    counts = {r[0]: r[1] for r in bal.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 4  # tie: class 0 is resampled
    assert bal.where("label = 1 AND copy_no = -1").count() == 4


def test_split_sizes(spark):
    rows = [(i, i * 3 + 1, i * 3 + 2, i * 3 + 3, 0 if i < 4 else 1) for i in range(8)]
    df = spark.createDataFrame(rows, "row_id bigint, f1 int, f2 int, f3 int, label int")
    sp = sampling.stratified_split(df, 0.3)
    per = {(r[0], r[1]): r[2] for r in sp.groupBy("label", "is_test").count().collect()}
    # ceil(0.3 * 8) = 3 test rows, 5 training rows shared 3/2 by largest remainder
    assert per[(0, True)] + per[(1, True)] == math.ceil(0.3 * 8)
    assert per[(0, False)] == 3 and per[(1, False)] == 2
    assert sp.where(~F.col("is_test")).count() > sp.where("is_test").count()


def test_kfold_sizes(spark):
    df = spark.range(103).select(F.col("id").alias("row_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    f = sampling.kfold_assign(df, 5)
    sizes = f.groupBy("label", "fold").count().collect()
    by = {}
    for r in sizes:
        by.setdefault(r[0], []).append(r[2])
    for v in by.values():
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_global_row_number_matches_window(spark):
    from pyspark.sql import Window

    df = spark.range(1000).select(F.col("id"), sampling.md5_key("id").alias("k"))
    a = sampling.global_row_number(df, ["k", "id"], "rn", 7).select("id", "rn")
    b = df.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("rn"))
    assert a.exceptAll(b).count() == 0 and a.count() == 1000


def test_vectorize_empty_vocabulary(spark):
    from tests.test_text import F_B

    df = spark.createDataFrame([(i, t) for i, t in enumerate(F_B)], "row_id bigint, message string")
    with pytest.raises(ValueError, match="empty vocabulary"):
        vectorize.fit_transform(df, min_df=5)
    x, vocab = vectorize.fit_transform(df, min_df=1)
    assert x.select("row_id").distinct().count() == 4
    norms = x.groupBy("row_id").agg(F.sum(F.col("value") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-9 for r in norms)


def test_auc_ap_tied(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "label int, probability double")
    assert abs(evaluate.roc_auc(df).first()[0] - 0.75) < 1e-12
    assert abs(evaluate.average_precision(df).first()[0] - 0.8333333333) < 1e-9
    tie = spark.createDataFrame([(1, 0.5), (0, 0.5)], "label int, probability double")
    assert abs(evaluate.roc_auc(tie).first()[0] - 0.5) < 1e-12


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    m = evaluate.binary_metrics(df).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0
    cm = evaluate.confusion_matrix(df).collect()
    assert len(cm) == 4 and sum(r["n"] for r in cm) == 2


def test_roc_monotone(spark):
    from textsieve.plans import catalog

    pts = catalog.QUERIES["roc_points"](spark, SF_SMALL).orderBy("point").collect()
    f = [r["fpr"] for r in pts]
    t = [r["tpr"] for r in pts]
    assert f == sorted(f) and t == sorted(t) and f[-1] == 1.0 and t[-1] == 1.0


def test_scoring_keeps_rows_without_known_terms(spark):
    from textsieve.plans import catalog

    pr = catalog.predictor(spark, SF_SMALL)
    df = spark.createDataFrame([(1, "zzzz qqqq"), (2, "")], "row_id bigint, text string")
    out = pr.transform(df, "text", ("row_id",)).collect()
    assert len(out) == 2
    assert all(r["prediction"] in (0, 1) and 0.5 <= r["confidence"] <= 1.0 for r in out)


def test_global_row_number_on_nondeterministic_input(spark):
    """Round-robin input: the range sample may differ between evaluations; the
    ranks must still be a permutation equal to the window's."""
    from pyspark.sql import Window

    df = spark.range(5000).repartition(7).select(F.col("id"), sampling.md5_key("id").alias("k"))
    a = sampling.global_row_number(df, ["k", "id"], "rn", 5).select("id", "rn")
    b = df.select("id", F.row_number().over(Window.orderBy("k", "id")).alias("rn"))
    assert a.exceptAll(b).count() == 0 and a.count() == 5000
    rt = sampling.running_totals(df.withColumn("one", F.lit(1)), ["k", "id"], ["one"], num_partitions=5)
    assert rt.where(F.col("cum_one") != F.col("rn")).count() == 0


def test_md5_rank_matches_window(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("g"),
                                  sampling.md5_key("id").alias("_k"))
    a = sampling.md5_rank(df, "g", "id", "rn", digits=2).select("id", "rn")
    b = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("_k", "id")).alias("rn"))
    assert a.exceptAll(b).count() == 0 and a.count() == 3000


def test_bigram_counts_are_made_once(spark):
    """The texts are cleaned for one aggregation, whose counts are written: what reads them holds no text any more."""
    rows = [(1, "red apple pie red apple"), (1, "red apple tart"), (0, "blue sky over blue sky"), (0, "blue sky")]
    out = rank.bigram_collocations(spark.createDataFrame(rows, "label int, message string"), "message", "label", 5, 2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "Generate" not in plan
    assert {(r.label, r["rank"], r.w1, r.w2, r.n12) for r in out.collect()} == {(1, 1, "red", "apple", 3), (0, 1, "blue", "sky", 3)}


def test_term_statistics_without_a_table_of_documents_and_terms(spark):
    rows = [(1, "apple apple pear"), (2, "pear plum"), (3, None), (4, ""), (5, "apple of"), (6, "plum plum plum")]
    df = spark.createDataFrame(rows, "row_id bigint, message string")
    plan = vectorize.term_stats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [row_id" not in plan
    shared = spark.createDataFrame([(1, "apple fig"), (None, "fig pear"), (None, "fig"), (5, "of")], "row_id bigint, message string")
    for d in (df, df.unionByName(shared)):
        counts = vectorize.term_counts(d).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("ctf"))
        assert sorted(vectorize.term_stats(d).collect()) == sorted(counts.collect())
