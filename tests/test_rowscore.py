"""Scoring inside the row equals the plan of joins, for every kind of model that has it, and moves nothing."""

import pytest
from pyspark.sql import functions as F

from textsieve.config import Options
from textsieve.operators import rowscore
from textsieve.plans import catalog, models, train
from textsieve.plans.predict import Predictor
from textsieve.streaming import score as st

SF_SMALL = "/root/testdata/sf0.001"
ODD = [(-1, None), (-2, ""), (-3, "zzzz qqqq"), (-4, "a b c"), (-5, "WIN win Win " * 2000), (-6, "\x00 \n\t")]


def texts(spark):
    docs = train.read_table(spark, SF_SMALL, "documents").select(F.col("doc_id").cast("bigint").alias("row_id"), "text")
    return docs.unionByName(spark.createDataFrame(ODD, "row_id bigint, text string"))


def rows_of(df):
    return {r.row_id: (r.text, r.preprocessed_text, r.prediction, r.label, round(r.probability, 9), round(r.confidence, 9))
            for r in df.collect()}


@pytest.mark.parametrize("method", ["tfidf", "count"])
def test_rows_equal_joins(spark, method):
    td = catalog.training(spark, SF_SMALL, Options(method=method))
    names = ["Multinomial Naive Bayes", "Bernoulli Naive Bayes", "Gaussian Naive Bayes", "Logistic Regression",
             "Support Vector Machine", "Decision Tree", "Random Forest"]
    if method == "count":
        names = names[:1] + names[3:4] + names[5:6]
    for name in names:
        params = {"n_estimators": 5} if name == "Random Forest" else None
        p = Predictor(models.create_model(name, params).fit(td), td.vocab, td.options)
        assert p.scores_in_the_row()
        inside = rows_of(p.transform(texts(spark)))
        p._row_scorer = None  # the plan of joins
        joined = rows_of(p.transform(texts(spark)))
        assert inside == joined and len(inside) == texts(spark).count(), name


def test_nothing_moves_and_ids_may_repeat(spark):
    p = catalog.predictor(spark, SF_SMALL)
    out = p.transform(texts(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Aggregate" not in plan
    twice = p.transform(texts(spark).unionByName(texts(spark)))
    assert twice.count() == 2 * out.count() and twice.distinct().count() == out.distinct().count()
    assert p.transform(texts(spark).limit(0)).count() == 0


def test_other_models_take_the_joins(spark, monkeypatch):
    td = catalog.training(spark, SF_SMALL)
    knn = Predictor(models.create_model("K-Nearest Neighbors").fit(td), td.vocab, td.options)
    assert not knn.scores_in_the_row()
    with pytest.raises(ValueError):
        st.append_stream(texts(spark), knn, "unused", "unused")
    nb = catalog.nb_model(spark, SF_SMALL)
    monkeypatch.setattr(rowscore, "BROADCAST_VOCAB_ROWS", 10)
    assert not Predictor(nb, td.vocab, td.options).scores_in_the_row()


def test_append_stream_equals_batch(spark):
    cols = ["conv_id", "turn", "prediction", "probability"]
    batch = catalog.QUERIES["predict_batch"](spark, SF_SMALL).select(*cols)
    stream = catalog.QUERIES["stream_append"](spark, SF_SMALL).select(*cols)
    assert sorted(batch.collect()) == sorted(stream.collect()) and batch.count() > 0
