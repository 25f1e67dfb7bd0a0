"""Library surfaces without a registered query: sinks, registry, lookup."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from textsieve.plans import catalog, models, predict
from textsieve.sources import io


def test_registry_and_factory():
    assert len(models.REGISTRY) == 10
    assert models.RECOMMENDED == ["Multinomial Naive Bayes", "Bernoulli Naive Bayes", "Logistic Regression",
                                  "Support Vector Machine"]
    got = models.get_models(["Logistic Regression", "No Such Model"], {"Logistic Regression": {"C": 10.0}})
    assert list(got) == ["Logistic Regression"] and got["Logistic Regression"]["C"] == 10.0
    with pytest.raises(ValueError):
        models.create_model("No Such Model")
    with pytest.raises(ValueError):
        models.create_model("Random Forest", {"max_leaf_nodes": 5})


def test_sinks_and_single_message(spark):
    pr = catalog.predictor(spark, SF_SMALL)
    one = pr.predict_one(spark, "Win a prize now").collect()
    assert len(one) == 1 and one[0]["label"] in ("spam", "ham")
    conv = catalog.tbl(spark, SF_SMALL, "conversations").select("conv_id", "turn", "text").limit(5)
    pred = pr.transform(conv, "text", ("conv_id", "turn"))
    d = tempfile.mkdtemp(prefix="sinks-")
    io.write_predictions_json(pred, f"{d}/json")
    io.write_predictions_text(pred, f"{d}/txt")
    recs = spark.read.json(f"{d}/json").collect()
    assert len(recs) == 5 and {"text", "prediction", "label", "probability", "confidence"} <= set(recs[0].asDict())
    lines = spark.read.text(f"{d}/txt").collect()
    assert sum(1 for r in lines if r[0].startswith("Classification: ")) == 5


def test_latest_model_lookup(spark):
    reg = spark.createDataFrame(
        [("mnb", "/m/a", None, 1, 0.5), ("mnb", "/m/b", "/v/b", 3, 0.4), ("bnb", "/m/c", None, 2, 0.9)],
        "name string, path string, vocab_path string, created_at int, metric double")
    assert predict.latest_model(reg).first()["path"] == "/m/b"
    assert predict.latest_model(reg, "bnb").first()["vocab_path"] == "/m/c"
    assert predict.latest_model(reg, by="metric").first()["name"] == "bnb"


def test_message_file_sources(spark):
    d = tempfile.mkdtemp(prefix="lines-")
    with open(f"{d}/m.txt", "w") as f:
        f.write("  first message \n\n\tsecond\n   \n")
    rows = [r[0] for r in io.read_message_lines(spark, f"{d}/m.txt").collect()]
    assert rows == ["first message", "second"]
    whole = io.read_whole_file(spark, f"{d}/m.txt").collect()
    assert len(whole) == 1 and whole[0][0].startswith("  first")
    with pytest.raises(FileNotFoundError):
        io.load_csv(spark, f"{d}/missing.csv")


def test_csv_traps(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(f"{d}/t.csv", "wb") as f:
        f.write(b'v1,v2,,\nham,"he said ""hi"", ok",,\nspam,"line one\nline two",,\nham,\xa3 cheap,,\nham,NA,,\n')
    df = io.load_and_preprocess(spark, f"{d}/t.csv")
    rows = [tuple(r) for r in df.collect()]
    assert rows[0] == (0, 'he said "hi", ok') and rows[1] == (1, "line one\nline two")
    assert rows[2] == (0, "£ cheap") and len(rows) == 4
    compat = io.load_and_preprocess(spark, f"{d}/t.csv", na_values=io.PANDAS_NA_VALUES)
    assert compat.count() == 3


def test_top_importances(spark):
    from textsieve.operators import rank

    imp = spark.createDataFrame([("a", 0.1), ("b", 0.5), ("c", 0.5), ("d", 0.0)], "term string, importance double")
    out = [tuple(r) for r in rank.top_importances(imp, 3).collect()]
    assert out == [(1, "b", 0.5), (2, "c", 0.5), (3, "a", 0.1)]


def test_tensor_sketch_approximates_poly_kernel(spark):
    """<TS(x), TS(y)> estimates (gamma <x, y> + coef0)^3 without bias; with
    many components the estimate is close."""
    import numpy as np

    from textsieve.plans import kernels

    long = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "a", 0.5), (2, "c", 0.5), (2, "b", 0.7)],
                                 "row_id bigint, term string, value double")
    docs = spark.createDataFrame([(1,), (2,)], "row_id bigint")
    vocab = spark.createDataFrame([("a",), ("b",), ("c",)], "term string")
    ts = {r["row_id"]: np.array(r["features"].toArray())
          for r in kernels.tensor_sketch(long, docs, vocab, 3, 1.0, 1.0, 4096).collect()}
    x = {"a": 0.6, "b": 0.8}
    y = {"a": 0.5, "c": 0.5, "b": 0.7}
    for u, v, i, j in ((x, x, 1, 1), (x, y, 1, 2)):
        exact = (sum(u[t] * v.get(t, 0.0) for t in u) + 1.0) ** 3
        assert abs(float(ts[i] @ ts[j]) - exact) / exact < 0.25
