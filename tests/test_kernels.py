"""F6 in the registry: kernel SVMs by name, their probabilities, one base for all gammas, the grid, and bundles."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from textsieve.operators import evaluate
from textsieve.plans import catalog, kernels, models, train
from textsieve.plans.predict import Predictor

SF_SMALL = "/root/testdata/sf0.001"
SVM = "Support Vector Machine"


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_map_stands_for_the_kernel(spark, kernel):
    """Products of mapped rows are near the kernel of the scaled rows, for several gammas from one base."""
    x = {1: {"a": 1.0, "b": 0.5}, 2: {"a": 0.8, "c": 0.6}, 3: {}, 4: {"b": 2.0, "c": 1.0}}
    std = {"a": 2.0, "b": 0.5, "c": 1.0}
    feats = spark.createDataFrame([(i, t, v) for i, r in x.items() for t, v in r.items()], "row_id bigint, term string, value double")
    docs = spark.createDataFrame([(i,) for i in x], "row_id bigint")
    vocab = spark.createDataFrame([(t,) for t in std], "term string")
    scale = spark.createDataFrame(list(std.items()), "term string, std double")
    base = None
    for gamma in (0.1, 0.5):
        m = kernels.KernelMap(kernel, gamma, vocab, scale, n_components=8192)
        base = m.base(docs, feats).persist() if base is None else base
        z = {r[0]: np.array(r[1]) for r in m.features(base).select("row_id", vector_to_array("features")).collect()}
        assert set(z) == set(x)
        own = {i: np.array([r.get(t, 0.0) / std[t] for t in std]) for i, r in x.items()}
        for i in x:
            for j in x:
                exact = math.exp(-gamma * ((own[i] - own[j]) ** 2).sum()) if kernel == "rbf" else (gamma * own[i] @ own[j]) ** 3
                assert abs(z[i] @ z[j] - exact) < 0.06 * max(1.0, abs(exact)), (kernel, gamma, i, j)


@pytest.mark.parametrize("kernel", ["rbf", "poly"])
def test_kernel_svm_by_name(spark, kernel, tmp_path):
    td = catalog.training(spark, SF_SMALL)
    model = models.create_model(SVM, {"kernel": kernel, "gamma": "auto"}).fit(td)
    sc = models.scored(model, td)
    got = sc.agg(F.count("*"), F.min("probability"), F.max("probability")).first()
    assert got[0] == td.docs_test.count() and 0 <= got[1] <= got[2] <= 1
    assert 0 <= evaluate.roc_auc(sc).first()[0] <= 1
    p = Predictor(model, td.vocab, td.options)
    texts = train.read_table(spark, SF_SMALL, "documents").select(F.col("doc_id").alias("row_id"), "text").limit(30)
    p.save(str(tmp_path / kernel))
    again = Predictor.load(spark, str(tmp_path / kernel))
    key = lambda q: {r.row_id: round(r.probability, 9) for r in q.transform(texts).collect()}
    assert key(again) == key(p)
    with pytest.raises(ValueError):
        p.top_features(3)


def test_grid_of_kernels(spark):
    td = catalog.training(spark, SF_SMALL)
    grid = {"C": [1.0], "kernel": ["linear", "rbf", "poly"], "gamma": ["scale", 1.0]}
    res, best = models.grid_search(SVM, td, grid, k=2)
    got = {r.params: r.mean_score for r in res.collect()}
    assert len(got) == 6 and set(best) == set(grid) and got[str(best)] == max(got.values())
    # a gamma means nothing to the linear kernel
    assert len({v for k, v in got.items() if "linear" in k}) == 1
    for wrong in ({"kernel": "sigmoid"}, {"gamma": "wide"}, {"gamma": -1.0}):
        with pytest.raises(ValueError):
            models.create_model(SVM, wrong)


def test_projection_and_sketch_do_not_move_arrays(spark, monkeypatch):
    """Entries move as numbers, runs are short, and both ways (weights sent to the tasks, or joined) give the same."""
    rng = np.random.default_rng(1)
    long = spark.createDataFrame([(int(i), f"t{t}", float(rng.random())) for i in range(40) for t in rng.choice(30, rng.integers(0, 9), False)],
                                 "row_id bigint, term string, value double")
    docs = spark.range(41).select(F.col("id").alias("row_id"))  # the last has no term
    vocab = spark.createDataFrame([(f"t{t}",) for t in range(30)], "term string")

    def both():
        z = {r.row_id: np.array(r.z) for r in kernels.rff_arrays(long, docs, vocab, 16, 0.5).collect()}
        x = {r[0]: np.array(r[1]) for r in kernels.tensor_sketch(long, docs, vocab, 3, 0.5, 1.0, 16).select("row_id", vector_to_array("features")).collect()}
        return z, x

    monkeypatch.setattr(kernels, "ROWS_AT_ONCE", 7)
    monkeypatch.setattr(kernels, "PRODUCTS_AT_ONCE", 5)
    plan = kernels.rff_arrays(long, docs, vocab, 16, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "Summarizer" not in plan and "aggregate_metrics" not in plan
    sent = both()
    monkeypatch.setattr(kernels, "BROADCAST_WEIGHTS", 0)
    joined = both()
    for a, b in zip(sent, joined):
        assert set(a) == set(b) == set(range(41))
        assert all(np.allclose(a[i], b[i], atol=1e-9) for i in a)
