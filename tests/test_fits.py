"""Fits that scale (F4, F7, F18, F19, F22, F23, F25, F26, F27, F29): the cleaner's passes, features written once, dense
pieces, the network on packed rows, fits side by side, the Gaussian grid in one plan."""

import math
import threading

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textsieve.functions import text as T
from textsieve.operators import bayes, evaluate, gradients, sampling
from textsieve.plans import models, run, train
from textsieve.config import Options


def messages(spark, rows=60, seed=5):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "gamma", "delta", "offer", "prize", "meet", "lunch", "call", "win"]
    out = []
    for i in range(rows):
        label = int(i % 3 == 0)
        p = np.array([1, 1, 1, 1, 4, 4, 1, 1, 2, 3] if label else [2, 2, 2, 2, 1, 1, 4, 4, 2, 1], float)
        out.append((i, " ".join(rng.choice(words, 8, p=p / p.sum())), label))
    return spark.createDataFrame(out, "row_id bigint, message string, label int")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_cleaner_takes_whitespace_and_punctuation_in_one_pass(spark):
    """the same texts as by a class of all whitespace, which is no longer matched."""
    odd = [None, "", " a 　b ", "x1 2 3y", "\x1c1\x1d", "a-  -b\r\n\tc", "see http://a.b/c?d e <b\n>f<i>", "   \u00851١", "a .  . b"]
    df = spark.createDataFrame([(t,) for t in odd], "t string")
    before = F.lower(F.coalesce("t", F.lit("")))
    for pattern, to in ((T.URL_PATTERN_EXACT, ""), (T.TAG_PATTERN, ""), (r"[!-/:-@\[-`{-~]", ""), (r"\p{Nd}+", ""), (f"[{T.WHITESPACE_CLASS}]+", " ")):
        before = F.regexp_replace(before, pattern, to)
    rows = df.select(T.clean_text("t").alias("now"), F.trim(before).alias("then")).collect()
    assert [r.now for r in rows] == [r.then for r in rows]
    assert f"[{T.WHITESPACE_CLASS}]+" not in plan(df.select(T.clean_text("t")))


def test_counts_and_features_are_tables(spark):
    """no model of a run joins, shuffles and sorts the counts again."""
    td = train.prepare(messages(spark), Options(min_df=1))
    assert "parquet" in plan(td.counts) and "Window" in plan(td.feats_train)
    made = run.train_models(None, ["Multinomial Naive Bayes"], td=td)
    assert "Window" not in plan(made.td.feats_train) and "Window" not in plan(made.td.feats_test)
    assert sorted(map(str, made.td.feats_test.collect())) == sorted(map(str, td.feats_test.collect()))


def test_svm_folds_are_fitted_side_by_side(spark, monkeypatch):
    """each fit waits for the other three."""
    rows = spark.createDataFrame([(i, i % 2, 1.0, Vectors.dense([i % 2 + 0.1 * (i % 7), 1.0])) for i in range(40)],
                                 ["row_id", "label", "weight", "features"])
    alone = [models.fit_platt_svm(LinearSVC(maxIter=20, weightCol="weight"), rows)]
    meet, own = threading.Barrier(4, timeout=60), LinearSVC.fit
    monkeypatch.setattr(LinearSVC, "fit", lambda self, df, params=None: (meet.wait(), own(self, df))[1])
    svm, platt = models.fit_platt_svm(LinearSVC(maxIter=20, weightCol="weight"), rows)
    assert np.allclose(svm.coefficients, alone[0][0].coefficients) and np.allclose(platt.coefficients, alone[0][1].coefficients)


def test_boosted_rows_are_dealt_by_their_dense_size(spark, monkeypatch):
    """only where there are too few partitions."""
    td, seen, own = train.prepare(messages(spark), Options(min_df=1)), [], GBTClassifier.fit
    monkeypatch.setattr(models, "DENSE_BYTES", 100)
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, params=None: (seen.append(df.rdd.getNumPartitions()), own(self, df))[1])
    models.create_model("Gradient Boosting", {"n_estimators": 2}).fit(td)
    assert seen == [math.ceil(td.docs_train.count() * td.vocab.count() * 4 / 100)]


def test_gaussian_grid_is_one_plan(spark, monkeypatch):
    """equal to fits of each fold and value, none of which is made."""
    td = train.prepare(messages(spark), Options(min_df=1))
    which = sampling.kfold_assign(td.docs_train.select("row_id", "label"), 3).select("row_id", "fold").checkpoint()
    want = {}
    for f in range(3):
        part = models.fold_data(td, which, f)
        for v in (1e-9, 0.5):
            sc = models.scored(bayes.fit_gaussian(part.feats_train, part.docs_train, part.vocab, v), part)
            want.setdefault(v, []).append(evaluate.binary_metrics(sc, weight_col="weight").first()["f1"])

    def none(*a, **k):
        raise AssertionError("a fit of its own")

    monkeypatch.setitem(bayes.FITTERS, "gaussian", none)
    res, _ = models.grid_search("Gaussian Naive Bayes", td, {"var_smoothing": [1e-9, 0.5]}, k=3)
    got = [(r["mean_score"], r["min_score"], r["max_score"]) for r in res.collect()]
    assert np.allclose(got, [(np.mean(s), min(s), max(s)) for s in want.values()])


def packed(spark, x, label, weight):
    n, t = x.shape
    docs = spark.createDataFrame([(i, int(label[i]), float(weight[i]), i % 2) for i in range(n)], "row_id bigint, label int, weight double, fold int")
    feats = spark.createDataFrame([(i, j, float(x[i, j])) for i in range(n) for j in range(t) if x[i, j]],
                                  "row_id bigint, term_id bigint, value double")
    return gradients.pack(docs, feats)


def sample(n=50, t=9, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.random((n, t)) * (rng.random((n, t)) < 0.5)
    x[0] = 0
    return x, (x[:, 0] > x[:, 1]).astype(int), rng.integers(1, 4, n).astype(float)


def test_dense_pieces_equal_sparse_ones(spark, monkeypatch):
    """loss and gradient of ten fits, whichever way the products are made."""
    x, label, weight = sample()
    blocks = packed(spark, x, label, weight)
    w = np.random.default_rng(1).normal(size=(10, 10))
    shared, out = (w, np.arange(10) % 2, np.ones((2, 10))), []
    used = []
    monkeypatch.setattr(gradients, "DENSE_NUMBERS", 40)
    for models_at_least in (1, 11):
        monkeypatch.setattr(gradients, "DENSE_MODELS", models_at_least)
        out.append(gradients.summed(blocks, 110, gradients._losses, shared))
        b = gradients.Block(label.astype(float), weight, np.zeros(50, int), np.r_[0, np.cumsum((x > 0).sum(axis=1))], np.nonzero(x)[1], x[x > 0])
        used.append({type(p) for p in b.pieces_for(9, 10)})
    assert np.allclose(*out) and used == [{gradients.DensePiece}, {gradients.Block}]


def test_network_on_packed_rows(spark):
    """the gradient is the loss's; Spark's model of these weights has that loss, copies counted; descent lowers it."""
    x, label, weight = sample()
    blocks, layers = packed(spark, x, label, weight), [9, 4, 2]
    start = np.random.default_rng(3).normal(size=9 * 4 + 4 + 4 * 2 + 2)
    out = gradients.summed(blocks, len(start) + 1, gradients._network, (start, layers))
    for i in (0, 7, 36, 41, 49):
        step = np.eye(len(start))[i] * 1e-5
        up, down = (gradients.summed(blocks, len(start) + 1, gradients._network, (start + s, layers))[0] for s in (step, -step))
        assert math.isclose(out[1 + i], (up - down) / 2e-5, rel_tol=1e-4, abs_tol=1e-6)
    weights, losses = gradients.fit_network(blocks, layers, start, 40, 1e-6)
    assert losses[0] == pytest.approx(out[0] / weight.sum()) and losses[-1] < 0.5 * losses[0]
    again, few = gradients.fit_network(blocks, layers, start, 3, 1e-6)
    assert len(few) <= 4


def test_network_of_the_registry_is_sparks_model_of_its_weights(spark, monkeypatch):
    """no row is copied or kept dense, and the fitted weights are scored as they were fitted."""
    td, own, seen = train.prepare(messages(spark), Options(min_df=1)), gradients.fit_network, []
    monkeypatch.setattr(gradients, "fit_network", lambda *a: seen.append(own(*a)) or seen[-1])
    model = models.create_model("Neural Network", {"hidden_layer_sizes": (3,), "max_iter": 30}).fit(td)
    (weights, losses), = seen
    assert np.allclose(model.stages[0].weights.toArray(), weights) and losses[-1] < losses[0]
    sc = model.score(td.docs_train, td.feats_train).collect()
    loss = -sum(r["weight"] * math.log(r["probability"] if r["label"] else 1 - r["probability"]) for r in sc) / sum(r["weight"] for r in sc)
    assert loss == pytest.approx(losses[-1], rel=1e-6)
