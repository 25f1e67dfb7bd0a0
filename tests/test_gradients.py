"""Logistic regressions that share their passes (F4, F17, F18): packed rows, the solver, folds and scales, the grid."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from textsieve.operators import evaluate, gradients, sampling
from textsieve.plans import catalog, models

SF_SMALL = "/root/testdata/sf0.001"
LR = "Logistic Regression"


def corpus(spark, seed=3, rows=60, terms=12):
    """Random documents, two of them without a term, with copies as weights; the same as dense arrays."""
    rng = np.random.default_rng(seed)
    x = rng.integers(1, 6, (rows, terms)) * (rng.random((rows, terms)) < 0.4)
    x[[0, 1]] = 0
    label = (x[:, 0] + x[:, 1] - x[:, 2] + rng.normal(0, 2, rows) > 1).astype(int)
    weight, fold = rng.integers(1, 4, rows).astype(float), np.arange(rows) % 3
    docs = spark.createDataFrame([(i, int(label[i]), float(weight[i]), int(fold[i])) for i in range(rows)],
                                 "row_id bigint, label int, weight double, fold int")
    feats = spark.createDataFrame([(i, int(j), float(x[i, j])) for i in range(rows) for j in range(terms) if x[i, j]],
                                  "row_id bigint, term_id bigint, value double")
    return docs, feats, x.astype(float), label, weight, fold


def test_packed_rows_hold_every_entry_once(spark, monkeypatch):
    docs, feats, x, label, weight, fold = corpus(spark)
    blocks = gradients.pack(docs, feats)

    def work(own, _, total):
        for b in own:
            for p in b.pieces(7):  # rows have up to 12 entries
                p.add_transposed(total[2:].reshape(12, 1), p.weight[:, None])
                total[0] += len(p)
                total[1] += p.times(np.ones((12, 1))).sum()
        return True

    monkeypatch.setattr(gradients, "CHUNK", 5)
    got = gradients.summed(blocks, 14, work)
    assert np.allclose(got, [60, x.sum(), *(weight @ x)])
    gradients.release(blocks)


def test_sums_move_as_bytes_and_entries_that_come_twice_add_up(spark, monkeypatch):
    """A pass's sums go to their Arrow groups as bytes, never as arrays of the JVM."""
    docs, feats, *_ = corpus(spark)
    blocks = gradients.pack(docs, feats)
    schemas, real = [], type(blocks).mapInArrow
    monkeypatch.setattr(type(blocks), "mapInArrow", lambda self, f, schema, *a, **k: schemas.append(schema) or real(self, f, schema, *a, **k))
    monkeypatch.setattr(gradients, "CHUNK", 3)

    def work(own, _, total):
        total += np.arange(8) * sum(len(b) for b in own)
        return True

    assert gradients.summed(blocks, 8, work).tolist() == (np.arange(8) * 60).tolist()
    assert gradients.summed(blocks, 8, lambda own, _, total: False).tolist() == [0.0] * 8
    assert schemas == ["chunk int, sums binary"] * 2
    gradients.release(blocks)
    one = np.ones(2)
    piece = gradients.DensePiece.of(gradients.Block(one, one, one, np.array([0, 3, 3]), np.array([2, 2, 0], "i4"), np.array([1.0, 2.0, 5.0])), 4)
    assert piece.x.tolist() == [[5.0, 0.0, 3.0, 0.0], [0.0] * 4]


def test_scales_leave_the_fold_out(spark, monkeypatch):
    docs, feats, x, label, weight, fold = corpus(spark)
    blocks = gradients.pack(docs, feats)
    monkeypatch.setattr(gradients, "AT_ONCE", 30)  # terms in ranges of 5
    got = gradients.fold_scales(blocks, 12, gradients.class_weights(blocks, 3))
    for f in range(4):
        keep = fold != f
        mean = np.average(x[keep], axis=0, weights=weight[keep])
        std = np.sqrt(np.average((x[keep] - mean) ** 2, axis=0, weights=weight[keep]))
        assert np.allclose(got[f], np.where(std > 0, std, 1.0)), f


@pytest.mark.parametrize("penalty", ["l1", "l2"])
def test_equals_a_separate_fit(spark, penalty, monkeypatch):
    """Coefficients and held-out scores of fits in shared passes, in groups of two, and of Spark's own solver one by one."""
    docs, feats, x, label, weight, fold = corpus(spark)
    blocks = gradients.pack(docs, feats)
    fits = [gradients.LogisticFit(0.1, penalty, False, 0), gradients.LogisticFit(1.0, penalty, True, 2),
            gradients.LogisticFit(1.0, penalty, False, 1)]
    whole, f1, _ = gradients.fit_logistic(blocks, 12, fits, 3, 1e-5)
    monkeypatch.setattr(gradients, "AT_ONCE", 2 * 13)
    grouped, again, _ = gradients.fit_logistic(blocks, 12, fits, 3, 1e-5)
    assert np.allclose(whole, grouped, atol=1e-4) and f1 == pytest.approx(again)
    scales = gradients.fold_scales(blocks, 12, gradients.class_weights(blocks, 3))
    for at, fit in enumerate(fits):
        keep = fold != fit.fold
        w = weight[keep].copy()
        if fit.balanced:
            by = {c: w[label[keep] == c].sum() for c in (0, 1)}
            w *= np.array([w.sum() / (2 * by[c]) for c in label[keep]])
        rows = spark.createDataFrame([(Vectors.dense(r / scales[fit.fold]), float(y), float(v)) for r, y, v in
                                      zip(x[keep], label[keep], w)], ["features", "label", "weight"])
        own = LogisticRegression(maxIter=1000, tol=1e-8, regParam=1 / (fit.c * int(w.sum())), standardization=False,
                                 elasticNetParam=float(penalty == "l1"), weightCol="weight").fit(rows)
        assert np.allclose(whole[at], [*own.coefficients, own.intercept], atol=2e-3), fit
        z = x[~keep] / scales[fit.fold] @ own.coefficients.toArray() + own.intercept
        yes, real, v = z > 0, label[~keep] == 1, weight[~keep]
        tp, wrong = v[yes & real].sum(), v[yes != real].sum()
        assert math.isclose(f1[at], 2 * tp / (2 * tp + wrong) if tp else 0.0, abs_tol=1e-9)


def test_no_rows_and_one_class(spark):
    empty = gradients.pack(spark.createDataFrame([], "row_id bigint, label int, weight double, fold int"),
                           spark.createDataFrame([], "row_id bigint, term_id bigint, value double"))
    coefficients, f1, _ = gradients.fit_logistic(empty, 4, [gradients.LogisticFit(fold=0)], 2, 1e-6)
    assert not coefficients.any() and f1 == [0.0]
    docs = spark.createDataFrame([(1, 1, 1.0, 0), (2, 1, 1.0, 1)], "row_id bigint, label int, weight double, fold int")
    feats = spark.createDataFrame([(1, 0, 2.0)], "row_id bigint, term_id bigint, value double")
    blocks = gradients.pack(docs, feats)
    coefficients, f1, _ = gradients.fit_logistic(blocks, 1, [gradients.LogisticFit(fold=0), gradients.LogisticFit(fold=1, balanced=True)], 2, 1e-6)
    assert np.isfinite(coefficients).all() and f1 == [1.0, 1.0]


def test_grid_scores_are_those_of_separate_fits(spark):
    """The grid's mean F1 against estimators of the registry, fitted fold by fold on the vectors of that fold."""
    td = catalog.training(spark, SF_SMALL)
    grid = {"C": [0.1], "penalty": ["l2"], "class_weight": [None, "balanced"], "solver": ["liblinear", "saga"]}
    res, best = models.grid_search(LR, td, grid, k=2)
    got = {r["params"]: r["mean_score"] for r in res.collect()}
    assert len(got) == 4 and max(got.values()) == got[str(best)]
    which = sampling.kfold_assign(td.docs_train.select("row_id", "label"), 2).select("row_id", "fold").checkpoint()
    own = []
    for f in range(2):
        part = models.fold_data(td, which, f)
        model = models.create_model(LR, {"penalty": "l2", "C": 0.1}).fit(part)
        own.append(evaluate.binary_metrics(models.scored(model, part), weight_col="weight").first()["f1"])
    key = str({"C": 0.1, "penalty": "l2", "class_weight": None, "solver": "saga"})
    assert got[key] == pytest.approx(sum(own) / 2, abs=0.02)
