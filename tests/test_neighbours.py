"""Nearest neighbours against comparing all pairs."""

import math
import random

import numpy as np
import pytest

from textsieve.operators import neighbours as N


def tables(spark, n_train, n_test, seed=0, empty=0.1, copies=True):
    """Random sparse rows: some equal, some without any term, some test rows with unknown terms."""
    rng = random.Random(seed)
    terms = [f"t{i}" for i in range(60)]

    def vector():
        if rng.random() < empty:
            return {}
        return {t: rng.choice([0.25, 0.5, 1.0, rng.random()]) for t in rng.sample(terms, rng.randint(1, 9)) if rng.random() < .8}

    train, test = {}, {}
    for i in range(n_train):
        v = dict(rng.choice(list(train.values()))[2]) if train and rng.random() < .2 else vector()
        train[i] = (rng.randint(0, 1), float(rng.choice([1, 1, 2, 9])) if copies else 1.0, v)
    for i in range(n_test):
        v = dict(rng.choice(list(train.values()))[2]) if train and rng.random() < .2 else vector()
        test[1000 + i] = v
    docs = spark.createDataFrame([(i, y, w) for i, (y, w, _) in train.items()], "row_id long, label int, weight double")
    feats = spark.createDataFrame([(i, y, w, t, x) for i, (y, w, v) in train.items() for t, x in v.items()],
                                  "row_id long, label int, weight double, term string, value double")
    known = sorted({t for _, _, v in train.values() for t in v})
    vocab = spark.createDataFrame([(t, i, sum(t in v for _, _, v in train.values())) for i, t in enumerate(known)],
                                  "term string, term_id long, df long")
    asked = spark.createDataFrame([(i,) for i in test], "row_id long")
    qfeats = spark.createDataFrame([(i, t, x) for i, v in test.items() for t, x in {**v, "unknown": 1.0}.items() if t in known],
                                   "row_id long, term string, value double")
    return train, test, docs, feats, vocab, asked, qfeats


def brute(train, test, k, weights, p):
    total = sum(w for _, w, _ in train.values())
    std = {}
    for t in {t for _, _, v in train.values() for t in v}:
        s, ss = (sum(w * v.get(t, 0) ** e for _, w, v in train.values()) for e in (1, 2))
        var = max(ss / total - (s / total) ** 2, 0)
        std[t] = math.sqrt(var) if var > 0 else 1.0
    near, prob = {}, {}
    for q, qv in test.items():
        order = []
        for x, (y, w, v) in train.items():
            diff = [abs(qv.get(t, 0) - v.get(t, 0)) / std[t] for t in {*qv, *v} if t in std]
            order.append((round(sum(d ** p for d in diff), 6), x, y, w))
        left, got = float(k), []
        for d, x, y, w in sorted(order):
            if left > 0:
                got.append((q, x, y, round(d if p == 1 else math.sqrt(d), 4), min(w, left)))
                left -= w
        near[q] = got
        here = any(g[3] == 0 for g in got)
        votes = [(g[2], g[4] if weights == "uniform" else (g[4] * (g[3] == 0) if here else g[4] / g[3])) for g in got]
        prob[q] = sum(v for y, v in votes if y) / sum(v for _, v in votes) if votes else None
    return near, prob


@pytest.mark.parametrize("k,weights,p", [(5, "uniform", 2), (7, "distance", 1), (1, "distance", 2), (3, "uniform", 1)])
def test_equals_all_pairs(spark, monkeypatch, k, weights, p):
    monkeypatch.setattr(N, "BLOCK_ROWS", 3)  # every term's list in many blocks
    train, test, docs, feats, vocab, asked, qfeats = tables(spark, 90, 40, seed=k + p)
    model = N.fit_knn(feats, docs, vocab, k, weights, p)
    near, prob = brute(train, test, k, weights, p)
    got = model.neighbours(asked, qfeats).collect()
    rows = sorted((r.row_id, r.neighbour, r.label, round(r.distance, 4), r.copies) for r in got)
    assert rows == sorted(r for v in near.values() for r in v)
    scored = {r.row_id: r for r in model.score(asked, qfeats).collect()}
    assert set(scored) == set(test)
    assert all(abs(scored[q].probability - v) < 1e-6 and scored[q].prediction == int(round(v, 9) > .5) for q, v in prob.items())


def test_edges(spark):
    # fewer copies than neighbours asked for; all rows without a term; no training rows
    for n, empty, k in ((3, 0.3, 50), (6, 1.0, 4), (8, 1.0, 30)):
        train, test, docs, feats, vocab, asked, qfeats = tables(spark, n, 5, seed=n, empty=empty)
        got = N.fit_knn(feats, docs, vocab, k).neighbours(asked, qfeats).collect()
        near, _ = brute(train, test, k, "uniform", 2)
        assert sorted((r.row_id, r.neighbour, r.copies) for r in got) == sorted((a, b, e) for v in near.values() for a, b, _, _, e in v)
    _, _, docs, feats, vocab, asked, qfeats = tables(spark, 3, 4)
    none = N.fit_knn(feats.limit(0), docs.limit(0), vocab)
    assert none.neighbours(asked, qfeats).count() == 0
    assert all(r.probability is None and r.prediction == 0 for r in none.score(asked, qfeats).collect())
    for bad in ({"p": 3}, {"weights": "near"}, {"n_neighbors": 0}):
        with pytest.raises(ValueError):
            N.fit_knn(feats, docs, vocab, **bad)


def test_few_pairs_are_candidates(spark):
    """Candidates are a small share of all pairs on the given tables, and grow far more slowly."""
    from textsieve.plans import train as T

    share = []
    for sf in ("sf0.001", "sf0.01"):
        td = T.prepare(T.labelled_messages(spark, f"/root/testdata/{sf}"))
        model = N.fit_knn(td.feats_train, td.docs_train, td.vocab)
        q = td.feats_test.join(model.std, "term").selectExpr("row_id as qid", "term", "value / std as v")
        pairs = model.candidates(td.docs_test.selectExpr("row_id as qid"), q).count()
        share.append(pairs / (td.docs_test.count() * model.rows.count()))
    assert share[1] < 0.2 and share[1] < share[0]


def test_registry_bundle_and_grid(spark, tmp_path):
    from textsieve.plans import models, predict
    from textsieve.plans import train as T

    td = T.prepare(T.labelled_messages(spark, "/root/testdata/sf0.001"))
    model = models.create_model("K-Nearest Neighbors").fit(td)
    p = predict.Predictor(model, td.vocab, td.options)
    p.save(str(tmp_path / "b"))
    texts = spark.createDataFrame([(1, "some text of the and"), (2, None), (3, "unknownword")], "row_id long, text string")
    one = {r.row_id: r.probability for r in p.transform(texts).collect()}
    two = {r.row_id: r.probability for r in predict.Predictor.load(spark, str(tmp_path / "b")).transform(texts).collect()}
    assert one == two and set(one) == {1, 2, 3}
    res, best = models.grid_search("K-Nearest Neighbors", td, {"n_neighbors": [3, 5], "weights": ["distance"], "p": [1]}, k=2)
    assert res.count() == 2 and best["n_neighbors"] in (3, 5)


def test_blocks_meet_every_row_of_each_other():
    """Blocks against plain loops: dense and sparse terms, a term that a row has twice, ties in the order of the rows."""
    rng = np.random.default_rng(3)

    def block(n, first):
        size = rng.integers(0, 7, n)
        place = np.concatenate([np.r_[0, rng.integers(1, 40, s - 1)] if s else np.empty(0, int) for s in size]).astype(int)
        value = rng.choice([0.25, 0.5, 2.0], len(place))
        return {"id": np.arange(first, first + n), "start": np.r_[0, np.cumsum(size)], "place": place, "value": value}

    q, x = block(30, 100), block(50, 0)
    rows = lambda b, i: list(zip(b["place"][b["start"][i]:b["start"][i + 1]], b["value"][b["start"][i]:b["start"][i + 1]]))
    for p in (1, 2):
        for b in (q, x):
            b["norm"] = np.array([sum(v ** p for _, v in rows(b, i)) for i in range(len(b["id"]))])
        want = []
        for i in range(30):
            overlap = [sum((min(v, w) if p == 1 else v * w) for t, v in rows(q, i) for s, w in rows(x, j) if s == t) for j in range(50)]
            far = [(round(max(q["norm"][i] + x["norm"][j] - 2 * overlap[j], 0), 6), j) for j in range(50)]
            want += [(i, j, d) for d, j in sorted(far)[:4]]
        assert [(i, j, d) for part in N._nearest(q, x, 4, p) for i, j, d in zip(*(c.tolist() for c in part))] == want


def test_scoring_does_not_join_pairs(spark, monkeypatch):
    """What meets is blocks, not a row for each shared term: no candidates are listed."""
    monkeypatch.setattr(N.KNNModel, "candidates", None)
    train, test, docs, feats, vocab, asked, qfeats = tables(spark, 12, 4)
    assert N.fit_knn(feats, docs, vocab, 3).score(asked, qfeats).count() == len(test)
