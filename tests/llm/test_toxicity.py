import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from textsieve.llm import toxicity as T

from .data import EDGES, table

WORDS = ["stone", "river", "and", "the", "Été", "日本", "of", "walks", "green"]
BAD = {"en": ["vilest", "rotter"], "de": ["schuft", "schufte", "schuftig"]}


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "en", "de", None])
        ws = [rng.choice(WORDS) + rng.choice(["", "", ",", ".\n"]) for _ in range(rng.randrange(1, 120))]
        toxic = int(rng.random() < .3)
        if toxic:
            ws[rng.randrange(len(ws))] = rng.choice(BAD.get(lang, BAD["en"])) + rng.choice(["", "!", ","])
        rows.append((i, " ".join(ws), lang, "s", 1))
        labels.append((i, None, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def model():
    rows, labels = corpus()
    learn = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    return T.fit([rows[i][1] for i in learn], np.array([labels[i][2] for i in learn]), [rows[i][2] for i in learn])


def plain_score(m, text):
    """The score of one text by plain loops."""
    words, w = [], b""
    for b in text.encode():
        c = bytes([b]).lower()
        if T.CLASSES[b] == 0:
            w += c
        elif w:
            words, w = words + [w], b""
    words += [w] if w else []
    v = [m.table[r].mean(0) for r in T.buckets_of(words)] + [np.zeros(T.DIM)] * max(T.WIDTHS)
    h = []
    for kernel, bias in zip(m.kernels, m.biases):
        for f in range(kernel.shape[2]):
            h.append(max(0.0, max(bias[f] + sum(v[i + j] @ kernel[j, :, f] for j in range(len(kernel)))
                                  for i in range(len(words) + 1))))
    x = m.scale * (np.array(h) @ m.out + m.intercept) + m.shift
    return 1 / (1 + np.exp(-x))


def test_scores_equal_plain_convolution(model):
    texts = ["", "stone", " . ", "the vilest of\nrivers", "Schuftig! 日本 and so on, and on.", " ".join(WORDS * 20)]
    got = model.score_texts(pa.array(texts, pa.large_string()))
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-4)
    # a text's score does not depend on what else is in its batch
    alone = [model.score_texts(pa.array([t], pa.large_string()))[0] for t in texts]
    assert np.allclose(got, alone, atol=1e-6)


def test_held_out_accuracy(spark, model):
    rows, labels = corpus()
    got = {r.doc_id: r for r in T.scored(table(spark, rows, ["score", "threshold", "flagged"]), model).collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2} == set(held) and len(held) > 80
    right = [got[i].predicted == labels[i][2] for i in held]
    assert np.mean(right) > 0.95
    assert np.mean([got[i].flagged == bool(labels[i][2]) for i in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.3) and r.flagged == (r.score >= r.threshold) for r in got.values())
    # the language decides the threshold, never the score
    other = T.scored(table(spark, [(i, t, "xx", "y", 0) for i, t, *_ in rows]), model).collect()
    assert all(abs(r.score - got[r.doc_id].score) < 1e-6 and r.threshold == model.threshold for r in other)


def test_training_rows(spark):
    rows, labels = corpus(120)
    extra = [(1, None, 1), (1, None, 1), (None, None, 1), (5000, None, 1), (7, None, None)]
    marks = spark.createDataFrame(labels + extra, "doc_id long, quality int, toxic int")
    long = [(i, "word " * 30_000 if i == 4 else t, *r) for i, t, *r in rows] + [rows[3]]
    got = T.training_rows(table(spark, long, ["k", "y", "t"]), marks, max_rows=15)
    assert got["k"].is_unique and 4 not in set(got["k"]) and (got["y"].value_counts() <= 15).all()
    assert all(zlib.crc32(str(k).encode()) % 4 != 2 for k in got["k"])
    assert set(T.training_rows(table(spark, []), marks).columns) == {"k", "y", "t", "lang", "w"}


def test_edges(spark, model):
    got = T.scored(table(spark, EDGES), model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    by = {}
    for r, (i, t, *_) in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(EDGES, key=lambda r: str(r[0]))):
        by.setdefault(i, []).append(r.score)
    assert len({round(by[i][0], 9) for i in (1, 2, 3)}) == 1  # null, empty and blank texts
    assert T.scored(table(spark, []), model).count() == 0
    assert T.fit([], np.zeros(0)).score_texts(pa.array(["x"], pa.large_string()))[0] == 0.5
    one = T.fit(["a", "b"], np.ones(2)).score_texts(pa.array(["x"], pa.large_string()))[0]
    assert one == pytest.approx(0.75)


def test_thresholds():
    y = np.array([1, 1, 0, 0, 1])
    assert T.best_threshold(np.array([.9, .8, .3, .2, .7]), y, np.ones(5)) == pytest.approx(.5)
    assert T.best_threshold(np.array([.1, .2]), np.zeros(2), np.ones(2)) == T.ACCEPT
    # equal scores are on one side
    assert T.best_threshold(np.full(5, .4), y, np.ones(5)) == pytest.approx(.4)


def test_learns_from_every_labelled_row(spark, monkeypatch):
    """no row and no text is left out of the fit, and thresholds come from all rows put aside."""
    rows, labels = corpus(1500, seed=5)
    rows[4] = (4, "word " * 30_000 + rows[4][1], *rows[4][2:])
    docs = table(spark, rows + [rows[3]])
    marks = spark.createDataFrame(labels + [(1, None, None), (None, None, 1), (9999, None, 1)], "doc_id long, quality int, toxic int")
    learn = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    all_rows = T.labelled(docs, marks)
    blocks, k = T.shards(all_rows, 400)
    got = list(T._blocks(blocks.toArrow().to_batches()))
    assert k == 3 and len(got) == 3
    assert sum(len(b[1]) for b in got) == len(learn) and sum(b[1].sum() for b in got) == sum(labels[i][2] for i in learn)
    assert 4 in learn and max(np.diff(b[4]).max() for b in got) > 30_000
    seen = []
    monkeypatch.setattr(T, "_scale_and_shift", lambda sums: seen.append(sums(0.0, 0.0)) or (1.0, 0.0))
    T._calibrate_all(T.fit([], np.zeros(0)), blocks, False)
    assert seen[0][4] == pytest.approx(0.25 * sum(b[2].sum() for b in got))  # each row put aside once
    monkeypatch.undo()
    model = T.fit_all(all_rows, 400)
    out = {r.doc_id: r for r in T.scored(docs, model).collect()}
    held = [i for i, r in out.items() if r.held_out]
    assert np.mean([out[i].predicted == labels[i][2] for i in held]) > 0.95
    assert np.mean([out[i].flagged == bool(labels[i][2]) for i in held]) > 0.95
    assert set(model.thresholds) <= {"en", "de"} and model.thresholds


def test_fit_all_of_few_labels(spark):
    rows, labels = corpus(30)
    docs = table(spark, rows)
    schema = "doc_id long, quality int, toxic int"
    none = T.fit_all(T.labelled(docs, spark.createDataFrame([], schema)))
    assert none.score_texts(pa.array(["x"], pa.large_string()))[0] == 0.5
    ids = [i for i in range(30) if zlib.crc32(str(i).encode()) % 4 != 2]
    one = T.fit_all(T.labelled(docs, spark.createDataFrame([(i, None, 1) for i in ids[:2]], schema)))
    assert one.score_texts(pa.array(["x"], pa.large_string()))[0] == pytest.approx(0.75)
    two = T.fit_all(T.labelled(docs, spark.createDataFrame([(i, None, int(j == 0)) for j, i in enumerate(ids[:3])], schema)))
    assert 0 <= two.score_texts(pa.array(["x"], pa.large_string()))[0] <= 1
