"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is binned. Shallow trees on one feature at a time are
boosted in cycles, with a small step, and their leaves add up to one lookup
table per feature; then the strongest pairs of features get a table of bins by
bins in the same way. A score is the sum of table entries. Texts are read in
Arrow batches, binned and added up with vectorised operations; the model is
fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import read, text_batches
from textsieve.llm.quality_rules import CLASSES, OTHER_WORD, class_counts, word_counts, words_of

#: At most so many labelled rows, the first by the md5 of their id, are used to fit. The bound of the driver's memory.
MAX_TRAIN_ROWS = 20_000
MAX_BINS, ROUNDS, STEP, LEAVES = 32, 200, 0.1, 3
PAIRS, PAIR_ROUNDS, PAIR_BINS = 8, 60, 8
HOLD_OUT, FOLDS = 2, 4

FEATURES = ("log_words", "word_length", "log_longest_word", "lower", "upper", "digits", "punctuation", "symbols", "unusual",
            "words_with_letters", "common_words", "log_words_per_line", "duplicate_lines", "repeated_windows", "distinct_words",
            "top_word", "equal_neighbours", "capitalised", "sentence_ends", "exclamations")


def features_of(text: str | None) -> list[float]:
    """``FEATURES`` of a whole text; all shares of an empty text are 0."""
    text = text or ""
    words = words_of(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = class_counts(text)
    chars = max(1, int(counts.sum()))
    share = {c: counts[i] / chars for i, c in enumerate(CLASSES[:-1])}
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    freq = np.bincount(ids)
    repeated = 0
    if n > 3 and len(seen) < n:
        key = (ids[:-2] * len(seen) + ids[1:-1])
        _, key = np.unique(key, return_inverse=True)
        _, key, times = np.unique(key * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        twice = times[key] > 1
        covered = np.zeros(n, dtype=bool)
        for i in range(3):
            covered[i:i + len(twice)] |= twice
        repeated = int(covered.sum())
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    vocab = list(seen)
    has_letter = np.array([not w.isascii() or w.lower() != w.upper() for w in vocab])
    capital = np.array([w[:1].isupper() for w in vocab])
    ends = np.array([w.endswith((b".", b"?")) for w in vocab])
    shouts = np.array([w.endswith(b"!") for w in vocab])
    lengths = np.array([len(w) for w in vocab])
    letters = share["lower"] + share["upper"] + share["letter"]
    common = word_counts(words)
    return [
        np.log1p(n), float(freq @ lengths) / n, np.log1p(lengths.max()), share["lower"],
        share["upper"] / letters if letters else 0.0,
        sum(text.count(d) for d in "0123456789") / max(1, len(text)), share["punctuation"], share["symbol"], share["other"],
        float(freq @ has_letter) / n, 1 - common[OTHER_WORD] / n, np.log1p(n / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), repeated / n, len(seen) / n, float(freq.max()) / n,
        float((ids[1:] == ids[:-1]).sum()) / n, float(freq @ capital) / n, float(freq @ ends) / n, float(freq @ shouts) / n,
    ]


@dataclass
class AdditiveModel:
    """``intercept``, for each feature its bin ``edges`` and ``table``, and for each pair ``(i, j)`` a table over coarse bins."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(x), self.intercept)
        bins = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)]
        for b, t in zip(bins, self.tables):
            total += t[b]
        for (i, j), t in self.pairs.items():
            total += t[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_cuts(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values by bin of a tree of ``leaves`` leaves over ordered bins, grown by best gain."""
    spans = [(0, len(grad))]
    gain_of = lambda g, h: g * g / (h + ridge)
    while len(spans) < leaves:
        best = (1e-9, None, 0)
        for s, (a, b) in enumerate(spans):
            if b - a < 2:
                continue
            g, h = np.cumsum(grad[a:b]), np.cumsum(hess[a:b])
            gain = gain_of(g[:-1], h[:-1]) + gain_of(g[-1] - g[:-1], h[-1] - h[:-1]) - gain_of(g[-1], h[-1])
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), s, a + k + 1)
        if best[1] is None:
            break
        a, b = spans.pop(best[1])
        spans += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(grad))
    for a, b in spans:
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + ridge)
    return out


def _best_quadrants(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that cuts each axis of a bins-by-bins table once."""
    cg, ch = np.zeros(np.add(grad.shape, 1)), np.zeros(np.add(hess.shape, 1))
    cg[1:, 1:], ch[1:, 1:] = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    best, out = 0.0, np.zeros_like(grad)
    for i in range(1, grad.shape[0]):
        for j in range(1, grad.shape[1]):
            g = np.array([cg[i, j], cg[i, -1] - cg[i, j], cg[-1, j] - cg[i, j], cg[-1, -1] - cg[i, -1] - cg[-1, j] + cg[i, j]])
            h = np.array([ch[i, j], ch[i, -1] - ch[i, j], ch[-1, j] - ch[i, j], ch[-1, -1] - ch[i, -1] - ch[-1, j] + ch[i, j]])
            gain = float((g * g / (h + ridge)).sum())
            if gain > best:
                best, v = gain, g / (h + ridge)
                out = np.zeros_like(grad)
                out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = v
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, step: float = STEP, leaves: int = LEAVES, pairs: int = PAIRS,
        ridge: float = 1.0) -> AdditiveModel:
    """Fit on features ``x`` and labels ``y`` (0 or 1). Without rows the score is 0.5, with one label only the smoothed prior."""
    prior = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(prior / (1 - prior))))
    if not len(y) or y.min() == y.max():
        return model
    n = x.shape[1]
    for i in range(n):
        q = np.unique(np.quantile(x[:, i], np.linspace(0, 1, MAX_BINS + 1)[1:-1]))
        model.edges.append(q)
        model.tables.append(np.zeros(len(q) + 1))
        model.coarse.append(np.arange(len(q) + 1) * PAIR_BINS // (len(q) + 1))
    bins = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for i in range(n):  # one feature at a time, in turn
            g, h = slopes()
            size = len(model.tables[i])
            add = step * _best_cuts(np.bincount(bins[i], g, size), np.bincount(bins[i], h, size), leaves, ridge)
            model.tables[i] += add
            total += add[bins[i]]
    both = {}
    g, h = slopes()
    for i in range(n):
        for j in range(i + 1, n):
            cell = model.coarse[i][bins[i]] * PAIR_BINS + model.coarse[j][bins[j]]
            table = lambda v: np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)  # noqa: E731, B023
            both[i, j] = (_best_quadrants(table(g), table(h), ridge)[0], cell)
    chosen = sorted(both, key=lambda k: -both[k][0])[:pairs]
    model.pairs = {k: np.zeros((PAIR_BINS, PAIR_BINS)) for k in chosen}
    for _ in range(PAIR_ROUNDS):
        for k in chosen:
            g, h = slopes()
            cell = both[k][1]
            table = lambda v: np.bincount(cell, v, PAIR_BINS ** 2).reshape(PAIR_BINS, PAIR_BINS)  # noqa: E731, B023
            add = step * _best_quadrants(table(g), table(h), ridge)[1]
            model.pairs[k] += add
            total += add.ravel()[cell]
    return model


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HOLD_OUT


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``max_rows`` labelled documents outside the held-out fold."""
    chosen = (
        labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k is not null and y is not null")
        .where(~held_out("k")).groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
        .orderBy(F.md5(F.col("k").cast("string")), "k").limit(max_rows)
    )

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series([features_of(t) for t in texts])

    # max_rows rows of two numbers: a proven bound
    rows = (text_batches(docs).select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "k")
            .select("k", "y", features("t").alias("x")).groupBy("k").agg(F.min("x").alias("x"), F.min("y").alias("y"))
            .toPandas().sort_values("k"))
    x = np.array(rows["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return x, rows["y"].to_numpy(dtype=float)


def scored(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text", accept: float = 0.7) -> DataFrame:
    """``id, held_out, score, predicted`` of each row. Null and empty texts score by their features, all 0. A null id
    counts as the empty text when folds are dealt. Rows are scored one by one; an empty table gives an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([features_of(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(shared.value.score(x))

    return (text_batches(docs).select(F.col(id_col), held_out(id_col).alias("held_out"), score(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= accept).cast("int")))


def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: whether its label was held out, its score, and the decision at 0.7."""
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit(*training_rows(docs, read(spark, sf_dir, "labels"))))


QUERIES = {"op2_quality_model": op2_quality_model}
ORACLES: dict[str, str] = {}
