"""Scoring inside the row (F19, F20, ST1): counts, weights, norm and model of a text without moving it.

A document's vector needs only its own terms and the vocabulary, so nothing has to be exploded, shuffled and gathered
again: Arrow batches of term arrays meet the vocabulary and the model as broadcast arrays. That holds where both are at
most ``BROADCAST_VOCAB_ROWS`` terms, which is counted; larger ones take the plan of joins (``vectorize``, ``score``).
No row depends on another one: ids may repeat, and a stream is scored in append mode. A null text has no terms.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsieve.operators import bayes, trees
from textsieve.operators.vectorize import BROADCAST_VOCAB_ROWS


def sparse_batch(terms: pd.Series, index: pd.Index, idf: np.ndarray | None):
    """``(row, place, value)`` of a batch of term arrays, by row and place: counts, or with ``idf`` TF-IDF of unit length."""
    size = terms.map(len).to_numpy(np.int64)
    place = index.get_indexer(pd.Index(np.concatenate([*terms, np.empty(0, object)]), dtype=object))
    row = np.repeat(np.arange(len(terms)), size)[place >= 0]
    key, count = np.unique(row * len(index) + place[place >= 0], return_counts=True)
    row, place, value = key // len(index), key % len(index), count.astype(float)
    if idf is not None:
        value = value * idf[place]
        value = value / np.sqrt(np.bincount(row, value * value, len(terms)))[row]
    return row, place, value


def _by_place(table: DataFrame, columns: list[str], size: int) -> np.ndarray:
    """The columns of ``table(term_id, ...)`` as arrays by ``term_id``, zero where a term is missing."""
    pdf = table.select("term_id", *columns).toPandas()
    out = np.zeros((len(columns), size))
    out[:, pdf["term_id"].to_numpy(np.int64)] = pdf[columns].to_numpy(float).T
    return out


class RowScorer:
    """``columns(terms)``: what a model says of rows with the term arrays ``terms``."""

    def __init__(self, model, vocab: DataFrame, method: str):
        words = vocab.select("term", "term_id", "idf").orderBy("term_id").toPandas()
        if list(words["term_id"]) != list(range(len(words))):
            raise ValueError("the vocabulary's numbers are not 0, 1, 2, ...")
        self.model, self.vocab, self.n_terms = model, vocab, len(words)
        idf = words["idf"].to_numpy(float) if method.lower() == "tfidf" else None
        self.words = (pd.Index(words["term"], dtype=object), idf)
        self.sc = vocab.sparkSession.sparkContext

    def score(self, df: DataFrame, terms: Column) -> DataFrame:
        """``df`` with ``prediction`` and ``probability`` (of class 1)."""
        if isinstance(self.model, bayes.NBModel):
            return bayes.with_class(df.withColumn("_s", self._bayes()(terms)), self.model, F.col("_s.s0"), F.col("_s.s1")).drop("_s")
        if isinstance(self.model, trees.TreeModel):
            return self.model.with_class(df.withColumn("probs", self._trees()(terms)), df.columns)
        rows = df.withColumn("_x", self._vector()(terms))
        return self.model.apply(rows, F.col("_x.i"), F.col("_x.v"), df.columns)

    def _bayes(self):
        m = self.model
        params = m.params.join(self.vocab.select("term", "term_id"), "term")
        shared = self.sc.broadcast((*self.words, _by_place(params, ["w0", "w1", "q0", "q1"], self.n_terms), m.presence))

        @F.pandas_udf("s0 double, s1 double")
        def sums(terms: pd.Series) -> pd.DataFrame:
            index, idf, (w0, w1, q0, q1), presence = shared.value
            row, t, x = sparse_batch(terms, index, idf)
            fx = (x > 0).astype(float) if presence else x
            return pd.DataFrame({n: np.bincount(row, w[t] * fx + q[t] * x * x, len(terms)) for n, w, q in (("s0", w0, q0), ("s1", w1, q1))})

        return sums

    def _vector(self):
        std = None
        if self.model.std is not None:
            std = _by_place(self.model.std.join(self.vocab.select("term", "term_id"), "term"), ["std"], self.n_terms)[0]
        shared = self.sc.broadcast((*self.words, std))

        @F.pandas_udf("i array<int>, v array<double>")
        def vector(terms: pd.Series) -> pd.DataFrame:
            index, idf, std = shared.value
            row, t, x = sparse_batch(terms, index, idf)
            if std is not None:  # a term without a deviation has no place in the scaled table either
                keep = std[t] > 0
                row, t, x = row[keep], t[keep], x[keep] / std[t[keep]]
            cut = np.searchsorted(row, np.arange(1, len(terms)))
            return pd.DataFrame({"i": pd.Series(np.split(t.astype(np.int32), cut)), "v": pd.Series(np.split(x, cut))})

        return vector

    def _trees(self):
        edges = _by_place(self.model.edges, ["lo", "hi"], self.n_terms)
        shared = self.sc.broadcast((*self.words, edges, self.model.arrays()))

        @F.pandas_udf("array<double>")
        def walk(terms: pd.Series) -> pd.Series:
            index, idf, (lo, hi), model = shared.value
            row, t, x = sparse_batch(terms, index, idf)
            keep = hi[t] > 0  # seen in a training row
            row, t, x = row[keep], t[keep], x[keep]
            return pd.Series(list(trees.walk(model, len(terms), len(index), row, t, trees.place_np(x, lo[t], hi[t]))))

        return walk


def row_scorer(model, vocab: DataFrame, method: str) -> RowScorer | None:
    """The scorer of a model, or none where it, or the vocabulary, is too large to broadcast or needs other rows."""
    known = isinstance(model, (bayes.NBModel, trees.TreeModel)) or hasattr(model, "apply")
    if not known or vocab.count() > BROADCAST_VOCAB_ROWS:
        return None
    if isinstance(model, trees.TreeModel) and model.nodes.count() > model.broadcast_nodes:
        return None
    return RowScorer(model, vocab, method)
