"""kernel SVMs on explicit feature maps: random Fourier features for the
RBF kernel (Rahimi and Recht, 2007), TensorSketch for the polynomial kernel.

z_j(x) = sqrt(2/D) cos(w_j . x + b_j), w_j ~ N(0, 2 gamma I), b_j ~ U(0, 2 pi)
approximates exp(-gamma |x - y|^2) by z(x) . z(y). Every draw is an md5 hash
of (term, component, seed), so the weight table is rebuilt identically on any
executor; it has one row of D weights per term. The projection w_j . x is a
product of a document's entries and that table in its task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.operators.sampling import global_row_number, md5_int
from textsieve.operators.vectorize import BROADCAST_VOCAB_ROWS
from textsieve.session import write_table

#: Weights of so many numbers at most (32 MB) go to every task.
BROADCAST_WEIGHTS = 4_000_000
#: Documents, and entries, that a task holds as arrays of components at a time.
ROWS_AT_ONCE, PRODUCTS_AT_ONCE = 512, 16_384

TWO32 = float(2 ** 32)


def _uniform(*parts, seed=42):
    return (md5_int(*parts, seed=seed).cast("double") + F.lit(0.5)) / F.lit(TWO32)


def gamma_value(gamma, long: DataFrame, n_docs: int, n_terms: int) -> float:
    """'auto' = 1/V; 'scale' = 1/(V var(X)) with the variance over all n x V
    entries (zeros included); a number is used as is."""
    if gamma == "auto":
        return 1.0 / n_terms
    if gamma == "scale":
        r = long.agg(F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("ss")).first()
        cells = float(n_docs) * n_terms
        m = (r["s"] or 0.0) / cells
        var = (r["ss"] or 0.0) / cells - m * m
        return 1.0 / (n_terms * var) if var > 0 else 1.0
    return float(gamma)


def rff_weights(vocab: DataFrame, n_components: int = 100, gamma: float = 1.0, seed: int = 42) -> DataFrame:
    """``(term, w)``: an array of ``n_components`` Gaussian draws per term, by Box-Muller from two md5 uniforms."""
    def draw(j):
        u1 = _uniform(F.col("term"), j, F.lit("u"), seed=seed)
        u2 = _uniform(F.col("term"), j, F.lit("v"), seed=seed)
        return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * math.pi * u2) * math.sqrt(2.0 * gamma)

    return vocab.select("term", F.transform(F.sequence(F.lit(0), F.lit(n_components - 1)), draw).alias("w"))


def rff_arrays(long: DataFrame, docs: DataFrame, vocab: DataFrame, n_components: int = 100, gamma: float = 1.0,
               seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """``(row_id, z)``: the random features of every document in ``docs`` as one array (documents without a term
    included). A document's entries come together as numbers, and its task adds up their terms' arrays."""
    proj = _project(long, rff_weights(vocab, n_components, gamma, seed), vocab, n_components, id_col)
    return docs.select(id_col).join(proj, id_col, "left").select(id_col, _waves(F.col("_s"), n_components, 1.0, seed).alias("z"))


def _entries(long: DataFrame, vocab: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame, int]:
    """``(id, _i, _v)``: each document's terms, by their number, and values; ``(term, i)``: the numbers of the vocabulary's
    terms; and how many there are. An entry moves as a number and a value, never with its term's array."""
    n = vocab.count()
    if n <= BROADCAST_VOCAB_ROWS:  # one small ordered window is fine
        numbered = vocab.select("term", F.row_number().over(Window.orderBy("term")).alias("i"))
    else:
        numbered = global_row_number(vocab.select("term"), ["term"], "i")
    terms = write_table(numbered.select("term", (F.col("i") - 1).cast("int").alias("i")))
    side = F.broadcast(terms) if n <= BROADCAST_VOCAB_ROWS else terms
    rows = long.select(id_col, "term", "value").join(side, "term").groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("i", F.col("value").cast("double").alias("v")))).alias("_e"))
    return rows.select(id_col, F.col("_e.i").alias("_i"), F.col("_e.v").alias("_v")), terms, n


def _runs(places: pd.Series, values: pd.Series):
    """``(first row, rows, row, place, value)`` of runs of ``ROWS_AT_ONCE`` documents, their entries one after another."""
    for a in range(0, len(places), ROWS_AT_ONCE):
        p, v = places.iloc[a:a + ROWS_AT_ONCE], values.iloc[a:a + ROWS_AT_ONCE]
        row = np.repeat(np.arange(len(p)), p.map(len).to_numpy(np.int64))
        yield a, len(p), row, np.concatenate([*p, np.empty(0, np.int64)]).astype(np.int64), np.concatenate([*v, np.empty(0)])


def _project(long: DataFrame, w: DataFrame, vocab: DataFrame, n_components: int, id_col: str) -> DataFrame:
    """``(id, _s)``: each document's sum of its terms' arrays of ``w(term, w)`` times their values. Weights of at most
    ``BROADCAST_WEIGHTS`` numbers go to every task; of larger ones, every entry meets its term's array in a join."""
    rows, terms, n = _entries(long, vocab, id_col)
    if n * n_components > BROADCAST_WEIGHTS:
        part = long.select(id_col, "term", "value").join(w, "term").select(
            id_col, array_to_vector(F.transform("w", lambda x: x * F.col("value"))).alias("_p"))
        # to arrays before the join: there is no vector for a document without a term
        return part.groupBy(id_col).agg(Summarizer.sum(F.col("_p")).alias("_v")).select(id_col, vector_to_array("_v").alias("_s"))
    table = np.zeros((n, n_components))
    for r in w.join(terms, "term").select("i", "w").collect():  # n * n_components numbers
        table[r["i"]] = r["w"]
    shared = long.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(places: pd.Series, values: pd.Series) -> pd.Series:
        out = []
        for _, n_rows, row, place, value in _runs(places, values):
            sums = np.zeros((n_rows, n_components))
            for a in range(0, len(row), PRODUCTS_AT_ONCE):  # a document's entries lie together
                r = row[a:a + PRODUCTS_AT_ONCE]
                first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                part = shared.value[place[a:a + PRODUCTS_AT_ONCE]] * value[a:a + PRODUCTS_AT_ONCE, None]
                sums[r[first]] += np.add.reduceat(part, first, axis=0)
            out += list(sums)
        return pd.Series(out, dtype=object)

    return rows.select(id_col, project("_i", "_v").alias("_s"))


def _waves(projection, n_components: int, factor: float, seed: int):
    """The random features of a projection (null: no term) times ``factor``."""
    p = F.coalesce(projection, F.array_repeat(F.lit(0.0), n_components))
    shift = lambda j: _uniform(j, F.lit("b"), seed=seed) * (2.0 * math.pi)
    return F.transform(p, lambda x, j: math.sqrt(2.0 / n_components) * F.cos(x * factor + shift(j)))


def rff_features(long: DataFrame, docs: DataFrame, vocab: DataFrame, n_components: int = 100, gamma: float = 1.0,
                 seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Long form ``(row_id, j, value)`` of ``rff_arrays``."""
    z = rff_arrays(long, docs, vocab, n_components, gamma, seed, id_col)
    return z.select(id_col, F.posexplode("z").alias("j", "value"))


def rff_vectors(long: DataFrame, docs: DataFrame, vocab: DataFrame, n_components: int = 100, gamma: float = 1.0,
                seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """``(row_id, features)`` dense vectors of the components, in order."""
    return rff_arrays(long, docs, vocab, n_components, gamma, seed, id_col).select(
        id_col, array_to_vector("z").alias("features"))


def fit_kernel_svc(train_long: DataFrame, train_docs: DataFrame, vocab: DataFrame, C: float = 1.0,
                   gamma="scale", n_components: int = 100, seed: int = 42):
    """Linear SVM on the random features of the training documents; returns
    ``(model, gamma)``."""
    n_docs = train_docs.count()
    n_terms = vocab.count()
    g = gamma_value(gamma, train_long, n_docs, n_terms)
    feats = rff_vectors(train_long, train_docs, vocab, n_components, g, seed).join(
        train_docs.select("row_id", "label", "weight"), "row_id")
    n = float(train_docs.agg(F.sum("weight")).first()[0])
    svc = LinearSVC(regParam=1.0 / (C * n), weightCol="weight", maxIter=100, standardization=False).fit(feats)
    return svc, g


# --- polynomial kernel: TensorSketch (Pham and Pagh, 2013) ------------------
#
# (gamma <x, y> + coef0)^p is approximated by <TS(x'), TS(y')> where x' is x
# scaled by sqrt(gamma) with one extra constant feature sqrt(coef0), and TS is
# the circular convolution (FFT product) of p independent count sketches.

_CONST_TERM = "\u0000const"


def _places(term, i, n_components: int, seed: int):
    """A term's bucket and sign in sketch ``i``, by md5."""
    h = (md5_int(term, i, F.lit("h"), seed=seed) % F.lit(n_components)).cast("int")
    return h, F.when(md5_int(term, i, F.lit("s"), seed=seed) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))


def sketch_hashes(vocab: DataFrame, degree: int = 3, n_components: int = 100, seed: int = 42) -> DataFrame:
    """``(term, i, h, s)``: for each of the ``degree`` sketches a bucket and a
    sign per term. |vocabulary| x degree rows."""
    t = vocab.select("term", F.explode(F.sequence(F.lit(0), F.lit(degree - 1))).alias("i"))
    h, s = _places(F.col("term"), F.col("i"), n_components, seed)
    return t.select("term", "i", h.alias("h"), s.alias("s"))


def tensor_sketch(long: DataFrame, docs: DataFrame, vocab: DataFrame, degree: int = 3, gamma: float = 1.0,
                  coef0: float = 0.0, n_components: int = 100, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """``(row_id, features)``: TensorSketch vectors of every document in ``docs`` (a document without a term gets the
    sketch of the constant feature alone, all zeros if ``coef0`` is 0). The constant feature has the same places in every
    document: they are expressions of the row, not a term that all documents would be joined on."""
    rows, terms, n = _entries(long, vocab, id_col)
    # the places of a document's terms and of the constant: bucket of sketch i at i * n_components + h
    place = lambda df: df.select(*df.columns, (F.col("i") * n_components + F.col("h")).cast("int").alias("p")).drop("h")
    hashes = place(sketch_hashes(vocab, degree, n_components, seed))
    own = hashes.join(terms.withColumnRenamed("i", "t"), "term").groupBy("t").agg(
        F.array_sort(F.collect_list(F.struct("i", "p", "s"))).alias("e"))
    own = own.select("t", F.col("e.p").alias("p"), F.col("e.s").alias("s"))
    fixed = None
    if coef0:
        h, sign = _places(F.lit(_CONST_TERM), F.col("i"), n_components, seed)
        const = place(long.sparkSession.range(degree).select(F.col("id").cast("int").alias("i")).select("i", h.alias("h"), sign.alias("s")))
        fixed = np.array([tuple(r) for r in const.orderBy("i").select("p", "s").collect()]).T  # a row for each sketch
    if n * degree > BROADCAST_WEIGHTS:
        # the table of places is too large for a task: every entry meets its own in a join
        entries = rows.select(id_col, F.explode(F.arrays_zip("_i", "_v")).alias("x")).select(id_col, F.col("x._i").alias("t"), F.col("x._v").alias("v"))
        moved = entries.join(own, "t").select(id_col, F.explode(F.arrays_zip("p", "s")).alias("y"), "v")
        moved = moved.groupBy(id_col, F.col("y.p").alias("_i")).agg(F.sum(F.col("y.s") * F.col("v")).alias("_v"))
        rows = moved.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("e")).select(
            id_col, F.col("e._i").alias("_i"), F.col("e._v").alias("_v"))
        to, signs = None, None
    else:
        to, signs = np.zeros((n, degree), np.int64), np.zeros((n, degree))
        for r in own.collect():  # n * degree numbers
            to[r["t"]], signs[r["t"]] = r["p"], r["s"]
    per_doc = docs.select(id_col).join(rows, id_col, "left")
    shared = long.sparkSession.sparkContext.broadcast((to, signs))
    factor, one = math.sqrt(gamma), math.sqrt(coef0)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def convolve(places: pd.Series, values: pd.Series) -> pd.Series:
        to, signs = shared.value
        out = []
        for _, n_rows, row, place, value in _runs(places, values):
            sk = np.zeros(n_rows * degree * n_components)  # no entry: all zeros
            for i in range(degree if to is not None else 1):
                p, v = (to[place, i], signs[place, i] * value) if to is not None else (place, value)
                sk += np.bincount(row * (degree * n_components) + p, v * factor, len(sk))
            sk = sk.reshape(n_rows, degree * n_components)
            if fixed is not None:
                sk[:, fixed[0].astype(int)] += fixed[1] * one
            prod = np.prod(np.fft.fft(sk.reshape(-1, degree, n_components), axis=2), axis=1)
            out += list(np.real(np.fft.ifft(prod, axis=1)))
        return pd.Series(out, dtype=object)

    i, v = F.coalesce("_i", F.array().cast("array<int>")), F.coalesce("_v", F.array().cast("array<double>"))
    return per_doc.select(id_col, array_to_vector(convolve(i, v)).alias("features"))


def fit_poly_svc(train_long: DataFrame, train_docs: DataFrame, vocab: DataFrame, C: float = 1.0, degree: int = 3,
                 gamma="scale", coef0: float = 0.0, n_components: int = 100, seed: int = 42):
    """Linear SVM on TensorSketch features; returns ``(model, gamma)``."""
    g = gamma_value(gamma, train_long, train_docs.count(), vocab.count())
    feats = tensor_sketch(train_long, train_docs, vocab, degree, g, coef0, n_components, seed).join(
        train_docs.select("row_id", "label", "weight"), "row_id")
    n = float(train_docs.agg(F.sum("weight")).first()[0])
    return LinearSVC(regParam=1.0 / (C * n), weightCol="weight", maxIter=100, standardization=False).fit(feats), g


# --- maps of the registry -----------------------------------------------------

#: Components of a feature map, unless a parameter says otherwise.
N_COMPONENTS = 256


@dataclass
class KernelMap:
    """Scaled long features to the vectors on which a linear SVM stands for a kernel's. Neither map depends on gamma but
    by a factor (``coef0`` is 0), so ``base`` is made once for all gammas: it is what has to be joined and summed."""

    kernel: str  # rbf | poly
    gamma: float
    vocab: DataFrame  # term
    std: DataFrame  # term, std
    n_components: int = N_COMPONENTS
    degree: int = 3
    seed: int = 42

    def base(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """``docs`` with ``_base``: the projection (rbf; null without a term) or the sketch (poly) for a gamma of 1."""
        small = self.vocab.count() <= BROADCAST_VOCAB_ROWS
        long = feats.join(F.broadcast(self.std) if small else self.std, "term").select(
            id_col, "term", (F.col("value") / F.col("std")).alias("value"))
        if self.kernel == "poly":
            x = tensor_sketch(long, docs, self.vocab, self.degree, 1.0, 0.0, self.n_components, self.seed, id_col)
            return docs.join(x.select(id_col, vector_to_array("features").alias("_base")), id_col)
        w = rff_weights(self.vocab, self.n_components, 1.0, self.seed)
        return docs.join(_project(long, w, self.vocab, self.n_components, id_col).withColumnRenamed("_s", "_base"), id_col, "left")

    def features(self, based: DataFrame) -> DataFrame:
        """The rows of ``base`` with ``features`` for this gamma."""
        if self.kernel == "poly":
            z = F.transform("_base", lambda x: x * F.lit(self.gamma ** (self.degree / 2)))
        else:
            z = _waves(F.col("_base"), self.n_components, math.sqrt(self.gamma), self.seed)
        return based.withColumn("features", array_to_vector(z)).drop("_base")
