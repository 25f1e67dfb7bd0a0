"""Model registry and estimators.

Every registry entry creates an estimator with one interface: ``fit(td)`` on
the training data returns a fitted model with ``score(docs, feats)``, whether
it is relational (Naive Bayes, neighbours, trees) or a ``pyspark.ml`` model.

Feature vectors (V13) are gathered per document from the long feature table by
the ``term_id`` that the vocabulary already carries, so no vocabulary reaches
the driver. Scaling (F12) divides by the population standard deviation and
never centres, so vectors stay sparse.
"""

from __future__ import annotations

import functools
import itertools
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.operators import bayes, evaluate, gradients, neighbours, sampling, trees
from textsieve.plans import kernels
from textsieve.session import cut_lineage, ensure_checkpoint_dir

# The tolerances at which the reference's solvers stop.
LR_TOL, SVM_TOL = 1e-4, 1e-3
#: The largest slope left by fits that share their passes, as a part of the loss.
LR_GRID_TOL = 1e-4
#: Held-out folds from which the probabilities of a linear SVM are learned.
PLATT_FOLDS = 3
#: So many trees of a grid grow together (a family of points that share their trees is never split).
TREES_AT_ONCE = 500
#: Bytes of a partition of dense rows.
DENSE_BYTES = 128 * 2 ** 20


# --- V13: vectors ----------------------------------------------------------

def vectors(docs: DataFrame, feats: DataFrame, n_terms: int, std: DataFrame | None = None,
            id_col: str = "row_id") -> DataFrame:
    """``docs`` with ``features``: one sparse vector of ``n_terms`` places per document, from its rows of the long table
    ``feats(id, term, term_id, value)``; a document without a known term has an empty vector."""
    value = F.col("value")
    if std is not None:
        feats = feats.join(F.broadcast(std) if n_terms <= bayes.BROADCAST_VOCAB_ROWS else std, "term")
        value = value / F.col("std")
    rows = feats.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col("term_id").cast("int").alias("i"), value.alias("v")))).alias("_e"))
    empty = F.array().cast("array<struct<i:int,v:double>>")
    e = F.coalesce(F.col("_e"), empty)
    return docs.join(rows, id_col, "left").withColumn("features", as_vector(n_terms, e.getField("i"), e.getField("v"))).drop("_e")


def as_vector(n_terms: int, places, values):
    """A sparse vector of ``n_terms`` places: its stored form, parsed, which is the built-in way there from columns."""
    stored = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(n_terms).alias("size"), places.alias("indices"),
                      values.alias("values"))
    return F.from_json(F.to_json(F.struct(stored.alias("x"))), T.StructType([T.StructField("x", VectorUDT())]))["x"]


def for_fitting(rows: DataFrame) -> DataFrame:
    """``rows`` in the checkpoint folder, in partitions that Spark sizes by their bytes: an iterative fit runs a job over
    them hundreds of times, so there should be as many as the data fill and no more."""
    ensure_checkpoint_dir(rows.sparkSession)
    return rows.hint("rebalance").checkpoint()


def dealt_for_dense(rows: DataFrame, n_terms: int, width: int) -> DataFrame:
    """``rows`` for an estimator that keeps each with all its ``n_terms`` places, ``width`` bytes each, whatever the bytes
    of its sparse vector: in partitions of ``DENSE_BYTES`` at most, as they are where they are as many already."""
    need = math.ceil(rows.count() * n_terms * width / DENSE_BYTES)
    return rows.repartition(need) if need > rows.rdd.getNumPartitions() else rows


def training_vectors(td, scaled: bool) -> tuple[DataFrame, DataFrame | None, int]:
    """``(row_id, label, weight, features)`` of the training rows, the scale (or none), and the number of terms.
    Kept with the training data, so that models fitted in turn share them."""
    cache = td.__dict__.setdefault("_vectors", {})
    if scaled not in cache:
        n = td.vocab.count()
        std = cut_lineage(bayes.scale_std(td.feats_train, td.docs_train, td.vocab)) if scaled else None
        rows = vectors(td.docs_train.select("row_id", "label", "weight"), td.feats_train, n, std)
        cache[scaled] = for_fitting(rows), std, n
    return cache[scaled]


def tree_rows(td) -> tuple[DataFrame, DataFrame, int]:
    """The training rows in bins, kept with the training data like its vectors."""
    cache = td.__dict__.setdefault("_vectors", {})
    if "trees" not in cache:
        cache["trees"] = trees.tree_rows(td.feats_train, td.docs_train, td.vocab)
    return cache["trees"]


# --- U3 / F13: registry ----------------------------------------------------

@dataclass
class ModelSpec:
    name: str
    builder: Callable[[dict], object]
    needs_scaling: bool
    default: dict = field(default_factory=dict)
    grid: dict = field(default_factory=dict)
    kind: str = "ml"  # "ml" (pyspark.ml estimator) or relational: "nb" (Naive Bayes), "knn" (neighbours), "trees"


REGISTRY: dict[str, ModelSpec] = {}


def register_model(name, builder, grid=None, needs_scaling=False, default=None, kind="ml"):
    REGISTRY[name] = ModelSpec(name, builder, needs_scaling, default or {}, grid or {}, kind)


def _reg(c: float, n: int) -> float:
    return 1.0 / (c * max(n, 1))


def _no_param(name):
    raise ValueError(f"parameter {name!r} has no equivalent here")


def _only(p, *known, class_weights=(None, "balanced")):
    """A parameter that the estimator has no equivalent for is an error, never ignored."""
    for k in p:
        if k not in (*known, "_n", "_v"):
            _no_param(k)
    if p.get("class_weight") not in class_weights:
        _no_param(f"class_weight={p['class_weight']}")


def _lr(p):
    # both solvers of the grid minimise the same objective, which Spark's own solver does too
    _only(p, "max_iter", "solver", "random_state", "C", "penalty", "class_weight")
    if p.get("solver") not in (None, "liblinear", "saga", "lbfgs"):
        _no_param("solver")
    return LogisticRegression(maxIter=int(p.get("max_iter", 100)), tol=LR_TOL, regParam=_reg(p.get("C", 1.0), p["_n"]),
                              elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0, standardization=False,
                              weightCol="weight")


def _svc(p):
    # kernels other than the linear one are maps before the same estimator: see fit_kernel
    _only(p, "max_iter", "kernel", "gamma", "degree", "n_components", "C", "probability", "random_state", "class_weight")
    if p.get("kernel", "linear") not in ("linear", "rbf", "poly"):
        _no_param(f"kernel={p['kernel']}")
    g = p.get("gamma", "scale")
    if g not in ("scale", "auto") and not (isinstance(g, (int, float)) and g > 0):
        _no_param(f"gamma={g}")
    return LinearSVC(maxIter=int(p.get("max_iter", 100)), tol=SVM_TOL, regParam=_reg(p.get("C", 1.0), p["_n"]),
                     standardization=False, weightCol="weight")


def _spec(p, **more) -> trees.TreeSpec:
    depth = p.get("max_depth")
    return trees.TreeSpec(criterion=p.get("criterion", "gini"), max_depth=None if depth is None else int(depth),
                          min_samples_split=int(p.get("min_samples_split", 2)), min_samples_leaf=int(p.get("min_samples_leaf", 1)),
                          class_weight=p.get("class_weight"), **more)


def _rf(p):
    _only(p, "n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "criterion", "random_state", "class_weight",
          class_weights=(None, "balanced", "balanced_subsample"))
    seed = int(p.get("random_state", 42))
    return [_spec(p, max_features="sqrt", bootstrap=True, seed=(seed * 1_000_003 + i) % 2 ** 31)
            for i in range(int(p.get("n_estimators", 100)))]


def _gbt(p):
    _only(p, "n_estimators", "learning_rate", "max_depth", "subsample", "random_state")
    return GBTClassifier(maxIter=int(p.get("n_estimators", 100)), stepSize=float(p.get("learning_rate", 0.1)),
                         maxDepth=int(p.get("max_depth", 3)), subsamplingRate=float(p.get("subsample", 1.0)),
                         seed=int(p.get("random_state", 42)), weightCol="weight")


def _dt(p):
    _only(p, "max_depth", "min_samples_split", "min_samples_leaf", "criterion", "random_state", "class_weight")
    return [_spec(p)]


def _mlp(p):
    # Spark's layers are sigmoid and have no penalty
    _only(p, "hidden_layer_sizes", "max_iter", "random_state")
    return MultilayerPerceptronClassifier(layers=[p["_v"], *p.get("hidden_layer_sizes", (100,)), 2],
                                          maxIter=int(p.get("max_iter", 100)), seed=int(p.get("random_state", 42)))


def _nb(kind):
    def make(p):
        _only(p, "var_smoothing" if kind == "gaussian" else "alpha")
        return kind, {k: v for k, v in p.items() if k in ("alpha", "var_smoothing")}
    return make


def _knn(p):
    _only(p, "n_neighbors", "weights", "p")
    return {k: v for k, v in p.items() if k in ("n_neighbors", "weights", "p")}


# The model names, defaults and grids of the reference.
register_model("Gaussian Naive Bayes", _nb("gaussian"), {"var_smoothing": [1e-9, 1e-8, 1e-7, 1e-6, 1e-5]}, False,
               {}, "nb")
register_model("Multinomial Naive Bayes", _nb("multinomial"), {"alpha": [0.1, 0.5, 1.0, 2.0]}, False,
               {"alpha": 1.0}, "nb")
register_model("Bernoulli Naive Bayes", _nb("bernoulli"), {"alpha": [0.1, 0.5, 1.0, 2.0]}, False,
               {"alpha": 1.0}, "nb")
register_model("Logistic Regression", _lr, {"C": [0.01, 0.1, 1.0, 10.0], "penalty": ["l1", "l2"],
                                            "solver": ["liblinear", "saga"], "class_weight": [None, "balanced"]},
               True, {"max_iter": 1000, "solver": "liblinear", "random_state": 42, "C": 1.0})
register_model("Support Vector Machine", _svc, {"C": [0.1, 1.0, 10.0], "kernel": ["linear", "rbf", "poly"],
                                                "gamma": ["scale", "auto", 0.1, 1.0],
                                                "class_weight": [None, "balanced"]},
               True, {"kernel": "linear", "C": 1.0, "probability": True, "random_state": 42})
register_model("Random Forest", _rf, {"n_estimators": [50, 100, 200], "max_depth": [None, 10, 20, 30],
                                      "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
                                      "class_weight": [None, "balanced", "balanced_subsample"]},
               False, {"n_estimators": 100, "random_state": 42}, "trees")
register_model("Gradient Boosting", _gbt, {"n_estimators": [50, 100, 200], "learning_rate": [0.01, 0.1, 0.2],
                                           "max_depth": [3, 5, 7], "subsample": [0.8, 1.0]},
               False, {"n_estimators": 100, "learning_rate": 0.1, "random_state": 42})
register_model("Decision Tree", _dt, {"max_depth": [None, 5, 10, 15, 20], "min_samples_split": [2, 5, 10],
                                      "min_samples_leaf": [1, 2, 4], "criterion": ["gini", "entropy"],
                                      "class_weight": [None, "balanced"]},
               False, {"random_state": 42}, "trees")
register_model("K-Nearest Neighbors", _knn, {"n_neighbors": [3, 5, 7, 9, 11],
                                                             "weights": ["uniform", "distance"], "p": [1, 2]},
               True, {"n_neighbors": 5}, "knn")
register_model("Neural Network", _mlp, {"hidden_layer_sizes": [(50,), (100,), (50, 50), (100, 50)],
                                        "activation": ["relu", "tanh"], "alpha": [0.0001, 0.001, 0.01],
                                        "learning_rate_init": [0.001, 0.01]},
               True, {"hidden_layer_sizes": (100,), "max_iter": 1000, "random_state": 42})

RECOMMENDED = ["Multinomial Naive Bayes", "Bernoulli Naive Bayes", "Logistic Regression", "Support Vector Machine"]


def get_models(selected: list[str] | None = None, custom_params: dict | None = None) -> dict[str, dict]:
    """Chosen registry entries with their parameters (defaults overridden
    by ``custom_params[name]``); unknown names are skipped."""
    names = selected or list(REGISTRY)
    out = {}
    for n in names:
        if n not in REGISTRY:
            continue
        out[n] = {**REGISTRY[n].default, **((custom_params or {}).get(n, {}))}
    return out


def create_model(name: str, params: dict | None = None) -> "Estimator":
    """the estimator of a registry entry; an unknown name raises."""
    if name not in REGISTRY:
        raise ValueError(f"Unknown model: {name}")
    spec = REGISTRY[name]
    p = {**spec.default, **(params or {})}
    spec.builder({**p, "_n": 1, "_v": 1})  # unknown parameters raise here
    return Estimator(name, p)


# --- F14: estimators and fitted models -------------------------------------------

@dataclass
class Estimator:
    """A model of the registry with its parameters."""

    name: str
    params: dict

    def fit(self, td) -> "bayes.NBModel | neighbours.KNNModel | trees.TreeModel | VectorModel":
        """Fit on ``TrainingData``; the result's ``score(docs, feats)`` adds ``prediction`` and ``probability``."""
        spec = REGISTRY[self.name]
        if spec.kind == "nb":
            kind, p = spec.builder(self.params)
            return bayes.FITTERS[kind](td.feats_train, td.docs_train, td.vocab, **p)
        if spec.kind == "knn":
            return neighbours.fit_knn(td.feats_train, td.docs_train, td.vocab, **spec.builder(self.params))
        if spec.kind == "trees":
            return trees.fit_trees(tree_rows(td), spec.builder(self.params))
        if self.params.get("kernel", "linear") != "linear":
            return fit_kernel(spec, self.params, td)
        if self.name == "Neural Network":
            return fit_network(spec, self.params, td)
        rows, std, n_terms = training_vectors(td, spec.needs_scaling)
        rows = _class_weight(rows, self.params.get("class_weight") == "balanced")
        p = {**self.params, "_n": int(rows.agg(F.sum("weight")).first()[0]), "_v": n_terms}
        est = spec.builder(p)
        if self.name == "Gradient Boosting":
            rows = dealt_for_dense(rows, n_terms, 4)
        if self.name == "Support Vector Machine":
            stages = fit_svm(est, rows, self.params)
        else:
            stages = [est.fit(rows)]
        return VectorModel(self.name, stages, n_terms, std)


@dataclass
class VectorModel:
    """A fitted ``pyspark.ml`` model with what turns long features into its vectors."""

    name: str
    stages: list  # the classifier; for the SVM also the margin and its probabilities
    n_terms: int
    std: DataFrame | None

    def score(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """Every row of ``docs`` gets ``prediction`` and ``probability`` (of class 1)."""
        return self._classes(vectors(docs, feats, self.n_terms, self.std, id_col), docs.columns)

    def apply(self, rows: DataFrame, places, values, columns: list[str]) -> DataFrame:
        """``columns`` of rows that carry their own (scaled) vector as arrays, with the same two columns."""
        return self._classes(rows.withColumn("features", as_vector(self.n_terms, places, values)), columns)

    def _classes(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        out = self.stages[0].transform(rows)
        cls = F.col("prediction").cast("int")
        if len(self.stages) > 1:  # the class is the side of the margin, the probability is Platt's
            out = out.withColumn("_class", cls).drop("prediction")
            out = self.stages[1].transform(margins(out)).withColumn("prediction", F.col("_class"))
            cls = F.col("prediction")
        # an SVM fitted without probabilities has none
        prob = vector_to_array("probability")[1] if "probability" in out.columns else F.lit(None).cast("double")
        return out.select(*columns, cls.alias("prediction"), prob.alias("probability"))

    def term_weights(self, vocab: DataFrame) -> DataFrame:
        """``(term, weight)``: the coefficients of a linear model."""
        return _by_term(self.stages[0].coefficients, vocab, "weight")

    def importances(self, vocab: DataFrame) -> DataFrame:
        """``(term, importance)`` of a tree model."""
        return _by_term(self.stages[0].featureImportances, vocab, "importance")

    def save(self, path: str):
        PipelineModel(self.stages).write().overwrite().save(f"{path}/model")
        if self.std is not None:
            self.std.write.mode("overwrite").parquet(f"{path}/std")


@dataclass
class KernelModel:
    """a linear SVM behind a kernel's feature map."""

    map: kernels.KernelMap
    svm: VectorModel

    def score(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """As ``VectorModel.score``."""
        return self.svm._classes(self.map.features(self.map.base(docs, feats, id_col)), docs.columns)

    def save(self, path: str):
        self.svm.save(path)
        self.map.std.write.mode("overwrite").parquet(f"{path}/std")
        self.map.vocab.write.mode("overwrite").parquet(f"{path}/terms")

    def options(self) -> dict:
        m = self.map
        return {"kernel": m.kernel, "gamma": m.gamma, "n_components": m.n_components, "degree": m.degree, "seed": m.seed}

    @classmethod
    def load(cls, spark, path: str, **options) -> "KernelModel":
        m = kernels.KernelMap(vocab=spark.read.parquet(f"{path}/terms"), std=spark.read.parquet(f"{path}/std"), **options)
        return cls(m, VectorModel("Support Vector Machine", PipelineModel.load(f"{path}/model").stages, m.n_components, None))


def training_scale(td) -> DataFrame:
    """F12's deviations of the training rows, kept with the training data."""
    cache = td.__dict__.setdefault("_vectors", {})
    if "std" not in cache:
        cache["std"] = cut_lineage(bayes.scale_std(td.feats_train, td.docs_train, td.vocab))
    return cache["std"]


def fit_network(spec: "ModelSpec", p: dict, td) -> VectorModel:
    """Spark's own network and its first weights, with passes over packed rows as its descent: a row stays sparse until
    its task needs it, and copies are weights. Spark's solver keeps every copy with all its terms."""
    cache = td.__dict__.setdefault("_vectors", {})
    std, n_terms = training_scale(td), td.vocab.count()
    if "packed" not in cache:
        scaled = td.feats_train.join(F.broadcast(std) if n_terms <= bayes.BROADCAST_VOCAB_ROWS else std, "term")
        docs = td.docs_train.select("row_id", "label", "weight", F.lit(-1).alias("fold"))
        cache["packed"] = gradients.pack(docs, scaled.select("row_id", "term_id", (F.col("value") / F.col("std")).alias("value")))
    est = spec.builder({**p, "_v": n_terms})
    steps = est.getMaxIter()
    # without a step Spark's solver gives its first weights, and a model of given ones
    one = td.vocab.sparkSession.createDataFrame([(0.0, Vectors.sparse(n_terms, []))], ["label", "features"])
    still = est.setMaxIter(0)
    weights, _ = gradients.fit_network(cache["packed"], est.getLayers(), still.fit(one).weights.toArray(), steps, est.getTol())
    model = still.setInitialWeights(Vectors.dense(weights)).fit(one)
    return VectorModel("Neural Network", [model.setMaxIter(steps) if hasattr(model, "setMaxIter") else model], n_terms, std)


def fit_kernel(spec: "ModelSpec", p: dict, td) -> KernelModel:
    """the map's base is kept with the training data, for all gammas, costs and class weights."""
    cache = td.__dict__.setdefault("_vectors", {})
    std, vocab, g = training_scale(td), td.vocab.select("term"), p.get("gamma", "scale")
    if ("gamma", g) not in cache:
        long = td.feats_train.join(std, "term").withColumn("value", F.col("value") / F.col("std"))
        cache["gamma", g] = kernels.gamma_value(g, long, td.docs_train.count(), vocab.count())
    m = kernels.KernelMap(p["kernel"], cache["gamma", g], vocab, std, int(p.get("n_components", kernels.N_COMPONENTS)),
                          int(p.get("degree", 3)), int(p.get("random_state", 42)))
    key = (m.kernel, m.n_components, m.degree, m.seed)
    if key not in cache:
        cache[key] = for_fitting(m.base(td.docs_train.select("row_id", "label", "weight"), td.feats_train))
    rows = m.features(cache[key])
    rows = _class_weight(rows, p.get("class_weight") == "balanced")
    est = spec.builder({**p, "_n": int(rows.agg(F.sum("weight")).first()[0]), "_v": m.n_components})
    return KernelModel(m, VectorModel("Support Vector Machine", fit_svm(est, rows, p), m.n_components, None))


def load_vector_model(spark, path: str, name: str, n_terms: int, scaled: bool) -> VectorModel:
    return VectorModel(name, PipelineModel.load(f"{path}/model").stages, n_terms,
                       spark.read.parquet(f"{path}/std") if scaled else None)


def _by_term(values, vocab: DataFrame, out: str) -> DataFrame:
    """A fitted vector joined to the vocabulary by index (J4); zeros are left out."""
    pairs = [(int(i), float(v)) for i, v in enumerate(values.toArray()) if v]
    return vocab.select("term_id", "term").join(
        vocab.sparkSession.createDataFrame(pairs, f"term_id bigint, {out} double"), "term_id").select("term", out)


def margins(df: DataFrame) -> DataFrame:
    """An SVM's output with the margin as the one-place vector ``_m``."""
    raw = df.withColumn("_raw1", vector_to_array("rawPrediction")[1])
    return VectorAssembler(inputCols=["_raw1"], outputCol="_m").transform(raw).drop("rawPrediction", "prediction", "_raw1")


def fit_svm(est, rows: DataFrame, p: dict) -> list:
    """The SVM, with what makes its margins probabilities unless ``probability`` is false."""
    return fit_platt_svm(est, rows) if p.get("probability", True) else [est.fit(rows)]


def fit_platt_svm(est, rows: DataFrame, folds: int = PLATT_FOLDS) -> list:
    """a linear SVM on all rows, and Platt's one-feature logistic regression on margins of rows that the SVM of
    their fold has not seen."""
    which = sampling.kfold_assign(rows.select("row_id", "label"), folds).select("row_id", "fold")
    dealt = for_fitting(rows.join(which, "row_id"))
    ids = [r[0] for r in dealt.select("fold").distinct().orderBy("fold").collect()]
    # an iteration is a job of a few short tasks: one fit alone leaves most cores idle, so all of them run side by side
    with ThreadPoolExecutor(len(ids) + 1) as pool:
        whole = pool.submit(inheritable_thread_target(rows.sparkSession)(est.fit), rows)
        parts = [pool.submit(inheritable_thread_target(rows.sparkSession)(est.fit), dealt.where(F.col("fold") != f)) for f in ids]
        parts = [p.result() for p in parts]
        held = [margins(m.transform(dealt.where(F.col("fold") == f))).select("label", "weight", "_m") for f, m in zip(ids, parts)]
        platt = LogisticRegression(featuresCol="_m", labelCol="label", weightCol="weight", maxIter=100).fit(
            functools.reduce(DataFrame.unionByName, held))
        return [whole.result(), platt]


def _class_weight(df: DataFrame, balanced: bool) -> DataFrame:
    if not balanced:
        return df
    counts = {r[0]: r[1] for r in df.groupBy("label").agg(F.sum("weight")).collect()}
    n = sum(counts.values())
    w = F.when(F.col("label") == 1, F.lit(n / (2 * counts.get(1, 1)))).otherwise(F.lit(n / (2 * counts.get(0, 1))))
    return df.withColumn("weight", F.col("weight") * w)


def fit_timed(name: str, td, params: dict | None = None):
    """``(fitted model, seconds)``. Shared vectors are made before the clock starts."""
    est = create_model(name, params)
    if REGISTRY[name].kind == "ml" and name != "Neural Network":
        training_vectors(td, REGISTRY[name].needs_scaling)
    elif REGISTRY[name].kind == "trees":
        tree_rows(td)
    t0 = time.time()
    model = est.fit(td)
    return model, time.time() - t0


def scored(model, td) -> DataFrame:
    """``(row_id, label, prediction, probability)`` of the test rows (and ``weight`` where they have one)."""
    keep = [c for c in ("row_id", "label", "weight") if c in td.docs_test.columns]
    return model.score(td.docs_test, td.feats_test).select(*keep, F.col("prediction").cast("int").alias("prediction"),
                                                           "probability")


# --- F15 / F16: fit and evaluate -------------------------------------------------

RESULT_SCHEMA = ("model string, ord int, error string, training_time double, accuracy double, precision double, "
                 "recall double, f1 double, roc_auc double")


def train_and_evaluate(models: dict[str, dict], td) -> tuple[DataFrame, dict]:
    """fit and evaluate each model in turn. One row per model; a model that fails has its ``error`` there and the
    rest go on. Also returns the fitted models by name."""
    rows, fitted = [], {}
    for i, (name, params) in enumerate(models.items()):
        try:
            model, secs = fit_timed(name, td, params)
            sc = cut_lineage(scored(model, td))
            weight = "weight" if "weight" in sc.columns else None  # held-out copies
            m = evaluate.binary_metrics(sc, weight_col=weight).first()
            auc = evaluate.roc_auc(sc, weight_col=weight).first()[0]
            rows.append((name, i, None, secs, m["accuracy"], m["precision"], m["recall"], m["f1"], auc))
            fitted[name] = model
        except Exception as e:  # noqa: BLE001 -- one failing model must not lose the others; its error is the result
            rows.append((name, i, f"{type(e).__name__}: {e}", None, None, None, None, None, None))
    return td.vocab.sparkSession.createDataFrame(rows, RESULT_SCHEMA), fitted


# --- F17 / F18: cross-validation and grid search of any model ---------------------

def fold_data(td, folds: DataFrame, fold: int):
    """The training data of one fold: fitted on the other folds' rows, tested on this fold's; scaling and all other
    statistics are taken anew from the rows it is fitted on."""
    this = folds.where(F.col("fold") == fold).select("row_id")
    side = lambda df, how: df.join(this, "row_id", how)
    return replace(td, docs_train=side(td.docs_train, "left_anti"), feats_train=side(td.feats_train, "left_anti"),
                   docs_test=side(td.docs_train, "left_semi"), feats_test=side(td.feats_train, "left_semi"))


def grid_points(grid: dict) -> list[dict]:
    """All combinations of a grid, in its order."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def tree_scores(part, points: list[list[trees.TreeSpec]]) -> list[float]:
    """Class-1 F1 on the test rows of ``part`` for each list of trees. Trees that points share (forests of several
    sizes) grow once, and the trees of many points grow and score together."""
    families: dict = {}
    for i, specs in enumerate(points):
        families.setdefault(specs[0], []).append(i)
    batches, size = [[]], 0
    for members in families.values():
        longest = max((points[i] for i in members), key=len)
        if any(points[i] != longest[:len(points[i])] for i in members):
            raise ValueError("points that begin with the same tree must go on alike")
        if batches[-1] and size + len(longest) > TREES_AT_ONCE:
            batches.append([])
            size = 0
        batches[-1].append((longest, members))
        size += len(longest)
    out = [0.0] * len(points)
    for batch in batches:
        specs, asked = [], []
        for longest, members in batch:
            asked += [(i, len(specs) + 1, len(points[i])) for i in members]
            specs += longest
        model = trees.fit_trees(tree_rows(part), specs)
        probs = model.tree_probabilities(part.docs_test, part.feats_test)
        asked_rows = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(a, ("point", "start", "size"))]) for a in asked]))
        each = probs.select("label", "weight", "probs", asked_rows.alias("q"))
        p = F.aggregate(F.slice("probs", F.col("q.start"), F.col("q.size")), F.lit(0.0), lambda s, x: s + x) / F.col("q.size")
        each = each.select("label", "weight", F.col("q.point").alias("point"), (F.round(p, 12) > 0.5).alias("yes"))
        cell = lambda cond: F.sum(F.when(cond, F.col("weight")).otherwise(0.0))
        sums = each.groupBy("point").agg(cell(F.col("yes") & (F.col("label") == 1)).alias("tp"),
                                         cell(F.col("yes") != (F.col("label") == 1)).alias("wrong"))
        for r in sums.collect():  # one row a point
            out[r["point"]] = 2 * r["tp"] / (2 * r["tp"] + r["wrong"]) if r["tp"] else 0.0
    return out


def logistic_scores(td, which: DataFrame, points: list[dict], k: int) -> list[float]:
    """Held-out F1 of every point and fold (a point's folds one after the other): all fits go through the same passes over
    one packed copy of the training rows, whose blocks know each row's fold."""
    fits = [gradients.LogisticFit(p.get("C", 1.0), p.get("penalty", "l2"), p.get("class_weight") == "balanced", f,
                                  int(p.get("max_iter", 100))) for p in points for f in range(k)]
    docs = td.docs_train.select("row_id", "label", "weight").join(which, "row_id")
    blocks = gradients.pack(docs, td.feats_train.select("row_id", "term_id", "value"))
    try:
        return gradients.fit_logistic(blocks, td.vocab.count(), fits, k, LR_GRID_TOL)[1]
    finally:
        gradients.release(blocks)


def bayes_scores(td, which: DataFrame, spec: "ModelSpec", points: list[dict], k: int) -> list[float]:
    """Held-out F1 of every point and fold of a Naive Bayes grid, as ``logistic_scores``: one plan, see ``bayes.cv_grid``."""
    kind, _ = spec.builder({})
    values = [float(next(iter(spec.builder({**spec.default, **p})[1].values()), bayes.DEFAULTS[kind])) for p in points]
    scores = bayes.cv_grid(td.feats_train, td.docs_train, td.vocab, which, kind, values, k)
    by = {(r["param"], r["fold"]): r["f1"] for r in scores.collect()}  # one row a point and fold
    return [by.get((v, f), 0.0) for v in values for f in range(k)]


def grid_search(name: str, td, grid: dict, k: int = 5, parallelism: int = 4) -> tuple[DataFrame, dict]:
    """class-1 F1 (G6) on stratified folds (M9) for every point of ``grid``; a key that the model cannot take
    raises. Returns ``(params, mean_score, std_score, min_score, max_score)`` by point and the best parameters (the
    first of equals). A grid of one point is a plain cross-validation."""
    points = grid_points(grid)
    spec = REGISTRY[name]
    for p in points:
        spec.builder({**spec.default, **p, "_n": 1, "_v": 1})  # an unknown key or value raises before any fit
    which = sampling.kfold_assign(td.docs_train.select("row_id", "label"), k).select("row_id", "fold")
    which = cut_lineage(which)
    logistic, one_plan = name == "Logistic Regression", spec.kind == "nb"
    parts = []
    for f in range(0 if logistic or one_plan else k):
        part = fold_data(td, which, f)
        part = replace(part, **{c: cut_lineage(getattr(part, c)) for c in ("docs_train", "feats_train", "docs_test", "feats_test")})
        if REGISTRY[name].kind == "ml" and name != "Neural Network":
            training_vectors(part, REGISTRY[name].needs_scaling)
        parts.append(part)

    def one(job):
        p, part = job
        sc = scored(create_model(name, p).fit(part), part)
        return evaluate.binary_metrics(sc, weight_col="weight").first()["f1"]

    if name == "Support Vector Machine":  # classes are sides of the margin: no point needs probabilities
        points = [{"probability": False, **p} for p in points]

    def same(p):
        """Equal estimators (solvers that Spark does not tell apart, a gamma without its kernel) are fitted once."""
        idle = {"solver", "random_state", "probability"} | ({"gamma", "degree"} if p.get("kernel") == "linear" else set())
        return tuple(sorted((k, str(v)) for k, v in p.items() if k not in idle))

    unique = {same(p): p for p in reversed(points)}
    if logistic:
        scores = logistic_scores(td, which, [{**spec.default, **p} for p in unique.values()], k)
    elif one_plan:
        scores = bayes_scores(td, which, spec, list(unique.values()), k)
    elif REGISTRY[name].kind == "trees":
        lists = [spec.builder({**spec.default, **p}) for p in unique.values()]
        by_fold = [tree_scores(part, lists) for part in parts]
        scores = [by_fold[f][i] for i in range(len(lists)) for f in range(k)]
    else:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(one, [(p, part) for p in unique.values() for part in parts]))
    by = {key: scores[i * k:(i + 1) * k] for i, key in enumerate(unique)}
    rows = []
    for p in points:
        own = by[same(p)]
        mean = sum(own) / k
        rows.append((str({x: v for x, v in p.items() if x in grid}), mean, (sum((x - mean) ** 2 for x in own) / k) ** 0.5, min(own), max(own)))
    best = grid_points(grid)[max(range(len(rows)), key=lambda i: rows[i][1])]
    return td.vocab.sparkSession.createDataFrame(
        rows, "params string, mean_score double, std_score double, min_score double, max_score double"), best
