"""Scoring new text with a fitted bundle.

A ``Predictor`` holds a fitted model and its vocabulary. A text is scored inside its row (``rowscore``) and never moves.
Where that cannot be (neighbours, lemmas, a vocabulary or model beyond the broadcast bound), scoring is one plan: term
counts -> join with the vocabulary -> per-document sums -> left join back to the input rows. In both, a text without
a known word keeps its row and scores the class constants.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.config import Options
from textsieve.functions.text import analyzer_terms, clean_text, preprocess_text
from textsieve.operators import bayes, neighbours, prepare, rank, rowscore, trees, vectorize
from textsieve.sources.io import path_exists


class Predictor:
    """A fitted model of any kind with the vocabulary and options it was fitted with."""

    def __init__(self, model, vocab: DataFrame, options: Options = Options(), stop_words=None):
        self.model = model
        self.vocab = vocab
        self.options = options
        self.stop_words = stop_words

    # F19 / F20
    def transform(self, df: DataFrame, text_col: str = "text", id_cols=("row_id",)) -> DataFrame:
        """``(*id_cols, text, preprocessed_text, prediction, label, probability, confidence)`` for every row of ``df``.
        Scored inside the row, ``df`` may be a stream and ids may repeat; on the plan of joins ``df`` must be unique on
        ``id_cols`` (join other columns back on the ids if needed)."""
        o = self.options
        key = F.struct(*[F.col(c) for c in id_cols]).alias("_rid")
        scorer = self._scorer()
        if scorer is not None:
            pre = clean_text(text_col) if o.preprocess else F.col(text_col)
            rows = df.select(key, F.col(text_col), pre.alias("_pre"))
            stop = vectorize.default_stop_words() if self.stop_words is None else self.stop_words
            scored, pre = scorer.score(rows, analyzer_terms("_pre", stop)), F.col("_pre")
        else:
            scored, pre = self._by_joins(df, text_col, key)
        p = F.col("probability")
        return scored.select(
            *[F.col("_rid").getField(c).alias(c) for c in id_cols],
            F.col(text_col),
            pre.alias("preprocessed_text"),
            F.col("prediction").cast("int"),
            prepare.decode_label("prediction").alias("label"),
            p.alias("probability"),
            F.greatest(p, 1 - p).alias("confidence"),
        )

    def _scorer(self):
        """The scorer inside the row, made once, or none."""
        if self.options.preprocess == "full":  # lemmas are joined
            return None
        if not hasattr(self, "_row_scorer"):
            self._row_scorer = rowscore.row_scorer(self.model, self.vocab, self.options.method)
        return self._row_scorer

    def scores_in_the_row(self) -> bool:
        return self._scorer() is not None

    def _by_joins(self, df: DataFrame, text_col: str, key):
        """The scored rows and their preprocessed text by the plan of joins."""
        o = self.options
        # hash-partition (id, text) once: counts by (id, term), the norm window
        # by id, the sums by id and the join back to the rows reuse it. Both
        # branches read the same two columns, so the exchange is shared.
        keyed = df.select(key, F.col(text_col)).repartition("_rid")
        if o.preprocess == "full":
            keyed = preprocess_text(keyed, text_col, "_pre", "_rid")
            source, pre = "_pre", F.col("_pre")
        else:
            source, pre = text_col, clean_text(text_col) if o.preprocess else F.col(text_col)
        counts = vectorize.term_counts(keyed, source, "_rid", self.stop_words, o.preprocess is True)
        feats = vectorize.vectorize(counts, self.vocab, o.method, o.max_features, "_rid")
        return self.model.score(keyed, feats, "_rid"), pre

    def predict_one(self, spark: SparkSession, text: str) -> DataFrame:
        """one message as a one-row DataFrame through the same plan."""
        df = spark.createDataFrame([(0, text)], "row_id bigint, text string")
        return self.transform(df, "text", ("row_id",))

    # F21 / W6
    def top_features(self, n: int = 20) -> DataFrame:
        """The most telling terms: of a linear or Naive Bayes model by weight for either class, of a tree model by
        importance."""
        m = self.model
        if isinstance(m, neighbours.KNNModel):
            raise ValueError("neighbours have no weights by term")
        if isinstance(m, bayes.NBModel):
            return rank.top_weights(m.term_weights(), n)
        if hasattr(m, "map"):
            raise ValueError("a kernel model has no weights by term")
        if isinstance(m, trees.TreeModel) or hasattr(m.stages[0], "featureImportances"):
            return rank.top_importances(m.importances(self.vocab), n)
        return rank.top_weights(m.term_weights(self.vocab), n)

    # Model and vocabulary saved together as one bundle
    def save(self, path: str):
        m = self.model
        spark = self.vocab.sparkSession
        if isinstance(m, bayes.NBModel):
            m.params.write.mode("overwrite").parquet(f"{path}/params")
            meta = {"kind": m.kind, "const0": m.const0, "const1": m.const1, "n_terms": m.n_terms, "presence": m.presence}
        elif isinstance(m, neighbours.KNNModel):
            m.save(path)
            meta = {"kind": "knn", "model": m.options()}
        elif isinstance(m, trees.TreeModel):
            m.save(path)
            meta = {"kind": "trees", "model": m.options()}
        elif hasattr(m, "map"):
            m.save(path)
            meta = {"kind": "kernel", "model": m.options()}
        else:
            m.save(path)
            meta = {"kind": "vector", "name": m.name, "n_terms": m.n_terms, "scaled": m.std is not None}
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        meta |= {"options": self.options.__dict__, "stop_words": list(self.stop_words) if self.stop_words is not None else None}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
            f"{path}/meta")

    # S9
    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Predictor":
        if not path_exists(spark, f"{path}/meta"):
            raise FileNotFoundError(f"no model bundle at {path}")
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        if meta["kind"] == "vector":
            from textsieve.plans.models import load_vector_model

            model = load_vector_model(spark, path, meta["name"], meta["n_terms"], meta["scaled"])
        elif meta["kind"] == "kernel":
            from textsieve.plans.models import KernelModel

            model = KernelModel.load(spark, path, **meta["model"])
        elif meta["kind"] == "trees":
            model = trees.TreeModel.load(spark, path, **meta["model"])
        elif meta["kind"] == "knn":
            model = neighbours.KNNModel.load(spark, path, **meta["model"])
        else:
            model = bayes.NBModel(meta["kind"], spark.read.parquet(f"{path}/params"), meta["const0"], meta["const1"],
                                  meta["n_terms"], meta["presence"])
        return cls(model, spark.read.parquet(f"{path}/vocab"), Options(**meta["options"]), meta["stop_words"])


def prediction_counts(pred: DataFrame) -> DataFrame:
    """``(label, n)`` of a scored batch."""
    return pred.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def format_result(pred: DataFrame, text_col: str = "text") -> DataFrame:
    """P10: ``Classification: SPAM (Confidence: 0.93)\\nText: ...``; texts over
    100 characters become their first 97 and ``...``."""
    # fixed values: the output format
    t = F.coalesce(F.col(text_col), F.lit(""))
    short = F.when(F.length(t) > 100, F.concat(F.substring(t, 1, 97), F.lit("..."))).otherwise(t)
    head = F.when(
        F.col("confidence").isNotNull(),
        F.format_string("Classification: %s (Confidence: %.2f)", F.upper("label"), F.col("confidence")),
    ).otherwise(F.concat(F.lit("Classification: "), F.upper("label")))
    return F.concat(head, F.lit("\nText: "), short)


def format_json(pred: DataFrame, text_col: str = "text") -> DataFrame:
    """P10 JSON form: one JSON object per record."""
    return F.to_json(F.struct(F.col(text_col).alias("text"), "preprocessed_text", "prediction", "label",
                              "probability", "confidence"))


# --- S11: model registry ----------------------------------------------------

REGISTRY_SCHEMA = "name string, path string, vocab_path string, created_at timestamp, metric double"


def record_model(spark: SparkSession, registry_path: str, name: str, path: str, metric: float | None, created_at=None) -> None:
    """Append a saved bundle to the registry table at ``registry_path``."""
    import datetime

    row = (name, path, f"{path}/vocab", created_at or datetime.datetime.now(), metric)
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(registry_path)


def latest_model(registry: DataFrame, name: str | None = None, by: str = "created_at") -> DataFrame:
    """``registry(name, path, vocab_path, created_at, metric)``: the
    newest (or best, ``by='metric'``) bundle, optionally of one model name."""
    r = registry if name is None else registry.where(F.col("name") == name)
    best = r.orderBy(F.desc(by), F.asc("name")).limit(1)
    return best.select("name", "path", F.coalesce("vocab_path", "path").alias("vocab_path"), by)
