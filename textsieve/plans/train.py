"""Training plan: split -> vocabulary -> upsample -> features -> fit (S1..F15).

Default order (``leaky_order=False``): split first, fit the vocabulary on the
training rows, upsample the training rows only. The text is tokenized once
per document into an array of (term, count) and that narrow table is
persisted for the several passes a fit makes (vocabulary, statistics, scoring).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.config import Options
from textsieve.operators import bayes, sampling, vectorize
from textsieve.session import cut_lineage, write_table


#: Session setting: spread every scanned table over so many partitions (one round-robin shuffle). Unset, the files'
#: own layout stays, at every size. For a single machine whose tables are one row group each, and for nothing else.
INPUT_PARTITIONS = "spark.textsieve.inputPartitions"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table, split by its own row groups (or see ``INPUT_PARTITIONS``)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    n = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def labelled_messages(spark: SparkSession, sf_dir: str, label: str = "toxic") -> DataFrame:
    """``(row_id, message, label)`` = documents joined with their labels."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return d.join(lab, "doc_id").select(
        F.col("doc_id").cast("bigint").alias("row_id"), F.col("text").alias("message"),
        F.col("label").cast("int").alias("label"))


@dataclass
class TrainingData:
    docs_train: DataFrame  # row_id, label, weight
    docs_test: DataFrame  # row_id, label
    feats_train: DataFrame  # row_id, label, weight, term, term_id, value
    feats_test: DataFrame  # row_id, label, term, term_id, value
    vocab: DataFrame  # term, term_id, df, ctf, idf
    counts: DataFrame  # persisted (row_id, label, is_test, term, tf)
    labels: DataFrame  # persisted (row_id, label, is_test)
    options: Options

    def release(self):
        self.vocab.unpersist()

    def settled(self) -> "TrainingData":
        """The same with its features written once, for plans that read them for several models: each reading of the
        lazy ones joins, shuffles and sorts the counts again."""
        if getattr(self, "_settled", False):
            return self
        out = replace(self, feats_train=write_table(self.feats_train), feats_test=write_table(self.feats_test))
        out._settled = True
        return out


def prepared_text(df: DataFrame, text_col: str, id_col: str, opts: Options) -> DataFrame:
    """``df`` with the text replaced by T13's result, if that is the chosen preprocessing."""
    if opts.preprocess != "full":
        return df
    from textsieve.functions.text import preprocess_text

    return preprocess_text(df, text_col, "_full", id_col).withColumn(text_col, F.col("_full")).drop("_full")


def prepare(base: DataFrame, opts: Options = Options(), stop_words=None) -> TrainingData:
    """S3 -> M7 -> V1..V9 -> M5, as lazy DataFrames over one persisted
    per-document term-count table."""
    if opts.leaky_order:
        return prepare_leaky(base, opts, stop_words)
    base = prepared_text(base, "message", "row_id", opts)
    stats: dict = {}
    split = sampling.stratified_split(base, opts.test_size, "label", "row_id", opts.seed, stats=stats)
    train_sizes = {g: n - stats["test"].get(g, 0) for g, n in stats["counts"].items()}
    # One hash shuffle of the documents by row_id up front: the (row_id, term)
    # counts need no shuffle of the larger (document, term) table. The number is
    # given, as cleaning takes more time than its bytes let Spark expect.
    split = split.repartition(sampling._num_parts(split, None), "row_id")
    # the split and the long count table are reused by every later pass:
    # write them once to the checkpoint folder (cuts lineage, survives
    # executor loss), as columns, in the job that makes them
    labels = write_table(split.select("row_id", "label", "is_test"))
    counts = write_table(vectorize.term_counts(
        split, "message", "row_id", stop_words, opts.preprocess is True, keep=("label", "is_test")))
    labels_train = labels.where(~F.col("is_test")).select("row_id", "label")
    n_train = sum(train_sizes.values())
    train_counts = counts.where(~F.col("is_test")).drop("is_test")
    vocab = vectorize.fit_vocabulary(train_counts, n_train, opts.min_df, opts.max_features)

    if opts.upsample:
        weights = write_table(sampling.draw_weights(
            sampling.balance_classes(labels_train, "label", "row_id", opts.seed, True, counts=train_sizes)))
        n_w = n_train
        w_side = F.broadcast(weights) if n_w <= sampling.BROADCAST_ROWS else weights
        w_counts = train_counts.join(w_side.drop("label"), "row_id")
    else:
        weights = labels_train.withColumn("weight", F.lit(1.0))
        w_counts = train_counts.withColumn("weight", F.lit(1.0))

    feats_train = vectorize.vectorize(w_counts, vocab, opts.method, opts.max_features, keep=("label", "weight"))
    test_counts = counts.where(F.col("is_test")).drop("is_test")
    feats_test = vectorize.vectorize(test_counts, vocab, opts.method, opts.max_features, keep=("label",))
    return TrainingData(
        docs_train=weights,
        docs_test=labels.where(F.col("is_test")).select("row_id", "label"),
        feats_train=feats_train,
        feats_test=feats_test,
        vocab=vocab,
        counts=counts,
        labels=labels,
        options=opts,
    )


def fit_naive_bayes(td: TrainingData, kind: str = "multinomial", **params) -> bayes.NBModel:
    fitter = bayes.FITTERS[kind]
    return fitter(td.feats_train, td.docs_train, td.vocab, **params)


def score_test(td: TrainingData, model: bayes.NBModel) -> DataFrame:
    """Scores of every test document (documents with no known term included)."""
    return model.score(td.docs_test, td.feats_test)


def prepare_leaky(base: DataFrame, opts: Options, stop_words=None) -> TrainingData:
    """The reference's order (Q2): vocabulary and IDF from every row, upsample
    every row, then a stratified split of the rows *with* their copies (a
    copy's key includes its copy number). Copies on each side become weights,
    so ``docs_test`` carries a ``weight`` for weighted evaluation."""
    rows = prepared_text(base, "message", "row_id", opts)
    rows = rows.repartition(sampling._num_parts(rows, None), "row_id")
    counts = write_table(vectorize.term_counts(rows, "message", "row_id", stop_words, opts.preprocess is True,
                                               keep=("label",)))
    labels = rows.select("row_id", "label")
    n_all = labels.count()
    vocab = vectorize.fit_vocabulary(counts, n_all, opts.min_df, opts.max_features)
    balanced = sampling.balance_classes(labels, "label", "row_id", opts.seed, opts.upsample)
    sp = sampling.stratified_split(balanced, opts.test_size, "label", "row_id", opts.seed, copy_col="copy_no")
    sides = {}
    for t in (False, True):
        sides[t] = cut_lineage(sp.where(F.col("is_test") == t).groupBy("row_id", "label").agg(
            F.count(F.lit(1)).cast("double").alias("weight")))
    w_tr = counts.join(F.broadcast(sides[False].drop("label")) if n_all <= sampling.BROADCAST_ROWS
                       else sides[False].drop("label"), "row_id")
    feats_train = vectorize.vectorize(w_tr, vocab, opts.method, opts.max_features, keep=("label", "weight"))
    te = counts.join(sides[True].select("row_id"), "row_id", "left_semi")
    feats_test = vectorize.vectorize(te, vocab, opts.method, opts.max_features, keep=("label",))
    all_labels = labels.withColumn("is_test", F.lit(None).cast("boolean"))
    return TrainingData(docs_train=sides[False], docs_test=sides[True], feats_train=feats_train,
                        feats_test=feats_test, vocab=vocab, counts=counts, labels=all_labels, options=opts)
