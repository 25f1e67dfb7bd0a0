"""Vectorizing: term counts, vocabulary fit, count and TF-IDF vectors.

The document-term matrix is a long table ``(row_id, term, value)``: only
non-zero entries exist. Counting per (document, term) and document
frequencies per term are partial+final aggregations; the vocabulary is bounded
by ``max_features`` and is broadcast only under that bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve.functions.text import analyzer_terms, clean_text, spark_english_stop_words
from textsieve.session import write_table

# Vocabularies at or below this many rows are broadcast explicitly; larger ones
# are left to the planner (AQE broadcasts at run time if they turn out small).
BROADCAST_VOCAB_ROWS = 1_000_000


def default_stop_words():
    return spark_english_stop_words()


def doc_terms(
    df: DataFrame,
    text_col: str = "message",
    id_col: str = "row_id",
    stop_words=None,
    preprocess: bool = False,
    keep=(),
) -> DataFrame:
    """V1: one row per token occurrence ``(id, *keep, term)``."""
    text = clean_text(text_col) if preprocess else F.col(text_col)
    sw = default_stop_words() if stop_words is None else stop_words
    return df.select(id_col, *keep, F.explode(analyzer_terms(text, sw)).alias("term"))


def term_counts(
    df: DataFrame,
    text_col: str = "message",
    id_col: str = "row_id",
    stop_words=None,
    preprocess: bool = False,
    keep=(),
) -> DataFrame:
    """V2: ``(id, *keep, term, tf)`` with one row per (document, term).

    The aggregation is partial (map side) + final, so a document's repeated
    terms are combined before the shuffle; ``keep`` columns are functions of
    ``id`` and ride along as grouping keys."""
    return doc_terms(df, text_col, id_col, stop_words, preprocess, keep).groupBy(id_col, *keep, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def term_stats(
    df: DataFrame,
    text_col: str = "message",
    id_col: str = "row_id",
    stop_words=None,
    preprocess: bool = False,
) -> DataFrame:
    """``(term, df, ctf)`` of all documents, as ``term_counts`` has them, without its table of (document, term): a
    document's terms are sorted inside its row, where the first of each run counts for ``df``. Only documents that share
    their id with another row are counted by (id, term)."""
    again = write_table(df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(id_col).alias("_id")))
    alone = again.isEmpty()
    one = df if alone else df.join(again, F.col(id_col).eqNullSafe(F.col("_id")), "left_anti")
    text = clean_text(text_col) if preprocess else F.col(text_col)
    sw = default_stop_words() if stop_words is None else stop_words
    sorted_terms = one.select(F.sort_array(analyzer_terms(text, sw)).alias("t"))
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice("t", 1, F.greatest(F.size("t") - 1, F.lit(0))))
    runs = sorted_terms.where(F.size("t") > 0).select(F.explode(F.arrays_zip(F.col("t"), before)).alias("e"))
    stats = runs.select(F.col("e.t").alias("term"), F.coalesce(F.col("e.t") != F.col("e.1"), F.lit(True)).cast("bigint").alias("df"),
                        F.lit(1).cast("bigint").alias("ctf"))
    if not alone:
        many = term_counts(df.join(again, F.col(id_col).eqNullSafe(F.col("_id")), "left_semi"), text_col, id_col, stop_words, preprocess)
        stats = stats.unionByName(many.select("term", F.lit(1).cast("bigint").alias("df"), F.col("tf").alias("ctf")))
    return stats.groupBy("term").agg(F.sum("df").alias("df"), F.sum("ctf").alias("ctf"))


def fit_vocabulary(
    counts: DataFrame,
    n_docs: int | None = None,
    min_df: int = 5,
    max_features: int | None = 5000,
    id_col: str = "row_id",
) -> DataFrame:
    """V3-V5, V7: ``vocab(term, term_id, df, ctf, idf)``.

    Keeps terms in at least ``min_df`` documents, then the ``max_features``
    terms with the highest corpus count (ties: term ascending), numbered in
    term order. ``idf = ln((1+n)/(1+df)) + 1``. Raises on an empty vocabulary.
    """
    if n_docs is None:
        n_docs = counts.select(id_col).distinct().count()
    return vocabulary(counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("ctf")), n_docs, min_df, max_features)


def vocabulary(stats: DataFrame, n_docs: int, min_df: int = 5, max_features: int | None = 5000) -> DataFrame:
    """``fit_vocabulary`` of ``stats(term, df, ctf)``."""
    stats = stats.where(F.col("df") >= min_df)
    if max_features is not None:
        stats = stats.orderBy(F.desc("ctf"), F.asc("term")).limit(int(max_features))
        # at most max_features rows: one small ordered window is fine
        vocab = stats.withColumn("term_id", (F.row_number().over(Window.orderBy("term")) - 1).cast("bigint"))
    else:
        from textsieve.operators.sampling import global_row_number

        vocab = global_row_number(stats, ["term"], out_col="term_id").withColumn(
            "term_id", (F.col("term_id") - 1).cast("bigint")
        )
    vocab = vocab.withColumn(
        "idf", F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    ).select("term", "term_id", "df", "ctf", "idf")
    vocab = write_table(vocab)
    if vocab.isEmpty():
        raise ValueError("empty vocabulary; perhaps the documents only contain stop words or min_df is too high")
    return vocab


def vocab_for_join(vocab: DataFrame, max_features: int | None) -> DataFrame:
    """Broadcast the vocabulary only when its size is bounded by max_features."""
    if max_features is not None and max_features <= BROADCAST_VOCAB_ROWS:
        return F.broadcast(vocab)
    return vocab


def count_vectors(counts: DataFrame, vocab: DataFrame, max_features: int | None = 5000,
                  id_col: str = "row_id", keep=()) -> DataFrame:
    """``(id, *keep, term, term_id, value)`` with raw counts; unknown terms dropped."""
    v = vocab_for_join(vocab.select("term", "term_id"), max_features)
    return counts.join(v, "term").select(id_col, *keep, "term", "term_id", F.col("tf").cast("double").alias("value"))


def tfidf_vectors(counts: DataFrame, vocab: DataFrame, max_features: int | None = 5000,
                  id_col: str = "row_id", keep=()) -> DataFrame:
    """V8: ``tf * idf``, each document scaled to unit L2 length.

    The per-document norm is a window over ``id`` (one shuffle of the joined
    pairs); an all-zero document has no rows and stays a zero vector.
    """
    v = vocab_for_join(vocab.select("term", "term_id", "idf"), max_features)
    w = counts.join(v, "term").select(id_col, *keep, "term", "term_id", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, *keep, "term", "term_id", (F.col("w") / norm).alias("value"))


def vectorize(counts: DataFrame, vocab: DataFrame, method: str = "tfidf", max_features: int | None = 5000,
              id_col: str = "row_id", keep=()) -> DataFrame:
    if method.lower() == "tfidf":
        return tfidf_vectors(counts, vocab, max_features, id_col, keep)
    return count_vectors(counts, vocab, max_features, id_col, keep)


def fit_transform(
    df: DataFrame,
    method: str = "tfidf",
    max_features: int | None = 5000,
    min_df: int = 5,
    stop_words=None,
    text_col: str = "message",
    id_col: str = "row_id",
    preprocess: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """V9: returns ``(long vectors, vocab)``."""
    counts = term_counts(df, text_col, id_col, stop_words, preprocess)
    n_docs = df.count()
    vocab = fit_vocabulary(counts, n_docs, min_df, max_features, id_col)
    return vectorize(counts, vocab, method, max_features, id_col), vocab


def transform(
    df: DataFrame,
    vocab: DataFrame,
    method: str = "tfidf",
    max_features: int | None = 5000,
    stop_words=None,
    text_col: str = "message",
    id_col: str = "row_id",
    preprocess: bool = False,
) -> DataFrame:
    """Vectors of new documents with a fitted vocabulary. Unknown terms are
    dropped; documents without a known term have no rows here, so scorers must
    left-join back to the document table (see ``bayes.score``)."""
    counts = term_counts(df, text_col, id_col, stop_words, preprocess)
    return vectorize(counts, vocab, method, max_features, id_col)
