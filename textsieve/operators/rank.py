"""Rankings: top features, best model, term frequency per class, bigram
collocations (W5-W11, A4, A5, A12, P7, P12, J4).

Top-k per group never sorts a whole group in one task: rows are first ranked
inside (group, salt) buckets, the k best of each bucket survive, and only
those (at most k x salts per group) are ranked per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve.functions import text as T
from textsieve.session import write_table


def top_k_per_group(df: DataFrame, group_cols: list, order_cols: list, k: int, salt_col: str | None = None,
                    salts: int = 64, rank_col: str = "rank") -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order) <= k`` in two
    phases; ``order_cols`` must be a total order. ``salt_col`` (default: a
    hash of all columns) spreads a hot group over ``salts`` tasks."""
    salt_src = F.col(salt_col) if salt_col else F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(salt_src, F.lit(salts)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    pre = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return pre.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def top_weights(weights: DataFrame, n: int = 20, feature_col: str = "term", weight_col: str = "weight") -> DataFrame:
    """The ``n`` largest (side ``spam``) and ``n`` smallest (side ``ham``)
    weights, rank from 1, ties by feature. Each side is a distributed
    take-ordered (partial top-n per partition, then a merge of few rows)."""
    out = None
    for side, order in (("spam", F.desc(weight_col)), ("ham", F.asc(weight_col))):
        top = weights.orderBy(order, F.asc(feature_col)).limit(n)
        ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(order, F.asc(feature_col))))
        part = ranked.select(F.lit(side).alias("side"), F.col("rank").cast("int"),
                             F.col(feature_col).alias("feature"), F.col(weight_col).cast("double").alias("weight"))
        out = part if out is None else out.unionByName(part)
    return out


def top_importances(importances: DataFrame, n: int = 20, feature_col: str = "term",
                    weight_col: str = "importance") -> DataFrame:
    """The ``n`` largest importances, rank from 1, ties by feature."""
    top = importances.orderBy(F.desc(weight_col), F.asc(feature_col)).limit(n)
    return top.select(
        F.row_number().over(Window.orderBy(F.desc(weight_col), F.asc(feature_col))).cast("int").alias("rank"),
        F.col(feature_col).alias("feature"), F.col(weight_col).cast("double").alias("importance"))


def best_model(results: DataFrame, metric: str = "f1") -> DataFrame:
    """W7 (+P12): the row with the highest ``metric`` among models without an
    error; the earliest ``ord`` wins ties. Empty input or no usable row is an
    error, as in the reference."""
    ok = results.where(F.col("error").isNull() & F.col(metric).isNotNull())
    # one row: taken here, so that the plan behind it runs once
    best = ok.orderBy(F.desc(metric), F.asc("ord")).limit(1).collect()
    if not best:
        raise ValueError(f"no usable model has a value of {metric!r}")
    return results.sparkSession.createDataFrame(best, results.schema)


def model_comparison(results: DataFrame, metric: str = "f1") -> DataFrame:
    """W8 (+P12): ``(model, value)`` for models that have the metric."""
    return results.where(F.col("error").isNull() & F.col(metric).isNotNull()).select(
        "model", F.col(metric).alias("value"))


def word_tokens(df: DataFrame, text_col: str = "message", keep=("label",), stop_words=None) -> DataFrame:
    """Cleaned word tokens without stop words, one row per occurrence, with
    their position: ``(*keep, pos, term)``."""
    toks = T.remove_stopwords(T.tokenize(T.clean_text(text_col)), stop_words)
    return df.select(*keep, F.posexplode(toks).alias("pos", "term"))


def term_frequency_by_class(df: DataFrame, text_col: str = "message", label_col: str = "label", k: int = 200,
                            stop_words=None) -> DataFrame:
    """A4: per class the ``k`` most frequent words ``(label, rank, term, n,
    weight)``, weight = n / (largest n of the class)."""
    toks = word_tokens(df, text_col, (label_col,), stop_words)
    counts = toks.groupBy(label_col, "term").agg(F.count(F.lit(1)).alias("n"))
    top = top_k_per_group(counts, [label_col], [F.desc("n"), F.asc("term")], k, salt_col=None)
    mx = F.max("n").over(Window.partitionBy(label_col))  # over at most k rows per class
    return top.select(label_col, F.col("rank").cast("int"), "term", "n", (F.col("n") / mx).alias("weight"))


def _ll(k: Column, n: Column, x: Column) -> Column:
    """k ln x + (n-k) ln(1-x), with 0 ln 0 = 0."""
    a = F.when(k > 0, k * F.log(x)).otherwise(F.lit(0.0))
    b = F.when(n - k > 0, (n - k) * F.log(F.lit(1.0) - x)).otherwise(F.lit(0.0))
    return a + b


def bigram_collocations(df: DataFrame, text_col: str = "message", label_col: str = "label", k: int = 50,
                        min_count: int = 2, stop_words=None) -> DataFrame:
    """A5: adjacent word pairs per class scored by Dunning's log-likelihood
    ratio G^2; the ``k`` best per class with at least ``min_count``
    occurrences: ``(label, rank, w1, w2, n12, g2)``.

    The text is tokenized once: every token is exploded with its successor
    (null for the last), and one aggregation with two grouping sets,
    (label, w1, w2) and (label, w1), yields bigram and unigram counts in a
    single shuffle. The counts are written, as four sides of the plan read them."""
    toks = T.remove_stopwords(T.tokenize(T.clean_text(text_col)), stop_words)
    n = F.size("t")
    nxt = F.concat(F.slice("t", 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    pairs = df.select(label_col, toks.alias("t")).select(
        label_col, F.explode(F.arrays_zip(F.col("t"), nxt)).alias("p")
    ).select(label_col, F.col("p.t").alias("w1"), F.col("p.1").alias("w2")).where(F.col("w1").isNotNull())
    both = pairs.groupingSets([[label_col, "w1", "w2"], [label_col, "w1"]], label_col, "w1", "w2").agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_gid"))
    both = write_table(both.where((F.col("_gid") == 1) | F.col("w2").isNotNull() & (F.col("n") >= min_count)))
    bi = both.where(F.col("_gid") == 0).select(label_col, "w1", "w2", F.col("n").alias("n12"))
    uni = both.where(F.col("_gid") == 1).select(label_col, F.col("w1").alias("term"), "n")
    totals = uni.groupBy(label_col).agg(F.sum("n").alias("N"))  # one row per class
    u1 = uni.select(label_col, F.col("term").alias("w1"), F.col("n").alias("n1"))
    u2 = uni.select(label_col, F.col("term").alias("w2"), F.col("n").alias("n2"))
    j = bi.join(u1, [label_col, "w1"]).join(u2, [label_col, "w2"]).join(F.broadcast(totals), label_col)
    n12, n1, n2, N = (F.col(c).cast("double") for c in ("n12", "n1", "n2", "N"))
    p, p1, p2 = n2 / N, n12 / n1, (n2 - n12) / (N - n1)
    g2 = F.lit(2.0) * (_ll(n12, n1, p1) + _ll(n2 - n12, N - n1, p2) - _ll(n12, n1, p) - _ll(n2 - n12, N - n1, p))
    scored = j.select(label_col, "w1", "w2", "n12", g2.alias("g2"))
    # rank on g2 rounded to 9 decimals so last-bit noise cannot reorder pairs
    top = top_k_per_group(scored, [label_col], [F.desc(F.round("g2", 9)), F.asc("w1"), F.asc("w2")], k)
    return top.select(label_col, F.col("rank").cast("int"), "w1", "w2", "n12", "g2")
