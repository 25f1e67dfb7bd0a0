"""Raw message table -> labelled messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The junk columns of the reference's CSV, by their pandas and Spark names.
JUNK_COLUMNS = ["Unnamed: 2", "Unnamed: 3", "Unnamed: 4", "_c2", "_c3", "_c4"]


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop the unnamed junk columns that are present."""
    return df.drop(*[c for c in JUNK_COLUMNS if c in df.columns])


def rename_columns(df: DataFrame) -> DataFrame:
    """v1 -> label, v2 -> message, only if both exist."""
    if "v1" in df.columns and "v2" in df.columns:
        return df.withColumnsRenamed({"v1": "label", "v2": "message"})
    return df


def encode_label(c) -> F.Column:
    """Spam -> 1, ham -> 0, anything else -> null (exact, case-sensitive)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == "spam", F.lit(1)).when(c == "ham", F.lit(0)).cast("int")


def decode_label(c) -> F.Column:
    """1 -> spam, anything else -> ham."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 1, F.lit("spam")).otherwise(F.lit("ham"))


def encode_labels(df: DataFrame) -> DataFrame:
    """P3 on the ``label`` column, only if it is string-typed."""
    if "label" in df.columns and dict(df.dtypes)["label"] == "string":
        return df.withColumn("label", encode_label("label"))
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """A1: ``(column, n_null)`` for columns that have nulls; one aggregation."""
    cols = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_null")) for i, c in enumerate(cols)])
    return counts.select(F.inline(pairs)).where(F.col("n_null") > 0)


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows null in label or message; in every column when there is
    no ``label``. A ``label`` without ``message`` is an error (Q7)."""
    if "label" in df.columns:
        if "message" not in df.columns:
            raise ValueError("column 'message' is missing; cannot drop rows with a null message")
        return df.dropna(subset=["label", "message"])
    return df.dropna()


def preprocess_data(df: DataFrame) -> DataFrame:
    """P5: P1 -> P2 -> P3 -> P4."""
    return df.transform(drop_junk_columns).transform(rename_columns).transform(encode_labels).transform(drop_null_rows)


def split_features_target(df: DataFrame) -> DataFrame:
    """``(message, label)`` by name, else columns 1 and 0 by position.
    Both stay in one DataFrame (rows never lose their pairing)."""
    if "message" in df.columns and "label" in df.columns:
        return df.select(F.col("message"), F.col("label"))
    cols = df.columns
    return df.select(F.col(cols[1]).alias("message"), F.col(cols[0]).alias("label"))


def filter_class(df: DataFrame, value: int, label_col: str = "label") -> DataFrame:
    """The rows of one class."""
    return df.where(F.col(label_col) == value)


def class_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A2: ``(label, n, pct)`` by descending count. The total comes from a
    second partial+final aggregate, not from a global window."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return counts.select(
        F.col(label_col), F.col("n"), (F.lit(100.0) * F.col("n") / F.lit(total)).alias("pct")
    ).orderBy(F.desc("n"), label_col)


def dataset_info(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A3: one row: rows, columns, spam and ham counts."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.count_if(F.col(label_col) == 1).alias("n_spam"),
        F.count_if(F.col(label_col) == 0).alias("n_ham"),
    )
