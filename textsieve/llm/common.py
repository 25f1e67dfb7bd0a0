"""Helpers that several operators share.

Working columns stand beside the caller's under names with the prefix
``_llm_``, which is reserved; any other name may occur in the input. A
caller's column with the name of a result column is replaced by the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.session import write_table

ASCII_WHITESPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def n_words(c: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    t = F.btrim(F.coalesce(c, F.lit("")), F.lit(ASCII_WHITESPACE))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, WORD_SPLIT))).cast("long")


def own(name: str) -> str:
    """Name of a working column."""
    return f"_llm_{name}"


def quoted(name: str) -> Column:
    """A caller's column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_results(df: DataFrame, original: list[str], results: dict[str, Column]) -> DataFrame:
    """The caller's columns, then the results; a result replaces a column of its name."""
    low = {r.lower() for r in results}
    keep = [quoted(c) for c in original if c.lower() not in low]
    # results are made in a step of their own, so that none refers to another by a caller's name
    out = df.select(*keep, F.struct(*[v.alias(k) for k, v in results.items()]).alias(own("results")))
    return out.select(*keep, *[F.col(own("results")).getField(k).alias(k) for k in results])


def text_batches(df: DataFrame, megabytes: int = 4) -> DataFrame:
    """``df``, after bounding the bytes of an Arrow batch in its session: texts are of any length, and the default of
    64 MB, held on both sides of the pipe by every task, is most of a small executor's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")
    return df


__all__ = ["read", "ascii_lower", "n_words", "own", "quoted", "with_results", "text_batches", "write_table"]
