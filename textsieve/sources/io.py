"""Sources and sinks.

Schemas are always explicit: a CSV is never schema-inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.functions.text import WHITESPACE_CLASS

RAW_SCHEMA = T.StructType([
    T.StructField("v1", T.StringType()),
    T.StructField("v2", T.StringType()),
    T.StructField("_c2", T.StringType()),
    T.StructField("_c3", T.StringType()),
    T.StructField("_c4", T.StringType()),
])

# Texts the pandas CSV reader turns into nulls (compatibility mode only).
PANDAS_NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (local, HDFS,
    object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path is a folder, likewise."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def load_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, encoding: str = "ISO-8859-1",
             na_values: list[str] | None = None) -> DataFrame:
    """Header CSV with quoted fields that may hold newlines and doubled
    quotes (G1). Missing columns of ``schema`` come back null; missing files
    raise. ``na_values`` turns listed texts into nulls (G3)."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no CSV at {path}")
    df = (spark.read.schema(schema)
          .options(header=True, multiLine=True, escape='"', quote='"', encoding=encoding, mode="PERMISSIVE")
          .csv(path))
    if na_values:
        df = df.select(*[F.when(F.col(c).isin(na_values), F.lit(None)).otherwise(F.col(c)).alias(c)
                         if t == "string" else F.col(c) for c, t in df.dtypes])
    return df


def load_csv_strict(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """The older scan. The header names the columns, the three junk columns must be there, and go."""
    df = (spark.read.options(header=True, multiLine=True, escape='"', quote='"', encoding=encoding).csv(path))
    junk = df.columns[2:5]
    if len(junk) < 3:
        raise ValueError(f"three columns after the first two expected, found {len(df.columns)} in all")
    return df.drop(*junk)


def load_and_preprocess(spark: SparkSession, path: str, **kw) -> DataFrame:
    """S3 (and S2): S1 then P1-P4."""
    from textsieve.operators.prepare import preprocess_data

    return preprocess_data(load_csv(spark, path, **kw))


def strip_py(c):
    """Python's ``str.strip()``: Unicode whitespace at both ends."""
    return F.regexp_replace(c, f"^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$", "")


def message_lines(df: DataFrame, text_col: str = "value", keep=()) -> DataFrame:
    """S4 on a text column: one message per line, stripped, blank lines
    dropped: ``(*keep, line_no, line)`` with the 1-based line position."""
    parts = F.split(F.col(text_col), "\r\n|\r|\n")
    x = df.select(*keep, F.posexplode(parts).alias("_pos", "_raw"))
    return x.select(*keep, (F.col("_pos") + 1).cast("int").alias("line_no"), strip_py(F.col("_raw")).alias("line")) \
        .where(F.col("line") != "")


def read_message_lines(spark: SparkSession, path: str) -> DataFrame:
    """A text file, one message per line."""
    df = spark.read.text(path).select(strip_py(F.col("value")).alias("text"))
    return df.where(F.col("text") != "")


def read_whole_file(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one message, unstripped."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def write_predictions_json(pred: DataFrame, path: str, text_col: str = "text"):
    """JSON lines, one record per prediction."""
    pred.select(F.col(text_col).alias("text"), "preprocessed_text", "prediction", "label", "probability",
                "confidence").write.mode("overwrite").json(path)


def write_predictions_text(pred: DataFrame, path: str, text_col: str = "text"):
    """Formatted records, a blank line between records."""
    from textsieve.plans.predict import format_result

    pred.select(F.concat(format_result(pred, text_col), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_run_summary(results: DataFrame, dataset: DataFrame, path: str):
    """Per-model metrics, training times and which one is best, and the one-row dataset description, as JSON."""
    results.write.mode("overwrite").json(f"{path}/models")
    dataset.write.mode("overwrite").json(f"{path}/dataset")
