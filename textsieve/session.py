"""Spark session helpers."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import types as T

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # delete checkpoint files once their DataFrames are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "textsieve", conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a single-process session (``local[...]``, as in tests)
    gets a scratch folder of its own; a cluster session is refused, because
    its executors share no local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="textsieve-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` in the checkpoint folder (reliable storage, survives
    executor loss) and return a DataFrame that reads it back, so later plans
    do not repeat its lineage. Never a local checkpoint."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    # persisted first, so writing the checkpoint reads the cached blocks
    # instead of computing the plan a second time
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def write_table(df, parts: str | None = None):
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder and
    reading it back: one job (a checkpoint takes two). For tables whose
    partitioning need not survive (vocabulary, model tables, weights). The
    folder goes when the application ends; ``drop_table`` removes it sooner.
    With ``parts``, a column of the table, each of its values has a folder of
    its own: see ``part_of``."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(parts) if parts else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    out._written_at = path
    return out


def part_of(table, parts: str, value):
    """The rows of a table of ``write_table(df, parts)`` with one value of that column, which it leaves out;
    ``drop_table`` deletes these rows alone."""
    path = f"{table._written_at}/{parts}={value}"
    schema = T.StructType([f for f in table.schema if f.name != parts])
    where = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).exists(where):
        return table.sparkSession.createDataFrame([], schema)
    out = table.sparkSession.read.schema(schema).parquet(path)
    out._written_at = path
    return out


def drop_table(df):
    """Delete a table of ``write_table`` that nothing lazy reads any more."""
    spark, path = df.sparkSession, getattr(df, "_written_at", None)
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
