"""Streaming scoring (ST1, ST2).

``readStream`` -> the same scoring plan as batch -> ``writeStream``. A model that scores inside the row has no state and
no aggregation, so it scores the stream itself, in append mode, into Spark's file sink, which lists each batch's files
once (``append_stream``). Any model can be run over micro-batches (``score_stream``): each batch is a table of its own.
Either gives exactly the batch result. Running counts are kept for each epoch of the scored output, so a batch
that is written twice is counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.plans.predict import Predictor
from textsieve.sources.io import is_folder

#: Files of so many bytes together are one batch of a table's stream.
BATCH_BYTES = 256 << 20


def score_stream(stream: DataFrame, predictor: Predictor, out_path: str, checkpoint: str, text_col: str = "text",
                 id_cols=("row_id",), available_now: bool = True):
    """ST1: score each micro-batch with the batch plan (``foreachBatch``) and
    append it under ``out_path/epoch=N``. Rewriting an epoch overwrites only
    that epoch's folder, so a retried batch is written once (idempotent)."""

    def write(batch: DataFrame, epoch: int):
        predictor.transform(batch, text_col, id_cols).write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def append_stream(stream: DataFrame, predictor: Predictor, out_path: str, checkpoint: str, text_col: str = "text",
                  id_cols=("row_id",), available_now: bool = True):
    """ST1 without micro-batch code: the scored stream appended to ``out_path``. Readers of that folder see a batch that
    was written twice once. Raises for a model that needs other rows than the one it scores."""
    if not predictor.scores_in_the_row():
        raise ValueError("this model does not score inside the row: use score_stream")
    w = predictor.transform(stream, text_col, id_cols).writeStream.format("parquet").outputMode("append")
    w = w.option("path", out_path).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def stream_parquet(spark: SparkSession, folder: str, schema, file_glob: str = "*.parquet",
                   max_files: int = 1, max_bytes: int | None = None) -> DataFrame:
    """A file stream over ``folder`` (new files matching ``file_glob``), of ``max_files`` a batch, or of files of
    ``max_bytes`` together."""
    limit = ("maxBytesPerTrigger", max_bytes) if max_bytes else ("maxFilesPerTrigger", max_files)
    return spark.readStream.schema(schema).option(*limit).option("pathGlobFilter", file_glob).parquet(folder)


def stream_table(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """A file stream over the table ``name`` of ``folder``: one file, or a folder of part files. Batches are bounded by
    their bytes, so their number does not follow that of the files."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    if is_folder(spark, path):
        return stream_parquet(spark, path, schema, "*", max_bytes=BATCH_BYTES)
    return stream_parquet(spark, folder, schema, f"{name}.parquet", max_bytes=BATCH_BYTES)


def write_epoch_counts(counts: DataFrame, state: str):
    """Replace the counts of the epochs in ``counts(epoch, label, n)``: each epoch has a folder of its own."""
    counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(state)


def scored_stream_counts(spark: SparkSession, scored_path: str, schema, state: str, checkpoint: str,
                         available_now: bool = True):
    """ST2: keep the counts by label of what ``score_stream`` writes, one set for each epoch, under ``state``.

    New files only tell which epochs have changed; an epoch is then counted anew from its folder and its earlier counts
    are replaced. So an epoch that is written again by a retried batch, in files of other names, and a batch of this
    stream that runs again after a crash both count once. ``schema`` has the column ``epoch`` of the folders' names."""
    changed = spark.readStream.schema(schema).parquet(scored_path).select("epoch")

    def update(batch: DataFrame, _: int):
        # the epochs of a batch: as many as the scoring stream has written since the last one
        epochs = [r[0] for r in batch.distinct().collect()]
        if epochs:
            now = spark.read.schema(schema).parquet(scored_path).where(F.col("epoch").isin(epochs))
            write_epoch_counts(now.groupBy("epoch", "label").agg(F.count(F.lit(1)).alias("n")), state)

    w = changed.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def running_counts(spark: SparkSession, state: str) -> DataFrame:
    """``(label, n)`` over all epochs counted so far."""
    counts = spark.read.schema("label string, n long, epoch long").parquet(state)
    return counts.groupBy("label").agg(F.sum("n").alias("n"))


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    from textsieve.session import ensure_checkpoint_dir

    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
