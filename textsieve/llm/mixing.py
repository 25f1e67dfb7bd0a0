"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by a hash of its documents. A document's virtual
finish time is the cumulative number of its source's tokens divided by the
source's target; a source whose target exceeds its size goes round again. All
copies are then range-sorted by finish time and the queue is truncated at the
total budget. Both running sums are distributed: rows are range-partitioned,
written once, and per-partition totals give the offsets.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textsieve.llm.common import n_words, own, quoted, read, with_results, write_table

WEIGHTS = (5, 2, 1)


def running_sum(df: DataFrame, order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with the inclusive sum of ``value`` over all rows up to each row in ``order``.

    The range partitions are stamped and written once, so every reader sees the same ones; the only step over
    all partitions together sees one row per partition.
    """
    def add_up(batches):
        done = 0
        for batch in batches:
            sums = pc.add(pc.cumulative_sum(batch.column(value)), done)
            if len(sums):
                done = sums[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, sums], names=[*batch.schema.names, "_within"])

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    stamped = write_table(ranged.mapInArrow(add_up, T.StructType([*ranged.schema, T.StructField("_within", T.LongType())])))
    sums = stamped.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    # one row per range partition: its size is the number of shuffle partitions
    return (stamped.join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_within") + F.col("_before"))
            .drop("_part", "_within", "_before"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.0, max_copies: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, before, target``.

    Sources in code point order (null last) take the weights in turn and share ``share`` of all tokens. A target
    stops at ``max_copies`` times its source's size; the excess goes to the others by weight until none is above.
    That fixed point is a level: sources fill up in the order of (cap / weight), so one sorted pass finds it.
    ``before`` is the number of tokens of all earlier sources.
    """
    per = write_table(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    by_name = W.orderBy(F.col("source").isNull(), F.col("source"))
    i = F.row_number().over(by_name) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (i % len(weights) + 1).cast("int"))
    per = per.select(
        "source", "source_size", pick.alias("weight"),
        F.coalesce(F.sum("source_size").over(by_name.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        (F.col("source_size") * max_copies).cast("double").alias("cap"),
    )
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    full_at = F.col("cap") / F.col("weight")
    order = W.orderBy("full_at", F.col("source").isNull(), F.col("source"))
    per = (
        per.withColumn("full_at", full_at)
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("filled", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
        # the level if all earlier sources are full and this one and the later ones are not
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("open_weight"))
        .withColumn("open", F.col("level") < F.col("full_at"))
        .withColumn("level", F.min(F.when(F.col("open"), F.struct("full_at", "level"))).over(every).getField("level"))
    )
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return per.select("source", "source_size", "before", target.alias("target"))


def queue(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share: float = 1.0,
          max_copies: int = 3) -> DataFrame:
    """One row per distinct row of ``docs``: ``id, source, size, body`` (md5 of the text), ``rows`` (how many equal
    rows there are), ``k`` (how many copies of them the mix takes, at most ``max_copies`` each), ``first_finish``,
    ``source_size`` and ``target``. Narrow: texts do not move.
    """
    sized = write_table(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("shuffled"),
        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("body")))
    targets = write_table(source_targets(sized, weights, share, max_copies))
    order = [F.col("source").isNull(), F.col("source"), F.col("shuffled"), F.col("id"), F.col("size"), F.col("body")]
    placed = running_sum(sized, order, "size", "upto").join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    budget = targets.agg(F.sum("source_size").alias("b")).first()["b"]
    budget = (budget or 0) * share
    # a document of round c (0, 1, ...) ends when its source has sent c whole rounds and the words up to it
    finish = (F.col("c") * F.col("source_size") + F.col("upto") - F.col("before")) / F.col("target")
    turns = (
        placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_copies - 1))).alias("c"))
        .withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0)))
        .select("id", "source", "shuffled", "size", "body", "source_size", "target", "c", "finish")
    )
    line = running_sum(turns, [F.col("finish"), F.col("source").isNull(), F.col("source"), F.col("c"),
                               F.col("shuffled"), F.col("id"), F.col("size"), F.col("body")], "size", "sent")
    # the queue is truncated at the budget; the copies of equal rows stay together
    taken = F.sum((F.col("sent") <= F.lit(budget)).cast("long"))
    return (line.groupBy("id", "source", "size", "body")
            .agg(taken.alias("k"), (F.count("*") / max_copies).cast("long").alias("rows"),
                 F.min("finish").alias("first_finish"), F.first("source_size").alias("source_size"),
                 F.first("target").alias("target")))


def with_copies(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **options) -> DataFrame:
    """``docs`` with ``_llm_size``, ``_llm_source_size``, ``_llm_target`` and ``_llm_copies``; see ``mix``."""
    per = queue(docs, id_col, text_col, source_col, **options)
    per = write_table(per.select(*[F.col(c).alias(own(c)) for c in (
        "id", "source", "size", "body", "rows", "k", "source_size", "target")]))
    keyed = docs.select("*", F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias(own("text_md5")))
    # a row for each document, of more bytes than its file: never one for the driver
    joined = keyed.join(per.hint("merge"), F.col(id_col).eqNullSafe(F.col(own("id"))) & (F.col(own("text_md5")) == F.col(own("body")))
                        & F.col(source_col).eqNullSafe(F.col(own("source"))))
    # equal rows only: a window is the rows of one id, source and text
    nth = F.row_number().over(W.partitionBy(own("id"), own("source"), own("body")).orderBy(F.lit(1))) - 1
    k, rows = F.col(own("k")), F.col(own("rows"))
    return joined.withColumn(own("copies"), (F.floor(k / rows) + (nth < k % rows).cast("long")).cast("long"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share: float = 1.0,
        max_copies: int = 3) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    Null texts have size 0. A null source is a source of its own, the last. Equal rows share their copies out: of
    ``r`` equal rows that the mix takes ``k`` times, the first ``k mod r`` take one more than the rest. A document
    of size 0 counts as taken when its finish time lies in the budget; its ``taken`` is 0 all the same. An empty
    table gives an empty table. The order depends on ids and texts alone, so reruns agree.
    """
    df = with_copies(docs, id_col, text_col, source_col, weights=weights, share=share, max_copies=max_copies)
    get = lambda c: F.col(own(c))
    return with_results(df, docs.columns, {
        **{c: get(c) for c in ("size", "source_size", "target", "copies")}, "taken": (get("size") * get("copies")).cast("long")})


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of ``docs``."""
    copies = F.col(own("copies"))
    return (with_copies(docs, **options).where(copies > 0)
            .select(*map(quoted, docs.columns), F.explode(F.sequence(F.lit(1), copies)).alias(own("nth")))
            .select(*map(quoted, docs.columns)))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words that the mix takes from it."""
    per = queue(read(spark, sf_dir, "documents"))
    # equal rows come back one by one
    return (per.select("*", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1)).alias("nth"))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * (F.floor(F.col("k") / F.col("rows"))
                                      + (F.col("nth") < F.col("k") % F.col("rows")).cast("long")))
                    .cast("long").alias("taken")))


QUERIES = {"op7_mixing": op7_mixing}
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS shuffled,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
  FROM sized GROUP BY source),
filling AS (
  SELECT *, (3 * source_size)::DOUBLE AS cap, 3 * source_size / weight AS full_at, sum(source_size) OVER () AS budget,
         coalesce(sum(3 * source_size::DOUBLE) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM per),
level AS (
  SELECT arg_min((budget - filled) / open_weight, full_at) AS level
  FROM filling WHERE (budget - filled) / open_weight < full_at),
targets AS (
  SELECT source, source_size, budget, least(cap, coalesce(level * weight, cap)) AS target FROM filling, level),
placed AS (
  SELECT s.*, source_size, target, budget,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, CASE WHEN target > 0 THEN (c * source_size + upto) / target ELSE 0 END AS finish
  FROM placed, (SELECT unnest([0, 1, 2]) AS c)),
line AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, c, shuffled, doc_id ROWS UNBOUNDED PRECEDING) AS sent
  FROM turns)
SELECT doc_id, size, source_size, target, (size * count(*) FILTER (WHERE sent <= budget))::BIGINT AS taken
FROM line GROUP BY doc_id, size, source_size, target
"""

ORACLES = {"op7_mixing": ORACLE}
