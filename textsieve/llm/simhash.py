"""SimHash near-dedup with multi-index hashing.

Fingerprints are folded into distinct values first, so copies cost one row.
Two fingerprints that differ in at most ``max_bits`` of 64 bits differ in at
most half of that in one of their two 32-bit segments: each segment's small
Hamming ball is enumerated, matches are fetched from the segment's table, and
complete distances are verified.

A segment value that many fingerprints share would make all pairs within its
bucket. Such a bucket is split again: its members agree in 32 bits up to the
ball, so the same search runs over the other 32 bits in segments of 16, and
once more in segments of 8, where a bucket holds at most 2**8 values.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textsieve.llm.common import own, quoted, read, text_batches, write_table
from textsieve.llm.components import components

SEED = 42
BLOCK = 1 << 16


def fingerprint_of(text: str | None, words: int = 3) -> int:
    """SimHash of a text's word shingles as a signed 64-bit number (see the module's query for the definition)."""
    import xxhash

    toks = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not toks:
        return 0
    joined = b" ".join(toks)
    lens = np.fromiter(map(len, toks), dtype=np.int64, count=len(toks))
    ends = np.cumsum(lens + 1) - 1
    starts = ends - lens
    n = max(1, len(toks) - words + 1)
    starts, ends = starts[:n], ends[min(words, len(toks)) - 1:]
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    @F.pandas_udf("long")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return udf(text)


def _ball(bits: int) -> Column:
    """Masks of a segment's Hamming ball of radius 1."""
    return F.array(*[F.lit(m).cast("long") for m in (0, *(1 << b for b in range(bits)))])


def _segment(rest: Column, bits: int, i: int) -> Column:
    return F.shiftrightunsigned(rest, i * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _verified(pairs: DataFrame, max_bits: int) -> DataFrame:
    return pairs.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits).select(
        F.col("fp").alias("a"), F.col("other").alias("b"))


def links(prints: DataFrame, max_bits: int = 3, bucket: int = 256) -> DataFrame:
    """``a, b`` for all pairs of distinct fingerprints (column ``fp``, each once) within ``max_bits``; pairs may repeat.

    ``max_bits`` is 3 at most: then one of two segments differs in one bit at most. Buckets of more than ``bucket``
    table rows are split by finer segments, exactly; none is cut.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius 1 cover at most 3 differing bits")
    both = prints.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("seg"))
    value = F.when(F.col("seg") == 0, _segment(F.col("fp"), 32, 0)).otherwise(_segment(F.col("fp"), 32, 1))
    # the 32 bits that the key leaves open
    rest = F.when(F.col("seg") == 0, _segment(F.col("fp"), 32, 1)).otherwise(_segment(F.col("fp"), 32, 0))
    table = both.select("fp", (F.shiftleft(F.col("seg").cast("long"), 32) + value).alias("key"), rest.alias("rest"))
    # of two values one bit apart, one is the other with a bit cleared: only that one need look the other up
    masks = table.select("fp", "key", "rest", F.explode(_ball(32)).alias("mask"))
    low = F.col("key").bitwiseAND(F.lit((1 << 32) - 1).cast("long"))
    probes = masks.where((F.col("mask") == 0) | (low.bitwiseAND(F.col("mask")) != 0)).select(
        F.col("fp").alias("other"), F.col("key").bitwiseXOR(F.col("mask")).alias("key"), F.col("rest").alias("other_rest"))
    return _search(table, probes, 16, max_bits, bucket)


def _search(table: DataFrame, probes: DataFrame, bits: int, max_bits: int, bucket: int) -> DataFrame:
    """Matches of ``probes`` (other, key, other_rest) in ``table`` (fp, key, rest), verified. ``bits``: the segments
    by which a bucket that is too large is split; at 4 the key has fixed all but 8 bits."""
    large = None
    if bits >= 8:
        large = write_table(table.groupBy("key").count().where(F.col("count") > bucket).select("key"))
        if large.isEmpty():
            large = None
    cold = table if large is None else table.join(large, "key", "left_anti")
    # Spark takes an exploded side for as small as the fingerprints, and would broadcast its rows, some 34 for each
    found = _verified(cold.hint("merge").join(probes.hint("merge"), "key").where(F.col("fp") != F.col("other")), max_bits)
    if large is None:
        return found
    # inside a large bucket: either of two halves of the open bits differs in one bit at most
    sub = lambda df, c: df.withColumn("half", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "value", F.when(F.col("half") == 0, _segment(F.col(c), bits, 0)).otherwise(_segment(F.col(c), bits, 1)))
    # the key of the next level: what was fixed so far, which half, and its value
    finer = lambda v: F.xxhash64("key", "half", v).alias("key")
    open_bits = lambda c: F.when(F.col("half") == 0, _segment(F.col(c), bits, 1)).otherwise(_segment(F.col(c), bits, 0))
    hot = sub(table.join(large, "key", "left_semi"), "rest").select(
        "fp", finer(F.col("value")), open_bits("rest").alias("rest"))
    hot_probes = sub(probes.join(large, "key", "left_semi"), "other_rest").withColumn(
        "mask", F.explode(_ball(bits))).select(
        "other", finer(F.col("value").bitwiseXOR(F.col("mask"))), open_bits("other_rest").alias("other_rest"))
    return found.unionByName(_search(write_table(hot), write_table(hot_probes), bits // 2, max_bits, bucket))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
            max_bits: int = 3) -> tuple[DataFrame, DataFrame]:
    """Two tables: ``id, body, fp`` of each row, and ``fp, component_id, keeper`` of each distinct fingerprint.

    ``component_id`` is the smallest id reachable (null only if no row of the component has an id); ``keeper`` is
    the (id, body) of the one document that stands for it, ``body`` being the md5 of the text.
    """
    rows = write_table(text_batches(docs).select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("body"),
                                   fingerprint(F.col(text_col), words).alias("fp")))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("body").alias("body")))
    distinct = write_table(rows.groupBy("fp").agg(first.alias("least")))
    roots = write_table(components(links(distinct.select("fp"), max_bits)))
    rooted = write_table(distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"))
    keepers = write_table(rooted.groupBy("root").agg(F.min("least").alias("keeper")))
    # a large component has many fingerprints: both sides are tables, so Spark may split its rows
    groups = write_table(rooted.join(keepers, "root").select(
        "fp", F.col("keeper.id").alias("component_id"), F.struct("keeper.id", "keeper.body").alias("keeper")))
    return rows, groups


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """``id, fingerprint`` (16 hex digits) and ``component_id`` of each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. Rows that repeat an id are rows of their
    own. An empty table gives an empty table.
    """
    rows, groups = classes(docs, id_col, text_col, words, max_bits)
    return rows.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` that stand for their near-duplicate group: the one with the smallest id (null ids last,
    ties by the md5 of the text, equal rows once)."""
    _, groups = classes(docs, id_col, text_col, words, max_bits)
    # one row per component, not one per fingerprint of a large one
    keepers = write_table(groups.select(F.col("keeper.id").alias(own("id")), F.col("keeper.body").alias(own("body"))).distinct())
    keyed = docs.select("*", F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias(own("text_md5")))
    # a row for most documents, of more bytes than its file: never one for the driver
    kept = keyed.join(keepers.hint("merge"), F.col(id_col).eqNullSafe(F.col(own("id"))) & (F.col(own("text_md5")) == F.col(own("body"))))
    # equal rows of one id and text
    nth = F.row_number().over(W.partitionBy(own("id"), own("body")).orderBy(F.lit(1)))
    return kept.withColumn(own("nth"), nth).where(F.col(own("nth")) == 1).select(*map(quoted, docs.columns))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its fingerprint and the smallest doc_id reachable over links of 3 bits at most."""
    return near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {"op1_simhash": op1_simhash}
ORACLES: dict[str, str] = {}
