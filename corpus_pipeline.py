"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, byte-level BPE.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``docs``, whatever these are; the
columns ``doc_id``, ``text``, ``lang`` and ``source`` must be among them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm import bpe, line_dedup, mixing, quality_rules, simhash
from textsieve.llm.common import quoted, read
from textsieve.session import drop_table, write_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and both divergence rules; null and empty texts fail the base rule."""
    return quality_rules.with_verdict(docs).where(F.col("_llm_quality.kept")).select(*map(quoted, docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that at least three documents share and a larger doc_id keeps; ``n_chars``
    follows the text. A document that loses all its lines stays with an empty text."""
    kept = line_dedup.with_kept_lines(docs)
    return kept.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else quoted(c) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document appears as often as the mix takes it, not at all if it does not."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of every document, copies included."""
    return bpe.token_digests(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mix_stage),
    ("byte_bpe", token_stage),
]

#: Fingerprints, divergence references and token ids have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir))
        if before is not None:
            drop_table(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
