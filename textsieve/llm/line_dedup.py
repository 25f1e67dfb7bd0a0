"""Line dedup: explode normalised lines, hash, count distinct documents per
hash, drop lines over the threshold, reassemble by position.

Built-in functions only. The explode carries a 128-bit hash, never the line,
so a passage that a third of all documents share costs one small row per
document; the hashes are made once, the counts combine map-side, and the rows
that go meet their documents over a join of plain tables, which Spark splits
where a key is hot. Texts move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import ASCII_WHITESPACE, ascii_lower, own, quoted, read, with_results, write_table


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_WHITESPACE)))


def with_kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                    min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` rebuilt, and ``_llm_n_lines`` and ``_llm_n_dropped``; see ``line_dedup``."""
    text = F.col(text_col)
    # a row is known by its id and text: rows of one id may have other texts, and those of one text lose the same lines
    row = F.xxhash64(text)
    hashed = write_table(
        docs.select(F.col(id_col).alias("id"), row.alias("row"),
                    F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("pos", "line"))
        .select("id", "row", "pos", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_chars)
        # two seeds: 128 bits
        .select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    common = write_table(
        hashed.groupBy("h1", "h2")
        .agg((F.count_distinct("id") + F.max(F.col("id").isNull().cast("int"))).alias("n"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "keeper")
    )
    gone = F.col(own("gone"))
    drops = (
        hashed.join(common, ["h1", "h2"])
        .where(F.col("id").isNull() | (F.col("id") < F.col("keeper")))
        .groupBy(F.col("id").alias(own("id")), F.col("row").alias(own("row")))
        .agg(F.collect_set("pos").alias(own("gone")))
    )
    # texts stream past a hash table of the drops of their partition: they are neither sorted nor held
    joined = docs.join(drops.hint("shuffle_hash"),
                       F.col(id_col).eqNullSafe(F.col(own("id"))) & (row == F.col(own("row"))), "left")
    n_lines = F.when(text.isNull(), 1).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    # an array of one element names the lines, so that a text is split once and not for each line that stays
    rebuilt = F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.concat_ws("\n", F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))))[0]
    return joined.select(
        *[F.when(gone.isNull(), text).otherwise(rebuilt).alias(c) if c == text_col else quoted(c) for c in docs.columns],
        n_lines.cast("long").alias(own("n_lines")),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias(own("n_dropped")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
               min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay, plus ``n_lines`` (before dropping) and ``n_dropped``.

    A line's key is the line with ASCII white space stripped at both ends and
    A-Z lower-cased. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` distinct documents lose all their lines except in the
    largest id that holds them. Null or empty texts have one empty line; null
    stays null. Rows that repeat an id count as one document, and each row
    loses its own lines only; all null ids together count as one document,
    smaller than any other. An empty table gives an empty table.
    """
    return with_results(with_kept_lines(docs, id_col, text_col, min_chars, min_docs), docs.columns, {
        "n_lines": F.col(own("n_lines")), "n_dropped": F.col(own("n_dropped"))})


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: how many lines it had, how many went, and the digest of the rest."""
    out = line_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keys AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (
  SELECT k, max(doc_id) AS keeper FROM keys WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT doc_id, pos, line, (keeper IS NOT NULL AND doc_id < keeper) AS gone
  FROM keys LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUERIES = {"op3_line_dedup": op3_line_dedup}
ORACLES = {"op3_line_dedup": ORACLE}
