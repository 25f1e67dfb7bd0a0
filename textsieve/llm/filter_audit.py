"""Filter interaction audit: what each filter removes in every order of the filters.

A document is reduced to a mask, one bit for each filter that it fails. What an
order removes at each step depends on the mask alone, so documents are counted
by part and mask first: at most 32 cells a part. Each cell then folds across
the array of all 120 orders with higher-order SQL functions: ``transform`` over
the orders, ``aggregate`` over the five filters of an order, and the cell gives
600 structs weighted by its counts. A part's cells are merged by elementwise
sums. The array of orders is a literal that Spark broadcasts to the tasks with
the plan. No document is looked at more than once, and no order is run.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import ASCII_WHITESPACE, UPPER, WORD_SPLIT, read, write_table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]
#: Counts of a step, all long.
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 200, 50, 2, r"[#$%&*|]"


def text_mask(text: Column) -> Column:
    """The filters that a text (not null) fails by itself, A to D as bits 1, 2, 4 and 8."""
    trimmed = F.btrim(text, F.lit(ASCII_WHITESPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT))
    # one element, so that the words of a text are made once
    by_words = F.transform(F.array(F.struct(words.alias("w"))), lambda s: F.struct(
        F.size(s["w"]).alias("n"), F.size(F.array_distinct(s["w"])).alias("d")))[0]
    n, distinct = by_words["n"].cast("long"), by_words["d"].cast("long")
    upper = (F.length(text) - F.length(F.translate(text, UPPER, ""))).cast("long")
    bit = lambda fails, value: F.when(fails, value).otherwise(0)
    return (bit(n < MIN_WORDS, 1) + bit(100 * distinct < MIN_DISTINCT * n, 2)
            + bit(100 * upper > MAX_UPPER * F.length(text), 4) + bit(F.regexp_like(text, F.lit(SYMBOLS)), 8))


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``id, part, mask`` of each row: the filters that it fails, A to E as bits 1 to 16; a table of narrow rows. A text
    fails E if a smaller id of the whole table has an identical text (128-bit hash)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = write_table(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")))
    # the least id of each text combines map-side; looking it up by text and id leaves no hot key, as a group of copies
    # has many ids. A null id is smaller than none.
    least = narrow.where("id is not null").groupBy("h1", "h2").agg(F.min("id").alias("id")).withColumn("_first", F.lit(True))
    known = narrow.join(least, ["h1", "h2", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("_first").isNull()
    return known.select("id", "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"))


def cells(masked: DataFrame, labels: DataFrame | None, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part and mask, and those that a label calls good or toxic."""
    if labels is None:
        named = masked.withColumn("good", F.lit(0)).withColumn("toxic", F.lit(0))
    else:
        marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
        named = masked.join(marks, "id", "left")
    return named.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("toxic"))


_ORDERS = "array(" + ", ".join("array(" + ", ".join(str(FILTERS.index(f)) for f in o) + ")" for o in ORDERS) + ")"
_NONE = "cast(array() as array<struct<" + ", ".join(f"{m}: bigint" for m in MEASURES) + ">>)"
#: One order over one cell. The fold holds the steps so far and whether an earlier filter has removed the cell.
_FOLD = f"""aggregate(o, struct({_NONE} as steps, false as gone), (s, f) -> struct(
  concat(s.steps, array(struct(
    if(s.gone or (mask & shiftleft(1, f)) <> 0, 0L, n) as kept,
    if(not s.gone and (mask & shiftleft(1, f)) <> 0, n, 0L) as removed,
    if(s.gone and (mask & shiftleft(1, f)) <> 0, n, 0L) as redundant,
    if(mask = shiftleft(1, f), n, 0L) as unique_fails,
    if(not s.gone and (mask & shiftleft(1, f)) <> 0, good, 0L) as good_lost,
    if(not s.gone and (mask & shiftleft(1, f)) <> 0, toxic, 0L) as toxic_lost))) as steps,
  s.gone or (mask & shiftleft(1, f)) <> 0 as gone), s -> s.steps)"""
_PLUS = "struct(" + ", ".join(f"x.{m} + y.{m} as {m}" for m in MEASURES) + ")"


def folded(counted: DataFrame) -> DataFrame:
    """``part, steps``: of each part the 600 structs of ``MEASURES``, order by order and step by step."""
    each = counted.select("part", F.expr(f"flatten(transform({_ORDERS}, o -> {_FOLD}))").alias("steps"))
    # a part has 32 cells at most, so a group is bounded whatever the number of documents
    merged = each.groupBy("part").agg(F.collect_list("steps").alias("all"))
    return merged.select("part", F.expr(
        f"aggregate(slice(all, 2, greatest(size(all) - 1, 1)), all[0], (a, b) -> zip_with(a, b, (x, y) -> {_PLUS}))").alias("steps"))


def filter_audit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step: ``part, filter_order, step`` and the counts of the part.

    ``kept`` after this step, ``removed`` here, ``redundant`` (failing this filter, removed earlier), ``unique_fails``
    (failing this filter only), ``good_lost`` and ``toxic_lost`` (removed here, by label), ``shapley`` (what this filter
    removes, summed over all orders). Every part has all 600 rows, zeros included. Filters: A under 200 words, B under 50 %
    distinct words, C over 2 % capitals, D a character of ``#$%&*|``, E a text that a smaller id has too.

    A null text is the empty text, a null part the empty string. Rows that repeat an id count each; none of them is a copy
    of the other. A null id is smaller than no other and has no smaller one. Labels that repeat an id count as one, marked
    if any of them is; a null label marks nothing. An empty table gives an empty table.
    """
    long = folded(cells(masks(docs, id_col, text_col, part_col), labels, id_col)).select("part", F.posexplode("steps").alias("at", "s"))
    orders = F.array(*[F.lit(o) for o in ORDERS])
    order, step = F.get(orders, F.expr("at div 5").cast("int")), F.col("at") % 5
    rows = long.select("part", order.alias("filter_order"), (step + 1).cast("int").alias("step"),
                       F.substring(order, step + 1, F.lit(1)).alias("filter"), *[F.col("s")[m].alias(m) for m in MEASURES])
    # 120 times five rows a part
    total = rows.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return rows.join(total, ["part", "filter"]).select("part", "filter_order", "step", *MEASURES, "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of ``documents`` by source, 600 rows each."""
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
         trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM documents),
w AS (SELECT *, CASE WHEN trimmed = '' THEN []::VARCHAR[] ELSE string_split_regex(trimmed, '[\x20\x09-\x0D]+') END AS words FROM d),
m AS (
  SELECT w.doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         w.doc_id > min(w.doc_id) OVER (PARTITION BY t) AS e, coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic
  FROM w LEFT JOIN labels l ON w.doc_id = l.doc_id),
fails AS (
  SELECT part, good, toxic, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': coalesce(e, false)} AS f, count(*) AS n FROM m GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
steps AS (SELECT filter_order, s AS step, filter_order[s] AS x, filter_order[1:s - 1] AS before
          FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
counted AS (
  SELECT part, filter_order, step, x, n, good, toxic, f[x] AS failing,
         len(list_filter(string_split(before, ''), lambda y: y <> '' AND f[y])) > 0 AS gone,
         len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: f[y])) AS n_fails
  FROM fails, steps),
sums AS (
  SELECT part, filter_order, step, x,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT failing), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND failing), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND failing), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE failing AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(n) FILTER (WHERE NOT gone AND failing AND good), 0) AS good_lost,
         coalesce(sum(n) FILTER (WHERE NOT gone AND failing AND toxic), 0) AS toxic_lost
  FROM counted GROUP BY part, filter_order, step, x)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM sums
"""

QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLES = {"op11_filter_audit": ORACLE}
