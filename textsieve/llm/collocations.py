"""Phrase collocation mining with mergeable Misra-Gries summaries.

Texts are cut into units of a bounded size, kept as numbers of their words.
First pass: each unit counts its n-grams (1 to 5 words) by hash and sends the
counts to hash partitions. A partition merges them into one Misra-Gries summary
whose capacity exceeds its mass divided by the threshold: the summary never
underestimates by the threshold or more, so every n-gram that reaches it
survives. The partition answers each unit with those of its n-grams that
survive. Second pass: the units count only these, exactly and by their words,
and the counts are added up by phrase.

Every part of a frequent phrase is at least as frequent, so the table of exact
counts holds all that a score needs. Units and partitions are bounded, nothing
is broadcast, and nothing but totals by language reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.batches import byte_classes, split_words
from textsieve.llm.common import read, text_batches
from textsieve.llm.substring_dedup import expand, squeeze
from textsieve.operators.rank import top_k_per_group
from textsieve.session import write_table

MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
#: N-grams (with repeats) of a hash partition on average; with the bytes of a unit, the bound of a task's memory.
PARTITION_MASS = 1 << 22
UNIT_MEGABYTES = 4
#: Bits of an n-gram's hash within its partition. Two n-grams of one hash only add to an estimate, never to a count.
KEY_BITS = 32

CLASSES = byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")

UNIT = "unit long, lang string, n long, words binary, ids binary, begins binary"
UNIT_SCHEMA = pa.schema([("unit", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("words", pa.binary()),
                         ("ids", pa.binary()), ("begins", pa.binary())])
MESSAGE_SCHEMA = pa.schema([("part", pa.int64()), ("unit", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
HIT_SCHEMA = pa.schema([("unit", pa.int64()), ("part", pa.int64()), ("keys", pa.binary())])
COUNT_SCHEMA = pa.schema([("lang", pa.string()), ("part", pa.int64()), ("phrases", pa.binary()), ("counts", pa.binary())])
PHRASE_SCHEMA = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("f", pa.int64())])


# -- units ------------------------------------------------------------------------

def pack_words(words: list[bytes]) -> bytes:
    return squeeze(np.frombuffer(b" ".join(words), dtype=np.uint8)) if words else squeeze(np.zeros(0, np.uint8))


def unpack_words(data: bytes) -> list[bytes]:
    return expand(data, np.uint8).tobytes().split(b" ")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def to_units(batches):
    """An Arrow batch of ``lang, t`` becomes one unit for each language in it."""
    part, seq = TaskContext.get().partitionId(), 0
    for batch in batches:
        lang, texts = batch.column(0), batch.column(1)
        for name in lang.unique():
            own = texts.filter(pc.equal(lang, name))
            ids, words, _, begins = split_words(own, CLASSES)
            if len(ids):
                yield _batch([((part << 32) + seq, name.as_py(), len(ids), pack_words(words), squeeze(ids.astype(np.int32)),
                               np.packbits(begins).tobytes())], UNIT_SCHEMA)
                seq += 1


class Ngrams:
    """The n-grams of a unit: its words, and for each order the hash of the n-gram that starts at a word and whether it
    lies within a piece."""

    def __init__(self, lang: str, words: bytes, ids: bytes, begins: bytes):
        from xxhash import xxh3_64_intdigest

        self.lang, self.words = lang, unpack_words(words)
        self.ids = expand(ids, np.int32)
        self.begins = np.unpackbits(np.frombuffer(begins, np.uint8), count=len(self.ids)).astype(bool)
        seed = xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.hashes = np.fromiter((xxh3_64_intdigest(w, seed) for w in self.words), dtype=np.uint64, count=len(self.words))

    def orders(self, longest: int):
        """``n, hash, ok`` of each order: arrays over the words that an n-gram may start at."""
        own = self.hashes[self.ids]
        h, ok = own, np.ones(len(own), dtype=bool)
        for n in range(1, longest + 1):
            if n > 1:
                h, ok = h[:-1] * np.uint64(0x9E3779B97F4A7C15), ok[:-1] & ~self.begins[n - 1:]
                h += own[n - 1:]
            mixed = h ^ (h >> np.uint64(31))
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            yield n, mixed, ok
            if len(h) <= 1:
                return

    def counted(self, longest: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct cells (the first ``bits`` bits of the hashes) of all n-grams, and how often each occurs."""
        all_of = np.sort(np.concatenate([h[ok] >> np.uint64(64 - bits) for _, h, ok in self.orders(longest)]))
        first = np.flatnonzero(np.concatenate([[True], all_of[1:] != all_of[:-1]])) if len(all_of) else np.zeros(0, np.int64)
        return all_of[first], np.diff(np.append(first, len(all_of)))

    def exact(self, longest: int, bits: int, cells: np.ndarray):
        """``phrase, count`` of each distinct n-gram whose cell is among the sorted ``cells``."""
        for n, h, ok in self.orders(longest):
            cell = h >> np.uint64(64 - bits)
            at = np.searchsorted(cells, cell)
            at[at == len(cells)] = 0
            start = np.flatnonzero(ok & (cells[at] == cell)) if len(cells) else np.zeros(0, np.int64)
            if not len(start):
                continue
            order = np.argsort(h[start], kind="stable")
            start = start[order]
            tuples = np.stack([self.ids[start + i] for i in range(n)], axis=1)
            new = np.concatenate([[True], h[start][1:] != h[start][:-1]])
            if (tuples[1:][~new[1:]] != tuples[:-1][~new[1:]]).any():  # one hash, other words
                tuples, counts = np.unique(tuples, axis=0, return_counts=True)
            else:
                first = np.flatnonzero(new)
                tuples, counts = tuples[first], np.diff(np.append(first, len(start)))
            for t, c in zip(tuples.tolist(), counts.tolist()):
                yield b" ".join([self.words[i] for i in t]), c


# -- summaries ----------------------------------------------------------------------

class MisraGries:
    """A mergeable summary of counts by key: at most ``capacity`` counters, each at most the true count and less by at most
    ``error``; ``error`` is below mass / capacity, the mass being all that was added."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray):
        """Add another summary's counters, or plain counts (keys may repeat)."""
        keys, counts = np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(keys) > self.capacity:
            # the largest counter that has no room is taken off all
            less = int(np.partition(counts, len(counts) - self.capacity - 1)[len(counts) - self.capacity - 1])
            self.error += less
            counts = counts - less
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def may_reach(self, threshold: int) -> np.ndarray:
        """The sorted keys whose true count may be ``threshold`` or more; all that reach it, if capacity > mass / threshold."""
        return self.keys[self.counts + self.error >= threshold]


def survivors(table: pa.Table, min_count: int) -> pa.Table:
    """One hash partition: merges the units' counts and answers each unit with those of its keys that may be frequent."""
    part = table.column("part")[0].as_py()
    sent = zip(table.column("unit").to_pylist(), table.column("keys").to_pylist(), table.column("counts").to_pylist())
    sent = [(u, np.cumsum(expand(k, np.uint64), dtype=np.uint64), expand(c, np.uint32).astype(np.int64)) for u, k, c in sent]
    mass = sum(int(c.sum()) for _, _, c in sent)
    summary = MisraGries(mass // min_count + 1)
    pending, size = [], 0
    for i, (_, k, c) in enumerate(sent):
        pending.append((k, c))
        size += len(k)
        if size > summary.capacity or i == len(sent) - 1:
            summary.merge(np.concatenate([k for k, _ in pending]), np.concatenate([c for _, c in pending]))
            pending, size = [], 0
    good = summary.may_reach(min_count)
    rows = []
    for u, k, _ in sent:
        at = np.searchsorted(good, k)
        at[at == len(good)] = 0
        hit = k[good[at] == k] if len(good) else k[:0]
        if len(hit):
            rows.append((u, part, squeeze(np.diff(hit, prepend=np.uint64(0)))))
    return pa.Table.from_batches([_batch(rows, HIT_SCHEMA)])


# -- exact counts of frequent phrases --------------------------------------------------

def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                     longest: int = MAX_WORDS, partition_mass: int = PARTITION_MASS) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, k, f`` (a phrase of ``k`` words, 1 to ``longest``, that occurs ``f`` times, ``min_count`` at least) and
    ``lang, n`` (all words of a language), both written tables."""
    plain = text_batches(docs, UNIT_MEGABYTES).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    units = write_table(plain.mapInArrow(to_units, UNIT))
    totals = write_table(units.groupBy("lang").agg(F.sum("n").alias("n")))
    mass = longest * (totals.agg(F.sum("n")).first()[0] or 0)
    part_bits = max(0, (mass // partition_mass).bit_length())
    bits = part_bits + KEY_BITS

    def send(batches):
        for batch in batches:
            for unit, lang, _, words, ids, begins in zip(*[c.to_pylist() for c in batch.columns]):
                cells, counts = Ngrams(lang, words, ids, begins).counted(longest, bits)
                keys, part = cells & np.uint64((1 << KEY_BITS) - 1), cells >> np.uint64(KEY_BITS)
                first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                rows = [(int(part[a]), unit, squeeze(np.diff(keys[a:b], prepend=np.uint64(0))), squeeze(counts[a:b].astype(np.uint32)))
                        for a, b in zip(first, [*first[1:], len(part)])]
                yield _batch(rows, MESSAGE_SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        return survivors(table, min_count)

    def count(own: pa.Table, hits: pa.Table) -> pa.Table:
        """The exact counts of a unit, packed by the hash of the phrase: few rows, whatever the number of phrases."""
        if not own.num_rows or not hits.num_rows:
            return pa.Table.from_batches([_batch([], COUNT_SCHEMA)])
        row = own.to_pylist()[0]
        cells = [np.cumsum(expand(k, np.uint64), dtype=np.uint64) + np.uint64(p << KEY_BITS)
                 for p, k in sorted(zip(hits.column("part").to_pylist(), hits.column("keys").to_pylist()))]
        grams = Ngrams(row["lang"], row["words"], row["ids"], row["begins"])
        packed: dict[int, tuple[list, list]] = {}
        for phrase, c in grams.exact(longest, bits, np.concatenate(cells)):
            phrases, counts = packed.setdefault(crc32(phrase) & ((1 << part_bits) - 1), ([], []))
            phrases.append(phrase)
            counts.append(c)
        return pa.Table.from_batches([_batch([
            (row["lang"], part, squeeze(np.frombuffer(b"\n".join(phrases), np.uint8)), squeeze(np.array(counts, np.uint32)))
            for part, (phrases, counts) in packed.items()], COUNT_SCHEMA)])

    def add_up(batches):
        """One hash partition of a language's phrases. The phrases that survived, a bounded share of the partition's mass,
        are all that is held."""
        total: dict[bytes, int] = {}
        for batch in batches:
            for lang, phrases, counts in zip(*[batch.column(c).to_pylist() for c in ("lang", "phrases", "counts")]):
                for phrase, c in zip(expand(phrases, np.uint8).tobytes().split(b"\n"), expand(counts, np.uint32).tolist()):
                    total[phrase] = total.get(phrase, 0) + c
        found = [(lang, phrase.decode("utf-8"), phrase.count(b" ") + 1, c) for phrase, c in total.items() if c >= min_count]
        yield _batch(found, PHRASE_SCHEMA)

    add_up.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    messages = units.mapInArrow(send, "part long, unit long, keys binary, counts binary")
    hits = messages.groupBy("part").applyInArrow(answer, "unit long, part long, keys binary")
    counts = units.groupBy("unit").cogroup(hits.groupBy("unit")).applyInArrow(
        count, "lang string, part long, phrases binary, counts binary")
    exact = counts.groupBy("lang", "part").applyInArrow(add_up, "lang string, phrase string, k int, f long")
    return write_table(exact), totals


# -- scores ----------------------------------------------------------------------------

def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of each phrase of two words or more, by its lowest-scoring cut."""
    words = F.split("phrase", " ")
    two = frequent.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), words.alias("w"))
    cuts = two.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "k", "a", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"))
    head = frequent.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tail = frequent.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    # 1000 a n and l r pass 64 bits; decimals of 38 digits hold both, and the quotient of whole numbers is exact
    ratio = (big("a") * big("n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)")
    joined = cuts.join(head, ["lang", "head"]).join(tail, ["lang", "tail"]).join(totals, "lang").select(
        "lang", "phrase", "k", "a", "cut", "l", "r", "n", ratio.alias("num"), (big("l") * big("r")).cast("decimal(38,0)").alias("den"))
    graded = joined.withColumn("score", F.expr("num div den"))
    least = F.min(F.struct("score", "cut", "l", "r", "n")).alias("s")
    return graded.groupBy("lang", "phrase", "k", "a").agg(least).select(
        "lang", "phrase", "k", "a", F.col("s.l").alias("l"), F.col("s.r").alias("r"), F.col("s.n").alias("n"),
        F.col("s.score").alias("score"))


def covered(candidates: DataFrame, percent: int = 100) -> DataFrame:
    """``lang, phrase`` of the candidates whose words lie within a longer candidate that is at least ``percent`` % as
    frequent."""
    parts = candidates.where("k > 2").select("lang", "a", "k", F.split("phrase", " ").alias("w"))
    inner = parts.select("lang", "a", "w", "k", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
    inner = inner.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, k - size + 1)")).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return longer.join(candidates.select("lang", "phrase", "a"), ["lang", "phrase"]).where(
        F.lit(100) * F.col("longer") >= F.lit(percent) * F.col("a")).select("lang", "phrase")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 longest: int = MAX_WORDS, top: int = TOP, partition_mass: int = PARTITION_MASS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: of each language the ``top`` best phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces and these at spaces and tabs into words.
    A candidate is a phrase with a = f(phrase) >= ``min_count`` occurrences within pieces, overlaps included. Cut in two
    parts with l and r occurrences it scores floor(1000 a n / (l r)), n being all words of the language; its lowest-scoring
    cut counts, the first of equals. Candidates within a longer one that is as frequent go. Ties of score are ranked by a,
    then by the phrase's bytes.

    A null language is ``und``, a null text empty. Repeated rows count each. A text of any length is read whole. An empty
    table, or one without a frequent phrase, gives an empty table.
    """
    frequent, totals = frequent_phrases(docs, text_col, lang_col, min_count, longest, partition_mass)
    candidates = write_table(scored(frequent, totals))
    rest = candidates.join(covered(candidates), ["lang", "phrase"], "left_anti")
    ranked = top_k_per_group(rest, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of ``documents``."""
    return collocations(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, min(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.k, a, cut, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:c.k], ' ')
  JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sizes AS (SELECT lang, a, k, w, unnest(range(2, k)) AS size FROM c),
inner_of AS (SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase
             FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM sizes)),
gone AS (SELECT DISTINCT c.lang, c.phrase FROM inner_of i JOIN c ON c.lang = i.lang AND c.phrase = i.phrase WHERE 100 * i.a >= 100 * c.a),
kept AS (SELECT * FROM best ANTI JOIN gone ON best.lang = gone.lang AND best.phrase = gone.phrase)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""

QUERIES = {"op13_collocations": op13_collocations}
ORACLES = {"op13_collocations": ORACLE}
