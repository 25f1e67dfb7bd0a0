"""Substring dedup with a count-min prefilter.

Documents are packed into units of a bounded number of words. First pass: each
unit makes a partial count-min sketch of its window hashes, kept sparse (the
sorted cells that it touches), and sends it to the cell blocks, where the
partial sketches are merged. A block answers each unit with one bit for each
cell it sent: whether the merged count is above one. A window is estimated
repeated if all its cells are; the count never underestimates, so none is lost.
Second pass: only those windows are grouped exactly, by a 128-bit hash. A unit
first folds its own repeats, so a passage that a third of all documents share
is one entry per unit, and gets back the smallest id that holds each window.

Every exchange is between units and blocks and both are bounded; nothing is
broadcast, and nothing but the size of the input reaches the driver.
"""

from __future__ import annotations

import math
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.common import read, text_batches
from textsieve.session import drop_table, part_of, write_table

WINDOW = 13
#: Words of a unit (a longer document is a unit of its own) and cells of a block, both bounds of a task's memory.
UNIT_WORDS, BLOCK_CELLS = 1 << 19, 1 << 25
DEPTH = 2
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
NO_ID = np.iinfo(np.int64).max
ZSTD = pa.Codec("zstd", compression_level=1)

ROWS = "src long, block long, kind int, data binary"
ROW_SCHEMA = pa.schema([("src", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])


# -- packing --------------------------------------------------------------------

def squeeze(a: np.ndarray) -> bytes:
    """An integer array, the bytes of equal weight together, compressed."""
    raw = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return len(raw).to_bytes(8, "little") + (ZSTD.compress(raw, asbytes=True) if raw else b"")


def expand(data: bytes, dtype) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, dtype=dtype)
    raw = np.frombuffer(ZSTD.decompress(data[8:], decompressed_size=n, asbytes=True), dtype=np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def pack_documents(ids: list[int], texts: list[str]) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.large_string())], names=["id", "t"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_documents(data: bytes) -> tuple[np.ndarray, list[str]]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return np.asarray(batch.column(0)), batch.column(1).to_pylist()


# -- windows --------------------------------------------------------------------

def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word (hashing is cheaper than remembering: a table of words misses the caches)."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


class Unit:
    """The windows of a unit's documents: ``h1, h2`` of the distinct ones in order, and each window's place in them."""

    def __init__(self, ids: np.ndarray, texts: list[str], window: int):
        self.ids, self.window = ids, window
        self.words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.n = np.maximum(lengths - window + 1, 0)
        flat = np.concatenate([word_hashes(w) for w in self.words]) if len(texts) else np.zeros(0, np.uint64)
        total = max(len(flat) - window + 1, 0)
        lanes = []
        for m in MULTIPLIERS:
            h = np.zeros(total, dtype=np.uint64)
            w, mult = flat ^ (flat >> np.uint64(29)) * np.uint64(m), np.uint64(m)
            for i in range(window):
                h *= mult
                h += w[i:i + total]
            # mix, so that the high bits make good cells
            h ^= h >> np.uint64(31)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            lanes.append(h)
        # windows that lie within one document
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
        at = np.repeat(starts, self.n) + _within(self.n)
        self.doc = np.repeat(np.arange(len(texts)), self.n)
        h1, h2 = lanes[0][at], lanes[1][at]
        order = _order(h1, h2)
        h1, h2 = h1[order], h2[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        self.h1, self.h2 = h1[new], h2[new]
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.cumsum(new) - 1
        # smallest id of the unit that holds each distinct window
        self.least = (np.minimum.reduceat(ids[self.doc[order]], np.flatnonzero(new)) if len(order) else np.zeros(0, np.int64))

    def cells(self, row: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted cells of a sketch row that the unit touches, and the place of each distinct window among them."""
        c = (self.h1 if row == 0 else self.h2) >> np.uint64(64 - bits)
        if row == 0:  # sorted already
            new = np.ones(len(c), dtype=bool)
            new[1:] = c[1:] != c[:-1]
            return c[new], np.cumsum(new) - 1
        return np.unique(c, return_inverse=True)

    def removed(self, least: np.ndarray) -> list[np.ndarray]:
        """For each document, which words a window covers that starts in a smaller id."""
        gone = least[self.place] < self.ids[self.doc]
        out, at = [], 0
        for words, n in zip(self.words, self.n):
            hit = np.flatnonzero(gone[at:at + n])
            at += n
            if not len(hit):
                out.append(np.zeros(len(words), dtype=bool))
                continue
            step = np.zeros(len(words) + 1, dtype=np.int64)
            step[hit] += 1  # places differ within each of the two
            step[hit + self.window] -= 1
            out.append(np.cumsum(step[:-1]) > 0)
        return out


def _order(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Places in the order of (h1, h2). Rarely are two h1 equal and their h2 not; only then both are sorted."""
    order = np.argsort(h1)
    tied = h1[order][1:] == h1[order][:-1]
    if (tied & (h2[order][1:] != h2[order][:-1])).any():
        order = np.lexsort((h2, h1))
    return order


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n-1 for each n, one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)


def blocks_of(cells: np.ndarray, bits: int, block_bits: int):
    """``block, first, last`` of each block that sorted ``cells`` touch."""
    block = cells >> np.uint64(bits - block_bits)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(cells) else []
    for a, b in zip(first, [*first[1:], len(cells)]):
        yield int(block[a]), int(a), int(b)


# -- the passes -----------------------------------------------------------------

DOCUMENTS, SKETCH, ESTIMATE, EXACT, LEAST = 0, 1, 3, 5, 6  # SKETCH and ESTIMATE plus the sketch row


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), ROW_SCHEMA.types)], schema=ROW_SCHEMA)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    unit_words: int = UNIT_WORDS) -> DataFrame:
    """``id, n_words, n_removed, text``: ``text`` is the words that stay, joined by one space.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller id. Ids are
    integers; a null id is larger than any other. Rows that share an id are not smaller than each other. Null and
    empty texts, and texts shorter than the window, lose nothing. Windows are taken from the input, not from what is
    left of it. An empty table gives an empty table.
    """
    plain = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    size = plain.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    # a word and its space are two bytes at least, and seven or so in prose: at most a cell in two is taken, mostly less
    bits = max(16, math.ceil(math.log2(size + 1)))
    block_bits = max(6, bits - int(math.log2(BLOCK_CELLS)))

    def pack(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[str] = []
        words = 0

        def unit():
            src = (part << 32) + seq
            yield src, -1, DOCUMENTS, pack_documents(ids, texts)
            u = Unit(np.array(ids, dtype=np.int64), texts, window)
            for row in range(DEPTH):
                cells, _ = u.cells(row, bits)
                for block, a, b in blocks_of(cells, bits, block_bits):
                    yield src, block, SKETCH + row, squeeze(np.diff(cells[a:b], prepend=np.uint64(0)))

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(NO_ID if i is None else i)
                texts.append(t)
                words += t.count(" ") + t.count("\n") + 1
                if words >= unit_words:
                    yield _batch(list(unit()))
                    ids, texts, words, seq = [], [], 0, seq + 1
        if ids:
            yield _batch(list(unit()))

    def merge_sketches(table: pa.Table) -> pa.Table:
        """One block of one sketch row: adds up the units' cells and answers each unit."""
        kind, block = table.column("kind")[0].as_py(), table.column("block")[0].as_py()
        srcs = table.column("src").to_pylist()
        sent = [np.cumsum(expand(d, np.uint64), dtype=np.uint64) for d in table.column("data").to_pylist()]
        merged = np.sort(np.concatenate(sent))
        more = np.unique(merged[1:][merged[1:] == merged[:-1]])
        rows = []
        for src, cells in zip(srcs, sent):
            at = np.searchsorted(more, cells)
            hit = at < len(more)
            hit[hit] = more[at[hit]] == cells[hit]
            rows.append((src, block, kind - SKETCH + ESTIMATE, squeeze(np.packbits(hit))))
        return pa.Table.from_batches([_batch(rows)])

    def opened(documents: pa.Table) -> Unit:
        ids, texts = unpack_documents(documents.column("data")[0].as_py())
        return Unit(ids, texts, window)

    def estimated(u: Unit, replies: pa.Table) -> np.ndarray:
        """Which distinct windows of the unit the merged sketch counts more than once, over all units."""
        data = {(k, b): d for k, b, d in zip(*(replies.column(c).to_pylist() for c in ("kind", "block", "data")))}
        yes = np.ones(len(u.h1), dtype=bool)
        for row in range(DEPTH):
            cells, place = u.cells(row, bits)
            flag = np.zeros(len(cells), dtype=bool)
            for block, a, b in blocks_of(cells, bits, block_bits):
                flag[a:b] = np.unpackbits(expand(data[ESTIMATE + row, block], np.uint8), count=b - a)
            yes &= flag[place]
        return yes

    def send_estimated(key, documents: pa.Table, replies: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return ROW_SCHEMA.empty_table()
        u = opened(documents)
        yes = np.flatnonzero(estimated(u, replies))
        rows = []
        for block, a, b in blocks_of(u.h1[yes], 64, block_bits):
            own = yes[a:b]
            parts = [squeeze(np.diff(u.h1[own], prepend=np.uint64(0))), squeeze(u.h2[own]), squeeze(u.least[own])]
            rows.append((key[0].as_py(), block, EXACT, b"".join(len(p).to_bytes(8, "little") + p for p in parts)))
        return pa.Table.from_batches([_batch(rows)]) if rows else ROW_SCHEMA.empty_table()

    def group_exactly(table: pa.Table) -> pa.Table:
        """One block of window hashes: the smallest id of each window over all units, for the units that have a larger one."""
        block = table.column("block")[0].as_py()
        got = []
        for d in table.column("data").to_pylist():
            parts, at = [], 0
            for dtype in (np.uint64, np.uint64, np.int64):
                n = int.from_bytes(d[at:at + 8], "little")
                parts.append(expand(d[at + 8:at + 8 + n], dtype))
                at += 8 + n
            got.append((np.cumsum(parts[0], dtype=np.uint64), parts[1], parts[2]))
        h1, h2, least = (np.concatenate(c) for c in zip(*got))
        order = _order(h1, h2)
        new = np.ones(len(order), dtype=bool)
        new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        lowest = np.empty(len(order), dtype=np.int64)
        first = np.flatnonzero(new)
        lowest[order] = np.repeat(np.minimum.reduceat(least[order], first), np.diff([*first, len(order)]))
        rows, at = [], 0
        for src, (own, _, _) in zip(table.column("src").to_pylist(), got):
            mine = slice(at, at + len(own))
            lower = lowest[mine] < least[mine]
            parts = [squeeze(np.packbits(lower)), squeeze(lowest[mine][lower])]
            rows.append((src, block, LEAST, b"".join(len(p).to_bytes(8, "little") + p for p in parts)))
            at += len(own)
        return pa.Table.from_batches([_batch(rows)])

    out_schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])

    def rebuild(key, documents: pa.Table, replies: pa.Table) -> pa.Table:
        if not documents.num_rows:
            return out_schema.empty_table()
        u = opened(documents)
        yes = np.flatnonzero(estimated(u, replies))
        lowest = {b: d for k, b, d in zip(*(replies.column(c).to_pylist() for c in ("kind", "block", "data"))) if k == LEAST}
        least = u.least.copy()
        for block, a, b in blocks_of(u.h1[yes], 64, block_bits):
            d = lowest[block]
            n = int.from_bytes(d[:8], "little")
            lower = np.unpackbits(expand(d[8:8 + n], np.uint8), count=b - a).astype(bool)
            least[yes[a:b][lower]] = expand(d[16 + n:], np.int64)
        gone = u.removed(least)
        kept = [b" ".join(compress(words, (~go).tolist()) if go.any() else words).decode("utf-8", "surrogatepass")
                for words, go in zip(u.words, gone)]
        return pa.Table.from_arrays([
            pa.array([None if i == NO_ID else i for i in u.ids.tolist()], pa.int64()),
            pa.array([len(w) for w in u.words], pa.int64()), pa.array([int(g.sum()) for g in gone], pa.int64()),
            pa.array(kept, pa.string())], schema=out_schema)

    first = write_table(plain.mapInArrow(pack, ROWS).withColumn("sent", (F.col("kind") != DOCUMENTS).cast("int")), "sent")
    units, sketches = part_of(first, "sent", 0), part_of(first, "sent", 1)
    estimates = write_table(sketches.groupBy("kind", "block").applyInArrow(merge_sketches, ROWS))
    drop_table(sketches)  # the estimates are written: nothing reads them again
    exact = units.groupBy("src").cogroup(estimates.groupBy("src")).applyInArrow(send_estimated, ROWS)
    least = write_table(exact.groupBy("block").applyInArrow(group_exactly, ROWS))
    replies = estimates.unionByName(least)
    result = units.groupBy("src").cogroup(replies.groupBy("src")).applyInArrow(
        rebuild, "id long, n_words long, n_removed long, text string")
    return result.withColumnRenamed("id", id_col)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its words, how many went, and the digest of the rest."""
    out = substring_dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS pos FROM d WHERE len(ws) >= 13),
k AS (
  SELECT doc_id, pos, list_slice(ws, pos, pos + 12) AS l FROM w),
least AS (SELECT l, min(doc_id) AS first_id FROM k GROUP BY l),
gone AS (
  SELECT DISTINCT doc_id, pos + o AS pos
  FROM k JOIN least USING (l), (SELECT unnest(range(0, 13)) AS o) WHERE doc_id > first_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d)
SELECT d.doc_id, len(ws) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept
           FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id) t USING (doc_id)
"""

QUERIES = {"op6_substring_dedup": op6_substring_dedup}
ORACLES = {"op6_substring_dedup": ORACLE}
