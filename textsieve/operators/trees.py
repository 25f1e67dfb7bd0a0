"""Decision trees and random forests without depth limits.

A tree is a table ``(tree, path, term_id, bin, n, w0, w1, gain)``. ``path`` is the way from the root, one character a
step (``0`` left, ``1`` right), so the children of a node need no numbers. A node with a null ``term_id`` is a leaf;
another one sends a row right where the row's bin of that term is at least ``bin``.

Values are binned per term: bin 0 is the absent term, and ``BINS`` bins of equal width lie between the smallest and the
largest value of the training rows. Only present terms are summed; what is left of the node's total belongs to bin 0.

Rows lie in packed blocks. Large nodes of all trees grow together: a pass over the blocks sums (tree, node, term, bin) in
its tasks, Spark adds these sums up and picks the best split of each node, and the splits move the rows on when a task
reads them. A node of at most ``local_entries`` entries is finished in one task. Both follow the same rule (largest
impurity decrease to 12 decimals, then smallest term, then smallest bin), so that bound changes no tree.

A row counts as often as it was copied and drawn; ``min_samples_split`` and ``min_samples_leaf`` compare these counts,
the impurities also carry the class weights. A tree with ``max_features="sqrt"`` lets a term into a node's search with
probability ``1 / sqrt(terms)``, by a hash of node and term. Where no drawn term splits the node, the draw is repeated
with twice the share until one does or all terms were in it. A drawn tree holds each copy of a row a Poisson(1) number
of times. Rows without a known term are rows with all bins 0; values must not be negative.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsieve.operators.vectorize import BROADCAST_VOCAB_ROWS
from textsieve.session import cut_lineage, drop_table, write_table

#: Bins of a term's values, beside the one of the absent term.
BINS = 32
#: A node with so few entries (present terms plus one for each row) is finished by one task.
LOCAL_ENTRIES = 4_000_000
#: Entries of a block and of a file of blocks.
BLOCK_ENTRIES, FILE_ENTRIES = 262_144, 4_000_000
#: Cells (term and bin) of the large nodes that one pass sums, where one node has fewer.
CELLS_AT_ONCE = 2_000_000
#: Terms of a node whose sums are added up together.
PART_TERMS = 512
#: Rows by terms, a byte each, that a task which finishes a node holds at most.
DENSE_CELLS = 160_000_000
#: Splits that tasks follow from the nodes stored with the blocks; with more, the blocks are written anew.
MOVES = 2_000
#: Models of at most so many nodes go to every task of a scoring; larger ones are joined step by step.
BROADCAST_NODES = 1_000_000
#: Steps of a joined scoring between two checkpoints.
STEPS = 8

#: ``up`` is the count of the parent.
GROWN_SCHEMA = "tree int, path string, term_id int, bin int, n double, w0 double, w1 double, gain double, up double"
_MOD = 2147483647


@dataclass(frozen=True)
class TreeSpec:
    """How one tree grows. ``max_depth=None`` is no limit."""

    criterion: str = "gini"
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    class_weight: str | None = None  # None, "balanced" or "balanced_subsample" (of the tree's own draw)
    max_features: str | None = None  # None: every term; "sqrt"
    bootstrap: bool = False
    seed: int = 42

    def __post_init__(self):
        if self.criterion not in ("gini", "entropy"):
            raise ValueError(f"unknown criterion {self.criterion!r}")
        if self.class_weight not in (None, "balanced", "balanced_subsample"):
            raise ValueError(f"unknown class_weight {self.class_weight!r}")
        if self.max_features not in (None, "sqrt"):
            raise ValueError(f"unknown max_features {self.max_features!r}")
        if self.max_depth is not None and self.max_depth < 1 or self.min_samples_split < 2 or self.min_samples_leaf < 1:
            raise ValueError("max_depth and min_samples_leaf start at 1, min_samples_split at 2")


# --- bins ---------------------------------------------------------------------

def bin_edges(feats: DataFrame) -> DataFrame:
    """``(term_id, lo, hi)``: the range of each term's values in the training rows."""
    return feats.where(F.col("value") > 0).groupBy("term_id").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def binned(docs: DataFrame, feats: DataFrame, edges: DataFrame, n_terms: int, id_col: str = "row_id") -> DataFrame:
    """``docs`` with the arrays ``t`` (present terms) and ``b`` (their bins, from 1), empty where none is known."""
    e = F.broadcast(edges) if n_terms <= BROADCAST_VOCAB_ROWS else edges
    place = F.floor(F.round((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS, 6))
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.greatest(place, F.lit(0)), F.lit(BINS - 1)) + 1).otherwise(F.lit(1))
    rows = feats.where(F.col("value") > 0).join(e, "term_id").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(
        F.col("term_id").cast("int").alias("t"), b.cast("int").alias("b")))).alias("_e"))
    none = F.array().cast("array<int>")
    return docs.join(rows, id_col, "left").select(
        *docs.columns, F.coalesce(F.col("_e").getField("t"), none).alias("t"),
        F.coalesce(F.col("_e").getField("b"), none).alias("b"))


def _own_bin():
    """A row's bin of the term ``term_id``."""
    place = F.array_position("t", F.col("term_id")).cast("int")
    return F.when(place > 0, F.try_element_at("b", place)).otherwise(F.lit(0))


def place_np(value, lo, hi):
    """The bins of values within their terms' ranges, as ``binned`` has them."""
    wide = hi > lo
    place = np.floor(np.round((value - lo) / np.where(wide, hi - lo, 1.0) * BINS, 6))
    return np.where(wide, np.clip(place, 0, BINS - 1) + 1, 1).astype(np.int64)


# --- the draw of terms ------------------------------------------------------------

def _drawn(node_seed: int, term: np.ndarray, share: float) -> np.ndarray:
    mod = lambda x: x - x // _MOD * _MOD  # noqa: E731  numpy divides by a constant far faster than it takes a remainder
    y = mod((node_seed + term.astype(np.int64) + 1) * 48271)
    y ^= y >> 13
    return mod(y * 69621) < share * float(_MOD)


def _node_seed(spec: TreeSpec, tree: int, path: str, tries: int) -> int:
    return zlib.crc32(f"{spec.seed}:{tree}:{path}:{tries}".encode())


def _share(spec: TreeSpec, n_terms: int, tries: int) -> float:
    return min(1.0, 2 ** tries / math.sqrt(n_terms)) if spec.max_features else 1.0


# --- the rule: the best split of a node ---------------------------------------------

def _impurity(a, b, criterion):
    """The node's weight times its impurity."""
    w = a + b
    safe = np.where(w > 0, w, 1.0)
    if criterion == "gini":
        return 2 * a * b / safe
    part = lambda x: np.where(x > 0, -x * np.log2(np.where(x > 0, x, 1.0) / safe), 0.0)
    return part(a) + part(b)


def _best_cell(key, k0, k1, n0, n1, factor, spec: TreeSpec):
    """``(term, bin, decrease, k0, k1, place)`` of a node's best split, or none. ``key`` holds its cells (term and bin) in
    order, ``k0`` and ``k1`` their counts by class; the last three are the counts to the right and the place of its cell."""
    if not len(key):
        return None
    term = key // (BINS + 1)
    ends = np.append(np.flatnonzero(term[1:] != term[:-1]), len(term) - 1)
    last = np.repeat(ends, np.diff(ends, prepend=-1))
    r0, r1 = (c[last] - c + x for x, c in ((k0, np.cumsum(k0)), (k1, np.cumsum(k1))))  # this bin and the larger ones
    a, b, ra, rb = n0 * factor[0], n1 * factor[1], r0 * factor[0], r1 * factor[1]
    gain = _impurity(a, b, spec.criterion) - _impurity(ra, rb, spec.criterion) - _impurity(a - ra, b - rb, spec.criterion)
    gain = np.round(gain / (a + b), 12)
    gain[(r0 + r1 < spec.min_samples_leaf) | (n0 + n1 - r0 - r1 < spec.min_samples_leaf)] = -np.inf
    i = int(np.argmax(gain))  # the first of equals: smallest term, then smallest bin
    if gain[i] == -np.inf:
        return None
    return int(term[i]), int(key[i] % (BINS + 1)), float(gain[i] * (a + b)), float(r0[i]), float(r1[i]), i


def _closed(spec: TreeSpec, depth: int, n0, n1, factor) -> bool:
    n = n0 + n1
    return n0 * factor[0] <= 0 or n1 * factor[1] <= 0 or n < spec.min_samples_split or n < 2 * spec.min_samples_leaf \
        or (spec.max_depth is not None and depth >= spec.max_depth)


def _summed(key, values: list[np.ndarray], n_cells: int):
    """The cells among ``key`` in order, and the sums of each of ``values`` by cell (the first has no zeros)."""
    if n_cells <= 32 * len(key):
        sums = [np.bincount(key, v, n_cells) for v in values]
        cells = np.flatnonzero(sums[0])
        return cells, [x[cells] for x in sums]
    cells, at = np.unique(key, return_inverse=True)
    return cells, [np.bincount(at, v, len(cells)) for v in values]


# --- packed rows ----------------------------------------------------------------------

def _poisson(key):
    """A Poisson(1) number from a 64-bit hash: how many steps of its distribution lie below a uniform number."""
    u = (F.shiftrightunsigned(key, 11).cast("double") + 0.5) / F.lit(float(2 ** 53))
    total, out = 0.0, F.lit(0)
    for j in range(12):
        total += math.exp(-1) / math.factorial(j)
        out = out + (u > total).cast("int")
    return out


#: Rows as a block. ``key`` and ``row`` are the entries by cell: term times ``BINS + 1`` plus bin, and the row's place in the
#: block. ``k`` holds each row's copies, then its number in each draw. ``at`` is each row's node by tree, empty at first.
BLOCKS = "one binary, k binary, key binary, row binary, at binary"


def _pack(rows: DataFrame, specs: list[TreeSpec]) -> DataFrame:
    """The rows in blocks, with the numbers that the trees with a draw give them, in as many files as entries fill, and no
    fewer than cores."""
    copies = F.round("weight").cast("int")
    rows = rows.where(copies >= 1)
    draws = [F.struct(F.lit(s.seed).cast("bigint").alias("seed"), F.lit(i).alias("tree")) for i, s in enumerate(specs) if s.bootstrap]
    k = F.array(copies)
    if draws:
        k = F.concat(k, F.transform(F.array(*draws), lambda draw: F.aggregate(
            F.sequence(F.lit(1), copies), F.lit(0), lambda acc, i: acc + _poisson(F.xxhash64(draw["seed"], draw["tree"], F.col("row_id"), i)))))
    entries = rows.agg(F.sum(F.size("t"))).first()[0]
    files = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil((entries or 0) / FILE_ENTRIES))
    rows = rows.select("row_id", (F.col("label") == 1).alias("one"), k.alias("k"), "t", "b").repartition(files, "row_id")
    return write_table(rows.select(F.coalesce("one", F.lit(False)).alias("one"), "k", "t", "b").mapInArrow(_packed, BLOCKS))


def _packed(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        one = np.asarray(batch.column("one").to_pylist(), dtype=np.uint8)
        k = batch.column("k").flatten().to_numpy().astype(np.int32).reshape(len(one), -1)
        terms, bins = batch.column("t"), batch.column("b")
        start = terms.offsets.to_numpy().astype(np.int64)
        key = terms.flatten().to_numpy().astype(np.int64) * (BINS + 1) + bins.flatten().to_numpy()
        start -= start[0]
        a = 0
        while a < len(one):
            b = max(int(np.searchsorted(start, start[a] + BLOCK_ENTRIES, "right")) - 1, a + 1)
            own = key[start[a]:start[b]]
            order = np.argsort(own, kind="stable")
            row = np.repeat(np.arange(b - a, dtype=np.int32), np.diff(start[a:b + 1]))
            parts = one[a:b], k[a:b].T, own[order], row[order], np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts],
                                             ["one", "k", "key", "row", "at"])
            a = b


@dataclass
class _Block:
    one: np.ndarray
    k: np.ndarray  # copies and draws x rows
    key: np.ndarray
    row: np.ndarray
    at: np.ndarray  # trees x rows, -1 where a row is not in the tree's draw

    @classmethod
    def read(cls, batch, i: int, draw: list[int], moves: list) -> "_Block":
        """The ``i``-th block of a batch with its rows moved on."""
        one, k, key, row, at = (np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in (
            ("one", np.uint8), ("k", np.int32), ("key", np.int64), ("row", np.int32), ("at", np.int32)))
        k = k.reshape(-1, len(one))
        at = at.reshape(len(draw), -1).copy() if len(at) else np.where(k[draw] > 0, 0, -1).astype(np.int32)
        if moves:
            m = np.array([x[:4] for x in moves], dtype=np.int64)
            lo, hi = np.searchsorted(key, m[:, 2]), np.searchsorted(key, (m[:, 2] // (BINS + 1) + 1) * (BINS + 1))
            for (tree, node, _, new), i0, i1 in zip(moves, lo, hi):  # to the right; the left child keeps its parent's number
                r = row[i0:i1]
                at[tree, r[at[tree, r] == node]] = new
        return cls(one, k, key, row, at)


# --- passes over the blocks --------------------------------------------------------------

def _totals(blocks: DataFrame, n_draws: int) -> list:
    """``(k0, k1, m)`` of all rows by draw, the first of them being the copies; ``m`` counts entries plus one a row."""
    def task(batches):
        out = np.zeros((n_draws + 1, 3))
        for batch in batches:
            for i in range(batch.num_rows):
                x = _Block.read(batch, i, [0], [])
                m = np.bincount(x.row, minlength=len(x.one)) + 1
                out += np.stack([x.k @ (1 - x.one.astype(float)), x.k @ x.one.astype(float), (x.k > 0) @ m], 1)
        yield pa.RecordBatch.from_arrays([pa.array(range(n_draws + 1), pa.int32()), *[pa.array(c) for c in out.T.copy()]], ["d", "k0", "k1", "m"])

    sums = blocks.mapInArrow(task, "d int, k0 double, k1 double, m double").groupBy("d").agg(*[F.sum(c).alias(c) for c in ("k0", "k1", "m")])
    return [(r["k0"], r["k1"], r["m"]) for r in sums.orderBy("d").collect()]


@dataclass
class _Node:
    """An open node. ``number`` is its number in its tree, ``up`` the count of its parent."""

    tree: int
    number: int
    path: str
    n0: float
    n1: float
    m: float
    up: float
    tries: int = 0

    def terms(self, specs, n_terms: int):
        """The drawn terms, or none where all are in."""
        share = _share(specs[self.tree], n_terms, self.tries)
        return np.flatnonzero(_drawn(_node_seed(specs[self.tree], specs[self.tree].tree, self.path, self.tries), np.arange(n_terms), share)) \
            if share < 1 else None


def _best_splits(blocks: DataFrame, nodes: list[_Node], specs, factors, draw: list[int], moves: list, n_terms: int) -> dict:
    """The best split of each of ``nodes`` that has one, by place: sums by cell in the tasks, packed by node and range of
    terms; each range is added up, and its best cell found, in a task of its own."""
    spark = blocks.sparkSession
    sent = spark.sparkContext.broadcast((nodes, specs, factors, draw, moves))
    width = PART_TERMS * (BINS + 1)

    def sums(batches):
        nodes, specs, _, draw, moves = sent.value
        terms = [x.terms(specs, n_terms) for x in nodes]
        total = [np.zeros((3, (n_terms if t is None else len(t)) * (BINS + 1))) for t in terms]
        for batch in batches:
            for i in range(batch.num_rows):
                x = _Block.read(batch, i, draw, moves)
                one = x.one.astype(bool)
                m = np.bincount(x.row, minlength=len(one)) + 1.0
                for node, t, out in zip(nodes, terms, total):
                    inside = x.at[node.tree] == node.number
                    if not inside.any():
                        continue
                    if t is None:
                        e = np.flatnonzero(inside[x.row])
                        key = x.key[e]
                    else:  # the entries of the drawn terms, their terms numbered by the draw
                        lo, hi = np.searchsorted(x.key, t * (BINS + 1)), np.searchsorted(x.key, (t + 1) * (BINS + 1))
                        size = hi - lo
                        e = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
                        at = np.repeat(np.arange(len(t)), size)
                        some = inside[x.row[e]]
                        e, at = e[some], at[some]
                        key = x.key[e] % (BINS + 1) + at * (BINS + 1)
                    r = x.row[e]
                    k = x.k[draw[node.tree]][r].astype(float)
                    cells, found = _summed(key, [k, k * one[r], m[r]], out.shape[1])
                    out[:, cells] += found
        for j, out in enumerate(total):
            for c in range(0, out.shape[1], width):
                own = out[:, c:c + width]
                cells = np.flatnonzero(own[0])
                if len(cells):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j], pa.int32()), pa.array([c // width], pa.int32()), pa.array([cells.astype(np.int32).tobytes()], pa.binary()),
                         pa.array([own[:, cells].tobytes()], pa.binary())], ["node", "part", "cells", "sums"])

    def pick(table: pa.Table) -> pa.Table:
        nodes, specs, factors, _, _ = sent.value
        j, part = table["node"][0].as_py(), table["part"][0].as_py()
        node = nodes[j]
        total = np.zeros((3, width))
        for cells, own in zip(table["cells"], table["sums"]):  # one of each task
            cells = np.frombuffer(cells.as_buffer(), np.int32)
            total[:, cells] += np.frombuffer(own.as_buffer()).reshape(3, -1)
        key = np.flatnonzero(total[0])
        k, k1, m = total[:, key]
        key += part * width
        t = node.terms(specs, n_terms)
        if t is not None:
            key = t[key // (BINS + 1)] * (BINS + 1) + key % (BINS + 1)
        best = _best_cell(key, k - k1, k1, node.n0, node.n1, factors[node.tree], specs[node.tree])
        rows = []
        if best is not None:
            t, v, gain, r0, r1, _ = best
            rows.append((j, t, v, gain, r0, r1, float(m[(key // (BINS + 1) == t) & (key % (BINS + 1) >= v)].sum())))
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    schema = pa.schema([("node", pa.int32()), ("t", pa.int32()), ("b", pa.int32()), *[(c, pa.float64()) for c in ("gain", "k0", "k1", "m")]])
    found = blocks.mapInArrow(sums, "node int, part int, cells binary, sums binary").groupBy("node", "part").applyInArrow(
        pick, "node int, t int, b int, gain double, k0 double, k1 double, m double").collect()
    sent.destroy()
    best: dict = {}
    for r in found:  # a node's parts are ranges of its terms: the same rule between them
        if r["node"] not in best or (-r["gain"], r["t"]) < (-best[r["node"]]["gain"], best[r["node"]]["t"]):
            best[r["node"]] = r
    return best


def _moved(blocks: DataFrame, draw: list[int], moves: list) -> DataFrame:
    """The blocks with the nodes that their rows have come to."""
    def task(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                at = _Block.read(batch, i, draw, moves).at
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(i, 1) for c in ("one", "k", "key", "row")],
                                                  pa.array([np.ascontiguousarray(at).tobytes()], pa.binary())],
                                                 ["one", "k", "key", "row", "at"])

    return write_table(blocks.mapInArrow(task, BLOCKS))


def _gathered(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start[i]`` to ``start[i] + size[i] - 1`` for each ``i`` in turn."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _subtree(piece: tuple, node: tuple, tree: int, spec, factor, n_terms: int, dense_cells: int = DENSE_CELLS) -> list[tuple]:
    """The grown nodes of the subtree of ``node`` (path, tries, count of the parent) over the rows of ``piece``: ``one`` and
    ``k`` by row, and their entries by row: the entries' number and the ``key`` of each.

    A piece of at most ``dense_cells`` rows by terms is spread out, a byte for each: a node then looks at its drawn terms and
    at its split's term only. Without a draw, a node's sums are its parent's less its sibling's, so that only the smaller
    child's entries are read. A larger piece reads all entries of a node, until a child is small enough."""
    one, k, size, key = piece
    k = k.astype(float)
    k1 = k * one
    start = np.cumsum(size, dtype=np.int64) - size
    n_cells = n_terms * (BINS + 1)
    of, spread = np.repeat(np.arange(len(one)), size), None
    term = key // (BINS + 1)
    if ((term[1:] == term[:-1]) & (of[1:] == of[:-1])).any():  # a row that has a term twice counts twice
        dense_cells = -1
    if len(one) * n_terms <= dense_cells:
        spread = np.zeros((n_terms, len(one)), np.uint8)
        spread[term, of] = key % (BINS + 1)
    del of, term

    def sums(rows):
        own = key[_gathered(start[rows], size[rows])]
        cells, (c, c1) = _summed(own, [np.repeat(x[rows], size[rows]) for x in (k, k1)], n_cells)
        return cells, c, c1

    def drawn_sums(rows, term):
        if spread is not None:
            part = spread[term[:, None], rows].ravel()
            here = np.flatnonzero(part)
            j, r = np.divmod(here, len(rows))
            own, d = term[j] * (BINS + 1) + part[here], rows[r]
        else:
            own, d = key[_gathered(start[rows], size[rows])], np.repeat(rows, size[rows])
            use = np.zeros(n_terms, bool)
            use[term] = True
            use = use[own // (BINS + 1)]
            own, d = own[use], d[use]
        cells, (c, c1) = _summed(own, [k[d], k1[d]], n_cells)
        return cells, c, c1

    out, every = [], np.arange(n_terms)
    path, tries, up = node
    todo = [(path, tries, up, np.arange(len(one)), (k - k1).sum(), k1.sum(), None)]
    while todo:
        path, tries, up, rows, n0, n1, known = todo.pop()
        n, best = n0 + n1, None
        if not _closed(spec, len(path), n0, n1, factor):
            while True:
                share = _share(spec, n_terms, tries)
                if share < 1:
                    seed = _node_seed(spec, spec.tree, path, tries)
                    cells, c, c1 = drawn_sums(rows, np.flatnonzero(_drawn(seed, every, share)))
                else:
                    cells, c, c1 = known or sums(rows)
                best = _best_cell(cells, c - c1, c1, n0, n1, factor, spec)
                if best is not None or share >= 1:
                    break
                tries += 1
        w0, w1 = n0 * factor[0], n1 * factor[1]
        if best is None:
            out.append((tree, path, None, None, n, w0, w1, 0.0, up))
            continue
        t, v, gain = best[:3]
        out.append((tree, path, t, v, n, w0, w1, gain, up))
        if spread is not None:
            right = spread[t, rows] >= v
        else:
            own = key[_gathered(start[rows], size[rows])]
            goes = (own >= t * (BINS + 1) + v) & (own < (t + 1) * (BINS + 1))
            right = np.bincount(np.repeat(np.arange(len(rows)), size[rows])[goes], minlength=len(rows)) > 0
        right, rest = rows[right], rows[~right]
        r1 = k1[right].sum()
        r0 = k[right].sum() - r1
        kids = [(path + "0", 0, n, rest, n0 - r0, n1 - r1, None), (path + "1", 0, n, right, r0, r1, None)]
        if spec.max_features is None:
            kids.sort(key=lambda x: size[x[3]].sum())
            (*small, _), (*large, _) = kids
            if not _closed(spec, len(path) + 1, large[4], large[5], factor):
                less, d, d1 = sums(small[3])
                at = np.searchsorted(cells, less)
                c[at] -= d
                c1[at] -= d1
                left = c > 0
                kids = [(*small, (less, d, d1)), (*large, (cells[left], c[left], c1[left]))]
        for x in kids:
            if spread is None and len(x[3]) * n_terms <= dense_cells and not _closed(spec, len(x[0]), x[4], x[5], factor):
                own = one[x[3]], k[x[3]], size[x[3]], key[_gathered(start[x[3]], size[x[3]])]
                out += _subtree(own, x[:3], tree, spec, factor, n_terms, dense_cells)
            else:
                todo.append(x)
    return out


def _finished(blocks: DataFrame, nodes: list[_Node], specs, factors, draw: list[int], moves: list, n_terms: int) -> DataFrame:
    """All nodes below (and including) ``nodes``, each subtree grown in its task."""
    sent = blocks.sparkSession.sparkContext.broadcast((
        {(x.tree, x.number): x for x in nodes}, specs, factors, draw, moves))
    key_type = np.int32 if n_terms * (BINS + 1) < 2 ** 31 else np.int64

    def parts(batches):
        nodes, _, _, draw, moves = sent.value
        numbers = {}
        for tree, number in nodes:
            numbers.setdefault(tree, []).append(number)
        names = ["tree", "number", "one", "k", "size", "key"]
        for batch in batches:
            for i in range(batch.num_rows):
                x = _Block.read(batch, i, draw, moves)
                key = x.key[np.argsort(x.row, kind="stable")].astype(key_type)
                size = np.bincount(x.row, minlength=len(x.one)).astype(np.int32)
                start = np.cumsum(size, dtype=np.int64) - size
                for tree, wanted in numbers.items():
                    rows = np.flatnonzero(np.isin(x.at[tree], wanted))
                    rows = rows[np.argsort(x.at[tree, rows], kind="stable")]
                    of_row, own_size = x.at[tree, rows], size[rows]
                    own_key = key[_gathered(start[rows], own_size)]
                    ends = np.append(0, np.cumsum(own_size))
                    for number in np.unique(of_row):
                        a, b = np.searchsorted(of_row, [number, number + 1])
                        own = x.one[rows[a:b]], x.k[draw[tree], rows[a:b]], own_size[a:b], own_key[ends[a]:ends[b]]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tree], pa.int32()), pa.array([int(number)], pa.int32()),
                             *[pa.array([y.tobytes()], pa.binary()) for y in own]], names)

    def finish(table: pa.Table) -> pa.Table:
        nodes, specs, factors, _, _ = sent.value
        tree = table["tree"][0].as_py()
        root = nodes[tree, table["number"][0].as_py()]
        piece = [np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[c]]) for c, t in (
            ("one", np.uint8), ("k", np.int32), ("size", np.int32), ("key", key_type))]
        out = _subtree(piece, (root.path, root.tries, root.up), tree, specs[tree], factors[tree], n_terms)
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    schema = pa.schema([("tree", pa.int32()), ("path", pa.string()), ("term_id", pa.int32()), ("bin", pa.int32()),
                        *[(c, pa.float64()) for c in ("n", "w0", "w1", "gain", "up")]])
    pieces = blocks.mapInArrow(parts, "tree int, number int, one binary, k binary, size binary, key binary")
    return pieces.groupBy("tree", "number").applyInArrow(finish, GROWN_SCHEMA)


# --- growth -------------------------------------------------------------------

@dataclass(frozen=True)
class _Growth(TreeSpec):
    """What grows: ``tree`` is the number of the tree in the draws of rows and terms."""

    tree: int = 0


def _growths(specs: list[TreeSpec]) -> tuple[list[_Growth], list[int]]:
    """What grows for ``specs``, and each one's place in it. Trees without draws that differ only in ``max_depth`` and
    ``min_samples_split`` are one tree, cut off earlier or later, as these close nodes but change no split."""
    found: dict = {}
    for i, s in enumerate(specs):
        own = i if s.bootstrap or s.max_features else (s.criterion, s.min_samples_leaf, s.class_weight)
        found.setdefault(own, []).append(i)
    growths, place = [], [0] * len(specs)
    for members in found.values():
        depths = [specs[i].max_depth for i in members]
        for i in members:
            place[i] = len(growths)
        growths.append(_Growth(**{**asdict(specs[members[0]]), "max_depth": None if None in depths else max(depths),
                                  "min_samples_split": min(specs[i].min_samples_split for i in members), "tree": members[0]}))
    return growths, place


def _factors(specs: list[TreeSpec], draw: list[int], totals: list) -> list[tuple[float, float]]:
    """The class weights of each tree: from all rows, or from the tree's own draw."""
    out = []
    for s, d in zip(specs, draw):
        k0, k1, _ = totals[d if s.class_weight == "balanced_subsample" else 0]
        out.append(tuple((k0 + k1) / (2 * x) if s.class_weight and x else 1.0 for x in (k0, k1)))
    return out


def grow(rows: DataFrame, specs: list[TreeSpec], n_terms: int, local_entries: int = LOCAL_ENTRIES) -> DataFrame:
    """The nodes (see above) of one tree for each of ``specs`` over the ``rows`` of ``tree_rows``."""
    spark = rows.sparkSession
    blocks = _pack(rows, specs)
    totals = _totals(blocks, sum(s.bootstrap for s in specs))
    if not totals or totals[0][0] + totals[0][1] <= 0:
        raise ValueError("no rows to grow a tree on")
    number = {i: j + 1 for j, i in enumerate(i for i, s in enumerate(specs) if s.bootstrap)}
    grown, place = _growths(specs)
    draw = [number.get(s.tree, 0) for s in grown]
    factors = _factors(grown, draw, totals)

    done, small, wide, moves = [], [], [], []
    used = [1] * len(grown)

    def sort_out(x: _Node):
        spec, factor = grown[x.tree], factors[x.tree]
        if _closed(spec, len(x.path), x.n0, x.n1, factor):
            done.append((x.tree, x.path, None, None, x.n0 + x.n1, x.n0 * factor[0], x.n1 * factor[1], 0.0, x.up))
        else:
            (small if x.m <= local_entries else wide).append(x)

    for tree, d in enumerate(draw):
        k0, k1, m = totals[d]
        if k0 + k1 > 0:
            sort_out(_Node(tree, 0, "", k0, k1, m, 0.0))
    while wide:
        now, cells = [], 0
        while wide and (not now or cells < CELLS_AT_ONCE):
            now.append(wide.pop(0))
            cells += (BINS + 1) * math.ceil(n_terms * _share(grown[now[-1].tree], n_terms, now[-1].tries))
        best = _best_splits(blocks, now, grown, factors, draw, moves, n_terms)
        for j, x in enumerate(now):
            spec, (f0, f1) = grown[x.tree], factors[x.tree]
            s, n = best.get(j), x.n0 + x.n1
            if s is None and _share(spec, n_terms, x.tries) < 1:  # drawn anew with a larger share
                wide.append(replace(x, tries=x.tries + 1))
                continue
            done.append((x.tree, x.path, s and s["t"], s and s["b"], n, x.n0 * f0, x.n1 * f1, s["gain"] if s else 0.0, x.up))
            if s:
                moves.append((x.tree, x.number, s["t"] * (BINS + 1) + s["b"], used[x.tree]))
                sort_out(_Node(x.tree, x.number, x.path + "0", x.n0 - s["k0"], x.n1 - s["k1"], x.m - s["m"], n))
                sort_out(_Node(x.tree, used[x.tree], x.path + "1", s["k0"], s["k1"], s["m"], n))
                used[x.tree] += 1
        if len(moves) > MOVES:
            blocks, before, moves = _moved(blocks, draw, moves), blocks, []
            drop_table(before)
    out = spark.createDataFrame(done, GROWN_SCHEMA)
    if small:
        out = out.unionByName(_finished(blocks, small, grown, factors, draw, moves, n_terms))
    # a tree of a growth ends where its own limits close a node
    trees = F.broadcast(spark.createDataFrame(
        [(g, i, s.max_depth, s.min_samples_split) for i, (g, s) in enumerate(zip(place, specs))],
        "growth int, tree int, max_depth int, min_split int"))
    out = write_table(out.withColumnRenamed("tree", "growth"))
    depth = F.length("path")
    limit = F.coalesce("max_depth", F.lit(2 ** 31 - 1))
    mine = out.join(trees, "growth").where((depth == 0) | (F.col("up") >= F.col("min_split")) & (depth <= limit))
    ends = (F.col("n") < F.col("min_split")) | (depth >= limit)
    nodes = write_table(mine.select("tree", "path", *[F.when(~ends, F.col(c)).alias(c) for c in ("term_id", "bin")], "n", "w0", "w1",
                                    F.when(ends, 0.0).otherwise(F.col("gain")).alias("gain")))
    drop_table(blocks)
    drop_table(out)
    return nodes


def walk(model, n_rows: int, n_terms: int, doc: np.ndarray, term: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The class-1 share of each row's leaf (rows x trees), given the model's arrays and the rows' present terms with
    their bins, by row and term."""
    roots, child, node_term, at_least, p1 = model
    key = np.append(doc * n_terms + term, np.iinfo(np.int64).max)
    bins = np.append(bins, 0)
    out = np.empty((n_rows, len(roots)))
    for j, root in enumerate(roots):
        at = np.full(n_rows, root)
        left = np.flatnonzero(node_term[at] >= 0)
        while len(left):
            here = at[left]
            want = left * n_terms + node_term[here]
            i = np.searchsorted(key, want)
            own = np.where(key[i] == want, bins[i], 0)
            at[left] = child[here, (own >= at_least[here]).astype(int)]
            left = left[node_term[at[left]] >= 0]
        out[:, j] = p1[at]
    return out


# --- fitted models ------------------------------------------------------------

@dataclass
class TreeModel:
    """Trees of ``grow`` with what turns long features into bins."""

    nodes: DataFrame
    edges: DataFrame
    n_trees: int
    n_terms: int
    specs: list[TreeSpec]
    broadcast_nodes: int = BROADCAST_NODES

    def tree_probabilities(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """``docs`` with ``probs``: the class-1 share of each tree's leaf, in tree order."""
        rows = binned(docs, feats, self.edges, self.n_terms, id_col)
        sizes = {r["tree"]: r["count"] for r in self.nodes.groupBy("tree").count().collect()}  # one row a tree
        if max(sizes.values(), default=0) > self.broadcast_nodes:
            return self._walk_by_joins(rows, id_col)
        groups, held = [], 0
        for tree in range(self.n_trees):
            if not groups or held + sizes[tree] > self.broadcast_nodes:
                groups.append([])
                held = 0
            groups[-1].append(tree)
            held += sizes[tree]
        if len(groups) == 1:
            return rows.withColumn("probs", self._walk(self.arrays())("t", "b")).drop("t", "b")
        # a pass for each group of trees, each with its own part of the model
        before = None
        for group in groups:
            own = self._walk(self.arrays(group))("t", "b")
            rows = write_table(rows.withColumn("probs", own if before is None else F.concat("probs", own)))
            if before is not None:
                drop_table(before)
            before = rows
        return rows.drop("t", "b")

    def arrays(self, trees: list[int] | None = None):
        """The nodes (of ``trees``, which follow each other) as arrays for ``walk``, at most ``broadcast_nodes`` of them.
        In the order of their paths a node's left child comes next, and its right child after what is below that one;
        no path reaches the driver."""
        nodes = self.nodes if trees is None else self.nodes.where(F.col("tree").between(trees[0], trees[-1]))
        model = nodes.orderBy("tree", "path").select(
            F.length("path").alias("depth"), "term_id", "bin", (F.col("w1") / (F.col("w0") + F.col("w1"))).alias("p1")).toPandas()
        child = np.full((len(model), 2), -1, np.int64)
        open_at: list[int] = []  # the nodes from a root to the one before
        roots = []
        for i, depth in enumerate(model.depth.tolist()):
            del open_at[depth:]
            if depth:
                up = open_at[-1]
                child[up, 0 if child[up, 0] < 0 else 1] = i
            else:
                roots.append(i)
            open_at.append(i)
        return (np.array(roots), child, model.term_id.fillna(-1).to_numpy(np.int64), model.bin.fillna(0).to_numpy(np.int64),
                model.p1.to_numpy())

    def _walk(self, arrays):
        shared = self.nodes.sparkSession.sparkContext.broadcast(arrays)
        n_terms = self.n_terms

        @F.pandas_udf("array<double>")
        def probs(t: pd.Series, b: pd.Series) -> pd.Series:
            flat = lambda s: np.concatenate([*s, []]).astype(np.int64)
            doc = np.repeat(np.arange(len(t)), t.map(len).to_numpy())
            return pd.Series(list(walk(shared.value, len(t), n_terms, doc, flat(t), flat(b))))

        return probs

    def _walk_by_joins(self, rows: DataFrame, id_col: str) -> DataFrame:
        """The same by joins on (tree, path), one step of all rows and trees at a time."""
        nodes = self.nodes.select("tree", "path", "term_id", "bin", (F.col("w1") / (F.col("w0") + F.col("w1"))).alias("p1"))
        rows = cut_lineage(rows)
        state = rows.select(id_col, F.explode(F.sequence(F.lit(0), F.lit(self.n_trees - 1))).alias("tree"), F.lit("").alias("path"),
                            F.lit(None).cast("double").alias("p"))
        depth = nodes.agg(F.max(F.length("path"))).first()[0]
        for step in range(depth + 1):
            j = state.join(nodes, ["tree", "path"], "left").join(rows.select(id_col, "t", "b"), id_col)
            state = j.select(
                id_col, "tree", F.when(F.col("term_id").isNull(), F.col("path")).otherwise(
                    F.concat("path", F.when(_own_bin() >= F.col("bin"), "1").otherwise("0"))).alias("path"),
                F.when(F.col("term_id").isNull(), F.coalesce("p", "p1")).alias("p"))
            if step % STEPS == STEPS - 1:
                state = cut_lineage(state)
        probs = state.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("tree", "p"))).getField("p").alias("probs"))
        return rows.drop("t", "b").join(probs, id_col)

    def score(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """Every row of ``docs`` gets ``prediction`` and ``probability`` (of class 1): the mean of the trees. Equal
        probabilities are class 0."""
        return self.with_class(self.tree_probabilities(docs, feats, id_col), docs.columns)

    def with_class(self, out: DataFrame, columns: list[str]) -> DataFrame:
        """``columns`` with the class and probability that follow from ``probs``."""
        p = F.aggregate("probs", F.lit(0.0), lambda s, x: s + x) / F.lit(float(self.n_trees))
        return out.select(*columns, p.alias("probability")).withColumn(
            "prediction", (F.round("probability", 12) > 0.5).cast("int"))

    def importances(self, vocab: DataFrame) -> DataFrame:
        """``(term, importance)``: each split's impurity decrease, shares within a tree, mean of the trees that split."""
        per = self.nodes.where("term_id IS NOT NULL").groupBy("tree", "term_id").agg(F.sum("gain").alias("g"))
        total = per.groupBy("tree").agg(F.sum("g").alias("total")).where("total > 0")
        n = total.count()
        mean = per.join(F.broadcast(total), "tree").groupBy("term_id").agg((F.sum(F.col("g") / F.col("total")) / F.lit(max(n, 1))).alias("importance"))
        return vocab.select("term_id", "term").join(mean, "term_id").where("importance > 0").select("term", "importance")

    def save(self, path: str):
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.edges.write.mode("overwrite").parquet(f"{path}/edges")

    def options(self) -> dict:
        return {"n_terms": self.n_terms, "specs": [asdict(s) for s in self.specs]}

    @classmethod
    def load(cls, spark, path: str, n_terms: int, specs: list[dict]) -> "TreeModel":
        own = [TreeSpec(**s) for s in specs]
        return cls(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"), len(own), n_terms, own)


def tree_rows(feats: DataFrame, docs: DataFrame, vocab: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """``(row_id, label, weight, t, b)`` of the training rows, the range of each term and the number of terms."""
    n_terms = vocab.count()
    edges = write_table(bin_edges(feats))
    rows = binned(docs.select("row_id", "label", "weight"), feats, edges, n_terms)
    return write_table(rows), edges, n_terms


def fit_trees(prepared: tuple[DataFrame, DataFrame, int], specs: list[TreeSpec],
              local_entries: int = LOCAL_ENTRIES) -> TreeModel:
    """One tree for each of ``specs`` on the training rows of ``tree_rows``."""
    rows, edges, n_terms = prepared
    return TreeModel(grow(rows, specs, n_terms, local_entries), edges, len(specs), n_terms, specs)
