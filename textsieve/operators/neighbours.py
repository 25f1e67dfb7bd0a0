"""Exact k nearest neighbours over the long feature table.

Values are not negative, so both distances are a sum of two norms and an
overlap that only shared terms add to:

    Manhattan          N(q) + N(x) - 2 sum min(q_t, x_t),   N = sum of values
    Euclidean, squared N(q) + N(x) - 2 sum q_t x_t,         N = sum of squares

Training rows and queries lie in packed blocks. Every block of queries meets every block of rows once, in a task that
adds up the overlaps of the terms they share, strip by strip, and sends on each query's ``k`` nearest rows of the block;
the nearest of all blocks are the result. A task holds two blocks and one strip, whatever the tables' size. Nothing is cut
off, all pairs are compared: twice the rows take four times the work.

``candidates`` leaves most pairs out instead. All terms have one order, the rarest first. If t is the first term that two
rows share, their overlap is at most what either has from t on: the lesser of both sums, or the root of the product of
both sums of squares. So a pair is met at its first shared term or nowhere, with a bound of its distance there. Each query
meets the rows that it shares one of their rarest terms with, and the k rows of the smallest norms; the best of them,
measured, give it a reach. Rows are listed under their terms in buckets by the least distance they could have there, and
a query reads only the buckets within its reach. A pair met this way takes rows of joins, several where it is measured;
``neighbours`` does not use it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textsieve.operators.rank import top_k_per_group
from textsieve.operators.vectorize import BROADCAST_VOCAB_ROWS
from textsieve.session import drop_table, write_table

#: Rows of a block: packed rows that meet at once, and what a term's list is dealt to, so that no task reads a whole one.
BLOCK_ROWS = 4096
#: Entries (row, term) of a packed block at most (one row at least); queries of a strip; terms of a dense product at a time.
BLOCK_ENTRIES, STRIP, SLAB = 2_000_000, 256, 512
#: Terms that more than this share of a strip's pairs have in common are added up as a dense product, by ``p``.
DENSE = {1: 0.2, 2: 0.004}
#: Buckets of the lists by impact; the rarest terms of a row under which the first step meets it; pairs that step measures.
BUCKETS, PROBES, MEASURED = 32, 4, 2
#: Distances (squared if Euclidean) are compared at so many decimals; nearer ones are ties, which the row id decides.
DECIMALS = 6
SLACK = 10.0 ** (1 - DECIMALS)

#: A block as a row: each part is the bytes of an array. Row ``i`` has the entries ``start[i]:start[i + 1]``.
KINDS = {"id": "i8", "label": "f8", "weight": "f8", "norm": "f8", "start": "i8", "place": "i4", "value": "f8"}


def _norm(v: Column, p: int) -> Column:
    return F.sum(v if p == 1 else v * v)


# --- blocks ---------------------------------------------------------------------

def pack(rows: DataFrame, entries: DataFrame, prefix: str) -> DataFrame:
    """Blocks of ``rows(id, label, weight, norm)``, by id within a block, with ``entries(id, place, value)``, written to the
    checkpoint folder. A row without entries is an empty one; rows of one id share its entries."""
    entry = F.struct(F.col("place").cast("int").alias("i"), F.col("value").cast("double").alias("v"))
    own = entries.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    e = F.coalesce("e", F.array().cast("array<struct<i:int,v:double>>"))
    nan = F.lit(float("nan"))
    files = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    dealt = rows.join(own, "id", "left").repartition(files, "id").sortWithinPartitions("id").select(
        F.col("id").cast("long"), *[F.coalesce(F.col(c).cast("double"), nan).alias(c) for c in ("label", "weight", "norm")],
        e.getField("i").alias("place"), e.getField("v").alias("value"))

    def packed(batches):
        for batch in batches:
            place, value = batch.column("place"), batch.column("value")
            start = place.offsets.to_numpy().astype(np.int64)
            parts = {c: batch.column(c).to_numpy() for c in ("id", "label", "weight", "norm")}
            terms, values, start = (*(c.flatten().to_numpy(zero_copy_only=False) for c in (place, value)), start - start[0])
            # a partition's rows scatter about BLOCK_ROWS: no block of the few that are over
            many = max(math.ceil(batch.num_rows / (1.2 * BLOCK_ROWS)), math.ceil(start[-1] / BLOCK_ENTRIES))
            for rows in np.array_split(np.arange(batch.num_rows), min(many, batch.num_rows)):
                a, b = rows[0], rows[-1] + 1
                lo, hi = start[a], start[b]
                block = {**{c: x[a:b] for c, x in parts.items()}, "start": start[a:b + 1] - lo, "place": terms[lo:hi],
                         "value": values[lo:hi]}
                yield pa.RecordBatch.from_arrays([pa.array([block[c].astype(t).tobytes()], pa.binary()) for c, t in KINDS.items()],
                                                 [prefix + c for c in KINDS])

    return write_table(dealt.mapInArrow(packed, ", ".join(f"{prefix}{c} binary" for c in KINDS)))


def _layers(row: np.ndarray, place: np.ndarray, value: np.ndarray):
    """Entries by place, as ``(place's values, first of each, end of each, row, value)``; an entry that a row has twice is in
    a layer of its own, as both count."""
    order = np.lexsort((row, place))
    row, place, value = row[order], place[order], value[order]
    while len(row):
        again = np.r_[False, (row[1:] == row[:-1]) & (place[1:] == place[:-1])]
        r, t, v = row[~again], place[~again], value[~again]
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        yield t[first], first, np.r_[first[1:], len(t)], r, v
        row, place, value = row[again], place[again], value[again]


def _add_overlap(out: np.ndarray, q, x, p: int):
    """Add to ``out`` the overlap that a layer of queries and one of rows have on the terms of both."""
    (qt, qa, qb, qr, qv), (xt, xa, xb, xr, xv) = q, x
    _, i, j = np.intersect1d(qt, xt, assume_unique=True, return_indices=True)
    qa, qb, xa, xb = qa[i], qb[i], xa[j], xb[j]
    dense = (qb - qa) * (xb - xa) > DENSE[p] * out.size
    if p == 2:
        common = np.flatnonzero(dense)
        for s in range(0, len(common), SLAB):
            part = common[s:s + SLAB]
            left, right = np.zeros((out.shape[0], len(part))), np.zeros((len(part), out.shape[1]))
            for c, t in enumerate(part):
                left[qr[qa[t]:qb[t]], c] = qv[qa[t]:qb[t]]
                right[c, xr[xa[t]:xb[t]]] = xv[xa[t]:xb[t]]
            out += left @ right
    else:
        for t in np.flatnonzero(dense):
            left, right = np.zeros(out.shape[0]), np.zeros(out.shape[1])
            left[qr[qa[t]:qb[t]]] = qv[qa[t]:qb[t]]
            right[xr[xa[t]:xb[t]]] = xv[xa[t]:xb[t]]
            out += np.minimum(left[:, None], right)
    add = (np.minimum if p == 1 else np.multiply).outer
    flat, at = out.reshape(-1), qr * out.shape[1]
    for a, b, c, d in zip(qa[~dense].tolist(), qb[~dense].tolist(), xa[~dense].tolist(), xb[~dense].tolist()):
        flat[at[a:b, None] + xr[c:d]] += add(qv[a:b], xv[c:d])


def _nearest(q: dict, x: dict, k: int, p: int):
    """``(row of q, row of x, far)``: for each row of the block ``q`` its ``k`` nearest rows of the block ``x``."""
    nx = len(x["id"])
    theirs = list(_layers(np.repeat(np.arange(nx), np.diff(x["start"])), x["place"], x["value"]))
    for a in range(0, len(q["id"]), STRIP):
        b = min(a + STRIP, len(q["id"]))
        lo, hi = q["start"][a], q["start"][b]
        out = np.zeros((b - a, nx))
        for mine in _layers(np.repeat(np.arange(b - a), np.diff(q["start"][a:b + 1])), q["place"][lo:hi], q["value"][lo:hi]):
            for other in theirs:
                _add_overlap(out, mine, other, p)
        far = np.round(np.maximum(q["norm"][a:b, None] + x["norm"] - 2 * out, 0.0), DECIMALS)
        if nx > k:
            row, col = np.nonzero(far <= np.partition(far, k - 1, axis=1)[:, k - 1:k])
        else:
            row, col = np.indices(far.shape).reshape(2, -1)
        value = far[row, col]
        order = np.lexsort((col, value, row))  # a block lies by row id
        row, col, value = row[order], col[order], value[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        yield row[keep] + a, col[keep], value[keep]


def _met(k: int, p: int):
    """Of pairs of blocks: ``id`` of each query with ``row_id, label, weight, far`` of the nearest rows."""

    def task(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                q, x = ({c: np.frombuffer(batch.column(prefix + c)[i].as_buffer(), t) for c, t in KINDS.items()} for prefix in "qx")
                for row, col, far in _nearest(q, x, k, p):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (q["id"][row], x["id"][col], x["label"][col], x["weight"][col], far)],
                        ["n", "row_id", "label", "weight", "far"])

    return task


# --- model ----------------------------------------------------------------------

@dataclass
class KNNModel:
    """Training rows ``rows(row_id, label, weight, norm)``, their scaled vectors ``vectors(row_id, term, v)``, the scale
    ``std(term, std)`` and the frequencies and numbers ``df(term, df, term_id)`` of the terms."""

    rows: DataFrame
    vectors: DataFrame
    std: DataFrame
    df: DataFrame
    n_terms: int
    k: int = 5
    weights: str = "uniform"
    p: int = 2

    def _small(self, df: DataFrame) -> DataFrame:
        """A table of one row per term, broadcast under the bound of the vocabulary."""
        return F.broadcast(df) if self.n_terms <= BROADCAST_VOCAB_ROWS else df

    def _add(self, q: Column, x: Column) -> Column:
        return F.least(q, x) if self.p == 1 else q * x

    def _most(self, q: Column, x: Column) -> Column:
        """The largest overlap of two rows by what each has left."""
        return F.least(q, x) if self.p == 1 else F.sqrt(q * x)

    def ordered(self, vectors: DataFrame, id_col: str) -> DataFrame:
        """``vectors`` with ``at``, a term's place in its row's order, and ``left``, what the row has from there on."""
        size = F.col("v") if self.p == 1 else F.col("v") * F.col("v")
        # the terms of one row, as many as a document has
        w = Window.partitionBy(id_col).orderBy("df", "term")
        onward = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        return vectors.join(self._small(self.df), "term").select(
            id_col, "term", "v", F.row_number().over(w).alias("at"), F.sum(size).over(onward).alias("left"))

    def first_rows(self) -> tuple[list, float]:
        """The ``k`` rows of the smallest norms (copies count), ties by row id, and the norm of the last copy."""
        first = self.rows.orderBy("norm", "row_id").limit(self.k).collect()  # k rows
        seen = 0.0
        for i, r in enumerate(first):
            seen += r["weight"]
            if seen >= self.k:
                return first[:i + 1], r["norm"]
        return first, float("inf")

    def met(self, asked: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
        """``asked`` joined with ``index`` on ``keys``, each key's rows dealt to blocks of ``BLOCK_ROWS``."""
        blocks = index.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks"))
        blocks = write_table(blocks)
        # a row per term and bucket
        blocks = F.broadcast(blocks) if self.n_terms * BUCKETS <= BROADCAST_VOCAB_ROWS else blocks
        index = index.join(blocks, keys).withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("blocks"))).drop("blocks")
        asked = asked.join(blocks, keys).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).drop("blocks")
        return asked.join(index, [*keys, "block"]).drop("block")

    def near_first(self, asked_ids: DataFrame, first: list) -> DataFrame:
        """``qid, row_id, norm``: every query with the rows of the smallest norms, ``k`` at most."""
        near = F.array(*[F.struct(F.lit(r["row_id"]).alias("row_id"), F.lit(float(r["norm"])).alias("norm")) for r in first])
        return asked_ids.select("qid", F.explode(near).alias("x")).select("qid", "x.*")

    def measured(self, pairs: DataFrame, queries: DataFrame, qnorms: DataFrame) -> DataFrame:
        """``qid, row_id, label, weight, far`` of distinct pairs ``(qid, row_id)``: their distances (squared if Euclidean)."""
        shared = (pairs.join(self.vectors, "row_id").join(queries.select("qid", "term", F.col("v").alias("qv")), ["qid", "term"])
                  .groupBy("qid", "row_id").agg(F.sum(self._add(F.col("qv"), F.col("v"))).alias("part")))
        far = F.coalesce("qnorm", F.lit(0.0)) + F.col("norm") - 2 * F.coalesce("part", F.lit(0.0))
        return pairs.join(shared, ["qid", "row_id"], "left").join(self.rows, "row_id").join(qnorms, "qid", "left").select(
            "qid", "row_id", "label", "weight", F.round(F.greatest(far, F.lit(0.0)), DECIMALS).alias("far"))

    def reach(self, asked_ids: DataFrame, queries: DataFrame, qnorms: DataFrame, index: DataFrame, first: list) -> DataFrame:
        """``qid, reach``: an upper bound of the k-th distance less the query's norm; null without as many copies."""
        probes = index.where(F.col("at") <= PROBES).select("term", "row_id", "norm", "v")
        pairs = self.met(queries.select("qid", "term", F.col("v").alias("qv")), probes, ["term"])
        pairs = pairs.select("qid", "row_id", "norm", self._add(F.col("qv"), F.col("v")).alias("part")).unionByName(
            self.near_first(asked_ids, first).withColumn("part", F.lit(0.0)))
        tried = pairs.groupBy("qid", "row_id").agg((F.max("norm") - 2 * F.sum("part")).alias("most"))
        best = top_k_per_group(tried, ["qid"], [F.asc("most"), F.asc("row_id")], MEASURED * self.k).select("qid", "row_id")
        known = self.measured(write_table(best), queries, qnorms)
        top = top_k_per_group(known, ["qid"], [F.asc("far"), F.asc("row_id")], self.k)
        seen = F.sum("weight").over(Window.partitionBy("qid").orderBy("rank"))
        kth = top.withColumn("seen", seen).where(F.col("seen") >= self.k).groupBy("qid").agg(F.min("far").alias("far"))
        return asked_ids.join(kth, "qid", "left").join(qnorms, "qid", "left").select(
            "qid", (F.col("far") - F.coalesce("qnorm", F.lit(0.0))).alias("reach"))

    def candidates(self, asked_ids: DataFrame, queries: DataFrame) -> DataFrame:
        """``qid, row_id``: the distinct pairs that may be neighbours, all neighbours among them. ``queries(qid, term, v)``."""
        first, bound = self.first_rows()
        queries = write_table(self.ordered(queries, "qid"))
        size = F.col("v") if self.p == 1 else F.col("v") * F.col("v")
        qnorms = write_table(queries.groupBy("qid").agg(F.sum(size).alias("qnorm")))
        most = queries.groupBy("term").agg(F.max("left").alias("cap"))
        # no query reaches beyond the k-th norm, so what lies there at its best is listed nowhere
        index = self.ordered(self.vectors, "row_id").join(self._small(most), "term").join(self.rows.select("row_id", "norm"), "row_id")
        index = index.withColumn("least", F.col("norm") - 2 * self._most(F.col("cap"), F.col("left")))
        index = write_table(index.where(F.col("least") <= F.lit(bound) + SLACK).drop("cap"))
        reach = write_table(self.reach(asked_ids, queries, qnorms, index, first))
        cuts = index.agg(F.percentile_approx("least", [i / BUCKETS for i in range(1, BUCKETS)])).first()[0] or []
        cuts = F.array(*[F.lit(float(c)) for c in sorted(set(cuts))]).cast("array<double>")
        below = lambda c: F.size(F.filter(cuts, lambda e: e <= c)).cast("long")
        lists = index.select("term", "row_id", "norm", "left", below(F.col("least")).alias("bucket"))
        # without a reach a query reads everything
        limit = F.coalesce("reach", F.lit(float("inf"))) + SLACK
        asked = queries.join(reach, "qid").select("qid", "term", F.col("left").alias("qleft"), limit.alias("limit"))
        asked = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), below(F.col("limit")))))
        found = self.met(asked, lists, ["term", "bucket"]).where(
            F.col("norm") - 2 * self._most(F.col("qleft"), F.col("left")) <= F.col("limit"))
        return found.select("qid", "row_id").unionByName(self.near_first(asked_ids, first).select("qid", "row_id")).distinct()

    def neighbours(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """``(id, neighbour, label, distance, copies, rank)``: the nearest training rows of each row of ``docs`` (unique
        ids), nearest first, until their copies number ``k``; the last row counts with as many as are missing."""
        if not self.rows.take(1):
            return docs.select(id_col).limit(0).select(
                id_col, *[F.lit(None).cast(t).alias(c) for c, t in
                          (("neighbour", "long"), ("label", "int"), ("distance", "double"), ("copies", "double"), ("rank", "int"))])
        asked = write_table(docs.select(F.col(id_col).alias("qid")).distinct().withColumn("n", F.monotonically_increasing_id()))
        number = self._small(self.df.select("term", "term_id"))
        queries = feats.select(id_col, "term", "value").join(self._small(self.std), "term").join(number, "term").select(
            F.col(id_col).alias("qid"), F.col("term_id").alias("place"), (F.col("value") / F.col("std")).alias("value"))
        queries = write_table(queries.join(asked, "qid").select(F.col("n").alias("id"), "place", "value"))
        qnorms = queries.groupBy("id").agg(_norm(F.col("value"), self.p).alias("norm"))
        none = F.lit(None).cast("double")
        wanted = asked.select(F.col("n").alias("id"), none.alias("label"), none.alias("weight")).join(
            qnorms, "id", "left").fillna(0.0, ["norm"])
        known = self.vectors.join(number, "term").select(F.col("row_id").alias("id"), F.col("term_id").alias("place"), F.col("v").alias("value"))
        q = pack(wanted, queries, "q")
        x = pack(self.rows.where("row_id IS NOT NULL").select(F.col("row_id").alias("id"), "label", "weight", "norm"), known, "x")
        # every block with every other one, each pair of files a task: no shuffle and no broadcast
        met = q.crossJoin(x.hint("shuffle_replicate_nl")).mapInArrow(
            _met(self.k, self.p), "n long, row_id long, label double, weight double, far double")
        best = write_table(top_k_per_group(met, ["n"], [F.asc("far"), F.asc("row_id")], self.k).withColumn(
            "label", F.when(~F.isnan("label"), F.col("label"))))
        for t in (queries, q, x):
            drop_table(t)
        best = best.join(asked, "n").drop("n")
        before = F.sum("weight").over(Window.partitionBy("qid").orderBy("rank")) - F.col("weight")
        return best.withColumn("copies", F.least("weight", F.lit(float(self.k)) - before)).where("copies > 0").select(
            F.col("qid").alias(id_col), F.col("row_id").alias("neighbour"), F.col("label").cast("int").alias("label"),
            (F.col("far") if self.p == 1 else F.sqrt("far")).alias("distance"), "copies", F.col("rank").cast("int").alias("rank"))

    def score(self, docs: DataFrame, feats: DataFrame, id_col: str = "row_id") -> DataFrame:
        """Every row of ``docs`` with the ``prediction`` and ``probability`` of its neighbours' votes: one a copy, or by the
        inverse distance, where neighbours at distance 0 outvote all others. Even votes are class 0; without training rows
        the probability is null."""
        near = self.neighbours(docs, feats, id_col)
        if self.weights == "distance":
            # k rows a document at most
            here = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy(id_col)) == 1
            vote = F.when(here, F.when(F.col("distance") == 0, F.col("copies")).otherwise(0.0)).otherwise(
                F.col("copies") / F.col("distance"))
        else:
            vote = F.col("copies")
        votes = near.withColumn("vote", vote).groupBy(id_col).agg(
            (F.sum(F.when(F.col("label") == 1, F.col("vote")).otherwise(0.0)) / F.sum("vote")).alias("probability"))
        return docs.join(votes, id_col, "left").withColumn(
            "prediction", F.when(F.round("probability", 12) > 0.5, 1).otherwise(0))

    def save(self, path: str):
        for name in ("rows", "vectors", "std", "df"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark, path: str, **options) -> "KNNModel":
        return cls(*[spark.read.parquet(f"{path}/{name}") for name in ("rows", "vectors", "std", "df")], **options)

    def options(self) -> dict:
        return {"n_terms": self.n_terms, "k": self.k, "weights": self.weights, "p": self.p}


def fit_knn(feats: DataFrame, docs: DataFrame, vocab: DataFrame, n_neighbors: int = 5, weights: str = "uniform",
            p: int = 2) -> KNNModel:
    """Keeps the training rows, scaled by F12; a row's weight is its number of copies, each of them a neighbour."""
    from textsieve.operators import bayes

    if weights not in ("uniform", "distance") or p not in (1, 2) or n_neighbors < 1:
        raise ValueError(f"no neighbours by n_neighbors={n_neighbors}, weights={weights!r}, p={p}")
    std = write_table(bayes.scale_std(feats, docs, vocab))
    n_terms = vocab.count()
    small = F.broadcast(std) if n_terms <= BROADCAST_VOCAB_ROWS else std
    vectors = write_table(feats.join(small, "term").select("row_id", "term", (F.col("value") / F.col("std")).alias("v")))
    norms = vectors.groupBy("row_id").agg(_norm(F.col("v"), p).alias("norm"))
    rows = write_table(docs.select("row_id", "label", "weight").join(norms, "row_id", "left").fillna(0.0, ["norm"]))
    return KNNModel(rows, vectors, std, vocab.select("term", "df", "term_id"), n_terms, n_neighbors, weights, p)
