"""Models fitted by passes over packed rows, many at a time.

Training rows lie in blocks: documents with their terms and values as packed arrays, written once. A pass reads every
block once, whatever the number of models under way: each task adds up what its blocks give to all of them, and Spark
sums these vectors by chunks. The driver holds the parameters and the summed gradients only, at most ``AT_ONCE`` numbers
(or one model's, if that is larger); what is more goes into further groups of models.

Folds need no rows of their own: a block carries the fold of each row, and a model leaves out the rows of its own fold.
Scaling is part of the parameters: a weight is divided by the fold's standard deviation instead of every value.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textsieve.session import drop_table, write_table

#: Numbers that a pass sends out and sums up at most (32 MB), where one model has fewer.
AT_ONCE = 4_000_000
#: Numbers in one message of a task's sums.
CHUNK = 65_536
#: Entries (document, term) of a block, of a file of blocks, and products that a task holds at a time.
BLOCK_ENTRIES, FILE_ENTRIES, PRODUCTS = 262_144, 4_000_000, 4_000_000

#: Products with so many models at least are made of dense pieces of so many numbers (8 MB), unless a row has less than one
#: entry in so many terms: a dense product takes that much less for a number than a sparse one.
DENSE_MODELS, DENSE_NUMBERS, DENSE_GAIN = 8, 1_000_000, 64

#: A block as a row: each part is the bytes of an array.
KINDS = {"label": "f8", "weight": "f8", "fold": "i4", "start": "i8", "place": "i4", "value": "f8"}
BLOCKS = "label binary, weight binary, fold binary, start binary, place binary, value binary"


# --- packed rows ------------------------------------------------------------------

@dataclass
class Block:
    """Some documents as a sparse matrix by rows: row ``i`` has the entries ``start[i]:start[i + 1]``."""

    label: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    start: np.ndarray
    place: np.ndarray
    value: np.ndarray

    def __len__(self):
        return len(self.label)

    def rows(self, a: int, b: int) -> "Block":
        lo, hi = self.start[a], self.start[b]
        return Block(self.label[a:b], self.weight[a:b], self.fold[a:b], self.start[a:b + 1] - lo, self.place[lo:hi],
                     self.value[lo:hi])

    def pieces(self, entries: int):
        """The block in runs of rows with at most ``entries`` entries (one row at least)."""
        a = 0
        while a < len(self):
            b = max(int(np.searchsorted(self.start, self.start[a] + entries, "right")) - 1, a + 1)
            yield self.rows(a, b)
            a = b

    def pieces_for(self, terms: int, models: int):
        """The block in runs of rows that suit products with ``models`` columns of ``terms`` numbers."""
        if models < DENSE_MODELS or terms * len(self) > DENSE_GAIN * len(self.place):
            yield from self.pieces(max(1, PRODUCTS // models))
            return
        step = max(1, DENSE_NUMBERS // terms)
        for a in range(0, len(self), step):
            yield DensePiece.of(self.rows(a, min(a + step, len(self))), terms)

    def times(self, w: np.ndarray) -> np.ndarray:
        """rows x terms by terms x models."""
        out = np.zeros((len(self), w.shape[1]))
        some = np.flatnonzero(np.diff(self.start))
        if len(some):
            out[some] = np.add.reduceat(w[self.place] * self.value[:, None], self.start[some], axis=0)
        return out

    def add_transposed(self, out: np.ndarray, g: np.ndarray, value: np.ndarray | None = None):
        """Add terms x rows by rows x models to ``out``."""
        if len(self.place):
            value = self.value if value is None else value
            order = np.argsort(self.place, kind="stable")
            place = self.place[order]
            first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            row = np.repeat(np.arange(len(self)), np.diff(self.start))[order]
            out[place[first]] += np.add.reduceat(g[row] * value[order][:, None], first, axis=0)


class DensePiece(Block):
    """Rows of a block with all their terms."""

    @classmethod
    def of(cls, b: Block, terms: int) -> "DensePiece":
        out = cls(b.label, b.weight, b.fold, b.start, b.place, b.value)
        # an entry that comes twice counts twice, as in sparse products
        row = np.repeat(np.arange(len(b)), np.diff(b.start))
        out.x = np.bincount(row * terms + b.place, b.value, len(b) * terms).reshape(len(b), terms)
        return out

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.x @ w

    def add_transposed(self, out: np.ndarray, g: np.ndarray, value: np.ndarray | None = None):
        if value is not None:
            return super().add_transposed(out, g, value)
        out += self.x.T @ g


def pack(docs: DataFrame, feats: DataFrame) -> DataFrame:
    """Blocks of ``docs(row_id, label, weight, fold)`` with ``feats(row_id, term_id, value)``, written to the checkpoint
    folder: as many files as entries fill, and no fewer than cores. A document without a known term is an empty row."""
    entry = F.struct(F.col("term_id").cast("int").alias("i"), F.col("value").cast("double").alias("v"))
    terms = feats.groupBy("row_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    e = F.coalesce("e", F.array().cast("array<struct<i:int,v:double>>"))
    rows = docs.join(terms, "row_id", "left")
    files = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(feats.count() / FILE_ENTRIES))
    rows = rows.repartition(files, "row_id").select(
        F.col("label").cast("double"), F.col("weight").cast("double"), F.col("fold").cast("int"),
        e.getField("i").alias("place"), e.getField("v").alias("value"))
    return write_table(rows.mapInArrow(_packed, BLOCKS))


def _packed(batches):
    for batch in batches:
        label, weight, fold = (batch.column(c).to_numpy() for c in ("label", "weight", "fold"))
        place, value = batch.column("place"), batch.column("value")
        start = place.offsets.to_numpy().astype(np.int64)
        rows = Block(label, weight, fold, start - start[0], place.flatten().to_numpy(zero_copy_only=False),
                     value.flatten().to_numpy(zero_copy_only=False))
        for p in rows.pieces(BLOCK_ENTRIES):
            parts = {c: getattr(p, c).astype(t).tobytes() for c, t in KINDS.items()}
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts.values()], list(parts))


def unpacked(batch):
    """The blocks of an Arrow batch."""
    for i in range(batch.num_rows):
        yield Block(**{c: np.frombuffer(batch.column(c)[i].as_buffer(), t) for c, t in KINDS.items()})


def summed(blocks: DataFrame, size: int, work, shared=None) -> np.ndarray:
    """``size`` numbers: the sum of what ``work(task's blocks, shared, total)`` adds to a task's ``total``."""
    sent = blocks.sparkSession.sparkContext.broadcast(shared)

    def task(batches):
        total = np.zeros(size)
        if work((b for batch in batches for b in unpacked(batch)), sent.value, total):
            for c in range(0, size, CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([c // CHUNK], pa.int32()), pa.array([total[c:c + CHUNK].tobytes()], pa.binary())],
                                                 ["chunk", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table["sums"][0].as_buffer()) // 8)
        for x in table["sums"]:  # one of each task
            total += np.frombuffer(x.as_buffer())
        return pa.table([table["chunk"].slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["chunk", "sums"])

    # the numbers stay bytes all the way: rows of arrays and their sums in the JVM took longer than the products
    sums = blocks.mapInArrow(task, "chunk int, sums binary").groupBy("chunk").applyInArrow(add, "chunk int, sums binary")
    out = np.zeros(size)
    for r in sums.collect():  # the parameters' size, no more
        own = np.frombuffer(r["sums"])
        out[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(own)] = own
    sent.destroy()
    return out


# --- one convex fit, as a sequence of points to evaluate --------------------------------

class Descent:
    """Limited-memory quasi-Newton descent of a mean loss with an L1 or L2 penalty on all places but the last. The owner
    evaluates the smooth loss at ``trial`` and tells it; many descents share the passes that evaluate them."""

    MEMORY, SHRINK, HALVINGS = 10, 1e-4, 30

    def __init__(self, size: int, l1: float, l2: float, max_iter: int, tol: float):
        self.l1, self.l2, self.max_iter, self.tol = l1, l2, max_iter, tol
        self.trial, self.x, self.value = np.zeros(size), None, None
        self.pairs, self.iterations, self.halvings, self.flat, self.done = [], 0, 0, 0, False

    def tell(self, loss: float, grad: np.ndarray):
        w = self.trial[:-1]
        value = loss + 0.5 * self.l2 * (w @ w) + self.l1 * np.abs(w).sum()
        if self.value is not None:
            if value > self.value + self.SHRINK * (self.slope @ (self.trial - self.x)):
                self.halvings += 1
                if self.halvings > self.HALVINGS:  # no lower point along this line within double precision
                    self.done = True
                else:
                    self.step *= 0.5
                    self._propose()
                return
        grad = grad.copy()
        grad[:-1] += self.l2 * w
        if self.value is not None:
            s, y = self.trial - self.x, grad - self.grad
            if s @ y > 1e-12 * (y @ y):
                self.pairs = [*self.pairs, (s, y)][-self.MEMORY:]
            small = self.value - value <= 1e-2 * self.tol * abs(value)
            self.flat = self.flat + 1 if small else 0
            self.iterations += 1
        self.x, self.value, self.grad = self.trial, value, grad
        self.slope = self._slope()
        # relative to the loss: with a weak penalty both become small long before the classes of new rows settle
        if np.abs(self.slope).max(initial=0.0) <= max(self.tol * abs(value), 1e-8) or self.flat >= 3 or self.iterations >= self.max_iter:
            self.done = True
            return
        self._aim()

    def _slope(self):
        """The gradient, at a corner of the L1 penalty its least one-sided value."""
        if not self.l1:
            return self.grad
        w, g = self.x[:-1], self.grad[:-1]
        at_zero = np.sign(g) * np.maximum(np.abs(g) - self.l1, 0.0)
        return np.r_[np.where(w != 0, g + self.l1 * np.sign(w), at_zero), self.grad[-1]]

    def _aim(self):
        """The next direction, within the places that may move: a place that stays at its corner has no curvature here."""
        q, back, pairs = self.slope.copy(), [], self.pairs
        if self.l1:
            free = np.r_[(self.x[:-1] != 0) | (self.slope[:-1] != 0), True]
            pairs = [(s * free, y * free) for s, y in pairs]
            pairs = [(s, y) for s, y in pairs if s @ y > 1e-12 * (y @ y)]
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            q -= a * y
            back.append(a)
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(back)):
            q += s * (a - (y @ q) / (s @ y))
        if self.l1:
            q[:-1][q[:-1] * self.slope[:-1] <= 0] = 0.0
        if self.slope @ q <= 0:
            q, pairs, self.pairs = self.slope.copy(), [], []
        self.direction, self.halvings = -q, 0
        self.step = 1.0 if pairs else min(1.0, 1.0 / np.linalg.norm(q))
        self._propose()

    def _propose(self):
        self.trial = self.x + self.step * self.direction
        if self.l1:  # no step crosses zero
            side = np.where(self.x[:-1] != 0, np.sign(self.x[:-1]), -np.sign(self.slope[:-1]))
            self.trial[:-1][self.trial[:-1] * side <= 0] = 0.0


# --- logistic regression: all points of a grid, all folds ------------------------------------

@dataclass
class LogisticFit:
    """One fit: without the rows of ``fold`` (none with -1), with a factor on the weight of either class."""

    c: float = 1.0
    penalty: str | None = "l2"
    balanced: bool = False
    fold: int = -1
    max_iter: int = 1000


def class_weights(blocks: DataFrame, k: int) -> np.ndarray:
    """``[fold, label]``: the rows' weight."""
    def work(own, _, total):
        cells = total.reshape(k, 2)
        for b in own:
            np.add.at(cells, (b.fold, b.label.astype(int)), b.weight)
        return True

    return summed(blocks, 2 * k, work).reshape(k, 2)


def fold_scales(blocks: DataFrame, n_terms: int, counts: np.ndarray) -> np.ndarray:
    """``[fold, term]``: F12's standard deviation over the rows that are not of the fold; the last one is over all."""
    k = len(counts)
    out = np.ones((k + 1, n_terms))
    total = np.r_[counts.sum() - counts.sum(axis=1), counts.sum()][:, None]
    width = max(1, AT_ONCE // (2 * k))
    for a in range(0, n_terms, width):  # terms in ranges, where a vocabulary is large
        b = min(a + width, n_terms)

        def work(own, _, sums):
            s = sums.reshape(b - a, 2 * k)
            for block in own:
                for p in block.pieces(max(1, PRODUCTS // (2 * k))):
                    g = np.zeros((len(p), k))
                    g[np.arange(len(p)), p.fold] = p.weight
                    inside = (p.place >= a) & (p.place < b)
                    start = np.r_[0, np.cumsum(inside)][p.start]
                    q = Block(p.label, p.weight, p.fold, start, p.place[inside] - a, p.value[inside])
                    q.add_transposed(s[:, :k], g)
                    q.add_transposed(s[:, k:], g, q.value ** 2)
            return True

        own = summed(blocks, 2 * k * (b - a), work).reshape(b - a, 2, k).transpose(1, 2, 0)
        s1, s2 = (np.vstack([x.sum(axis=0) - x, x.sum(axis=0)[None]]) / np.maximum(total, 1e-300) for x in own)
        std = np.sqrt(np.maximum(s2 - s1 * s1, 0.0))
        out[:, a:b] = np.where(std > 0, std, 1.0)
    return out


def _losses(own, shared, total):
    """Loss and gradient of every model: ``w`` is (terms + 1) x models, the last row the constants."""
    w, fold, factor = shared
    n, m = w.shape[0] - 1, w.shape[1]
    loss, grad = total[:m], total[m:].reshape(n + 1, m)
    for block in own:
        for p in block.pieces_for(n, m):
            side = 2 * p.label - 1
            z = side[:, None] * (p.times(w[:n]) + w[n])
            rows = p.weight[:, None] * factor[p.label.astype(int)] * (p.fold[:, None] != fold)
            loss += (rows * np.logaddexp(0.0, -z)).sum(axis=0)
            g = -side[:, None] * rows * np.exp(-np.logaddexp(0.0, z))
            p.add_transposed(grad[:n], g)
            grad[n] += g.sum(axis=0)
    return True


def _held_out(own, shared, total):
    """True positives and errors of every model on the rows of its fold."""
    w, fold, _ = shared
    n, m = w.shape[0] - 1, w.shape[1]
    cells = total.reshape(2, m)
    for block in own:
        for p in block.pieces_for(n, m):
            yes = p.times(w[:n]) + w[n] > 0
            rows = p.weight[:, None] * (p.fold[:, None] == fold)
            real = p.label[:, None] == 1
            cells[0] += (rows * (yes & real)).sum(axis=0)
            cells[1] += (rows * (yes != real)).sum(axis=0)
    return True


def fit_logistic(blocks: DataFrame, n_terms: int, fits: list[LogisticFit], k: int, tol: float, scores: bool = True):
    """Coefficients ``[model, terms + 1]`` (on scaled values, the constant last), each model's held-out F1 of class 1 (none
    unless ``scores``), and the number of passes. All models of a group take each pass together; one that has come to its
    end leaves it."""
    counts = class_weights(blocks, k)
    scales = fold_scales(blocks, n_terms, counts)
    group = max(1, AT_ONCE // (n_terms + 1))
    coefficients, f1, passes = [], [], 0
    for a in range(0, len(fits), group):
        part = fits[a:a + group]
        std = np.stack([np.r_[scales[f.fold], 1.0] for f in part])
        by_class = np.stack([counts.sum(axis=0) - (counts[f.fold] if f.fold >= 0 else 0.0) for f in part])
        n = by_class.sum(axis=1)
        factor = np.where(np.array([f.balanced for f in part])[:, None], n[:, None] / np.maximum(2 * by_class, 1e-300), 1.0)
        # a part of one class gives either factor, as the classes that are there then weigh n
        n = np.maximum((factor * by_class).sum(axis=1).astype(int), 1)
        fold = np.array([f.fold for f in part])
        runs = [Descent(n_terms + 1, *((r, 0.0) if f.penalty == "l1" else (0.0, r)), f.max_iter, tol)
                for f, r in zip(part, 1.0 / (np.array([f.c for f in part]) * n))]
        while True:
            live = [i for i, r in enumerate(runs) if not r.done]
            if not live:
                break
            w = np.stack([runs[i].trial / std[i] for i in live], axis=1)
            out = summed(blocks, (n_terms + 2) * len(live), _losses, (w, fold[live], factor[live].T))
            passes += 1
            loss, grad = out[:len(live)], out[len(live):].reshape(n_terms + 1, len(live))
            for j, i in enumerate(live):
                runs[i].tell(loss[j] / n[i], grad[:, j] / std[i] / n[i])
        coefficients += [r.x for r in runs]
        if scores:
            w = np.stack([r.x / s for r, s in zip(runs, std)], axis=1)
            tp, wrong = summed(blocks, 2 * len(part), _held_out, (w, fold, None)).reshape(2, len(part))
            f1 += [float(2 * t / (2 * t + x)) if t else 0.0 for t, x in zip(tp, wrong)]
    return np.array(coefficients), f1, passes


# --- neural network ---------------------------------------------------------------------------

def layer_views(weights: np.ndarray, layers: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(inputs x outputs, constants)`` of each layer of Spark's flat weights."""
    out, at = [], 0
    for n, m in zip(layers, layers[1:]):
        out.append((weights[at:at + n * m].reshape(n, m), weights[at + n * m:at + n * m + m]))
        at += n * m + m
    return out


def _network(own, shared, total):
    """Summed loss (cross-entropy of a softmax behind sigmoid layers) and its gradient."""
    weights, layers = shared
    net, grad = layer_views(weights, layers), layer_views(total[1:], layers)
    for block in own:
        for p in block.pieces_for(layers[0], layers[1]):
            z, seen = p.times(net[0][0]) + net[0][1], []
            for w, c in net[1:]:
                seen.append(np.exp(-np.logaddexp(0.0, -z)))
                z = seen[-1] @ w + c
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
            real = p.label.astype(int)
            copies = np.maximum(np.floor(p.weight + 0.5), 1.0)
            total[0] -= copies @ z[np.arange(len(p)), real]
            g = np.exp(z)
            g[np.arange(len(p)), real] -= 1.0
            g *= copies[:, None]
            for i in range(len(net) - 1, 0, -1):
                a = seen[i - 1]
                grad[i][0][:] += a.T @ g
                grad[i][1][:] += g.sum(axis=0)
                g = (g @ net[i][0].T) * a * (1.0 - a)
            p.add_transposed(grad[0][0], g)
            grad[0][1][:] += g.sum(axis=0)
    return True


def fit_network(blocks: DataFrame, layers: list[int], start: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """Weights of a network after descent from ``start``, and the mean loss after each step. It ends as Spark's own solver
    does: after ``max_iter`` steps, or where ten steps lowered the loss by ``tol`` of its first value at most."""
    n = summed(blocks, 1, _copies)[0]
    run, losses = Descent(len(start), 0.0, 0.0, max_iter, tol), []
    run.trial = np.array(start, float)
    while n and not run.done:
        out = summed(blocks, len(start) + 1, _network, (run.trial, layers))
        run.tell(out[0] / n, out[1:] / n)
        if run.x is not None and (not losses or run.value < losses[-1]):
            losses.append(run.value)
            if len(losses) > 10 and losses[-11] - losses[-1] <= tol * losses[0]:
                break
    return (run.x if run.x is not None else run.trial), losses


def _copies(own, _, total):
    for block in own:
        total[0] += np.maximum(np.floor(block.weight + 0.5), 1.0).sum()
    return True


def release(blocks: DataFrame):
    """Delete the blocks of ``pack``."""
    drop_table(blocks)
