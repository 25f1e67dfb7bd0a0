"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's vector is the mean of table rows picked by the hashes of the word and
of its first characters, so inflected forms share most of it. Filters of
several widths slide over the words of a whole text, the largest answer of each
filter is kept (max pooling), and a logistic layer turns these into a score.
The model learns from every labelled row, whole texts of any length: rows lie
in shards by the hash of their id, each shard takes the steps of a pass from
the same model in a task of its own, and Spark averages what they learned
before the next pass. An embedding is averaged over the shards that met it.
Texts are scored in Arrow batches, where each distinct word is projected once.

One labelled row in five is not fitted on: the score's scale and a threshold
for each language are calibrated on all of these, by sums that Spark makes. The
score never depends on it: languages, labels, sources and ids are no input.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textsieve.llm.batches import byte_classes, split_words
from textsieve.llm.common import read, text_batches
from textsieve.llm.quality_model import held_out
from textsieve.session import drop_table, write_table

#: Labelled rows of a shard and characters of their texts, about: what a task learns from at a time.
SHARD_ROWS, SHARD_CHARS = 8_192, 8 << 20
#: Passes over all rows where there are several shards; a single shard makes ``EPOCHS``.
ROUNDS = 6
#: So many labelled ids at most (12 bytes each) go to every task of the join with the texts.
BROADCAST_LABELS = 1_000_000
#: The table's rows are averaged in so many pieces; scores are counted at so many decimals of their log odds.
PIECES, LOGIT_DECIMALS = 64, 3
#: Bounds of ``training_rows``, for fits in memory (``fit``): rows of either label, the first by the md5 of their id, and
#: words of a text. ``fit_all`` has no such bound.
MAX_ROWS_OF_A_LABEL, MAX_TRAIN_WORDS = 3_000, 20_000
BUCKETS, DIM, FILTERS, WIDTHS, PREFIXES = 1 << 15, 12, 8, (1, 2, 3), (4, 5, 6)
#: Passes over the sample, and the least number of steps: a small sample is passed more often.
EPOCHS, MIN_STEPS, BATCH, STEP = 12, 1_000, 32, 0.05
#: One row in so many calibrates thresholds and the score's scale and is not fitted on.
CALIBRATE = 5
#: Positive calibration rows below which a language has the threshold of all languages.
MIN_POSITIVES = 20
ACCEPT = 0.3

CLASSES = byte_classes(bytes(range(33)) + b"!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~")


def buckets_of(words: list[bytes]) -> np.ndarray:
    """The table rows of each word: of the word and of its first 4, 5 and 6 characters."""
    from xxhash import xxh3_64_intdigest

    out = np.empty((len(words), 1 + len(PREFIXES)), dtype=np.int64)
    for i, w in enumerate(words):
        out[i, 0] = xxh3_64_intdigest(w) % BUCKETS
        # by bytes: for a hash it is no matter where in a character a prefix ends
        for k, n in enumerate(PREFIXES):
            out[i, k + 1] = xxh3_64_intdigest(w[:n], n) % BUCKETS
    return out


def padded(ids: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (from 1) with as many zeros after each text as the widest filter has places, and where each text begins.
    A text without words is zeros alone."""
    gap = max(WIDTHS)
    counts = np.bincount(doc, minlength=n_docs)
    starts = np.concatenate([[0], np.cumsum(counts + gap)])[:-1]
    out = np.zeros(int(counts.sum()) + gap * n_docs, dtype=np.int64)
    out[np.arange(len(ids)) + doc * gap] = ids + 1
    return out, starts


@dataclass
class ConvModel:
    """``table`` of embeddings, for each width its ``kernels`` (width x dim x filters) and ``biases``, the last layer, the
    scale and shift that turn its sum into a probability, and thresholds by language."""

    table: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    intercept: float
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = ACCEPT
    thresholds: dict[str, float] = field(default_factory=dict)

    def word_vectors(self, rows: np.ndarray) -> np.ndarray:
        """A vector for each word, after one of zeros for the gaps."""
        v = np.zeros((len(rows) + 1, self.table.shape[1]), dtype=self.table.dtype)
        for k in range(rows.shape[1]):
            v[1:] += self.table[rows[:, k]]
        v /= rows.shape[1]
        return v

    def answers(self, vectors: np.ndarray, seq: np.ndarray, starts: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """What a width's filters say at each word, and at the first place after a text; later places would see the next
        text and say nothing."""
        total = np.tile(bias.astype(vectors.dtype), (len(seq), 1))
        for j in range(kernel.shape[0]):
            total[:len(seq) - j] += (vectors @ kernel[j])[seq[j:]]
        ends = np.append(starts[1:], len(seq))
        for k in range(1, max(WIDTHS)):
            total[ends - k] = -np.inf
        return total

    def pooled(self, vectors: np.ndarray, seq: np.ndarray, starts: np.ndarray) -> np.ndarray:
        each = [np.maximum.reduceat(self.answers(vectors, seq, starts, k, b), starts, axis=0) if len(starts) else np.zeros((0, len(b)))
                for k, b in zip(self.kernels, self.biases)]
        return np.maximum(np.concatenate(each, axis=1), 0)

    def margin(self, rows: np.ndarray, seq: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.pooled(self.word_vectors(rows), seq, starts) @ self.out + self.intercept

    def score_texts(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 for each whole text of a column without nulls."""
        ids, words, doc, _ = split_words(texts, CLASSES)
        seq, starts = padded(ids, doc, len(texts))
        m = self.margin(buckets_of(words), seq, starts).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.scale * m + self.shift, -30, 30)))


def _begin(rng, prior: float) -> ConvModel:
    return ConvModel(
        (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32),
        [(rng.standard_normal((w, DIM, FILTERS)) * np.sqrt(1 / (w * DIM))).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        np.zeros(FILTERS * len(WIDTHS), np.float32), float(np.log(prior / (1 - prior))))


def _out(rng) -> np.ndarray:
    return (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32)


def fit(texts: list[str], y: np.ndarray, langs: list[str | None] | None = None, weight: np.ndarray | None = None,
        epochs: int = EPOCHS, seed: int = 0) -> ConvModel:
    """Train on whole texts and labels; rows may weigh differently (a sample that is richer in one label). Without rows
    the score is 0.5, with one label only the smoothed prior."""
    rng = np.random.default_rng(seed)
    y = np.asarray(y, dtype=np.float64)
    weight = np.ones(len(y)) if weight is None else np.asarray(weight, dtype=np.float64)
    prior = ((weight * y).sum() + 1) / (weight.sum() + 2)
    model = _begin(rng, prior)
    if not len(y) or y.min() == y.max():
        return model
    model.out = _out(rng)
    ids, words, doc, _ = split_words(pa.array(texts, pa.large_string()), CLASSES)
    rows = buckets_of(words)
    cut = np.searchsorted(doc, np.arange(len(y) + 1))
    aside = np.arange(len(y)) % CALIBRATE == CALIBRATE - 1 if len(y) >= 2 * CALIBRATE else np.zeros(len(y), bool)
    learn = np.flatnonzero(~aside)
    # both labels weigh the same while fitting; the calibration after it brings back their shares
    balance = np.where(y == 1, 0.5 / max(1, y[learn].sum()), 0.5 / max(1, (1 - y[learn]).sum())) * len(learn)
    speed, spot = _speeds(model)
    steps = max(1, len(learn) // BATCH)
    for _ in range(max(epochs, -(-MIN_STEPS // steps))):
        _pass(model, rows, ids, cut, y, balance, learn, rng, speed, spot)
    held = np.flatnonzero(aside) if aside.any() else learn
    margins = _margins(model, rows, ids, cut, held)
    _calibrate(model, margins, y[held], weight[held], [langs[i] for i in held] if langs is not None else None)
    return model


def _speeds(model: ConvModel):
    return [np.zeros_like(model.table[:, :1])] + [np.zeros_like(a) for a in (*model.kernels, *model.biases, model.out)], np.zeros(1)


def _pass(model: ConvModel, rows, ids, cut, y, balance, learn, rng, speed, spot):
    """One step for each batch of the texts ``learn``, in random order."""
    for at in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
        word_of, inverse = np.unique(np.concatenate([ids[cut[d]:cut[d + 1]] for d in at]), return_inverse=True)
        counts = cut[at + 1] - cut[at]
        seq, starts = padded(inverse, np.repeat(np.arange(len(at)), counts), len(at))
        _step(model, rows[word_of], seq, starts, y[at], balance[at], speed, spot)


def _margins(model: ConvModel, rows, ids, cut, which) -> np.ndarray:
    out = []
    for at in np.array_split(which, max(1, len(which) // 256)):
        word_of, inverse = np.unique(np.concatenate([ids[cut[d]:cut[d + 1]] for d in at]), return_inverse=True)
        seq, starts = padded(inverse, np.repeat(np.arange(len(at)), cut[at + 1] - cut[at]), len(at))
        out.append(model.margin(rows[word_of], seq, starts))
    return np.concatenate(out).astype(np.float64)


def _step(model: ConvModel, rows, seq, starts, y, weight, speed, spot):
    """One Adagrad step on a batch. Only the place with each filter's largest answer gets a gradient."""
    vectors = model.word_vectors(rows)
    lengths = np.diff(np.append(starts, len(seq)))
    owner = np.repeat(np.arange(len(starts)), lengths)
    tops, places = [], []
    for kernel, bias in zip(model.kernels, model.biases):
        a = model.answers(vectors, seq, starts, kernel, bias)
        top = np.maximum.reduceat(a, starts, axis=0)
        hit = a == top[owner]
        # the first place of the largest answer
        place = np.minimum.reduceat(np.where(hit, np.arange(len(seq))[:, None], len(seq)), starts, axis=0)
        tops.append(top)
        places.append(place)
    pooled = np.maximum(np.concatenate(tops, axis=1), 0)
    p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.intercept, -30, 30)))
    g = ((p - y) * weight / len(y)).astype(np.float32)
    back = (g[:, None] * model.out) * (pooled > 0)
    d_out = pooled.T @ g
    d_vec = np.zeros_like(vectors)
    grads = []
    for k, (kernel, place) in enumerate(zip(model.kernels, places)):
        part = back[:, k * FILTERS:(k + 1) * FILTERS]
        d_kernel = np.zeros_like(kernel)
        for j in range(kernel.shape[0]):
            i = np.minimum(place + j, len(seq) - 1)
            word = np.where(place + j < len(seq), seq[i], 0)
            d_kernel[j] = np.einsum("df,dfe->ef", part, vectors[word])
            np.add.at(d_vec, word.ravel(), (part[:, :, None] * kernel[j].T[None]).reshape(-1, kernel.shape[1]))
        grads.append((d_kernel, part.sum(0)))
    d_vec[0] = 0
    for a, d, s in zip((*model.kernels, *model.biases, model.out),
                       (*[x for x, _ in grads], *[x for _, x in grads], d_out), speed[1:]):
        s += d * d
        a -= STEP * d / (np.sqrt(s) + 1e-6)
    spot += float(g.sum()) ** 2
    model.intercept -= STEP * float(g.sum()) / (np.sqrt(spot[0]) + 1e-6)
    moved = np.flatnonzero(np.abs(d_vec[1:]).sum(1))
    d_rows = np.repeat(d_vec[1:][moved] / rows.shape[1], rows.shape[1], axis=0)
    touched, inverse = np.unique(rows[moved].ravel(), return_inverse=True)
    d_table = np.zeros((len(touched), model.table.shape[1]), dtype=np.float32)
    np.add.at(d_table, inverse, d_rows)
    speed[0][touched] += (d_table * d_table).mean(1, keepdims=True)
    model.table[touched] -= STEP * d_table / (np.sqrt(speed[0][touched]) + 1e-6)


def _calibrate(model: ConvModel, margin, y, weight, langs):
    """Scale and shift of the sum by a two-parameter logistic fit on held rows, and the threshold of each language with
    the best F1 there."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y == 1, *_targets(n1, n0))

    def sums(a, b):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        return [x.sum() for x in (g * margin, g, h * margin * margin, h * margin, h)]

    model.scale, model.shift = _scale_and_shift(sums)
    score = 1 / (1 + np.exp(-np.clip(model.scale * margin + model.shift, -30, 30)))
    model.threshold = best_threshold(score, y, weight)
    for lang in sorted({x for x in langs or [] if x is not None}):
        at = np.array([x == lang for x in langs])
        if y[at].sum() >= MIN_POSITIVES:
            model.thresholds[lang] = best_threshold(score[at], y[at], weight[at])


def _targets(n1, n0) -> tuple[float, float]:
    """Smoothed targets keep the curve finite where the labels are separable."""
    return (n1 + 1) / (n1 + 2), 1 / (n0 + 2)


def _scale_and_shift(sums) -> tuple[float, float]:
    """Newton's steps by ``sums(a, b)``: of the slopes and curvatures over all calibration rows."""
    a, b = 1.0, 0.0
    for _ in range(50):
        gm, g, hmm, hm, h = sums(a, b)
        grad = np.array([gm + 1e-3 * (a - 1), g])
        hess = np.array([[hmm + 1e-3, hm], [hm, h + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(b)


def best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Middle of the gap between scores at which F1 is largest (the lowest of equals); the default without positives."""
    if not (y == 1).any():
        return ACCEPT
    order = np.argsort(-score, kind="stable")
    s, hit, w = score[order], y[order], weight[order]
    tp, taken = np.cumsum(w * hit), np.cumsum(w)
    f1 = 2 * tp / (taken + (w * hit).sum())
    f1[:-1][s[1:] == s[:-1]] = -1  # equal scores go together
    k = len(f1) - 1 - int(np.argmax(f1[::-1]))
    return float((s[k] + s[k + 1]) / 2) if k + 1 < len(s) else float(s[k])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  label_col: str = "toxic", max_rows: int = MAX_ROWS_OF_A_LABEL) -> pd.DataFrame:
    """``k, y, w, t, lang`` of the labelled rows to fit on, none of them in the held-out fold: at most ``max_rows`` of
    either label, ``w`` how many rows one stands for. Repeated labels of an id are averaged; an id counts once."""
    named = (
        labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k is not null and y is not null")
        .where(~held_out("k")).groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    share = {r["y"]: r["n"] for r in named.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = [named.where(F.col("y") == v).orderBy(F.md5(F.col("k").cast("string")), "k").limit(max_rows) for v in (0, 1)]
    chosen = part[0].unionByName(part[1])
    # two times max_rows keys, and texts of a bounded length: proven bounds
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaces = F.length(text) - F.length(F.translate(text, " \n\t", ""))
    rows = (docs.where(spaces < MAX_TRAIN_WORDS).select(F.col(id_col).alias("k"), text.alias("t"), F.col(lang_col).alias("lang"))
            .where(F.length("t") < 20 * MAX_TRAIN_WORDS).join(F.broadcast(chosen), "k")
            .groupBy("k").agg(F.min("y").alias("y"), F.min("t").alias("t"), F.min("lang").alias("lang"))
            .orderBy(F.md5(F.col("k").cast("string")), "k").toPandas())
    got = rows["y"].value_counts().to_dict()
    rows["w"] = [share[v] / got[v] for v in rows["y"]]
    return rows


# --- the fit on all labelled rows ---------------------------------------------------

BLOCK_SCHEMA = "shard int, y binary, aside binary, lang array<string>, cut binary, ids binary, words binary"


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             label_col: str = "toxic") -> DataFrame:
    """``k, y, t, size, lang, aside`` of every labelled row outside the held-out fold (ids of several rows come repeated):
    the ids ``aside`` calibrate. Repeated labels of an id are averaged."""
    # written once; as long as they are few, no text moves to meet them
    named = write_table(
        labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("y")).where("k is not null and y is not null")
        .where(~held_out("k")).groupBy("k").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    aside = F.pmod(F.xxhash64(F.lit("aside"), F.col("k").cast("string")), F.lit(CALIBRATE)) == CALIBRATE - 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(F.col(id_col).alias("k"), text.alias("t"), F.length(text).cast("long").alias("size"), F.col(lang_col).alias("lang"))
    small = F.broadcast(named) if named.count() <= BROADCAST_LABELS else named
    return whole.join(small, "k").select("k", "y", "t", "size", "lang", aside.alias("aside"))


def _pack(group: pa.Table) -> pa.Table:
    """The rows of a shard as one row of arrays, in the order of their ids' hashes."""
    group = group.sort_by([("h", "ascending"), ("k", "ascending")])
    texts = pa.concat_arrays([c.cast(pa.large_string()) for c in group["t"].chunks])
    ids, words, doc, _ = split_words(texts, CLASSES)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    parts = [group["y"].to_numpy().astype(np.int8), group["aside"].to_numpy().astype(bool), None, cut.astype(np.int64),
             ids.astype(np.int32), buckets_of(words).astype(np.int32)]
    cells = [pa.array([x.tobytes()], pa.binary()) if x is not None else pa.array([group["lang"].to_pylist()], pa.list_(pa.string()))
             for x in parts]
    return pa.table([pa.array([group["shard"][0].as_py()], pa.int32()), *cells],
                    names=["shard", "y", "aside", "lang", "cut", "ids", "words"])


def _blocks(batches):
    """The shards of a task, one at a time: ``(shard, y, aside, lang, cut, ids, rows)``."""
    for batch in batches:
        for r in batch.to_pylist():
            as_array = lambda c, t: np.frombuffer(r[c], dtype=t)  # noqa: E731, B023
            yield (r["shard"], as_array("y", np.int8).astype(np.float64), as_array("aside", bool), r["lang"], as_array("cut", np.int64),
                   as_array("ids", np.int32), as_array("words", np.int32).reshape(-1, 1 + len(PREFIXES)))


def shards(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The rows of ``labelled`` in blocks, and the number of shards; an id counts once."""
    n, chars = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    k = max(1, -(-n // shard_rows), -(-(chars or 0) // SHARD_CHARS))
    h = F.xxhash64(F.col("k").cast("string"))
    dealt = rows.select(F.pmod(h, F.lit(k)).cast("int").alias("shard"), "k", "y", "t", "lang", "aside").repartition(k, "shard")
    once = dealt.groupBy("shard", "k").agg(F.min("y").alias("y"), F.min("t").alias("t"), F.min("lang").alias("lang"),
                                           F.first("aside").alias("aside"))
    once = once.select("shard", h.alias("h"), F.col("k").cast("string").alias("k"), "y", "t", "lang", "aside")
    return write_table(once.groupBy("shard").applyInArrow(_pack, BLOCK_SCHEMA)), k


def _dense(model: ConvModel, speed, spot) -> np.ndarray:
    """All parameters beside the table, and their speeds."""
    parts = [*model.kernels, *model.biases, model.out, np.array([model.intercept]), *speed[1:], spot]
    return np.concatenate([np.asarray(p, np.float64).ravel() for p in parts])


def _put_dense(model: ConvModel, speed, spot, flat: np.ndarray):
    at = 0
    for a in (*model.kernels, *model.biases, model.out, None, *speed[1:], spot):
        size = 1 if a is None else a.size
        part, at = flat[at:at + size], at + size
        if a is None:
            model.intercept = float(part[0])
        else:
            a[...] = part.reshape(a.shape)


def _copy(model: ConvModel) -> ConvModel:
    return ConvModel(model.table.copy(), [a.copy() for a in model.kernels], [a.copy() for a in model.biases], model.out.copy(),
                     model.intercept)


def _learner(shared, weights: tuple[float, float], every: bool, passes: int | None, round_no: int, seed: int):
    """Takes each shard of a task through its passes (enough for ``MIN_STEPS`` if there is no number) and adds up what they
    learned: for each row of the table the changes, the speeds and how many shards met it."""

    def learn(batches):
        first, n = None, 0
        for shard, y, aside, _, cut, ids, rows in _blocks(batches):
            begin, speed0, spot0 = shared.value
            which = np.arange(len(y)) if every else np.flatnonzero(~aside)
            if first is None:
                first, table, dense = shard, np.zeros((BUCKETS, DIM + 2)), 0.0
            if not len(which):
                continue
            model, speed, spot = _copy(begin), [a.copy() for a in speed0], spot0.copy()
            balance = np.where(y == 1, weights[1], weights[0])
            rng = np.random.default_rng([seed, round_no, shard])
            todo = passes or max(EPOCHS, -(-MIN_STEPS // max(1, len(which) // BATCH)))
            for _ in range(todo):
                _pass(model, rows, ids, cut, y, balance, which, rng, speed, spot)
            met = (speed[0] != speed0[0])[:, 0]
            table[met, :DIM] += model.table[met].astype(np.float64) - begin.table[met]
            table[met, DIM] += speed[0][met, 0]
            table[met, DIM + 1] += 1
            dense = dense + _dense(model, speed, spot)
            n += 1
        if n:
            bodies = [*np.split(table, PIECES), dense]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(bodies)), pa.int32()), pa.array([first] * len(bodies), pa.int32()),
                 pa.array([n] * len(bodies), pa.int64()), pa.array([b.astype(np.float32).tobytes() for b in bodies], pa.binary())],
                names=["piece", "first", "n", "body"])

    return learn


def _add_up(group: pa.Table) -> pa.Table:
    group = group.sort_by("first")  # one order of adding, whatever task ended first
    total = 0.0
    for batch in group.select(["body"]).to_batches():
        for b in batch.column(0):
            total = total + np.frombuffer(b.as_buffer(), dtype=np.float32).astype(np.float64)
    return pa.table([pa.array([group["piece"][0].as_py()], pa.int32()), pa.array([sum(group["n"].to_pylist())], pa.int64()),
                     pa.array([total.tobytes()], pa.binary())], names=["piece", "n", "body"])


def _round(blocks: DataFrame, state, weights, every: bool, passes: int | None, round_no: int, seed: int):
    """One pass of all shards from ``state``, which becomes their average. The driver gets one table of sums."""
    model, speed, spot = state
    shared = blocks.sparkSession.sparkContext.broadcast(state)
    sums = blocks.mapInArrow(_learner(shared, weights, every, passes, round_no, seed), "piece int, first int, n long, body binary")
    for r in sums.groupBy("piece").applyInArrow(_add_up, "piece int, n long, body binary").collect():
        body = np.frombuffer(r["body"], dtype=np.float64)
        if r["piece"] == PIECES:
            _put_dense(model, speed, spot, body / r["n"])
            continue
        body = body.reshape(-1, DIM + 2)
        at = r["piece"] * len(body) + np.flatnonzero(body[:, DIM + 1])
        got = body[body[:, DIM + 1] > 0]
        model.table[at] += (got[:, :DIM] / got[:, DIM + 1:]).astype(np.float32)
        speed[0][at, 0] = got[:, DIM] / got[:, DIM + 1]
    shared.unpersist()


def fit_all(rows: DataFrame, shard_rows: int = SHARD_ROWS, rounds: int = ROUNDS, seed: int = 0) -> ConvModel:
    """Train on every row of ``labelled``; without rows the score is 0.5, with one label only the smoothed prior."""
    blocks, k = shards(rows, shard_rows)

    def counted(batches):
        for _, y, aside, *_ in _blocks(batches):
            yield pa.RecordBatch.from_pydict({"one": pa.array(y == 1), "aside": pa.array(aside)})

    found = blocks.mapInArrow(counted, "one boolean, aside boolean").groupBy("one", "aside").count().collect()
    count = {(r["one"], r["aside"]): r["count"] for r in found}
    of = lambda one, *sides: sum(count.get((one, s), 0) for s in sides)
    n1, n0 = of(True, True, False), of(False, True, False)
    rng = np.random.default_rng(seed)
    prior = (n1 + 1) / (n1 + n0 + 2)
    model = _begin(rng, prior)
    if not n1 or not n0:
        drop_table(blocks)
        return model
    model.out = _out(rng)
    # rows are put aside if both sides then have both labels
    every = not all(of(one, side) for one in (True, False) for side in (True, False))
    sides = (True, False) if every else (False,)
    f1, f0 = of(True, *sides), of(False, *sides)
    # both labels weigh the same while fitting; the calibration after it brings back their shares
    weights = (0.5 / f0 * (f1 + f0), 0.5 / f1 * (f1 + f0))
    state = (model, *_speeds(model))
    for i in range(rounds if k > 1 else 1):
        _round(blocks, state, weights, every, 1 if k > 1 else None, i, seed)
    _calibrate_all(model, blocks, every)
    drop_table(blocks)
    return model


def _calibrate_all(model: ConvModel, blocks: DataFrame, every: bool):
    """``_calibrate`` on all rows put aside. Thresholds are found among log odds of ``LOGIT_DECIMALS`` decimals, whose
    counts are a bounded table for each language."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def margins(batches):
        for _, y, aside, lang, cut, ids, rows in _blocks(batches):
            held = np.arange(len(y)) if every else np.flatnonzero(aside)
            if len(held):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(y[held]), pa.array([lang[i] for i in held], pa.string()),
                     pa.array(_margins(shared.value, rows, ids, cut, held))], names=["y", "lang", "m"])

    held = write_table(blocks.mapInArrow(margins, "y double, lang string, m double"))
    n1, n0 = held.agg(F.sum("y"), F.sum(1 - F.col("y"))).first()
    target = F.when(F.col("y") == 1, F.lit(_targets(n1, n0)[0])).otherwise(F.lit(_targets(n1, n0)[1]))

    def sums(a, b):
        z = F.greatest(F.least(F.col("m") * float(a) + float(b), F.lit(30.0)), F.lit(-30.0))
        p = held.select("m", target.alias("target"), (1 / (1 + F.exp(-z))).alias("p"))
        g, h, m = F.col("p") - F.col("target"), F.greatest(F.col("p") * (1 - F.col("p")), F.lit(1e-9)), F.col("m")
        return p.agg(*[F.sum(x).alias(f"s{i}") for i, x in enumerate((g * m, g, h * m * m, h * m, h))]).first()

    model.scale, model.shift = _scale_and_shift(sums)
    z = F.round(F.greatest(F.least(F.col("m") * model.scale + model.shift, F.lit(30.0)), F.lit(-30.0)), LOGIT_DECIMALS)
    counts = held.groupBy("lang", z.alias("z")).agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))
    counts = write_table(counts)

    def best(table: pa.Table) -> pa.Table:
        at, n1, n0 = (table[c].to_numpy() for c in ("z", "n1", "n0"))
        score, y, w = np.tile(1 / (1 + np.exp(-at)), 2), np.repeat([1.0, 0.0], len(at)), np.concatenate([n1, n0])
        v = best_threshold(score[w > 0], y[w > 0], w[w > 0])
        return pa.table([table["lang"].slice(0, 1), pa.array([v])], names=["lang", "v"])

    of_all = counts.groupBy("z").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).withColumn("lang", F.lit(None).cast("string"))
    often = counts.where("lang is not null").groupBy("lang").agg(F.sum("n1").alias("n")).where(F.col("n") >= MIN_POSITIVES).select("lang")
    by_lang = counts.join(F.broadcast(often), "lang")
    for r in of_all.unionByName(by_lang).groupBy("lang").applyInArrow(best, "lang string, v double").collect():  # a row a language
        if r["lang"] is None:
            model.threshold = r["v"]
        else:
            model.thresholds[r["lang"]] = r["v"]
    drop_table(held)
    drop_table(counts)
    shared.unpersist()


def scored(docs: DataFrame, model: ConvModel, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           accept: float = ACCEPT) -> DataFrame:
    """``id, held_out, score, predicted, threshold, flagged`` of each row: ``predicted`` by ``accept``, ``flagged`` by the
    threshold of the row's language (of all languages for null and unknown ones). Null and empty texts score like a text
    without words. A null id counts as the empty text when folds are dealt. Rows are scored one by one; repeated rows come
    out repeated, an empty table gives an empty table."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score_texts(pa.array(texts, pa.large_string())))

    threshold = F.lit(model.threshold)
    for lang, v in model.thresholds.items():
        threshold = F.when(F.col(lang_col) == lang, F.lit(v)).otherwise(threshold)
    out = text_batches(docs).select(F.col(id_col), held_out(id_col).alias("held_out"),
                                    score(F.coalesce(F.col(text_col), F.lit(""))).alias("score"), threshold.alias("threshold"))
    return out.select(id_col, "held_out", "score", (F.col("score") >= accept).cast("int").alias("predicted"), "threshold",
                      (F.col("score") >= F.col("threshold")).alias("flagged"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: whether its label was held out, its score, the decision at 0.3, and that of its language."""
    docs = read(spark, sf_dir, "documents")
    return scored(docs, fit_all(labelled(text_batches(docs), read(spark, sf_dir, "labels"))))


QUERIES = {"op12_toxicity": op12_toxicity}
ORACLES: dict[str, str] = {}
