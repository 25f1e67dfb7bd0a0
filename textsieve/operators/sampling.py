"""Ranks, splits, folds and upsampling (H1, M1-M9).

Random draws are md5 keys of ``row_id:copy_no:seed`` (``G11``), so Spark and
SQL engines draw the same rows. No step here ranks with an unpartitioned
window over the data: global order comes from a range shuffle, and each
range partition learns its offset from a table with one row per partition.

Assignment of rows to the test set or to a fold never joins the text back:
the few cut-off keys (one per class, or per class and fold) are computed on
the narrow key table and broadcast, and each row compares its own key.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of the per-class draw table below which it is broadcast.
BROADCAST_ROWS = 2_000_000


def _num_parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def md5_key(*parts, seed: int = 42) -> Column:
    """Hex md5 of ``part1:part2:...:seed`` (a uniform, reproducible draw)."""
    cols = []
    for p in parts:
        cols += [F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit(":")]
    return F.md5(F.concat(*cols, F.lit(str(seed))))


def md5_int(*parts, seed: int = 42) -> Column:
    """First 8 hex digits of ``md5_key`` as a non-negative integer."""
    return F.conv(F.substring(md5_key(*parts, seed=seed), 1, 8), 16, 10).cast("bigint")


def global_row_number(df: DataFrame, order_cols: list, out_col: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """H1: ``row_number()`` over a total order, computed without a single-task
    window. ``order_cols`` must be a total order (add a unique tie-breaker).

    Range-partition and sort by the order; ``monotonically_increasing_id``
    then encodes (partition, position). Per-partition counts (one row per
    partition) give each partition its offset. ``df`` should be narrow (keys
    only): it is written once to the checkpoint folder.
    """
    from textsieve.session import cut_lineage

    n = _num_parts(df, num_partitions)
    ordered = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    # The range bounds are sampled from the input; were the plan evaluated
    # twice (counts and rows), two samples could give two different
    # partitionings. Stamp the ids once and write them to the checkpoint
    # folder, so both branches read the same rows.
    with_id = cut_lineage(ordered.withColumn("_mid", F.monotonically_increasing_id()))
    with_id = with_id.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = with_id.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # at most num_partitions rows
    offsets = counts.select(
        "_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off")
    )
    return (
        with_id.join(F.broadcast(offsets), "_part")
        .withColumn(out_col, (F.col("_off") + F.col("_pos") + 1).cast("bigint"))
        .drop("_mid", "_part", "_pos", "_off")
    )


def rank_within(df: DataFrame, group_col: str, order_cols: list, out_col: str = "rn",
                num_partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` for a
    low-cardinality group (e.g. a class label) whose groups may each hold a
    large share of the rows: a global row number minus the group's start."""
    ranked = global_row_number(df, [group_col, *order_cols], "_g", num_partitions)
    starts = ranked.groupBy(group_col).agg(F.min("_g").alias("_start"))
    return ranked.join(F.broadcast(starts), group_col).withColumn(
        out_col, (F.col("_g") - F.col("_start") + 1).cast("bigint")
    ).drop("_g", "_start")


def running_totals(df: DataFrame, order_cols: list, sum_cols: list, prefix: str = "cum_",
                   num_partitions: int | None = None) -> DataFrame:
    """H1 for prefix sums: cumulative sums of ``sum_cols`` along a total order.

    Range-partition; per-partition totals (one row per partition) give each
    partition its starting offsets; inside a partition a window adds up the
    rest. Also adds ``rn``, the 1-based position in the order.
    """
    from textsieve.session import cut_lineage

    n = _num_parts(df, num_partitions)
    # written once, so the totals and the rows see the same range partitions
    parted = cut_lineage(df.repartitionByRange(n, *order_cols).withColumn("_part", F.spark_partition_id()))
    totals = parted.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sum_cols]
    )
    w_all = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(w_all), F.lit(0)).alias("_off_n"),
        *[F.coalesce(F.sum(f"_t_{c}").over(w_all), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
    )
    w_in = Window.partitionBy("_part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    out = parted.join(F.broadcast(offsets), "_part").select(
        *df.columns,
        (F.col("_off_n") + F.row_number().over(Window.partitionBy("_part").orderBy(*order_cols))).cast("bigint").alias("rn"),
        *[(F.col(f"_off_{c}") + F.sum(c).over(w_in)).alias(f"{prefix}{c}") for c in sum_cols],
    )
    return out


# --- md5-keyed ranks: deterministic buckets, no sampling ----------------------

BUCKET_DIGITS = 4  # 16^4 buckets: each holds ~1/65536 of a class


def _bucket_offsets(k: DataFrame, group: str, digits: int) -> DataFrame:
    """``(group, _b, _n, _start)``: rows per (class, key bucket) and how many
    rows of the class come before the bucket. At most classes x 16^digits rows;
    the window runs over that small table, not over the data."""
    counts = k.groupBy(group, F.substring("_k", 1, digits).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_start", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def md5_rank(k: DataFrame, group: str, id_col: str, out_col: str = "rn", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY group ORDER BY _k, id)`` for an
    md5 hex key ``_k``: the leading hex digits are an order-preserving bucket
    (uniform, so no bucket is hot even when one class holds most rows); a row's
    rank is its bucket's offset plus its rank inside the bucket."""
    offs = _bucket_offsets(k, group, digits)
    kb = k.withColumn("_b", F.substring("_k", 1, digits))
    # a plain equi-join on (group, _b): the window below needs the keys
    # clustered by (group, _b) anyway, so the join's shuffle is shared
    w = Window.partitionBy(group, "_b").orderBy("_k", id_col)
    return kb.join(offs.drop("_n"), [group, "_b"]).withColumn(
        out_col, (F.col("_start") + F.row_number().over(w)).cast("bigint")).drop("_b", "_start")


# --- class counts (M1) ------------------------------------------------------

def class_counts(df: DataFrame, label_col: str = "label") -> dict:
    """``{label: n}`` (one tiny aggregate collected)."""
    return {r[0]: r[1] for r in df.groupBy(label_col).count().collect()}


def majority_minority(counts: dict) -> tuple[int, int]:
    """M1: class 0 is the majority only if strictly larger; on a tie class 1
    is called the majority and class 0 gets resampled."""
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    return (0, 1) if n0 > n1 else (1, 0)


def class_majority(df: DataFrame, label_col: str = "label") -> DataFrame:
    """M1 as a table: ``(label, n, role)`` with role majority/minority."""
    c = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    both = F.broadcast(df.sparkSession.createDataFrame([(0,), (1,)], f"{label_col} int"))
    full = both.join(c, label_col, "left").fillna(0, ["n"])
    n0 = F.max(F.when(F.col(label_col) == 0, F.col("n"))).over(Window.partitionBy())
    n1 = F.max(F.when(F.col(label_col) == 1, F.col("n"))).over(Window.partitionBy())
    maj = F.when(n0 > n1, F.lit(0)).otherwise(F.lit(1))
    return full.select(
        F.col(label_col).cast("int").alias(label_col),
        F.col("n").cast("bigint").alias("n"),
        F.when(F.col(label_col) == maj, F.lit("majority")).otherwise(F.lit("minority")).alias("role"),
    )


# --- upsampling (M2-M6) -----------------------------------------------------

def upsample_draws(df: DataFrame, minority_label: int, n_draws: int, label_col: str = "label",
                   id_col: str = "row_id", seed: int = 42, n_minority: int | None = None) -> DataFrame:
    """M2 + M4: ``n_draws`` rows drawn with replacement from the minority
    class. Returns ``(row_id, copy_no)``, one row per draw.

    The minority rows get a dense index 0..n_min-1 in md5-key order; draw
    ``i`` picks index ``md5_int(i) % n_min``.
    """
    minority = df.where(F.col(label_col) == minority_label).select(id_col).withColumn("_k", md5_key(id_col, seed=seed))
    n_min = minority.count() if n_minority is None else n_minority
    if n_min == 0 or n_draws <= 0:
        return df.sparkSession.createDataFrame([], f"{id_col} bigint, copy_no bigint")
    indexed = md5_rank(minority.withColumn("_g", F.lit(0)), "_g", id_col, "_idx").select(
        id_col, (F.col("_idx") - 1).alias("_pick"))
    draws = df.sparkSession.range(n_draws).select(
        F.col("id").alias("copy_no"), (md5_int(F.col("id"), seed=seed) % F.lit(n_min)).alias("_pick")
    )
    side = F.broadcast(indexed) if n_min <= BROADCAST_ROWS else indexed
    return draws.join(side, "_pick").select(F.col(id_col).cast("bigint"), F.col("copy_no").cast("bigint"))


def balance_classes(df: DataFrame, label_col: str = "label", id_col: str = "row_id", seed: int = 42,
                    enabled: bool = True, counts: dict | None = None) -> DataFrame:
    """M5: ``(row_id, label, copy_no)``: majority rows once (copy_no -1), then
    as many minority draws as there are majority rows. Off switch returns
    every row once."""
    base = df.select(F.col(id_col).cast("bigint"), F.col(label_col).cast("int"))
    if not enabled:
        return base.withColumn("copy_no", F.lit(-1).cast("bigint"))
    counts = class_counts(base, label_col) if counts is None else counts
    maj, mino = majority_minority(counts)
    n_maj = counts.get(maj, 0)
    majority = base.where(F.col(label_col) == maj).withColumn("copy_no", F.lit(-1).cast("bigint"))
    draws = upsample_draws(base, mino, n_maj, label_col, id_col, seed, counts.get(mino, 0)).withColumn(
        label_col, F.lit(mino).cast("int"))
    return majority.unionByName(draws.select(id_col, label_col, "copy_no"))


def legacy_upsample(df: DataFrame, label_col: str = "label", id_col: str = "row_id", seed: int = 42) -> DataFrame:
    """M6: class 1 is always the minority; it is drawn up to the size of class 0."""
    base = df.select(F.col(id_col).cast("bigint"), F.col(label_col).cast("int"))
    n0 = base.where(F.col(label_col) == 0).count()
    zeros = base.where(F.col(label_col) == 0).withColumn("copy_no", F.lit(-1).cast("bigint"))
    draws = upsample_draws(base, 1, n0, label_col, id_col, seed).withColumn(label_col, F.lit(1).cast("int"))
    return zeros.unionByName(draws.select(id_col, label_col, "copy_no"))


def draw_weights(balanced: DataFrame, id_col: str = "row_id", label_col: str = "label") -> DataFrame:
    """Copies as weights: ``(row_id, label, weight)``. Training sums use the
    weight instead of materialising copies of the long feature table."""
    return balanced.groupBy(id_col, label_col).agg(F.count(F.lit(1)).cast("double").alias("weight"))


# --- splits and folds (M7-M9) -----------------------------------------------

def _cut_keys(keys: DataFrame, label_col: str | None, id_col: str, targets_fn,
              digits: int = BUCKET_DIGITS) -> DataFrame:
    """Keys at given ranks. ``targets_fn(counts)`` maps ``{class: size}`` to
    ``{class: [ranks]}``. Returns ``(label, cut_rank, cut_key)`` (a few rows
    per class, as a literal table) and the class counts.

    Bucket counts locate the bucket that holds each wanted rank; only the
    rows of those few buckets are ranked."""
    group = label_col if label_col else "_all"
    k = keys if label_col else keys.withColumn("_all", F.lit(0))
    k = k.select(group, id_col, "_k")
    counts = {r[0]: r[1] for r in k.groupBy(group).count().collect()}
    wanted = targets_fn(counts)
    rows = [(g, int(t)) for g, ts in wanted.items() for t in ts if 1 <= t <= counts.get(g, 0)]
    if not rows:
        return None, counts
    spark = keys.sparkSession
    gtype = dict(k.dtypes)[group]
    targets = F.broadcast(spark.createDataFrame(rows, f"{group} {gtype}, cut_rank bigint"))
    offs = _bucket_offsets(k, group, digits)
    hit = offs.join(targets, group).where(
        (F.col("cut_rank") > F.col("_start")) & (F.col("cut_rank") <= F.col("_start") + F.col("_n"))
    ).select(group, "_b", "cut_rank", (F.col("cut_rank") - F.col("_start")).alias("_local"))
    hit = spark.createDataFrame(hit.collect(), hit.schema)  # one row per target
    inb = k.withColumn("_b", F.substring("_k", 1, digits)).join(F.broadcast(hit.select(group, "_b").distinct()),
                                                              [group, "_b"])
    w = Window.partitionBy(group, "_b").orderBy("_k", id_col)
    ranked = inb.withColumn("_local", F.row_number().over(w))
    cuts = ranked.join(F.broadcast(hit), [group, "_b", "_local"]).select(
        group, "cut_rank", F.struct(F.col("_k"), F.col(id_col)).alias("cut_key"))
    return spark.createDataFrame(cuts.collect(), cuts.schema), counts


def test_quotas(counts: dict, test_size: float) -> dict:
    """Test rows per class, as a stratified shuffle split allocates them: the
    test set has ``ceil(test_size * n)`` rows; the training rows are shared
    out in proportion to class size, floors first, then one more row to the
    classes with the largest remainders (ties: lower class first); each class
    keeps the rest for testing."""
    n = sum(counts.values())
    if n == 0:
        return {}
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    labels = sorted(counts, key=lambda g: (g is None, g))
    train = {g: n_train * counts[g] // n for g in labels}
    need = n_train - sum(train.values())
    by_rem = sorted(labels, key=lambda g: (-(n_train * counts[g] % n), labels.index(g)))
    for g in by_rem[:need]:
        train[g] += 1
    return {g: counts[g] - train[g] for g in labels}


def stratified_split(df: DataFrame, test_size: float = 0.3, label_col: str | None = "label",
                     id_col: str = "row_id", seed: int = 42, copy_col: str | None = None,
                     stats: dict | None = None) -> DataFrame:
    """M7 (M8 with ``label_col=None``): adds boolean ``is_test``. Within each
    class the rows are ordered by md5 key; the first ``test_quotas`` rows of
    each class are the test rows. Only the narrow key table is ranked; each
    row then compares its own key with its class's broadcast cut-off."""
    parts = [id_col] + ([copy_col] if copy_col else [])
    keyed = df.withColumn("_k", md5_key(*parts, seed=seed))
    quotas = {}

    def targets(counts):
        quotas.update(test_quotas(counts, test_size))
        return {g: [q] for g, q in quotas.items()}

    cuts, counts = _cut_keys(keyed, label_col, id_col, targets)
    if stats is not None:  # class sizes and test rows, for callers that need them
        stats["counts"], stats["test"] = dict(counts), dict(quotas)
    if cuts is None:
        return keyed.withColumn("is_test", F.lit(False)).drop("_k")
    group = label_col if label_col else "_all"
    src = keyed if label_col else keyed.withColumn("_all", F.lit(0))
    out = src.join(F.broadcast(cuts.select(group, "cut_key")), group, "left")
    return out.withColumn(
        "is_test", F.coalesce(F.struct(F.col("_k"), F.col(id_col)) <= F.col("cut_key"), F.lit(False))
    ).drop("_k", "cut_key", *([] if label_col else ["_all"]))


def kfold_assign(df: DataFrame, k: int = 5, label_col: str | None = "label", id_col: str = "row_id",
                 seed: int = 42) -> DataFrame:
    """M9: adds ``fold`` = floor((rank-1) * k / n_c) within each class by md5
    key: contiguous chunks whose sizes differ by at most one per class."""
    keyed = df.withColumn("_k", md5_key(id_col, seed=seed))

    def starts(n):  # first rank of folds 1..k-1
        return sorted({math.ceil(f * n / k) + 1 for f in range(1, k)} - {n + 1})

    cuts, _ = _cut_keys(keyed, label_col, id_col, lambda counts: {g: starts(n) for g, n in counts.items()})
    group = label_col if label_col else "_all"
    src = keyed if label_col else keyed.withColumn("_all", F.lit(0))
    if cuts is None:
        return src.withColumn("fold", F.lit(0)).drop("_k", *([] if label_col else ["_all"]))
    # per class, the fold of each starting key (a chunk may be empty for tiny
    # classes, so fold numbers come from the rank, not from the position)
    lists = cuts.groupBy(group).agg(
        F.collect_list(F.struct(F.col("cut_key"), F.col("cut_rank"))).alias("_cuts")
    )
    me = F.struct(F.col("_k"), F.col(id_col))
    last_start = F.aggregate(
        F.col("_cuts"), F.lit(1).cast("bigint"),
        lambda acc, c: F.when(c["cut_key"] <= me, F.greatest(acc, c["cut_rank"])).otherwise(acc),
    )
    n_c = F.col("_n")
    counts_df = src.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    out = src.join(F.broadcast(lists), group, "left").join(F.broadcast(counts_df), group)
    fold = F.floor((last_start - 1) * F.lit(k) / n_c).cast("int")
    return out.withColumn("fold", F.coalesce(fold, F.lit(0))).drop(
        "_k", "_cuts", "_n", *([] if label_col else ["_all"])
    )
