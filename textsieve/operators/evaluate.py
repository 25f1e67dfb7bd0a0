"""Binary-classification evaluation.

Input: a scored DataFrame with ``label`` (0/1), ``prediction`` (0/1) and,
for curves, a ``probability`` score. Scalar metrics are one aggregation pass.
Curves first collapse to one row per distinct score (partial+final
aggregation), then take prefix sums with the range-partitioned helper, so no
step runs a global single-task window over the scored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textsieve.operators.sampling import running_totals


def _div(a: Column, b: Column) -> Column:
    """a / b, and 0 when b is 0 (``zero_division=0``)."""
    return F.coalesce(a / F.when(b != 0, b), F.lit(0.0)).cast("double")


def _tally(cond, weight_col: str | None):
    """count_if(cond), or the sum of the weights of the rows meeting it (a
    weight stands for that many copies of the row)."""
    if weight_col is None:
        return F.count_if(cond)
    return F.sum(F.when(cond, F.col(weight_col)).otherwise(F.lit(0.0)))


def _cells(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
           weight_col: str | None = None) -> DataFrame:
    y, p = F.col(label_col), F.col(pred_col)
    return df.agg(
        _tally((y == 1) & (p == 1), weight_col).alias("tp"),
        _tally((y == 0) & (p == 1), weight_col).alias("fp"),
        _tally((y == 0) & (p == 0), weight_col).alias("tn"),
        _tally((y == 1) & (p == 0), weight_col).alias("fn"),
    )


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                     weight_col: str | None = None) -> DataFrame:
    """Four rows ``(label, prediction, n)``; empty cells are kept as 0.
    With ``weight_col``, ``n`` is the (double) sum of weights."""
    out = _cells(df, label_col, pred_col, weight_col).select(
        F.inline(F.array(*[
            F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n"))
            for y, p, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]))
    )
    return out.select(F.col("label").cast("int"), F.col("prediction").cast("int"),
                      F.col("n").cast("bigint" if weight_col is None else "double"))


def binary_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                   weight_col: str | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1 (0 on zero division)."""
    c = _cells(df, label_col, pred_col, weight_col)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec, rec = _div(tp, tp + fp), _div(tp, tp + fn)
    return c.select(
        _div(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                          weight_col: str | None = None) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg``, ``weighted avg`` with
    precision, recall, f1-score, support (with ``weight_col`` the sum of weights)."""
    c = _cells(df, label_col, pred_col, weight_col)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1 = _div(2 * tp, 2 * tp + fp + fn)
    f0 = _div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn).cast("double"), (tn + fp).cast("double")
    n = s0 + s1
    acc = _div(tp + tn, n)
    row = lambda name, p, r, f, s: F.struct(
        F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
        s.cast("bigint" if weight_col is None else "double").alias("support"))
    return c.select(F.inline(F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f0 * s0 + f1 * s1, n), n),
    )))


def score_table(df: DataFrame, label_col: str = "label", score_col: str = "probability",
                weight_col: str | None = None) -> DataFrame:
    """Distinct scores, descending: ``(score, pos, neg, rn, cum_pos, cum_neg)``."""
    per_score = df.groupBy(F.col(score_col).alias("score")).agg(
        _tally(F.col(label_col) == 1, weight_col).alias("pos"), _tally(F.col(label_col) != 1, weight_col).alias("neg")
    )
    return running_totals(per_score, [F.desc("score")], ["pos", "neg"])


def _totals(df: DataFrame, label_col: str, weight_col: str | None = None) -> tuple[float, float]:
    """(positives, negatives): two scalars from one small aggregate."""
    y = F.col(label_col)
    r = df.agg(_tally(y == 1, weight_col).alias("P"), _tally(y != 1, weight_col).alias("N")).first()
    return r["P"] or 0, r["N"] or 0


def roc_points(df: DataFrame, label_col: str = "label", score_col: str = "probability",
               drop_intermediate: bool = True, weight_col: str | None = None) -> DataFrame:
    """``(point, threshold, fpr, tpr)``: the origin (threshold +inf) and
    one point per distinct score by descending score; a point is dropped when
    it is collinear with both neighbours (equal steps before and after).
    The next point's step comes from an equi-join on position ``rn + 1``."""
    P, N = _totals(df, label_col, weight_col)
    st = score_table(df, label_col, score_col, weight_col)
    nxt = st.select((F.col("rn") - 1).alias("rn"), F.col("pos").alias("n_pos"), F.col("neg").alias("n_neg"))
    j = st.join(nxt, "rn", "left")
    if drop_intermediate:
        keep = (F.col("rn") == 1) | F.col("n_pos").isNull() | (F.col("n_pos") != F.col("pos")) | (
            F.col("n_neg") != F.col("neg"))
    else:
        keep = F.lit(True)
    pts = j.where(keep).select(
        F.col("rn").alias("point"),
        F.col("score").cast("double").alias("threshold"),
        _div(F.col("cum_neg"), F.lit(N)).alias("fpr"),
        _div(F.col("cum_pos"), F.lit(P)).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("point"), F.lit(float("inf")).alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "probability",
            weight_col: str | None = None) -> DataFrame:
    """Trapezoid area; tied scores count half. Each distinct score adds
    neg * (2*cum_pos - pos) / (2 P N): no neighbour lookup is needed."""
    st = score_table(df, label_col, score_col, weight_col)
    return st.agg(
        F.sum(F.col("neg") * (2 * F.col("cum_pos") - F.col("pos"))).alias("_a"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
    ).select(_div(F.col("_a"), 2.0 * F.col("_p") * F.col("_n")).alias("roc_auc"))


def pr_points(df: DataFrame, label_col: str = "label", score_col: str = "probability",
              weight_col: str | None = None) -> DataFrame:
    """``(point, threshold, precision, recall)`` per distinct score, plus
    the end point (precision 1, recall 0, no threshold)."""
    P, _ = _totals(df, label_col, weight_col)
    st = score_table(df, label_col, score_col, weight_col)
    recall = F.lit(1.0) if P == 0 else _div(F.col("cum_pos"), F.lit(P))
    pts = st.select(
        F.col("rn").alias("point"),
        F.col("score").cast("double").alias("threshold"),
        _div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        recall.alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("point"), F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, label_col: str = "label", score_col: str = "probability",
                      weight_col: str | None = None) -> DataFrame:
    """Step sum ``sum (R_n - R_{n-1}) P_n`` without interpolation; the
    recall step at a distinct score is pos/P."""
    st = score_table(df, label_col, score_col, weight_col)
    return st.agg(
        F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("_a"),
        F.sum("pos").alias("_p"),
    ).select(_div(F.col("_a"), F.col("_p")).alias("average_precision"))


def fold_stats(scores: DataFrame, score_col: str = "score", keys=()) -> DataFrame:
    """A10: mean, population std, min, max of fold scores (per ``keys``)."""
    g = scores.groupBy(*keys) if keys else scores.groupBy()
    return g.agg(
        F.avg(score_col).alias("mean_score"),
        F.stddev_pop(score_col).alias("std_score"),
        F.min(score_col).alias("min_score"),
        F.max(score_col).alias("max_score"),
        F.count(F.lit(1)).alias("n_folds"),
    )


def evaluate(scored: DataFrame, label_col: str = "label", pred_col: str = "prediction",
             score_col: str | None = "probability", weight_col: str | None = None) -> dict:
    """F16: every metric of one scored DataFrame, as DataFrames (lazy); ``weight_col`` counts a row's copies."""
    w = {"weight_col": weight_col}
    out = {
        "metrics": binary_metrics(scored, label_col, pred_col, **w),
        "confusion_matrix": confusion_matrix(scored, label_col, pred_col, **w),
        "classification_report": classification_report(scored, label_col, pred_col, **w),
    }
    if score_col and score_col in scored.columns:
        out.update({
            "roc_auc": roc_auc(scored, label_col, score_col, **w),
            "average_precision": average_precision(scored, label_col, score_col, **w),
            "roc_curve": roc_points(scored, label_col, score_col, **w),
            "pr_curve": pr_points(scored, label_col, score_col, **w),
        })
    return out
