"""Classification metrics as grouped aggregations.

Count-based metrics (accuracy, F1, confusion matrix, report, log loss) are
one partial-then-final hash aggregation per ``by`` group. Ranking metrics
(ROC AUC with half-credit ties, ROC / PR curves, average precision) first
aggregate to one row per distinct score, then take exact running totals
with ``running_totals`` (quantile buckets, no single-task window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayput.operators.ordered import null_safe, running_totals
from stayput.session import staged

DEC = "decimal(38,0)"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _safe_div(a: Column, b: Column) -> Column:
    """Division that gives 0 when the denominator is 0 (sklearn zero_division=0)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


# ---------------------------------------------------------------------------
# count-based
# ---------------------------------------------------------------------------
def _count(condition: Column, n: str | None) -> Column:
    """Rows that meet a condition, or the sum of their ``n`` where a row stands for several."""
    return F.count_if(condition) if n is None else F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0))


def confusion_counts(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """tn, fp, fn, tp (bigint) per group; rows with a null label or prediction are skipped. ``n`` names a count of equal rows."""
    yc, pc = _c(y), _c(yhat)
    return df.groupBy(*by).agg(
        _count((yc == 0) & (pc == 0), n).alias("tn"),
        _count((yc == 0) & (pc == 1), n).alias("fp"),
        _count((yc == 1) & (pc == 0), n).alias("fn"),
        _count((yc == 1) & (pc == 1), n).alias("tp"),
    )


def evaluation(df: DataFrame, y: str, yhat: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """The four counts, accuracy, F1, error rate, ROC AUC and average precision per group.

    The rows are read once, into a table of counts per (group, label, prediction, score) that all metrics are taken from.
    """
    cells = staged(df.groupBy(*by, _c(y).alias("_y"), _c(yhat).alias("_yhat"), _c(score).cast("double").alias("_score"))
                   .agg(F.count(F.lit(1)).alias("_n")), "cells")
    counts = binary_metrics(cells, "_y", "_yhat", by, n="_n")
    ranks = ranking_metrics(cells, "_y", "_score", by, n="_n")
    if not by:
        return counts.crossJoin(ranks.select("roc_auc", "average_precision"))     # one row each
    both = counts.alias("c").join(ranks.alias("r"), null_safe("c", "r", by), "left")
    return both.select(*[F.col(f"c.{c}").alias(c) for c in counts.columns], "r.roc_auc", "r.average_precision")


def binary_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """V1 accuracy, V2 F1 (positive class), V9 error rate, plus the four counts."""
    cc = confusion_counts(df, y, yhat, by, n)
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return cc.select(
        *by, "tn", "fp", "fn", "tp",
        _safe_div(F.col("tp") + F.col("tn"), n).alias("accuracy"),
        _safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
        _safe_div(F.col("fp") + F.col("fn"), n).alias("error_rate"),
    )


def confusion_matrix(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """V4: rows = actual class (0, 1), columns pred_0 / pred_1, zero-filled."""
    cc = confusion_counts(df, y, yhat, by)
    neg = cc.select(*by, F.lit(0).alias("actual"), F.col("tn").alias("pred_0"), F.col("fp").alias("pred_1"))
    pos = cc.select(*by, F.lit(1).alias("actual"), F.col("fn").alias("pred_0"), F.col("tp").alias("pred_1"))
    return neg.unionByName(pos)


def classification_report(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """V5: precision / recall / f1 / support for classes 0 and 1, accuracy, macro and weighted avg."""
    cc = confusion_counts(df, y, yhat, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * tp, 2 * tp + fp + fn), _safe_div(2 * tn, 2 * tn + fn + fp)
    s0, s1 = tn + fp, tp + fn
    n = s0 + s1
    per = cc.select(*by, p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"),
                    p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"),
                    s0.alias("s0"), s1.alias("s1"), n.alias("n"),
                    _safe_div(tp + tn, n).alias("acc"))

    def row(label, p, r, f, s):
        return per.select(*by, F.lit(label).alias("class"), p.alias("precision"),
                          r.alias("recall"), f.alias("f1_score"), s.cast("bigint").alias("support"))

    def wavg(a, b):
        return _safe_div(F.col(a) * F.col("s0") + F.col(b) * F.col("s1"), F.col("n"))

    rows = [
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), F.col("acc"), F.col("n")),
        row("macro avg", (F.col("p0") + F.col("p1")) / 2, (F.col("r0") + F.col("r1")) / 2,
            (F.col("f0") + F.col("f1")) / 2, F.col("n")),
        row("weighted avg", wavg("p0", "p1"), wavg("r0", "r1"), wavg("f0", "f1"), F.col("n")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _log_loss_term(y: str, p: str, eps: float) -> Column:
    pc = F.least(F.greatest(_c(p), F.lit(eps)), F.lit(1 - eps))
    yc = _c(y).cast("double")
    return -(yc * F.log(pc) + (1 - yc) * F.log(1 - pc))


def log_loss(df: DataFrame, y: str, p: str, by: Sequence[str] = (), eps: float = 1e-15) -> DataFrame:
    """V9: mean binary cross-entropy with p clipped to [eps, 1 - eps]."""
    return df.where(_c(y).isNotNull() & _c(p).isNotNull()).groupBy(*by) \
        .agg(F.avg(_log_loss_term(y, p, eps)).alias("log_loss"))


def training_monitors(df: DataFrame, y: str, p: str, yhat: str, by: Sequence[str] = (),
                      eps: float = 1e-15) -> DataFrame:
    """V9: log loss and error rate together, in one aggregation."""
    valid = _c(y).isNotNull() & _c(p).isNotNull()
    return df.where(valid).groupBy(*by).agg(
        F.avg(_log_loss_term(y, p, eps)).alias("log_loss"),
        F.avg((_c(y) != _c(yhat)).cast("double")).alias("error_rate"))


def confusion_type(y: str | Column, yhat: str | Column) -> Column:
    """TP / TN / FP / FN, anything else (incl. null) -> Unknown."""
    yc, pc = _c(y), _c(yhat)
    return (F.when((yc == 1) & (pc == 1), "TP").when((yc == 0) & (pc == 0), "TN")
            .when((yc == 0) & (pc == 1), "FP").when((yc == 1) & (pc == 0), "FN")
            .otherwise("Unknown"))


def with_confusion_type(df: DataFrame, y: str, yhat: str, label_map: dict | None = None) -> DataFrame:
    """V10 + V12: per-row confusion type, optional decoded label columns."""
    out = df.withColumn("confusion_type", confusion_type(y, yhat))
    if label_map:
        m = F.create_map(*[F.lit(x) for kv in label_map.items() for x in kv])
        out = out.withColumn("y_true_label", F.try_element_at(m, _c(y))) \
                 .withColumn("y_pred_label", F.try_element_at(m, _c(yhat)))
    return out


def confusion_type_counts(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Count per confusion type, descending."""
    return (df.select(confusion_type(y, yhat).alias("confusion_type"))
            .groupBy("confusion_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "confusion_type"))


# ---------------------------------------------------------------------------
# ranking: one row per distinct score, then exact running totals
# ---------------------------------------------------------------------------
def score_counts(df: DataFrame, y: str, score: str, by: Sequence[str] = (), n: str | None = None) -> DataFrame:
    """(by, score, pos, neg): class counts per distinct score (partial aggregation first)."""
    yc, sc = _c(y), _c(score)
    return (df.where(yc.isNotNull() & sc.isNotNull())
            .groupBy(*by, sc.cast("double").alias("score"))
            .agg(_count(yc == 1, n).alias("pos"), _count(yc != 1, n).alias("neg")))


def cumulative_table(df: DataFrame, y: str, score: str, by: Sequence[str] = (),
                     next_counts: bool = False, with_totals: bool = False, n: str | None = None, keep: bool = False, **kw) -> DataFrame:
    """Per distinct score (descending): pos, neg, tp = cum_pos, fp = cum_neg (score >= s);
    with ``with_totals`` also the group's class totals ``tot_pos`` / ``tot_neg``.

    With ``keep`` the counts per distinct score are written to the shared folder once: the passes for bounds, bucket totals and
    running sums read them and not the rows again, which pays where rows are many or costly to make."""
    counts = score_counts(df, y, score, by, n)
    counts = staged(counts, "scores") if keep else counts
    out = running_totals(counts, "score", ["pos", "neg"], by=by, descending=True,
                         next_cols=["pos", "neg"] if next_counts else (), with_totals=with_totals, **kw)
    return out.withColumnRenamed("cum_pos", "tp").withColumnRenamed("cum_neg", "fp")


def ranking_metrics(df: DataFrame, y: str, score: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """V3 ROC AUC (ties count half) and V8 average precision, one row per group."""
    cum = cumulative_table(df, y, score, by, **kw)
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    agg = cum.groupBy(*by).agg(
        F.sum(neg.cast(DEC) * (2 * tp - pos).cast(DEC)).alias("_auc_num"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"),
        F.sum(pos.cast("double") * tp.cast("double") / (tp + fp).cast("double")).alias("_ap_num"),
        F.count(F.lit(1)).alias("distinct_scores"),
    )
    P, N = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    return agg.select(
        *by, "n_pos", "n_neg", "distinct_scores",
        F.when((P > 0) & (N > 0), F.col("_auc_num").cast("double") / (F.lit(2.0) * P * N)).alias("roc_auc"),
        F.when(P > 0, F.col("_ap_num") / P).alias("average_precision"),
    )


def roc_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = (),
              drop_intermediate: bool = True, **kw) -> DataFrame:
    """V6: (threshold, fpr, tpr) from (0, 0); collinear interior points dropped.

    The origin row has a null threshold (above every score).
    """
    cum = cumulative_table(df, y, score, by, next_counts=drop_intermediate, with_totals=True, **kw)
    pts = cum.withColumnRenamed("tot_pos", "_P").withColumnRenamed("tot_neg", "_N")
    if drop_intermediate:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        keep = (first | F.col("next_pos").isNull()
                | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg")))
        pts = pts.where(keep)
    point = F.struct(F.col("score").alias("threshold"),
                     F.try_divide(F.col("fp").cast("double"), F.col("_N").cast("double")).alias("fpr"),
                     F.try_divide(F.col("tp").cast("double"), F.col("_P").cast("double")).alias("tpr"))
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return _with_end(pts, by, origin, point, ["threshold", "fpr", "tpr"])


def _with_end(pts: DataFrame, by: Sequence[str], end: Column, point: Column, names: Sequence[str]) -> DataFrame:
    """The points and one end point per group, emitted beside the group's first point (highest score)."""
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    both = pts.select(*by, F.explode(F.when(first, F.array(end, point)).otherwise(F.array(point))).alias("_p"))
    return both.select(*by, *[F.col(f"_p.{n}").alias(n) for n in names])


def pr_curve(df: DataFrame, y: str, score: str, by: Sequence[str] = (), **kw) -> DataFrame:
    """V7: (threshold, precision, recall) per distinct score, plus the end point (1, 0)."""
    cum = cumulative_table(df, y, score, by, with_totals=True, **kw)
    pts = cum.withColumnRenamed("tot_pos", "_P")
    point = F.struct(F.col("score").alias("threshold"),
                     _safe_div(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                     F.when(F.col("_P") == 0, F.lit(1.0))
                      .otherwise(F.col("tp").cast("double") / F.col("_P").cast("double")).alias("recall"))
    end = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return _with_end(pts, by, end, point, ["threshold", "precision", "recall"])
