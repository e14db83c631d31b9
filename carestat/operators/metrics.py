"""Evaluation of a scored population.

Input: a DataFrame with a 0/1 ``label`` and a probability ``score``.

Threshold metrics are one global aggregate (four ``count_if``). Ranking
metrics (ROC AUC, average precision, curve points) first aggregate to one
row per distinct score and then add up running totals over range partitions of
the scores (``ranks.running_totals``). Scores are taken as they are: two that
differ in their last digit rank apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import r6, rows_of, safe_div, zero_div
from .ranks import running_totals

LABEL, SCORE = "label", "score"


def scored_view(df: DataFrame, label: str, score: str, key: str | None = None) -> DataFrame:
    cols = [F.col(label).cast("int").alias(LABEL), F.col(score).cast("double").alias(SCORE)]
    if key:
        cols.insert(0, F.col(key))
    return df.select(*cols)


# ---------------------------------------------------------------- E2, E3 --
def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Tp, fp, fn, tn at ``score >= threshold`` (always four counts)."""
    pred = F.col(SCORE) >= F.lit(threshold)
    pos = F.col(LABEL) == 1
    return scored.agg(F.count_if(pred & pos).alias("tp"), F.count_if(pred & ~pos).alias("fp"),
                      F.count_if(~pred & pos).alias("fn"), F.count_if(~pred & ~pos).alias("tn"))


def threshold_metrics_from_counts(cm: DataFrame) -> DataFrame:
    """E3 from a confusion row: accuracy, precision/recall/F1 (0 when undefined)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = zero_div(tp, tp + fp)
    recall = zero_div(tp, tp + fn)
    f1 = zero_div(2 * precision * recall, precision + recall)
    return cm.select("tp", "fp", "fn", "tn",
                     r6(safe_div(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
                     r6(precision).alias("precision"), r6(recall).alias("recall"),
                     r6(f1).alias("f1"))


def threshold_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return threshold_metrics_from_counts(confusion(scored, threshold))


def class_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per-class precision, recall, F1, support, then macro and weighted
    averages (zero when undefined)."""
    cm = confusion(scored, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def prf(t, f_pos, f_neg):
        p = zero_div(t, t + f_pos)
        r = zero_div(t, t + f_neg)
        return p, r, zero_div(2 * p * r, p + r)

    p1, r1, f1 = prf(tp, fp, fn)
    p0, r0, f0 = prf(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s1 + s0

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), r6(p).alias("precision"), r6(r).alias("recall"),
                        r6(f).alias("f1"), s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", safe_div(p0 * s0 + p1 * s1, n), safe_div(r0 * s0 + r1 * s1, n),
            safe_div(f0 * s0 + f1 * s1, n), n))
    return cm.select(F.inline(rows))


# ---------------------------------------------------------- E5-E8 ranking --
def score_groups(scored: DataFrame) -> DataFrame:
    """One row per distinct score, descending cumulative counts.

    Columns: score, n, pos, neg, cum_n, cum_pos, cum_neg, pos_total, neg_total.
    """
    g = scored.groupBy(SCORE).agg(F.count(F.lit(1)).alias("n"),
                                  F.sum(F.col(LABEL)).cast("bigint").alias("pos"))
    g = g.withColumn("neg", F.col("n") - F.col("pos"))
    g = running_totals(g, SCORE, ["n", "pos", "neg"], descending=True)
    return g.select(SCORE, "n", "pos", "neg", "cum_n", "cum_pos", "cum_neg",
                    F.col("total_pos").alias("pos_total"), F.col("total_neg").alias("neg_total"))


def _ranking_aggs() -> list:
    above = F.col("cum_pos") - F.col("pos")
    return [
        r6(safe_div(F.sum(F.col("neg") * (above + F.col("pos") / 2.0)),
                    F.first("pos_total") * F.first("neg_total"))).alias("roc_auc"),
        r6(safe_div(F.sum(F.col("pos") * safe_div(F.col("cum_pos"), F.col("cum_n"))),
                    F.first("pos_total"))).alias("average_precision")]


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """E5 + E6: ROC AUC (ties count half; NULL with one class) and average
    precision (step sum over distinct scores)."""
    return score_groups(scored).agg(*_ranking_aggs())


def roc_points(scored: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    g = score_groups(scored)
    return g.select(F.col(SCORE).alias("threshold"),
                    r6(safe_div(F.col("cum_neg"), F.col("neg_total"))).alias("fpr"),
                    r6(safe_div(F.col("cum_pos"), F.col("pos_total"))).alias("tpr"))


def pr_points(scored: DataFrame) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    g = score_groups(scored)
    return g.select(F.col(SCORE).alias("threshold"),
                    r6(safe_div(F.col("cum_pos"), F.col("cum_n"))).alias("precision"),
                    r6(safe_div(F.col("cum_pos"), F.col("pos_total"))).alias("recall"))


def prevalence(scored: DataFrame) -> DataFrame:
    """No-skill baseline = share of positives."""
    return scored.agg(r6(F.avg(F.col(LABEL))).alias("no_skill_precision"))


def normalized_confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts per (actual, predicted) with the row-normalised share."""
    cm = confusion(scored, threshold)
    cells = rows_of(("actual", "predicted", "count"),
                    (0, 0, F.col("tn")), (0, 1, F.col("fp")), (1, 0, F.col("fn")), (1, 1, F.col("tp")))
    long = cm.select(F.inline(cells))
    row_total = F.sum("count").over(Window.partitionBy("actual"))  # 4 rows
    return long.select("actual", "predicted", "count",
                       r6(zero_div(F.col("count"), row_total)).alias("share"))


# ------------------------------------------------------------------- E11 --
def model_metrics(scored: DataFrame, model: str, threshold: float = 0.5,
                  order: int = 0) -> DataFrame:
    """The six comparison metrics of one scored model, as fractions.

    One aggregate over the distinct-score table gives both the confusion
    counts at the threshold and the ranking sums.
    """
    g = score_groups(scored)
    flag = F.col(SCORE) >= F.lit(threshold)
    one = g.agg(F.sum(F.when(flag, F.col("pos")).otherwise(0)).alias("tp"),
                F.sum(F.when(flag, F.col("neg")).otherwise(0)).alias("fp"),
                F.sum(F.when(~flag, F.col("pos")).otherwise(0)).alias("fn"),
                F.sum(F.when(~flag, F.col("neg")).otherwise(0)).alias("tn"),
                *_ranking_aggs())
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision = zero_div(tp, tp + fp)
    recall = zero_div(tp, tp + fn)
    return one.select(
        F.lit(model).alias("model"), F.lit(order).alias("model_order"),
        r6(safe_div(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        r6(precision).alias("precision"), r6(recall).alias("recall"),
        r6(zero_div(2 * precision * recall, precision + recall)).alias("f1"),
        "roc_auc", "average_precision")


def comparison_table(metric_rows: Sequence[DataFrame]) -> DataFrame:
    """One row per model with "xx.xx%" text (rounded numerically first)."""
    out = metric_rows[0]
    for m in metric_rows[1:]:
        out = out.unionByName(m)

    def pct(c):
        return F.format_string("%.2f%%", F.round(F.col(c) * 100.0, 2))
    return out.select("model", pct("accuracy").alias("Accuracy"), pct("precision").alias("Precision"),
                      pct("recall").alias("Recall"), pct("f1").alias("F1 Score"),
                      pct("roc_auc").alias("ROC AUC"), pct("average_precision").alias("Avg Precision"))


def best_model(metric_rows: DataFrame, order_col: str = "model_order") -> DataFrame:
    """Highest F1; the earliest model wins ties."""
    return metric_rows.orderBy(F.desc("f1"), F.asc(order_col)).limit(1)


# ------------------------------------------------------------------- E14 --
def score_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """Density histogram of scores in [0, 1] per outcome."""
    b = F.least(F.floor(F.col(SCORE) * bins), F.lit(bins - 1)).cast("int")
    agg = scored.groupBy(F.col(LABEL).alias("label"), b.alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"))
    n_label = F.sum("count").over(Window.partitionBy("label"))  # over <= 2*bins rows
    return agg.select("label", "bucket", r6(F.col("bucket") / float(bins)).alias("bin_low"),
                      "count", r6(F.col("count") / (n_label * (1.0 / bins))).alias("density"))
