"""Model evaluation as aggregations: ROC AUC, classifier report, confusion matrix, regression report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running_sums


def roc_auc(df: DataFrame, label_col: str, score_col: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Tie-aware AUC = P(score_pos > score_neg) + 0.5 P(equal), by counts per distinct score and a
    bucketed running count of negatives. Accepts hard 0/1 predictions or scores.
    One class only -> NULL. Output: group cols + ``auc``."""
    g = list(group_cols)
    counts = (df.where(F.col(label_col).isNotNull() & F.col(score_col).isNotNull())
              .groupBy(*g, F.col(score_col).cast("double").alias("__dw_s"))
              .agg(F.sum(F.when(F.col(label_col) == 1, 1).otherwise(0)).cast("long").alias("__dw_pos"),
                   F.sum(F.when(F.col(label_col) == 1, 0).otherwise(1)).cast("long").alias("__dw_neg")))
    r = running_sums(counts, g, "__dw_s", ["__dw_neg"])
    below_neg = F.col("cum___dw_neg") - F.col("__dw_neg")
    agg = [F.sum(F.col("__dw_pos") * (below_neg + F.col("__dw_neg") * F.lit(0.5))).alias("__dw_num"),
           F.sum("__dw_pos").alias("__dw_p"), F.sum("__dw_neg").alias("__dw_n")]
    a = r.groupBy(*g).agg(*agg) if g else r.agg(*agg)
    denom = F.col("__dw_p").cast("double") * F.col("__dw_n").cast("double")
    return a.select(*g, F.when(denom > 0, F.col("__dw_num") / denom).alias("auc"))


def confusion_matrix(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return (df.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def classifier_report(df: DataFrame, label_col: str, pred_col: str, prob_col: str | None = None,
                      prefix: str = "val_", group_cols: Sequence[str] = ()) -> DataFrame:
    """One aggregation: counts, accuracy, precision, recall, F1 (positive class 1), log loss."""
    y, p = F.col(label_col), F.col(pred_col)
    tp = F.sum(((y == 1) & (p == 1)).cast("long"))
    fp = F.sum(((y != 1) & (p == 1)).cast("long"))
    tn = F.sum(((y != 1) & (p != 1)).cast("long"))
    fn = F.sum(((y == 1) & (p != 1)).cast("long"))
    aggs = [tp.alias("tp"), fp.alias("fp"), tn.alias("tn"), fn.alias("fn")]
    if prob_col:
        eps = 1e-15
        pr = F.least(F.greatest(F.col(prob_col), F.lit(eps)), F.lit(1 - eps))
        aggs.append(F.avg(-(y * F.log(pr) + (F.lit(1) - y) * F.log(F.lit(1.0) - pr))).alias("log_loss"))
    g = list(group_cols)
    a = df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    out = [*g, F.col("tp").alias(f"{prefix}true_positives"), F.col("fp").alias(f"{prefix}false_positives"),
           F.col("tn").alias(f"{prefix}true_negatives"), F.col("fn").alias(f"{prefix}false_negatives"),
           F.when(n > 0, (tp + tn) / n).alias(f"{prefix}accuracy_score"),
           prec.alias(f"{prefix}precision_score"), rec.alias(f"{prefix}recall_score"),
           f1.alias(f"{prefix}f1_score")]
    if prob_col:
        out.append(F.col("log_loss").alias(f"{prefix}log_loss"))
    return a.select(*out)


def regression_report(df: DataFrame, label_col: str, pred_col: str, group_cols: Sequence[str] = (),
                      prefix: str = "metric_") -> DataFrame:
    """MSE, RMSE, MAE and R^2 = 1 - SSE/SST (SST from the numerically stable var_pop)."""
    err = F.col(label_col) - F.col(pred_col)
    aggs = [F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
            F.var_pop(label_col).alias("__dw_vy"), F.count(F.lit(1)).alias("n")]
    g = list(group_cols)
    a = df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)
    return a.select(*g, F.col("mse").alias(f"{prefix}mse"), F.sqrt("mse").alias(f"{prefix}rmse"),
                    F.col("mae").alias(f"{prefix}mae"),
                    F.when(F.col("__dw_vy") > 0, F.lit(1.0) - F.col("mse") / F.col("__dw_vy"))
                    .alias(f"{prefix}r2"), "n")
