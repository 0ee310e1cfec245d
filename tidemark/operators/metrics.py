"""Evaluation metrics as aggregations over a table of actual and predicted values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ranking import average_rank, ranked_counts


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and R2, per group if ``by`` is given. One pass."""
    error = F.col(actual) - F.col(predicted)
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    mse = F.avg(error * error)
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (F.lit(1.0) - F.try_divide(mse, F.var_pop(actual))).alias("r2"),
    )


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def accuracy(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(actual) == F.col(predicted)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def _zero_divide(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, actual: str, predicted: str, labels: Sequence[int]) -> DataFrame:
    """Precision, recall, F1 and support per label of the list; 0 where a ratio is undefined."""
    rows = []
    for k in labels:
        is_k, said_k = F.col(actual) == k, F.col(predicted) == k
        hits, support, said = F.count_if(is_k & said_k), F.count_if(is_k), F.count_if(said_k)
        rows.append(
            F.struct(
                F.lit(k).cast("int").alias("label"),
                _zero_divide(hits, said).alias("precision"),
                _zero_divide(hits, support).alias("recall"),
                _zero_divide(2 * hits, said + support).alias("f1"),
                support.alias("support"),
            )
        )
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def report_averages(report: DataFrame) -> DataFrame:
    """Macro and support-weighted averages of a report, as two rows."""
    scores = ["precision", "recall", "f1"]
    total = F.sum("support")
    macro = F.struct(F.lit("macro").alias("average"), *[F.avg(s).alias(s) for s in scores])
    weighted = F.struct(
        F.lit("weighted").alias("average"),
        *[_zero_divide(F.sum(F.col(s) * F.col("support")), total).alias(s) for s in scores],
    )
    return report.agg(F.array(macro, weighted).alias("rows")).select(F.inline("rows"))


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[int]) -> DataFrame:
    """One row per actual label and one column per predicted label, for the fixed label list."""
    rows = [
        F.struct(
            F.lit(k).cast("int").alias("actual"),
            *[F.count_if((F.col(actual) == k) & (F.col(predicted) == j)).alias(f"pred_{j}") for j in labels],
        )
        for k in labels
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve from average ranks, ties counted half. Scores are ranked in a range
    partitioned pass, after equal scores have been counted."""
    known = df.filter(F.col(label).isNotNull())
    ranked = ranked_counts(known, score, by, {"n_pos": F.count_if(F.col(label) == 1)})
    positives, total = F.sum("n_pos").cast("double"), F.sum("n").cast("double")
    rank_sum = F.sum(F.col("n_pos") * average_rank())
    area = F.try_divide(rank_sum - positives * (positives + 1) / 2, positives * (total - positives))
    return ranked.groupBy(*by).agg(area.alias("auc"), F.sum("n_pos").alias("n_pos"), F.sum("n").alias("n"))
