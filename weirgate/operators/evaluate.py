"""Classification metrics over scored rows, optionally per group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import ratio
from weirgate.operators.ordered import running_totals


def confusion_metrics(
    df: DataFrame, label: str, prediction: str, by: list[str] = ()
) -> DataFrame:
    """accuracy, precision, recall, F1; zero denominators give 0."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")

    def cells(actual: int, predicted: int, name: str):
        return F.count(F.when((y == actual) & (p == predicted), 1)).alias(name)

    counts = df.groupBy(*by).agg(
        cells(1, 1, "tp"), cells(0, 1, "fp"), cells(1, 0, "fn"), cells(0, 0, "tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    """Exact rank AUC; ties count half. A group with a single class gets 0.5."""
    keys = list(by) or ["_all"]
    frame = df if by else df.withColumn("_all", F.lit(0))
    counted = frame.groupBy(*keys, score).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
    )
    ranked = running_totals(counted, keys, score, ["pos", "neg"])
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5)
    area = F.try_divide(F.sum(wins), F.max("pos_total").cast("double") * F.max("neg_total"))
    single = (F.max("pos_total") == 0) | (F.max("neg_total") == 0)
    out = ranked.groupBy(*keys).agg(
        F.max("pos_total").alias("positives"),
        F.max("neg_total").alias("negatives"),
        F.when(single, F.lit(0.5)).otherwise(area).alias("roc_auc"),
    )
    return out if by else out.drop("_all")


def classification_report(
    df: DataFrame, label: str, prediction: str, score: str, by: list[str] = ()
) -> DataFrame:
    """Confusion metrics and AUC together."""
    keys = list(by) or ["_all"]
    frame = df if by else df.withColumn("_all", F.lit(0))
    joined = confusion_metrics(frame, label, prediction, keys).join(
        roc_auc(frame, label, score, keys).select(*keys, "roc_auc"), keys
    )
    return joined if by else joined.drop("_all")
