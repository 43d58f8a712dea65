"""Validation gate of a current batch against a reference batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import is_missing
from weirgate.operators.drift import drift_report, drift_summary
from weirgate.session import local_rows


@dataclass(frozen=True)
class ValidationConfig:
    target_column: str = "Exited"
    drift_share_threshold: float = 0.3
    max_missing_fraction: float = 0.2
    max_row_count_delta_fraction: float = 0.5
    fail_on_drift: bool = False
    fail_on_schema_mismatch: bool = True
    fail_on_missing_fraction: bool = True
    fail_on_row_count_delta: bool = False


def schema_difference(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Columns whose presence or type differs. Informational; the gate compares names only."""
    left, right = dict(reference.dtypes), dict(current.dtypes)
    rows = [
        (name, left.get(name), right.get(name))
        for name in sorted(left.keys() | right.keys())
        if left.get(name) != right.get(name)
    ]
    return local_rows(
        reference.sparkSession, rows, "column string, reference_type string, current_type string"
    )


def _row_and_missing(df: DataFrame) -> tuple[int, float]:
    """Row count and the largest missing fraction, in one pass."""
    worst = [F.avg(is_missing(df, c).cast("int")) for c in df.columns]
    row = df.agg(F.count(F.lit(1)).alias("n"), F.array_max(F.array(*worst)).alias("worst")).first()
    return row.n, row.worst or 0.0


def validate(
    reference: DataFrame,
    current: DataFrame,
    config: ValidationConfig,
    report: Callable[[DataFrame, DataFrame], DataFrame] = drift_report,
) -> DataFrame:
    """One summary row: status, failed checks in order, each check, and the figures behind it.

    The cheap checks run first; drift is computed only when they pass, otherwise its
    fields are NULL. ``report`` may be replaced by any (column, drifted) report.
    """
    target_present = config.target_column in reference.columns and config.target_column in current.columns
    schema_match = set(reference.columns) == set(current.columns)
    reference_rows = reference.count()
    current_rows, missing = _row_and_missing(current)
    delta = abs(current_rows - reference_rows) / max(reference_rows, 1)
    missing_ok = missing <= config.max_missing_fraction
    rows_ok = delta <= config.max_row_count_delta_fraction
    failed = [
        name
        for name, bad in (
            ("target_column_present", not target_present),
            ("schema_mismatch", config.fail_on_schema_mismatch and not schema_match),
            ("max_missing_fraction", config.fail_on_missing_fraction and not missing_ok),
            ("row_count_delta_fraction", config.fail_on_row_count_delta and not rows_ok),
        )
        if bad
    ]
    spark = reference.sparkSession
    if failed:
        drift = spark.range(1).select(
            F.lit(None).cast("double").alias("drifted_column_count"),
            F.lit(None).cast("double").alias("drifted_column_share"),
        )
    else:
        drift = drift_summary(report(reference, current))
    share = F.col("drifted_column_share")
    late = F.array_compact(
        F.array(
            F.when(F.lit(config.fail_on_drift and not failed) & share.isNull(), "drift_metric_missing"),
            F.when(
                F.lit(config.fail_on_drift and not failed) & (share > config.drift_share_threshold),
                "data_drift_detected",
            ),
        )
    )
    early = F.array(*[F.lit(f) for f in failed]).cast("array<string>")

    def names(df: DataFrame):
        return F.array(*[F.lit(c) for c in sorted(df.columns)])

    return drift.withColumn("failed_checks", F.concat(early, late)).select(
        F.when(F.size("failed_checks") > 0, "failed").otherwise("passed").alias("status"),
        "failed_checks",
        F.struct(
            F.lit(schema_match).alias("schema_match"),
            F.lit(target_present).alias("target_column_present"),
            F.lit(missing_ok).alias("missing_fraction_within_threshold"),
            F.lit(rows_ok).alias("row_count_within_threshold"),
            (share <= config.drift_share_threshold).alias("drift_within_threshold"),
        ).alias("checks"),
        "drifted_column_count",
        "drifted_column_share",
        F.struct(
            F.lit(reference_rows).cast("long").alias("reference"), F.lit(current_rows).cast("long").alias("current")
        ).alias("row_counts"),
        F.struct(
            F.lit(len(reference.columns)).alias("reference"), F.lit(len(current.columns)).alias("current")
        ).alias("column_counts"),
        F.lit(float(missing)).alias("max_missing_fraction"),
        F.lit(float(delta)).alias("row_count_delta_fraction"),
        names(reference).alias("reference_columns"),
        names(current).alias("current_columns"),
        F.struct(*[F.lit(v).alias(k) for k, v in vars(config).items()]).alias("thresholds"),
    )
