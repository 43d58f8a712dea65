"""Declared configuration against what the source jobs recorded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import codes


def normal_path(path: Column) -> Column:
    """Forward slashes, from the first ``configs`` part on, else the last part; blank is NULL."""
    parts = F.filter(F.split(F.translate(F.trim(path), "\\", "/"), "/"), lambda p: p != "")
    at = F.array_position(parts, "configs")
    tail = F.array_join(F.slice(parts, F.greatest(at, F.lit(1)).cast("int"), F.greatest(F.size(parts), F.lit(1))), "/")
    return F.when(at > 0, tail).when(F.size(parts) > 0, F.element_at(parts, -1))


def same_path(declared: Column, source: Column) -> Column:
    """Equal, or equal in the last part; a missing side matches."""
    def last(path: Column) -> Column:
        return F.element_at(F.split(path, "/"), -1)

    missing = declared.isNull() | source.isNull()
    return missing | (declared == source) | (last(declared) == last(source))


def dataset_kind(raw: Column) -> Column:
    """Registered asset, URI, or local path."""
    text = F.trim(raw)
    return (
        F.when(F.startswith(text, F.lit("azureml:")) & ~F.startswith(text, F.lit("azureml://")), "azureml_asset")
        .when(F.contains(text, F.lit("://")), "uri")
        .otherwise("local_path")
    )


def lineage_status(declared: DataFrame, manifests: DataFrame) -> DataFrame:
    """Compare each release's declared configs with its job's manifests.

    ``declared``: release_id, job_name, data_config, train_config, allow_mismatch.
    ``manifests``: job_name, train_present, validation_present, train_config, data_config.
    """
    right = manifests.select(
        "job_name",
        "train_present",
        "validation_present",
        normal_path(F.col("data_config")).alias("source_data"),
        normal_path(F.col("train_config")).alias("source_train"),
    )
    rows = declared.select(
        "release_id",
        "job_name",
        "allow_mismatch",
        F.coalesce(normal_path(F.col("data_config")), "data_config").alias("data_config"),
        F.coalesce(normal_path(F.col("train_config")), "train_config").alias("train_config"),
    ).join(right, "job_name", "left")
    errors = codes(
        (~same_path(F.col("data_config"), F.col("source_data")), "data_config"),
        (~same_path(F.col("train_config"), F.col("source_train")), "train_config"),
    )
    unavailable = codes(
        (~F.coalesce("train_present", F.lit(False)), "train_manifest_unavailable"),
        (~F.coalesce("validation_present", F.lit(False)), "validation_manifest_unavailable"),
    )
    has_error = F.size("mismatches") > 0
    has_source = F.col("source_data").isNotNull() | F.col("source_train").isNotNull()
    status = (
        F.when(has_error & F.col("allow_mismatch"), "mismatch_allowed")
        .when(has_error, "failed")
        .when(has_source, "validated")
        .otherwise("unverified")
    )
    good = F.col("lineage_status") != "failed"
    return (
        rows.withColumn("mismatches", errors)
        .withColumn("warnings", unavailable)
        .withColumn("lineage_status", status)
        .select(
            "release_id",
            "lineage_status",
            F.when(F.col("lineage_status") == "mismatch_allowed", "override").otherwise(F.col("lineage_status")).alias("validation_status"),
            # An allowed mismatch is a warning, not an error.
            F.when(F.col("lineage_status") == "failed", F.col("mismatches")).otherwise(F.array().cast("array<string>")).alias("errors"),
            F.when(F.col("lineage_status") == "mismatch_allowed", F.concat("warnings", "mismatches")).otherwise(F.col("warnings")).alias("warnings"),
            F.when(good, F.coalesce("source_data", "data_config")).otherwise(F.col("data_config")).alias("data_config"),
            F.when(good, F.coalesce("source_train", "train_config")).otherwise(F.col("train_config")).alias("train_config"),
        )
    )
