"""JSON artifacts: candidate metrics and step manifests, many files at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys of a candidate file that are not metrics.
NOT_METRICS = ("model_name", "run_id")


def parse_candidate_metrics(lines: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``line`` JSON objects to (keep..., model_name, run_id, metrics map<string,double>).

    Every key but the two names is a metric and must be a number.
    """
    fields = F.from_json("line", "map<string,string>")
    metrics = F.transform_values(
        F.map_filter(F.col("fields"), lambda k, v: ~k.isin(*NOT_METRICS)), lambda k, v: v.cast("double")
    )
    return lines.select(*keep, fields.alias("fields")).select(
        *keep,
        F.col("fields")["model_name"].alias("model_name"),
        F.col("fields")["run_id"].alias("run_id"),
        metrics.alias("metrics"),
    )


def read_candidate_metrics(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Candidate files, one JSON object each. Paths that do not exist are skipped."""
    found = [p for p in paths if p and path_exists(spark, p)]
    if not found:
        return spark.createDataFrame([], "model_name string, run_id string, metrics map<string,double>, source_path string")
    lines = spark.read.text(found, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json").select(
        F.col("value").alias("line"), F.input_file_name().alias("source_path")
    )
    return parse_candidate_metrics(lines, keep=["source_path"])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Manifests under ``root/<sweep_id>/<family>/<kind>/*.json`` with status and warnings."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    body = F.from_json("value", "status string, warnings array<string>")
    parts = F.split(F.input_file_name(), "/")
    return files.select(
        F.element_at(parts, -4).alias("sweep_id"),
        F.element_at(parts, -3).alias("model_name"),
        F.element_at(parts, -2).alias("kind"),
        F.input_file_name().alias("path"),
        body.alias("body"),
    ).select(
        "sweep_id",
        "model_name",
        "kind",
        "path",
        "body.status",
        F.coalesce("body.warnings", F.array().cast("array<string>")).alias("warnings"),
    )
