"""Registered model versions: baselines, reuse, tags, promotion.

A version row is ``(name, version text, tags map<string,string>)``. Versions compare as
numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import codes

# Fixed values.
APPROVED = "approved"
VALIDATED = "validated"
BOOTSTRAP_NAME = "bootstrap-baseline"
DEFAULT_METRIC = "f1"


def tag_metric(tags: Column, name: str) -> Column:
    """Tag text as a number: absent is 0.0, text that is no number raises."""
    return F.coalesce(tags[name], F.lit("0")).cast("double")


def versions_of(models: DataFrame, name: str) -> DataFrame:
    """All versions of one model; an unknown name gives no rows."""
    return models.where(F.col("name") == name)


def latest_approved(models: DataFrame) -> DataFrame:
    """Baseline per model name: highest approved version, else the bootstrap baseline of zeros."""
    approved = F.lower(F.coalesce(F.col("tags")["approval_status"], F.lit(""))) == APPROVED
    number = F.when(approved, F.col("version").cast("bigint"))
    metrics = F.struct(
        "version",
        F.coalesce(F.col("tags")["primary_metric"], F.lit(DEFAULT_METRIC)).alias("primary_metric"),
        F.when(approved, tag_metric(F.col("tags"), "f1")).alias("f1"),
        F.when(approved, tag_metric(F.col("tags"), "roc_auc")).alias("roc_auc"),
    )
    best = models.groupBy("name").agg(F.max_by(F.when(approved, metrics), number).alias("b"))
    has = F.col("b").isNotNull()
    return best.select(
        "name",
        F.when(has, F.col("name")).otherwise(BOOTSTRAP_NAME).alias("model_name"),
        F.col("b.version").alias("model_version"),
        F.coalesce("b.primary_metric", F.lit(DEFAULT_METRIC)).alias("primary_metric"),
        F.coalesce("b.f1", F.lit(0.0)).alias("f1"),
        F.coalesce("b.roc_auc", F.lit(0.0)).alias("roc_auc"),
    )


def reusable_versions(releases: DataFrame, models: DataFrame) -> DataFrame:
    """Newest approved version that matches each release's lineage.

    ``releases``: release_id, name, source_job_name, data_config, train_config,
    model_name; the last three are compared only where not NULL, and the model only where
    not empty either. Versions that agree on
    everything compared are folded to the newest first, so a model with very many
    versions does not multiply the join.
    """
    tags = F.col("tags")
    folded = (
        models.where(
            (F.coalesce(tags["approval_status"], F.lit("")) == APPROVED)
            & (F.coalesce(tags["lineage_status"], F.lit("")) == VALIDATED)
        )
        .groupBy(
            "name",
            F.coalesce(tags["source_job_name"], F.lit("")).alias("source_job_name"),
            F.coalesce(tags["data_config"], F.lit("")).alias("m_data"),
            F.coalesce(tags["train_config"], F.lit("")).alias("m_train"),
            F.coalesce(
                F.nullif(tags["candidate_model_name"], F.lit("")), tags["best_model"]
            ).alias("m_model"),
        )
        .agg(F.max(F.col("version").cast("bigint")).alias("version"))
    )

    def agrees(wanted: str, tagged: str) -> Column:
        return F.col(wanted).isNull() | F.coalesce(F.col(wanted) == F.col(tagged), F.lit(False))

    matched = releases.join(folded, ["name", "source_job_name"]).where(
        agrees("data_config", "m_data") & agrees("train_config", "m_train")
        & ((F.col("model_name") == "") | agrees("model_name", "m_model"))
    )
    return matched.groupBy("release_id", "name").agg(F.max("version").cast("string").alias("version"))


def promotion(
    candidates: DataFrame,
    baselines: DataFrame,
    minimum_improvement: float = 0.0,
    minimum_score: float = 0.0,
) -> DataFrame:
    """Promote or reject each candidate against the baseline of its model name.

    ``candidates``: candidate_id, name, score. A missing score or baseline counts as
    0.0. Reaching a limit exactly passes.
    """
    joined = candidates.join(baselines.select("name", F.col("f1").alias("_baseline")), "name", "left")
    score, base = F.coalesce("score", F.lit(0.0)), F.coalesce("_baseline", F.lit(0.0))
    reasons = codes(
        (F.col("candidate_score") < minimum_score, "candidate_below_minimum_score"),
        (F.col("improvement") < minimum_improvement, "improvement_below_threshold"),
    )
    return (
        joined.select(
            "candidate_id",
            "name",
            score.alias("candidate_score"),
            base.alias("baseline_score"),
            (score - base).alias("improvement"),
        )
        .withColumn("reasons", reasons)
        .withColumn("status", F.when(F.size("reasons") == 0, "promote").otherwise("reject"))
    )


def promotable(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decisions that allow a release, the others with the status that stopped them)."""
    status = F.lower(F.coalesce("status", F.lit("")))
    allowed = decisions.where(status == "promote")
    refused = decisions.where(status != "promote").withColumn(
        "refused_status", F.when(status == "", "unknown").otherwise(status)
    )
    return allowed, refused


def version_tags(decisions: DataFrame) -> DataFrame:
    """Tags for newly approved versions: core tags win over lineage tags.

    ``decisions``: candidate_id, job_name, status, primary_metric, metrics
    map<string,double>, model_name, lineage map<string,string>.
    """
    def text(column: Column, default: str) -> Column:
        return F.coalesce(column.cast("string"), F.lit(default))

    core = F.create_map(
        F.lit("approval_status"), F.lit(APPROVED),
        F.lit("source_job_name"), F.col("job_name"),
        F.lit("primary_metric"), text(F.col("primary_metric"), DEFAULT_METRIC),
        F.lit("f1"), text(F.col("metrics")["f1"], "0.0"),
        F.lit("roc_auc"), text(F.col("metrics")["roc_auc"], "0.0"),
        F.lit("promotion_status"), text(F.col("status"), "unknown"),
        F.lit("candidate_model_name"), text(F.col("model_name"), "unknown"),
    )
    lineage = F.coalesce("lineage", F.create_map().cast("map<string,string>"))
    kept = F.map_filter(lineage, lambda k, v: ~F.map_contains_key(core, k))
    return decisions.select("candidate_id", F.map_concat(kept, core).alias("tags"))
