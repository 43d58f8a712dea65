"""Choosing winners among many candidates, for many sweeps at once.

Candidates are rows ``(sweep_id, model_name, run_id, metrics map<string,double>)``.
Everything is a partial aggregation, so one sweep may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default order in which families win a full tie.
FAMILY_PRIORITY = ("logreg", "rf", "xgboost")


def family_rank(model_name: Column, priority: tuple[str, ...] = FAMILY_PRIORITY) -> Column:
    """Position in the priority list; unlisted families come last."""
    place = F.array_position(F.array(*[F.lit(p) for p in priority]), model_name)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(priority))).cast("int")


def without_metric(candidates: DataFrame, metric: str) -> DataFrame:
    """Candidates that cannot be ranked because the metric is missing."""
    return candidates.where(F.col("metrics")[metric].isNull()).select("sweep_id", "model_name", "run_id")


def select_winner(
    candidates: DataFrame,
    primary: str = "f1",
    secondary: str = "roc_auc",
    priority: tuple[str, ...] = FAMILY_PRIORITY,
    on_missing: str = "error",
    round_to: int | None = None,
) -> DataFrame:
    """Winner per sweep: primary, then secondary, then family priority, name and run id.

    ``tie_break_reason`` names the level that decided. ``tie_candidates`` lists the
    distinct family names tied on the primary metric when the secondary decides, else
    those tied on both; ``tied`` counts the candidates. A candidate without the primary
    metric fails the job, or is left out with ``on_missing="reject"``.
    """
    p = F.col("metrics")[primary]
    s = F.coalesce(F.col("metrics")[secondary], F.lit(float("-inf")))
    if on_missing == "error":
        message = F.concat(F.lit(f"metric {primary} missing for "), F.col("model_name"))
        p = F.when(p.isNotNull(), p).otherwise(F.raise_error(message).cast("double"))
    elif on_missing == "reject":
        candidates = candidates.where(p.isNotNull())
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    if round_to is not None:
        p, s = F.round(p, round_to), F.round(s, round_to)
    scored = candidates.select("sweep_id", "model_name", "run_id", p.alias("p"), s.alias("s"))
    # Three folds, each with map-side combine and no join: one sweep may hold most rows.
    levels = scored.groupBy("sweep_id", "p", "model_name", "s").agg(
        F.count(F.lit(1)).alias("n"), F.min("run_id").alias("run_id")
    )
    families = levels.groupBy("sweep_id", "p", "model_name").agg(
        F.sum("n").alias("primary_n"), F.max_by(F.struct("s", "n", "run_id"), "s").alias("top")
    )
    entry = F.struct(
        family_rank(F.col("model_name"), priority).alias("rank"), "model_name", "top.run_id", "top.s", "top.n", "primary_n"
    )
    # One entry per family name within a (sweep, primary value).
    tied = families.groupBy("sweep_id", "p").agg(F.collect_list(entry).alias("entries"))
    best = tied.groupBy("sweep_id").agg(F.max("p").alias("score"), F.max_by("entries", "p").alias("entries"))

    def total(entries: Column, name: str) -> Column:
        return F.aggregate(entries, F.lit(0).cast("long"), lambda acc, e: acc + e[name])

    top_s = F.array_max(F.transform("entries", lambda e: e["s"]))
    both = F.filter("entries", lambda e: e["s"] == F.col("_s"))
    won = F.array_min("_both")
    ranked = best.withColumn("_s", top_s).withColumn("_both", both).withColumn("_won", won)
    same_rank = F.filter("_both", lambda e: e["rank"] == F.col("_won.rank"))
    counted = ranked.select(
        "*",
        total(F.col("entries"), "primary_n").alias("_primary"),
        total(F.col("_both"), "n").alias("_secondary"),
        total(same_rank, "n").alias("_priority"),
    )
    reason = (
        F.when(F.col("_primary") == 1, "primary_metric")
        .when(F.col("_secondary") == 1, "secondary_metric")
        .when(F.col("_priority") == 1, "family_priority")
        .otherwise("final_fallback")
    )
    by_secondary = F.col("tie_break_reason") == "secondary_metric"
    listed = F.when(by_secondary, F.col("entries")).otherwise(F.col("_both"))
    return counted.withColumn("tie_break_reason", reason).select(
        "sweep_id",
        "_won.model_name",
        "_won.run_id",
        "score",
        "tie_break_reason",
        F.sort_array(F.transform(listed, lambda e: e["model_name"])).alias("tie_candidates"),
        F.when(by_secondary, F.col("_primary")).otherwise(F.col("_secondary")).alias("tied"),
    )


def best_by(candidates: DataFrame, metric: str, order: str, by: list[str]) -> DataFrame:
    """Highest metric per group; ties go to the earliest in ``order``."""
    key = F.struct(F.col("metrics")[metric].alias("score"), (-F.col(order)).alias("earlier"))
    best = F.max_by(F.struct("model_name", "run_id", "metrics"), key)
    return candidates.groupBy(*by).agg(best.alias("best")).select(*by, "best.*")


def best_overall(sweeps: DataFrame, by: list[str] = ()) -> DataFrame:
    """Best sweep by score, skipping those without a best run or a numeric score; the first wins ties.

    ``sweeps``: seq, model_name, best_run_id, score (text).
    """
    score = F.expr("try_cast(score as double)")
    usable = sweeps.withColumn("metric", score).where("metric is not null and best_run_id is not null and best_run_id <> ''")
    best = F.max_by(F.struct("model_name", "best_run_id", "metric"), F.struct("metric", -F.col("seq")))
    return usable.groupBy(*by).agg(best.alias("best")).where("best is not null").select(*by, "best.*")


def metrics_long(candidates: DataFrame) -> DataFrame:
    """(sweep_id, model_name, run_id, metric, value): one row per reported metric."""
    return candidates.select("sweep_id", "model_name", "run_id", F.explode("metrics").alias("metric", "value"))


def metrics_text(candidates: DataFrame) -> DataFrame:
    """Metrics of each candidate as ``k=v`` sorted by key, for a report table."""
    pairs = F.transform(
        F.sort_array(F.map_entries("metrics")),
        lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.4f", e["value"])),
    )
    return candidates.select("sweep_id", "model_name", "run_id", F.array_join(pairs, ", ").alias("metrics_text"))


def with_family_artifacts(candidates: DataFrame, bundles: DataFrame, manifests: DataFrame) -> DataFrame:
    """Attach artifact paths by family; manifest entries win over bundle entries on a key clash.

    ``bundles`` and ``manifests``: (sweep_id, model_name, paths map<string,string>),
    at most one row per key.
    """
    keys = ["sweep_id", "model_name"]
    empty = F.create_map().cast("map<string,string>")
    # The two small sides meet first, so that candidates pass through a single join.
    paths = bundles.withColumnRenamed("paths", "_bundle").join(
        manifests.withColumnRenamed("paths", "_manifest"), keys, "full_outer"
    )
    bundle = F.map_filter(F.coalesce("_bundle", empty), lambda k, v: v.isNotNull())
    manifest = F.map_filter(F.coalesce("_manifest", empty), lambda k, v: v.isNotNull())
    merged = paths.select(*keys, bundle.alias("_bundle"), manifest.alias("_manifest"))
    kept = F.map_filter("_bundle", lambda k, v: ~F.map_contains_key("_manifest", k))
    artifacts = merged.select(*keys, F.map_concat(kept, "_manifest").alias("_artifacts"))
    return (
        candidates.join(artifacts, keys, "left")
        .withColumn("artifacts", F.coalesce("_artifacts", empty))
        .drop("_artifacts")
    )


def family_report(candidates: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row per (sweep, family) seen as a candidate or in a manifest.

    ``manifests``: (sweep_id, model_name, kind hpo/train, status, warnings array).
    Absent manifests read ``missing``; warnings keep the hpo, train order.
    """
    keys = ["sweep_id", "model_name"]

    def status(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.coalesce("status", F.lit("missing")))).alias(f"{kind}_status")

    by_family = manifests.groupBy(*keys).agg(
        status("hpo"),
        status("train"),
        F.flatten(
            F.transform(F.sort_array(F.collect_list(F.struct("kind", "warnings"))), lambda w: w["warnings"])
        ).alias("warnings"),
    )
    seen = candidates.groupBy(*keys).agg(F.max("run_id").alias("run_id"))
    missing = F.lit("missing")
    return seen.join(by_family, keys, "full_outer").select(
        *keys,
        "run_id",
        F.coalesce("hpo_status", missing).alias("hpo_status"),
        F.coalesce("train_status", missing).alias("train_status"),
        F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
    )


def winner_mismatches(summaries: DataFrame, manifests: DataFrame, configs: DataFrame) -> DataFrame:
    """Runs whose winner differs between summary, manifest and (where present) config.

    Each input: (run_id, family). A missing manifest is a mismatch, a missing config is not.
    """
    joined = summaries.join(manifests.withColumnRenamed("family", "manifest_family"), "run_id", "left").join(
        configs.withColumnRenamed("family", "config_family"), "run_id", "left"
    )
    bad_manifest = ~F.col("family").eqNullSafe(F.col("manifest_family"))
    bad_config = F.col("config_family").isNotNull() & (F.col("config_family") != F.col("family"))
    return joined.where(bad_manifest | bad_config).select(
        "run_id",
        "family",
        "manifest_family",
        "config_family",
        F.when(bad_manifest, "winner_manifest").otherwise("winner_train_config").alias("mismatch"),
    )
