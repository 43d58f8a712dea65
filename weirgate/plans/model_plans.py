"""Training over the churn view. No SQL twin exists for a fitted model."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.operators import models, prep, search
from weirgate.operators.validate import ValidationConfig
from weirgate.plans.common import Registry, rounded
from weirgate.sources.tables import CHURN_CATEGORICAL, CHURN_TARGET, churn_view, table

plans = Registry()


def prepared_churn(spark, sf):
    return prep.prepare(
        churn_view(spark, sf), target=CHURN_TARGET, key="customer_id",
        drop=["customer_id", "surname"], categorical=CHURN_CATEGORICAL,
    )


def _flat(results):
    return rounded(
        results.select(
            "model_name", "class_weight", *[F.col("metrics")[m].alias(m) for m in models.METRIC_NAMES],
            F.concat_ws("; ", "warnings").alias("warnings"),
        ), 4,
    )


@plans.query("train_logreg")
def train_logreg(spark, sf):
    results, _ = models.train_families(prepared_churn(spark, sf), ("logreg",))
    return _flat(results)


@plans.query("train_families")
def train_families(spark, sf):
    results, _ = models.train_families(prepared_churn(spark, sf))
    return _flat(results)


@plans.query("train_smote")
def train_smote(spark, sf):
    results, _ = models.train_families(prepared_churn(spark, sf), ("logreg",), use_smote=True)
    return _flat(results)


@plans.query("trial_results")
def trial_results(spark, sf):
    """Two sampled trials per family from a grid whose depths follow the data."""
    families = table(spark, sf, "customer").groupBy(
        F.expr("CASE c_custkey % 2 WHEN 0 THEN 'rf' ELSE 'logreg' END").alias("family")
    ).agg(F.count_distinct("c_mktsegment").cast("int").alias("most"))
    spaces = families.select(
        F.lit(1).alias("sweep_id"), "family",
        F.create_map(F.lit("use_smote"), F.array(F.lit("false"))).alias("shared"),
        F.expr(
            "CASE family WHEN 'rf' THEN map('max_depth', transform(sequence(2, most), x -> CAST(x AS STRING)), 'n_estimators', array('100', '200', '300'))"
            " ELSE map('C', array('0.1', '1.0', '10.0')) END"
        ).alias("space"),
    )
    picked = search.sample_trials(search.expand_trials(spaces, ["max_depth", "n_estimators", "C", "use_smote"]), 2)
    chosen = [
        (r.trial, r.family, dict(r.own))
        for r in picked.select("trial", "family", search.family_parameters(F.col("family"), F.col("params")).alias("own")).collect()
    ]
    results = models.run_trials(prepared_churn(spark, sf), chosen)
    return rounded(results.select("run_id", "model_name", "status", F.col("metrics")["f1"].alias("f1"), F.col("metrics")["roc_auc"].alias("roc_auc")), 4)


@plans.query("batch_score_model")
def batch_score_model(spark, sf):
    """Scores of the whole churn view by a fitted model, per geography."""
    prepared = prepared_churn(spark, sf)
    train, _ = models.training_sides(prepared)
    fitted = models.train_model(train, "logreg", prepared.features, prepared.target)
    scored = fitted.transform(models.fill_gaps(prepared.data, prepared.side("train"), prepared.features))
    return rounded(scored.groupBy("geography", "split").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score")), 4)


@plans.query("smoke_job")
def smoke_job(spark, sf):
    return rounded(models.smoke(
        churn_view(spark, sf), target=CHURN_TARGET, key="customer_id", drop=["customer_id", "surname"],
        categorical=CHURN_CATEGORICAL, config=ValidationConfig(target_column=CHURN_TARGET),
    ), 4)
