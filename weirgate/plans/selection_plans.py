"""Winner selection, search spaces and winner configs over derived trials."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.operators import search, select
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import hash52_sql
from weirgate.sources.artifacts import parse_candidate_metrics
from weirgate.sources.derived import derived, derived_sql, trials
from weirgate.sources.tables import spread, table

plans = Registry()

_RANK = "CASE model_name WHEN 'logreg' THEN 0 WHEN 'rf' THEN 1 WHEN 'xgboost' THEN 2 ELSE 3 END"


@plans.query(
    "select_winner",
    f"""WITH {derived_sql("trials")},
    c AS (SELECT *, coalesce(roc_auc, CAST('-infinity' AS DOUBLE)) AS s, {_RANK} AS rnk FROM trials),
    p AS (SELECT * FROM (SELECT *, max(f1) OVER (PARTITION BY sweep_id) AS top FROM c) WHERE f1 = top),
    b AS (SELECT *, s = max(s) OVER (PARTITION BY sweep_id) AS both_tied FROM p),
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sweep_id ORDER BY rnk, model_name, run_id) AS place
                         FROM b WHERE both_tied) WHERE place = 1),
    n AS (SELECT b.sweep_id, count(*) AS np, count(*) FILTER (WHERE b.both_tied) AS nb,
                 count(*) FILTER (WHERE b.both_tied AND b.rnk = w.rnk) AS nr,
                 string_agg(DISTINCT b.model_name, ',' ORDER BY b.model_name) AS pn,
                 string_agg(DISTINCT b.model_name, ',' ORDER BY b.model_name) FILTER (WHERE b.both_tied) AS bn
          FROM b JOIN w ON b.sweep_id = w.sweep_id GROUP BY b.sweep_id)
    SELECT w.sweep_id, w.model_name, w.run_id, round(w.f1, 6) AS score,
           CASE WHEN np = 1 THEN 'primary_metric' WHEN nb = 1 THEN 'secondary_metric'
                WHEN nr = 1 THEN 'family_priority' ELSE 'final_fallback' END AS tie_break_reason,
           CASE WHEN np > 1 AND nb = 1 THEN pn ELSE bn END AS tie_candidates,
           CASE WHEN np > 1 AND nb = 1 THEN np ELSE nb END AS tied
    FROM w JOIN n ON w.sweep_id = n.sweep_id""",
)
def select_winner(spark, sf):
    won = select.select_winner(trials(spark, sf))
    return rounded(won.withColumn("tie_candidates", F.concat_ws(",", "tie_candidates")))


@plans.query(
    "family_priority",
    f"""WITH {derived_sql("trials")}
    SELECT model_name, {_RANK} AS priority, count(*) AS n FROM trials GROUP BY model_name""",
)
def family_priority(spark, sf):
    rows = trials(spark, sf)
    return rows.groupBy("model_name", select.family_rank(F.col("model_name")).alias("priority")).agg(
        F.count("*").alias("n")
    )


@plans.query(
    "missing_metric",
    f"""WITH {derived_sql("trials")} SELECT sweep_id, model_name, run_id FROM trials WHERE roc_auc IS NULL""",
)
def missing_metric(spark, sf):
    return select.without_metric(trials(spark, sf), "roc_auc")


@plans.query(
    "best_f1",
    f"""WITH {derived_sql("trials")}
    SELECT sweep_id, model_name, run_id, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc FROM (
      SELECT *, row_number() OVER (PARTITION BY sweep_id ORDER BY f1 DESC, seq) AS place FROM trials) WHERE place = 1""",
)
def best_f1(spark, sf):
    best = select.best_by(trials(spark, sf), "f1", "seq", ["sweep_id"])
    return rounded(
        best.select("sweep_id", "model_name", "run_id", F.col("metrics")["f1"].alias("f1"), F.col("metrics")["roc_auc"].alias("roc_auc"))
    )


_SWEEPS = {
    "seq": "o_orderkey",
    "grp": "o_custkey",
    "model_name": "CASE o_orderkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'xgboost' END",
    "best_run_id": "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE concat('child-', o_orderkey) END",
    "score": "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' ELSE concat('0.', o_orderkey % 9 + 1) END",
}
_SWEEPS_SQL = "sweeps AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _SWEEPS.items()) + " FROM orders)"


@plans.query(
    "best_overall",
    f"""WITH {_SWEEPS_SQL}
    SELECT grp, model_name, best_run_id, CAST(score AS DOUBLE) AS metric FROM (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY TRY_CAST(score AS DOUBLE) DESC, seq) AS place
      FROM sweeps WHERE best_run_id IS NOT NULL AND TRY_CAST(score AS DOUBLE) IS NOT NULL) WHERE place = 1""",
)
def best_overall(spark, sf):
    sweeps = table(spark, sf, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _SWEEPS.items()])
    return select.best_overall(sweeps, ["grp"])


@plans.query(
    "candidate_metrics",
    f"""WITH {derived_sql("trials")}
    SELECT sweep_id, model_name, run_id, 'f1' AS metric, round(f1, 6) AS value FROM trials
    UNION ALL SELECT sweep_id, model_name, run_id, 'roc_auc', round(roc_auc, 6) FROM trials WHERE roc_auc IS NOT NULL""",
)
def candidate_metrics(spark, sf):
    rows = derived(spark, sf, "trials")
    text = F.concat(
        F.lit('{"model_name":"'), "model_name", F.lit('","run_id":"'), "run_id", F.lit('","f1":'), "f1",
        F.coalesce(F.concat(F.lit(',"roc_auc":'), "roc_auc"), F.lit("")), F.lit("}"),
    )
    parsed = parse_candidate_metrics(rows.select("sweep_id", text.alias("line")), keep=["sweep_id"])
    return rounded(select.metrics_long(parsed))


@plans.query(
    "metrics_text",
    f"""WITH {derived_sql("trials")}
    SELECT sweep_id, model_name, run_id,
           printf('f1=%.4f', f1) || CASE WHEN roc_auc IS NULL THEN '' ELSE printf(', roc_auc=%.4f', roc_auc) END AS metrics_text
    FROM trials""",
)
def metrics_text(spark, sf):
    return select.metrics_text(trials(spark, sf))


_BUNDLES_SQL = """
bundles AS (SELECT sweep_id, model_name, concat('out/', sweep_id, '/model') AS model_output,
                   concat('bundle/', sweep_id) AS hpo_manifest
            FROM (SELECT DISTINCT sweep_id, model_name FROM trials) WHERE model_name <> 'svm'),
manifests AS (SELECT sweep_id, model_name,
                     CASE WHEN sweep_id % 3 = 0 THEN NULL ELSE concat('manifest/', sweep_id) END AS hpo_manifest
              FROM (SELECT DISTINCT sweep_id, model_name FROM trials) WHERE model_name <> 'rf')"""


@plans.query(
    "family_artifacts",
    f"""WITH {derived_sql("trials")}, {_BUNDLES_SQL}
    SELECT t.sweep_id, t.model_name, t.run_id, b.model_output,
           coalesce(m.hpo_manifest, b.hpo_manifest) AS hpo_manifest
    FROM trials t LEFT JOIN bundles b ON t.sweep_id = b.sweep_id AND t.model_name = b.model_name
                  LEFT JOIN manifests m ON t.sweep_id = m.sweep_id AND t.model_name = m.model_name""",
)
def family_artifacts(spark, sf):
    rows = trials(spark, sf)
    families = rows.select("sweep_id", "model_name").distinct()
    bundles = families.where("model_name <> 'svm'").select(
        "sweep_id", "model_name",
        F.expr("map('model_output', concat('out/', sweep_id, '/model'), 'hpo_manifest', concat('bundle/', sweep_id))").alias("paths"),
    )
    manifests = families.where("model_name <> 'rf'").select(
        "sweep_id", "model_name",
        F.expr("map('hpo_manifest', CASE WHEN sweep_id % 3 = 0 THEN NULL ELSE concat('manifest/', sweep_id) END)").alias("paths"),
    )
    joined = select.with_family_artifacts(rows, bundles, manifests)
    return joined.select(
        "sweep_id", "model_name", "run_id",
        F.col("artifacts")["model_output"].alias("model_output"), F.col("artifacts")["hpo_manifest"].alias("hpo_manifest"),
    )


@plans.query(
    "family_union",
    f"""WITH {derived_sql("trials")},
    seen AS (SELECT sweep_id, model_name, max(run_id) AS run_id FROM trials WHERE model_name <> 'svm' GROUP BY 1, 2),
    man AS (SELECT DISTINCT sweep_id, model_name FROM trials WHERE model_name <> 'rf'),
    two AS (SELECT *, sweep_id % 2 = 0 AS has_train, 'ok' AS hpo FROM man)
    SELECT coalesce(s.sweep_id, t.sweep_id) AS sweep_id, coalesce(s.model_name, t.model_name) AS model_name, run_id,
           coalesce(hpo, 'missing') AS hpo_status, CASE WHEN has_train THEN 'partial' ELSE 'missing' END AS train_status,
           CASE WHEN t.sweep_id IS NULL THEN '' WHEN has_train THEN concat('h', t.sweep_id, '|t1|t2') ELSE concat('h', t.sweep_id) END AS warnings
    FROM seen s FULL OUTER JOIN two t ON s.sweep_id = t.sweep_id AND s.model_name = t.model_name""",
)
def family_union(spark, sf):
    rows = trials(spark, sf)
    families = rows.where("model_name <> 'rf'").select("sweep_id", "model_name").distinct()
    hpo = families.select("*", F.lit("hpo").alias("kind"), F.lit("ok").alias("status"),
                          F.array(F.concat(F.lit("h"), F.col("sweep_id"))).alias("warnings"))
    train = families.where("sweep_id % 2 = 0").select(
        "*", F.lit("train").alias("kind"), F.lit("partial").alias("status"), F.array(F.lit("t1"), F.lit("t2")).alias("warnings"))
    report = select.family_report(rows.where("model_name <> 'svm'"), hpo.unionByName(train))
    return report.withColumn("warnings", F.concat_ws("|", "warnings"))


@plans.query(
    "winner_consistency",
    f"""WITH {derived_sql("winner_summaries")}, {derived_sql("winner_manifests")}, {derived_sql("winner_train_configs")}
    SELECT s.run_id, s.family, m.family AS manifest_family, c.family AS config_family,
           CASE WHEN m.family IS NULL OR m.family <> s.family THEN 'winner_manifest' ELSE 'winner_train_config' END AS mismatch
    FROM winner_summaries s
    LEFT JOIN (SELECT * FROM winner_manifests WHERE run_id % 101 <> 0) m ON s.run_id = m.run_id
    LEFT JOIN (SELECT * FROM winner_train_configs WHERE run_id % 2 = 0) c ON s.run_id = c.run_id
    WHERE m.family IS NULL OR m.family <> s.family OR c.family <> s.family""",
)
def winner_consistency(spark, sf):
    return select.winner_mismatches(
        derived(spark, sf, "winner_summaries"),
        derived(spark, sf, "winner_manifests").where("run_id % 101 <> 0"),
        derived(spark, sf, "winner_train_configs").where("run_id % 2 = 0"),
    )


# One search per customer: the number of choices follows the nation key.
def spaces(spark, sf):
    return spread(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey").select(
        F.col("c_custkey").alias("sweep_id"),
        F.expr("CASE c_custkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'svm' END").alias("family"),
        F.expr("map('use_smote', array('true', CAST(NULL AS STRING)))").alias("shared"),
        F.expr(
            "CASE WHEN c_custkey % 3 = 2 THEN map() ELSE map("
            "'depth', transform(sequence(1, 1 + c_nationkey % 3), x -> CAST(x AS STRING)),"
            "'leaf', array('1', CAST(NULL AS STRING), '4')) END"
        ).cast("map<string,array<string>>").alias("space"),
    )


_TRIALS_SQL = """
grid AS (
  SELECT c_custkey AS sweep_id, CASE c_custkey % 3 WHEN 0 THEN 'rf' ELSE 'logreg' END AS family, d AS depth, l AS leaf
  FROM (SELECT c_custkey, unnest(range(1, 2 + c_nationkey % 3)) AS d, c_nationkey FROM customer WHERE c_custkey % 3 <> 2) a,
       (VALUES ('1'), ('4')) b(l)
),
keyed AS (SELECT *, concat(family, '_depth=', depth, ',', family, '_leaf=', leaf, ',use_smote=true') AS trial FROM grid)"""


@plans.query("search_space", f"WITH {_TRIALS_SQL} SELECT sweep_id, family, trial FROM keyed")
def search_space(spark, sf):
    grid = search.expand_trials(spaces(spark, sf), ["depth", "leaf", "use_smote"])
    return grid.select("sweep_id", "family", search.trial_key(F.col("params")).alias("trial"))


@plans.query(
    "trial_sample",
    f"""WITH {_TRIALS_SQL}
    SELECT sweep_id, family, replace(trial, concat(family, '_'), concat(family, '.')) AS overrides, CAST(place AS INTEGER) AS trial_no FROM (
      SELECT *, row_number() OVER (PARTITION BY sweep_id, family ORDER BY {hash52_sql(42, "sweep_id", "trial")}, trial) AS place
      FROM keyed) WHERE place <= 2""",
)
def trial_sample(spark, sf):
    grid = search.expand_trials(spaces(spark, sf), ["depth", "leaf", "use_smote"])
    picked = search.sample_trials(grid, 2)
    return picked.select(
        "sweep_id", "family", search.trial_key(search.override_keys(F.col("params"))).alias("overrides"), "trial_no"
    )


@plans.query(
    "winner_config",
    """SELECT o_orderkey AS sweep_id, CASE o_orderkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'xgboost' END AS models,
              concat('C=', CASE WHEN o_orderkey % 2 = 0 THEN concat('float:', o_custkey, '.5') ELSE concat('int:', o_custkey) END,
                     ',flag=bool:true,min_samples_split=int:', greatest(o_orderkey % 15, 2), ',tol=text:1e-3') AS hyperparameters,
              'balanced' AS class_weight, CAST(42 AS BIGINT) AS random_state, o_orderkey % 2 = 0 AS use_smote
       FROM orders""",
)
def winner_config(spark, sf):
    orders = table(spark, sf, "orders")
    family = "CASE o_orderkey % 3 WHEN 0 THEN 'rf' WHEN 1 THEN 'logreg' ELSE 'xgboost' END"
    winners = orders.select(F.col("o_orderkey").alias("sweep_id"), F.expr(family).alias("model_name"))
    manifests = orders.select(
        F.col("o_orderkey").alias("sweep_id"),
        F.expr(family).alias("model_name"),
        F.expr(
            f"map(concat({family}, '_C'), CASE WHEN o_orderkey % 2 = 0 THEN concat(o_custkey, '.5') ELSE CAST(o_custkey AS STRING) END,"
            f" concat({family}, '_flag'), ' TRUE ', concat({family}, '_tol'), '1e-3',"
            f" concat({family}, '_min_samples_split'), CAST(o_orderkey % 15 AS STRING),"
            " 'svm_C', '9', 'class_weight', 'balanced', 'random_state', '42',"
            " 'use_smote', CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'off' END)"
        ).alias("params"),
    )
    config = search.winner_configs(winners, manifests)
    clamped = F.transform_values(
        "hyperparameters",
        lambda k, v: F.concat(
            v["kind"], F.lit(":"),
            F.when((k == "min_samples_split") & (v["value"].try_cast("double") < 2), "2").otherwise(v["value"]),
        ),
    )
    return config.select(
        "sweep_id", F.concat_ws(",", "models").alias("models"), search.trial_key(clamped).alias("hyperparameters"),
        "class_weight", "random_state", "use_smote",
    )


_GRID = [f"p{i}" for i in range(12)]


@plans.query(
    "trial_sample_grid",
    """SELECT c_custkey AS sweep_id, 'rf' AS family, least(24, n) AS trials, least(24, n) AS different, true AS from_choices
       FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 1000000000000 WHEN 1 THEN 12 ELSE 30 END AS n FROM customer)""",
)
def trial_sample_grid(spark, sf):
    """24 trials of each customer's grid: 10**12 points, 12 or 30."""
    kind = F.col("c_custkey") % 3
    values = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: x.cast("string"))

    def some(n):
        return F.slice(values, 1, n)

    few = F.when(kind == 1, F.create_map(F.lit("p0"), some(4), F.lit("p5"), some(3), F.lit("p7"), F.array(F.lit(None).cast("string"))))
    spaces = spread(table(spark, sf, "customer").select("c_custkey"), "c_custkey").select(
        F.col("c_custkey").alias("sweep_id"), F.lit("rf").alias("family"),
        F.create_map().cast("map<string,array<string>>").alias("shared"),
        F.when(kind == 0, F.create_map(*[x for p in _GRID for x in (F.lit(p), some(10))])).otherwise(
            few.otherwise(F.create_map(F.lit("p1"), some(10), F.lit("p2"), some(3)))
        ).alias("space"),
    )
    trials = search.sample_grid(spaces, _GRID, 24)
    digits = F.forall(F.map_values("params"), lambda v: v.rlike("^[0-9]$"))
    return trials.groupBy("sweep_id", "family").agg(
        F.count("*").alias("trials"), F.count_distinct(search.trial_key(F.col("params"))).alias("different"), F.bool_and(digits).alias("from_choices")
    )
