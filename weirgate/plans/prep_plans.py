"""Preparation, resampling and evaluation over the churn view."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.operators import evaluate, prep
from weirgate.operators.smote import smote
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import hash52_sql, uniform_sql, with_churn
from weirgate.session import cut_lineage
from weirgate.sources.tables import (
    CHURN_CATEGORICAL,
    CHURN_NUMERIC,
    CHURN_TARGET,
    churn_view,
    labelled_documents,
    table,
)

plans = Registry()

# Largest-remainder quotas per class and the hash-ordered choice of test rows.
SPLIT_SQL = f"""
sizes AS (SELECT exited, count(*) AS n FROM churn GROUP BY exited),
shares AS (
  SELECT exited, n, n * 1.0 * (t - CAST(ceil(0.2 * t) AS BIGINT)) / t AS share,
         t - CAST(ceil(0.2 * t) AS BIGINT) AS train
  FROM sizes, (SELECT CAST(sum(n) AS BIGINT) AS t FROM sizes)
),
quotas AS (
  SELECT exited, n - (CAST(floor(share) AS BIGINT)
           + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, exited)
                       <= train - (SELECT CAST(sum(floor(share)) AS BIGINT) FROM shares)
                  THEN 1 ELSE 0 END) AS test_rows
  FROM shares
),
split_rows AS (
  SELECT c.*, CASE WHEN row_number() OVER (PARTITION BY c.exited ORDER BY {hash52_sql(42, "customer_id")}, customer_id)
                        <= q.test_rows THEN 'test' ELSE 'train' END AS split
  FROM churn c JOIN quotas q ON c.exited = q.exited
)"""


@plans.query(
    "drop_columns",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def drop_columns(spark, sf):
    kept, _ = prep.remove_columns(table(spark, sf, "orders"), ["o_custkey", "o_orderdate", "no_such"])
    return kept


@plans.query(
    "strat_split",
    with_churn("SELECT customer_id, exited, split FROM split_rows", SPLIT_SQL),
)
def strat_split(spark, sf):
    churn = cut_lineage(churn_view(spark, sf).select("customer_id", CHURN_TARGET))
    rule = prep.fit_split(churn, CHURN_TARGET, "customer_id", 0.2, 42)
    return prep.split(churn, rule).select("customer_id", CHURN_TARGET, "split")


@plans.query(
    "plain_split",
    f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {hash52_sql(7, "doc_id")}, doc_id)
                              <= (SELECT CAST(ceil(0.25 * count(*)) AS BIGINT) FROM labels)
                         THEN 'test' ELSE 'train' END AS split FROM labels""",
)
def plain_split(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id")
    return prep.split(labels, prep.fit_split(labels, "", "doc_id", 0.25, 7, stratify=False))


@plans.query(
    "label_encode",
    with_churn(
        """SELECT s.customer_id, g.code AS geography, m.code AS segment
           FROM split_rows s
           LEFT JOIN (SELECT geography, CAST(row_number() OVER (ORDER BY geography) - 1 AS INTEGER) AS code
                      FROM (SELECT DISTINCT geography FROM split_rows WHERE split = 'train')) g
             ON s.geography = g.geography
           LEFT JOIN (SELECT segment, CAST(row_number() OVER (ORDER BY segment) - 1 AS INTEGER) AS code
                      FROM (SELECT DISTINCT segment FROM split_rows WHERE split = 'train')) m
             ON s.segment = m.segment""",
        SPLIT_SQL,
    ),
)
def label_encode(spark, sf):
    churn = cut_lineage(churn_view(spark, sf))
    rows = prep.split(churn, prep.fit_split(churn, CHURN_TARGET, "customer_id", 0.2, 42))
    encoders = prep.fit_encoders(rows.where("split = 'train'"), CHURN_CATEGORICAL)
    return prep.encode(rows, encoders, CHURN_CATEGORICAL).select("customer_id", *CHURN_CATEGORICAL)


@plans.query(
    "encoder_table",
    """SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
       FROM (SELECT DISTINCT 'lang' AS "column", lang AS value FROM documents
             UNION ALL SELECT DISTINCT 'source', source FROM documents)""",
)
def encoder_table(spark, sf):
    return prep.fit_encoders(table(spark, sf, "documents").select("lang", "source"), ["lang", "source"])


@plans.query(
    "code_lookup",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_partkey, l.l_suppkey, f.code AS l_returnflag
       FROM lineitem l LEFT JOIN (
         SELECT l_returnflag, CAST(row_number() OVER (ORDER BY l_returnflag) - 1 AS INTEGER) AS code
         FROM (SELECT DISTINCT l_returnflag FROM lineitem WHERE l_returnflag <> 'R')) f
       ON l.l_returnflag = f.l_returnflag""",
)
def code_lookup(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag"
    )
    known = prep.fit_encoders(lines.where("l_returnflag <> 'R'"), ["l_returnflag"])
    return prep.encode(lines, known, ["l_returnflag"], on_unseen="null")


@plans.query(
    "standard_scale",
    with_churn(
        "SELECT customer_id, split, "
        + ", ".join(
            f"round(({c} - (SELECT avg({c}) FROM split_rows WHERE split = 'train')) / "
            f"(SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END"
            f" FROM split_rows WHERE split = 'train'), 6) AS {c}"
            for c in CHURN_NUMERIC
        )
        + " FROM split_rows",
        SPLIT_SQL,
    ),
)
def standard_scale(spark, sf):
    churn = cut_lineage(churn_view(spark, sf))
    rows = prep.split(churn, prep.fit_split(churn, CHURN_TARGET, "customer_id", 0.2, 42))
    scaler = prep.fit_scaler(rows.where("split = 'train'"), CHURN_NUMERIC)
    return rounded(scaler.apply(rows).select("customer_id", "split", *CHURN_NUMERIC))


@plans.query(
    "prep_summary",
    with_churn(
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE split = 'train') AS train_rows,
                  count(*) FILTER (WHERE split = 'test') AS test_rows, round(avg(exited), 6) AS label_rate,
                  round(avg(exited) FILTER (WHERE split = 'train'), 6) AS train_label_rate,
                  round(avg(exited) FILTER (WHERE split = 'test'), 6) AS test_label_rate,
                  'credit_score,geography,segment,age,tenure,balance,num_products,has_cr_card,is_active,salary'
                    AS feature_names,
                  'geography,segment' AS encoded_columns,
                  'credit_score,age,tenure,balance,num_products,has_cr_card,is_active,salary' AS scaled_columns,
                  'customer_id,surname' AS dropped_columns
           FROM split_rows""",
        SPLIT_SQL,
    ),
)
def prep_summary(spark, sf):
    prepared = prep.prepare(
        churn_view(spark, sf), target=CHURN_TARGET, key="customer_id",
        drop=["row_number", "customer_id", "surname"], categorical=CHURN_CATEGORICAL,
    )
    flat = prepared.metadata()
    lists = [c for c, t in flat.dtypes if t.startswith("array")]
    return rounded(flat.withColumns({c: F.concat_ws(",", c) for c in lists}))


@plans.query(
    "positive_weight",
    """SELECT count(*) FILTER (WHERE toxic = 0) AS negatives, count(*) FILTER (WHERE toxic = 1) AS positives,
              round(count(*) FILTER (WHERE toxic = 0) * 1.0 / count(*) FILTER (WHERE toxic = 1), 6)
                AS scale_pos_weight FROM labels""",
)
def positive_weight(spark, sf):
    return rounded(prep.positive_weight(table(spark, sf, "labels"), "toxic"))


@plans.query(
    "class_weights",
    """SELECT l_returnflag, count(*) AS n,
              round((SELECT count(*) FROM lineitem) * 1.0
                    / ((SELECT count(DISTINCT l_returnflag) FROM lineitem) * count(*)), 6) AS weight
       FROM lineitem GROUP BY l_returnflag""",
)
def class_weights(spark, sf):
    return rounded(prep.class_weights(table(spark, sf, "lineitem"), "l_returnflag"))


SMOTE_FEATURES = {
    "balance": "balance / CAST(10 AS DOUBLE)",
    "tenure": "CAST(tenure AS DOUBLE)",
    "salary": "salary / CAST(1000 AS DOUBLE)",
    "num_products": "num_products",
}

_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in SMOTE_FEATURES)


@plans.query(
    "smote",
    with_churn(
        "SELECT customer_id, exited, round(balance, 6) AS balance, round(tenure, 6) AS tenure,"
        " round(salary, 6) AS salary, num_products, CAST(NULL AS BIGINT) AS draw FROM pts"
        " UNION ALL SELECT b.customer_id, 1, round(b.balance + u * (n.balance - b.balance), 6),"
        " round(b.tenure + u * (n.tenure - b.tenure), 6), round(b.salary + u * (n.salary - b.salary), 6),"
        " CAST(trunc(b.num_products + u * (n.num_products - b.num_products)) AS BIGINT), draw"
        " FROM drawn d JOIN pts b ON d.customer_id = b.customer_id"
        " JOIN near r ON r.customer_id = d.customer_id AND r.rank = d.pick"
        " JOIN pts n ON n.customer_id = r.other",
        "pts AS (SELECT customer_id, exited, "
        + ", ".join(f"{e} AS {c}" for c, e in SMOTE_FEATURES.items())
        + " FROM churn WHERE tenure IS NOT NULL)",
        f"""near AS (
          SELECT a.customer_id, b.customer_id AS other,
                 row_number() OVER (PARTITION BY a.customer_id ORDER BY {_D2}, b.customer_id) - 1 AS rank
          FROM pts a JOIN pts b ON a.customer_id <> b.customer_id AND a.exited = 1 AND b.exited = 1)""",
        f"""drawn AS (
          SELECT customer_id, draw, CAST(floor({uniform_sql("42n", "customer_id", "draw")} * 5) AS BIGINT) AS pick,
                 {uniform_sql("42u", "customer_id", "draw")} AS u
          FROM (SELECT customer_id, unnest(range(copies)) AS draw FROM (
                  SELECT customer_id, need // n + CASE WHEN place <= need % n THEN 1 ELSE 0 END AS copies
                  FROM (SELECT customer_id, row_number() OVER (ORDER BY {hash52_sql(42, "customer_id")}, customer_id) AS place
                        FROM pts WHERE exited = 1),
                       (SELECT count(*) FILTER (WHERE exited = 1) AS n,
                               count(*) FILTER (WHERE exited = 0) - count(*) FILTER (WHERE exited = 1) AS need
                        FROM pts))))""",
    ),
)
def smote_churn(spark, sf):
    points = cut_lineage(
        churn_view(spark, sf).where("tenure is not null").select(
            "customer_id", CHURN_TARGET, *[F.expr(e).alias(c) for c, e in SMOTE_FEATURES.items()]
        )
    )
    return rounded(smote(points, list(SMOTE_FEATURES), CHURN_TARGET, "customer_id"))


_SCORE = "CAST((n_chars * 7 + doc_id * 13) % 1000 AS DOUBLE) / 1000"
_SCORED_SQL = f"""WITH d AS (
  SELECT lang, source, toxic, {_SCORE} AS score FROM labels JOIN documents USING (doc_id))"""


def scored_documents(spark, sf):
    return labelled_documents(spark, sf).withColumn("score", F.expr(_SCORE)).withColumn(
        "prediction", (F.col("score") >= 0.3).cast("int")
    )


def _confusion_sql(group: str) -> str:
    counts = (
        "count(*) FILTER (WHERE toxic = 1 AND score >= 0.3) AS tp,"
        " count(*) FILTER (WHERE toxic = 0 AND score >= 0.3) AS fp,"
        " count(*) FILTER (WHERE toxic = 1 AND score < 0.3) AS fn,"
        " count(*) FILTER (WHERE toxic = 0 AND score < 0.3) AS tn"
    )
    return (
        f"{_SCORED_SQL}, c AS (SELECT {group}{', ' if group else ''}{counts} FROM d {'GROUP BY ' + group if group else ''})"
        " SELECT *, round((tp + tn) * 1.0 / (tp + fp + fn + tn), 6) AS accuracy,"
        " CASE WHEN tp + fp = 0 THEN 0.0 ELSE round(tp * 1.0 / (tp + fp), 6) END AS precision,"
        " CASE WHEN tp + fn = 0 THEN 0.0 ELSE round(tp * 1.0 / (tp + fn), 6) END AS recall,"
        " CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2.0 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM c"
    )


@plans.query("confusion_metrics", _confusion_sql(""))
def confusion_metrics(spark, sf):
    return rounded(evaluate.confusion_metrics(scored_documents(spark, sf), "toxic", "prediction"))


@plans.query("confusion_by_source", _confusion_sql("source"))
def confusion_by_source(spark, sf):
    return rounded(evaluate.confusion_metrics(scored_documents(spark, sf), "toxic", "prediction", ["source"]))


def _auc_sql(group: str) -> str:
    part = f"PARTITION BY {group} " if group else ""
    key = f"{group}, " if group else ""
    return (
        f"{_SCORED_SQL}, g AS (SELECT {key}score, count(*) FILTER (WHERE toxic = 1) AS p,"
        f" count(*) FILTER (WHERE toxic = 0) AS n FROM d GROUP BY {key}score),"
        f" r AS (SELECT *, coalesce(sum(n) OVER ({part}ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING"
        f" AND 1 PRECEDING), 0) AS below FROM g)"
        f" SELECT {key}CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,"
        f" CASE WHEN sum(p) = 0 OR sum(n) = 0 THEN 0.5"
        f" ELSE round(sum(p * (below + 0.5 * n)) / (sum(p) * sum(n)), 6) END AS roc_auc"
        f" FROM r {'GROUP BY ' + group if group else ''}"
    )


@plans.query("roc_auc", _auc_sql(""))
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(scored_documents(spark, sf), "toxic", "score"))


@plans.query("roc_auc_by_source", _auc_sql("source"))
def roc_auc_by_source(spark, sf):
    return rounded(evaluate.roc_auc(scored_documents(spark, sf), "toxic", "score", ["source"]))
