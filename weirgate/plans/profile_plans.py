"""Exploratory profile of the churn view and of the raw tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.operators import profile
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import CHURN_LONG_SQL, with_churn
from weirgate.sources.tables import (
    CHURN_CATEGORICAL,
    CHURN_ID_COLUMNS,
    CHURN_NUMERIC,
    CHURN_TARGET,
    churn_view,
    labelled_documents,
    table,
)

plans = Registry()

CHURN_COLUMNS = [*CHURN_ID_COLUMNS, *CHURN_CATEGORICAL, *CHURN_NUMERIC, CHURN_TARGET]
CHURN_TYPES = {
    "customer_id": "bigint", "surname": "string", "geography": "string", "segment": "string",
    "credit_score": "double", "age": "int", "tenure": "int", "balance": "double",
    "num_products": "bigint", "has_cr_card": "int", "is_active": "int", "salary": "double",
    "exited": "int",
}


def _per_column_sql(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c, t=CHURN_TYPES[c]) for c in CHURN_COLUMNS)


@plans.query(
    "label_rate_by_group",
    with_churn(
        "SELECT geography, count(*) AS n, round(avg(exited), 6) AS label_rate"
        " FROM churn GROUP BY geography"
    ),
)
def label_rate_by_group(spark, sf):
    return rounded(profile.label_rate(churn_view(spark, sf), CHURN_TARGET, ["geography"]))


@plans.query(
    "label_rate_overall",
    with_churn("SELECT count(*) AS n, round(avg(exited), 6) AS label_rate FROM churn"),
)
def label_rate_overall(spark, sf):
    return rounded(profile.label_rate(churn_view(spark, sf), CHURN_TARGET))


@plans.query(
    "profile_counts",
    "SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem",
)
def profile_counts(spark, sf):
    return profile.table_counts(table(spark, sf, "lineitem"))


@plans.query(
    "column_info",
    with_churn(
        _per_column_sql("SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null_count FROM churn")
    ),
)
def column_info(spark, sf):
    return profile.column_info(churn_view(spark, sf), CHURN_COLUMNS)


@plans.query(
    "missing_fraction",
    with_churn(
        _per_column_sql(
            "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count,"
            " round(1.0 - count({c}) * 1.0 / count(*), 6) AS missing_fraction FROM churn"
        )
    ),
)
def missing_fraction(spark, sf):
    return rounded(profile.missing_by_column(churn_view(spark, sf), CHURN_COLUMNS))


@plans.query(
    "max_missing_fraction",
    with_churn(
        "SELECT round(max(f), 6) AS max_missing_fraction FROM ("
        + _per_column_sql("SELECT 1.0 - count({c}) * 1.0 / count(*) AS f FROM churn")
        + ")"
    ),
)
def max_missing_fraction(spark, sf):
    return rounded(profile.max_missing_fraction(churn_view(spark, sf)))


@plans.query(
    "missing_report",
    with_churn(
        "SELECT \"column\", missing_count FROM ("
        + _per_column_sql("SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count FROM churn")
        + ") WHERE missing_count > 0"
    ),
)
def missing_report(spark, sf):
    return profile.missing_report(churn_view(spark, sf))


@plans.query(
    "row_delta",
    """SELECT r AS reference_rows, c AS current_rows,
              round(abs(c - r) * 1.0 / greatest(r, 1), 6) AS row_count_delta_fraction
       FROM (SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS r,
                    count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS c FROM orders)""",
)
def row_delta(spark, sf):
    orders = table(spark, sf, "orders")
    early = orders.where("o_orderdate < timestamp_ntz '1998-01-01'")
    late = orders.where("o_orderdate >= timestamp_ntz '1998-01-01'")
    return rounded(profile.row_count_delta(early, late))


@plans.query(
    "duplicates",
    """SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count
       FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""",
)
def duplicates(spark, sf):
    return profile.duplicate_count(table(spark, sf, "documents").select("text", "lang"))


@plans.query(
    "cardinality",
    with_churn(
        _per_column_sql(
            "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_count,"
            " round(count(DISTINCT {c}) * 1.0 / count(*), 6) AS unique_ratio, '{t}' AS dtype FROM churn"
        )
    ),
)
def cardinality(spark, sf):
    return rounded(profile.cardinality(churn_view(spark, sf), CHURN_COLUMNS))


@plans.query(
    "high_cardinality",
    with_churn(
        "SELECT * FROM ("
        + _per_column_sql(
            "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_count,"
            " round(count(DISTINCT {c}) * 1.0 / count(*), 6) AS unique_ratio FROM churn"
        )
        + ") WHERE unique_ratio > 0.95"
    ),
)
def high_cardinality(spark, sf):
    return rounded(profile.high_cardinality_columns(churn_view(spark, sf), 0.95))


@plans.query(
    "describe",
    """WITH cells AS (
         SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
         UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
         UNION ALL SELECT 'l_discount', l_discount FROM lineitem
         UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
       SELECT "column", count(v) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std,
              round(min(v), 4) AS min, round(quantile_cont(v, 0.25), 4) AS q25,
              round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75,
              round(max(v), 4) AS max
       FROM cells GROUP BY "column" """,
)
def describe(spark, sf):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.describe(table(spark, sf, "lineitem"), columns), 4)


@plans.query(
    "value_counts",
    "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "lineitem"), "l_returnflag")


@plans.query(
    "crosstab",
    with_churn(
        "SELECT segment, count(*) FILTER (WHERE exited = 0) AS exited_0,"
        " count(*) FILTER (WHERE exited = 1) AS exited_1 FROM churn GROUP BY segment"
    ),
)
def crosstab(spark, sf):
    return profile.crosstab(churn_view(spark, sf), "segment", CHURN_TARGET)


@plans.query(
    "histogram",
    with_churn(
        """SELECT c."column", c.exited,
                  CAST(least(floor((value - low) / width), 29) AS BIGINT) AS bin,
                  round(low + least(floor((value - low) / width), 29) * width, 4) AS bin_start,
                  count(*) AS n, round(count(*) / (any_value(total) * any_value(width)), 4) AS density
           FROM churn_long c JOIN spans s ON c."column" = s."column" AND c.exited = s.exited
           WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4""",
        CHURN_LONG_SQL,
        """spans AS (
             SELECT "column", exited, count(value) AS total,
                    CASE WHEN max(value) = min(value) THEN min(value) - 0.5 ELSE min(value) END AS low,
                    CASE WHEN max(value) = min(value) THEN 1.0 / 30
                         ELSE (max(value) - min(value)) / 30 END AS width
             FROM churn_long GROUP BY "column", exited)""",
    ),
)
def histogram(spark, sf):
    return rounded(profile.histogram(churn_view(spark, sf), CHURN_NUMERIC, CHURN_TARGET), 4)


@plans.query(
    "boxplot",
    with_churn(
        """SELECT "column", exited, n, round(q25, 4) AS q25, round(q50, 4) AS q50, round(q75, 4) AS q75,
                  round(least(lo, q25), 4) AS whisker_low, round(greatest(hi, q75), 4) AS whisker_high,
                  outliers
           FROM (
             SELECT b."column", b.exited, count(*) AS n, q25, q50, q75,
                    min(value) FILTER (WHERE value >= q25 - 1.5 * (q75 - q25)) AS lo,
                    max(value) FILTER (WHERE value <= q75 + 1.5 * (q75 - q25)) AS hi,
                    count(*) FILTER (WHERE value < q25 - 1.5 * (q75 - q25)
                                        OR value > q75 + 1.5 * (q75 - q25)) AS outliers
             FROM churn_long c JOIN boxes b ON c."column" = b."column" AND c.exited = b.exited
             WHERE value IS NOT NULL GROUP BY b."column", b.exited, q25, q50, q75)""",
        CHURN_LONG_SQL,
        """boxes AS (
             SELECT "column", exited, quantile_cont(value, 0.25) AS q25,
                    quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
             FROM churn_long WHERE value IS NOT NULL GROUP BY "column", exited)""",
    ),
)
def boxplot(spark, sf):
    return rounded(profile.boxplot(churn_view(spark, sf), CHURN_NUMERIC, CHURN_TARGET), 4)


_PAIRS = [(a, b) for a in CHURN_NUMERIC for b in CHURN_NUMERIC if a != b]


@plans.query(
    "corr_matrix",
    with_churn(
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS corr FROM churn"
            for a, b in _PAIRS
        )
        + "".join(f" UNION ALL SELECT '{c}', '{c}', CAST(1.0 AS DOUBLE)" for c in CHURN_NUMERIC)
    ),
)
def corr_matrix(spark, sf):
    return rounded(profile.correlation_matrix(churn_view(spark, sf), CHURN_NUMERIC))


@plans.query(
    "corr_target",
    with_churn(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(corr({c}, exited), 6) AS corr FROM churn"
            for c in CHURN_NUMERIC
        )
    ),
)
def corr_target(spark, sf):
    return rounded(profile.correlation_with(churn_view(spark, sf), CHURN_NUMERIC, CHURN_TARGET))


_DOC_TYPES = {"doc_id": "bigint", "lang": "string", "source": "string", "n_chars": "bigint",
              "quality": "int", "toxic": "int"}


@plans.query(
    "summary_profile",
    "WITH d AS (SELECT l.doc_id, lang, source, n_chars, quality, toxic FROM labels l"
    " JOIN documents USING (doc_id)) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS row_count, count(*) - count({c}) AS missing_count,"
        f" count(DISTINCT {c}) AS unique_count, CAST(min({c}) AS VARCHAR) AS min_text,"
        f" CAST(max({c}) AS VARCHAR) AS max_text, count(DISTINCT {c}) = 0 AS is_empty,"
        f" count(DISTINCT {c}) = 1 AS is_constant FROM d"
        for c in _DOC_TYPES
    ),
)
def summary_profile(spark, sf):
    return profile.summary_profile(labelled_documents(spark, sf))


@plans.query(
    "class_subset",
    with_churn("SELECT customer_id, geography, balance FROM churn WHERE exited = 1"),
)
def class_subset(spark, sf):
    return churn_view(spark, sf).where(f"{CHURN_TARGET} = 1").select(
        "customer_id", "geography", "balance"
    )


@plans.query(
    "head_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
)
def head_rows(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        "o_orderkey"
    ).limit(5)


@plans.query(
    "label_set",
    """SELECT count(DISTINCT toxic) AS classes, count(DISTINCT toxic) = 2 AS both_present FROM labels""",
)
def label_set(spark, sf):
    return table(spark, sf, "labels").agg(
        F.count_distinct("toxic").alias("classes"),
        (F.count_distinct("toxic") == 2).alias("both_present"),
    )
