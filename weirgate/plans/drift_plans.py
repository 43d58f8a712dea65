"""Drift statistics and the validation gate over the churn view and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.functions.pvalues import ks_exact_tail
from weirgate.operators import drift, sketches
from weirgate.operators.validate import ValidationConfig, validate
from weirgate.plans.common import Registry, rounded
from weirgate.plans.views import with_churn
from weirgate.session import cut_lineage, local_rows
from weirgate.sources.tables import CHURN_TARGET, churn_view, table

plans = Registry()

NUMERIC = ["balance", "age", "salary"]
CATEGORICAL = ["geography", "segment", "exited"]

# Customers with a low balance against those with a high one: balance drifts, the rest hardly.
HALVES_SQL = """
halves AS (SELECT *, CASE WHEN balance < 4500 THEN 0 ELSE 1 END AS side FROM churn)"""


def balance_halves(spark, sf, **kwargs):
    churn = cut_lineage(churn_view(spark, sf, **kwargs).drop("surname"))
    return churn.where("balance < 4500"), churn.where("balance >= 4500")


def _numeric_sql(final: str) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, side FROM halves" for c in NUMERIC)
    return with_churn(
        final,
        HALVES_SQL,
        f"cells AS (SELECT * FROM ({cells}) WHERE v IS NOT NULL)",
        """counted AS (SELECT "column", v, count(*) FILTER (WHERE side = 0) AS r,
                              count(*) FILTER (WHERE side = 1) AS c FROM cells GROUP BY "column", v)""",
        """cdf AS (
          SELECT "column", v, sum(r) OVER w / sum(r) OVER p - sum(c) OVER w / sum(c) OVER p AS gap,
                 lead(v) OVER w - v AS step, sum(r) OVER p AS rn, sum(c) OVER p AS cn
          FROM counted WINDOW w AS (PARTITION BY "column" ORDER BY v), p AS (PARTITION BY "column"))""",
    )


@plans.query(
    "ks_stat",
    _numeric_sql(
        'SELECT "column", CAST(max(rn) AS BIGINT) AS ref_n, CAST(max(cn) AS BIGINT) AS cur_n,'
        ' round(max(abs(gap)), 6) AS ks FROM cdf GROUP BY "column"'
    ),
)
def ks_stat(spark, sf):
    low, high = balance_halves(spark, sf)
    return rounded(drift.numeric_statistics(drift.stacked(low, high, NUMERIC), NUMERIC).drop("wasserstein"))


@plans.query(
    "wasserstein",
    _numeric_sql(
        """SELECT d."column", round(w / greatest(s, 0.001), 6) AS wasserstein
           FROM (SELECT "column", sum(abs(gap) * coalesce(step, 0)) AS w FROM cdf GROUP BY "column") d
           JOIN (SELECT "column", stddev_pop(v) AS s FROM cells WHERE side = 0 GROUP BY "column") s
             ON d."column" = s."column" """
    ),
)
def wasserstein(spark, sf):
    low, high = balance_halves(spark, sf)
    return rounded(
        drift.numeric_statistics(drift.stacked(low, high, NUMERIC), NUMERIC).select("column", "wasserstein")
    )


def _categorical_sql(final: str) -> str:
    cells = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v, side FROM halves" for c in CATEGORICAL)
    return with_churn(
        final,
        HALVES_SQL,
        f"cells AS ({cells})",
        """counted AS (SELECT "column", v, count(*) FILTER (WHERE side = 0) AS r,
                              count(*) FILTER (WHERE side = 1) AS c FROM cells GROUP BY "column", v)""",
        """shares AS (SELECT *, sum(r) OVER p AS rn, sum(c) OVER p AS cn, r / sum(r) OVER p AS p,
                             c / sum(c) OVER p AS q FROM counted WINDOW p AS (PARTITION BY "column"))""",
    )


def _categorical(spark, sf):
    low, high = balance_halves(spark, sf)
    return rounded(drift.categorical_statistics(drift.stacked(low, high, CATEGORICAL), CATEGORICAL))


@plans.query(
    "chi2_stat",
    _categorical_sql(
        'SELECT "column", CAST(max(rn) AS BIGINT) AS ref_n, CAST(max(cn) AS BIGINT) AS cur_n,'
        " count(*) AS categories, count(*) - 1 AS freedom,"
        ' round(sum((c - p * cn) * (c - p * cn) / (p * cn)), 6) AS chi2 FROM shares GROUP BY "column"'
    ),
)
def chi2_stat(spark, sf):
    return _categorical(spark, sf).select("column", "ref_n", "cur_n", "categories", "freedom", "chi2")


@plans.query(
    "prop_z",
    _categorical_sql(
        """SELECT "column", round((r / rn - c / cn) / sqrt(((r + c) / (rn + cn)) * (1 - (r + c) / (rn + cn))
                                   * (1 / rn + 1 / cn)), 6) AS z
           FROM shares WHERE "column" = 'exited' AND v = '0'"""
    ),
)
def prop_z(spark, sf):
    return _categorical(spark, sf).where("z is not null").select("column", "z")


@plans.query(
    "js_distance",
    _categorical_sql(
        """SELECT "column", round(sqrt(greatest(sum(
             CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
             + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 6) AS js
           FROM shares GROUP BY "column" """
    ),
)
def js_distance(spark, sf):
    return _categorical(spark, sf).select("column", "js")


@plans.query(
    "column_types",
    """SELECT * FROM (VALUES ('l_linenumber', CASE WHEN (SELECT count(DISTINCT l_linenumber) FROM lineitem) > 5 THEN 'num' ELSE 'cat' END),
         ('l_quantity', 'num'), ('l_returnflag', 'cat'), ('l_extendedprice', 'num')) AS t("column", kind)""",
)
def column_types(spark, sf):
    lines = table(spark, sf, "lineitem")
    kinds = drift.column_kinds(lines, ["l_linenumber", "l_quantity", "l_returnflag", "l_extendedprice"])
    return local_rows(spark, list(kinds.items()), "column string, kind string")


DRIFT_COLUMNS = [*NUMERIC, *CATEGORICAL]


def _score_sql(final: str) -> str:
    """``scores``: (column, method, score) of the distances of every column."""
    return with_churn(
        final,
        HALVES_SQL,
        "ncells AS (SELECT * FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v, side FROM halves" for c in NUMERIC)
        + ") WHERE v IS NOT NULL)",
        """ncount AS (SELECT "column", v, count(*) FILTER (WHERE side = 0) AS r, count(*) FILTER (WHERE side = 1) AS c
                      FROM ncells GROUP BY "column", v)""",
        """ncdf AS (SELECT "column", sum(r) OVER w / sum(r) OVER p - sum(c) OVER w / sum(c) OVER p AS gap,
                           lead(v) OVER w - v AS step
                    FROM ncount WINDOW w AS (PARTITION BY "column" ORDER BY v), p AS (PARTITION BY "column"))""",
        """nw AS (SELECT d."column", w, s FROM
                  (SELECT "column", sum(abs(gap) * coalesce(step, 0)) AS w FROM ncdf GROUP BY "column") d
                  JOIN (SELECT "column", stddev_pop(v) AS s FROM ncells WHERE side = 0 GROUP BY "column") s
                  ON d."column" = s."column")""",
        "ccells AS ("
        + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS v, side FROM halves" for c in CATEGORICAL)
        + ")",
        """cshare AS (SELECT "column", count(*) FILTER (WHERE side = 0) / sum(count(*) FILTER (WHERE side = 0)) OVER (PARTITION BY "column") AS p,
                             count(*) FILTER (WHERE side = 1) / sum(count(*) FILTER (WHERE side = 1)) OVER (PARTITION BY "column") AS q
                      FROM ccells GROUP BY "column", v)""",
        """cj AS (SELECT sqrt(greatest(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                  + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js, "column"
                  FROM cshare GROUP BY "column")""",
        """scores AS (SELECT "column", 'wasserstein' AS method, w / greatest(s, 0.001) AS score FROM nw
                      UNION ALL SELECT "column", 'jensenshannon', js FROM cj)""",
    )


@plans.query(
    "drift_report",
    _score_sql(
        """SELECT "column", method, round(score, 6) AS score, 0.1 AS threshold, score >= 0.1 AS drifted FROM scores"""
    ),
)
def drift_report(spark, sf):
    low, high = balance_halves(spark, sf)
    return rounded(drift.drift_report(low, high, DRIFT_COLUMNS))


# Distances named column by column, as a caller may.
DISTANCES = {**{c: "wasserstein" for c in NUMERIC}, **{c: "jensenshannon" for c in CATEGORICAL}}


@plans.query(
    "drift_share",
    _score_sql(
        "SELECT CAST(count(*) FILTER (WHERE score >= 0.1) AS DOUBLE) AS drifted_column_count,"
        " round(count(*) FILTER (WHERE score >= 0.1) * 1.0 / count(*), 6) AS drifted_column_share FROM scores"
    ),
)
def drift_share(spark, sf):
    low, high = balance_halves(spark, sf)
    return rounded(drift.drift_summary(drift.drift_report(low, high, DRIFT_COLUMNS, method=DISTANCES)))


# --- sketches --------------------------------------------------------------------------

# The intervals depend on how rows are cut into tasks, the exact figures and their place do not.
_BINNED_SQL = _numeric_sql(
    """SELECT d."column", CAST(rn AS BIGINT) AS ref_n, CAST(cn AS BIGINT) AS cur_n, round(ks, 6) AS ks,
              round(w, 4) AS wasserstein, true AS ks_held, true AS wasserstein_held, true AS narrow
       FROM (SELECT "column", max(rn) AS rn, max(cn) AS cn, max(abs(gap)) AS ks, sum(abs(gap) * coalesce(step, 0)) AS w
             FROM cdf GROUP BY "column") d"""
)


def _held(spark, sf, found):
    """Exact distances beside the intervals that must hold them."""
    low, high = balance_halves(spark, sf)
    both = drift.stacked(low, high, NUMERIC)
    spread = low.agg(*[F.greatest(F.stddev_pop(c), F.lit(0.001)).alias(c) for c in NUMERIC]).unpivot([], NUMERIC, "column", "unit")
    exact = drift.numeric_statistics(both, NUMERIC).select("column", "ks", "wasserstein").join(spread, "column")
    joined = exact.withColumn("wasserstein", F.col("wasserstein") * F.col("unit")).join(found, "column")
    slack = 1e-6

    def inside(name):
        value = F.col(name)
        return (value >= F.col(f"{name}_low") - slack) & (value <= F.col(f"{name}_high") * (1 + slack) + slack)

    return joined.select(
        "column", "ref_n", "cur_n", F.round("ks", 6).alias("ks"), F.round("wasserstein", 4).alias("wasserstein"),
        inside("ks").alias("ks_held"), inside("wasserstein").alias("wasserstein_held"),
        (F.col("ks_high") - F.col("ks_low") < 0.03).alias("narrow"),
    )


@plans.query("drift_binned", _BINNED_SQL)
def drift_binned(spark, sf):
    low, high = balance_halves(spark, sf)
    return _held(spark, sf, sketches.binned_report(low, high, NUMERIC))


@plans.query("drift_binned_merged", _BINNED_SQL)
def drift_binned_merged(spark, sf):
    """Sketches of each region and segment, merged by side."""
    parts = [
        sketches.merged(sketches.quantile_sketches(half, NUMERIC, by=["geography", "segment"]))
        for half in balance_halves(spark, sf)
    ]
    return _held(spark, sf, sketches.binned_drift(*parts))


_ORDERS_SQL = """
sides AS (SELECT o_custkey AS k, o_totalprice AS v, (o_orderstatus = 'O')::INT AS cur FROM orders),
sizes AS (SELECT k, count(*) FILTER (WHERE cur = 0) AS n, count(*) FILTER (WHERE cur = 1) AS m FROM sides GROUP BY k),
gaps AS (
  SELECT k, max(abs(r * m - c * n)) AS gap, max(n) AS n, max(m) AS m FROM (
    SELECT k, n, m, count(*) FILTER (WHERE cur = 0) OVER w AS r, count(*) FILTER (WHERE cur = 1) OVER w AS c
    FROM sides JOIN sizes USING (k) WINDOW w AS (PARTITION BY k ORDER BY v RANGE UNBOUNDED PRECEDING)
  ) GROUP BY k
),
-- Every order of n + m values, as the bits of a number.
orders_of AS (
  SELECT n, m, bits FROM (SELECT unnest(range(1, 9)) AS n), (SELECT unnest(range(1, 9)) AS m), (SELECT unnest(range(0, 65536)) AS bits)
  WHERE bits < (1 << (n + m)::INT) AND bit_count(bits::INT) = n
),
path_gaps AS (
  SELECT n, m, list_max(list_transform(range(1, n + m + 1), lambda i:
    abs(bit_count((bits & ((1 << i::INT) - 1))::INT) * m - (i - bit_count((bits & ((1 << i::INT) - 1))::INT)) * n))) AS gap
  FROM orders_of
),
counted AS (SELECT n, m, gap, count(*) AS paths FROM path_gaps GROUP BY ALL)"""


@plans.query(
    "ks_exact",
    f"""WITH {_ORDERS_SQL}
    SELECT g.k AS custkey, g.n AS ref_n, g.m AS cur_n, round(g.gap * 1.0 / (g.n * g.m), 6) AS ks,
           round(sum(c.paths) FILTER (WHERE c.gap >= g.gap) * 1.0 / sum(c.paths), 6) AS p_value
    FROM gaps g JOIN counted c USING (n, m) GROUP BY g.k, g.n, g.m, g.gap""",
)
def ks_exact(spark, sf):
    """Prices of a customer's finished and open orders, for customers with one to eight of each."""
    cells = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("column"), F.col("o_totalprice").alias("value"),
        (F.col("o_orderstatus") == "O").cast("int").alias("is_current"),
    )
    found = drift.cell_statistics(cells).where("ref_n BETWEEN 1 AND 8 AND cur_n BETWEEN 1 AND 8")
    return rounded(found.select(
        F.col("column").alias("custkey"), "ref_n", "cur_n", "ks",
        ks_exact_tail(F.col("ks"), F.col("ref_n"), F.col("cur_n")).alias("p_value"),
    ))


def _flat(summary):
    checks = summary.select("status", F.concat_ws(",", "failed_checks").alias("failed_checks"), "checks.*",
                            F.col("row_counts.reference").alias("reference_rows"),
                            F.col("row_counts.current").alias("current_rows"),
                            "max_missing_fraction", "row_count_delta_fraction")
    return rounded(checks.drop("drift_within_threshold"))


def _gate_sql(nulls: int, limit: float) -> str:
    return with_churn(
        f"""SELECT CASE WHEN miss > {limit} THEN 'failed' ELSE 'passed' END AS status,
                   CASE WHEN miss > {limit} THEN 'max_missing_fraction' ELSE '' END AS failed_checks,
                   true AS schema_match, true AS target_column_present,
                   miss <= {limit} AS missing_fraction_within_threshold,
                   abs(c - r) * 1.0 / r <= 0.5 AS row_count_within_threshold,
                   r AS reference_rows, c AS current_rows, round(miss, 6) AS max_missing_fraction,
                   round(abs(c - r) * 1.0 / r, 6) AS row_count_delta_fraction
            FROM (SELECT count(*) FILTER (WHERE balance < 4500) AS r, count(*) FILTER (WHERE balance >= 4500) AS c,
                         greatest(
                           count(*) FILTER (WHERE balance >= 4500 AND (customer_id % {nulls} = 0 OR num_products = 0)),
                           count(*) FILTER (WHERE balance >= 4500 AND age IS NULL)) * 1.0
                         / count(*) FILTER (WHERE balance >= 4500) AS miss FROM churn)"""
    )


@plans.query("validation_gate", _gate_sql(13, 0.2))
def validation_gate(spark, sf):
    low, high = balance_halves(spark, sf)
    return _flat(validate(low, high, ValidationConfig(target_column=CHURN_TARGET)))


@plans.query("validation_gate_missing", _gate_sql(3, 0.2))
def validation_gate_missing(spark, sf):
    low, high = balance_halves(spark, sf, null_every=3)
    return _flat(validate(low, high, ValidationConfig(target_column=CHURN_TARGET)))


@plans.query(
    "validation_gate_drift",
    _score_sql(
        """SELECT limit_share, count(*) FILTER (WHERE score >= 0.1) * 1.0 AS drifted_column_count,
                  CASE WHEN count(*) FILTER (WHERE score >= 0.1) * 1.0 / count(*) > limit_share THEN 'failed' ELSE 'passed' END AS status,
                  CASE WHEN count(*) FILTER (WHERE score >= 0.1) * 1.0 / count(*) > limit_share THEN 'data_drift_detected' ELSE '' END AS failed_checks,
                  count(*) FILTER (WHERE score >= 0.1) * 1.0 / count(*) <= limit_share AS drift_within_threshold
           FROM scores, (VALUES (0.1), (0.9)) AS l(limit_share) GROUP BY limit_share
           UNION ALL SELECT NULL, NULL, 'failed', 'drift_metric_missing', NULL"""
    ),
)
def validation_gate_drift(spark, sf):
    """The gate's drift outcomes: over and within the limit, and without a metric."""
    low, high = (half.select(*DRIFT_COLUMNS) for half in balance_halves(spark, sf))

    def gate(limit, report):
        config = ValidationConfig(
            target_column=CHURN_TARGET, fail_on_drift=True, drift_share_threshold=limit, fail_on_missing_fraction=False
        )
        return validate(low, high, config, report).select(
            F.lit(limit if report is full else None).cast("double").alias("limit_share"), "drifted_column_count", "status",
            F.concat_ws(",", "failed_checks").alias("failed_checks"), "checks.drift_within_threshold",
        )

    def full(reference, current):
        return drift.drift_report(reference, current, DRIFT_COLUMNS)

    def nothing(reference, current):
        return full(reference, current).where("false")

    return gate(0.1, full).unionByName(gate(0.9, full)).unionByName(gate(0.1, nothing))
