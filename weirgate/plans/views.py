"""SQL twins of the labelled views, for the correctness check only."""

CHURN_SQL = """
churn_cutoff AS (
  SELECT max(CAST(o_orderdate AS DATE)) - 365 AS cutoff FROM orders
),
churn_orders AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority, cutoff,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders, churn_cutoff
),
churn_per AS (
  SELECT o_custkey, cutoff,
         count(*) FILTER (WHERE day <= cutoff) AS num_products,
         CAST(sum(cents) FILTER (WHERE day <= cutoff) AS BIGINT) AS cents,
         min(day) FILTER (WHERE day <= cutoff) AS first_day,
         max(day) FILTER (WHERE day <= cutoff) AS last_day,
         max(CASE WHEN day <= cutoff AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS has_cr_card,
         max(CASE WHEN day <= cutoff AND day > cutoff - 365 THEN 1 ELSE 0 END) AS is_active,
         max(CASE WHEN day > cutoff THEN 1 ELSE 0 END) AS stayed
  FROM churn_orders GROUP BY o_custkey, cutoff
),
churn AS (
  SELECT c_custkey AS customer_id, c_name AS surname,
         CASE WHEN c_custkey % 13 <> 0 AND num_products > 0
              THEN CAST(cents AS DOUBLE) / 100.0 / num_products END AS credit_score,
         r_name AS geography, c_mktsegment AS segment,
         CAST(cutoff - last_day AS INTEGER) AS age, CAST(cutoff - first_day AS INTEGER) AS tenure,
         c_acctbal AS balance, CAST(coalesce(num_products, 0) AS BIGINT) AS num_products,
         coalesce(has_cr_card, 0) AS has_cr_card, coalesce(is_active, 0) AS is_active,
         CAST(coalesce(cents, 0) AS DOUBLE) / 100.0 AS salary,
         1 - coalesce(stayed, 0) AS exited
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN churn_per ON c_custkey = o_custkey
)
"""

# Long form of the numeric churn columns.
CHURN_LONG_SQL = """
churn_long AS (
  SELECT exited, 'credit_score' AS "column", CAST(credit_score AS DOUBLE) AS value FROM churn
  UNION ALL SELECT exited, 'age', CAST(age AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'tenure', CAST(tenure AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'balance', CAST(balance AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'num_products', CAST(num_products AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'has_cr_card', CAST(has_cr_card AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'is_active', CAST(is_active AS DOUBLE) FROM churn
  UNION ALL SELECT exited, 'salary', CAST(salary AS DOUBLE) FROM churn
)
"""


def with_churn(select: str, *more: str) -> str:
    """``WITH`` clause of the churn view, further CTEs, then the select."""
    return "WITH " + ",\n".join([CHURN_SQL, *more]) + "\n" + select


def hash52_sql(seed: int | str, *keys: str) -> str:
    """SQL twin of ``weirgate.functions.columns.hash52``."""
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT)"


def uniform_sql(seed: int | str, *keys: str) -> str:
    return f"({hash52_sql(seed, *keys)} / 4503599627370496.0)"
