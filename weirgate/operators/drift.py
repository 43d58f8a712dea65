"""Distribution drift between a reference table and a current table, per column.

Both tables are read once. Values are counted before anything is ordered, so a value
that fills a third of the rows is one row from then on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import NUMERIC_TYPES, known, ratio
from weirgate.functions.pvalues import chi_square_tail, ks_exact_tail, ks_tail, normal_two_sided
from weirgate.operators.ordered import running_totals


def stacked(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """Both tables with ``is_current`` 0/1; the named columns only."""
    return reference.select(F.lit(0).alias("is_current"), *columns).unionAll(
        current.select(F.lit(1).alias("is_current"), *columns)
    )


def column_kinds(df: DataFrame, columns: list[str] | None = None, most_distinct: int = 5) -> dict[str, str]:
    """``num`` for numeric columns with more than a few distinct values, else ``cat``."""
    names = columns or df.columns
    numeric = [c for c in names if isinstance(df.schema[c].dataType, NUMERIC_TYPES)]
    distinct = (
        df.agg(*[F.approx_count_distinct(known(df, c)).alias(c) for c in numeric]).first()
        if numeric
        else {}
    )
    return {c: "num" if c in numeric and distinct[c] > most_distinct else "cat" for c in names}


def _side_counts(cells: DataFrame) -> DataFrame:
    return (
        cells.where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(
            F.count(F.when(F.col("is_current") == 0, 1)).alias("ref"),
            F.count(F.when(F.col("is_current") == 1, 1)).alias("cur"),
        )
    )


def _cells(both: DataFrame, columns: list[str], kind: str) -> DataFrame:
    cast = both.select("is_current", *[known(both, c).cast(kind).alias(c) for c in columns])
    return cast.unpivot(["is_current"], columns, "column", "value")


def numeric_statistics(both: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: ks, wasserstein (divided by the reference deviation), counts."""
    return cell_statistics(_cells(both, columns, "double"))


def cell_statistics(cells: DataFrame) -> DataFrame:
    """As :func:`numeric_statistics`, of (is_current, column, value); a column may be any key."""
    ranked = running_totals(_side_counts(cells), ["column"], "value", ["ref", "cur"], with_next=True)
    gap = F.abs(
        ratio(F.col("ref_before") + F.col("ref"), F.col("ref_total"))
        - ratio(F.col("cur_before") + F.col("cur"), F.col("cur_total"))
    )
    distances = ranked.groupBy("column").agg(
        F.max(gap).alias("ks"),
        F.sum(gap * (F.coalesce("next_value", "value") - F.col("value"))).alias("wasserstein"),
        F.max("ref_total").alias("ref_n"),
        F.max("cur_total").alias("cur_n"),
    )
    spread = cells.groupBy("column").agg(
        F.stddev_pop(F.when(F.col("is_current") == 0, F.col("value"))).alias("ref_std")
    )
    return distances.join(spread, "column").select(
        "column",
        "ref_n",
        "cur_n",
        "ks",
        (F.col("wasserstein") / F.greatest(F.coalesce("ref_std", F.lit(0.0)), F.lit(0.001))).alias("wasserstein"),
    )


def categorical_statistics(both: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: chi2 with its degrees of freedom, two-proportion z, Jensen-Shannon distance."""
    counted = _side_counts(_cells(both, columns, "string"))
    totals = counted.groupBy("column").agg(
        F.sum("ref").alias("ref_n"),
        F.sum("cur").alias("cur_n"),
        F.count(F.lit(1)).alias("categories"),
        # Proportion of the first value in text order, for the two-category test.
        F.min_by("ref", "value").alias("ref_first"),
        F.min_by("cur", "value").alias("cur_first"),
    )
    # One row per column, named by the caller: bounded by the schema.
    shares = counted.join(F.broadcast(totals), "column")
    p, q = ratio(F.col("ref"), F.col("ref_n")), ratio(F.col("cur"), F.col("cur_n"))
    middle = (p + q) / 2
    expected = p * F.col("cur_n")
    observed = F.col("cur").cast("double")

    def divergence(x: Column) -> Column:
        return F.when(x > 0, x * F.ln(x / middle)).otherwise(0.0)

    sums = shares.groupBy("column").agg(
        F.sum(
            F.when(expected > 0, (observed - expected) * (observed - expected) / expected)
            .when(observed > 0, F.lit(float("inf")))
            .otherwise(0.0)
        ).alias("chi2"),
        F.sqrt(F.greatest(F.sum(divergence(p) + divergence(q)) / 2, F.lit(0.0))).alias("js"),
    )
    p1, p2 = ratio(F.col("ref_first"), F.col("ref_n")), ratio(F.col("cur_first"), F.col("cur_n"))
    pooled = ratio(F.col("ref_first") + F.col("cur_first"), F.col("ref_n") + F.col("cur_n"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("ref_n") + 1 / F.col("cur_n")))
    return sums.join(totals, "column").select(
        "column",
        "ref_n",
        "cur_n",
        "categories",
        "chi2",
        (F.col("categories") - 1).alias("freedom"),
        F.when(F.col("categories") == 2, ratio(p1 - p2, error)).alias("z"),
        "js",
    )


@dataclass(frozen=True)
class Method:
    """How a statistics row becomes a score, and when the score means drift."""

    score: Callable[[], Column]
    threshold: float
    drift_below: bool


# Selectable by name. p-value methods flag small scores, distances flag large ones.
METHODS: dict[str, Method] = {
    "ks": Method(lambda: ks_tail(F.col("ks"), F.col("ref_n"), F.col("cur_n")), 0.05, True),
    "ks_exact": Method(lambda: ks_exact_tail(F.col("ks"), F.col("ref_n"), F.col("cur_n")), 0.05, True),
    "chisquare": Method(lambda: chi_square_tail(F.col("chi2"), F.col("freedom")), 0.05, True),
    "z": Method(lambda: F.coalesce(normal_two_sided(F.col("z")), F.lit(1.0)), 0.05, True),
    "wasserstein": Method(lambda: F.col("wasserstein"), 0.1, False),
    "jensenshannon": Method(lambda: F.col("js"), 0.1, False),
}
# Families of methods a report can use; ``by_size`` tests references of up to so many rows.
FAMILIES = ("distance", "test", "by_size")
SMALL_REFERENCE = 1000


def _flag(stats: DataFrame, choice: Column, names: list[str]) -> DataFrame:
    score, threshold, below = F.lit(None).cast("double"), F.lit(None).cast("double"), F.lit(False)
    for name in names:
        method = METHODS[name]
        hit = F.col("method") == name
        score = F.when(hit, method.score()).otherwise(score)
        threshold = F.when(hit, F.lit(method.threshold)).otherwise(threshold)
        below = F.when(hit, F.lit(method.drift_below)).otherwise(below)
    drifted = F.when(below, F.col("score") < F.col("threshold")).otherwise(F.col("score") >= F.col("threshold"))
    return (
        stats.withColumn("method", choice)
        .withColumn("score", score)
        .withColumn("threshold", threshold)
        .withColumn("drifted", F.coalesce(drifted, F.lit(False)))
        .select("column", "method", "score", "threshold", "drifted")
    )


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    kinds: dict[str, str] | None = None,
    method: dict[str, str] | None = None,
    family: str = "distance",
) -> DataFrame:
    """One row per column: method, score, threshold, drifted.

    ``family`` chooses the methods of all columns, alike for tables of any size: ``distance``
    (wasserstein, jensenshannon) or ``test`` (ks, z, chisquare). With ``by_size`` references of
    up to 1000 rows are tested and larger ones measured. ``method`` overrides the choice per
    column; the report names the method used.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}; choose from {FAMILIES}")
    names = [c for c in (columns or reference.columns) if c in current.columns]
    kinds = kinds or column_kinds(reference, names)
    both = stacked(reference, current, names)
    tested = family == "test" or (family == "by_size" and reference.limit(SMALL_REFERENCE + 1).count() <= SMALL_REFERENCE)
    small = F.lit(tested)
    forced = F.lit(None).cast("string")
    for column, chosen in (method or {}).items():
        if chosen not in METHODS:
            raise ValueError(f"unknown drift method {chosen!r}; choose from {sorted(METHODS)}")
        forced = F.when(F.col("column") == column, F.lit(chosen)).otherwise(forced)
    parts = []
    numeric = [c for c in names if kinds[c] == "num"]
    categorical = [c for c in names if kinds[c] == "cat"]
    if numeric:
        default = F.when(small, F.lit("ks")).otherwise("wasserstein")
        parts.append(
            _flag(numeric_statistics(both, numeric), F.coalesce(forced, default), ["ks", "ks_exact", "wasserstein"])
        )
    if categorical:
        default = (
            F.when(~small, F.lit("jensenshannon")).when(F.col("categories") <= 2, "z").otherwise("chisquare")
        )
        parts.append(
            _flag(
                categorical_statistics(both, categorical),
                F.coalesce(forced, default),
                ["chisquare", "z", "jensenshannon"],
            )
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_summary(report: DataFrame) -> DataFrame:
    """Count and share of drifted columns; NULL when there was nothing to compare."""
    return report.agg(
        F.when(F.count(F.lit(1)) > 0, F.sum(F.col("drifted").cast("double"))).alias("drifted_column_count"),
        F.avg(F.col("drifted").cast("double")).alias("drifted_column_share"),
    )
