"""Exploratory profile of a table. Every job reads only the columns it reports on."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.columns import is_missing, known, numeric_columns, ratio
from weirgate.operators.ordered import quantiles, ranked_values
from weirgate.session import small_side

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def long_values(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep..., column, value) with one row per cell; NaN becomes NULL."""
    cells = df.select(*keep, *[known(df, c).cast("double").alias(c) for c in columns])
    return cells.unpivot(list(keep), columns, "column", "value")


def _per_column(df: DataFrame, columns: list[str], metrics: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregation for all columns, then one row per column."""
    wide = df.agg(
        *[expr.alias(f"{m}__{c}") for m, by_column in metrics.items() for c, expr in by_column.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{m}__{c}`").alias(m) for m in metrics])
            for c in columns
        ]
    )
    return wide.select(F.inline(rows))


def table_counts(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )


def column_info(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Type and non-missing count per column."""
    names = columns or df.columns
    counts = _per_column(
        df, names, {"non_null_count": {c: F.count(F.when(~is_missing(df, c), 1)) for c in names}}
    )
    types = F.create_map(
        *[F.lit(x) for c in names for x in (c, df.schema[c].dataType.simpleString())]
    )
    return counts.select("column", types[F.col("column")].alias("dtype"), "non_null_count")


def missing_by_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    names = columns or df.columns
    flags = {c: is_missing(df, c).cast("int") for c in names}
    return _per_column(
        df,
        names,
        {
            "missing_count": {c: F.coalesce(F.sum(f), F.lit(0)) for c, f in flags.items()},
            "missing_fraction": {c: F.coalesce(F.avg(f), F.lit(0.0)) for c, f in flags.items()},
        },
    )


def missing_report(df: DataFrame) -> DataFrame:
    """Only the columns that have missing values."""
    return missing_by_column(df).where("missing_count > 0").select("column", "missing_count")


def max_missing_fraction(df: DataFrame) -> DataFrame:
    return missing_by_column(df).agg(F.max("missing_fraction").alias("max_missing_fraction"))


def row_count_delta(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Relative change of the row count against the reference."""
    sides = reference.select(F.lit(0).alias("is_current")).unionAll(
        current.select(F.lit(1).alias("is_current"))
    )
    counts = sides.agg(
        F.count(F.when(F.col("is_current") == 0, 1)).alias("reference_rows"),
        F.count(F.when(F.col("is_current") == 1, 1)).alias("current_rows"),
    )
    gap = F.abs(F.col("current_rows") - F.col("reference_rows"))
    return counts.withColumn(
        "row_count_delta_fraction", gap / F.greatest("reference_rows", F.lit(1))
    )


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows; NULL equals NULL.

    Long texts are compared by length and SHA-256, so whole documents are not shuffled.
    """
    keys = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            text = F.when(F.length(column) <= 64, column.cast("binary")).otherwise(F.unhex(F.sha2(column, 256)))
            keys += [F.length(column).alias(f"n_{f.name}"), text.alias(f.name)]
        else:
            keys.append(column)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
        )
    )


def cardinality(df: DataFrame, columns: list[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-missing values per column and their ratio to all rows."""
    names = columns or df.columns
    count = F.approx_count_distinct if approximate else F.count_distinct
    profile = _per_column(
        df,
        names,
        {
            "unique_count": {c: count(known(df, c)) for c in names},
            "_rows": {c: F.count(F.lit(1)) for c in names},
        },
    )
    types = F.create_map(
        *[F.lit(x) for c in names for x in (c, df.schema[c].dataType.simpleString())]
    )
    return profile.select(
        "column",
        "unique_count",
        ratio(F.col("unique_count"), F.col("_rows")).alias("unique_ratio"),
        types[F.col("column")].alias("dtype"),
    )


def high_cardinality_columns(
    df: DataFrame, max_ratio: float, columns: list[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Columns whose distinct ratio is above the limit; pass the names to ``df.drop``."""
    return (
        cardinality(df, columns, approximate)
        .where(F.col("unique_ratio") > max_ratio)
        .select("column", "unique_count", "unique_ratio")
    )


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, exact quartiles, max per numeric column."""
    cells = long_values(df, columns or numeric_columns(df))
    moments = cells.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = quantiles(ranked_values(cells, ["column"], "value"), ["column"], "value", QUARTILES)
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", *QUARTILES, "max"
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null counts, most frequent first, ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def label_rate(df: DataFrame, label: str, by: list[str] = ()) -> DataFrame:
    """Mean of a 0/1 label, overall or per group in ascending rate."""
    rates = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("label_rate"))
    return rates.orderBy("label_rate", *by) if by else rates


def crosstab(df: DataFrame, column: str, label: str, labels: list[int] = (0, 1)) -> DataFrame:
    """Counts per category and label value; absent cells are 0."""
    cells = [F.count(F.when(F.col(label) == v, 1)).alias(f"{label}_{v}") for v in labels]
    return df.groupBy(column).agg(*cells)


def histogram(df: DataFrame, columns: list[str], label: str, bins: int = 30) -> DataFrame:
    """Equal-width density histogram over each class's own range; the last bin is closed."""
    cells = long_values(df, columns, [label]).where(F.col("value").isNotNull())
    keys = ["column", label]
    spans = cells.groupBy(*keys).agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.count("value").alias("_n")
    )
    flat = F.col("_max") == F.col("_min")
    spans = spans.select(
        *keys,
        "_n",
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("_low"),
        F.when(flat, F.lit(1.0 / bins))
        .otherwise((F.col("_max") - F.col("_min")) / bins)
        .alias("_width"),
    )
    placed = F.least(F.floor((F.col("value") - F.col("_low")) / F.col("_width")), F.lit(bins - 1))
    return (
        cells.join(small_side(spans), keys)
        .groupBy(*keys, placed.alias("bin"), "_n", "_low", "_width")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            *keys,
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            "n",
            (F.col("n") / (F.col("_n") * F.col("_width"))).alias("density"),
        )
    )


def boxplot(df: DataFrame, columns: list[str], label: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the extreme points within ``reach`` IQRs, outliers beyond."""
    keys = ["column", label]
    ranked = ranked_values(long_values(df, columns, [label]), keys, "value")
    boxes = quantiles(ranked, keys, "value", QUARTILES)
    iqr = F.col("q75") - F.col("q25")
    low, high = F.col("q25") - reach * iqr, F.col("q75") + reach * iqr
    inside = F.col("value").between(low, high)
    joined = ranked.join(small_side(boxes), keys)
    # With interpolated quartiles no data point need lie between a quartile and its fence.
    return (
        joined.groupBy(*keys, *QUARTILES)
        .agg(
            F.sum("n").alias("n"),
            F.min(F.when(F.col("value") >= low, F.col("value"))).alias("_low_point"),
            F.max(F.when(F.col("value") <= high, F.col("value"))).alias("_high_point"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
        .select(
            *keys,
            "n",
            *QUARTILES,
            F.least("_low_point", "q25").alias("whisker_low"),
            F.greatest("_high_point", "q75").alias("whisker_high"),
            "outliers",
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation, all pairs in one aggregation."""
    pairs = list(combinations(columns, 2))
    cells = df.select(*[known(df, c).cast("double").alias(c) for c in columns])
    wide = cells.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(x).alias("column_a"), F.lit(y).alias("column_b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
            for x, y in ((a, b), (b, a))
        ],
        *[
            F.struct(F.lit(c).alias("column_a"), F.lit(c).alias("column_b"), F.lit(1.0).alias("corr"))
            for c in columns
        ],
    )
    return wide.select(F.inline(rows))


def correlation_with(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Correlation of each column with the label, strongest positive first."""
    cells = df.select(label, *[known(df, c).cast("double").alias(c) for c in columns])
    pairs = _per_column(cells, columns, {"corr": {c: F.corr(c, label) for c in columns}})
    return pairs.orderBy(F.desc("corr"), "column")


def summary_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, missing, distinct, and whether it is empty or constant."""
    names = df.columns
    profile = _per_column(
        df,
        names,
        {
            "row_count": {c: F.count(F.lit(1)) for c in names},
            "missing_count": {c: F.count(F.when(is_missing(df, c), 1)) for c in names},
            "unique_count": {c: F.count_distinct(known(df, c)) for c in names},
            "min_text": {c: F.min(known(df, c)).cast("string") for c in names},
            "max_text": {c: F.max(known(df, c)).cast("string") for c in names},
        },
    )
    return profile.select(
        "*",
        (F.col("unique_count") == 0).alias("is_empty"),
        (F.col("unique_count") == 1).alias("is_constant"),
    )
