"""Running totals over an ordering, without a single-task window.

Exact quantiles, rank AUC, empirical distribution gaps, category codes and trailing
windows all need "how much lies before this value". A window partitioned by column or
class would give one task per column. Here the pre-aggregated rows are range
partitioned on the composite key (group, value), so a heavy group spreads over many
partitions; only per-partition totals (groups + partitions rows) are ever ordered
globally, and each partition adds its offset locally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.columns import any_of
from weirgate.session import cut_lineage


def range_buckets(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Rows tagged with ``_bucket``, ascending in ``keys``; written once and reused.

    Without ``partitions`` the number follows the data: it starts at
    ``spark.sql.shuffle.partitions`` and adaptive execution joins neighbouring ranges
    that are small. The checkpoint pins the sampled boundaries: every later branch sees
    the same buckets even if an executor is lost.
    """
    columns = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return cut_lineage(ranged.withColumn("_bucket", F.spark_partition_id()))


def running_totals(
    df: DataFrame,
    by: list[str],
    order: str,
    sums: list[str],
    partitions: int | None = None,
    with_next: bool = False,
) -> DataFrame:
    """Add ``<s>_before`` (strictly before) and ``<s>_total`` (whole group) for each sum.

    ``df`` must hold one row per (by, order). ``with_next`` also adds ``next_value``,
    the following order value in the group.
    """
    tagged = range_buckets(df, [*by, order], partitions)
    keys = [*by, "_bucket"]
    totals = tagged.groupBy(*keys).agg(
        *[F.sum(s).alias(f"_sum_{s}") for s in sums], F.min(order).alias("_first")
    )
    over_buckets = Window.partitionBy(*by).orderBy("_bucket")
    before = over_buckets.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"{s}_total") for s in sums],
        F.lead("_first").over(over_buckets).alias("_next_first"),
    )
    inside = Window.partitionBy(*keys).orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    columns: list[Column] = [
        (F.col(f"_off_{s}") + F.coalesce(F.sum(s).over(earlier), F.lit(0))).alias(f"{s}_before")
        for s in sums
    ]
    columns += [F.col(f"{s}_total") for s in sums]
    if with_next:
        columns.append(
            F.coalesce(F.lead(order).over(inside), F.col("_next_first")).alias("next_value")
        )
    return tagged.join(offsets, keys).select(*df.columns, *columns)


def ranked_values(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Distinct non-null values per group with ``n``, ``n_before`` and ``n_total``."""
    counted = (
        df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    )
    return running_totals(counted, by, value, ["n"])


def quantiles(
    ranked: DataFrame, by: list[str], value: str, wanted: dict[str, float]
) -> DataFrame:
    """Linear-interpolation quantiles per group from :func:`ranked_values`.

    Only the rows that hold a wanted rank reach the final aggregation.
    """
    low, high = F.col("n_before"), F.col("n_before") + F.col("n")
    at = {name: (F.col("n_total") - 1) * F.lit(p) for name, p in wanted.items()}

    def covers(rank: Column) -> Column:
        return (low <= rank) & (rank < high)

    useful = any_of([covers(F.floor(r)) | covers(F.ceil(r)) for r in at.values()])
    picks = []
    for name, rank in at.items():
        picks += [
            F.max(F.when(covers(F.floor(rank)), F.col(value))).alias(f"_lo_{name}"),
            F.max(F.when(covers(F.ceil(rank)), F.col(value))).alias(f"_hi_{name}"),
        ]
    found = ranked.where(useful).groupBy(*by).agg(F.max("n_total").alias("_n"), *picks)
    out = []
    for name, p in wanted.items():
        rank = (F.col("_n") - 1) * F.lit(p)
        step = F.col(f"_hi_{name}") - F.col(f"_lo_{name}")
        out.append((F.col(f"_lo_{name}") + step * (rank - F.floor(rank))).alias(name))
    return found.select(*by, *out)
