"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.session import cut_lineage, local_rows

# A rate above this is the sum of several draws, whose terms stay in a double's range.
RATE_PER_DRAW = 64.0
# Sources travel to every task only up to this measured size.
BROADCAST_BYTES = 4 << 20


def cdf_of(rate: Column) -> Column:
    """Cumulative Poisson probabilities from 0 up, until what is left is below 1e-17."""
    last = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(
        F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("cdf")
    )

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(
            p.alias("p"), (acc["c"] + p).alias("c"), F.concat(acc["cdf"], F.array(acc["c"] + p)).alias("cdf")
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, add, lambda acc: acc["cdf"])


def source_rates(
    df: DataFrame, source: str, weights: dict[str, float] | None, temperature: float, total: float | None
) -> DataFrame:
    """(_w_source, rate): mean repetitions that bring each source to its share of ``total``.

    Without weights a source's share is its row count to the power ``temperature``; without
    a total the mix has as many rows as the table. A source without a weight gets none.
    """
    counted = df.groupBy(F.col(f"`{source}`").alias("_w_source")).agg(F.count("*").alias("_w_n"))
    if weights is None:
        shares = counted.withColumn("_w_share", F.pow(F.col("_w_n").cast("double"), F.lit(temperature)))
    else:
        table = local_rows(df.sparkSession, list(weights.items()), "_w_name string, _w_share double")
        shares = counted.join(
            table, F.col("_w_source").eqNullSafe(F.col("_w_name")), "left"
        ).select("_w_source", "_w_n", F.coalesce("_w_share", F.lit(0.0)).alias("_w_share"))
    sums = shares.agg(F.sum("_w_share").alias("_w_shares"), F.sum("_w_n").alias("_w_rows"))
    wanted = F.lit(float(total)) if total is not None else F.col("_w_rows").cast("double")
    rate = F.col("_w_share") / F.col("_w_shares") * wanted / F.col("_w_n")
    # One row of sums.
    return shares.crossJoin(F.broadcast(sums)).select(
        "_w_source", F.when(F.col("_w_shares") > 0, rate).otherwise(F.lit(0.0)).alias("rate")
    )


def mix(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.7,
    total: float | None = None,
    source: str = "source",
    id: str = "doc_id",
    seed: int = 0,
) -> DataFrame:
    """Each row as often as a Poisson draw says, shuffled, with ``copy`` from 1 and ``rate``.

    The draw inverts the Poisson distribution at a number hashed from seed and id, so it is
    the same on every run and for repeated rows. A null source is a source of its own, a
    null id hashes like the word ``null``. Columns named ``copy`` or ``rate`` are replaced;
    others pass through. An empty table gives an empty table.
    """
    rates = source_rates(df, source, weights, temperature, total)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_PER_DRAW)).cast("int")
    table = cut_lineage(
        rates.select("_w_source", "rate", draws.alias("_w_draws"))
        .withColumn("_w_cdf", cdf_of(F.col("rate") / F.col("_w_draws")))
    )
    size = table.agg(F.sum(F.size("_w_cdf") * 8 + 64 + F.coalesce(F.length("_w_source"), F.lit(0))).alias("b")).first()
    side = F.broadcast(table) if (size["b"] or 0) <= BROADCAST_BYTES else table
    name = F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("null"))

    def drawn(i: Column) -> Column:
        digest = F.md5(F.concat_ws("|", F.lit(str(seed)), name, i.cast("string")).cast("binary"))
        return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))

    each = F.transform(
        F.sequence(F.lit(1), F.col("_w_draws")),
        lambda i: F.size(F.filter("_w_cdf", lambda c: c <= drawn(i))),
    )
    rows = df.drop("copy", "rate")
    copies = F.aggregate(each, F.lit(0), lambda a, b: a + b)
    repeated = (
        rows.join(side, F.col(f"`{source}`").eqNullSafe(F.col("_w_source")))
        .withColumn("_w_copies", copies)
        .where(F.col("_w_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_w_copies"))))
    )
    order = F.xxhash64(F.lit(seed), name, F.col("copy"))
    return (
        repeated.withColumn("_w_order", order)
        .repartition("_w_order")
        .sortWithinPartitions("_w_order")
        .select(*rows.columns, "copy", "rate")
    )
