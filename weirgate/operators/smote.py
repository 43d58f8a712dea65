"""Oversampling of the smaller classes with synthetic rows between near neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.columns import uniform
from weirgate.operators.neighbours import nearest_neighbours
from weirgate.operators.pick import class_sizes, pick_by_hash

CHUNK = 1000


def _neighbour_slots(points: DataFrame, k: int, **tuning) -> DataFrame:
    """Per distinct point, the k nearest *rows*: its own copies first, then the others."""
    near = (
        nearest_neighbours(points, k, **tuning)
        .groupBy("pid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "copies", "features"))).alias("near"))
    )
    own = F.array_repeat("features", F.least(F.col("copies") - 1, F.lit(k)).cast("int"))
    others = F.flatten(
        F.transform(
            F.coalesce("near", F.array().cast("array<struct<rank:int,copies:bigint,features:array<double>>>")),
            lambda n: F.array_repeat(n["features"], F.least(n["copies"], F.lit(k)).cast("int")),
        )
    )
    return points.join(near, "pid", "left").select(
        "features", F.slice(F.concat(own, others), 1, k).alias("slots")
    )


def smote(
    df: DataFrame,
    features: list[str],
    label: str,
    key: str,
    k: int = 5,
    seed: int = 42,
    integers: str = "truncate",
    **tuning,
) -> DataFrame:
    """Raise every class to the size of the largest one.

    Returns ``key, label, features..., draw``: original rows have a NULL ``draw``,
    synthetic ones carry the key of their base row. Each base row gets the same number
    of draws, and the remainder goes to rows in hash order, so the counts are exact.
    A synthetic row is ``base + u * (neighbour - base)``. Columns of integer type are
    truncated, or with ``integers="copy"`` taken from the nearer end.
    """
    sizes = class_sizes(df, label)
    largest = max(sizes.values())
    rows = df.select(key, label, *features)
    out = rows.withColumn("draw", F.lit(None).cast("long"))
    for value, n in sorted(sizes.items()):
        missing = largest - n
        if missing == 0:
            continue
        if n <= k:
            raise ValueError(f"class {value!r} has {n} rows, more than {k} are needed")
        out = out.unionByName(
            _synthetic(rows.where(F.col(label) == value), value, n, missing, features, label, key, k, seed, integers, tuning)
        )
    return out


def _synthetic(members, value, n, missing, features, label, key, k, seed, integers, tuning) -> DataFrame:
    vectors = members.select(
        key, F.array(*[F.col(c).cast("double") for c in features]).alias("features")
    )
    # Copies of a point have the same neighbours: search once per distinct point.
    points = vectors.groupBy("features").agg(F.count("*").alias("copies"), F.min(key).cast("long").alias("pid"))
    slots = _neighbour_slots(points, k, **tuning)
    each, extra = divmod(missing, n)
    extra_rule = pick_by_hash(members, label, key, {value: extra}, seed)
    draws = F.lit(each) + F.col("_extra").cast("int")
    base = extra_rule.chosen(members.select(key, label), "_extra").select(key, draws.alias("draws"))
    base = base.where("draws > 0").join(vectors, key).join(slots, "features")
    if each >= CHUNK:
        # Few base rows, many draws: spread chunks of draws before multiplying rows.
        chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("draws") - 1) / CHUNK).cast("int")))
        base = base.withColumn("chunk", chunks).repartition(key, "chunk")
        first = F.col("chunk").cast("long") * CHUNK
        last = F.least(first + CHUNK, F.col("draws").cast("long")) - 1
        base = base.withColumn("draw", F.explode(F.sequence(first, last))).drop("chunk")
    else:
        base = base.withColumn("draw", F.explode(F.sequence(F.lit(0).cast("long"), F.col("draws") - F.lit(1).cast("long"))))
    pick = F.floor(uniform(f"{seed}n", F.col(key), F.col("draw")) * k).cast("int")
    drawn = base.select(
        key,
        "draw",
        "features",
        F.element_at("slots", pick + 1).alias("other"),
        uniform(f"{seed}u", F.col(key), F.col("draw")).alias("u"),
    )
    columns = []
    for i, name in enumerate(features):
        a, b = F.col("features")[i], F.col("other")[i]
        kind = members.schema[name].dataType
        mixed = a + F.col("u") * (b - a)
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) and integers == "copy":
            mixed = F.when(F.col("u") < 0.5, a).otherwise(b)
        columns.append(mixed.cast(kind).alias(name))
    kind = members.schema[label].dataType
    return drawn.select(key, F.lit(value).cast(kind).alias(label), *columns, "draw")
