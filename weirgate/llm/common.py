"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from weirgate.operators.ordered import range_buckets
from weirgate.session import cut_lineage, ensure_checkpoint_dir, shuffles_released

# Texts handed to one vectorised call hold about this many characters, so that a worker's
# memory follows this number and its longest single text, not the table.
STEP_CHARS = 1 << 19
# What may travel to every task, as measured.
BROADCAST_BYTES = 8 << 20

Texts = Callable[[list[str]], list]


def documents(spark: SparkSession, directory: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def filled(text: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))


def worker_store() -> dict:
    """Tables that are costly to build, kept for the life of a Python worker."""
    name = "_weirgate_worker_store"
    return sys.modules.setdefault(name, ModuleType(name)).__dict__


def map_texts(
    df: DataFrame, text: str, make: Callable[[], Texts], added: str, keep: list[str] | None = None
) -> DataFrame:
    """One pass over the rows: ``keep`` columns and the ``added`` ones computed from the text.

    ``make`` runs once per task and returns a function from texts to arrow-ready columns.
    A kept column with an added one's name gives way to it.
    """
    new = T.StructType.fromDDL(added)
    kept = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    inner = df.select(*[F.col(f"`{c}`") for c in kept], filled(text).alias("_w_text"))
    schema = T.StructType([*inner.schema.fields[:-1], *new.fields])
    arrow = to_arrow_schema(schema)
    width = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = batch.column(width).to_pylist()
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size + len(texts[end]) <= STEP_CHARS):
                    size += len(texts[end])
                    end += 1
                columns = compute(texts[start:end])
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(width)]
                    + [pa.array(c, arrow.field(width + i).type) for i, c in enumerate(columns)],
                    names=schema.names,
                )
                start = end

    return inner.mapInArrow(run, schema)


def following_ids(df: DataFrame, key: str, descending: bool = True) -> DataFrame:
    """(key, next_key) for each distinct non-null key; after the last comes the first.

    Range buckets are ordered inside; only one row per bucket is ordered globally.
    """
    ids = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_w_key")).distinct()
    tagged = range_buckets(ids, ["_w_key"])
    inside = Window.partitionBy("_bucket").orderBy("_w_key")
    step = F.lag if descending else F.lead
    edge = F.max if descending else F.min
    edges = tagged.groupBy("_bucket").agg(edge("_w_key").alias("_edge"))
    beyond = Window.orderBy("_bucket")
    # One row per bucket: a window over all of them is small.
    neighbours = edges.select("_bucket", step("_edge").over(beyond).alias("_beyond"))
    first = tagged.agg(edge("_w_key").alias("_first"))
    return (
        tagged.withColumn("_inner", step("_w_key").over(inside))
        .join(neighbours, "_bucket", "left")
        .crossJoin(F.broadcast(first))  # one row
        .select(
            F.col("_w_key").alias(key),
            F.coalesce("_inner", "_beyond", "_first").alias("next_key"),
        )
    )


def written(df: DataFrame) -> DataFrame:
    """The frame as a compressed table in the shared checkpoint folder, read back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized_side(df: DataFrame, bytes_of: Column) -> DataFrame:
    """A pinned join side, broadcast only if its measured size allows; else a plain side."""
    pinned = cut_lineage(df)
    size = pinned.agg(F.sum(bytes_of).alias("b")).first()["b"] or 0
    return F.broadcast(pinned) if size <= BROADCAST_BYTES else pinned
