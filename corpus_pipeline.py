"""Corpus preparation: reject, clean, deduplicate, mix, pack."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import lines, mixing, packing, parity, toxicity
from weirgate.llm.common import sized_side
from weirgate.session import cut_lineage

TEMPERATURE = 0.7


def hidden(docs: DataFrame, *read: str) -> DataFrame:
    """The columns, all but those ``read`` under private names that no operator uses."""
    return docs.select(*[
        F.col(f"`{c}`").alias(c if c in read else f"_w_column_{i}") for i, c in enumerate(docs.columns)
    ])


def shown(df: DataFrame, docs: DataFrame, *read: str) -> DataFrame:
    """The columns of ``docs`` under their own names again."""
    return df.select(*[
        F.col(c if c in read else f"_w_column_{i}").alias(c) for i, c in enumerate(docs.columns)
    ])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from these documents' labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grammar = toxicity.fit(docs, labels)
    body = hidden(docs)
    text = f"_w_column_{docs.columns.index('text')}"
    scored = toxicity.score(body.withColumn("_w_body", F.col(text)), grammar, text="_w_body", keep=body.columns)
    return shown(scored.where(F.col("predicted") == 0), docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many documents of its source share."""
    read = ("text", "source", "n_chars")
    kept = lines.line_dedup(hidden(docs, *read), "text", "source")
    changed = F.col("n_dropped") > 0
    return shown(kept.withColumn(
        "n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ), docs, *read)


# Rows without an id are named by their texts, beyond every id.
NAMELESS = 1 << 62


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: its smallest id, then the smallest md5 of the text.

    Rows without an id take part by their texts and come after those with one (ids are taken
    to be below 2**62). Texts without words link with nothing and all stay, repeated ones too.
    """
    name = F.coalesce(F.col("doc_id"), F.xxhash64("text").bitwiseAND(F.lit(NAMELESS - 1)).bitwiseOR(F.lit(NAMELESS)))
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_w_row"), "text", name.alias("_w_name")
    )
    found = parity.similar_components(named, "_w_name", "text")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    stays = (
        found.where((F.col("doc_id") == F.col("component_id")) & (F.col("n_shingles") > 0))
        .groupBy(F.col("doc_id").alias("_w_name")).agg(F.count("*").alias("_w_rows"))
    )
    stays = cut_lineage(stays)
    # Names go to the texts where their measured size allows, so that no text is shuffled.
    lone = sized_side(stays.where("_w_rows = 1").select("_w_name"), F.lit(16))
    repeated = sized_side(stays.where("_w_rows > 1").select("_w_name"), F.lit(16))
    worded = named.where(~wordless)
    one = worded.join(lone, "_w_name", "left_semi").select("_w_row.*")
    order = F.struct(F.md5("text"), F.md5(F.to_json("_w_row")))
    several = (
        worded.join(repeated, "_w_name", "left_semi")
        .groupBy("_w_name").agg(F.min_by("_w_row", order).alias("_w_row")).select("_w_row.*")
    )
    return one.union(several).union(named.where(wordless).select("_w_row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh as their sizes to the power 0.7, shuffled."""
    read = ("doc_id", "source")
    return shown(mixing.mix(hidden(docs, *read), temperature=TEMPERATURE), docs, *read)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores, set similarity and tokens are beyond SQL; tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are checkpointed for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
