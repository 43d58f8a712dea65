"""Registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.llm import (
    conversations, fingerprints, knn, lines, mixing, packing, pages, parity, periods, sharding, suffixes, tokens,
    toxicity,
)
from weirgate.llm.common import documents
from weirgate.plans.common import Registry

plans = Registry()
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 40
TEMPERATURE = 0.7


@plans.query("op1_fingerprints")
def op1(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, directory))


@plans.query("op2_suffix_dedup")
def op2(spark: SparkSession, directory: str) -> DataFrame:
    return suffixes.drop_repeats(documents(spark, directory))


LINES_SQL = """
WITH lines_of AS (
  SELECT page_id, rowid AS r,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         string_split(trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', chr(10), 'g'),
                                          '[\\n\\r]+', chr(10), 'g'), ' '), chr(10)) AS ls
  FROM (SELECT *, row_number() OVER () AS rowid FROM pages)
),
each AS (SELECT r, host, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM lines_of),
counted AS (
  SELECT host, line, count(DISTINCT r) AS n FROM each WHERE trim(line, ' ') <> '' GROUP BY ALL
),
totals AS (SELECT host, count(*) AS total FROM lines_of GROUP BY ALL),
bad AS (
  SELECT host, line FROM counted JOIN totals USING (host) WHERE n >= 2 AND n > 0.05 * total
),
kept AS (
  SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS body
  FROM each ANTI JOIN bad USING (host, line) GROUP BY r
)
SELECT page_id, host, len(ls)::INT AS n_lines, (len(ls) - coalesce(n, 0))::INT AS n_dropped,
       md5(coalesce(body, '')) AS kept_md5
FROM lines_of LEFT JOIN kept USING (r)
"""


@plans.query("op3_line_dedup", LINES_SQL)
def op3(spark: SparkSession, directory: str) -> DataFrame:
    split = documents(spark, directory, "pages").select(
        "page_id", lines.host_of(F.col("url")).alias("host"), lines.html_lines(F.col("html")).alias("body")
    )
    return lines.line_dedup(split, "body", "host").select(
        "page_id", "host", "n_lines", "n_dropped", F.md5(F.col("body").cast("binary")).alias("kept_md5")
    )


MIX_SQL = f"""
WITH counted AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
shares AS (SELECT source, n, pow(n::DOUBLE, {TEMPERATURE}) AS share FROM counted),
rates AS (
  SELECT source, share / sum(share) OVER () * (sum(n) OVER ())::DOUBLE / n AS rate FROM shares
),
steps AS (SELECT source, rate, greatest(1, ceil(rate / 64.0))::INT AS draws FROM rates),
terms AS (
  SELECT source, rate, draws, k,
         exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1)) AS p
  FROM steps, (SELECT unnest(range(0, 200)) AS k)
),
cdf AS (SELECT source, rate, draws, list(c ORDER BY k) AS cs FROM (
  SELECT source, rate, draws, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms)
  GROUP BY ALL),
drawn AS (
  SELECT doc_id, d.source, rate, text,
         list_sum(list_transform(range(1, draws + 1), lambda i: len(list_filter(cs, lambda c: c <=
           ('0x' || substr(md5('0|' || coalesce(doc_id::VARCHAR, 'null') || '|' || i::VARCHAR), 1, 13))::BIGINT
           / 4503599627370496.0))))::INT AS copies
  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
)
SELECT doc_id, source, unnest(range(1, copies + 1))::INT AS copy, round(rate, 6) AS rate, md5(coalesce(text, '')) AS text_md5
FROM drawn WHERE copies > 0
"""


@plans.query("op4_mixing", MIX_SQL)
def op4(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mix(documents(spark, directory), temperature=TEMPERATURE).select(
        "doc_id", "source", "copy", F.round("rate", 6).alias("rate"),
        F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"),
    )


TOP_SQL = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""


@plans.query("op5_top_k", TOP_SQL)
def op5(spark: SparkSession, directory: str) -> DataFrame:
    return knn.top_k(documents(spark, directory, "embeddings"))


@plans.query("op6_token_counts")
def op6(spark: SparkSession, directory: str) -> DataFrame:
    return tokens.token_counts(documents(spark, directory), VOCABULARY, keep=["doc_id"])


@plans.query("op7_packing")
def op7(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(documents(spark, directory), VOCABULARY)


@plans.query("op8_toxicity")
def op8(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    grammar = toxicity.fit(docs, documents(spark, directory, "labels"))
    scored = toxicity.score(docs, grammar, keep=["doc_id"])
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@plans.query("op9_ngram_join")
def op9(spark: SparkSession, directory: str) -> DataFrame:
    return parity.similar_components(documents(spark, directory))


@plans.query("op10_sharding")
def op10(spark: SparkSession, directory: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, directory), SHARDS)


@plans.query("op11_conversation_repair")
def op11(spark: SparkSession, directory: str) -> DataFrame:
    return conversations.repair_report(documents(spark, directory, "conversations"))


@plans.query("op12_html_text")
def op12(spark: SparkSession, directory: str) -> DataFrame:
    found = pages.main_text(documents(spark, directory, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


@plans.query("op13_periodic_runs")
def op13(spark: SparkSession, directory: str) -> DataFrame:
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periods.collapse_runs(documents(spark, directory), keep=["doc_id"], plant=number)
    return periods.run_digests(found)
