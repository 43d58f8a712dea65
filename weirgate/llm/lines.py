"""Site-relative line deduplication: a line on too large a share of a host's pages goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.session import cut_lineage

# A host's boilerplate reaches its pages over this many salted copies of its row.
SALTS = 16
# A line of one page only is no boilerplate, however few pages the host has.
LEAST_PAGES = 2
BROADCAST_BYTES = 4 << 20


def host_of(url: Column) -> Column:
    """Host of an address in lower case; empty where there is none."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1))


def html_lines(html: Column) -> Column:
    """Text between tags, one line each."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", "\n")
    return F.trim(F.regexp_replace(text, "[\n\r]+", "\n"))


def boilerplate(df: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(_w_host, _w_bad): hashes of each host's boilerplate lines.

    A host has at most (average lines of a page) / ratio of them. Lines are counted once per
    page and pre-aggregated before the shuffle, so a large host does not gather in one task.
    """
    lines = df.select("_w_host", F.explode(F.array_distinct("_w_lines")).alias("_w_line")).where(
        F.trim("_w_line") != ""
    )
    counted = lines.groupBy("_w_host", F.xxhash64("_w_line").alias("_w_hash")).agg(
        F.count("*").alias("_w_pages")
    )
    totals = df.groupBy("_w_host").agg(F.count("*").alias("_w_total"))
    often = counted.where(F.col("_w_pages") >= min_pages)
    return (
        often.join(totals, "_w_host")
        .where(F.col("_w_pages") > ratio * F.col("_w_total"))
        .groupBy("_w_host")
        .agg(F.collect_list("_w_hash").alias("_w_bad"))
    )


def line_dedup(
    df: DataFrame, text: str, host: str, ratio: float = 0.05, min_pages: int = LEAST_PAGES
) -> DataFrame:
    """Rows with boilerplate lines cut from ``text``, and ``n_lines``, ``n_dropped``.

    A line goes when it stands on more than ``ratio`` of the pages of its host, and on at
    least ``min_pages`` (2: every line of a lone page is on all pages); a larger floor
    decides instead of ``ratio`` on hosts below ``min_pages / ratio`` pages. On a small host
    the lines of equal pages go from all of them. Blank lines stay. A null text is empty (one blank line), a null host
    is a host of its own, a repeated row is a page like any other, and a page left without
    lines keeps its row with an empty text. Columns named ``n_lines`` or ``n_dropped`` are
    replaced; others pass through. An empty table gives an empty table.
    """
    rows = df.drop("n_lines", "n_dropped")
    named = rows.withColumn("_w_host", F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\0")))
    split = named.withColumn("_w_lines", F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n"))
    bad = cut_lineage(boilerplate(split.select("_w_host", "_w_lines"), ratio, min_pages))
    size = bad.agg(F.sum(F.size("_w_bad") * 8 + 64 + F.length("_w_host")).alias("b")).first()["b"] or 0
    if size <= BROADCAST_BYTES:
        joined = split.join(F.broadcast(bad), "_w_host", "left")
    else:
        salted = bad.withColumn("_w_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = split.withColumn("_w_salt", F.pmod(F.xxhash64("_w_lines"), F.lit(SALTS)).cast("int")).join(
            salted, ["_w_host", "_w_salt"], "left"
        )
    clean = F.filter(
        "_w_lines", lambda x: (F.trim(x) == "") | ~F.array_contains("_w_bad", F.xxhash64(x))
    )
    kept = F.when(F.col("_w_bad").isNull(), F.col("_w_lines")).otherwise(clean)
    return (
        joined.withColumn("_w_kept", kept)
        .select(
            *[F.array_join("_w_kept", "\n").alias(c) if c == text else F.col(f"`{c}`") for c in rows.columns],
            F.size("_w_lines").alias("n_lines"),
            (F.size("_w_lines") - F.size("_w_kept")).alias("n_dropped"),
        )
    )
