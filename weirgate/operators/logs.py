"""Deployment logs: marker lines, runtime contract, failure details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import any_of

# Fixed values.
PROOF_MARKERS = ("REPO_OWNED_SCORER_INIT=", "REPO_OWNED_SCORER_RUN=")
GENERATED_RUNTIME_CLUES = (
    "ERROR:entry_module:",
    "inputs_collector is not defined",
    "outputs_collector is not defined",
)
FAILURE_MARKERS = (
    "REPO_OWNED_SCORER_RUN=",
    "ValueError:",
    "TypeError:",
    "RuntimeError:",
    "UserScriptException:",
)
OVERRIDE = "ValueError:"


def non_blank_lines(text: Column) -> Column:
    """Stripped lines that are not empty."""
    return F.filter(
        F.transform(F.split(text, r"\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")),
        lambda x: x != "",
    )


def contains_any(column: Column, markers: tuple[str, ...]) -> Column:
    return any_of([F.contains(column, F.lit(m)) for m in markers])


def log_lines(logs: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-blank line, with its position inside the chunk."""
    keep = [c for c in logs.columns if c != text]
    return logs.select(*keep, F.posexplode(non_blank_lines(F.col(text))).alias("pos", "line"))


def marker_lines(logs: DataFrame, markers: tuple[str, ...] = FAILURE_MARKERS, text: str = "text") -> DataFrame:
    """Lines that contain any marker."""
    lines = log_lines(logs.where(contains_any(F.col(text), markers)), text)
    return lines.where(contains_any(F.col("line"), markers))


def runtime_contract(logs: DataFrame, by: str = "deployment", text: str = "text") -> DataFrame:
    """Per deployment: whether the own scorer proved to run, and which markers showed it."""
    has = [F.max(F.contains(F.col(text), F.lit(m))).alias(f"_m{i}") for i, m in enumerate(PROOF_MARKERS)]
    seen = logs.groupBy(by).agg(*has, F.max(contains_any(F.col(text), GENERATED_RUNTIME_CLUES)).alias("_clue"))
    markers = F.array_compact(
        F.array(*[F.when(F.col(f"_m{i}"), F.lit(m)) for i, m in enumerate(PROOF_MARKERS)])
    )
    status = (
        F.when(F.size("markers") > 0, "repo_owned_scoring_proven")
        .when(F.col("_clue"), "generated_runtime_still_in_control")
        .otherwise("inconclusive")
    )
    return seen.withColumn("markers", markers).select(
        by, status.alias("runtime_contract"), "markers", (F.size("markers") > 0).alias("observed")
    )


def failure_fields(text: Column) -> Column:
    """struct(error_type, error_message) from the last non-blank line, split at the first ``: ``."""
    lines = non_blank_lines(text)
    last = F.when(F.size(lines) > 0, F.element_at(lines, -1)).otherwise(F.trim(text))
    at = F.instr(last, ": ")
    kind, message = F.left(last, at - 1), F.substr(last, at + 2)
    split = (at > 1) & (F.length(message) > 0)
    return F.struct(
        F.when(split, F.trim(kind)).otherwise("RuntimeError").alias("error_type"),
        F.when(split, F.trim(message)).otherwise(last).alias("error_message"),
    )


def enrich_failures(
    failures: DataFrame, logs: DataFrame, by: str = "deployment", order: str = "chunk", text: str = "text"
) -> DataFrame:
    """Failure type and message per deployment; the first override line in the log wins.

    The excerpt itself is :func:`marker_lines`; here its length is kept, so a deployment
    with a very long log is never gathered into one row.
    """
    excerpt = marker_lines(logs, FAILURE_MARKERS, text)
    place = F.struct(F.col(order), F.col("pos"))
    found = excerpt.groupBy(by).agg(
        F.count(F.lit(1)).alias("excerpt_lines"),
        F.min_by(
            F.when(F.startswith(F.col("line"), F.lit(OVERRIDE)), F.col("line")),
            F.when(F.startswith(F.col("line"), F.lit(OVERRIDE)), place),
        ).alias("override"),
    )
    message = F.substr(F.col("override"), F.instr(F.col("override"), ": ") + 2)
    return (
        failures.withColumn("_f", failure_fields(F.col("error_text")))
        .join(found, by, "left")
        .select(
            by,
            F.when(F.col("override").isNotNull(), "ValueError").otherwise(F.col("_f.error_type")).alias("error_type"),
            F.when(F.col("override").isNotNull(), message).otherwise(F.col("_f.error_message")).alias("error_message"),
            F.coalesce("excerpt_lines", F.lit(0)).alias("excerpt_lines"),
        )
    )
