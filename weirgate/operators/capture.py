"""Captured predictions: parsing, distribution, evidence, records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.columns import uniform
from weirgate.operators.ordered import running_totals

OUTPUT_LABELS = "labels"


def label_texts(line: Column, variant: Column) -> Column:
    """Outputs of a capture line as text, telling 0, 0.0, "0", true and null apart as Python does.

    The raw token keeps ``0.0``; the variant's element types say which tokens were
    booleans or null. Anything but an array of outputs gives NULL.
    """
    raw = F.from_json(line, "struct<outputs: array<string>>")["outputs"]
    kinds = F.transform(
        F.try_variant_get(variant, "$.outputs", "array<variant>"), lambda x: F.schema_of_variant(x)
    )

    def text(token: Column, kind: Column) -> Column:
        return (
            F.when(token.isNull() | (kind == "VOID"), "None")
            .when(kind == "BOOLEAN", F.initcap(token))
            .otherwise(token)
        )

    return F.zip_with(raw, kinds, text)


def parse_capture_lines(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Capture records from ``line`` (other columns are kept).

    Blank lines and JSON that is no object are skipped. A line that is no JSON raises,
    or with ``strict=False`` is skipped too.
    """
    keep = [c for c in lines.columns if c != "line"]
    text = F.trim("line")
    # A generated row: filters stay above it, so that a line is built and parsed once and not for each use of ``v``.
    read = F.struct(text.alias("line"), F.try_parse_json(text).alias("v"))
    parsed = lines.select(*keep, F.inline(F.array(read))).where("line <> ''")
    if strict:
        bad = F.raise_error(F.concat(F.lit("not JSON: "), F.col("line"))).cast("boolean")
        is_object = F.when(F.col("v").isNull(), bad).otherwise(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    else:
        is_object = F.col("v").isNotNull() & F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))

    def field(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("v", f"$.{name}", kind).alias(name)

    count = F.try_variant_get("v", "$.feature_count", "string").try_cast("double")
    return parsed.where(is_object).select(
        *keep,
        F.to_timestamp(F.try_variant_get("v", "$.timestamp_utc", "string")).alias("timestamp_utc"),
        field("request_id"),
        field("endpoint_name"),
        field("deployment_name"),
        field("model_name"),
        field("model_version"),
        field("row_count", "bigint"),
        field("captured_row_count", "bigint"),
        count.cast("bigint").alias("feature_count"),
        field("capture_source"),
        label_texts(F.col("line"), F.col("v")).alias(OUTPUT_LABELS),
    )


def _reading(line: Column) -> Column:
    """``accepted``, or why a line is no record."""
    text = F.trim(line)
    v = F.try_parse_json(text)
    return (
        F.when(text == "", "blank")
        .when(v.isNull(), "not_json")
        .when(~F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "not_object")
        .otherwise("accepted")
    )


def capture_rejects(lines: DataFrame) -> DataFrame:
    """How many lines were blank, no JSON, or no object."""
    return lines.groupBy(_reading(F.col("line")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def unreadable_lines(lines: DataFrame) -> DataFrame:
    """The lines that are no JSON or no object, with the ``reason``; blank and null lines are left out."""
    told = lines.where(F.col("line").isNotNull()).withColumn("reason", _reading(F.col("line")))
    return told.where(F.col("reason").isin("not_json", "not_object"))


def prediction_distribution(records: DataFrame, by: list[str]) -> DataFrame:
    """Count per group and predicted label."""
    return (
        records.select(*by, F.explode(OUTPUT_LABELS).alias("label"))
        .groupBy(*by, "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def max_class_share(distribution: DataFrame, by: list[str]) -> DataFrame:
    return distribution.groupBy(*by).agg(
        F.sum("n").alias("predictions"), (F.max("n") / F.sum("n")).alias("max_single_class_share")
    )


def record_marks(records: DataFrame, keep: list[Column | str], expected_feature_count: int) -> DataFrame:
    """One row per record (``record`` true, no label) and one per prediction of it.

    Counting both together needs the parsed records only once.
    """
    fits = F.coalesce(F.col("feature_count"), F.lit(-1)) == expected_feature_count
    marks = F.concat(
        F.array(F.lit(None).cast("string")), F.coalesce(OUTPUT_LABELS, F.array().cast("array<string>"))
    )
    rows = records.select(*keep, fits.alias("fits"), F.posexplode(marks).alias("at", "label"))
    return rows.withColumn("record", F.col("at") == 0).drop("at")


def facts_of_marks(marks: DataFrame, by: list[Column | str], names: list[str]) -> DataFrame:
    """Record count, schema consistency and label balance per group; two aggregations, one shuffle key."""
    counts = marks.groupBy(*by, "record", "label").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("fits").alias("fits")
    )
    labelled = F.when(~F.col("record"), F.col("n"))
    return counts.groupBy(*names).agg(
        F.sum(F.when(F.col("record"), F.col("n"))).alias("record_count"),
        F.bool_and("fits").alias("schema_consistent"),
        F.coalesce(F.sum(labelled), F.lit(0)).alias("predictions"),
        F.coalesce(F.max(labelled) / F.sum(labelled), F.lit(0.0)).alias("max_single_class_share"),
    )


def capture_facts(records: DataFrame, by: list[str], expected_feature_count: int) -> DataFrame:
    """Per group: record count, whether every record has the expected width, label balance."""
    return facts_of_marks(record_marks(records, by, expected_feature_count), by, by)


def with_read_paths(facts: DataFrame, lines: DataFrame, path: str = "capture_path") -> DataFrame:
    """Facts with a row of zero records for every path that was read but holds no record.

    A path whose lines are blank or no objects was retrieved; only a path without any line
    is missing.
    """
    empty = lines.select(path).distinct().join(facts, path, "left_anti").select(
        path,
        F.lit(0).cast("long").alias("record_count"),
        F.lit(False).alias("schema_consistent"),
        F.lit(0).cast("long").alias("predictions"),
        F.lit(0.0).alias("max_single_class_share"),
    )
    return facts.unionByName(empty)


# --- evidence --------------------------------------------------------------------------


def capture_blob_path(uri: Column, strict: bool = True) -> Column:
    """Path inside the store for the two URI forms captures are written with.

    Anything else raises, or gives NULL with ``strict=False``.
    """
    # URI schemes.
    asset = F.startswith(uri, F.lit("azureml://")) & F.contains(uri, F.lit("/paths/"))
    blob = F.startswith(uri, F.lit("azureblob://")) & (F.size(F.split(uri, "/", 5)) == 5)
    path = F.when(asset, F.substring_index(F.regexp_replace(uri, "^.*?/paths/", "\u0000"), "\u0000", -1)).when(
        blob, F.element_at(F.split(uri, "/", 5), 5)
    )
    if not strict:
        return path
    bad = F.raise_error(F.concat(F.lit("unsupported capture URI: "), uri))
    return path.when(uri.isNull(), F.lit(None)).otherwise(bad.cast("string"))


def exact_evidence(manifests: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files named by a manifest, manifests whose file is absent). NULL paths are skipped."""
    named = manifests.where("capture_path is not null").withColumn(
        "path", capture_blob_path(F.col("capture_path"), strict=False)
    )
    usable = named.where("path is not null")
    return files.join(usable, "path", "left_semi"), usable.join(files, "path", "left_anti")


def capture_partition(timestamp: Column) -> Column:
    """Date part of an ISO timestamp as a path."""
    return F.translate(F.split_part(timestamp, F.lit("T"), F.lit(1)), "-", "/")


def capture_relative_path(
    prefix: Column, endpoint: Column, deployment: Column, timestamp: Column, request_id: Column, session: Column
) -> Column:
    """``prefix/yyyy/mm/dd/endpoint/deployment[/session]/request.jsonl`` of the non-empty parts."""
    def part(column: Column) -> Column:
        return F.nullif(column, F.lit(""))

    return F.concat_ws(
        "/",
        part(prefix),
        part(capture_partition(timestamp)),
        part(endpoint),
        part(deployment),
        part(session),
        F.concat(request_id, F.lit(".jsonl")),
    )


# --- records ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CaptureSettings:
    sample_rate: float = 1.0
    max_rows_per_request: int = 5
    capture_inputs: bool = True
    capture_outputs: bool = True
    redact_inputs: bool = False
    seed: int | str = 42


def sampled(requests: DataFrame, rate: float, key: str = "request_id", seed: int | str = 42) -> DataFrame:
    """Requests whose reproducible uniform number is below the rate; 0 none, 1 all."""
    if rate <= 0.0:
        return requests.where(F.lit(False))
    if rate >= 1.0:
        return requests
    return requests.where(uniform(seed, F.col(key)) < rate)


CAPTURE_IDENTITY = [
    "timestamp_utc", "request_id", "endpoint_name", "deployment_name", "model_name", "model_version",
]


def capture_records(scored: DataFrame, features: list[str], settings: CaptureSettings) -> DataFrame:
    """One record per request from scored rows (identity columns, pos, features, prediction).

    Only the first ``max_rows_per_request`` rows of a request are ever collected.
    """
    keep = F.col("pos") < settings.max_rows_per_request
    if settings.redact_inputs:
        row = F.create_map(F.lit("feature_count"), F.lit(float(len(features))))
    else:
        row = F.create_map(*[x for c in features for x in (F.lit(c), F.col(c).cast("double"))])
    captured = F.struct("pos", row.alias("row"), F.col("prediction").alias("prediction"))
    grouped = sampled(scored, settings.sample_rate, seed=settings.seed).groupBy(*CAPTURE_IDENTITY).agg(
        F.count(F.lit(1)).alias("row_count"),
        # collect_list skips the NULLs of rows beyond the bound.
        F.array_sort(
            F.collect_list(F.when(keep, captured)), lambda a, b: a["pos"] - b["pos"]
        ).alias("_rows"),
    )
    extra = []
    if settings.capture_inputs:
        extra.append(F.transform("_rows", lambda r: r["row"]).alias("inputs"))
    if settings.capture_outputs:
        extra.append(F.transform("_rows", lambda r: r["prediction"]).alias("outputs"))
    return grouped.select(
        *CAPTURE_IDENTITY,
        "row_count",
        F.least("row_count", F.lit(settings.max_rows_per_request)).alias("captured_row_count"),
        F.lit(len(features)).alias("feature_count"),
        *extra,
    )


# --- persistence of signals ------------------------------------------------------------

CHUNK_ROWS = 10_000


def signal_persistence(
    history: DataFrame, by: str, order: list[str], fired: str, runs: int = 2, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Add ``signal_persistence``: repeated_signal when the last ``runs`` runs all fired.

    Runs get their rank by distributed running totals; windows then cover chunks of at
    most ``chunk_rows`` ranks, each with the ``runs - 1`` rows before it as context. A
    deployment with most of the history is many chunks.
    """
    if runs - 1 >= chunk_rows:
        raise ValueError("runs must be smaller than chunk_rows")
    rows = history.withColumn("_order", F.struct(*order)).withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(rows, [by], "_order", ["_one"])
    rank = F.col("_one_before")
    chunk = F.floor(rank / chunk_rows)
    own = F.struct(chunk.alias("chunk"), F.lit(False).alias("context"))
    spill = F.when(rank % chunk_rows >= chunk_rows - (runs - 1), F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("context")))
    placed = ranked.withColumn("_place", F.explode(F.array_compact(F.array(own, spill)))).select("*", "_place.*")
    trailing = Window.partitionBy(by, "chunk").orderBy("_one_before").rowsBetween(-(runs - 1), 0)
    streak = F.sum(F.col(fired).cast("int")).over(trailing)
    return (
        placed.withColumn("_streak", streak)
        .where(~F.col("context"))
        .select(
            *history.columns,
            F.when(F.col("_streak") == runs, "repeated_signal").otherwise("single_event").alias("signal_persistence"),
        )
    )
