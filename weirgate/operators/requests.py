"""Scoring requests as a table: validate, align, score, and keep evidence."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_FEATURE_COUNT = 10
PREVIEW_LENGTH = 500
NUMBERS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def validate_requests(requests: DataFrame, expected: int = DEFAULT_FEATURE_COUNT, body: str = "body") -> DataFrame:
    """Add ``rows``, ``status``, ``error``, ``error_row``, ``error_column``.

    A body must be an object whose ``input_data`` is a non-empty list of lists of
    ``expected`` numbers; booleans are not numbers. The first defect in reading order is
    reported. ``rows`` is array<array<double>>, NULL for rejected requests.
    """
    v = F.try_parse_json(body)
    is_object = F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))

    def first_text(cell: Column) -> Column:
        return ~F.coalesce(F.schema_of_variant(cell).rlike(NUMBERS), F.lit(False))

    def defect(row: Column, i: Column) -> Column:
        cells = F.try_variant_get(row, "$", "array<variant>")
        bad = F.filter(F.transform(cells, lambda c, j: F.when(first_text(c), j)), lambda j: j.isNotNull())

        def report(code: str, column: Column | None = None) -> Column:
            place = F.lit(None).cast("int") if column is None else column.cast("int")
            return F.struct(F.lit(code).alias("error"), i.cast("int").alias("row"), place.alias("column"))

        return (
            F.when(cells.isNull(), report("row_not_list"))
            .when(F.size(cells) != expected, report("wrong_feature_count"))
            .when(F.size(bad) > 0, report("not_numeric", F.get(bad, F.lit(0))))
        )

    parsed = requests.withColumn("_v", v).withColumn(
        "_list", F.when(is_object, F.try_variant_get("_v", "$.input_data", "array<variant>"))
    )
    defects = parsed.withColumn(
        "_first", F.get(F.filter(F.transform("_list", defect), lambda d: d.isNotNull()), F.lit(0))
    )
    has_field = F.try_variant_get("_v", "$.input_data", "variant").isNotNull()
    error = (
        F.when(F.col("_v").isNull(), "not_json")
        .when(~is_object, "not_object")
        .when(~has_field, "input_data_missing")
        .when(F.col("_list").isNull() | (F.size("_list") == 0), "input_data_empty")
        .otherwise(F.col("_first.error"))
    )
    rows = F.try_variant_get("_v", "$.input_data", "array<array<double>>")
    return defects.withColumn("error", error).select(
        *requests.columns,
        F.when(F.col("error").isNull(), rows).alias("rows"),
        F.when(F.col("error").isNull(), "passed").otherwise("failed").alias("status"),
        "error",
        F.col("_first.row").alias("error_row"),
        F.col("_first.column").alias("error_column"),
    )


def align_features(valid: DataFrame, names: list[str] | None = None, expected: int = DEFAULT_FEATURE_COUNT) -> DataFrame:
    """One row per input row: the request's columns, ``pos`` and one column per feature."""
    names = names or [f"feature_{i}" for i in range(expected)]
    keep = [c for c in valid.columns if c not in ("rows", "status", "error", "error_row", "error_column", "body")]
    exploded = valid.where("status = 'passed'").select(*keep, F.posexplode("rows").alias("pos", "_row"))
    return exploded.select(*keep, "pos", *[F.get("_row", F.lit(i)).alias(n) for i, n in enumerate(names)])


def prediction_column(columns: list[str], inputs: list[str]) -> str | list[str]:
    """The ``prediction`` column, else the only new column, else all new columns."""
    if "prediction" in columns:
        return "prediction"
    new = [c for c in columns if c not in inputs]
    return new[0] if len(new) == 1 else new


def score_rows(aligned: DataFrame, model: Transformer) -> DataFrame:
    """Apply a fitted model; ``prediction`` holds its normalised output."""
    scored = model.transform(aligned)
    chosen = prediction_column(scored.columns, aligned.columns)
    output = F.col(chosen) if isinstance(chosen, str) else F.struct(*chosen)
    return scored.select(*aligned.columns, output.alias("prediction"))


def responses(scored: DataFrame, by: list[str]) -> DataFrame:
    """Predictions per request, in input order."""
    pairs = F.array_sort(
        F.collect_list(F.struct("pos", "prediction")), lambda a, b: a["pos"] - b["pos"]
    )
    return scored.groupBy(*by).agg(F.transform(pairs, lambda p: p["prediction"]).alias("outputs"))


def linear_scores(valid: DataFrame, weights: list[float], intercept: float) -> DataFrame:
    """Outputs of a linear model inside the row, without exploding requests."""
    def score(row: Column) -> Column:
        total = F.lit(intercept)
        for i, w in enumerate(weights):
            total = total + F.get(row, F.lit(i)) * w
        return F.when(total > 0, 1).otherwise(0)

    return valid.where("status = 'passed'").withColumn("outputs", F.transform("rows", score))


def response_outputs(response: Column) -> Column:
    """Response text as JSON outputs: a list as it is, other JSON wrapped, plain text wrapped as text."""
    v = F.try_parse_json(response)
    is_list = F.startswith(F.schema_of_variant(v), F.lit("ARRAY"))
    return (
        F.when(v.isNull(), F.to_json(F.array(response)))
        .when(is_list, response)
        .otherwise(F.concat(F.lit("["), response, F.lit("]")))
    )


def preview(response: Column) -> Column:
    """The first 500 characters, with ``...`` when there is more."""
    return F.when(F.length(response) <= PREVIEW_LENGTH, response).otherwise(
        F.concat(F.left(response, F.lit(PREVIEW_LENGTH)), F.lit("..."))
    )


def canary_records(scored: DataFrame, response: str = "response") -> DataFrame:
    """Evidence per scored request: payload shape, endpoint, model, response preview.

    Reads request_id, rows, endpoint_name, deployment_name, model_name, model_version.
    """
    return scored.select(
        "request_id",
        F.struct(
            F.lit("input_data_2d_array").alias("format"),
            F.size("rows").alias("row_count"),
            F.size(F.get("rows", F.lit(0))).alias("feature_count"),
            F.lit("passed").alias("validation_status"),
        ).alias("payload"),
        F.struct("endpoint_name", "deployment_name").alias("endpoint"),
        F.struct(F.col("model_name").alias("name"), F.col("model_version").alias("version")).alias("model"),
        F.struct(preview(F.col(response)).alias("preview")).alias("response"),
    )
