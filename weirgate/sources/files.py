"""CSV tables, prepared datasets and capture files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean a missing value in CSV files.
MISSING_TEXTS = (
    "", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "#NA", "#N/A N/A",
    "-NaN", "-nan", "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN",
)

# Columns of the raw churn table.
CHURN_SCHEMA = (
    "RowNumber int, CustomerId bigint, Surname string, CreditScore int, Geography string, Gender string, "
    "Age int, Tenure int, Balance double, NumOfProducts int, HasCrCard int, IsActiveMember int, "
    "EstimatedSalary double, Exited int"
)


def _listing(spark: SparkSession, path: str, glob: str) -> list[str] | None:
    """Sorted files under a directory, the path itself for a file, None when absent.

    Only file names are listed; at most one row per file comes to the driver.
    """
    try:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        rows = reader.load(path).select("path").orderBy("path").collect()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return [r.path for r in rows]


def typed(text: Column, kind: T.DataType) -> Column:
    """CSV text as a value: missing texts are NULL, anything else must parse."""
    known = F.when(~text.isin(*MISSING_TEXTS), text)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        # Whole numbers may be written as 3.0 when the column once had gaps.
        return F.regexp_replace(known, r"\.0*$", "").cast(kind)
    return known.cast(kind)


def _read_group(spark: SparkSession, files: list[str], header: list[str], schema: T.StructType | None) -> DataFrame:
    raw = T.StructType([T.StructField(h, T.StringType()) for h in header])
    frame = spark.read.schema(raw).option("header", True).option("mode", "FAILFAST").csv(files)
    kinds = {f.name: f.dataType for f in schema.fields} if schema else {}
    return frame.select(*[typed(F.col(f"`{h}`"), kinds.get(h, T.StringType())).alias(h) for h in header])


def infer_types(df: DataFrame) -> T.StructType:
    """bigint, double or string per text column, from all rows in one aggregation."""
    checks = []
    for i, name in enumerate(df.columns):
        c = F.col(f"`{name}`")
        checks += [
            F.bool_and(c.isNull() | c.rlike(r"^\s*[+-]?\d{1,18}\s*$")).alias(f"w{i}"),
            F.bool_and(c.isNull() | c.try_cast("double").isNotNull()).alias(f"d{i}"),
            F.count(c).alias(f"n{i}"),
        ]
    row = df.agg(*checks).first()
    fields = []
    for i, name in enumerate(df.columns):
        # A column without any value reads as a floating column of gaps.
        kind = T.DoubleType() if not row[f"n{i}"] else T.LongType() if row[f"w{i}"] else T.DoubleType() if row[f"d{i}"] else T.StringType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, strict_suffix: bool = True
) -> DataFrame:
    """A CSV file, or all ``*.csv`` of a directory united by column name.

    Files with the same header are read together; columns a file lacks are NULL. Without
    a schema the types are inferred from all rows.
    """
    is_file = path.rstrip("/").rsplit("/", 1)[-1].lower().endswith(".csv")
    files = _listing(spark, path, "*")
    if files is None:
        raise FileNotFoundError(f"no such path: {path}")
    single = len(files) == 1 and files[0].rstrip("/").endswith(path.rstrip("/").rsplit("/", 1)[-1]) and files[0].rsplit("/", 1)[-1] == path.rstrip("/").rsplit("/", 1)[-1]
    if single:
        if strict_suffix and not is_file:
            raise ValueError(f"not a .csv file: {path}")
    else:
        files = [f for f in files if f.endswith(".csv")]
        if not files:
            raise FileNotFoundError(f"no .csv files in {path}")
    wanted = T.StructType.fromDDL(schema) if schema else None
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in files:
        # The header row of one file: names only.
        header = tuple(spark.read.option("header", True).csv(file).columns)
        groups.setdefault(header, []).append(file)
    parts = [_read_group(spark, names, list(header), wanted) for header, names in groups.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if wanted is None:
        kinds = infer_types(merged)
        merged = merged.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kinds.fields])
    return merged


def read_prepared(spark: SparkSession, path: str) -> DataFrame:
    """A prepared dataset; both splits must be there, the error names the missing ones."""
    missing = [s for s in ("train", "test") if _listing(spark, f"{path}/split={s}", "*.parquet") in (None, [])]
    if missing:
        raise FileNotFoundError(f"prepared data in {path} lacks: {', '.join(missing)}")
    return spark.read.parquet(path)


def read_capture_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a capture file or of every ``*.jsonl`` below a directory."""
    reader = spark.read.option("recursiveFileLookup", True)
    if not path.endswith(".jsonl"):
        reader = reader.option("pathGlobFilter", "*.jsonl")
    return reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def read_requests(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(requests whose body is a JSON object, the others with the reason), one body per line."""
    rows = spark.read.text(path).select(F.col("value").alias("body"))
    return split_requests(rows)


def split_requests(rows: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Requests by whether ``body`` is a JSON object. Bytes are read as UTF-8."""
    text = F.col(body).cast("string")
    v = F.try_parse_json(text)
    kind = (
        F.when(v.isNull(), "not_json")
        .when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), "object")
        .otherwise("not_object")
    )
    tagged = rows.withColumn(body, text).withColumn("reason", kind)
    return tagged.where("reason = 'object'").drop("reason"), tagged.where("reason <> 'object'")
