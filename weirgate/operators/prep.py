"""Leakage-safe feature preparation: exact stratified split, codes, scaling, weights."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.columns import known, numeric_columns, present
from weirgate.operators.ordered import running_totals
from weirgate.operators.pick import HashCut, class_sizes, pick_by_hash
from weirgate.session import cut_lineage, local_rows, small_side


def remove_columns(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Drop those of ``columns`` the frame has; also return their names in request order."""
    dropped = present(df, columns)
    return df.drop(*dropped), dropped


def feature_columns(df: DataFrame, target: str, key: str | None = None) -> list[str]:
    """Everything but the target and the row key. Features and label stay in one frame."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is not in the data")
    return [c for c in df.columns if c not in (target, key)]


# --- split -----------------------------------------------------------------------------


def train_quotas(sizes: dict[object, int], test_size: float | int) -> dict[object, int]:
    """Training rows per class: proportional, remainders to the largest fractions.

    Equal fractions go to the smaller class label.
    """
    total = sum(sizes.values())
    test = math.ceil(test_size * total) if isinstance(test_size, float) else int(test_size)
    train = total - test
    if not 0 < test < total:
        raise ValueError("both sides of the split must get rows")
    if min(sizes.values()) < 2:
        raise ValueError("each class needs at least 2 rows to be stratified")
    if min(train, test) < len(sizes):
        raise ValueError("each side needs at least one row per class")
    shares = {c: n * train / total for c, n in sizes.items()}
    quotas = {c: math.floor(s) for c, s in shares.items()}
    order = sorted(sizes, key=lambda c: (-(shares[c] - quotas[c]), c))
    for c in order[: train - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def fit_split(
    df: DataFrame, label: str, key: str, test_size: float | int = 0.2, seed: int = 42, stratify: bool = True
) -> HashCut:
    """Rule that sends an exact number of rows per class to the test side."""
    if stratify:
        sizes = class_sizes(df, label)
        quotas = train_quotas(sizes, test_size)
        return pick_by_hash(df, label, key, {c: sizes[c] - q for c, q in quotas.items()}, seed)
    total = df.count()
    test = math.ceil(test_size * total) if isinstance(test_size, float) else int(test_size)
    if not 0 < test < total:
        raise ValueError("both sides of the split must get rows")
    flat = df.withColumn("_all", F.lit(0))
    return pick_by_hash(flat, "_all", key, {0: test}, seed)


def split(df: DataFrame, rule: HashCut) -> DataFrame:
    """Add ``split`` = train/test."""
    frame = df if rule.label in df.columns else df.withColumn(rule.label, F.lit(0))
    tagged = rule.chosen(frame, "_test").withColumn(
        "split", F.when(F.col("_test"), "test").otherwise("train")
    )
    return tagged.drop("_test", *([] if rule.label in df.columns else [rule.label]))


# --- categorical codes -----------------------------------------------------------------


def fit_encoders(df: DataFrame, columns: list[str], missing: str = "error") -> DataFrame:
    """(column, value, code): position of each value in sorted order, from 0.

    Missing categories are left out; ``missing="extra"`` gives them the code after the
    last value.
    """
    columns = present(df, columns)
    cells = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    )
    distinct = cells.groupBy("column", "value").agg(F.lit(1).cast("long").alias("one"))
    ranked = running_totals(distinct.where("value is not null"), ["column"], "value", ["one"])
    coded = ranked.select("column", "value", F.col("one_before").cast("int").alias("code"))
    if missing == "extra":
        last = coded.groupBy("column").agg((F.max("code") + 1).cast("int").alias("code"))
        gaps = distinct.where("value is null").join(last, "column").select("column", "value", "code")
        coded = coded.unionByName(gaps)
    return coded


def encode(
    df: DataFrame, encoders: DataFrame, columns: list[str], on_unseen: str = "error"
) -> DataFrame:
    """Replace categories by their codes.

    ``on_unseen``: ``error`` raises on a value without a code, ``null`` leaves NULL,
    ``extra`` uses the number of known values.
    """
    out = df
    for name in present(df, columns):
        lookup = small_side(
            encoders.where(F.col("column") == name).select(
                F.col("value").alias("_value"), F.col("code").alias("_code")
            ),
            max_rows=1_000_000,
        )
        code = F.col("_code")
        if on_unseen == "error":
            text = F.concat(F.lit(f"unseen value in {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("NULL")))
            code = F.when(code.isNotNull(), code).otherwise(F.raise_error(text).cast("int"))
        elif on_unseen == "extra":
            code = F.coalesce(code, F.lit(lookup.count()))
        elif on_unseen != "null":
            raise ValueError(f"unknown on_unseen {on_unseen!r}")
        order = out.columns
        out = (
            out.join(lookup, F.col(name).cast("string").eqNullSafe(F.col("_value")), "left")
            .withColumn(name, code)
            .select(*order)
        )
    return out


# --- scaling ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; zero deviation scales by 1."""

    parameters: dict[str, tuple[float, float]] = field(default_factory=dict)

    def table(self, spark) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.parameters.items()]
        return local_rows(spark, rows, "column string, mean double, scale double")

    def apply(self, df: DataFrame) -> DataFrame:
        scaled = {
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, (m, s) in self.parameters.items()
            if c in df.columns
        }
        return df.withColumns(scaled) if scaled else df


def fit_scaler(df: DataFrame, columns: list[str] | None = None, exclude: list[str] = ()) -> Scaler:
    """One pass over the training rows for all columns."""
    names = [c for c in (columns or numeric_columns(df)) if c not in set(exclude)]
    if not names:
        return Scaler()
    row = df.agg(
        *[F.avg(known(df, c)).alias(f"m_{c}") for c in names],
        *[F.stddev_pop(known(df, c)).alias(f"s_{c}") for c in names],
    ).first()
    return Scaler({c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in names if row[f"m_{c}"] is not None})


# --- class balance ---------------------------------------------------------------------


def positive_weight(
    df: DataFrame, label: str, family: str = "xgboost", mode: str | None = "balanced", user_set: bool = False
) -> DataFrame:
    """negatives / positives for boosted trees in balanced mode; NULL where it does not apply."""
    applies = family == "xgboost" and mode == "balanced" and not user_set
    counts = df.agg(
        F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
    )
    usable = F.lit(applies) & (F.col("negatives") > 0) & (F.col("positives") > 0)
    return counts.withColumn(
        "scale_pos_weight", F.when(usable, F.try_divide(F.col("negatives").cast("double"), F.col("positives")))
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class; ordered over the class table only."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class: this window never sees the data rows.
    every = Window.partitionBy(F.lit(0))
    return counts.select(
        label,
        "n",
        (F.sum("n").over(every) / (F.count("n").over(every) * F.col("n"))).alias("weight"),
    )


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight on every row; the class table is tiny and checked, so no row moves."""
    sizes = class_sizes(df, label)
    total = sum(sizes.values())
    rows = [(value, total / (len(sizes) * n)) for value, n in sizes.items()]
    weights = local_rows(df.sparkSession, rows, f"{label} {dict(df.dtypes)[label]}, {name} double")
    return df.join(F.broadcast(weights), label, "left").select(*df.columns, name)


# --- the whole preparation -------------------------------------------------------------


@dataclass(frozen=True)
class Prepared:
    """One frame with ``split``, plus everything fitted on its training rows."""

    data: DataFrame
    encoders: DataFrame | None
    scaler: Scaler
    features: list[str]
    encoded: list[str]
    scaled: list[str]
    dropped: list[str]
    target: str
    key: str

    def side(self, name: str) -> DataFrame:
        return self.data.where(F.col("split") == name)

    def metadata(self) -> DataFrame:
        """One row: counts, label rates per split, and the columns by treatment."""
        t = F.col(self.target)
        in_train, in_test = F.col("split") == "train", F.col("split") == "test"

        def names(values: list[str]):
            return F.array(*[F.lit(v) for v in values]).cast("array<string>")

        return self.data.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count(F.when(in_train, 1)).alias("train_rows"),
            F.count(F.when(in_test, 1)).alias("test_rows"),
            F.avg(t).alias("label_rate"),
            F.avg(F.when(in_train, t)).alias("train_label_rate"),
            F.avg(F.when(in_test, t)).alias("test_label_rate"),
        ).select(
            "*",
            names(self.features).alias("feature_names"),
            names(self.encoded).alias("encoded_columns"),
            names(self.scaled).alias("scaled_columns"),
            names(self.dropped).alias("dropped_columns"),
        )


def prepare(
    df: DataFrame,
    *,
    target: str,
    key: str,
    drop: list[str] = (),
    categorical: list[str] = (),
    test_size: float | int = 0.2,
    seed: int = 42,
    stratify: bool = True,
    on_unseen: str = "error",
) -> Prepared:
    """Drop, split, then fit codes and scaling on the training rows and apply to both.

    The row key is kept beside the features, so rows never have to be matched by position.
    """
    kept, dropped = remove_columns(df, [c for c in drop if c != key])
    if key in drop:
        dropped = [c for c in drop if c in set(dropped) | {key}]
    features = feature_columns(kept, target, key)
    # Read once per fit below: split counts, codes, scaling, and the final rows.
    kept = cut_lineage(kept)
    tagged = split(kept, fit_split(kept, target, key, test_size, seed, stratify))
    train = tagged.where(F.col("split") == "train")
    encoded = present(kept, list(categorical))
    encoders, data = None, tagged
    if encoded:
        encoders = fit_encoders(train, encoded)
        data = encode(tagged, encoders, encoded, on_unseen)
    scaled = numeric_columns(kept.select(*features), exclude=encoded)
    scaler = fit_scaler(train, scaled) if scaled else Scaler()
    return Prepared(
        scaler.apply(data), encoders, scaler, features, encoded, scaled, dropped, target, key
    )
