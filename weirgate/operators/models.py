"""Classifier families, training over a prepared split, and trials over a parameter grid."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.functions.columns import known
from weirgate.operators.evaluate import classification_report
from weirgate.operators.pick import class_sizes
from weirgate.operators.prep import Prepared, prepare, with_class_weight
from weirgate.operators.select import best_by
from weirgate.operators.smote import smote
from weirgate.operators.validate import ValidationConfig, validate
from weirgate.session import cut_lineage, local_rows

MAX_TREE_DEPTH = 30
FEATURES, WEIGHT = "features", "weight"


@dataclass
class Built:
    """An estimator, the parameters it took, and what had to be changed or left out."""

    estimator: object
    applied: dict[str, object]
    notes: list[str] = field(default_factory=list)


def _logreg(params: dict, label: str, weight_sum: float, seed: int) -> Built:
    c = float(params.get("C", 1.0))
    notes = []
    if params.get("solver", "lbfgs") != "lbfgs":
        notes.append(f"solver {params['solver']} runs as lbfgs")
    # The penalty is on the mean loss here, so the strength is spread over the weights.
    estimator = LogisticRegression(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, maxIter=int(params.get("max_iter", 1000)),
        regParam=1.0 / (c * weight_sum), elasticNetParam=0.0, standardization=False,
    )
    return Built(estimator, {k: params[k] for k in ("C", "max_iter", "solver") if k in params}, notes)


def _depth(value: object, notes: list[str]) -> int:
    depth = int(value)
    if depth > MAX_TREE_DEPTH:
        notes.append(f"max_depth {depth} clamped to {MAX_TREE_DEPTH}")
    return min(depth, MAX_TREE_DEPTH)


def _forest(params: dict, label: str, weight_sum: float, seed: int) -> Built:
    notes: list[str] = []
    if "min_samples_split" in params:
        notes.append("min_samples_split has no counterpart")
    estimator = RandomForestClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed,
        numTrees=int(params.get("n_estimators", 100)), maxDepth=_depth(params.get("max_depth", 10), notes),
        minInstancesPerNode=int(params.get("min_samples_leaf", 4)),
        featureSubsetStrategy=str(params.get("max_features", "sqrt")),
    )
    taken = ("n_estimators", "max_depth", "min_samples_leaf", "max_features")
    return Built(estimator, {k: params[k] for k in taken if k in params}, notes)


def _boosted(params: dict, label: str, weight_sum: float, seed: int) -> Built:
    notes: list[str] = []
    estimator = GBTClassifier(
        featuresCol=FEATURES, labelCol=label, weightCol=WEIGHT, seed=seed,
        maxIter=int(params.get("n_estimators", 100)), maxDepth=_depth(params.get("max_depth", 6), notes),
        stepSize=float(params.get("learning_rate", 0.1)), subsamplingRate=float(params.get("subsample", 0.8)),
        featureSubsetStrategy=str(float(params.get("colsample_bytree", 0.8))),
    )
    taken = ("n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "scale_pos_weight")
    return Built(estimator, {k: params[k] for k in taken if k in params}, notes)


# Add a family by adding a builder.
FAMILIES: dict[str, Callable[[dict, str, float, int], Built]] = {
    "logreg": _logreg,
    "rf": _forest,
    "xgboost": _boosted,
}
KNOWN_PARAMETERS = {
    "logreg": {"C", "max_iter", "solver"},
    "rf": {"n_estimators", "max_depth", "min_samples_leaf", "min_samples_split", "max_features"},
    "xgboost": {"n_estimators", "max_depth", "learning_rate", "subsample", "colsample_bytree", "scale_pos_weight"},
}


def build(family: str, params: dict | None, label: str, weight_sum: float, seed: int = 42) -> Built:
    """Estimator of a family; parameters it does not know are left out and reported."""
    if family not in FAMILIES:
        raise ValueError(f"unknown model {family!r}; choose from {sorted(FAMILIES)}")
    given = dict(params or {})
    if isinstance(given.get("min_samples_split"), (int, float)) and given["min_samples_split"] < 2:
        given["min_samples_split"] = 2
    unknown = sorted(set(given) - KNOWN_PARAMETERS[family])
    built = FAMILIES[family]({k: v for k, v in given.items() if k not in unknown}, label, weight_sum, seed)
    built.notes += [f"unknown parameter {name} ignored" for name in unknown]
    return built


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector with gaps as NaN, so that rows are never dropped silently."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features})
    return VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="keep").transform(filled)


def fill_gaps(df: DataFrame, train: DataFrame, features: list[str]) -> DataFrame:
    """Replace missing values by the training mean; one pass over the training rows."""
    row = train.agg(*[F.avg(known(train, c).cast("double")).alias(c) for c in features]).first()
    return df.withColumns(
        {c: F.coalesce(known(df, c).cast("double"), F.lit(row[c] if row[c] is not None else 0.0)) for c in features}
    )


def weighted(
    df: DataFrame, label: str, family: str, class_weight: str | None, params: dict | None
) -> DataFrame:
    """Row weights of the family: balanced classes, or negatives/positives for boosted trees."""
    if family == "xgboost":
        given = (params or {}).get("scale_pos_weight")
        if given is not None:
            return df.withColumn(WEIGHT, F.when(F.col(label) == 1, float(given)).otherwise(1.0))
        if class_weight == "balanced":
            sizes = class_sizes(df, label)
            if sizes.get(0) and sizes.get(1):
                return df.withColumn(WEIGHT, F.when(F.col(label) == 1, sizes[0] / sizes[1]).otherwise(1.0))
        return df.withColumn(WEIGHT, F.lit(1.0))
    if class_weight == "balanced":
        return with_class_weight(df, label, WEIGHT)
    return df.withColumn(WEIGHT, F.lit(1.0))


@dataclass(frozen=True)
class Fitted:
    family: str
    model: Model
    features: list[str]
    applied: dict[str, object]
    notes: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` (0/1) and ``score`` (probability of class 1)."""
        scored = self.model.transform(assemble(df, self.features))
        return scored.select(
            *df.columns,
            F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("score"),
        )


def train_model(
    train: DataFrame,
    family: str,
    features: list[str],
    label: str,
    params: dict | None = None,
    class_weight: str | None = "balanced",
    seed: int = 42,
) -> Fitted:
    rows = weighted(train, label, family, class_weight, params)
    total = rows.agg(F.sum(WEIGHT)).first()[0]
    built = build(family, params, label, float(total), seed)
    model = built.estimator.fit(assemble(rows, features).select(FEATURES, label, WEIGHT))
    return Fitted(family, model, features, built.applied, built.notes)


def evaluate_model(fitted: Fitted, test: DataFrame, label: str) -> DataFrame:
    """One row: model_name, confusion counts, metrics, AUC."""
    report = classification_report(fitted.transform(test), label, "prediction", "score")
    return report.select(F.lit(fitted.family).alias("model_name"), *report.columns)


METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc")
RESULT_SCHEMA = (
    "seq int, model_name string, run_id string, metrics map<string,double>, applied map<string,string>, "
    "class_weight string, warnings array<string>"
)


def _balance(train: DataFrame, prepared: Prepared, seed: int) -> DataFrame:
    """Oversampled training rows with the original types."""
    return smote(train, prepared.features, prepared.target, prepared.key, seed=seed).drop("draw")


def training_sides(prepared: Prepared, use_smote: bool = False, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) written once, gaps filled from the training rows, optionally oversampled."""
    filled = cut_lineage(fill_gaps(prepared.data, prepared.side("train"), prepared.features))
    train = filled.where(F.col("split") == "train").drop("split")
    test = filled.where(F.col("split") == "test").drop("split")
    if use_smote:
        train = cut_lineage(_balance(train, prepared, seed))
    return train, test


def train_families(
    prepared: Prepared,
    families: tuple[str, ...] = ("logreg", "rf", "xgboost"),
    params: dict[str, dict] | None = None,
    class_weight: str | None = "balanced",
    use_smote: bool = False,
    seed: int = 42,
) -> tuple[DataFrame, dict[str, Fitted]]:
    """Fit every family on the same split; any failure fails the stage.

    Oversampling and class weights exclude each other; the result row records the weight
    that was really used, and warns about tiny test sides.
    """
    for family in families:
        if family not in FAMILIES:
            raise ValueError(f"unknown model {family!r}; choose from {sorted(FAMILIES)}")
    effective = None if use_smote else class_weight
    train, test = training_sides(prepared, use_smote, seed)
    fitted = {
        family: train_model(train, family, prepared.features, prepared.target, (params or {}).get(family), effective, seed)
        for family in families
    }
    return _results(fitted, test, prepared.target, effective), fitted


def _results(fitted: dict[str, Fitted], test: DataFrame, label: str, effective: str | None) -> DataFrame:
    """One metrics row per fitted model: a handful of rows, however large the data."""
    rows = []
    for i, (name, model) in enumerate(fitted.items()):
        metrics = evaluate_model(model, test, label).first().asDict()
        n = sum(metrics[c] for c in ("tp", "fp", "fn", "tn"))
        warnings = list(model.notes)
        if n < 20:
            warnings.append(f"test side has only {n} rows, metrics are unstable")
            if all(metrics[m] == 1.0 for m in METRIC_NAMES):
                warnings.append("every metric is 1.0 on a tiny test side, this shows wiring and not quality")
        applied = {k: str(v) for k, v in model.applied.items()}
        rows.append((i, model.family, f"run-{name}", {m: metrics[m] for m in METRIC_NAMES}, applied, effective, warnings))
    return local_rows(test.sparkSession, rows, RESULT_SCHEMA)


def run_trials(
    prepared: Prepared,
    trials: list[tuple[str, str, dict]],
    class_weight: str | None = "balanced",
    use_smote: bool = False,
    max_concurrent: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Fit parameter sets ``(trial_id, family, params)`` side by side; a failed one gets a row too.

    The trial list comes from :func:`weirgate.operators.search.sample_trials`, bounded by
    its budget; each fit is a Spark job over the shared split.
    """
    effective = None if use_smote else class_weight
    train, test = training_sides(prepared, use_smote, seed)

    def one(trial: tuple[str, str, dict]) -> tuple:
        trial_id, family, params = trial
        try:
            model = train_model(train, family, prepared.features, prepared.target, params, effective, seed)
            metrics = evaluate_model(model, test, prepared.target).first().asDict()
            return (trial_id, family, "finished", {m: metrics[m] for m in METRIC_NAMES}, None)
        except Exception as error:  # noqa: BLE001 - one bad trial must not end the search
            return (trial_id, family, "failed", {}, f"{type(error).__name__}: {error}")

    with ThreadPoolExecutor(max_concurrent) as pool:
        rows = list(pool.map(one, trials))
    return local_rows(
        prepared.data.sparkSession, rows,
        "run_id string, model_name string, status string, metrics map<string,double>, error string",
    )


def best_candidate_summary(results: DataFrame, by: list[str] = ()) -> DataFrame:
    """Best row by F1 with its metrics; the first in training order wins ties."""
    return best_by(results, "f1", "seq", list(by))


def smoke(df: DataFrame, *, target: str, key: str, drop: list[str], categorical: list[str], config: ValidationConfig) -> DataFrame:
    """Self-test: prepare, validate the table against itself, train, one summary row."""
    pinned = cut_lineage(df)
    prepared = prepare(pinned, target=target, key=key, drop=drop, categorical=categorical)
    gate = validate(pinned, pinned, config).first()
    results, _ = train_families(prepared, ("logreg",))
    best = best_candidate_summary(results).first()
    meta = prepared.metadata().first()
    row = (gate.status, gate.drifted_column_share, meta.train_rows, meta.test_rows, best.model_name, best.metrics["f1"])
    return local_rows(
        df.sparkSession, [row],
        "validation_status string, drifted_column_share double, train_rows bigint, test_rows bigint, model_name string, f1 double",
    )
