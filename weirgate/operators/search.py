"""Search spaces, trial sampling, and turning a winner into a fixed training config."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.functions.columns import hash52

# Family prefixes of trial parameters, and parameters shared by families.
FAMILIES = ("rf", "logreg", "xgboost")
SHARED_PARAMETERS = ("use_smote", "class_weight", "random_state")


def expand_trials(spaces: DataFrame, parameters: list[str]) -> DataFrame:
    """Every combination of choices per (sweep_id, family).

    ``spaces``: sweep_id, family, shared map<string,array<string>>, space (same type).
    NULL choices are removed first; families with an empty space are skipped. Each
    parameter is one ``explode`` of the row's own choices, so nothing is joined. Family
    parameters get the ``family_`` prefix; shared ones do not.
    """
    clean = {
        name: F.map_filter(
            F.transform_values(name, lambda k, v: F.filter(v, lambda x: x.isNotNull())),
            lambda k, v: F.size(v) > 0,
        )
        for name in ("shared", "space")
    }
    rows = spaces.withColumns(clean).where(F.size("space") > 0)
    chosen = []
    for i, name in enumerate(parameters):
        source = "shared" if name in SHARED_PARAMETERS else "space"
        rows = rows.withColumn(f"_p{i}", F.explode_outer(F.col(source)[name]))
        key = F.lit(name) if source == "shared" else F.concat("family", F.lit(f"_{name}"))
        chosen.append(F.struct(key.alias("key"), F.col(f"_p{i}").alias("value")))
    present = F.filter(F.array(*chosen), lambda e: e["value"].isNotNull())
    return rows.select("sweep_id", "family", F.map_from_entries(present).alias("params"))


def trial_key(params: Column) -> Column:
    """Stable text of a parameter map."""
    pairs = F.transform(F.sort_array(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(pairs, ",")


def sample_trials(trials: DataFrame, max_trials: int, seed: int = 42) -> DataFrame:
    """At most ``max_trials`` per (sweep, family), in hash order."""
    keyed = trials.withColumn("trial", trial_key(F.col("params")))
    order = Window.partitionBy("sweep_id", "family").orderBy(
        hash52(seed, F.col("sweep_id"), F.col("trial")), "trial"
    )
    return keyed.withColumn("trial_no", F.row_number().over(order)).where(F.col("trial_no") <= max_trials)


# Rounds of the permutation, and steps of its walk back into the grid.
ROUNDS, WALK = 6, 64
MOST_POINTS = 1 << 62


def _permuted(x: Column, left: Column, right: Column, key: list[Column]) -> Column:
    """A keyed permutation of the numbers below ``left * right``: Feistel rounds that add a
    hash of one half to the other, each half in its own radix."""

    def step(s: Column, i: Column) -> Column:
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, *key), left), left)).otherwise(s["l"]).alias("l"),
            F.when(odd, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], i, *key), right), right)).alias("r"),
        )

    # Whole-number division; a double would lose the last digits of a large number.
    start = F.struct(F.call_function("div", x, right).alias("l"), F.pmod(x, right).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * right + s["r"])


def sample_grid(spaces: DataFrame, parameters: list[str], max_trials: int, seed: int = 42) -> DataFrame:
    """At most ``max_trials`` different trials of each (sweep_id, family), without the grid.

    ``spaces`` as for :func:`expand_trials`. Trial number ``t`` is sent to a point of the grid by
    a keyed permutation, and the point's digits in the radices of the choices name the
    parameters; so no two trials are equal, and a space with fewer points gives all of them.
    Every trial is computed from its number alone: one narrow job, whatever the grid's size
    (up to 2**62 points, beyond which it fails). The permuted domain is the smallest rectangle
    that holds the grid; a number outside the grid is permuted again until it is inside.
    """
    clean = {
        name: F.map_filter(
            F.transform_values(name, lambda k, v: F.filter(v, lambda x: x.isNotNull())), lambda k, v: F.size(v) > 0
        )
        for name in ("shared", "space")
    }
    rows = spaces.withColumns(clean).where(F.size("space") > 0)

    def choices(name: str) -> Column:
        return F.col("shared" if name in SHARED_PARAMETERS else "space")[name]

    sizes = {f"_n{i}": F.coalesce(F.size(choices(p)), F.lit(1)).cast("long") for i, p in enumerate(parameters)}
    sizes = {k: F.when(c < 1, F.lit(1)).otherwise(c).cast("long") for k, c in sizes.items()}
    rows = rows.withColumns(sizes)
    points = F.aggregate(F.array(*sizes), F.lit(1).cast("decimal(38,0)"), lambda a, n: (a * n).cast("decimal(38,0)"))
    large = F.raise_error(F.lit("a grid of more than 2**62 points")).cast("long")
    rows = rows.withColumn("_points", points).withColumn(
        "_points", F.when(F.col("_points") <= MOST_POINTS, F.col("_points").cast("long")).otherwise(large)
    )
    rows = rows.withColumn("_left", F.ceil(F.sqrt(F.col("_points").cast("double"))).cast("long"))
    rows = rows.withColumn("_right", F.expr("(_points + _left - 1) DIV _left"))
    numbered = rows.withColumn("trial_no", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("_points"), F.lit(max_trials)))))
    key = [F.lit(seed), F.col("sweep_id"), F.col("family")]
    first = F.col("trial_no") - 1

    def again(x: Column) -> Column:
        return _permuted(x, F.col("_left"), F.col("_right"), key)

    def inside(x: Column, otherwise: Column) -> Column:
        return F.when(x < F.col("_points"), x).otherwise(otherwise)

    # The first step mostly ends inside; only the others walk on.
    stepped = numbered.withColumn("_at", again(first))
    walk = F.aggregate(F.sequence(F.lit(2), F.lit(WALK)), F.col("_at"), lambda x, i: inside(x, again(x)))
    walked = stepped.withColumn("_at", inside(F.col("_at"), walk))
    lost = F.raise_error(F.lit("no point of the grid was reached")).cast("long")
    placed = walked.withColumn("_at", F.when(F.col("_at") < F.col("_points"), F.col("_at")).otherwise(lost))
    below = ["CAST(1 AS BIGINT)"]
    for i in range(len(parameters)):
        below.append(f"{below[-1]} * _n{i}")
    chosen = []
    for i, name in enumerate(parameters):
        digit = F.expr(f"CAST((_at DIV ({below[i]})) % _n{i} AS INT)")
        label = F.lit(name) if name in SHARED_PARAMETERS else F.concat("family", F.lit(f"_{name}"))
        chosen.append(F.struct(label.alias("key"), F.get(choices(name), digit).alias("value")))
    present = F.filter(F.array(*chosen), lambda e: e["value"].isNotNull())
    return placed.select("sweep_id", "family", "trial_no", F.map_from_entries(present).alias("params"))


def override_keys(params: Column) -> Column:
    """``rf_x`` becomes ``rf.x`` for the known families."""
    pattern = f"^({'|'.join(FAMILIES)})_"
    return F.transform_keys(params, lambda k, v: F.regexp_replace(k, pattern, "$1."))


def typed_scalar(text: Column, scientific: bool = False) -> Column:
    """struct(kind, value): which type a text stands for, and its trimmed text.

    A float needs a dot, so ``1e-3`` stays text unless ``scientific``.
    """
    word = F.trim(text)
    exponent = r"^[+-]?(\d+\.\d*|\.\d+|\d+(?=[eE]))([eE][+-]?\d+)?$" if scientific else r"^[+-]?(\d+\.\d*|\.\d+)([eE][+-]?\d+)?$"
    kind = (
        F.when(F.lower(word).isin("true", "false"), "bool")
        .when(word.rlike(r"^[+-]?\d+$"), "int")
        .when(word.rlike(exponent), "float")
        .when(text.isNotNull(), "text")
    )
    value = F.when(F.lower(word).isin("true", "false"), F.lower(word)).otherwise(word)
    return F.struct(kind.alias("kind"), value.alias("value"))


def loose_bool(value: Column, default: bool, strict: bool = True) -> Column:
    """yes/no words as booleans. Strict raises on anything else, lenient reads it as false."""
    # Accepted words.
    true_words, false_words = ("true", "1", "yes", "y", "on"), ("false", "0", "no", "n", "off")
    word = F.lower(F.trim(value.cast("string")))
    if not strict:
        return F.when(value.isNull(), F.lit(default)).otherwise(word.isin("1", "true", "yes", "on"))
    bad = F.raise_error(F.concat(F.lit("not a boolean: "), value.cast("string"))).cast("boolean")
    return (
        F.when(value.isNull(), F.lit(default))
        .when(word.isin(*true_words), F.lit(True))
        .when(word.isin(*false_words), F.lit(False))
        .otherwise(bad)
    )


def family_parameters(family: Column, params: Column) -> Column:
    """The ``family_*`` entries with the prefix removed."""
    prefix = F.concat(family, F.lit("_"))
    own = F.map_filter(params, lambda k, v: F.startswith(k, prefix))
    return F.transform_keys(own, lambda k, v: F.substr(k, F.length(prefix) + 1))


def clamp_min_samples(params: Column, known: list[str]) -> Column:
    """Keep known parameters; a numeric ``min_samples_split`` below 2 becomes 2."""
    kept = F.map_filter(params, lambda k, v: k.isin(*known))
    return F.transform_values(
        kept,
        lambda k, v: F.when((k == "min_samples_split") & (v.try_cast("double") < 2), F.lit("2")).otherwise(v),
    )


def winner_configs(winners: DataFrame, manifests: DataFrame) -> DataFrame:
    """Fixed training config per winner.

    ``winners``: (sweep_id, model_name). ``manifests``: (sweep_id, model_name, params
    map<string,string>), the trial that won. Run-level parameters are carried over;
    a winner without parameters of its own fails the job.
    """
    joined = winners.select("sweep_id", "model_name").join(manifests, ["sweep_id", "model_name"], "left")
    own = family_parameters(F.col("model_name"), F.coalesce("params", F.create_map().cast("map<string,string>")))
    checked = F.when(F.size(own) > 0, own).otherwise(
        F.raise_error(F.concat(F.lit("no winner parameters for "), F.col("model_name"))).cast("map<string,string>")
    )
    shared = {name: F.col("params")[name] for name in SHARED_PARAMETERS}
    return joined.select(
        "sweep_id",
        F.array("model_name").alias("models"),
        F.transform_values(checked, lambda k, v: typed_scalar(v)).alias("hyperparameters"),
        shared["class_weight"].alias("class_weight"),
        F.trim(shared["random_state"]).try_cast("bigint").alias("random_state"),
        loose_bool(shared["use_smote"], False).alias("use_smote"),
    )
