"""Sales regression: feature checks, leakage, models, metrics. Training and scoring are distributed (Spark ML)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions import amounts
from marketloom.operators import cleaning, profiling
from marketloom.schema import ID_COLUMNS, TARGET, numeric_columns

FEATURES, PREDICTION = "features", "prediction"

# Fixed values that must equal the reference's for right results.
SEED = 42
TRAIN_PERCENT = 80
TREES = 100
BOOSTING = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1}
CORRELATED, LEAKING, RECHECK, IDENTICAL = 0.95, 0.95, 0.9, 0.999


# --- the feature matrix ----------------------------------------------------------------------------------------------


def feature_columns(df: DataFrame, target: str = TARGET, exclude: Sequence[str] = ID_COLUMNS) -> list[str]:
    """All numeric columns but the target and the excluded ones."""
    return [c for c in numeric_columns(df) if c != target and c not in exclude]


def feature_list(df: DataFrame, target: str = TARGET, exclude: Sequence[str] = ID_COLUMNS) -> DataFrame:
    chosen = set(feature_columns(df, target, exclude))
    rows = [(c, t, "target" if c == target else "feature" if c in chosen else "left out") for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "column string, type string, role string")


def fill_features(df: DataFrame, features: Sequence[str], target: str | None = TARGET, exact: bool = True) -> DataFrame:
    """Fill missing features and target with their median; a column without any value becomes 0.

    One scan tells which columns miss values; medians are looked for only in these. The input is read several times.
    """
    columns = [*features, *([target] if target else [])]
    missing = cleaning.missing_counts(df.select(*columns))
    medians = cleaning.numeric_fills(df, [c for c in columns if missing[c]], "median", exact)
    return cleaning.fill_numeric(df, columns, {c: medians.get(c, 0.0) for c in columns})


def constant_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with at most one distinct value; one scan for minima and maxima."""
    stats = profiling.nan_to_null(df.select(*columns)).agg(
        *[e.alias(f"{k}_{i}") for i, c in enumerate(columns) for k, e in (("min", F.min(c)), ("max", F.max(c)))]
    )
    cells = {
        c: [F.col(f"min_{i}").eqNullSafe(F.col(f"max_{i}")), F.col(f"min_{i}").cast("double")] for i, c in enumerate(columns)
    }
    return profiling.unpivot(stats, cells, ["constant", "value"]).where("constant").drop("constant")


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error").transform(df)


def correlated_pairs(df: DataFrame, columns: Sequence[str], threshold: float = CORRELATED) -> DataFrame:
    """Pairs of columns without missing values whose correlation is above the threshold in absolute value.

    The driver holds one number per pair of columns, whatever the number of rows.
    """
    columns = list(columns)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    matrix = Correlation.corr(assemble(doubles, columns), FEATURES).first()[0].toArray()
    pairs = [
        (columns[i], columns[j], float(matrix[i, j]))
        for i in range(len(columns))
        for j in range(i + 1, len(columns))
        if abs(matrix[i, j]) > threshold
    ]
    return df.sparkSession.createDataFrame(pairs, "left_column string, right_column string, correlation double")


# --- relation to the target ------------------------------------------------------------------------------------------


def _with_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """One row per (column, row): its value ``x`` and the target ``y``. Grouped right after, so nothing large moves."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
    return df.select(F.col(target).cast("double").alias("y"), F.inline(pairs))


def pearson(x: str, y: str):
    """Correlation over the rows that have both values; null, not an error, if one of them does not vary."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def target_correlation(df: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """(column, correlation) with the target over the rows that have both; columns without one are left out."""
    found = _with_target(df, columns, target).groupBy("column").agg(pearson("x", "y").alias("correlation"))
    return found.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))


def strongest(correlations: DataFrame, k: int = 10) -> DataFrame:
    return correlations.orderBy(F.desc(F.abs("correlation")), "column").limit(k)


def target_identity(df: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """Columns that equal the target on every row, or follow it almost perfectly."""
    same = F.bool_and(F.col("x").eqNullSafe(F.col("y"))).cast("int").alias("identical")
    found = _with_target(df, columns, target).groupBy("column").agg(same, pearson("x", "y").alias("correlation"))
    return found.where((F.col("identical") == 1) | (F.col("correlation") > IDENTICAL))


def leakage_columns(df: DataFrame, columns: Sequence[str], target: str = TARGET, threshold: float = LEAKING) -> DataFrame:
    """Columns that give the target away: by correlation, or by a name made from the target's."""
    found = target_correlation(df, columns, target)
    named = [c for c in columns if target in c]
    by_name = F.col("column").isin(named) if named else F.lit(False)
    known = df.sparkSession.createDataFrame([(c,) for c in columns], "column string").join(found, "column", "left")
    reason = F.when(F.abs("correlation") > threshold, "correlation").when(by_name, "name")
    return known.withColumn("reason", reason).where(F.col("reason").isNotNull())


def clean_features(df: DataFrame, columns: Sequence[str], target: str = TARGET) -> tuple[list[str], list[str]]:
    """(columns without leakage, columns among them that still correlate above 0.9)."""
    leaking = {r["column"] for r in leakage_columns(df, columns, target).collect()}  # one row per column at most
    kept = [c for c in columns if c not in leaking]
    again = target_correlation(df, kept, target).where(F.abs("correlation") > RECHECK).collect() if kept else []
    return kept, [r["column"] for r in again]


# --- split, models, metrics ------------------------------------------------------------------------------------------


def split_flag(keys: Sequence[str], percent: int = TRAIN_PERCENT, seed: int = SEED):
    """True for the training share. Decided by a hash of the row's key, so it survives retries and repartitioning.

    The hash is the first seven hex digits of the MD5 of the key's values and the seed, joined by commas, which other engines
    know too; missing values count as empty.
    """
    key = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("long") % 100 < percent


def split(df: DataFrame, keys: Sequence[str], percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(keys, percent, seed)
    return df.where(flag), df.where(~flag)


def estimator(kind: str, target: str = TARGET, **settings):
    """``linear``, ``forest`` or ``boosting``.

    The forest looks at all features in every split, like the reference's, and grows its trees as deep as Spark can
    (``maxDepth`` 30; a smaller one is much faster); ``maxMemoryInMB`` lets one scan of the data grow more nodes.
    """
    base = {"featuresCol": FEATURES, "labelCol": target, "predictionCol": PREDICTION}
    if kind == "linear":
        return LinearRegression(**{**base, **settings})
    if kind == "forest":
        forest = {"numTrees": TREES, "maxDepth": 30, "featureSubsetStrategy": "all", "maxMemoryInMB": 1024, "seed": SEED}
        return RandomForestRegressor(**{**base, **forest, **settings})
    if kind == "boosting":
        return GBTRegressor(**{**base, **BOOSTING, "seed": SEED, **settings})
    raise ValueError(f"unknown model: {kind}")


def fit(kind: str, train: DataFrame, features: Sequence[str], target: str = TARGET, **settings):
    return estimator(kind, target, **settings).fit(assemble(train, features).select(FEATURES, target))


def predict(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows with ``prediction``."""
    return model.transform(assemble(df, features)).drop(FEATURES)


def fit_predict(kind: str, train: DataFrame, test: DataFrame, features: Sequence[str], target: str = TARGET, **settings):
    """(fitted model, test rows with ``prediction``)."""
    model = fit(kind, train, features, target, **settings)
    return model, predict(model, test, features)


def regression_metrics(df: DataFrame, label: str = TARGET, prediction: str = PREDICTION) -> DataFrame:
    """mse, rmse, mae, r2 and mape (over non-zero labels) from one scan."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    sums = df.where(y.isNotNull() & p.isNotNull()).agg(
        amounts.row_count().alias("rows"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("__variance"),
        (F.avg(F.when(y != 0, F.abs(error / y))) * 100).alias("mape"),
    )
    return sums.select(
        "rows", "mse", F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide("mse", "__variance")).alias("r2"), "mape"
    )


def importances(df: DataFrame, model, features: Sequence[str], k: int = 10) -> DataFrame:
    """The k most important features of a tree model."""
    values = model.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def prediction_check(df: DataFrame, label: str = TARGET, prediction: str = PREDICTION) -> DataFrame:
    """Ranges of labels and predictions, and whether all predictions are as good as equal to the labels."""
    y, p = F.col(label), F.col(prediction)
    close = F.abs(p - y) <= 1e-8 + 1e-5 * F.abs(y)
    return df.agg(
        F.min(y).alias("label_min"),
        F.max(y).alias("label_max"),
        F.min(p).alias("prediction_min"),
        F.max(p).alias("prediction_max"),
        F.bool_and(F.coalesce(close, F.lit(False))).cast("int").alias("all_close"),
    )


def range_check(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum and missing values of each feature in both parts."""

    def part(df: DataFrame, name: str) -> DataFrame:
        stats = df.agg(
            *[
                e.alias(f"{k}_{i}")
                for i, c in enumerate(columns)
                for k, e in (
                    ("min", F.min(c).cast("double")),
                    ("max", F.max(c).cast("double")),
                    ("missing", F.count(F.when(profiling.is_missing(df, c), 1))),
                )
            ]
        )
        cells = {c: [F.col(f"{k}_{i}") for k in ("min", "max", "missing")] for i, c in enumerate(columns)}
        return profiling.unpivot(stats, cells, ["min", "max", "missing"]).withColumn("part", F.lit(name))

    return part(train, "train").unionByName(part(test, "test"))
