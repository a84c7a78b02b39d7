"""Popularity regression: data preparation, baseline, forest, search, report.

M1 outlier cut, M2 undersampling, M3 log target, M4 split, M5 mean baseline,
M6 metrics, M7-M10 assemble/scale/forest pipeline, M11 grid search with
k-fold CV (see ``search`` for the one that shares work), M12 report, M13 scoring.

Scalars (threshold, class sizes, training mean) enter the plans as scalar
subqueries, so nothing is collected on the data path. Sampling and splitting
default to salted digests of the key (repeatable, independent of each other,
checkable against SQL, trap T11); the engine's seeded ``sample``/``randomSplit`` are options.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scalar import safe_ln

# Fixed values of the reference's modeling set-up: outlier quantile, seed,
# folds, metric, and the 3 x 3 x 5 x 2 = 90-point forest grid.
OUTLIER_QUANTILE = 0.999
SEED = 0
NUM_FOLDS = 3
METRIC = "r2"
GRID_NUM_TREES = (64, 96, 128)
GRID_SUBSAMPLING = (0.5, 0.7, 1.0)
GRID_MIN_INSTANCES = (1, 5, 10, 15, 20)
GRID_STRATEGIES = ("sqrt", "all")

# Fixed values of the repeatable draw: the first hex digits of an MD5 taken as
# a number, and one salt per use, so sampling and splitting are independent.
DRAW_DIGITS = 13
SAMPLE_SALT = "sample"
SPLIT_SALT = "split"


def key_uniform(key: str, salt: str = "") -> Column:
    """A repeatable draw in [0, 1) from a key: md5('salt:key'), its first 13 hex digits / 16^13.

    Draws of different salts are independent of each other. A NULL key draws
    as the text 'null', so no row is without a draw.
    """
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10)
    return number.cast("double") / F.lit(float(16**DRAW_DIGITS))


def key_uniform_sql(key: str, salt: str = "") -> str:
    """``key_uniform`` in DuckDB SQL."""
    text = f"'{salt}:' || coalesce(CAST({key} AS VARCHAR), 'null')"
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, {DRAW_DIGITS}) AS BIGINT) AS DOUBLE) / {float(16**DRAW_DIGITS)})"


def remove_outliers(df: DataFrame, label: str, quantile: float = OUTLIER_QUANTILE, accuracy: int = 10000) -> DataFrame:
    """M1: keep rows with label strictly below its approximate ``quantile``."""
    threshold = df.select(F.percentile_approx(label, quantile, accuracy)).scalar()
    return df.where(F.col(label) < threshold)


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, n) per label value: the input for choosing undersampling classes."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def undersample(
    df: DataFrame,
    label: str,
    majority: float | Column = 1.0,
    minority: float | Column = 2.0,
    key: str = "pid",
    method: str = "hash",
    seed: int = 0,
) -> DataFrame:
    """M2: shrink the majority class to about the size of the minority class.

    Majority rows are drawn with fraction n(minority) / n(majority), clamped to
    1 (trap T10: the reference fails when the fraction exceeds 1 or
    n(majority) is 0); all other rows stay, those without a label too.
    ``method="hash"`` draws by the key (salt ``SAMPLE_SALT``);
    ``"bernoulli"`` uses ``rand(seed)``.
    """
    maj = majority if isinstance(majority, Column) else F.lit(majority)
    mino = minority if isinstance(minority, Column) else F.lit(minority)
    sizes = df.select(
        F.struct(
            F.count_if(F.col(label) == maj).alias("n_major"), F.count_if(F.col(label) == mino).alias("n_minor")
        )
    ).scalar()
    fraction = F.least(F.lit(1.0), F.try_divide(sizes["n_minor"].cast("double"), sizes["n_major"].cast("double")))
    draw = key_uniform(key, SAMPLE_SALT) if method == "hash" else F.rand(seed)
    return df.where(~F.col(label).eqNullSafe(maj) | (draw < fraction))


def log_target(df: DataFrame, label: str) -> DataFrame:
    """M3: replace the label by its natural log (NULL unless positive, T9)."""
    return df.withColumn(label, safe_ln(label))


def hash_split(df: DataFrame, key: str = "pid", train_fraction: float = 0.8, salt: str = SPLIT_SALT) -> tuple[DataFrame, DataFrame]:
    """M4: (train, test) by a digest of the key: the same rows every run and every action, each row in one set."""
    u = key_uniform(key, salt)
    return df.where(u < train_fraction), df.where(u >= train_fraction)


def with_baseline(train: DataFrame, test: DataFrame, label: str, out: str = "baseline_prediction"):
    """M5: the training mean of the label as a prediction column on both sets."""
    mean = train.select(F.avg(label)).scalar()
    return train.withColumn(out, mean), test.withColumn(out, mean)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """M6: one row (n, rmse, r2) — the numbers ``RegressionEvaluator`` gives.

    r2 = 1 - sum((y - p)^2) / sum((y - mean y)^2); rows with a NULL label or
    prediction are left out, as the evaluator does.
    """
    both = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    err = F.col(label) - F.col(prediction)
    agg = both.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(err * err).alias("ss_res"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("ss_tot"),
    )
    return agg.select(
        "n",
        F.sqrt(F.col("ss_res") / F.col("n")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.col("ss_res"), F.col("ss_tot"))).alias("r2"),
    )


def metrics_for_predictions(df: DataFrame, label: str, predictions: Sequence[str]) -> DataFrame:
    """M6 for several prediction columns of the same rows in one pass:
    (predictor, n, rmse, r2), one row per prediction column."""
    y = F.col(label)
    aggs = []
    for p in predictions:
        ok = y.isNotNull() & F.col(p).isNotNull()
        err = F.when(ok, y - F.col(p))
        aggs += [
            F.count_if(ok).alias(f"n__{p}"),
            F.sum(err * err).alias(f"res__{p}"),
            (F.var_pop(F.when(ok, y)) * F.count_if(ok)).alias(f"tot__{p}"),
        ]
    row = df.agg(*aggs)
    cells = F.array(
        *[
            F.struct(
                F.lit(p).alias("predictor"),
                F.col(f"n__{p}").alias("n"),
                F.sqrt(F.col(f"res__{p}") / F.col(f"n__{p}")).alias("rmse"),
                (F.lit(1.0) - F.try_divide(F.col(f"res__{p}"), F.col(f"tot__{p}"))).alias("r2"),
            )
            for p in predictions
        ]
    )
    return row.select(F.explode(cells).alias("_m")).select("_m.*")


def metrics_table(sets: dict[str, DataFrame], label: str, prediction: str) -> DataFrame:
    """M6 for several row sets: (set, n, rmse, r2)."""
    parts = [regression_metrics(df, label, prediction).select(F.lit(name).alias("set"), "*") for name, df in sets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def metrics_long(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Wide metric table -> (ids..., metric, value)."""
    return wide.unpivot(ids=list(ids), values=list(metrics), variableColumnName="metric", valueColumnName="value")


# ---------------------------------------------------------------- forest


@dataclass
class ForestSpec:
    num_trees: int = 20
    subsampling_rate: float = 1.0
    min_instances: int = 1
    subset_strategy: str = "auto"
    seed: int = 0
    max_depth: int = 5
    max_bins: int = 32
    bootstrap: bool = True


def forest_pipeline(features: Sequence[str], label: str, spec: ForestSpec = ForestSpec(), nulls: str = "impute"):
    """(impute) -> assemble -> scale (unit stddev, no centring) -> forest.

    ``nulls``: ``"impute"`` (default) fills a NULL feature with its training
    mean, so scoring returns every row; ``"error"`` fails on one, as the
    reference does (T12); ``"skip"`` drops such rows at assembly.
    """
    stages = []
    cols = list(features)
    if nulls == "impute":
        imputed = [f"{c}__imputed" for c in cols]
        stages.append(Imputer(inputCols=cols, outputCols=imputed, strategy="mean"))
        cols = imputed
    stages.append(VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="skip" if nulls == "skip" else "error"))
    stages.append(StandardScaler(inputCol="features", outputCol="scaled_features"))
    forest = RandomForestRegressor(
        featuresCol="scaled_features",
        labelCol=label,
        numTrees=spec.num_trees,
        subsamplingRate=spec.subsampling_rate,
        minInstancesPerNode=spec.min_instances,
        featureSubsetStrategy=spec.subset_strategy,
        seed=spec.seed,
        maxDepth=spec.max_depth,
        maxBins=spec.max_bins,
        bootstrap=spec.bootstrap,
    )
    stages.append(forest)
    return Pipeline(stages=stages), forest


def grid_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    num_trees: Sequence[int] = GRID_NUM_TREES,
    subsampling: Sequence[float] = GRID_SUBSAMPLING,
    min_instances: Sequence[int] = GRID_MIN_INSTANCES,
    strategies: Sequence[str] = GRID_STRATEGIES,
    folds: int = NUM_FOLDS,
    metric: str = METRIC,
    seed: int = SEED,
    parallelism: int = 4,
    nulls: str = "impute",
):
    """K-fold cross-validated grid search (the reference's 90-point grid by default)."""
    pipeline, forest = forest_pipeline(features, label, ForestSpec(seed=seed), nulls)
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(num_trees))
        .addGrid(forest.subsamplingRate, list(subsampling))
        .addGrid(forest.minInstancesPerNode, list(min_instances))
        .addGrid(forest.featureSubsetStrategy, list(strategies))
        .build()
    )
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    cv = CrossValidator(
        estimator=pipeline, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds, seed=seed,
        parallelism=parallelism,
    )
    return cv.fit(train), forest, grid


def cv_report(spark, cv_model, forest, grid) -> DataFrame:
    """One row per grid point with its mean CV metric and whether it is
    the chosen point: the first best by the metric's own direction (public
    getters only; the report is bounded by the grid)."""
    rows = []
    scores = list(cv_model.avgMetrics)
    best = scores.index(max(scores) if cv_model.getEvaluator().isLargerBetter() else min(scores))
    for i, (params, score) in enumerate(zip(grid, scores)):
        rows.append(
            (
                int(params[forest.numTrees]),
                float(params[forest.subsamplingRate]),
                int(params[forest.minInstancesPerNode]),
                str(params[forest.featureSubsetStrategy]),
                float(score),
                i == best,
            )
        )
    return spark.createDataFrame(
        rows,
        "num_trees int, subsampling_rate double, min_instances int, subset_strategy string, cv_metric double, "
        "is_best boolean",
    )


def importances(spark, model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of the fitted forest, by input name."""
    forest = model.stages[-1] if hasattr(model, "stages") else model
    values = forest.featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


def score(model, df: DataFrame, key: str, label: str) -> DataFrame:
    """(key, label, prediction, baseline_prediction)."""
    return model.transform(df).select(key, label, "prediction", "baseline_prediction")


def prepare(
    df: DataFrame,
    label: str,
    remove_outliers_flag: bool,
    log_flag: bool,
    undersample_flag: bool,
    majority=1.0,
    minority=2.0,
    key: str = "pid",
) -> DataFrame:
    """The reference's preparation order: outliers -> undersampling -> log."""
    out = df
    if remove_outliers_flag:
        out = remove_outliers(out, label)
    if undersample_flag:
        out = undersample(out, label, majority, minority, key)
    if log_flag:
        out = log_target(out, label)
    return out
