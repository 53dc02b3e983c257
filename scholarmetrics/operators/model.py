"""Linear model of citation counts (M1-M7) on ``pyspark.ml``.

The original refitted an SGD regression from scratch with +100 iterations until
the test error repeated.  Its objective is plain least squares with an
intercept (an L1 regulariser was named but its weight left at 0), so the fit
here is ``LinearRegression(regParam=0, solver="normal")``: one distributed pass
that aggregates the Gram matrix ``XᵀX`` and ``Xᵀy`` (tree aggregate, size
features², independent of the row count), then a tiny solve on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarmetrics.functions.expressions import hash_bucket, l2_normalized

# Fixed values of the original training set-up.
TRAIN_FRACTION = 0.7
SPLIT_SEED = 11
BUDGET_STEP = 100


def prepare(df: DataFrame, label: str, features: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """Label and feature columns as doubles; NULL features become ``fill``
    (missing features were written as the text ``None`` and could not be read
    back, so an explicit fill is the usable choice).  ``fill=None`` drops rows
    with a NULL feature instead."""
    cols = [F.col(label).cast("double").alias(label)] + [F.col(c).cast("double").alias(c) for c in features]
    keep = [c for c in df.columns if c not in (label, *features)]
    out = df.select(*keep, *cols)
    return out.na.drop(subset=list(features)) if fill is None else out.na.fill(fill, subset=list(features))


def assemble(df: DataFrame, label: str, features: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """M1: ``label`` plus a dense ``features`` vector."""
    p = prepare(df, label, features, fill)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(p)


def normalize(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """M2: row-wise L2 normalisation of the feature columns (zero rows stay)."""
    others = [c for c in df.columns if c not in features]
    return df.select(*others, *l2_normalized(list(features)))


def normalize_vectors(assembled: DataFrame, p: float = 2.0, column: str = "features") -> DataFrame:
    """M2 on an assembled vector column with ``pyspark.ml.feature.Normalizer``
    (JVM-side, per row); the same values as ``normalize`` for ``p=2``."""
    out = Normalizer(inputCol=column, outputCol=f"{column}_normalized", p=p).transform(assembled)
    return out.drop(column).withColumnRenamed(f"{column}_normalized", column)


def split_flag(df: DataFrame, key: str = "paper_id", fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED) -> DataFrame:
    """M3: adds ``is_train`` from a hash bucket of ``key`` (stable under any
    partitioning or recomputation, unlike ``randomSplit``).  Tenths use ten
    buckets; any other fraction is resolved to one in a million."""
    buckets = 10 if abs(fraction * 10 - round(fraction * 10)) < 1e-9 else 1_000_000
    return df.withColumn("is_train", hash_bucket(key, seed, buckets) < F.lit(int(round(fraction * buckets))))


def split_train_test(df: DataFrame, key: str = "paper_id", fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, key, fraction, seed)
    return (
        flagged.filter(F.col("is_train")).drop("is_train"),
        flagged.filter(~F.col("is_train")).drop("is_train"),
    )


def fit_linear(
    train: DataFrame,
    label: str,
    features: Sequence[str],
    solver: str = "normal",
    max_iter: int = 100,
    fill: float | None = 0.0,
) -> LinearRegressionModel:
    """M4: least squares with an intercept.

    ``LinearRegression`` reads its input more than once (instance extraction,
    then the training summary), so the assembled ``(label, features)`` rows are
    persisted for the fit.  The rows are one per paper (not per edge or
    link); MEMORY_AND_DISK spills instead of failing, and a lost block is
    recomputed from lineage."""
    lr = LinearRegression(
        featuresCol="features",
        labelCol=label,
        predictionCol="prediction",
        regParam=0.0,
        elasticNetParam=0.0,
        fitIntercept=True,
        solver=solver,
        maxIter=max_iter,
    )
    data = assemble(train, label, features, fill).select(label, "features")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return lr.fit(data)
    finally:
        data.unpersist()


def coefficients(
    model: LinearRegressionModel, features: Sequence[str], spark: SparkSession | None = None
) -> DataFrame:
    """One row ``(intercept, <feature>...)`` of a fitted model (the fit itself
    was the distributed part; this row is its small result)."""
    spark = spark or SparkSession.getActiveSession()
    schema = T.StructType(
        [T.StructField("intercept", T.DoubleType())]
        + [T.StructField(f, T.DoubleType()) for f in features]
    )
    row = [float(model.intercept)] + [float(x) for x in model.coefficients.toArray()]
    return spark.createDataFrame([tuple(row)], schema)


def predictions(model: LinearRegressionModel, test: DataFrame, label: str, features: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    return model.transform(assemble(test, label, features, fill))


def score_mse(model: LinearRegressionModel, test: DataFrame, label: str, features: Sequence[str], fill: float | None = 0.0) -> DataFrame:
    """M5: one row ``(mse, n)`` on the test rows (one distributed aggregate)."""
    p = predictions(model, test, label, features, fill)
    err = F.col("prediction") - F.col(label)
    return p.agg(F.avg(err * err).alias("mse"), F.count(F.lit(1)).alias("n"))


def mse_by_budget(
    train: DataFrame,
    test: DataFrame,
    label: str,
    features: Sequence[str],
    step: int = BUDGET_STEP,
    max_refits: int = 200,
    fill: float | None = 0.0,
    together: int = 4,
) -> DataFrame:
    """M6: refit with ``step``, ``2*step``, ... L-BFGS iterations until the test
    MSE repeats (to ten digits) or is not a number, ``max_refits`` budgets at most.
    Returns the whole curve ``(iterations, mse, converged)``; ``converged`` is true in
    the last row if the error repeated, so a capped run can be told from a finished one.

    The optimiser's own tolerance is 0, so the budget alone ends a fit and every
    row of the curve is a different fit.  ``together`` budgets are fitted in turn and
    then scored by one pass over the test rows (``score_models``), which reads them once
    for the group in place of once a budget; a budget beyond the one that repeats is
    dropped, so the curve does not depend on ``together``.  The driver keeps only
    coefficients and MSEs.  Train and test are assembled once and cached.
    """
    a_train = assemble(train, label, features, fill).select(label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    p_test = prepare(test, label, features, fill).select(label, *features).persist(StorageLevel.MEMORY_AND_DISK)
    results: list[tuple[int, float, bool]] = []
    try:
        while len(results) < max_refits and not (results and (results[-1][2] or results[-1][1] != results[-1][1])):
            budgets = [(len(results) + 1 + i) * step for i in range(min(together, max_refits - len(results)))]
            models = [
                LinearRegression(
                    featuresCol="features", labelCol=label, regParam=0.0, fitIntercept=True,
                    solver="l-bfgs", maxIter=b, tol=0.0,
                ).fit(a_train)
                for b in budgets
            ]
            for budget, mse in zip(budgets, score_models(models, p_test, label, features)):
                again = bool(results) and abs(mse - results[-1][1]) <= 1e-10 * abs(mse)
                results.append((budget, mse, again))
                if again or mse != mse:
                    break
    finally:
        a_train.unpersist()
        p_test.unpersist()
    spark = train.sparkSession
    return spark.createDataFrame(results, "iterations int, mse double, converged boolean")


def linear_prediction(model: LinearRegressionModel, features: Sequence[str]) -> Column:
    """The model as a column expression: its coefficients are literals, so any number of
    models fit in one projection."""
    terms = [F.col(c) * F.lit(float(k)) for c, k in zip(features, model.coefficients.toArray())]
    return sum(terms, F.lit(float(model.intercept)))


def score_models(
    models: Sequence[LinearRegressionModel], test: DataFrame, label: str, features: Sequence[str]
) -> list[float]:
    """MSE of every model, from one aggregate over the (prepared) test rows; NaN where
    there are none."""
    errors = [linear_prediction(m, features) - F.col(label) for m in models]
    row = test.agg(*[F.avg(e * e).alias(f"m{i}") for i, e in enumerate(errors)]).first()
    return [float("nan") if x is None else float(x) for x in row]


def fit_pipeline(
    train: DataFrame, label: str, features: Sequence[str], normalized: bool = True, fill: float | None = 0.0
) -> PipelineModel:
    """M1, M2 and M4 as one ``pyspark.ml`` pipeline: assemble the feature columns, scale
    each row to length 1 (``Normalizer``, p=2), fit.  The fitted pipeline is one object to
    save, load and transform with; its input is a table with the feature columns."""
    data = prepare(train, label, features, fill).select(label, *features)
    stages = [VectorAssembler(inputCols=list(features), outputCol="assembled" if normalized else "features")]
    if normalized:
        stages.append(Normalizer(inputCol="assembled", outputCol="features", p=2.0))
    stages.append(
        LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, fitIntercept=True, solver="normal")
    )
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def save_model(model: LinearRegressionModel | PipelineModel, path: str) -> None:
    """M7: persist a fitted model or pipeline (Spark ML format, overwriting)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
