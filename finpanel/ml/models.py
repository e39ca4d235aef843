"""Model fitting (the native gradient-boosting and neural libraries of the original notebooks
are replaced by their Spark ML counterparts). Regression forests and boosting are grown by
``trees``, in passes over binned rows, networks by ``network``, in passes over matrices; both are
returned as the Spark ML models they are.

Every fit takes a DataFrame, a label and feature column names; features are
assembled once (NULLs must be imputed first — ``prepare.impute_*``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressionModel, RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.ml import network as nw
from finpanel.ml import trees as tr


def _pipe(features: Sequence[str], est) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features",
                                            handleInvalid="keep"), est])


#: Rows that a network's layers take at a time.
STACK = 1024
#: Training rows of one task, at most about.
TASK_ROWS = 250_000


def dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """The training rows dealt evenly: a task per core, or as many whole rounds of them as the rows ask for.

    Trees and networks pass over the rows many times; a table of few or uneven files would leave
    cores idle in every pass, one of many small tasks would merge as many sets of sums."""
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(cores * max(1, -(-df.count() // (task_rows * cores))))


def fit_linear(df: DataFrame, y: str, features: Sequence[str], l2: float = 0.0, l1_ratio: float = 0.0) -> PipelineModel:
    """Ridge (l1_ratio 0), lasso (1) or elastic net."""
    return _pipe(features, LinearRegression(labelCol=y, regParam=l2, elasticNetParam=l1_ratio)).fit(df)


def fit_logistic(df: DataFrame, y: str, features: Sequence[str], C: float = 1.0,
                 family: str = "auto", max_iter: int = 100) -> PipelineModel:
    return _pipe(features, LogisticRegression(labelCol=y, regParam=1.0 / C / max(df.count(), 1),
                                              family=family, maxIter=max_iter)).fit(df)


def fit_forest(df: DataFrame, y: str, features: Sequence[str], task: str = "regression", trees: int = 200,
               depth: int = 10, seed: int = 42) -> PipelineModel:
    """A third of the features per node for a regression (``trees.forest``); classes are told apart by Spark ML's
    trees, where every row keeps the node it stands at in each tree (4 bytes a tree)."""
    cls = RandomForestRegressor if task == "regression" else RandomForestClassifier
    est = cls(labelCol=y, numTrees=trees, maxDepth=depth, seed=seed, cacheNodeIds=True, checkpointInterval=-1)
    if task != "regression" or depth < 1:
        return _pipe(features, est).fit(dealt(df))
    chunks, cuts = tr.binned(df, y, features, _parts)
    grown = tr.forest(chunks, len(features), trees, depth, seed)
    chunks.unpersist()
    return _fitted(features, tr.as_model(df.sparkSession, est, "org.apache.spark.ml.regression.RandomForestRegressionModel", grown, cuts, [1.0] * trees,
                                         {"labelCol": y, "maxDepth": depth, "seed": seed}, RandomForestRegressionModel.load))


def _parts(df: DataFrame) -> DataFrame:
    return dealt(df, tr.PART_ROWS)


def _fitted(features: Sequence[str], model) -> PipelineModel:
    return PipelineModel([VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), model])


def _boosted(df: DataFrame, y: str, features: Sequence[str], est, kind: str, load, bins=None) -> PipelineModel:
    """The model of a boosting estimator, its trees grown by ``trees.boost`` (over ``bins``, if the rows are binned already)."""
    trees, depth, seed = est.getMaxIter(), est.getMaxDepth(), est.getSeed()
    if depth < 1:
        return _pipe(features, est).fit(dealt(df))
    binary = isinstance(est, GBTClassifier)
    chunks, cuts = bins or tr.binned(df, y, features, _parts, (0.0, 1.0) if binary else None)
    grown = tr.boost(chunks, len(features), trees, depth, est.getStepSize(), est.getSubsamplingRate(), seed, binary)
    if not bins:
        chunks.unpersist()
    return _fitted(features, tr.as_model(df.sparkSession, est, kind, grown, cuts, [1.0] + [est.getStepSize()] * (trees - 1),
                                         {"labelCol": y, "maxDepth": depth, "seed": seed}, load))


class PerClass:
    """One binary model per class, their raw scores kept (``score_<class>``): classes are ranked
    by the score itself, and the prediction is the class that scores highest (ties -> the smaller)."""

    def __init__(self, models: Mapping[int, PipelineModel]):
        self.models = dict(sorted(models.items()))

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        out = df
        for c, m in self.models.items():
            out = m.transform(out).withColumn(f"score_{c}", vector_to_array("rawPrediction")[1]).drop(
                "features", "rawPrediction", "probability", "prediction")
        best = F.array_max(F.array(*[F.struct(F.col(f"score_{c}").alias("s"), F.lit(-c).alias("c")) for c in self.models]))
        return out.withColumn("prediction", (-best["c"]).cast("double"))


def fit_gbt(df: DataFrame, y: str, features: Sequence[str], task: str = "regression", trees: int = 300,
            depth: int = 6, lr: float = 0.05, subsample: float = 0.8, seed: int = 42, classes: Sequence[int] = (0, 1, 2), bins=None):
    """Gradient-boosted trees; three and more classes by one binary model each (``PerClass``). ``bins``: see ``shared_bins``."""
    args = dict(maxIter=trees, maxDepth=depth, stepSize=lr, subsamplingRate=subsample, seed=seed)
    if task == "regression":
        return _boosted(df, y, features, GBTRegressor(labelCol=y, **args), "org.apache.spark.ml.regression.GBTRegressionModel", GBTRegressionModel.load, bins)
    kind, load = "org.apache.spark.ml.classification.GBTClassificationModel", GBTClassificationModel.load
    if task == "binary":
        return _boosted(df, y, features, GBTClassifier(labelCol=y, **args), kind, load, bins)
    own = df.where(F.col(y).isNotNull())
    return PerClass({c: _boosted(own.withColumn("_is", (F.col(y).cast("int") == c).cast("double")), "_is", features,
                                 GBTClassifier(labelCol="_is", **args), kind, load) for c in classes})


def fit_mlp(df: DataFrame, y: str, features: Sequence[str], hidden: Sequence[int] = (256, 128, 64),
            n_classes: int = 2, max_iter: int = 100, seed: int = 42) -> PipelineModel:
    """Rows are stacked ``STACK`` at a time: the layers then multiply larger matrices (``network``)."""
    layers, spark = [len(features), *hidden, n_classes], df.sparkSession
    est = MultilayerPerceptronClassifier(labelCol=y, layers=layers, maxIter=max_iter, blockSize=STACK, seed=seed)
    start = nw.start_of(spark, est, n_classes, len(features))
    chunks = nw.stacked(df, y, features, dealt, n_classes)
    w = nw.minimised(nw.loss_of(chunks, layers, STACK), start.weights.toArray().copy(), max_iter)
    chunks.unpersist()
    return _fitted(features, nw.with_weights(spark, est, start, w, MultilayerPerceptronClassificationModel.load))


def predict(model: PipelineModel, df: DataFrame, prob_col: str = "prob") -> DataFrame:
    """Predictions with a plain probability-of-positive column when available."""
    out = model.transform(df)
    if "probability" in out.columns:
        from pyspark.ml.functions import vector_to_array
        out = out.withColumn(prob_col, vector_to_array("probability")[1])
    return out


def class_scores(model, df: DataFrame, classes: Sequence[int] = (0, 1, 2)) -> tuple[DataFrame, list[str]]:
    """Predictions with one score column per class, and their names (none if the model gives no scores)."""
    out, names = model.transform(df), [f"score_{c}" for c in classes]
    if not isinstance(model, PerClass):
        if "probability" not in out.columns:
            return out, []
        from pyspark.ml.functions import vector_to_array
        p = vector_to_array("probability")
        out = out.withColumns({n: F.get(p, F.lit(int(c))) for n, c in zip(names, classes)})
    return out, names


def gram(df: DataFrame, cols: Sequence[str]) -> tuple[int, "np.ndarray", "np.ndarray"]:
    """(rows, means, centred cross sums) over rows complete in ``cols``: each partition sums its
    rows' products into one matrix, and a row per cell is added up by Spark."""
    import numpy as np
    import pyarrow as pa
    whole = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    first = whole.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(c).alias(c) for c in cols]).first()
    k, means = len(cols), np.asarray([first[c] or 0.0 for c in cols])

    def sums(batches):
        total = np.zeros((k, k))
        for b in batches:
            x = np.column_stack([np.asarray(b.column(c)) for c in cols]) - means
            total += x.T @ x
        yield pa.record_batch({"cell": pa.array(np.arange(k * k)), "s": pa.array(total.ravel())})

    cells = whole.mapInArrow(sums, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(k * k)
    for r in cells:
        out[r["cell"]] = r["s"]
    return first["_n"], means, out.reshape(k, k)


def ridge(df: DataFrame, y: str, features: Sequence[str], alpha: float = 1.0) -> DataFrame:
    """(feature, coefficient) of the penalised least squares |y - Xw - b|^2 + alpha |w|^2, the
    intercept b last and free of the penalty: normal equations on centred cross sums, solved on
    the driver (one matrix of features). Rows with a NULL among the columns are left out; no
    rows or a singular system with alpha 0 gives the least-norm solution."""
    import numpy as np
    _, means, s = gram(df, [*features, y])
    k = len(features)
    a = s[:k, :k] + alpha * np.eye(k)
    w = np.linalg.solve(a, s[:k, k]) if alpha > 0 and k else np.linalg.lstsq(a, s[:k, k], rcond=None)[0]
    b = means[k] - means[:k] @ w
    return df.sparkSession.createDataFrame([*zip(features, map(float, w)), ("(intercept)", float(b))], "feature string, coefficient double")


def ridge_prediction(coefficients: DataFrame) -> Column:
    """The linear predictor as a column expression."""
    out = F.lit(0.0)
    for r in coefficients.collect():
        out = out + (F.lit(r["coefficient"]) if r["feature"] == "(intercept)" else F.col(r["feature"]) * r["coefficient"])
    return out


def importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance) from a tree model (or |coefficients| for linear models)."""
    m = model.stages[-1]
    spark = SparkSession.getActiveSession()
    if hasattr(m, "featureImportances"):
        vals = m.featureImportances.toArray().tolist()
    elif hasattr(m, "coefficients"):
        vals = [abs(v) for v in m.coefficients.toArray().tolist()]
    else:
        vals = [None] * len(features)
    return spark.createDataFrame(list(zip(features, [float(v) if v is not None else None for v in vals])),
                                 "feature string, importance double")


MODEL_GRID: Mapping[str, dict] = {
    "ridge": {"fit": "linear", "l2": 1.0, "l1_ratio": 0.0},
    "lasso": {"fit": "linear", "l2": 0.001, "l1_ratio": 1.0},
    "elastic_net": {"fit": "linear", "l2": 0.01, "l1_ratio": 0.5},
    "random_forest": {"fit": "forest", "trees": 200, "depth": 10},
    "gbt": {"fit": "gbt", "trees": 300, "depth": 6, "lr": 0.05, "subsample": 0.8},
}


@contextmanager
def shared_bins(df: DataFrame, y: str, features: Sequence[str], spec: Mapping, task: str):
    """The rows binned once for many fits of ``spec`` with the same rows, as arguments of ``fit_by_name`` (none where nothing is shared)."""
    if spec["fit"] != "gbt" or task == "multiclass":
        yield {}
        return
    bins = tr.binned(df, y, features, _parts, (0.0, 1.0) if task == "binary" else None)
    try:
        yield {"bins": bins}
    finally:
        bins[0].unpersist()


def fit_by_name(df: DataFrame, y: str, features: Sequence[str], spec: Mapping, task: str = "regression"):
    kind = spec["fit"]
    args = {k: v for k, v in spec.items() if k != "fit"}
    if kind == "linear":
        return fit_linear(df, y, features, **args)
    if kind == "logistic":
        return fit_logistic(df, y, features, **args)
    if kind == "forest":
        return fit_forest(df, y, features, task=task, **args)
    if kind == "gbt":
        return fit_gbt(df, y, features, task=task, **args)
    if kind == "mlp":
        return fit_mlp(df, y, features, **args)
    raise ValueError(kind)
