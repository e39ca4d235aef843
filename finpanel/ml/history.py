"""What earlier runs left: rows of experiments and fitted models with their metrics.

Both are append-only Parquet tables in a folder that all executors share, keyed by run; a run
adds files and changes none, so runs side by side do not disturb each other.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODELS = "run string, name string, path string, features array<string>, y string, task string, metrics map<string,double>"


def append(rows: DataFrame, folder: str, run: str | None = None) -> str:
    """Add ``rows`` under ``run`` (a new name by default)."""
    run = run or uuid.uuid4().hex
    rows.withColumns({"run": F.lit(run), "recorded_at": F.current_timestamp()}).write.mode("append").parquet(folder)
    return run


def read(spark: SparkSession, folder: str, before: str | None = None) -> DataFrame:
    """All rows of all runs, or those of runs other than ``before``."""
    rows = spark.read.parquet(folder)
    return rows.where(F.col("run") != before) if before else rows


def save_model(model: PipelineModel, name: str, features: Sequence[str], y: str, task: str, metrics: Mapping[str, float], folder: str,
               run: str | None = None) -> str:
    """Store a fitted model and the metrics it had; returns its path."""
    run = run or uuid.uuid4().hex
    path = f"{folder}/models/{name}-{run}"
    model.save(path)
    spark = SparkSession.getActiveSession()
    kept = {k: float(v) for k, v in metrics.items() if v is not None}
    append(spark.createDataFrame([(run, name, path, list(features), y, task, kept)], MODELS).drop("run"), f"{folder}/table", run)
    return path


def recheck(spark: SparkSession, folder: str, df: DataFrame, tol: float = 0.001) -> DataFrame:
    """Score every stored model again on ``df``: (run, name, metric, stored, now, ok), ok where the
    metric is within ``tol`` of the stored one."""
    from finpanel.ml.search import _metrics
    rows = []
    for m in read(spark, f"{folder}/table").orderBy("recorded_at", "name").collect():  # a row per stored model
        now = _metrics(PipelineModel.load(m["path"]), df, m["y"], m["task"])
        now = {k: float(v) for k, v in now.items() if v is not None}
        rows += [(m["run"], m["name"], k, v, now.get(k), k in now and abs(now[k] - v) <= tol) for k, v in sorted(m["metrics"].items())]
    return spark.createDataFrame(rows, "run string, name string, metric string, stored double, now double, ok boolean")
