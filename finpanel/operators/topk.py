"""Top-k reports and ranking (a limit here is the feature)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk_coverage(cov: DataFrame, k: int = 10, by: str = "pct_coverage", ascending: bool = False) -> DataFrame:
    """Top-k columns of a coverage table (one row per column: bounded by the schema)."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return cov.orderBy(o, F.col("column")).limit(k)


def topk_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int,
                   rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group via row_number (one shuffle on the group)."""
    g = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*g).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def topk_corr(corr: DataFrame, k: int = 10, target: str = "target", value: str = "r",
              feature: str = "feature") -> DataFrame:
    """Top-k features per target by |r| (ties by name)."""
    return topk_per_group(corr.where(F.col(value).isNotNull()), target,
                          [F.abs(F.col(value)).desc(), F.col(feature)], k)


def topk_signed(corr: DataFrame, k: int = 10, target: str = "target", value: str = "r",
                feature: str = "feature") -> DataFrame:
    """k most negative and k most positive correlations per target."""
    neg = topk_per_group(corr.where(F.col(value) < 0), target, [F.col(value).asc(), F.col(feature)], k)
    pos = topk_per_group(corr.where(F.col(value) > 0), target, [F.col(value).desc(), F.col(feature)], k)
    return neg.withColumn("side", F.lit("neg")).unionByName(pos.withColumn("side", F.lit("pos")))


def model_ranking(metrics: DataFrame, by: str, ascending: bool = False, group: Sequence[str] = (),
                  name: str = "model") -> DataFrame:
    """1-based rank of models by a metric (within optional task groups)."""
    o = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    w = Window.partitionBy(*group).orderBy(o, F.col(name)) if group else Window.orderBy(o, F.col(name))
    return metrics.withColumn("rank", F.row_number().over(w))


def sample_rows(df: DataFrame, key: Sequence[str] | str, n: int, seed: int = 42) -> DataFrame:
    """Repeatable sample of n rows: order by md5('seed|key...') then key, take n.

    A top-n (each task keeps its n best, one small merge); md5 of the text form makes
    the order reproducible outside Spark as well."""
    keys = [key] if isinstance(key, str) else list(key)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")


def topk_importance(importances: DataFrame, k: int = 20) -> DataFrame:
    """Top-k features of a (feature, importance) table."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)
