"""Cross-validation folds.

``temporal_folds`` reproduces expanding-window time-series splits (n splits, test
size n_rows // (n_splits + 1), train = everything before the test block) over the
order (fy, fiscal period, tie). The exact row position comes from
``ranks.row_positions``, never from a one-partition global window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.functions.scalar import map_codes
from finpanel.ml.ranks import row_positions
from finpanel.ml.split import unit_hash

# fiscal period order used for chronological CV (Q4 before FY; others last)
CV_FP_ORDER = {"Q1": 1, "Q2": 2, "Q3": 3, "Q4": 4, "FY": 5}


def temporal_folds(df: DataFrame, fy: str = "fy", fp: str = "fp", tie: str = "adsh", n_splits: int = 3,
                   fp_order: Mapping[str, int] = CV_FP_ORDER) -> DataFrame:
    """Adds ``pos`` (chronological position) and ``test_fold`` (1..n_splits or NULL).
    Fold k trains on pos < start_k and tests on test_fold = k. A NULL year orders last, an
    unknown period last in its year; ``tie`` may be of any type."""
    cols = list(df.columns)
    d = df.withColumns({"_year": F.col(fy).cast("long"), "_fp": F.coalesce(map_codes(fp, fp_order), F.lit(99))})
    d = row_positions(d, ["_year", "_fp", tie])
    size = F.floor(F.col("_n") / (n_splits + 1))
    first = F.col("_n") - n_splits * size
    k = F.floor((F.col("_pos") - first) / size) + 1
    return d.select(*cols, F.col("_pos").alias("pos"),
                    F.when((F.col("_pos") >= first) & (size > 0), k.cast("int")).alias("test_fold"))


def fold_frames(folded: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) of fold k from ``temporal_folds`` output."""
    start = folded.where(F.col("test_fold") == k).agg(F.min("pos")).first()[0]
    return folded.where(F.col("pos") < start), folded.where(F.col("test_fold") == k)


def kfold_column(df: DataFrame, keys: Sequence[str], k: int = 5, strata: str | None = None,
                 seed: int = 42) -> DataFrame:
    """Shuffled (optionally stratified) k-fold assignment as an int column ``fold``:
    seeded hash order within the stratum (NULL is a stratum), position mod k."""
    cols = list(df.columns)
    d = row_positions(df.withColumn("_u", unit_hash(keys, seed)), ["_u"], [strata] if strata else [])
    return d.select(*cols, F.pmod(F.col("_pos"), F.lit(k)).cast("int").alias("fold"))
