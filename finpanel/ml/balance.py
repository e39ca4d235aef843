"""SMOTE-NC style oversampling on Spark: every class below the largest is filled up to it.

Neighbours are found inside a class by ``lsh.knn_lsh`` under the mixed metric: Euclidean over
the continuous features, and for every category that differs the median of the continuous
features' standard deviations in that class. Every row with a neighbour is a parent; the rows
a class lacks are spread evenly over its parents (one more for the first ones in hash order).
A synthetic row lies on the line between its parent and one of the parent's neighbours, both
named in the output, and takes each category as the most frequent value among the parent's
neighbours (ties -> the smallest value). Every draw is a hash of (seed, id, draw): retries
reproduce the rows.

A NULL label is no class: such rows are left out. A class in which no row has a neighbour (a
single row, or NULLs in the continuous features) repeats its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import median

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finpanel.ml.ranks import row_positions
from finpanel.ml.split import unit_hash
from finpanel.operators.lsh import knn_lsh
from finpanel.session import cut_lineage


def category_penalty(rows: DataFrame, cont: Sequence[str]) -> float:
    """Median of the continuous features' standard deviations."""
    st = rows.agg(*[F.stddev_pop(c).alias(c) for c in cont]).first()
    return float(median([st[c] or 0.0 for c in cont])) if cont else 1.0


def _filled(rows: DataFrame, id_col: str, cont: Sequence[str], cat: Sequence[str], lacking: int, k: int, seed: int) -> DataFrame:
    """(source_id, near_id, draw, features...): ``lacking`` synthetic rows of one class."""
    edges = cut_lineage(knn_lsh(rows, id_col, cont, cat, k, category_penalty(rows, cont), seed=seed), "smote")
    parents = edges.groupBy(F.col("src").alias(id_col)).agg(F.array_sort(F.collect_list(F.struct("rank", "dst"))).alias("_near"))
    held = rows.join(parents, id_col)
    if held.isEmpty():
        held = rows.withColumn("_near", F.array(F.struct(F.lit(1).alias("rank"), F.col(id_col).alias("dst"))))
    held = row_positions(held.withColumn("_u", unit_hash([id_col], seed)), ["_u", id_col])
    share = F.expr(f"cast({lacking} div _n + if(_pos < {lacking} % _n, 1, 0) as int)")
    draws = held.where(share > 0).select(id_col, *[F.col(c).alias(f"_a_{c}") for c in cont], "_near", F.explode(F.sequence(F.lit(1), share)).alias("draw"))
    pick = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id_col), F.col("draw")), F.size("_near")) + 1
    draws = draws.withColumns({"near_id": F.element_at("_near", pick.cast("int"))["dst"], "_w": unit_hash([id_col, "draw"], seed + 2)}).drop("_near")
    other = rows.select(F.col(id_col).alias("near_id"), *[F.col(c).alias(f"_b_{c}") for c in cont])
    out = draws.join(other, "near_id").select(F.col(id_col).alias("source_id"), "near_id", "draw", *[
        (F.col(f"_a_{c}") + F.col("_w") * (F.col(f"_b_{c}") - F.col(f"_a_{c}"))).alias(c) for c in cont])
    if not cat:
        return out
    votes = held.select(F.col(id_col).alias("source_id"), F.explode("_near.dst").alias("near_id")).join(
        rows.select(F.col(id_col).alias("near_id"), *cat), "near_id")
    for c in cat:
        n = votes.groupBy("source_id", c).agg(F.count(F.lit(1)).alias("_v"))
        first = Window.partitionBy("source_id").orderBy(F.col("_v").desc(), F.col(c).asc_nulls_last())
        out = out.join(n.withColumn("_r", F.row_number().over(first)).where("_r = 1").select("source_id", c), "source_id")
    return out


def smote_nc(df: DataFrame, label: str, id_col: str, cont: Sequence[str], cat: Sequence[str] = (),
             k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic rows only: (label, source_id, near_id, draw, features..., synthetic = 1). Classes
    are counted on the driver (a row per class)."""
    cont, cat = list(cont), list(cat)
    base = cut_lineage(df.where(F.col(label).isNotNull()).select(label, id_col, *cont, *cat), "smote-rows")
    counts = {r[label]: r["n"] for r in base.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = []
    for c in sorted(counts, key=str):
        lacking = max(counts.values()) - counts[c]
        if lacking:
            rows = base.where(F.col(label) == F.lit(c)).drop(label)
            parts.append(_filled(rows, id_col, cont, cat, lacking, k, seed).select(
                F.lit(c).cast(df.schema[label].dataType).alias(label), "source_id", "near_id", "draw", *cont, *cat, F.lit(1).alias("synthetic")))
    if not parts:
        return base.where(F.lit(False)).select(label, F.col(id_col).alias("source_id"), F.col(id_col).alias("near_id"), F.lit(0).alias("draw"),
                                               *cont, *cat, F.lit(1).alias("synthetic"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
