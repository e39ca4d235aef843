"""Row filters and the one-pass cleaning audit.

Filters are plain predicates so Catalyst pushes them into the Parquet scan
(``isin``, ``between``, comparisons show up under PushedFilters).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.functions.scalar import col


def filter_in(df: DataFrame, c: str, values: Sequence) -> DataFrame:
    return df.where(F.col(c).isin(list(values)))


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def filter_blank(df: DataFrame, c: str) -> DataFrame:
    """Keep rows whose text column is NULL or blank; no-op when the column is absent."""
    return df.where(blank(c)) if c in df.columns else df


def filter_uom(df: DataFrame, rules: dict[str, Sequence[str]], tag: str = "tag",
               uom: str = "uom") -> DataFrame:
    """Keep (tag in rule tags AND uom = rule unit) for any rule — one OR predicate."""
    cond = None
    for unit, tags in rules.items():
        c = F.col(tag).isin(list(tags)) & (F.col(uom) == F.lit(unit))
        cond = c if cond is None else cond | c
    return df.where(cond)


def filter_current(df: DataFrame, a, b) -> DataFrame:
    """Keep facts of the filing's own period (a = b)."""
    return df.where(col(a) == col(b))


def filter_not_q4(df: DataFrame, c: str = "fp", value: str = "Q4") -> DataFrame:
    """Drop fp = 'Q4'; NULL fp is kept."""
    return df.where(~F.col(c).eqNullSafe(F.lit(value)))


def filter_positive(df: DataFrame, c: str) -> DataFrame:
    """Drop < 0, = 0 and NULL."""
    return df.where(F.col(c) > 0)


def filter_range(df: DataFrame, c: str, lo, hi) -> DataFrame:
    return df.where(F.col(c).between(lo, hi))


def filter_min(df: DataFrame, c: str, minimum, null_as_zero: bool = False) -> DataFrame:
    x = F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c)
    return df.where(x >= minimum)


def filter_min_group(df: DataFrame, entity: str, count_col: str = "adsh", minimum: int = 2) -> DataFrame:
    """Drop entities with fewer than ``minimum`` non-null ``count_col`` rows; rows with a
    NULL entity are kept (pandas groupby never counts them, so they are never listed).

    Counts are a partial/final aggregate (a huge entity is pre-counted map-side), then
    joined back on the entity; the count table has one row per entity."""
    counts = (df.where(F.col(entity).isNotNull()).groupBy(entity)
                .agg(F.count(F.col(count_col)).alias("_n")).where(F.col("_n") < minimum).select(entity))
    return df.join(counts, entity, "left_anti")


def step_audit(df: DataFrame, steps: Sequence[tuple[str, Column]], entity: str | None = None) -> DataFrame:
    """Rows removed per cleaning step in one pass.

    ``steps`` is an ordered list of (name, keep_predicate). Each row is charged to the
    first step whose predicate does not hold; rows passing all are 'kept'.
    Output: step, step_no, rows_out, entities_out (distinct entities among those rows).
    """
    expr = None
    for i, (name, keep) in enumerate(steps):
        fail = ~F.coalesce(keep, F.lit(False))
        expr = F.when(fail, F.lit(i)) if expr is None else expr.when(fail, F.lit(i))
    expr = expr.otherwise(F.lit(len(steps)))
    names = F.create_map(*[x for i, (n, _) in enumerate(steps) for x in (F.lit(i), F.lit(n))],
                         F.lit(len(steps)), F.lit("kept"))
    d = df.withColumn("_step", expr)
    aggs = [F.count(F.lit(1)).alias("rows_out")]
    if entity:
        aggs.append(F.count_distinct(F.col(entity)).alias("entities_out"))
    return (d.groupBy("_step").agg(*aggs)
             .select(F.col("_step").alias("step_no"), names[F.col("_step")].alias("step"),
                     *[a for a in ["rows_out"] + (["entities_out"] if entity else [])]))
