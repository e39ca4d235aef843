"""Positions and prefix counts in a global order, without a one-partition window.

One way at every size: rows are range-partitioned by the order (Spark samples the
bounds; a heavy group is cut like any other range), landed with their partition's
number, counted per partition, and a partition's offset is added to what a window
finds inside it. Any orderable type serves; NULLs come last.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finpanel.session import cut_lineage

#: Rows of a range, about: what one task sorts.
RANGE_ROWS = 250_000


def ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` landed in ranges of ``order``, with the range's number as ``_range``."""
    parts = max(2, -(-df.count() // RANGE_ROWS))
    cut = df.repartitionByRange(parts, *[F.col(c).asc_nulls_last() for c in order])
    return cut_lineage(cut.withColumn("_range", F.spark_partition_id()), "ranges")


def _offsets(r: DataFrame, by: list[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per (by, range): ``_off_<name>``, the sum over earlier ranges, and ``<name>_total`` of the group."""
    per = r.groupBy(*by, "_range").agg(*[c.alias(f"_s_{n}") for n, c in sums.items()])
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return per.select(*by, "_range",
                      *[F.coalesce(F.sum(f"_s_{n}").over(ahead), F.lit(0)).alias(f"_off_{n}") for n in sums],
                      *[F.sum(f"_s_{n}").over(Window.partitionBy(*by)).alias(f"{n}_total") for n in sums])


def _with_offsets(r: DataFrame, off: DataFrame, by: list[str]) -> DataFrame:
    on = [*by, "_range"]
    off = off.withColumnsRenamed({c: f"_on_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return r.join(off, cond).drop(*[f"_on_{c}" for c in on])


def value_prefix(df: DataFrame, x: str | Column, counts: Mapping[str, Column], by: Sequence[str] = (),
                 x_name: str = "x") -> DataFrame:
    """Per (by..., x): each count, ``<name>_below`` (sum over smaller x) and ``<name>_total``.

    Equal values are summed map-side first, so a value that a third of the rows hold is
    one row of the order."""
    by = list(by)
    xc = F.col(x) if isinstance(x, str) else x
    cnt = (df.select(*by, xc.alias(x_name), *[c.alias(n) for n, c in counts.items()])
             .groupBy(*by, x_name).agg(*[F.sum(n).alias(n) for n in counts]))
    r = ranged(cnt, [*by, x_name])
    d = _with_offsets(r, _offsets(r, by, {n: F.sum(n) for n in counts}), by)
    w = Window.partitionBy(*by, "_range").orderBy(F.col(x_name).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return d.select(*by, x_name, *counts, *[f"{n}_total" for n in counts],
                    *[(F.col(f"_off_{n}") + F.coalesce(F.sum(n).over(w), F.lit(0))).alias(f"{n}_below") for n in counts])


def row_positions(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), pos: str = "_pos", total: str = "_n") -> DataFrame:
    """``df`` with each row's 0-based position in ``order`` (within ``by``) and the group's
    number of rows. Every row keeps a position of its own: rows equal in ``order`` follow a
    hash of all their columns, and rows equal in all are interchangeable. NULL groups and
    NULL order values are kept (a NULL group is a group; NULLs come last)."""
    by, cols = list(by), list(df.columns)
    d = df.withColumn("_tie", F.xxhash64(*cols))
    r = ranged(d, [*by, *order, "_tie"])
    d = _with_offsets(r, _offsets(r, by, {"_c": F.count(F.lit(1))}), by)
    w = Window.partitionBy(*by, "_range").orderBy(*[F.col(c).asc_nulls_last() for c in [*order, "_tie"]])
    return d.select(*cols, (F.col("_off__c") + F.row_number().over(w) - 1).alias(pos), F.col("_c_total").alias(total))
