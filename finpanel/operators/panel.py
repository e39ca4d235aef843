"""Panel (entity x period) window operators.

All lag/lead/ffill operators share one ``Window`` spec per (entity, order), so Spark
sorts each entity partition once and evaluates every window column in one
``Window`` node. Lag/lead step over *rows* (an irregular panel), not calendar
quarters: gaps are not filled.

Rows whose entity key is NULL get NULL lags/leads (pandas groupby drops NaN keys).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finpanel.functions.scalar import bool_flag_null, clip, col, safe_div


def _order_cols(order: Sequence) -> list[Column]:
    return [col(o) for o in order]


def panel_window(entity: str | Sequence[str], order: Sequence) -> Window:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(*_order_cols(order))


def spread_window(df: DataFrame, entity: str | Sequence[str], order: Sequence) -> Window:
    """The panel window of ``df``, with rows that lack an entity dealt by a hash of all their
    columns: their lags are NULL whatever their neighbours, so no task has to sort them together."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    lacks = F.lit(False)
    for k in keys:
        lacks = lacks | F.col(k).isNull()
    return Window.partitionBy(*keys, F.when(lacks, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))).orderBy(*_order_cols(order))


def _guard(entity, c: Column) -> Column:
    keys = [entity] if isinstance(entity, str) else list(entity)
    cond = None
    for k in keys:
        p = F.col(k).isNotNull()
        cond = p if cond is None else cond & p
    return F.when(cond, c)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool, bool]],
             cols: Sequence[str] | None = None) -> DataFrame:
    """First row per ``keys`` under ``order`` = [(column, ascending, nulls_first), ...].

    Written as ONE min/max aggregate over a struct (sort keys, then the whole row), so
    Spark combines map-side: a key holding a third of all rows is reduced inside every
    map task before the shuffle, and no group is ever sorted in a single task (a
    ``row_number`` window would). Numeric sort keys can run in either direction; all
    non-numeric keys must share one direction (it picks min or max). ``cols`` limits
    the carried row (struct fields are not pruned later, so pass what you need)."""
    types = dict(df.dtypes)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    other_dirs = {asc for c, asc, _ in order if types[c] not in numeric and not types[c].startswith("decimal")}
    if len(other_dirs) > 1:
        raise ValueError("non-numeric sort keys must share one direction")
    use_min = other_dirs.pop() if other_dirs else True
    parts = []
    for i, (c, asc, nulls_first) in enumerate(order):
        x = F.col(c)
        if asc != use_min:  # only numeric keys reach here
            x = -x
        null_small = nulls_first if use_min else not nulls_first
        flag = F.when(F.col(c).isNull(), 0 if null_small else 1).otherwise(1 if null_small else 0)
        parts += [flag.alias(f"f{i}"), x.alias(f"k{i}")]
    keep = list(dict.fromkeys(list(keys) + list(cols))) if cols else df.columns
    payload = [c for c in keep if c not in set(keys)]
    row = F.struct(*[F.col(f"`{c}`") for c in payload]).alias("row")
    pick = F.min if use_min else F.max
    # keys come straight from the grouping, so the output keeps its hash partitioning
    best = df.groupBy(*keys).agg(pick(F.struct(*parts, row)).alias("_best"))
    return best.select(*[F.col(f"`{c}`") if c in set(keys) else F.col(f"_best.row.`{c}`").alias(c)
                         for c in keep])


def dedup_latest(df: DataFrame, keys: Sequence[str], by: str = "filed",
                 tie: Sequence[str] = ("adsh",), cols: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: latest ``by`` (a NULL ``by`` counts as latest,
    as pandas sorts NaN last and keeps the last row), ties -> largest ``tie``."""
    return first_by(df, keys, [(by, False, True)] + [(t, False, True) for t in tie], cols)


def dedup_longest(df: DataFrame, keys: Sequence[str] = ("adsh", "tag"), by: str = "qtrs",
                  tie: Sequence[str] = ("version", "value"), cols: Sequence[str] | None = None) -> DataFrame:
    """Keep the row with the largest duration per (filing, tag); ties by ``tie`` ascending."""
    return first_by(df, keys, [(by, False, False)] + [(t, True, False) for t in tie], cols)


def dedup_last_by_id(df: DataFrame, id_col: str = "adsh", by: str = "quarter",
                     tie: Sequence[str] = (), cols: Sequence[str] | None = None) -> DataFrame:
    """Keep the last header per id (by loading order, e.g. quarter); ties -> largest ``tie``."""
    return first_by(df, [id_col], [(by, False, False)] + [(t, False, False) for t in tie], cols)


def lag_expr(entity, order, c: str, n: int = 1, window=None) -> Column:
    return _guard(entity, F.lag(F.col(c), n).over(panel_window(entity, order) if window is None else window))


def lead_expr(entity, order, c: str, n: int = 1, window=None) -> Column:
    return _guard(entity, F.lead(F.col(c), n).over(panel_window(entity, order) if window is None else window))


def lag1(df: DataFrame, entity, order, cols: Sequence[str], suffix: str = "_prev") -> DataFrame:
    w = spread_window(df, entity, order)
    return df.withColumns({f"{c}{suffix}": lag_expr(entity, order, c, window=w) for c in cols})


def lead1(df: DataFrame, entity, order, cols: Sequence[str], suffix: str = "_next") -> DataFrame:
    w = spread_window(df, entity, order)
    return df.withColumns({f"{c}{suffix}": lead_expr(entity, order, c, window=w) for c in cols})


def diff1(df: DataFrame, entity, order, cols: Sequence[str], suffix: str = "_diff") -> DataFrame:
    w = spread_window(df, entity, order)
    return df.withColumns({f"{c}{suffix}": F.col(c) - lag_expr(entity, order, c, window=w) for c in cols})


def pct_delta_expr(entity, order, c: str, bound: float | None = 5.0, window=None) -> Column:
    prev = lag_expr(entity, order, c, window=window)
    d = safe_div(F.col(c) - prev, F.abs(prev))
    return clip(d, -bound, bound) if bound is not None else d


def pct_delta(df: DataFrame, entity, order, cols: Sequence[str], bound: float | None = 5.0,
              suffix: str = "_pct") -> DataFrame:
    """(x - prev) / |prev| clipped to +-bound; NULL when prev is 0 or missing."""
    w = spread_window(df, entity, order)
    return df.withColumns({f"{c}{suffix}": pct_delta_expr(entity, order, c, bound, w) for c in cols})


def accel(df: DataFrame, entity, order, c: str, name: str | None = None) -> DataFrame:
    """Second difference: (x - prev) - (prev - prev2)."""
    w = spread_window(df, entity, order)
    x, p1, p2 = F.col(c), F.lag(F.col(c), 1).over(w), F.lag(F.col(c), 2).over(w)
    return df.withColumn(name or f"{c}_accel", _guard(entity, (x - p1) - (p1 - p2)))


def worsened_flag(c: str) -> Column:
    """1 if the change is > 0, 0 otherwise, NULL kept."""
    return bool_flag_null(F.col(c) > 0, c)


def ffill_limit(df: DataFrame, entity, order, cols: Sequence[str], limit: int = 2) -> DataFrame:
    """Carry the last non-null value forward over at most ``limit`` rows."""
    w = spread_window(df, entity, order).rowsBetween(-limit, 0)
    return df.withColumns({c: F.coalesce(F.col(c), _guard(entity, F.last(F.col(c), True).over(w)))
                           for c in cols})


def delta_check(df: DataFrame, entity, order, c: str, stored: str, tol: float = 1e-6) -> DataFrame:
    """Recompute x - prev and compare with a stored delta: one row of counts."""
    rec = F.col(c) - lag_expr(entity, order, c, window=spread_window(df, entity, order))
    both = rec.isNotNull() & F.col(stored).isNotNull()
    d = (df.withColumn("_rec", rec)
           .withColumn("_both", both)
           .withColumn("_bad", F.col("_both") & (F.abs(F.col("_rec") - F.col(stored)) > tol)))
    return d.agg(F.count_if(F.col("_both")).alias("n_compared"),
                 F.count_if(F.col("_bad")).alias("n_mismatch"),
                 F.max(F.when(F.col("_both"), F.abs(F.col("_rec") - F.col(stored)))).alias("max_abs_diff"))


def panel_sort(df: DataFrame, entity, order) -> DataFrame:
    """Global order (entity, order...) — only for writing; windows sort per partition."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    return df.orderBy(*[F.col(k) for k in keys], *_order_cols(order))
