"""Cleaning rules, coverage filter, winsorising, imputation, pruning and checks.

Data-dependent steps (coverage filter, winsor bounds, medians, prune lists) are two
steps: one small aggregate (a row per column or per group) is computed on the
cluster, then applied as column expressions. Only those few statistics reach the
driver; rows never do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.functions.scalar import clip
from finpanel.session import cut_lineage
from finpanel.operators.aggregates import coverage, grouped_medians, missing_by_group, quantiles


def _num(df: DataFrame, c: str) -> Column:
    return F.col(f"`{c}`").cast("double")


# -- cleaning ------------------------------------------------------------------------

IMPOSSIBLE_NEGATIVE = ["CashAndCashEquivalentsAtCarryingValue", "CommonStockSharesOutstanding",
                       "CommonStockSharesIssued", "Liabilities"]


def clean_impossible(df: DataFrame, cols: Sequence[str] = tuple(IMPOSSIBLE_NEGATIVE)) -> DataFrame:
    """Negative cash, shares, liabilities -> NULL (row kept)."""
    return df.withColumns({c: F.when(~F.coalesce(_num(df, c) < 0, F.lit(False)), F.col(f"`{c}`"))
                           for c in cols if c in df.columns})


def clean_duration(df: DataFrame, tags: Sequence[str] = tuple(S.TAGS_FLOW), lo: int = 0, hi: int = 4,
                   suffix: str = "_qtrs") -> DataFrame:
    """Flow value with duration > hi or = lo -> value AND duration NULL (-1 passes)."""
    out = {}
    for t in tags:
        q = f"{t}{suffix}"
        if t in df.columns and q in df.columns:
            bad = F.coalesce((_num(df, q) > hi) | (_num(df, q) == lo), F.lit(False))
            out[t] = F.when(~bad, F.col(f"`{t}`"))
            out[q] = F.when(~bad, F.col(f"`{q}`"))
    return df.withColumns(out)


def drop_durations(df: DataFrame, suffix: str = "_qtrs") -> DataFrame:
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def coverage_filter(df: DataFrame, min_pct: float = S.COVERAGE_MIN_PCT, prefix: str = "fe_",
                    protected: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop ``prefix`` columns with coverage below min_pct (protected ones kept).
    Returns (frame, dropped columns ordered by coverage)."""
    cols = [c for c in df.columns if c.startswith(prefix)]
    if not cols:
        return df, []
    cov = coverage(df, cols).where(F.col("pct_coverage") < min_pct).orderBy("pct_coverage", "column")
    low = [r["column"] for r in cov.collect() if r["column"] not in set(protected)]
    return df.drop(*low), low


def column_bounds(df: DataFrame, cols: Sequence[str], lower_pct: float, upper_pct: float) -> dict:
    """{column: (lo, hi)} exact percentiles (distributed rank selection), one small result."""
    q = quantiles(df, cols, [lower_pct / 100.0, upper_pct / 100.0]).collect()
    b: dict[str, list] = {}
    for r in q:
        b.setdefault(r["column"], [None, None])[0 if r["p"] == lower_pct / 100.0 else 1] = r["value"]
    return {c: tuple(v) for c, v in b.items()}


def winsorize(df: DataFrame, cols: Sequence[str] = tuple(S.WINSOR_COLS), lower_pct: float = S.WINSOR_PCTS[0],
              upper_pct: float = S.WINSOR_PCTS[1]) -> DataFrame:
    """Clip each column to its own [p_lower, p_upper]; NULL kept; all-NULL columns untouched."""
    cols = [c for c in cols if c in df.columns]
    bounds = column_bounds(df, cols, lower_pct, upper_pct)
    return df.withColumns({c: clip(F.col(f"`{c}`"), F.lit(lo), F.lit(hi))
                           for c, (lo, hi) in bounds.items()})


def range_check(df: DataFrame, cols: Sequence[str], ratio: float = 5.0, floor: float = 0.001) -> DataFrame:
    """Per column: min, p1, p99, max and an alarm when |max| > ratio*|p99| and |p99| > floor."""
    q = quantiles(df, cols, [0.01, 0.99])
    qw = q.groupBy("column").pivot("p", [0.01, 0.99]).agg(F.first("value"))
    qw = qw.select("column", F.col("`0.01`").alias("p1"), F.col("`0.99`").alias("p99"))
    mm = df.agg(*[x for c in cols for x in (F.min(_num(df, c)).alias(f"{c}__min"),
                                             F.max(_num(df, c)).alias(f"{c}__max"))])
    mml = mm.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}__min`").alias("min"),
                                                 F.col(f"`{c}__max`").alias("max")) for c in cols])).alias("s")
                    ).select("s.*")
    out = mml.join(qw, "column", "left")
    return out.withColumn("alarm", F.coalesce((F.abs("max") > ratio * F.abs("p99")) & (F.abs("p99") > floor),
                                              F.lit(False)))


def clip_flag(df: DataFrame, bounds: Mapping[str, tuple[float, float]] = S.CLIP_BOUNDS,
              prefix: str = "fe_clipped_") -> DataFrame:
    """Fixed bounds per column with an int8 audit flag (NULL value -> flag 0)."""
    out = {}
    for c, (lo, hi) in bounds.items():
        if c in df.columns:
            x = F.col(f"`{c}`")
            out[f"{prefix}{c}"] = F.coalesce((x < lo) | (x > hi), F.lit(False)).cast("byte")
            out[c] = clip(x, lo, hi)
    return df.withColumns(out)


def prune_coverage(df: DataFrame, cols: Sequence[str], min_pct: float = S.PRUNE_COVERAGE_MIN,
                   prefix: str = "_PODADA_") -> tuple[DataFrame, list[str]]:
    """Columns below min_pct coverage are kept but renamed with a prefix."""
    cov = coverage(df, cols).where(F.col("pct_coverage") < min_pct).collect()
    low = [r["column"] for r in cov]
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in low}), low


# -- imputation ----------------------------------------------------------------------

def impute_audit_rule(pct_null: Column, cuts: Sequence[float] = S.AUDIT_NULL_CUTS) -> Column:
    """Strategy from % null: none / simple / with flag / structural."""
    return (F.when(pct_null < cuts[0], "NO_IMPUTAR").when(pct_null < cuts[1], "IMP_SIMPLE")
             .when(pct_null < cuts[2], "IMP_CON_FLAG").otherwise("IMP_ESTRUCTURAL"))


def impute_plan(df: DataFrame, features: Sequence[str], sector: str,
                class_b: Sequence[str] = (), usd_override: Sequence[str] = tuple(S.USD_OVERRIDE_COLS),
                cuts: Sequence[float] = S.IMPUTE_COVERAGE_CUTS, limit: float = S.STRUCTURAL_STD_LIMIT) -> DataFrame:
    """Per feature: coverage %, spread of sector missing %, structural flag, strategy."""
    m = missing_by_group(df, sector, features, limit)
    cov, st = F.col("pct_coverage"), F.col("structural")
    base = (F.when((cov >= cuts[0]) & ~st, "IMP_MEDIANA_GLOBAL")
             .when((cov >= cuts[0]) & st, "IMP_MEDIANA_SECTOR")
             .when((cov >= cuts[1]) & ~st, "IMP_MEDIANA_FLAG")
             .when((cov >= cuts[1]) & st, "IMP_CERO_FLAG")
             .when(cov >= cuts[2], "CONSERVAR_FLAG")
             .otherwise("PODA_PRELIMINAR"))
    strat = (F.when(F.col("column").isin(list(class_b)) if class_b else F.lit(False), "IMP_CERO_INICIAL")
              .when(F.col("column").isin(list(usd_override)) if usd_override else F.lit(False),
                    "IMP_MEDIANA_SECTOR_FLAG")
              .otherwise(base))
    return m.withColumn("strategy", strat)


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0).cast(df.schema[c].dataType)) for c in cols})


def impute_zero_flag(df: DataFrame, cols: Sequence[str], prefix: str = "fe_isnull_") -> DataFrame:
    """0 + int8 flag of where the value was missing (flag computed before the fill)."""
    df = df.withColumns({f"{prefix}{c}": F.col(f"`{c}`").isNull().cast("byte") for c in cols})
    return impute_zero(df, cols)


def global_medians(df: DataFrame, cols: Sequence[str]) -> dict:
    q = quantiles(df, cols, [0.5]).collect()
    med = {c: None for c in cols}
    med.update({r["column"]: r["value"] for r in q})
    return med


def impute_median(df: DataFrame, cols: Sequence[str], flag: bool = False,
                  prefix: str = "fe_imputed_") -> DataFrame:
    """Global median fill (medians of all columns in one distributed pass)."""
    med = global_medians(df, cols)
    if flag:
        df = df.withColumns({f"{prefix}{c}": F.col(f"`{c}`").isNull().cast("byte") for c in cols})
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(med[c])) for c in cols if med[c] is not None})


def impute_group_median(df: DataFrame, cols: Sequence[str], key: str, flag: bool = False,
                        global_after: bool = True, prefix: str = "fe_imputed_") -> DataFrame:
    """Sector median, then global median for what is left.

    Rows whose key is NULL lose their value in the sector step (pandas groupby
    transform leaves them NaN) and get the global median. ``global_after`` picks the
    global median of the sector-filled column (True) or of the original (False)."""
    if flag:
        df = df.withColumns({f"{prefix}{c}": F.col(f"`{c}`").isNull().cast("byte") for c in cols})
    held = cut_lineage(df.select(key, *cols), "medians")  # every pass below reads these columns alone

    def fill(d: DataFrame) -> DataFrame:
        return d.join(gm, key, "left").withColumns({c: F.when(F.col(key).isNotNull(), F.coalesce(F.col(f"`{c}`"), F.col(f"{c}_median")))
                                                    for c in cols}).drop(*[f"{c}_median" for c in cols])
    gm = cut_lineage(grouped_medians(held.where(F.col(key).isNotNull()), [key], cols), "medians")
    glob = global_medians(fill(held) if global_after else held, cols)
    return fill(df).withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(glob[c])) for c in cols if glob[c] is not None})


def impute_by_plan(df: DataFrame, plan: DataFrame, sector: str) -> DataFrame:
    """Apply an ``impute_plan``: each strategy to its columns, in the plan's fixed order.

    Kept-with-flag columns get 0 and their flag; columns for preliminary pruning stay as
    they are (``prune_coverage`` renames them). One row per feature reaches the driver."""
    of: dict[str, list[str]] = {}
    for r in plan.select("column", "strategy").collect():
        of.setdefault(r["strategy"], []).append(r["column"])
    steps = {
        "IMP_CERO_INICIAL": impute_zero,
        "IMP_MEDIANA_GLOBAL": impute_median,
        "IMP_MEDIANA_SECTOR": lambda d, c: impute_group_median(d, c, sector),
        "IMP_MEDIANA_SECTOR_FLAG": lambda d, c: impute_group_median(d, c, sector, flag=True, global_after=False),
        "IMP_MEDIANA_FLAG": lambda d, c: impute_median(d, c, flag=True),
        "IMP_CERO_FLAG": impute_zero_flag,
        "CONSERVAR_FLAG": impute_zero_flag,
    }
    for name, step in steps.items():
        if of.get(name):
            df = step(df, sorted(of[name]))
    return df


def impute_backstop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Leftover NULLs -> global median, or 0 when the column has no value at all."""
    med = global_medians(df, cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(med[c] if med[c] is not None else 0.0))
                           for c in cols})


# -- checks ----------------------------------------------------------------------------

def accept_checks(df: DataFrame, checks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Named checks evaluated in ONE aggregate: {name: (value_aggregate, ok_predicate_on_value)}.
    Output rows: (check, value, ok)."""
    one = df.agg(*[v.cast("double").alias(n) for n, (v, _) in checks.items()])
    long = one.unpivot([], list(checks), "check", "value")
    ok = None
    for n, (_, pred) in checks.items():
        cond = F.col("check") == n
        ok = F.when(cond, pred) if ok is None else ok.when(cond, pred)
    return long.withColumn("ok", F.coalesce(ok, F.lit(False)))


def needs_coverage(df: DataFrame, needs: Mapping[str, Sequence[str]], max_null_pct: float = 80.0) -> DataFrame:
    """Per business need and required column: present?, % null, usable (present and % null <= max)."""
    present = [c for cs in needs.values() for c in cs if c in df.columns]
    cov = coverage(df, list(dict.fromkeys(present))) if present else None
    rows = [(n, c, c in df.columns) for n, cs in needs.items() for c in cs]
    m = df.sparkSession.createDataFrame(rows, "need string, column string, present boolean")
    if cov is not None:
        m = m.join(cov.select("column", (F.lit(100.0) - F.col("pct_coverage")).alias("pct_null")), "column", "left")
    else:
        m = m.withColumn("pct_null", F.lit(None).cast("double"))
    return m.withColumn("usable", F.col("present") & F.coalesce(F.col("pct_null") <= max_null_pct, F.lit(False)))
