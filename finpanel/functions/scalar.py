"""Pure Column expressions. Every helper is null-safe under ANSI mode.

Rules (see SURVEY §1.4): SQL NULL is the only missing value; division uses
``try_divide``; text->number uses ``try_cast``; clipping keeps NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


# -- numbers -----------------------------------------------------------------

def coerce_numeric(c: ColumnOrName, to: str = "double") -> Column:
    """Text -> number or NULL. Integers go through double so '20250228.0' parses."""
    c = col(c)
    if to in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        return c.try_cast("double").try_cast(to)
    return c.try_cast(to)


def qtrs_default(c: ColumnOrName, default: int = -1) -> Column:
    """Null or unparseable duration -> ``default`` (an int)."""
    return F.coalesce(coerce_numeric(c, "int"), F.lit(default))


def safe_div(num: ColumnOrName, den: ColumnOrName, fill=None) -> Column:
    """num / den; NULL (or ``fill``) when den is 0 or either side is NULL."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return r if fill is None else F.coalesce(r, F.lit(fill))


def eps_div(num: ColumnOrName, den: ColumnOrName, eps: float = 1e-9) -> Column:
    """Legacy num / (den + eps)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double") + F.lit(eps))


def zero_fill(c: ColumnOrName) -> Column:
    return F.coalesce(col(c).cast("double"), F.lit(0.0))


def coalesce_pair(*cs: ColumnOrName) -> Column:
    return F.coalesce(*[col(c) for c in cs])


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """Bound to [lo, hi]; NULL stays NULL (``greatest``/``least`` would not)."""
    x = col(c)
    y = x
    if hi is not None:
        y = F.least(y, _lit(hi))
    if lo is not None:
        y = F.greatest(y, _lit(lo))
    return F.when(x.isNotNull(), y)


def sigmoid_score(z: ColumnOrName, center: float = 1.23) -> Column:
    """1 / (1 + exp(z - center)): high score = high risk."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(col(z) - F.lit(center)))


def const_null_if(c: ColumnOrName, bad: Column) -> Column:
    """Value, set to NULL where ``bad`` holds (NULL condition keeps the value)."""
    return F.when(~F.coalesce(bad, F.lit(False)), col(c))


# -- text / codes ----------------------------------------------------------------

def norm_text(c: ColumnOrName, upper: bool = True) -> Column:
    x = F.trim(col(c))
    return F.upper(x) if upper else x


def map_codes(c: ColumnOrName, mapping: Mapping, default=None) -> Column:
    """Code -> value through a literal map; unmapped -> ``default`` (NULL by default)."""
    expr = None
    x = col(c)
    for k, v in mapping.items():
        expr = (F.when(x == F.lit(k), F.lit(v)) if expr is None
                else expr.when(x == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def period_label(fy: ColumnOrName, fp: ColumnOrName) -> Column:
    """'2021-Q1'; NULL if either part is NULL."""
    return F.concat(col(fy).cast("int").cast("string"), F.lit("-"), col(fp))


def yyyymmdd_to_date(c: ColumnOrName) -> Column:
    """Integer or text yyyymmdd -> DATE, NULL when invalid (e.g. 20251340)."""
    s = coerce_numeric(c, "bigint").cast("string")
    return F.try_to_date(s, "yyyyMMdd")


def date_to_yyyymmdd(c: ColumnOrName) -> Column:
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def day_lag(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days from ``start`` to ``end`` (both yyyymmdd); NULL per row when invalid."""
    return F.datediff(yyyymmdd_to_date(end), yyyymmdd_to_date(start))


def contains_flag(c: ColumnOrName, text: str = "/A") -> Column:
    return F.coalesce(col(c).contains(text), F.lit(False)).cast("int")


def code_prefix(c: ColumnOrName, n: int = 2) -> Column:
    """First n digits of the integer value of a code: '0100' -> 10."""
    as_int = coerce_numeric(c, "bigint")
    return F.substring(as_int.cast("string"), 1, n).try_cast("int")


def range_code(c: ColumnOrName, bounds: Sequence[tuple[float, str]], default: str = "UNKNOWN") -> Column:
    """Upper-bound lookup: first label whose bound >= value; NULL/out of range -> default."""
    x = col(c)
    expr = None
    for ub, label in bounds:
        cond = x <= F.lit(ub)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def bin_right_open(c: ColumnOrName, edges: Sequence[float], labels: Sequence) -> Column:
    """Label of [edges[i], edges[i+1]); outside all bins or NULL -> NULL."""
    x = col(c)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


# -- flags ----------------------------------------------------------------------

def bool_flag_null(cond: Column, ref: ColumnOrName | Iterable[ColumnOrName]) -> Column:
    """0/1 of ``cond``; NULL where the reference column(s) is NULL."""
    refs = [ref] if isinstance(ref, (str, Column)) else list(ref)
    present = None
    for r in refs:
        p = col(r).isNotNull()
        present = p if present is None else present & p
    return F.when(present, F.coalesce(cond, F.lit(False)).cast("int"))


def bool_flag_zero(cond: Column) -> Column:
    """0/1 of ``cond``; NULL -> 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def cast_byte(c: ColumnOrName) -> Column:
    return col(c).cast("int").cast("byte")


def row_sum(cols: Iterable[ColumnOrName]) -> Column:
    """Sum of columns with NULL as 0."""
    out = None
    for c in cols:
        t = F.coalesce(col(c).cast("double"), F.lit(0.0))
        out = t if out is None else out + t
    return out


def row_all_present(cols: Iterable[ColumnOrName]) -> Column:
    out = None
    for c in cols:
        t = col(c).isNotNull()
        out = t if out is None else out & t
    return out


def row_count_present(cols: Iterable[ColumnOrName]) -> Column:
    out = None
    for c in cols:
        t = col(c).isNotNull().cast("int")
        out = t if out is None else out + t
    return out
