"""Set operations, column housekeeping and reshaping."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_quarters(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append per-quarter frames whose columns may differ (missing -> NULL)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def drop_dup_suffix(df: DataFrame, pattern: str = r"\.\d+$") -> DataFrame:
    """Drop columns such as 'x.1' left by a duplicated header."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.search(pattern, c)])


def order_columns(df: DataFrame, blocks: Sequence[Iterable[str] | str]) -> DataFrame:
    """Select columns block by block; a block given as 'sorted:<regex>' takes the
    matching columns A-Z; the rest keep their order at the end."""
    seen: list[str] = []
    for b in blocks:
        if isinstance(b, str) and b.startswith("sorted:"):
            rx = re.compile(b[len("sorted:"):])
            cols = sorted(c for c in df.columns if rx.search(c) and c not in seen)
        else:
            cols = [c for c in b if c in df.columns and c not in seen]
        seen += cols
    seen += [c for c in df.columns if c not in seen]
    return df.select(*[F.col(f"`{c}`") for c in seen])


def rename_cols(df: DataFrame, mapping: Mapping[str, str] | None = None, prefix: str | None = None,
                cols: Sequence[str] = ()) -> DataFrame:
    """Rename by map, and/or prefix a list of columns (e.g. '_PODADA_')."""
    m = dict(mapping or {})
    if prefix:
        m.update({c: f"{prefix}{c}" for c in cols})
    return df.withColumnsRenamed({k: v for k, v in m.items() if k in df.columns})


def column_contract(df: DataFrame, required: Sequence[str], pattern: str | None = None,
                    raise_on_missing: bool = False) -> DataFrame:
    """Missing / extra columns against a required list (extra = matching ``pattern`` but
    not required). Returns (column, status) rows; optionally raises on missing."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    extra = [c for c in df.columns if c not in set(required) and (pattern is None or re.search(pattern, c))]
    if raise_on_missing and missing:
        raise ValueError(f"missing required columns: {missing}")
    rows = [(c, "missing") for c in missing] + [(c, "extra") for c in extra] + \
           [(c, "ok") for c in required if c in have]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable",
         val: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), var, val)


def unstack(df: DataFrame, key: str, col: str, values: Sequence, fill: int = 0) -> DataFrame:
    """Long -> wide counts of ``col`` per ``key`` over a fixed level list."""
    w = df.groupBy(key).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return w.select(key, *[F.coalesce(F.col(f"`{v}`"), F.lit(fill)).alias(str(v)) for v in values])


def one_hot(df: DataFrame, col: str, levels: Sequence[str], prefix: str) -> DataFrame:
    """Fixed-level dummies as byte columns (levels fixed, so the schema never depends on data)."""
    return df.withColumns({f"{prefix}{lv}": (F.col(col) == F.lit(lv)).cast("int").cast("byte")
                           for lv in levels})
