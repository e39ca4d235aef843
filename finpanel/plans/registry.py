"""Registered queries over the driver tables: name -> (Spark builder, oracle SQL).

Every builder takes (spark, sf_dir) and returns a DataFrame; every oracle is DuckDB
SQL over the pre-registered table views. Doubles are rounded on both sides so
summation order does not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column (presentation only)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def load_all() -> None:
    """Import every catalogue module so its @register calls run."""
    import importlib
    import pkgutil

    import finpanel.plans as plans
    for m in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        if m.name.startswith("catalog_"):
            importlib.import_module(f"finpanel.plans.{m.name}")
