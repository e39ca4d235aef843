"""Train/validation splits, feature lists, scaling and class balancing.

Randomness is replaced by seeded hashes of row keys, so every split and sample is
repeatable and survives task retries (no ``rand()`` re-evaluated on a retry).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S


def unit_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from the row keys (52 hash bits)."""
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return F.pmod(h, F.lit(1 << 52)).cast("double") / float(1 << 52)


def split_temporal(df: DataFrame, col: str = "fy", cut: int = S.TRAIN_LAST_FY) -> tuple[DataFrame, DataFrame]:
    """col <= cut -> train, else validation."""
    return df.where(F.col(col) <= cut), df.where(F.col(col) > cut)


def split_random(df: DataFrame, keys: Sequence[str], share: float = 0.8, strata: str | None = None,
                 seed: int = 42) -> DataFrame:
    """Adds ``split`` = train/test: seeded hash order inside each stratum (NULL is a
    stratum), the first round(share * n) rows train — the share holds per class and the
    split is repeatable."""
    from finpanel.ml.ranks import row_positions
    cols = list(df.columns)
    d = row_positions(df.withColumn("_u", unit_hash(keys, seed)), ["_u"], [strata] if strata else [])
    return d.select(*cols, F.when(F.col("_pos") < F.round(F.col("_n") * share), "train").otherwise("test").alias("split"))


def feature_select(df: DataFrame, exclude: Sequence[str] = (), exclude_prefixes: Sequence[str] = ()) -> list[str]:
    """All columns minus exclusion lists and prefixes (schema only)."""
    ex = set(exclude)
    return [c for c in df.columns if c not in ex and not any(c.startswith(p) for p in exclude_prefixes)]


def binary_split(df: DataFrame, cols: Sequence[str]) -> tuple[list[str], list[str]]:
    """(binary, continuous): binary = every non-null value in {0, 1}; one aggregate."""
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).alias(c) for c in cols]).first()
    binary = [c for c in cols if row[c] == 0]
    return binary, [c for c in cols if c not in binary]


def standardise(train: DataFrame, others: Sequence[DataFrame], cols: Sequence[str]) -> list[DataFrame]:
    """Fit mean / population std on train, apply to all; std 0 or NULL -> divide by 1."""
    st = train.agg(*[x for c in cols for x in (F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s"))]).first()

    def apply(d: DataFrame) -> DataFrame:
        out = {}
        for c in cols:
            m, s = st[f"{c}__m"], st[f"{c}__s"]
            s = s if s not in (None, 0.0) else 1.0
            out[c] = (F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(s)
        return d.withColumns(out)
    return [apply(train)] + [apply(o) for o in others]


def class_balance(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Rows per class (NULL is one) before and after; a class that one side lacks is NULL there."""
    sides = (before.select(label, F.lit(1).alias("b"), F.lit(None).cast("int").alias("a"))
             .unionByName(after.select(label, F.lit(None).cast("int").alias("b"), F.lit(1).alias("a"))))
    return sides.groupBy(label).agg(F.sum("b").alias("n_before"), F.sum("a").alias("n_after"))


def undersample(df: DataFrame, label: str, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Every class (NULL is one) cut to the smallest class by seeded hash order (rows kept whole)."""
    from finpanel.ml.ranks import row_positions
    cols = list(df.columns)
    d = row_positions(df.withColumn("_u", unit_hash(keys, seed)), ["_u"], [label])
    least = d.agg(F.min("_n")).first()[0] or 0
    return d.where(F.col("_pos") < least).select(*cols)
