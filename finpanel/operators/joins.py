"""Joins. Sides are broadcast by Spark's own byte thresholds, never by a count of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

def join_num_sub(num: DataFrame, sub: DataFrame, on: str = "adsh",
                 sub_cols: Sequence[str] = ("period",)) -> DataFrame:
    """Inner equi-join of facts with the header's columns on the filing id alone.

    Spark chooses: a header within its broadcast bound meets the facts where they are read, so
    later filters drop rows before any exchange; else both sides are dealt by filing once, and
    what is grouped by filing afterwards needs no further exchange."""
    return num.join(sub.select(on, *[c for c in sub_cols if c != on]), on, "inner")


def join_meta(wide: DataFrame, sub: DataFrame, on: str = "adsh") -> DataFrame:
    """Inner join of the pivoted panel with header metadata (both keyed by filing)."""
    return wide.join(sub, on, "inner")


def join_outer_align(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b, on, "full_outer")


def join_left_lookup(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b, on, "left")


def semi_anti_groups(df: DataFrame, keys: DataFrame, on: str | Sequence[str], how: str = "semi") -> DataFrame:
    """Keep (semi) or drop (anti) rows whose key is in a computed key set."""
    return df.join(keys, on, "left_semi" if how == "semi" else "left_anti")


def concat_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Add a block of derived columns by expression (no positional join)."""
    return df.withColumns(exprs)
