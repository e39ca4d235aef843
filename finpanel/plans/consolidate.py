"""Entry 1 — long quarterly facts -> wide company x filing panel.

  facts ─ filters (tags, blank segments/coreg, unit rule) ─┐
  header ─ form filter ────────────────────────────────────┴ join on filing ─ ddate = period
    ─ longest duration per (filing, tag) ─ pivot to tags + _qtrs ─ order

Shuffles: facts and header are each dealt once, by filing. Dedup and pivot group by the
filing and more, so they reuse that partitioning; the header's columns come along as
group keys and the header is read once. A filing has some thousands of facts at most, so
no filing makes a partition heavy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.operators import filters as fl
from finpanel.operators.aggregates import pivot_wide
from finpanel.operators.joins import join_num_sub
from finpanel.operators.panel import dedup_latest, dedup_longest
from finpanel.operators.reshape import order_columns


def consolidate(num: DataFrame, sub: DataFrame, tags: Sequence[str] = tuple(S.ALL_TAGS),
                unit_rules: Mapping[str, Sequence[str]] | None = None,
                forms: Sequence[str] | None = tuple(S.FORMS),
                meta_cols: Sequence[str] = tuple(S.META_COLS),
                current: tuple[str, str] = ("ddate", "period"),
                join_cols: Sequence[str] = ("period",),
                tie: Sequence[str] = ("version", "value")) -> DataFrame:
    unit_rules = unit_rules or {"USD": S.TAGS_USD, "shares": S.TAGS_SHARES}
    if forms is not None:
        sub = fl.filter_in(sub, "form", forms)
    facts = fl.filter_in(num, "tag", tags)
    for c in ("segments", "coreg"):
        facts = fl.filter_blank(facts, c)
    facts = fl.filter_uom(facts, unit_rules)
    meta = ["adsh"] + [c for c in meta_cols if c in sub.columns and c != "adsh"]
    extra = [c for c in join_cols if c not in meta]
    needed = list(dict.fromkeys(["adsh", "tag", "qtrs", "value", current[0], *tie]))
    facts = facts.select(*[c for c in needed if c in facts.columns])
    facts = join_num_sub(facts, sub, "adsh", [*meta, *extra])
    # Current period only. Within coalesce the equality is no join key: as one it would deal the
    # facts by period, too, and the grouping by filing would need an exchange of its own.
    facts = facts.where(F.coalesce(F.col(current[0]) == F.col(current[1]), F.lit(False)))
    longest = dedup_longest(facts, [*meta, "tag"], "qtrs", list(tie), cols=["qtrs", "value"])
    panel = pivot_wide(longest, meta, "tag", list(tags), "value", "qtrs")
    return order_columns(panel, [list(meta_cols), list(tags), [f"{t}_qtrs" for t in tags]])


def clean_panel(panel: DataFrame, keys: Sequence[str] = ("cik", "fy", "fp"), by: str = "filed",
                tie: Sequence[str] = ("adsh",)) -> DataFrame:
    """One filing per (entity, fiscal year, period): the latest filed, NULL counts as latest."""
    return dedup_latest(panel, list(keys), by, list(tie))


def consolidate_quarters(num: DataFrame, sub: DataFrame, **kw) -> DataFrame:
    """Headers loaded from several quarters: keep the last header per filing first."""
    from finpanel.operators.panel import dedup_last_by_id
    if "quarter" in sub.columns:
        sub = dedup_last_by_id(sub, "adsh", "quarter")
    return consolidate(num, sub, **kw)
