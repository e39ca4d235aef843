"""Entries 2 and 3 composed: cleaned panel -> features -> prepared set -> targets.

Entry 2 (clean, features, prepare) and Entry 3 (strict universe, targets, encoding; forward
fill, imputation by plan, clipping, pruning, checks) as DataFrame functions.
Every data-dependent decision (coverage, percentiles, medians, correlations) is a
small distributed aggregate followed by column expressions.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.functions.scalar import range_code
from finpanel.operators import features as fe
from finpanel.operators import filters as fl
from finpanel.operators import prepare as pr
from finpanel.operators.aggregates import coverage
from finpanel.operators.panel import dedup_latest, ffill_limit
from finpanel.operators.reshape import one_hot
from finpanel.operators.targets import filter_has_target, strict_universe, targets
from finpanel.session import cut_lineage


def clean(df: DataFrame, year_range=S.YEAR_RANGE) -> DataFrame:
    """Phase 1: trim fp, drop Q4, keep positive assets, one filing per period, null
    impossible values and bad durations, fiscal-year range."""
    df = df.withColumn("fp", F.upper(F.trim(F.col("fp"))))
    df = fl.filter_not_q4(df, "fp")
    df = fl.filter_positive(df, "Assets")
    df = dedup_latest(df, ["cik", "fy", "fp"], "filed", ["adsh"])
    df = pr.clean_impossible(df)
    df = pr.clean_duration(df)
    return fl.filter_range(df, "fy", *year_range)


def prepare(df: DataFrame, min_pct: float = S.COVERAGE_MIN_PCT, min_assets: float = S.MIN_ASSETS,
            min_periods: int = S.MIN_PERIODS, winsor=S.WINSOR_PCTS) -> DataFrame:
    """Phase 3: drop durations, coverage filter, quality filters, winsorising."""
    df = pr.drop_durations(df)
    protected = S.CONTEXT_COLS + ["fe_zscore_altman", "fe_zscore_risk_score",
                                  "fe_flag_altman_distress", "fe_flag_altman_grey"]
    df, _ = pr.coverage_filter(df, min_pct, "fe_", protected)
    df = fl.filter_min(df, "Assets", min_assets)
    df = fl.filter_min_group(df, "cik", "adsh", min_periods)
    return pr.winsorize(df, S.WINSOR_COLS, *winsor)


def feature_panel(raw: DataFrame, year_range=S.YEAR_RANGE, min_assets: float = S.MIN_ASSETS,
                  min_periods: int = S.MIN_PERIODS, min_pct: float = S.COVERAGE_MIN_PCT) -> DataFrame:
    """Entry 2 end to end: clean -> 73 features -> prepare. The feature panel is
    materialised (checkpoint folder) before the multi-pass preparation statistics."""
    feats = cut_lineage(fe.build_features(clean(raw, year_range)))
    return prepare(feats, min_pct=min_pct, min_assets=min_assets, min_periods=min_periods)


def modelling_set(panel: DataFrame, parts: Sequence[str] = tuple(fe.ZPARTS), entity: str = "cik",
                  forms: Sequence[str] = tuple(S.FORMS), target: str = "target_score_next") -> DataFrame:
    """Entry 3 whole: ``training_set``, forward fill of stock columns per company, imputation
    by plan (medians by two-digit SIC sector), clipping with flags, pruning of sparse and
    redundant features (the autoregressive ones stay), backstop fill, acceptance checks.

    Each data-dependent step reads a stored table and brings one row per feature (or pair)
    to the driver; pruned columns stay under their prefix, as in the original. Missing values
    or forbidden columns among the features raise, the other checks only warn."""
    from finpanel.operators.profile import prune_corr
    df = training_set(panel, parts, entity, forms)
    free = [c for c in fe.FEATURE_COLS if c in df.columns and c not in S.CONTEXT_COLS and c not in S.FEATURES_A_FORBIDDEN]
    class_b = [c for c in S.FEATURES_B_AUTOREGRESSIVE if c in free]
    stock = [c for c in free if c.startswith(("fe_anual_", "fe_shares_"))]
    df = cut_lineage(ffill_limit(df, entity, fe.panel_order(), stock, S.FFILL_LIMIT), "training")
    rows = df.count()
    plan = pr.impute_plan(df, free, "fe_ctx_sic_sector", class_b=class_b)
    df = cut_lineage(pr.clip_flag(pr.impute_by_plan(df, plan, "fe_ctx_sic_sector")), "imputed")
    df, sparse = pr.prune_coverage(df, free)
    df, redundant = prune_corr(df, [c for c in free if c not in sparse and c not in class_b], target)
    final = [c for c in free if c not in sparse and c not in redundant]
    gaps = [r["column"] for r in coverage(df, final).where("pct_coverage < 100").collect()]
    df = pr.impute_backstop(df, gaps) if gaps else df
    failed = {r["check"]: r["value"] for r in modelling_checks(df, final, rows, target).where("NOT ok").collect()}
    if failed.keys() & {"nulls", "forbidden"}:
        raise ValueError(f"modelling set not accepted: {failed}")
    if failed:
        warnings.warn(f"modelling set: checks failed: {failed}", stacklevel=2)
    return df


def modelling_checks(df: DataFrame, features: Sequence[str], rows_before: int, target: str = "target_score_next") -> DataFrame:
    """The acceptance checks of Entry 3 (check, value, ok) for the final ``features``."""
    from finpanel.operators.profile import corr_with_target
    n = F.count(F.lit(1))

    def nulls(cols):
        return sum((n - F.count(c) for c in cols), F.max(F.lit(0)))

    def constant(x):
        return F.coalesce(F.max(F.lit(x)), F.lit(x))

    free = [c for c in features if c not in S.FEATURES_B_AUTOREGRESSIVE]
    r = corr_with_target(df, free, [target]).agg(F.max("abs_r")).first()[0] if free else None
    v = F.col("value")
    return pr.accept_checks(df, {
        "nulls": (F.coalesce(nulls(features), F.lit(0)), v == 0),
        "features": (constant(len(features)), v >= S.MIN_FEATURES),
        "rows_lost_pct": ((F.lit(rows_before) - n) * 100.0 / F.lit(max(rows_before, 1)), F.abs(v) <= S.MAX_ROWS_LOST_PCT),
        "targets_null": (F.coalesce(nulls([c for c in df.columns if c.startswith("target_")]), F.lit(0)), v == 0),
        "max_corr": (constant(r or 0.0), v <= S.LEAKAGE_MAX_R),
        "forbidden": (constant(len(set(features) & set(S.FEATURES_A_FORBIDDEN))), v == 0),
    })


def training_set(panel: DataFrame, parts: Sequence[str] = tuple(fe.ZPARTS), entity: str = "cik",
                 forms: Sequence[str] = tuple(S.FORMS)) -> DataFrame:
    """Entry 3 core: strict universe (valid forms, all five Z parts), targets from the
    next surviving row, rows without a next value dropped, SIC division dummies.

    A panel that lacks a part (say, its coverage was too low) raises: the universe would
    be another one."""
    missing = [p for p in parts if p not in panel.columns]
    if missing:
        raise ValueError(f"the strict universe needs all parts; missing: {missing}")
    df = strict_universe(panel, parts, forms)
    df = targets(df, entity, fe.panel_order(), "fe_zscore_risk_score")
    df = filter_has_target(df, ["target_score_next"])
    div = range_code(F.col("fe_ctx_sic_sector"), S.SIC_DIVISIONS)
    df = df.withColumn("fe_sic_division", div)
    return one_hot(df, "fe_sic_division", S.SIC_DIVISION_LABELS, "fe_sic_div_")
