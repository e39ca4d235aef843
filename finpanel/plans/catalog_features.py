"""Entry 1 (consolidation) and the 2.9 feature blocks on the driver financial panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.operators import features as fe
from finpanel.plans import sql_features as sf
from finpanel.plans.driver_panel import RAW_SQL_CTES, financial_panel, raw_panel
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv

KEYS = ["adsh", "cik", "fy", "fp"]
RAW_COLS = ["adsh", "cik", "form", "period", "filed", "fy", "fp", "price"] + dv.DRIVER_TAGS + \
    [f"{t}_qtrs" for t in dv.DRIVER_TAGS]


@register("consolidate", "WITH " + RAW_SQL_CTES + "\nSELECT " + ", ".join(
    f"ROUND({c}, 6) AS {c}" if c in dv.DRIVER_TAGS or c == "price" else c for c in RAW_COLS) + " FROM RAW")
def q_consolidate(spark, d):
    return rounded(raw_panel(spark, d).select(*RAW_COLS))


def _features(spark, d):
    return fe.build_features(financial_panel(spark, d), "cik", "sic")


BLOCKS = {
    "fe_context": ["fe_ctx_revenue_consolidado", "fe_ctx_fp_orden", "fe_ctx_periodo",
                   "fe_ctx_filing_lag", "fe_ctx_amendment", "fe_ctx_sic_sector"],
    "fe_annualised": ["fe_anual_revenue"] + [n for n, _ in fe.ANNUAL] + ["fe_anual_factor"],
    "fe_profitability": fe.PROFITABILITY,
    "fe_liquidity": fe.LIQUIDITY,
    "fe_leverage": fe.LEVERAGE,
    "fe_efficiency": fe.EFFICIENCY,
    "fe_balance_quality": fe.BALANCE_QUALITY,
    "fe_cashflow": fe.CASHFLOW,
    "fe_shares": ["fe_shares_book_value", "fe_shares_dilution", "fe_shares_assets_per_share"],
    "altman_parts": fe.ZPARTS,
    "altman_z": ["fe_zscore_altman"],
    "risk_score": ["fe_zscore_risk_score"],
    "fe_flags": ["fe_flag_patrimonio_negativo", "fe_flag_perdida_neta", "fe_flag_deficit_acumulado",
                 "fe_flag_liquidez_critica", "fe_flag_fco_negativo", "fe_flag_insolvencia",
                 "fe_flag_margen_negativo", "fe_flag_sin_revenue", "fe_flag_altman_distress",
                 "fe_flag_altman_grey"],
    "fe_deltas": [n for _, n in fe.PCT_DELTAS] + [n for _, n in fe.ABS_DELTAS]
                 + ["fe_delta_risk_deterioro", "fe_delta_risk_score_prev"],
}


def _block_query(cols):
    def fn(spark, d):
        return rounded(_features(spark, d).select(*KEYS, *cols))
    return fn


for _name, _cols in BLOCKS.items():
    register(_name, sf.select_rounded(_cols))(_block_query(_cols))


@register("build_features", sf.select_rounded(fe.FEATURE_COLS))
def q_build_features(spark, d):
    return rounded(_features(spark, d).select(*KEYS, *fe.FEATURE_COLS))


@register("total_debt", "WITH " + sf.FEATURE_SQL_CTES + f"""
SELECT adsh, cik, fy, fp, ROUND({sf.DEBT}, 6) AS total_debt, ROUND({sf.SHORT}, 6) AS short_debt FROM FIN""")
def q_total_debt(spark, d):
    p = financial_panel(spark, d)
    debt, short = fe.total_debt(p)
    return rounded(p.select(*KEYS, debt.alias("total_debt"), short.alias("short_debt")))


@register("optional_col", "WITH " + sf.FEATURE_SQL_CTES + """
SELECT adsh, ROUND(Assets, 6) AS assets, CAST(NULL AS DOUBLE) AS goodwill FROM FIN""")
def q_optional_col(spark, d):
    p = financial_panel(spark, d)
    return rounded(p.select("adsh", fe.optional_col(p, "Assets").alias("assets"),
                            fe.optional_col(p, "Goodwill").alias("goodwill")))


LEG = {"Q1": 4.0, "Q2": 2.0, "Q3": 4.0 / 3.0, "FY": 1.0, "Q4": 1.0}


@register("annualise_by_period", "WITH " + sf.FEATURE_SQL_CTES + """
SELECT adsh, ROUND(f, 6) AS factor_anual, ROUND(OperatingIncomeLoss * f, 6) AS OperatingIncomeLoss_anual,
  ROUND(NetIncomeLoss * f, 6) AS NetIncomeLoss_anual FROM (
  SELECT *, CAST(COALESCE(CASE fp WHEN 'Q1' THEN 4.0 WHEN 'Q2' THEN 2.0 WHEN 'Q3' THEN 4.0 / 3.0
                            WHEN 'FY' THEN 1.0 WHEN 'Q4' THEN 1.0 END, 1.0) AS DOUBLE) AS f FROM FIN)""")
def q_annualise_by_period(spark, d):
    p = financial_panel(spark, d)
    out = fe.annualise_by_period(p, "fp", ["OperatingIncomeLoss", "NetIncomeLoss"], LEG)
    return rounded(out.select("adsh", "factor_anual", "OperatingIncomeLoss_anual", "NetIncomeLoss_anual"))


def _eps(n, dd):
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({dd} AS DOUBLE) + 1e-9, 0))"


STRICT_SQL = "WITH " + sf.FEATURE_SQL_CTES + f""",
L AS (SELECT *, CAST(COALESCE(CASE fp WHEN 'Q1' THEN 4.0 WHEN 'Q2' THEN 2.0 WHEN 'Q3' THEN 4.0 / 3.0
                         WHEN 'FY' THEN 1.0 WHEN 'Q4' THEN 1.0 END, 1.0) AS DOUBLE) AS f,
             COALESCE(Revenues, RevenueFromContractWithCustomerExcludingAssessedTax) AS revenues_consolidado FROM FIN),
X AS (SELECT *, {_eps('AssetsCurrent - LiabilitiesCurrent', 'Assets')} AS X1_wc_assets,
   {_eps('RetainedEarningsAccumulatedDeficit', 'Assets')} AS X2_re_assets,
   {_eps('OperatingIncomeLoss * f', 'Assets')} AS X3_ebit_assets,
   {_eps('StockholdersEquity', 'ABS(Liabilities)')} AS X4_equity_liab,
   {_eps('revenues_consolidado * f', 'Assets')} AS X5_rev_assets FROM L),
Z AS (SELECT *, {sf.clip('(0.717 * X1_wc_assets + 0.847 * X2_re_assets + 3.107 * X3_ebit_assets + 0.420 * X4_equity_liab + 0.998 * X5_rev_assets)', -20.0, 20.0)} AS altman_zscore FROM X)
SELECT adsh, ROUND(X1_wc_assets, 6) AS X1_wc_assets, ROUND(X4_equity_liab, 6) AS X4_equity_liab,
  ROUND(altman_zscore, 6) AS altman_zscore, ROUND(1.0 / (1.0 + EXP(altman_zscore - 1.23)), 6) AS risk_score_0_1 FROM Z"""


@register("altman_strict", STRICT_SQL)
def q_altman_strict(spark, d):
    p = financial_panel(spark, d).withColumn(
        "revenues_consolidado", F.coalesce("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax"))
    p = fe.annualise_by_period(p, "fp", ["OperatingIncomeLoss", "revenues_consolidado"], LEG)
    out = fe.altman_strict(p)
    return rounded(out.select("adsh", "X1_wc_assets", "X4_equity_liab", "altman_zscore", "risk_score_0_1"))


@register("flags_legacy", "WITH " + sf.FEATURE_SQL_CTES + """
SELECT adsh, f1 AS flag_patrimonio_negativo, f2 AS flag_perdida_neta, f3 AS flag_deficit_acumulado,
  f4 AS flag_liquidez_critica, f5 AS flag_fco_negativo, f1 + f2 + f3 + f4 + f5 AS n_alertas FROM (
  SELECT adsh, CAST(COALESCE(StockholdersEquity < 0, false) AS INTEGER) AS f1,
    CAST(COALESCE(NetIncomeLoss < 0, false) AS INTEGER) AS f2,
    CAST(COALESCE(RetainedEarningsAccumulatedDeficit < 0, false) AS INTEGER) AS f3,
    CAST(COALESCE(LiabilitiesCurrent > AssetsCurrent, false) AS INTEGER) AS f4,
    CAST(COALESCE(NetCashProvidedByUsedInOperatingActivities < 0, false) AS INTEGER) AS f5 FROM FIN)""")
def q_flags_legacy(spark, d):
    out = fe.flags_legacy(financial_panel(spark, d))
    return out.select("adsh", *fe.LEGACY_FLAGS, "n_alertas")


@register("ratio_alias", sf.select_rounded(["fe_ratio_liquidez", "fe_ratio_roa"], keys=("adsh",)))
def q_ratio_alias(spark, d):
    f = _features(spark, d).select("adsh", F.col("fe_ratio_liquidez").alias("RATIO_liquidez_corriente"),
                                   F.col("fe_ratio_roa").alias("RATIO_ROA"))
    return rounded(fe.ratio_alias(f))


# -- entries 2 and 3 composed (rows-only: each is a chain of the operators above) ----------

def _years(spark, d):
    """First and last fiscal year of the table's filings, so that the range drops none."""
    return tuple(dv.header(spark, d).agg(F.min("fy"), F.max("fy")).first())


@register("feature_panel")
def q_feature_panel(spark, d):
    from finpanel.plans.training import feature_panel
    return feature_panel(financial_panel(spark, d), year_range=(1995, 2001))


@register("training_set")
def q_training_set(spark, d):
    from finpanel.plans.driver_panel import DENSE_ROLES, DRIVER_FORMS
    from finpanel.plans.training import feature_panel, training_set
    # Order prices are no assets in dollars: no minimum, and columns stay however sparse.
    panel = feature_panel(financial_panel(spark, d, DENSE_ROLES), year_range=_years(spark, d), min_assets=0, min_periods=1, min_pct=0.0)
    return training_set(panel, forms=DRIVER_FORMS)


@register("modelling_set")
def q_modelling_set(spark, d):
    from finpanel.plans.driver_panel import DENSE_ROLES, DRIVER_FORMS
    from finpanel.plans.training import feature_panel, modelling_set
    panel = feature_panel(financial_panel(spark, d, DENSE_ROLES), year_range=_years(spark, d), min_assets=0, min_periods=1, min_pct=0.0)
    return modelling_set(panel, forms=DRIVER_FORMS)
