"""Feature blocks (73 ``fe_*`` columns) as column expressions, one select per layer.

Layer 1  context        6   fe_ctx_*
Layer 2  annualised     8   fe_anual_*      ratios 27  fe_ratio_*   shares 3  fe_shares_*
Layer 3  Altman Z'      7   fe_zscore_*     flags  10  fe_flag_*
Layer 4  deltas        12   fe_delta_*      (one Window spec: one sort per entity)

Column names of the inputs are the XBRL tags; a tag missing from the frame reads as
NULL (``optional_col``), so any panel with a subset of tags works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel import schema as S
from finpanel.functions.scalar import (
    bool_flag_null, bool_flag_zero, clip, code_prefix, contains_flag, day_lag, eps_div, map_codes,
    period_label, row_count_present, safe_div, sigmoid_score, zero_fill,
)
from finpanel.operators.panel import lag_expr

REV = "fe_ctx_revenue_consolidado"


def optional_col(df: DataFrame, name: str, default=None) -> Column:
    """Column if present, else a typed literal (NULL by default)."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(default).cast("double")


def annual_factor(q: Column) -> Column:
    """4 / qtrs for 1 <= qtrs <= 4, else NULL."""
    qd = q.cast("double")
    return F.when((qd >= 1) & (qd <= 4), F.lit(4.0) / qd)


# -- layer 1 ------------------------------------------------------------------------

def fe_context(df: DataFrame, sic: str = "sic") -> DataFrame:
    o = lambda c: optional_col(df, c)
    return df.withColumns({
        REV: F.coalesce(o("Revenues"), o("RevenueFromContractWithCustomerExcludingAssessedTax")),
        "fe_ctx_fp_orden": map_codes("fp", S.FP_ORDER),
        "fe_ctx_periodo": period_label("fy", "fp"),
        "fe_ctx_filing_lag": day_lag("period", "filed"),
        "fe_ctx_amendment": contains_flag("form", "/A"),
        "fe_ctx_sic_sector": code_prefix(sic),
    })


# -- layer 2 ------------------------------------------------------------------------

ANNUAL = [("fe_anual_ebit", "OperatingIncomeLoss"), ("fe_anual_net_income", "NetIncomeLoss"),
          ("fe_anual_cash_operating", "NetCashProvidedByUsedInOperatingActivities"),
          ("fe_anual_cash_investing", "NetCashProvidedByUsedInInvestingActivities"),
          ("fe_anual_cash_financing", "NetCashProvidedByUsedInFinancingActivities"),
          ("fe_anual_gross_profit", "GrossProfit")]


def annualised_exprs(df: DataFrame) -> dict[str, Column]:
    o = lambda c: optional_col(df, c)
    rq = F.coalesce(o("Revenues_qtrs"), o("RevenueFromContractWithCustomerExcludingAssessedTax_qtrs"))
    out = {"fe_anual_revenue": F.col(REV) * annual_factor(rq)}
    for name, tag in ANNUAL:
        out[name] = o(tag) * annual_factor(o(f"{tag}_qtrs"))
    out["fe_anual_factor"] = annual_factor(F.coalesce(rq, o("NetIncomeLoss_qtrs")))
    return out


def fe_annualised(df: DataFrame) -> DataFrame:
    return df.withColumns(annualised_exprs(df))


def total_debt(df: DataFrame) -> tuple[Column, Column]:
    """(total debt, short-term debt): LTD else LTD noncurrent + current; + current + short-term."""
    o = lambda c: optional_col(df, c)
    short = zero_fill(o("DebtCurrent")) + zero_fill(o("ShortTermBorrowings"))
    long_ = F.coalesce(o("LongTermDebt"), zero_fill(o("LongTermDebtNoncurrent")) + zero_fill(o("LongTermDebtCurrent")))
    return long_ + short, short


def ratio_exprs(df: DataFrame) -> dict[str, Column]:
    o = lambda c: optional_col(df, c)
    ta, ni, eq, ebit = o("Assets"), o("NetIncomeLoss"), o("StockholdersEquity"), o("OperatingIncomeLoss")
    ca, cl, tl, cash = o("AssetsCurrent"), o("LiabilitiesCurrent"), o("Liabilities"), \
        o("CashAndCashEquivalentsAtCarryingValue")
    rev, cfo = F.col(REV), o("NetCashProvidedByUsedInOperatingActivities")
    debt, short = total_debt(df)
    capex = o("PaymentsToAcquirePropertyPlantAndEquipment")
    return {
        "fe_ratio_roa": safe_div(ni, ta),
        "fe_ratio_roe": safe_div(ni, eq),
        "fe_ratio_margen_bruto": safe_div(o("GrossProfit"), rev),
        "fe_ratio_margen_operativo": safe_div(ebit, rev),
        "fe_ratio_margen_neto": safe_div(ni, rev),
        "fe_ratio_ebitda_assets": safe_div(zero_fill(ebit) + zero_fill(o("DepreciationAndAmortization")), ta),
        "fe_ratio_liquidez": safe_div(ca, cl),
        "fe_ratio_quick": safe_div(zero_fill(ca) - zero_fill(o("InventoryNet")), cl),
        "fe_ratio_cash": safe_div(cash, ta),
        "fe_ratio_cash_current": safe_div(cash, cl),
        "fe_ratio_apalancamiento": safe_div(tl, ta),
        "fe_ratio_deuda_equity": safe_div(debt, eq),
        "fe_ratio_deuda_assets": safe_div(debt, ta),
        "fe_ratio_deuda_cp_total": safe_div(short, debt),
        "fe_ratio_cobertura_intereses": safe_div(ebit, o("InterestExpense")),
        "fe_ratio_rotacion_activos": safe_div(rev, ta),
        "fe_ratio_sga_revenue": safe_div(o("SellingGeneralAndAdministrativeExpense"), rev),
        "fe_ratio_rnd_revenue": safe_div(o("ResearchAndDevelopmentExpense"), rev),
        "fe_ratio_capex_revenue": safe_div(capex, rev),
        "fe_ratio_tangibilidad": safe_div(o("PropertyPlantAndEquipmentNet"), ta),
        "fe_ratio_goodwill_assets": safe_div(o("Goodwill"), ta),
        "fe_ratio_intangibles_assets": safe_div(o("IntangibleAssetsNetExcludingGoodwill"), ta),
        "fe_ratio_capital_trabajo": safe_div(zero_fill(ca) - zero_fill(cl), ta),
        "fe_ratio_fcf_assets": safe_div(cfo - zero_fill(capex), ta),
        "fe_ratio_calidad_ingresos": safe_div(cfo, ni),
        "fe_ratio_cashflow_deuda": safe_div(cfo, debt),
        "fe_ratio_cfo_revenue": safe_div(cfo, rev),
    }


PROFITABILITY = ["fe_ratio_roa", "fe_ratio_roe", "fe_ratio_margen_bruto", "fe_ratio_margen_operativo",
                 "fe_ratio_margen_neto", "fe_ratio_ebitda_assets"]
LIQUIDITY = ["fe_ratio_liquidez", "fe_ratio_quick", "fe_ratio_cash", "fe_ratio_cash_current"]
LEVERAGE = ["fe_ratio_apalancamiento", "fe_ratio_deuda_equity", "fe_ratio_deuda_assets",
            "fe_ratio_deuda_cp_total", "fe_ratio_cobertura_intereses"]
EFFICIENCY = ["fe_ratio_rotacion_activos", "fe_ratio_sga_revenue", "fe_ratio_rnd_revenue",
              "fe_ratio_capex_revenue"]
BALANCE_QUALITY = ["fe_ratio_tangibilidad", "fe_ratio_goodwill_assets", "fe_ratio_intangibles_assets",
                   "fe_ratio_capital_trabajo"]
CASHFLOW = ["fe_ratio_fcf_assets", "fe_ratio_calidad_ingresos", "fe_ratio_cashflow_deuda",
            "fe_ratio_cfo_revenue"]


def _ratio_block(names):
    def block(df: DataFrame) -> DataFrame:
        e = ratio_exprs(df)
        return df.withColumns({n: e[n] for n in names})
    return block


fe_profitability = _ratio_block(PROFITABILITY)
fe_liquidity = _ratio_block(LIQUIDITY)
fe_leverage = _ratio_block(LEVERAGE)
fe_efficiency = _ratio_block(EFFICIENCY)
fe_balance_quality = _ratio_block(BALANCE_QUALITY)
fe_cashflow = _ratio_block(CASHFLOW)


def shares_exprs(df: DataFrame) -> dict[str, Column]:
    o = lambda c: optional_col(df, c)
    out_, basic, dil = o("CommonStockSharesOutstanding"), o("WeightedAverageNumberOfSharesOutstandingBasic"), \
        o("WeightedAverageNumberOfDilutedSharesOutstanding")
    return {"fe_shares_book_value": safe_div(o("StockholdersEquity"), out_),
            "fe_shares_dilution": safe_div(dil - basic, basic),
            "fe_shares_assets_per_share": safe_div(o("Assets"), out_)}


def fe_shares(df: DataFrame) -> DataFrame:
    return df.withColumns(shares_exprs(df))


# -- layer 3 ------------------------------------------------------------------------

ZPARTS = ["fe_zscore_x1_wc_assets", "fe_zscore_x2_re_assets", "fe_zscore_x3_ebit_assets",
          "fe_zscore_x4_equity_liab", "fe_zscore_x5_rev_assets"]


def altman_parts_exprs(df: DataFrame) -> dict[str, Column]:
    o = lambda c: optional_col(df, c)
    ta = o("Assets")
    ebit = F.col("fe_anual_ebit") if "fe_anual_ebit" in df.columns else o("OperatingIncomeLoss")
    rev = F.col("fe_anual_revenue") if "fe_anual_revenue" in df.columns else F.col(REV)
    return {
        "fe_zscore_x1_wc_assets": safe_div(zero_fill(o("AssetsCurrent")) - zero_fill(o("LiabilitiesCurrent")), ta),
        "fe_zscore_x2_re_assets": safe_div(o("RetainedEarningsAccumulatedDeficit"), ta),
        "fe_zscore_x3_ebit_assets": safe_div(ebit, ta),
        "fe_zscore_x4_equity_liab": safe_div(o("StockholdersEquity"), F.abs(o("Liabilities"))),
        "fe_zscore_x5_rev_assets": safe_div(rev, ta),
    }


def altman_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(altman_parts_exprs(df))


def altman_z(parts: Sequence[str] = tuple(ZPARTS), weights=S.ALTMAN_WEIGHTS,
             min_parts: int = S.ALTMAN_MIN_PARTS, bounds=S.ALTMAN_BOUNDS) -> Column:
    """Weighted sum with missing parts as 0; NULL unless >= min_parts present; clipped."""
    z = None
    for w, p in zip(weights, parts):
        t = F.lit(w) * zero_fill(p)
        z = t if z is None else z + t
    z = F.when(row_count_present(parts) >= min_parts, z)
    return clip(z, bounds[0], bounds[1])


def risk_score(z: Column | str, center: float = S.ALTMAN_DISTRESS) -> Column:
    return sigmoid_score(z, center)


def flag_exprs(df: DataFrame) -> dict[str, Column]:
    o = lambda c: optional_col(df, c)
    eq, ni, re_ = o("StockholdersEquity"), o("NetIncomeLoss"), o("RetainedEarningsAccumulatedDeficit")
    cfo, tl, ta, ebit = o("NetCashProvidedByUsedInOperatingActivities"), o("Liabilities"), o("Assets"), \
        o("OperatingIncomeLoss")
    liq, z, rev = F.col("fe_ratio_liquidez"), F.col("fe_zscore_altman"), F.col(REV)
    return {
        "fe_flag_patrimonio_negativo": bool_flag_null(eq < 0, eq),
        "fe_flag_perdida_neta": bool_flag_null(ni < 0, ni),
        "fe_flag_deficit_acumulado": bool_flag_null(re_ < 0, re_),
        "fe_flag_liquidez_critica": bool_flag_null(liq < 1, liq),
        "fe_flag_fco_negativo": bool_flag_null(cfo < 0, cfo),
        "fe_flag_insolvencia": bool_flag_null(tl > ta, tl),
        "fe_flag_margen_negativo": bool_flag_null(ebit < 0, ebit),
        "fe_flag_sin_revenue": bool_flag_zero(rev.isNull() | (rev == 0)),
        "fe_flag_altman_distress": bool_flag_null(z < S.ALTMAN_DISTRESS, z),
        "fe_flag_altman_grey": bool_flag_null((z >= S.ALTMAN_DISTRESS) & (z < S.ALTMAN_GREY), z),
    }


def fe_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(flag_exprs(df))


# -- layer 4 ------------------------------------------------------------------------

PCT_DELTAS = [("Assets", "fe_delta_assets_qoq"), (REV, "fe_delta_revenue_qoq"),
              ("NetIncomeLoss", "fe_delta_net_income_qoq"),
              ("CashAndCashEquivalentsAtCarryingValue", "fe_delta_cash_qoq"),
              ("Liabilities", "fe_delta_liabilities_qoq"), ("StockholdersEquity", "fe_delta_equity_qoq")]
ABS_DELTAS = [("fe_ratio_liquidez", "fe_delta_liquidez_qoq"),
              ("fe_ratio_apalancamiento", "fe_delta_apalancamiento_qoq"),
              ("fe_zscore_altman", "fe_delta_zscore_qoq"), ("fe_zscore_risk_score", "fe_delta_risk_score_qoq")]


def panel_order() -> list[Column]:
    """Entity order (fy, fp order) with NULLs last, as pandas sorts."""
    return [F.col("fy").asc_nulls_last(), F.col("fe_ctx_fp_orden").asc_nulls_last()]


def fe_deltas(df: DataFrame, entity: str = "cik", order: Sequence[Column] | None = None,
              bound: float = S.DELTA_BOUND) -> DataFrame:
    order = list(order or panel_order())
    out = {}
    for src, name in PCT_DELTAS:
        if src in df.columns:
            prev = lag_expr(entity, order, src)
            out[name] = clip(safe_div(F.col(src) - prev, F.abs(prev)), -bound, bound)
    for src, name in ABS_DELTAS:
        if src in df.columns:
            out[name] = F.col(src) - lag_expr(entity, order, src)
    df = df.withColumns(out)
    return df.withColumns({
        "fe_delta_risk_deterioro": bool_flag_null(F.col("fe_delta_risk_score_qoq") > 0, "fe_delta_risk_score_qoq"),
        "fe_delta_risk_score_prev": lag_expr(entity, order, "fe_zscore_risk_score"),
    })


def build_features(df: DataFrame, entity: str = "cik", sic: str = "sic") -> DataFrame:
    """All 73 features in four projection layers (each a single ``withColumns``)."""
    df = fe_context(df, sic)
    layer2 = {}
    layer2.update(annualised_exprs(df))
    layer2.update(ratio_exprs(df))
    layer2.update(shares_exprs(df))
    df = df.withColumns(layer2)
    df = df.withColumns(altman_parts_exprs(df))
    z = altman_z()
    df = df.withColumn("fe_zscore_altman", z)
    df = df.withColumn("fe_zscore_risk_score", risk_score("fe_zscore_altman"))
    df = df.withColumns(flag_exprs(df))
    return fe_deltas(df, entity)


FEATURE_COLS = list(S.CONTEXT_COLS) + ["fe_anual_revenue"] + [n for n, _ in ANNUAL] + ["fe_anual_factor"] \
    + S.RATIO_COLS + ZPARTS + ["fe_zscore_altman", "fe_zscore_risk_score"] \
    + ["fe_flag_patrimonio_negativo", "fe_flag_perdida_neta", "fe_flag_deficit_acumulado",
       "fe_flag_liquidez_critica", "fe_flag_fco_negativo", "fe_flag_insolvencia", "fe_flag_margen_negativo",
       "fe_flag_sin_revenue", "fe_flag_altman_distress", "fe_flag_altman_grey"] \
    + S.SHARES_COLS + [n for _, n in PCT_DELTAS] + [n for _, n in ABS_DELTAS] \
    + ["fe_delta_risk_deterioro", "fe_delta_risk_score_prev"]


# -- legacy variants ------------------------------------------------------------------

LEGACY_FLOWS = ["OperatingIncomeLoss", "revenues_consolidado", "NetIncomeLoss", "GrossProfit",
                "InterestExpense", "NetCashProvidedByUsedInOperatingActivities"]


def annualise_by_period(df: DataFrame, fp: str = "fp", cols: Sequence[str] = tuple(LEGACY_FLOWS),
                        factors=S.LEGACY_PERIOD_FACTOR) -> DataFrame:
    """Legacy: flow x factor by fiscal period (Q1 4, Q2 2, Q3 4/3, FY/Q4 1, other 1)."""
    f = F.coalesce(map_codes(fp, factors), F.lit(1.0))
    out = {"factor_anual": f}
    out.update({f"{c}_anual": F.col(c) * f for c in cols if c in df.columns})
    return df.withColumns(out)


def altman_strict(df: DataFrame, eps: float = S.LEGACY_EPS, weights=S.ALTMAN_WEIGHTS,
                  bounds=S.ALTMAN_STRICT_BOUNDS, ebit: str = "OperatingIncomeLoss_anual",
                  rev: str = "revenues_consolidado_anual") -> DataFrame:
    """Legacy Z: eps in denominators, any missing part -> NULL, clip +-20, then sigmoid."""
    o = lambda c: optional_col(df, c)
    ta = o("Assets")
    parts = {
        "X1_wc_assets": eps_div(o("AssetsCurrent") - o("LiabilitiesCurrent"), ta, eps),
        "X2_re_assets": eps_div(o("RetainedEarningsAccumulatedDeficit"), ta, eps),
        "X3_ebit_assets": eps_div(o(ebit), ta, eps),
        "X4_equity_liab": eps_div(o("StockholdersEquity"), F.abs(o("Liabilities")), eps),
        "X5_rev_assets": eps_div(o(rev), ta, eps),
    }
    df = df.withColumns(parts)
    z = None
    for w, p in zip(weights, parts):
        t = F.lit(w) * F.col(p)
        z = t if z is None else z + t
    df = df.withColumn("altman_zscore", clip(z, bounds[0], bounds[1]))
    return df.withColumn("risk_score_0_1", risk_score("altman_zscore"))


LEGACY_FLAGS = ["flag_patrimonio_negativo", "flag_perdida_neta", "flag_deficit_acumulado",
                "flag_liquidez_critica", "flag_fco_negativo"]


def flags_legacy(df: DataFrame) -> DataFrame:
    """Legacy flags with NULL as 0, plus the number of active alerts."""
    o = lambda c: optional_col(df, c)
    df = df.withColumns({
        "flag_patrimonio_negativo": bool_flag_zero(o("StockholdersEquity") < 0),
        "flag_perdida_neta": bool_flag_zero(o("NetIncomeLoss") < 0),
        "flag_deficit_acumulado": bool_flag_zero(o("RetainedEarningsAccumulatedDeficit") < 0),
        "flag_liquidez_critica": bool_flag_zero(o("LiabilitiesCurrent") > o("AssetsCurrent")),
        "flag_fco_negativo": bool_flag_zero(o("NetCashProvidedByUsedInOperatingActivities") < 0),
    })
    return df.withColumn("n_alertas", sum((F.col(c) for c in LEGACY_FLAGS), F.lit(0)))


# FIXED VALUES — legacy RATIO_* -> fe_ratio_* names
RATIO_ALIAS = {
    "RATIO_apalancamiento": "fe_ratio_apalancamiento", "RATIO_liquidez_corriente": "fe_ratio_liquidez",
    "RATIO_deuda_equity": "fe_ratio_deuda_equity", "RATIO_margen_operativo": "fe_ratio_margen_operativo",
    "RATIO_margen_neto": "fe_ratio_margen_neto", "RATIO_cobertura_intereses": "fe_ratio_cobertura_intereses",
    "RATIO_cash": "fe_ratio_cash", "RATIO_ROA": "fe_ratio_roa", "RATIO_ROE": "fe_ratio_roe",
    "RATIO_cashflow_deuda": "fe_ratio_cashflow_deuda",
}


def ratio_alias(df: DataFrame, mapping=None) -> DataFrame:
    """Rename legacy ratio columns to the fe_ratio_* names (present ones only)."""
    m = mapping or RATIO_ALIAS
    return df.withColumnsRenamed({k: v for k, v in m.items() if k in df.columns})
