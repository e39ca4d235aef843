"""DuckDB oracle for the feature layers over the driver financial panel (CTE ``FIN``)."""

from __future__ import annotations

from finpanel.plans.driver_panel import FIN_SQL_CTES, ROLES

_PRESENT = set(ROLES)


def o(tag: str) -> str:
    """Optional column: the tag if the panel has it, else a typed NULL."""
    return tag if tag in _PRESENT else "CAST(NULL AS DOUBLE)"


def sd(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def z(x: str) -> str:
    return f"COALESCE(CAST({x} AS DOUBLE), 0.0)"


def af(q: str) -> str:
    return f"(CASE WHEN {q} >= 1 AND {q} <= 4 THEN CAST(4.0 AS DOUBLE) / {q} END)"


def clip(x: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE GREATEST({lo}, LEAST({hi}, {x})) END)"


def flag(cond: str, ref: str) -> str:
    return f"(CASE WHEN {ref} IS NULL THEN NULL WHEN COALESCE({cond}, false) THEN 1 ELSE 0 END)"


REV = "fe_ctx_revenue_consolidado"
DEBT = f"(COALESCE({o('LongTermDebt')}, {z(o('LongTermDebtNoncurrent'))} + {z(o('LongTermDebtCurrent'))}) + " \
       f"{z(o('DebtCurrent'))} + {z(o('ShortTermBorrowings'))})"
SHORT = f"({z(o('DebtCurrent'))} + {z(o('ShortTermBorrowings'))})"
CFO = o("NetCashProvidedByUsedInOperatingActivities")

CTX = {
    REV: f"COALESCE({o('Revenues')}, {o('RevenueFromContractWithCustomerExcludingAssessedTax')})",
    "fe_ctx_fp_orden": "CASE fp WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'FY' THEN 4 END",
    "fe_ctx_periodo": "CAST(fy AS VARCHAR) || '-' || fp",
    "fe_ctx_filing_lag": "CAST(datediff('day', CAST(TRY_STRPTIME(CAST(period AS VARCHAR), '%Y%m%d') AS DATE), "
                         "CAST(TRY_STRPTIME(CAST(filed AS VARCHAR), '%Y%m%d') AS DATE)) AS INTEGER)",
    "fe_ctx_amendment": "CAST(COALESCE(contains(form, '/A'), false) AS INTEGER)",
    "fe_ctx_sic_sector": "TRY_CAST(SUBSTRING(CAST(TRY_CAST(TRY_CAST(sic AS DOUBLE) AS BIGINT) AS VARCHAR), 1, 2) AS INTEGER)",
}

RQ = f"COALESCE({o('Revenues_qtrs')}, {o('RevenueFromContractWithCustomerExcludingAssessedTax_qtrs')})"
ANNUAL = {
    "fe_anual_revenue": f"{REV} * {af(RQ)}",
    "fe_anual_ebit": f"{o('OperatingIncomeLoss')} * {af(o('OperatingIncomeLoss_qtrs'))}",
    "fe_anual_net_income": f"{o('NetIncomeLoss')} * {af(o('NetIncomeLoss_qtrs'))}",
    "fe_anual_cash_operating": f"{CFO} * {af(o('NetCashProvidedByUsedInOperatingActivities_qtrs'))}",
    "fe_anual_cash_investing": f"{o('NetCashProvidedByUsedInInvestingActivities')} * "
                               f"{af(o('NetCashProvidedByUsedInInvestingActivities_qtrs'))}",
    "fe_anual_cash_financing": f"{o('NetCashProvidedByUsedInFinancingActivities')} * "
                               f"{af(o('NetCashProvidedByUsedInFinancingActivities_qtrs'))}",
    "fe_anual_gross_profit": f"{o('GrossProfit')} * {af(o('GrossProfit_qtrs'))}",
    "fe_anual_factor": af(f"COALESCE({RQ}, {o('NetIncomeLoss_qtrs')})"),
}

TA, NI, EQ, EBIT = o("Assets"), o("NetIncomeLoss"), o("StockholdersEquity"), o("OperatingIncomeLoss")
CA, CL, TL, CASH = o("AssetsCurrent"), o("LiabilitiesCurrent"), o("Liabilities"), \
    o("CashAndCashEquivalentsAtCarryingValue")
CAPEX = o("PaymentsToAcquirePropertyPlantAndEquipment")
RATIOS = {
    "fe_ratio_roa": sd(NI, TA), "fe_ratio_roe": sd(NI, EQ),
    "fe_ratio_margen_bruto": sd(o("GrossProfit"), REV), "fe_ratio_margen_operativo": sd(EBIT, REV),
    "fe_ratio_margen_neto": sd(NI, REV),
    "fe_ratio_ebitda_assets": sd(f"{z(EBIT)} + {z(o('DepreciationAndAmortization'))}", TA),
    "fe_ratio_liquidez": sd(CA, CL), "fe_ratio_quick": sd(f"{z(CA)} - {z(o('InventoryNet'))}", CL),
    "fe_ratio_cash": sd(CASH, TA), "fe_ratio_cash_current": sd(CASH, CL),
    "fe_ratio_apalancamiento": sd(TL, TA), "fe_ratio_deuda_equity": sd(DEBT, EQ),
    "fe_ratio_deuda_assets": sd(DEBT, TA), "fe_ratio_deuda_cp_total": sd(SHORT, DEBT),
    "fe_ratio_cobertura_intereses": sd(EBIT, o("InterestExpense")),
    "fe_ratio_rotacion_activos": sd(REV, TA),
    "fe_ratio_sga_revenue": sd(o("SellingGeneralAndAdministrativeExpense"), REV),
    "fe_ratio_rnd_revenue": sd(o("ResearchAndDevelopmentExpense"), REV),
    "fe_ratio_capex_revenue": sd(CAPEX, REV),
    "fe_ratio_tangibilidad": sd(o("PropertyPlantAndEquipmentNet"), TA),
    "fe_ratio_goodwill_assets": sd(o("Goodwill"), TA),
    "fe_ratio_intangibles_assets": sd(o("IntangibleAssetsNetExcludingGoodwill"), TA),
    "fe_ratio_capital_trabajo": sd(f"{z(CA)} - {z(CL)}", TA),
    "fe_ratio_fcf_assets": sd(f"{CFO} - {z(CAPEX)}", TA),
    "fe_ratio_calidad_ingresos": sd(CFO, NI), "fe_ratio_cashflow_deuda": sd(CFO, DEBT),
    "fe_ratio_cfo_revenue": sd(CFO, REV),
}
SOUT = o("CommonStockSharesOutstanding")
SB, SD = o("WeightedAverageNumberOfSharesOutstandingBasic"), o("WeightedAverageNumberOfDilutedSharesOutstanding")
SHARES = {"fe_shares_book_value": sd(EQ, SOUT), "fe_shares_dilution": sd(f"{SD} - {SB}", SB),
          "fe_shares_assets_per_share": sd(TA, SOUT)}
ZP = {
    "fe_zscore_x1_wc_assets": sd(f"{z(CA)} - {z(CL)}", TA),
    "fe_zscore_x2_re_assets": sd(o("RetainedEarningsAccumulatedDeficit"), TA),
    "fe_zscore_x3_ebit_assets": sd("fe_anual_ebit", TA),
    "fe_zscore_x4_equity_liab": sd(EQ, f"ABS({TL})"),
    "fe_zscore_x5_rev_assets": sd("fe_anual_revenue", TA),
}
W = (0.717, 0.847, 3.107, 0.420, 0.998)
ZSUM = " + ".join(f"{w} * {z(p)}" for w, p in zip(W, ZP))
NPRES = " + ".join(f"CAST({p} IS NOT NULL AS INTEGER)" for p in ZP)
ZEXPR = clip(f"(CASE WHEN {NPRES} >= 3 THEN {ZSUM} END)", -10.0, 15.0)
FLAGS = {
    "fe_flag_patrimonio_negativo": flag(f"{EQ} < 0", EQ),
    "fe_flag_perdida_neta": flag(f"{NI} < 0", NI),
    "fe_flag_deficit_acumulado": flag(f"{o('RetainedEarningsAccumulatedDeficit')} < 0",
                                      o("RetainedEarningsAccumulatedDeficit")),
    "fe_flag_liquidez_critica": flag("fe_ratio_liquidez < 1", "fe_ratio_liquidez"),
    "fe_flag_fco_negativo": flag(f"{CFO} < 0", CFO),
    "fe_flag_insolvencia": flag(f"{TL} > {TA}", TL),
    "fe_flag_margen_negativo": flag(f"{EBIT} < 0", EBIT),
    "fe_flag_sin_revenue": f"CAST(({REV} IS NULL OR {REV} = 0) AS INTEGER)",
    "fe_flag_altman_distress": flag("fe_zscore_altman < 1.23", "fe_zscore_altman"),
    "fe_flag_altman_grey": flag("fe_zscore_altman >= 1.23 AND fe_zscore_altman < 2.90", "fe_zscore_altman"),
}
WIN = "OVER (PARTITION BY cik ORDER BY fy NULLS LAST, fe_ctx_fp_orden NULLS LAST)"


def _lag(c: str) -> str:
    return f"(CASE WHEN cik IS NULL THEN NULL ELSE LAG({c}) {WIN} END)"


PCT = [("Assets", "fe_delta_assets_qoq"), (REV, "fe_delta_revenue_qoq"),
       ("NetIncomeLoss", "fe_delta_net_income_qoq"),
       ("CashAndCashEquivalentsAtCarryingValue", "fe_delta_cash_qoq"),
       ("Liabilities", "fe_delta_liabilities_qoq"), ("StockholdersEquity", "fe_delta_equity_qoq")]
ABSD = [("fe_ratio_liquidez", "fe_delta_liquidez_qoq"), ("fe_ratio_apalancamiento", "fe_delta_apalancamiento_qoq"),
        ("fe_zscore_altman", "fe_delta_zscore_qoq"), ("fe_zscore_risk_score", "fe_delta_risk_score_qoq")]
DELTAS = {}
for _src, _name in PCT:
    DELTAS[_name] = clip(sd(f"{_src} - {_lag(_src)}", f"ABS({_lag(_src)})"), -5.0, 5.0)
for _src, _name in ABSD:
    DELTAS[_name] = f"{_src} - {_lag(_src)}"


def _sel(d: dict) -> str:
    return ",\n    ".join(f"{e} AS {k}" for k, e in d.items())


FEATURE_SQL_CTES = FIN_SQL_CTES + f""",
C1 AS (SELECT *, {_sel(CTX)} FROM FIN),
C2 AS (SELECT *, {_sel(ANNUAL)}, {_sel(RATIOS)}, {_sel(SHARES)} FROM C1),
C3 AS (SELECT *, {_sel(ZP)} FROM C2),
C4 AS (SELECT *, {ZEXPR} AS fe_zscore_altman FROM C3),
C5 AS (SELECT *, 1.0 / (1.0 + EXP(fe_zscore_altman - 1.23)) AS fe_zscore_risk_score FROM C4),
C6 AS (SELECT *, {_sel(FLAGS)} FROM C5),
C7 AS (SELECT *, {_sel(DELTAS)} FROM C6),
FE AS (SELECT *, {flag('fe_delta_risk_score_qoq > 0', 'fe_delta_risk_score_qoq')} AS fe_delta_risk_deterioro,
    {_lag('fe_zscore_risk_score')} AS fe_delta_risk_score_prev FROM C7)"""


def select_rounded(cols, src="FE", keys=("adsh", "cik", "fy", "fp"), doubles=None) -> str:
    """SELECT keys + cols, rounding the double columns (all but known int/text ones)."""
    ints = {"fe_ctx_fp_orden", "fe_ctx_filing_lag", "fe_ctx_amendment", "fe_ctx_sic_sector",
            "fe_ctx_periodo", "fe_delta_risk_deterioro"} | {c for c in cols if c.startswith("fe_flag_")}
    parts = [k for k in keys]
    for c in cols:
        if c in ints or (doubles is not None and c not in doubles):
            parts.append(c)
        else:
            parts.append(f"ROUND({c}, 6) AS {c}")
    return "WITH " + FEATURE_SQL_CTES + "\nSELECT " + ", ".join(parts) + f" FROM {src}"
