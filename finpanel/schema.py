"""Schemas, tag catalogue and fixed thresholds.

Everything under "FIXED VALUES" must equal the published pipeline's constants for
results to agree; they are kept together, in their natural order, as plain text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — XBRL tag catalogue (balance, income, cash flow, shares)
# ---------------------------------------------------------------------------
TAGS_BALANCE = [
    "Assets", "AssetsCurrent", "AssetsNoncurrent",
    "CashAndCashEquivalentsAtCarryingValue",
    "RestrictedCashAndCashEquivalentsAtCarryingValue",
    "ShortTermInvestments", "MarketableSecuritiesCurrent",
    "AccountsReceivableNetCurrent", "InventoryNet",
    "PrepaidExpenseAndOtherAssetsCurrent",
    "PropertyPlantAndEquipmentNet", "OperatingLeaseRightOfUseAsset",
    "Goodwill", "IntangibleAssetsNetExcludingGoodwill",
    "OtherAssetsNoncurrent", "OtherAssetsCurrent",
    "Liabilities", "LiabilitiesCurrent", "LiabilitiesNoncurrent",
    "AccountsPayableCurrent", "AccruedLiabilitiesCurrent",
    "ShortTermBorrowings", "DebtCurrent", "LongTermDebt",
    "LongTermDebtNoncurrent", "LongTermDebtCurrent",
    "OperatingLeaseLiabilityCurrent", "OperatingLeaseLiabilityNoncurrent",
    "DeferredRevenueCurrent", "DeferredRevenueNoncurrent",
    "ContractWithCustomerLiabilityCurrent",
    "OtherLiabilitiesNoncurrent", "OtherLiabilitiesCurrent",
    "StockholdersEquity",
    "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    "RetainedEarningsAccumulatedDeficit",
    "CommonStockValue", "AdditionalPaidInCapital",
    "TreasuryStockValue", "MinorityInterest",
    "AccumulatedOtherComprehensiveIncomeLossNetOfTax",
]
TAGS_INCOME = [
    "Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax",
    "CostOfRevenue", "CostOfGoodsAndServicesSold", "GrossProfit",
    "OperatingExpenses", "ResearchAndDevelopmentExpense",
    "SellingGeneralAndAdministrativeExpense",
    "GeneralAndAdministrativeExpense", "SellingAndMarketingExpense",
    "DepreciationAndAmortization", "DepreciationDepletionAndAmortization",
    "Depreciation", "AmortizationOfIntangibleAssets",
    "OperatingIncomeLoss", "InterestExpense", "InterestExpenseDebt",
    "InterestIncomeExpenseNet", "NonoperatingIncomeExpense",
    "OtherNonoperatingIncomeExpense",
    "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
    "IncomeTaxExpenseBenefit", "IncomeLossFromContinuingOperations",
    "NetIncomeLoss", "ComprehensiveIncomeNetOfTax",
    "EarningsPerShareBasic", "EarningsPerShareDiluted",
]
TAGS_CASHFLOW = [
    "NetCashProvidedByUsedInOperatingActivities",
    "NetCashProvidedByUsedInInvestingActivities",
    "NetCashProvidedByUsedInFinancingActivities",
    "DepreciationDepletionAndAmortization",
    "ShareBasedCompensation",
    "PaymentsToAcquirePropertyPlantAndEquipment",
    "ProceedsFromSaleOfPropertyPlantAndEquipment",
    "PaymentsToAcquireBusinessesNetOfCashAcquired",
    "PaymentsOfDividends", "PaymentsOfDividendsCommonStock",
    "ProceedsFromIssuanceOfDebt", "ProceedsFromIssuanceOfLongTermDebt",
    "RepaymentsOfDebt", "RepaymentsOfLongTermDebt",
    "ProceedsFromIssuanceOfCommonStock", "ProceedsFromStockOptionsExercised",
    "PaymentsForRepurchaseOfCommonStock",
    "IncreaseDecreaseInAccountsReceivable",
    "IncreaseDecreaseInInventories", "IncreaseDecreaseInAccountsPayable",
    "DeferredIncomeTaxExpenseBenefit",
]
TAGS_SHARES = [
    "CommonStockSharesOutstanding", "CommonStockSharesIssued",
    "WeightedAverageNumberOfSharesOutstandingBasic",
    "WeightedAverageNumberOfDilutedSharesOutstanding",
]
# point-in-time (stock) tags: a duration other than 0 is not expected
TAGS_STOCK_EXTRA = ["CommonStockSharesOutstanding", "CommonStockSharesIssued"]
# flow tags whose duration must be 1..4 quarters
TAGS_FLOW_EXTRA = ["WeightedAverageNumberOfSharesOutstandingBasic",
                   "WeightedAverageNumberOfDilutedSharesOutstanding"]

META_COLS = ["adsh", "cik", "name", "sic", "form", "period",
             "filed", "fy", "fp", "fye", "countryba", "stprba"]
FORMS = ["10-K", "10-Q", "10-K/A", "10-Q/A"]
FP_ORDER = {"Q1": 1, "Q2": 2, "Q3": 3, "FY": 4}

# Altman Z' (private firm) weights X1..X5, distress / grey cut-offs, bounds
ALTMAN_WEIGHTS = (0.717, 0.847, 3.107, 0.420, 0.998)
ALTMAN_MIN_PARTS = 3
ALTMAN_BOUNDS = (-10.0, 15.0)
ALTMAN_DISTRESS = 1.23
ALTMAN_GREY = 2.90
# legacy strict Z: eps in denominators, clip +-20
ALTMAN_STRICT_BOUNDS = (-20.0, 20.0)
LEGACY_EPS = 1e-9
# percent-change clip for *_qoq deltas
DELTA_BOUND = 5.0
# risk bands [a, b) and labels
RISK_EDGES = (0.0, 0.20, 0.45, 0.65, 0.85, 1.01)
RISK_LABELS = ("bajo", "moderado_bajo", "moderado_alto", "alto", "critico")
# target rules: next score >= .5 distress; class 0 < .35 <= 1 < .65 <= 2
TARGET_DISTRESS_CUT = 0.5
TARGET_CLASS_CUTS = (0.35, 0.65)
# legacy per-period annualisation factor
LEGACY_PERIOD_FACTOR = {"Q1": 4.0, "Q2": 2.0, "Q3": 4.0 / 3.0, "FY": 1.0, "Q4": 1.0}
# preparation defaults
MIN_ASSETS = 100_000.0
MIN_PERIODS = 2
YEAR_RANGE = (2013, 2025)
WINSOR_PCTS = (1.0, 99.0)
COVERAGE_MIN_PCT = 5.0
# imputation plan by coverage % (>=90, >=60, >=30, else prune) x structural missing
IMPUTE_COVERAGE_CUTS = (90.0, 60.0, 30.0)
STRUCTURAL_STD_LIMIT = 15.0
# USD magnitudes forced to sector median + flag
USD_OVERRIDE_COLS = ["fe_anual_net_income", "fe_anual_cash_investing",
                     "fe_anual_cash_financing", "fe_anual_cash_operating"]
# audit rule by % null: <5 none, <30 simple, <70 with flag, else structural
AUDIT_NULL_CUTS = (5.0, 30.0, 70.0)
FFILL_LIMIT = 2
PRUNE_COVERAGE_MIN = 30.0
PRUNE_CORR_MAX = 0.95
LEAKAGE_MAX_R = 0.85
MIN_FEATURES = 50
MAX_ROWS_LOST_PCT = 5.0
TRAIN_LAST_FY = 2023
# SIC 2-digit division upper bounds and labels (A..J)
SIC_DIVISIONS = (
    (9, "A"), (14, "B"), (17, "C"), (39, "D"), (49, "E"),
    (51, "F"), (59, "G"), (67, "H"), (89, "I"), (99, "J"),
)
SIC_DIVISION_LABELS = ("A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "UNKNOWN")
# fixed clip bounds with audit flags
CLIP_BOUNDS = {
    "fe_ratio_cashflow_deuda": (-25.0, 25.0),
    "fe_shares_book_value": (-50.0, 200.0),
    "fe_shares_assets_per_share": (0.0, 1000.0),
    "fe_delta_liquidez_qoq": (-20.0, 20.0),
    "fe_delta_apalancamiento_qoq": (-10.0, 10.0),
}
# column families by prefix, in checking order; meta columns; everything else raw XBRL
FAMILY_PREFIXES = ["fe_ctx_", "fe_anual_", "fe_ratio_", "fe_zscore_", "fe_flag_", "fe_shares_", "fe_delta_"]
# keep/drop and leakage classes
DROP_REDUNDANT = ["fe_ctx_revenue_consolidado", "fe_ctx_periodo", "fe_anual_factor"]
FEATURES_A_FORBIDDEN = [
    "fe_zscore_x1_wc_assets", "fe_zscore_x2_re_assets", "fe_zscore_x3_ebit_assets",
    "fe_zscore_x4_equity_liab", "fe_zscore_x5_rev_assets", "fe_zscore_altman",
    "fe_zscore_risk_score", "fe_flag_altman_distress", "fe_flag_altman_grey",
]
FEATURES_B_AUTOREGRESSIVE = ["fe_delta_zscore_qoq", "fe_delta_risk_score_qoq",
                             "fe_delta_risk_score_prev", "fe_delta_risk_deterioro"]
# ---------------------------------------------------------------------------

TAGS_USD = list(dict.fromkeys(TAGS_BALANCE + TAGS_INCOME + TAGS_CASHFLOW))
ALL_TAGS = TAGS_USD + TAGS_SHARES
TAGS_STOCK = TAGS_BALANCE + TAGS_STOCK_EXTRA
TAGS_FLOW = [t for t in dict.fromkeys(TAGS_INCOME + TAGS_CASHFLOW)] + TAGS_FLOW_EXTRA

RATIO_COLS = [
    "fe_ratio_roa", "fe_ratio_roe", "fe_ratio_margen_bruto", "fe_ratio_margen_operativo",
    "fe_ratio_margen_neto", "fe_ratio_ebitda_assets", "fe_ratio_liquidez", "fe_ratio_quick",
    "fe_ratio_cash", "fe_ratio_cash_current", "fe_ratio_apalancamiento",
    "fe_ratio_deuda_equity", "fe_ratio_deuda_assets", "fe_ratio_deuda_cp_total",
    "fe_ratio_cobertura_intereses", "fe_ratio_rotacion_activos", "fe_ratio_sga_revenue",
    "fe_ratio_rnd_revenue", "fe_ratio_capex_revenue", "fe_ratio_tangibilidad",
    "fe_ratio_goodwill_assets", "fe_ratio_intangibles_assets", "fe_ratio_capital_trabajo",
    "fe_ratio_fcf_assets", "fe_ratio_calidad_ingresos", "fe_ratio_cashflow_deuda",
    "fe_ratio_cfo_revenue",
]
SHARES_COLS = ["fe_shares_book_value", "fe_shares_dilution", "fe_shares_assets_per_share"]
WINSOR_COLS = RATIO_COLS + SHARES_COLS
CONTEXT_COLS = ["fe_ctx_revenue_consolidado", "fe_ctx_fp_orden", "fe_ctx_periodo",
                "fe_ctx_filing_lag", "fe_ctx_amendment", "fe_ctx_sic_sector"]

# raw DERA schemas: everything as text at the edge, typed by try_cast afterwards
SUB_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in META_COLS])
NUM_COLS = ["adsh", "tag", "version", "ddate", "qtrs", "uom", "value", "segments", "coreg"]
NUM_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in NUM_COLS])
TAG_COLS = ["tag", "version", "custom", "abstract", "datatype", "tlabel", "doc"]
PRE_COLS = ["adsh", "report", "line", "stmt", "tag", "plabel"]
RAW_SCHEMAS = {
    "sub": SUB_SCHEMA,
    "num": NUM_SCHEMA,
    "tag": T.StructType([T.StructField(c, T.StringType()) for c in TAG_COLS]),
    "pre": T.StructType([T.StructField(c, T.StringType()) for c in PRE_COLS]),
}


def family_of(col: str) -> str:
    """Column family by name: fe_* prefix family, 'meta', or 'xbrl_raw'."""
    for p in FAMILY_PREFIXES:
        if col.startswith(p):
            return p[:-1]
    if col in META_COLS:
        return "meta"
    return "xbrl_raw"
