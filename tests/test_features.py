"""Feature formulas on hand-computed rows (SURVEY Appendix A)."""

import math

from finpanel.operators import features as fe


def _panel(spark):
    rows = [
        # cik fy fp  Assets AC  LC  TL  EQ   RE   NI  NIq  OI  OIq Rev Revq RevC RevCq Cash  LTD  DebtC
        (1, 2024, "Q2", 100.0, 40.0, 20.0, 60.0, 40.0, 10.0, 5.0, 2, 8.0, 2, None, None, 50.0, 2, 10.0, None, 5.0),
        (1, 2024, "Q3", 120.0, 30.0, 30.0, 150.0, -30.0, -5.0, -2.0, 5, 6.0, 3, 60.0, 3, None, None, 0.0, 20.0, None),
        (2, 2024, "FY", 50.0, None, None, None, None, None, None, None, None, None, 0.0, 4, None, None, None, None, None),
    ]
    cols = ("cik int, fy int, fp string, Assets double, AssetsCurrent double, LiabilitiesCurrent double, "
            "Liabilities double, StockholdersEquity double, RetainedEarningsAccumulatedDeficit double, "
            "NetIncomeLoss double, NetIncomeLoss_qtrs int, OperatingIncomeLoss double, OperatingIncomeLoss_qtrs int, "
            "Revenues double, Revenues_qtrs int, RevenueFromContractWithCustomerExcludingAssessedTax double, "
            "RevenueFromContractWithCustomerExcludingAssessedTax_qtrs int, CashAndCashEquivalentsAtCarryingValue double, "
            "LongTermDebt double, DebtCurrent double")
    df = spark.createDataFrame(rows, cols)
    return df.withColumns({"adsh": df["cik"].cast("string"), "form": df["fp"], "period": df["fy"] * 10000 + 101,
                           "filed": df["fy"] * 10000 + 301, "sic": df["cik"].cast("string")})


def test_feature_values(spark):
    out = {(r["cik"], r["fp"]): r for r in fe.build_features(_panel(spark)).collect()}
    a = out[(1, "Q2")]
    assert a["fe_ctx_revenue_consolidado"] == 50.0                   # contract revenue fills Revenues
    assert a["fe_anual_revenue"] == 100.0 and a["fe_anual_factor"] == 2.0
    assert a["fe_ratio_roa"] == 0.05 and a["fe_ratio_liquidez"] == 2.0
    assert a["fe_ratio_deuda_equity"] == 5.0 / 40.0                  # LTD NULL -> parts 0, + DebtCurrent
    x = [0.2, 0.1, 16.0 / 100.0, 40.0 / 60.0, 1.0]
    z = 0.717 * x[0] + 0.847 * x[1] + 3.107 * x[2] + 0.420 * x[3] + 0.998 * x[4]
    assert abs(a["fe_zscore_altman"] - z) < 1e-12
    assert abs(a["fe_zscore_risk_score"] - 1 / (1 + math.exp(z - 1.23))) < 1e-12
    assert a["fe_flag_altman_grey"] == 1 and a["fe_flag_altman_distress"] == 0
    assert a["fe_ctx_filing_lag"] == 60 and a["fe_ctx_fp_orden"] == 2 and a["fe_ctx_periodo"] == "2024-Q2"
    b = out[(1, "Q3")]
    assert b["fe_anual_net_income"] is None                          # qtrs 5 -> no factor
    assert b["fe_flag_patrimonio_negativo"] == 1 and b["fe_flag_insolvencia"] == 1
    assert b["fe_delta_assets_qoq"] == 0.2 and b["fe_delta_cash_qoq"] == -1.0
    assert b["fe_delta_risk_score_prev"] == a["fe_zscore_risk_score"]
    c = out[(2, "FY")]
    assert c["fe_flag_sin_revenue"] == 1 and c["fe_zscore_altman"] is None   # < 3 parts
    assert c["fe_flag_insolvencia"] is None and c["fe_ratio_deuda_assets"] == 0.0
