"""Entries 2 and 3 composed: whole input, and the order of the steps."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from finpanel.plans import training

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["training_set", "modelling_set"])
def test_no_fiscal_year_of_the_input_is_missing(spark, name, monkeypatch):
    monkeypatch.setattr(training, name, lambda panel, **_: panel)
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(F.year("o_orderdate").alias("fy"))
    got = {r["fy"] for r in se.queries()[name](spark, SF).select("fy").distinct().collect()}
    assert got == {r["fy"] for r in orders.distinct().collect()}


def test_modelling_set_fills_then_plans_then_clips(spark):
    # Five rows with a target for each of four companies; the sixth only gives the last target.
    gaps = {(1, 1): None, (1, 2): None, (1, 3): None}
    rows = []
    for c in range(1, 5):
        for t in range(6):
            revenue = gaps.get((c, t), 10.0 * c + [0, 7, 3, 9, 1, 5][t])
            book = None if (c, t) == (2, 0) else 300.0 if c > 1 else 5.0 + t * t
            quick = 1.5 + t if c in (1, 3) and t < 4 else None
            score = ((c * 7 + t * t * 3) % 11) / 11
            rows.append((f"a{c}{t}", c, "10-K", 2000 + t, "FY", 20000 + t, 4, 20, *[0.1] * 5, score, revenue, book, quick))
    panel = spark.createDataFrame(rows, "adsh string, cik int, form string, fy int, fp string, filed int, fe_ctx_fp_orden int, "
                                  "fe_ctx_sic_sector int, " + ", ".join(f"{p} double" for p in training.fe.ZPARTS)
                                  + ", fe_zscore_risk_score double, fe_anual_revenue double, fe_shares_book_value double, fe_ratio_quick double")
    with pytest.warns(UserWarning, match="features"):
        df = training.modelling_set(panel)
    got = {(r["cik"], r["fy"] - 2000): r for r in df.withColumnsRenamed({c: c.removeprefix("_REDUNDANTE_") for c in df.columns}).collect()}
    assert len(got) == 20
    # Two periods carry the company's value on, the third is left to the median of what is there then.
    assert [got[1, t]["fe_anual_revenue"] for t in range(5)] == [10.0, 10.0, 10.0, 30.0, 11.0]
    assert "fe_imputed_fe_anual_revenue" not in df.columns  # 95 % are there after the fill, 85 % before
    # Clipped after the fill: the median, 300, is cut with its flag.
    assert (got[2, 0]["fe_shares_book_value"], got[2, 0]["fe_clipped_fe_shares_book_value"]) == (200.0, 1)
    assert (got[2, 0]["fe_ratio_quick"], got[2, 0]["fe_isnull_fe_ratio_quick"]) == (0.0, 1)
    assert {c: v for c, v, ok in training.modelling_checks(df, ["fe_anual_revenue"], 40).collect() if not ok} == {"features": 1.0, "rows_lost_pct": 50.0}
