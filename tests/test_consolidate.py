"""Entry 1 on DERA-shaped fixtures (FIXTURES.md A1/A2)."""

from finpanel.plans.consolidate import clean_panel, consolidate
from finpanel.sources.files import type_num


def _sub(spark):
    rows = [("0001", "10", "Alpha", "0100", "10-K", "20241231", "20250220", "2024", "FY", "1231", "US", "NA"),
            ("0002", "10", "Alpha", "0100", "10-K/A", "20241231", "20250301", "2024", "FY", "1231", "US", "NA"),
            ("0003", "20", "Beta", "5171", "8-K", "20240930", "20241101", "2024", "Q3", "1231", "US", "TX")]
    cols = "adsh cik name sic form period filed fy fp fye countryba stprba".split()
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return df.withColumns({"period": df["period"].cast("int"), "filed": df["filed"].cast("int"),
                           "fy": df["fy"].cast("int")})


def _num(spark):
    rows = [
        ("0001", "Assets", "us-gaap/2024", "20241231", "0", "USD", "100", None, None),
        ("0001", "Assets", "us-gaap/2024", "20231231", "0", "USD", "90", None, None),     # prior period
        ("0001", "Revenues", "us-gaap/2024", "20241231", "4", "USD", "50", None, None),
        ("0001", "Revenues", "us-gaap/2024", "20241231", "1", "USD", "12", None, None),   # shorter
        ("0001", "Revenues", "us-gaap/2024", "20241231", "4", "USD", "55", "Segment", None),  # segment
        ("0001", "CommonStockSharesOutstanding", "dei/2024", "20241231", "0", "shares", "7", None, None),
        ("0001", "CommonStockSharesOutstanding", "dei/2024", "20241231", "0", "USD", "8", None, None),  # bad unit
        ("0001", "UnknownTag", "x", "20241231", "0", "USD", "1", None, None),
        ("0002", "Assets", "us-gaap/2024", "20241231", None, "USD", "abc", " ", None),
        ("0003", "Assets", "us-gaap/2024", "20240930", "0", "USD", "5", None, None),     # 8-K filing
    ]
    cols = "adsh tag version ddate qtrs uom value segments coreg".split()
    return type_num(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))


def test_consolidate_rules(spark):
    panel = consolidate(_num(spark), _sub(spark))
    rows = {r["adsh"]: r for r in panel.collect()}
    assert set(rows) == {"0001", "0002"}                       # 8-K dropped, unknown tag ignored
    a = rows["0001"]
    assert a["Assets"] == 100.0 and a["Assets_qtrs"] == 0      # only ddate = period
    assert a["Revenues"] == 50.0 and a["Revenues_qtrs"] == 4   # longest duration, segment row gone
    assert a["CommonStockSharesOutstanding"] == 7.0            # unit rule
    assert rows["0002"]["Assets"] is None and rows["0002"]["Assets_qtrs"] == -1  # 'abc' -> NULL, qtrs -> -1
    assert len(panel.columns) == 12 + 2 * 92


def test_clean_panel_keeps_latest_amendment(spark):
    panel = clean_panel(consolidate(_num(spark), _sub(spark)))
    assert [r["adsh"] for r in panel.collect()] == ["0002"]
