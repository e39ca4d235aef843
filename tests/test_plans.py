"""Plan-shape guards: the scale properties the design relies on."""

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_consolidation_filters_before_the_exchange(spark):
    """A header within the broadcast bound meets the facts where they are read: what is exchanged
    has passed the form and the current-period filters and is combined."""
    text = _plan(se.queries()["consolidate"](spark, SF)).split("\n\n")[0]
    assert "BroadcastHashJoin" in text and text.count("Scan parquet") == 2
    assert text.rindex(" Exchange") < text.index("BroadcastHashJoin")  # operators are printed from the top


def test_consolidation_deals_facts_and_header_once(spark):
    """Beyond that bound facts and header are dealt by filing; nothing is dealt again."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = _plan(se.queries()["consolidate"](spark, SF)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange") == 2 and text.count("Scan parquet") == 2
    assert "Join" in text and text.index("Aggregate") < text.index("Join")


def test_dedups_are_aggregates_not_windows(spark):
    text = _plan(se.queries()["dedup_latest"](spark, SF))
    assert "SortAggregate" in text  # the winning row is a struct: its buffer is sorted, not hashed
    assert "Window" not in text.split("\n\n")[0]


def test_scan_prunes_columns(spark):
    text = _plan(se.queries()["dedup_latest"](spark, SF))
    schema = [ln for ln in text.splitlines() if ln.startswith("ReadSchema")][0]
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema


def test_panel_windows_after_unique_key(spark):
    text = _plan(se.queries()["panel_risk"](spark, SF)).split("\n\n")[0]
    # the lag/lead windows partition by the entity only after the (cik, fy, fp) aggregate
    assert text.index("Window") < text.index("HashAggregate")
