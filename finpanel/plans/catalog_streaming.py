"""Structured Streaming: quarterly facts arriving as files, consolidated per micro-batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from finpanel.plans.catalog_features import RAW_COLS
from finpanel.plans.consolidate import consolidate
from finpanel.plans.driver_panel import DRIVER_FORMS, DRIVER_META, RAW_SQL_CTES
from finpanel.plans.registry import register, rounded
from finpanel.sources import driver as dv
from finpanel.streaming import ingest as st


@register("stream_consolidate", "WITH " + RAW_SQL_CTES + "\nSELECT " + ", ".join(
    f"ROUND({c}, 6) AS {c}" if c in dv.DRIVER_TAGS or c == "price" else c for c in RAW_COLS) + " FROM RAW")
def q_stream_consolidate(spark, d):
    header = dv.header(spark, d)
    # facts tagged with their filing's quarter; a quarter has several files, a file one quarter and a range
    # of its filings: their number grows with the facts, not with tasks times quarters
    facts = dv.facts(spark, d).join(st.with_quarter(header.select("adsh", "period"), "period")
                                    .select("adsh", "quarter"), "adsh")
    out, ckpt = st.stream_paths(spark, "consolidate")
    src = out.rsplit("/", 1)[0] + "/facts"
    facts.repartitionByRange("quarter", "adsh").write.partitionBy("quarter").parquet(src)

    def transform(batch):
        return consolidate(batch, header, tags=dv.DRIVER_TAGS,
                           unit_rules={"USD": dv.USD_TAGS, "shares": dv.SHARE_TAGS}, forms=DRIVER_FORMS,
                           meta_cols=DRIVER_META, current=("dyear", "fy"), join_cols=("fy",),
                           tie=("version", "supp", "value"))

    st.ingest_quarters(spark, src, transform, out, ckpt, files_per_trigger=200, key="adsh", folder="quarter")
    return rounded(st.read_ingested(spark, out, "adsh").select(*RAW_COLS).withColumn("fy", F.col("fy").cast("int")))
