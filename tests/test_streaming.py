"""Streaming ingest: every quarter folder processed once; a restart with the same
checkpoint adds nothing; new quarters are picked up incrementally."""

from pyspark.sql import functions as F

from finpanel.streaming import ingest as st


def test_restart_and_incremental(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "facts"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    rows = [(f"a{i}", "2024Q1" if i < 6 else "2024Q2", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "adsh string, quarter string, value double")
    df.where(F.col("quarter") == "2024Q1").repartition(1).write.partitionBy("quarter").parquet(src)

    def transform(b):
        return b.groupBy("quarter").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))

    st.ingest_quarters(spark, src, transform, out, ckpt)
    first = sorted(tuple(r) for r in st.read_ingested(spark, out).collect())
    assert first == [("2024Q1", 6, 15.0)]
    st.ingest_quarters(spark, src, transform, out, ckpt)          # restart: nothing new
    assert sorted(tuple(r) for r in st.read_ingested(spark, out).collect()) == first
    df.where(F.col("quarter") == "2024Q2").repartition(1).write.mode("append").partitionBy("quarter").parquet(src)
    st.ingest_quarters(spark, src, transform, out, ckpt)          # the new quarter only
    got = sorted(tuple(r) for r in st.read_ingested(spark, out).collect())
    assert got == [("2024Q1", 6, 15.0), ("2024Q2", 4, 30.0)]


def test_filing_in_two_files_gives_one_row(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "facts"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "adsh string, value double")
    more = spark.createDataFrame([("a", 10.0)], "adsh string, value double")

    def transform(b):
        return b.groupBy("adsh").agg(F.sum("value").alias("v"))

    for part in (df, more):
        part.coalesce(1).write.mode("append").parquet(src)
        st.ingest_quarters(spark, src, transform, out, ckpt, key="adsh")
    assert sorted(tuple(r) for r in st.read_ingested(spark, out, "adsh").collect()) == [("a", 11.0), ("b", 2.0)]
