"""With ``folder``, a batch reads the history of its own folders only, and a filing in two files is one row."""

from pyspark.sql import functions as F

from finpanel.streaming import ingest as st


def test_history_of_own_folders(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "facts"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    plans = []

    def transform(b):
        plans.append(b._jdf.queryExecution().executedPlan().toString())
        return b.groupBy("adsh").agg(F.sum("value").alias("v"))

    steps = [[("a", "2024Q1", 1.0), ("b", "2024Q2", 2.0), ("n", None, 5.0)], [("a", "2024Q1", 10.0)], [("n", None, 50.0)]]
    for rows in steps:
        spark.createDataFrame(rows, "adsh string, quarter string, value double").coalesce(1).write.mode("append").partitionBy("quarter").parquet(src)
        st.ingest_quarters(spark, src, transform, out, ckpt, files_per_trigger=9, key="adsh", folder="quarter")
    assert sorted(tuple(r) for r in st.read_ingested(spark, out, "adsh").collect()) == [("a", 11.0), ("b", 2.0), ("n", 55.0)]
    pruned = [p for p in plans if "PartitionFilters: [" in p and "quarter" in p.split("PartitionFilters: [", 1)[1][:80]]
    assert len(pruned) == len(plans) == 3
