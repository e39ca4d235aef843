"""Text readers: over-long lines dropped, short lines kept, optional columns."""

from finpanel.sources import files as fs


def test_read_tsv_and_read_sub(spark, tmp_path):
    p = tmp_path / "sub.txt"
    p.write_text("adsh\tcik\tform\tperiod\tfy\tfp\n"
                 "a1\t0010\t10-K\t20241231\t2024\tFY\n"
                 "a2\t0020\t10-Q\t20240930\n"                 # short: kept with NULLs
                 "a3\t0030\t10-Q\t20240630\t2024\tQ2\textra\n"  # long: dropped
                 "a4\t0040\t8-K\t20240630\t2024\tQ2\n")
    t = fs.read_tsv(spark, str(p))
    assert sorted(r["adsh"] for r in t.collect()) == ["a1", "a2", "a4"]
    sub = fs.read_sub(spark, str(p))
    rows = {r["adsh"]: r for r in sub.collect()}
    assert set(rows) == {"a1", "a2"}
    assert rows["a1"]["cik"] == "0010" and rows["a1"]["stprba"] is None and rows["a1"]["period"] == 20241231
    assert rows["a2"]["fy"] is None


def test_quarter_range(spark):
    q = [r["quarter"] for r in fs.quarter_range(spark, "2023Q3", "2024Q2").collect()]
    assert q == ["2023Q3", "2023Q4", "2024Q1", "2024Q2"]


def test_read_tsv_by_each_files_header(spark, tmp_path):
    """Quarters with other columns, or in another order, and partition folders."""
    for q, text in {"2023Q4": "adsh\tform\tfy\nx1\t10-K\t2023\nx2\t10-K\t2023\tmore\n", "2024Q1": "adsh\tcik\tform\ny1\t7\t10-Q\n"}.items():
        (tmp_path / f"quarter={q}").mkdir()
        (tmp_path / f"quarter={q}" / "sub.txt").write_text(text)
    t = fs.read_tsv(spark, str(tmp_path))
    got = {(r["adsh"], r["form"], r["fy"], r["cik"], r["quarter"]) for r in t.collect()}
    assert got == {("x1", "10-K", "2023", None, "2023Q4"), ("y1", "10-Q", None, "7", "2024Q1")}
    assert {r["adsh"] for r in fs.read_sub(spark, str(tmp_path)).collect()} == {"x1", "y1"}


def test_manifest_shows_empty_files(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(5).coalesce(1).write.parquet(p)
    spark.range(0).coalesce(1).write.mode("append").parquet(p)
    got = sorted((r["rows"], r["status"]) for r in fs.ingest_manifest(spark.read.parquet(p), p).collect())
    assert got == [(0, "empty"), (5, "ok")]


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    """Twelve files with three headers take as many Spark jobs as three files."""
    def write(n, where):
        where.mkdir()
        for k in range(n):
            names = [["a", "b"], ["b", "a"], ["a", "c"]][k % 3]
            (where / f"f{k}.tsv").write_text("\t".join(names) + "\n" + "\t".join(f"{c}{k}" for c in names) + "\n")
        (where / "empty.tsv").write_text("")
        return str(where)

    def jobs(n, where):
        path, group = write(n, where), f"g{n}"
        spark.sparkContext.setJobGroup(group, group)
        df = fs.read_tsv(spark, path)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    few, a = jobs(3, tmp_path / "few")
    many, b = jobs(12, tmp_path / "many")
    assert a == b
    rows = {(r.a, r.b, r.c) for r in many.select("a", "b", "c").collect()}
    assert rows == {(f"a{k}", f"b{k}", None) if k % 3 < 2 else (f"a{k}", None, f"c{k}") for k in range(12)}
    assert len(few.collect()) == 3
