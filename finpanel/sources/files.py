"""Readers and writers for the quarterly filing tables (sub / num / tag / pre) and panels.

* Raw text is read as strings and typed afterwards with ``try_cast`` (N2), so a bad
  value becomes NULL instead of failing the job or dropping the row.
* Over-long lines are dropped, short lines kept (N19): the schema comes from the
  header, plus a ``_corrupt_record`` column whose field count decides.
* Quarters are a partition column, so a quarter range is a partition filter.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finpanel import schema as S
from finpanel.functions.scalar import coerce_numeric, qtrs_default

CORRUPT = "_corrupt_record"


def quarter_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive list of quarters 'YYYYQn' between two quarter labels."""
    def first_day(q: str) -> str:
        y, n = q.upper().split("Q")
        return f"{int(y):04d}-{(int(n) - 1) * 3 + 1:02d}-01"
    d = spark.range(1).select(F.explode(F.sequence(
        F.to_date(F.lit(first_day(start))), F.to_date(F.lit(first_day(end))),
        F.expr("interval 3 months"))).alias("d"))
    return d.select(quarter_label(F.col("d")).alias("quarter"))


def quarter_label(d) -> "F.Column":
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def quarter_range_of(df: DataFrame, date_col: str) -> DataFrame:
    """Quarters spanned by a date column (min..max), derived on the cluster."""
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return b.select(F.explode(F.sequence(F.trunc(F.to_date("lo"), "quarter"),
                                         F.trunc(F.to_date("hi"), "quarter"),
                                         F.expr("interval 3 months"))).alias("d")
                    ).select(quarter_label(F.col("d")).alias("quarter"))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes) of all files below ``path``: Spark's own listing, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line): the first line of every file that has one, in one job over all files.

    Only the split at offset 0 holds a first line; a task keeps the first row of each such file."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line"))

    def first(batches):
        seen: set[str] = set()
        for b in batches:
            for f in b.column("file").unique().to_pylist():
                if f not in seen:
                    seen.add(f)
                    yield b.slice(b.column("file").to_pylist().index(f), 1).select(["file", "line"])
    return lines.where("at = 0").drop("at").mapInArrow(first, "file string, line string")


def files_by_header(spark: SparkSession, path: str, sep: str = "\t") -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their own header: a row per different header reaches the driver,
    with the names of its files, which the readers need there."""
    heads = first_lines(spark, path).where("length(line) > 0").groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(heads.collect(), key=lambda r: r["files"]):
        names = tuple(c.strip().strip('"') for c in r["line"].lstrip("\ufeff").split(sep))
        out.setdefault(names, []).extend(r["files"])
    return out


def read_tsv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             sep: str = "\t") -> DataFrame:
    """Tab-separated text with header, every column as string; lines with more fields
    than their file's header are dropped, shorter lines are kept with NULLs.

    Files are read by their own header and united by name, so quarters whose columns
    differ or stand in another order do not shift values; a column that a file lacks is
    NULL there. ``columns`` instead names the columns of all files by position."""
    groups = {tuple(columns): [path]} if columns else files_by_header(spark, path, sep)
    out = None
    for cols, files in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols] +
                              [T.StructField(CORRUPT, T.StringType())])
        reader = (spark.read.schema(schema).option("header", True).option("sep", sep)
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                  .option("nullValue", "").option("encoding", "UTF-8"))
        if columns is None and files != [path] and not any(c in path for c in "*?[{") and os.path.basename(files[0]) != os.path.basename(path):
            reader = reader.option("basePath", path)  # a folder: its partition folders stay columns
        df = reader.csv(files)
        n_fields = F.size(F.split(F.col(CORRUPT), sep))
        df = df.where(F.col(CORRUPT).isNull() | (n_fields <= len(cols))).drop(CORRUPT)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no file with a header below {path}")
    return out


def select_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` that exist in ``df``; missing ones as typed NULLs."""
    return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_sub(spark: SparkSession, path: str, cols: Sequence[str] = S.META_COLS,
             forms: Iterable[str] | None = S.FORMS) -> DataFrame:
    """Header table: ids kept as text, only existing columns read, valid forms only."""
    raw = read_tsv(spark, path)
    sch = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    df = select_schema(raw, sch)
    if forms is not None:
        df = df.where(F.col("form").isin(list(forms)))
    return df.withColumns({"period": coerce_numeric("period", "int"),
                           "filed": coerce_numeric("filed", "int"),
                           "fy": coerce_numeric("fy", "int")})


def type_num(df: DataFrame) -> DataFrame:
    """Facts typed: ddate int, qtrs int (NULL -> -1), value double; segments/coreg kept."""
    df = select_schema(df, S.NUM_SCHEMA) if set(S.NUM_COLS) - set(df.columns) else df
    return df.withColumns({"ddate": coerce_numeric("ddate", "int"),
                           "qtrs": qtrs_default("qtrs", -1),
                           "value": coerce_numeric("value", "double")})


def read_num(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fact table, converted per quarter (partition column ``quarter``)."""
    df = spark.read.format(fmt).load(path) if fmt != "tsv" else read_tsv(spark, path)
    return type_num(df)


def read_tag_pre(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Tag dictionary or presentation table (ingested; no later step consumes them)."""
    return select_schema(read_tsv(spark, path), S.RAW_SCHEMAS[table])


def quarter_scan(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Partitioned table restricted to quarters in [start, end] (partition pruning;
    quarters with no folder are simply absent)."""
    df = spark.read.format(fmt).load(path)
    if start:
        df = df.where(F.col("quarter") >= start)
    if end:
        df = df.where(F.col("quarter") <= end)
    return df


def read_panel(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("fy",),
                mode: str = "overwrite") -> str:
    """Write a panel partitioned by fiscal year (parquet by default, CSV as option)."""
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("duplicate column names")
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_converted(df: DataFrame, path: str, quarter_col: str = "quarter") -> str:
    """Per-quarter conversion of raw text to parquet, partitioned by quarter."""
    df.write.mode("overwrite").partitionBy(quarter_col).parquet(path)
    return path


def write_tsv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    w = df.write.mode("overwrite").option("header", True).option("sep", "\t")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def ingest_manifest(df: DataFrame, path: str, group: str | None = None) -> DataFrame:
    """Rows and bytes per file of the table below ``path`` (and per partition value), status ok/empty.

    The files come from the folder's listing (a table, not the driver), so one without rows is a
    line, too; files that Spark takes for hidden are none of the table."""
    d = df.select(*([group] if group else []), F.col("_metadata.file_path").alias("file"),
                  F.col("_metadata.file_size").alias("file_size"))
    counts = (d.groupBy("file", *([group] if group else []))
               .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes")))
    listed = listing(df.sparkSession, path).select("file")
    # Listing and scan may spell a local path differently (file:/ and file:///).
    same = F.regexp_replace("file", "^file:/+", "file:/")
    out = listed.withColumn("_at", same).drop("file").join(counts.withColumn("_at", same), "_at", "left")
    if group:  # of a file without rows, the value is read off its folder
        found = F.nullif(F.regexp_extract("_at", f"{group}=([^/]*)/", 1), F.lit(""))
        out = out.withColumn(group, F.coalesce(group, found.cast(df.schema[group].dataType)))
    return (out.withColumns({"file": F.coalesce("file", "_at"), "rows": F.coalesce("rows", F.lit(0).cast("long"))}).drop("_at")
               .withColumn("mb", F.col("bytes") / (1024.0 * 1024.0))
               .withColumn("columns", F.lit(len(df.columns)))
               .withColumn("status", F.when(F.col("rows") > 0, "ok").otherwise("empty")))


def metric_rows(spark: SparkSession, rows: Iterable[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame([(a, b, float(c) if c is not None else None) for a, b, c in rows],
                                 "section string, name string, value double")


def write_metrics(frames: Sequence[DataFrame], path: str) -> str:
    """Union of (section, name, value) metric frames written as one table."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    out.write.mode("overwrite").parquet(path)
    return path


def stage_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, below the shared checkpoint folder."""
    from finpanel.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), "stages", f"{name}-{uuid.uuid4().hex}")
