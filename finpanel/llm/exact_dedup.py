"""Exact dedup as a stateful stream with disk-backed keyed state.

Every row becomes (digest, id, content locator); a Structured Streaming aggregation with
the RocksDB state store keeps, per digest and without expiry, the number of rows and the
first one: smallest id, then smallest locator. The state is read back from the checkpoint
in the shared folder, so it survives lost executors and can be carried on by a later run.
Hits (digests held by several rows) are settled on their full bytes: rows of one digest
with different texts are different groups.

Defined cases: a null text counts as empty; a null id orders after all ids; rows that
repeat id and text form one group of which one row stays; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import GAP, fresh, land, run_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """Null as empty; every run of whitespace as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stream_state(rows: DataFrame, path: str, checkpoint: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over the landed ``rows`` at ``path``; return its state (digest, n, first)."""
    spark = rows.sparkSession
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else some MB for each of many stores
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    source = own.readStream.schema(rows.schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    kept = source.parquet(path).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("no_id", "id", "locator")).alias("first"))
    query = (kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    state = own.read.format("statestore").load(checkpoint)
    return state.select("key.digest", F.col("value.count").alias("n"), F.col("value.min").alias("first"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    ``digest`` maps normalised text to bytes. It only has to be deterministic: equal
    digests of different texts are told apart by the texts.
    """
    spark = docs.sparkSession
    base = run_dir(spark, "exact-dedup")
    text = normalised(F.col(text_col))
    path = f"{base}/rows"
    rows = land(docs.select(F.col(id_col).alias("id"), F.col(id_col).isNull().alias("no_id"),
                            digest(text).alias("digest"),
                            F.struct(F.input_file_name().alias("file"),
                                     F.monotonically_increasing_id().alias("row")).alias("locator")), path)
    state = stream_state(rows, path, f"{base}/state", files_per_batch)
    state.write.parquet(f"{base}/groups")
    groups = spark.read.parquet(f"{base}/groups")

    # Hits: the texts behind every digest of several rows, compared whole. Equal texts of a
    # map task are combined before the shuffle, so a large group stays one row per task.
    hit_ids = (rows.join(groups.where("n > 1").select("digest"), "digest", "left_semi")
               .select(F.col("id").alias("_hit")).distinct())
    hits = (docs.select(F.col(id_col).alias("id"), F.col(id_col).isNull().alias("no_id"), F.col(text_col).alias("_text"))
            .join(hit_ids.hint("merge"), F.col("id").eqNullSafe(F.col("_hit")), "left_semi")  # ids grow with the corpus
            .select("id", "no_id", normalised(F.col("_text")).alias("_text"))
            .withColumn("digest", digest(F.col("_text"))))
    variants = hits.groupBy("digest", "_text").agg(F.count(F.lit(1)).alias("m"))
    clash = land(variants.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
                 .select("digest"), f"{base}/clash")

    same = (rows.join(groups, "digest")
            .select("id", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("locator") == F.col("first.locator")).alias("kept"), "digest"))
    if clash.isEmpty():
        return same
    # Equal digest, different bytes: these groups are formed again, by text.
    whole = hits.join(clash, "digest", "left_semi").withColumn("locator", F.monotonically_increasing_id())
    whole = land(whole, f"{base}/whole")
    by_text = whole.groupBy("digest", "_text").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("no_id", "id", "locator")).alias("first"))
    split = (whole.join(by_text, ["digest", "_text"])
             .select("id", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
                     (F.col("locator") == F.col("first.locator")).alias("kept"), "digest"))
    return same.join(clash, "digest", "left_anti").select(split.columns).unionByName(split)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    base = run_dir(docs.sparkSession, "drop-copies")
    out = land(exact_dedup(docs, id_col, text_col).select("id", "digest", "kept"), f"{base}/out")
    keep, sha = out.where("kept"), fresh(docs, "sha")
    marked = docs.withColumn(sha, sha256(normalised(F.col(text_col))))

    def same(keys):
        return marked[id_col].eqNullSafe(keys["id"]) & (marked[sha] == keys["digest"])

    # Rows that repeat id and text are one document: where there are any, one of them stays.
    again = land(out.groupBy("id", "digest").count().where("count > 1").select("id", "digest"), f"{base}/again")
    if again.isEmpty():
        return marked.join(keep, same(keep), "left_semi").drop(sha)
    once = marked.join(again, same(again), "left_semi").dropDuplicates([id_col, sha])
    once = once.join(keep, once[id_col].eqNullSafe(keep["id"]) & (once[sha] == keep["digest"]), "left_semi")
    other = marked.join(again, same(again), "left_anti")
    other = other.join(keep, other[id_col].eqNullSafe(keep["id"]) & (other[sha] == keep["digest"]), "left_semi")
    return other.unionByName(once).drop(sha)
