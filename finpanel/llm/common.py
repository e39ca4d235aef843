"""Helpers shared by the operators: landed tables, row keys, token arrays."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.session import ensure_checkpoint_dir

#: A null id orders after every other id.
LAST_ID = (1 << 63) - 1
#: Bytes of text that one numpy pass works on (a longer document is a pass of its own).
CHUNK_BYTES = 1 << 19
#: The whitespace of all word definitions: space and bytes 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder; no two runs share one."""
    return os.path.join(ensure_checkpoint_dir(spark), "llm", f"{label}-{uuid.uuid4().hex}")


def land(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table of this run that only landed tables were made from."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases (their results are landed).

    It drops what neither side refers to any more, on its own thread: give it a moment."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """d and r: ordering id (null last), a row key telling apart rows of one id."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)), F.xxhash64(F.col(id_col).isNull(), F.col(text_col))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, r, text): the row key and the text."""
    d, r = row_key(id_col, text_col)
    return docs.select(d.alias("d"), r.alias("r"), F.col(text_col).alias("text"))


def same_row(docs: DataFrame, id_col: str, text_col: str, keys: DataFrame) -> Column:
    """Join condition of ``docs`` with the (d, r) of ``keyed`` in ``keys``, whatever else ``docs`` holds."""
    return ((F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)) == keys["d"])
            & (F.xxhash64(docs[id_col].isNull(), docs[text_col]) == keys["r"]))


#: Words of a row filter: what bounds its broadcast, whatever the number of rows.
FILTER_WORDS = 1 << 18


def likely(rows: DataFrame, need: DataFrame) -> DataFrame:
    """The ``rows`` (d, r, ...) that may be in ``need`` (d, r): all that are and, by a filter of three
    bits a row in one of FILTER_WORDS words, few others. The exact join that follows then deals out
    little else than the texts it keeps."""
    h = F.xxhash64("d", "r")
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, 18 + 6 * k).bitwiseAND(F.lit(63))).cast("int")) for k in range(3)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])
    word = F.pmod(h, F.lit(FILTER_WORDS)).alias("filter_word")
    held = need.select(word, mask.alias("m")).groupBy("filter_word").agg(F.bit_or("m").alias("filter_bits"))
    met = F.broadcast(held.withColumnRenamed("filter_word", "filter_at"))
    return (rows.join(met, word == F.col("filter_at")).where(F.col("filter_bits").bitwiseAND(mask) == mask)
            .drop("filter_at", "filter_bits"))


def needed(rows: DataFrame, need: DataFrame) -> DataFrame:
    """The ``rows`` (d, r, ...) that are in ``need`` (d, r; every one once), dealt out after the filter of
    ``likely``. An inner join, as Spark moves a left semi join below the filter's and then deals out all rows."""
    return likely(rows, need).join(need, ["d", "r"])


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it until ``docs`` has no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def public_id(d: Column) -> Column:
    """The id as it came in: null where ``keyed`` put the last id."""
    return F.when(d != LAST_ID, d)


def text_chunks(batches, extra: tuple[str, ...] = ()) -> Iterator[tuple]:
    """Arrow batches with d, r, text -> (d, r, [bytes or None], *extra columns) of about CHUNK_BYTES."""
    for b in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), dtype=np.int64)
        lo = 0
        while lo < b.num_rows:
            total, hi = int(sizes[lo]), lo + 1
            while hi < b.num_rows and total + sizes[hi] <= CHUNK_BYTES:
                total += int(sizes[hi])
                hi += 1
            part = b.slice(lo, hi - lo)
            yield (np.asarray(part.column("d")), np.asarray(part.column("r")),
                   part.column("text").cast(pa.binary()).to_pylist(),
                   *(part.column(c) for c in extra))
            lo = hi


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (published splitmix64 constants), array-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(m: int) -> int:
    return pow(m, -1, 1 << 64)


#: Odd multipliers of the two polynomial fingerprints.
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    """base ** 0 .. base ** (2**bits - 1), modulo 2**64."""
    out = np.ones(1 << bits, np.uint64)
    step, have = base, 1
    while have < len(out):
        out[have:2 * have] = out[:have] * np.uint64(step)
        step, have = step * step % (1 << 64), 2 * have
    return out


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, max(10, int(n - 1).bit_length() if n > 1 else 1))[:n]


class Fingerprints:
    """Prefix sums of a polynomial over 64-bit token values: the hash of any [i, j) in O(1)."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(BASES[which], n), out=self.prefix[1:])
        self.back = powers(_inverse(BASES[which]), n + 1)

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return mix64((self.prefix[j] - self.prefix[i]) * self.back[i])


@lru_cache(maxsize=4)
def byte_values(fold: bool = False) -> np.ndarray:
    """A 64-bit value for each byte; with ``fold`` A-Z share the values of a-z."""
    out = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    if fold:
        out[65:91] = out[97:123]
    return out


class Tokens:
    """Tokens of a chunk: ``value`` (64 bit), ``doc`` (row in the chunk), ``at`` (doc -> first token)."""

    def __init__(self, value: np.ndarray, at: np.ndarray, begin=None, end=None, data=None):
        self.value, self.at = value, at
        self.begin, self.end, self.data = begin, end, data
        self.count = np.diff(at)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def byte_tokens(texts: list) -> Tokens:
    """Every byte of every text is a token; null is empty."""
    parts = [t or b"" for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=at[1:])
    return Tokens(byte_values()[data], at, data=data)


def word_tokens(texts: list, fold: bool = False, gaps: np.ndarray = SPACE) -> Tokens:
    """Every run of bytes not in ``gaps`` is a token; null has none; ``fold`` lower-cases A-Z."""
    parts = [t or b"" for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    start = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=start[1:])
    inside = ~gaps[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside)).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    value = Fingerprints(byte_values(fold)[data]).of(begin, end)
    return Tokens(value, np.searchsorted(begin, start), begin, end, data)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every i with a whole window."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(out) - (width - have)], out[width - have:])
    return out


def docs_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
