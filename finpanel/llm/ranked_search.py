"""Ranked lexical search turned round: the items are indexed, the documents stream past them.

An inverted index over the items' terms (term -> items and counts) is broadcast. Documents
are read once: each is cut into terms, its counts of indexed terms are landed with its length,
and from these come the statistics (documents with a term, all terms, documents per term).
A second pass streams the landed counts through the weighted index into one bounded heap per
item and task; heaps are merged in two steps, so that no merge reads more than about the
square root of all heaps of an item.

The broadcast has a bound: items are dealt in order into shards of at most ``SHARD_POSTINGS``
distinct (item, term) pairs and one more item, and every shard has its own pass over the
documents. Terms are compared by 128-bit fingerprints. A long text is worked on in segments
cut between terms.

Terms are maximal runs of digits, Latin letters and everything beyond ASCII; only A-Z are
lower-cased. A term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms has
m = 75 + 25 n N div L and scores w * (10^9 tf div (1000 tf + 12 m)) for each of the item's terms,
repeats included. The best documents with a score above 0 are ranked, equal scores by
ascending id.

Null or term-free texts are no documents of the statistics and match nothing; an item without
terms has no results; a null document id is ranked behind equal scores and stays null. Rows
that repeat an id, and rows alike in all, are documents (or items) of their own. Empty tables
give no rows. Other columns are never read. Ids are longs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finpanel.llm.common import BASES, Fingerprints, byte_values, land, run_dir, word_tokens
from finpanel.ml.ranks import value_prefix

#: Distinct (item, term) pairs of one broadcast index: about 30 bytes each.
SHARD_POSTINGS = 1 << 18
#: Longest piece of a text that is cut into terms at once.
SEGMENT = 1 << 20
#: Cells of the documents x items block that is scored at once.
CELLS = 1 << 21

GAPS = np.ones(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    GAPS[_a:_b] = False


def segments(text: bytes) -> Iterator[bytes]:
    """``text`` in pieces of about SEGMENT bytes, cut only between terms."""
    lo = 0
    while len(text) - lo > SEGMENT:
        hi = lo + SEGMENT
        while hi < len(text):  # the next byte that is no part of a term
            gap = np.flatnonzero(GAPS[np.frombuffer(text, np.uint8, min(4096, len(text) - hi), hi)])
            if len(gap):
                hi += int(gap[0])
                break
            hi += 4096
        hi = min(hi, len(text))
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def term_counts(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n of every text; text, first and second fingerprint, count of every distinct term of a text)."""
    n, found = np.zeros(len(texts), np.int64), []
    pieces = [(k, s) for k, t in enumerate(texts) for s in segments(t or b"")]
    lo = 0
    while lo < len(pieces):
        hi, size = lo, 0
        while hi < len(pieces) and (hi == lo or size + len(pieces[hi][1]) <= SEGMENT):
            size, hi = size + len(pieces[hi][1]), hi + 1
        of = np.asarray([k for k, _ in pieces[lo:hi]], np.int64)
        t = word_tokens([s for _, s in pieces[lo:hi]], fold=True, gaps=GAPS)
        doc = of[t.doc]
        n += np.bincount(doc, minlength=len(texts))
        if len(doc):
            second = Fingerprints(byte_values(True)[t.data], 1).of(t.begin, t.end)
            found.append((doc, t.value, second, np.ones(len(doc), np.int64)))
        lo = hi
    if not found:
        return n, *(np.zeros(0, d) for d in (np.int64, np.uint64, np.uint64, np.int64))
    doc, one, two, count = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((two, one, doc))
    doc, one, two, count = doc[order], one[order], two[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
    return n, doc[first], one[first], two[first], np.add.reduceat(count, first)


def _row_chunks(b: pa.RecordBatch) -> Iterator[tuple[pa.Array, list]]:
    """(ids, texts) of runs of rows of about two SEGMENTs (a longer text is a run of its own)."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0), dtype=np.int64))
    lo = 0
    while lo < b.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 2 * SEGMENT, "right")))
        yield b.column("id").slice(lo, hi - lo), b.column("text").slice(lo, hi - lo).cast(pa.binary()).to_pylist()
        lo = hi


def _postings(batches):
    """Items -> (item, item_id, one, two, count); the item's number is its place in the table's files."""
    task, k = TaskContext.get().partitionId(), 0
    for b in batches:
        for ids, texts in _row_chunks(b):
            _, row, one, two, count = term_counts(texts)
            yield pa.record_batch({"item": pa.array((task << 40) + k + row), "item_id": ids.take(pa.array(row)), "one": pa.array(one.view(np.int64)),
                                   "two": pa.array(two.view(np.int64)), "count": pa.array(count)})
            k += len(ids)


class Index:
    """Terms of a shard of items, sorted by fingerprint, and their postings in one array each."""

    def __init__(self, one: np.ndarray, two: np.ndarray, item: np.ndarray, count: np.ndarray):
        one, two = one.view(np.uint64), two.view(np.uint64)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        fresh = np.ones(len(one), bool)
        fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(fresh)
        self.one, self.two, self.at = one[first], two[first], np.append(first, len(one))
        self.items, place = np.unique(item, return_inverse=True)
        self.item, self.count = place[order].astype(np.int32), count[order]

    def terms(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The term's number, or -1."""
        if not len(self.one):
            return np.full(len(one), -1)
        lo = np.searchsorted(self.one, one)
        lo[lo == len(self.one)] = 0
        out = np.where((self.one[lo] == one) & (self.two[lo] == two), lo, -1)
        for k in np.flatnonzero((out < 0) & (self.one[lo] == one)):  # two terms with one first fingerprint
            same = np.flatnonzero((self.one == one[k]) & (self.two == two[k]))
            out[k] = same[0] if len(same) else -1
        return out


def _matched(index):
    """Documents -> (id, n, terms, counts): their indexed terms."""
    def run(batches):
        ix = index.value
        for b in batches:
            for ids, texts in _row_chunks(b):
                n, doc, one, two, count = term_counts(texts)
                term = ix.terms(one, two)
                hit = term >= 0
                ends = np.zeros(len(ids) + 1, np.int32)
                np.cumsum(np.bincount(doc[hit], minlength=len(ids)), out=ends[1:])
                yield pa.record_batch({"id": ids, "n": pa.array(n),
                                       "terms": pa.ListArray.from_arrays(pa.array(ends), pa.array(term[hit].astype(np.int32))),
                                       "counts": pa.ListArray.from_arrays(pa.array(ends), pa.array(count[hit]))})
    return run


class Heaps:
    """The k best documents of every item; a place that is not taken has score 0."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score, self.id, self.null = np.zeros((items, k), np.int64), np.zeros((items, k), np.int64), np.ones((items, k), bool)

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        touched = np.unique(item)
        item = np.concatenate((item, np.repeat(touched, self.k)))
        score = np.concatenate((score, self.score[touched].ravel()))
        ids, null = np.concatenate((ids, self.id[touched].ravel())), np.concatenate((null, self.null[touched].ravel()))
        order = np.lexsort((ids, null, -score, item))
        item, score, ids, null = item[order], score[order], ids[order], null[order]
        start = np.searchsorted(item, touched)
        best = (start[:, None] + np.arange(self.k)).ravel()
        self.score[touched], self.id[touched], self.null[touched] = (x[best].reshape(-1, self.k) for x in (score, ids, null))


def length_share(n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """m of documents of ``n`` terms, in whole numbers."""
    if len(n) and int(n.max()) * 25 * docs >= 1 << 63:
        return np.asarray([75 + 25 * int(x) * docs // length for x in n], np.int64)
    return 75 + 25 * n * docs // length


def _heaps(index, weights, docs: int, length: int, k: int):
    """Landed counts -> (item, score, id, task): the heaps of a task."""
    def run(batches):
        ix, w = index.value, weights.value
        heaps, size, width = Heaps(len(ix.items), k), np.diff(ix.at), max(1, len(ix.items))
        for b in batches:
            m = length_share(np.asarray(b.column("n")), docs, length)
            null = np.asarray(b.column("id").is_null())
            ids = np.asarray(b.column("id").fill_null(0))
            lists = b.column("terms")
            at = np.asarray(lists.offsets).astype(np.int64)
            term, tf = np.asarray(lists.values), np.asarray(b.column("counts").values)
            step = max(1, CELLS // width)
            for lo in range(0, b.num_rows, step):
                hi = min(lo + step, b.num_rows)
                rows = np.repeat(np.arange(hi - lo), np.diff(at[lo:hi + 1]))
                t, f = term[at[lo]:at[hi]], tf[at[lo]:at[hi]]
                gain = w[t] * ((1_000_000_000 * f) // (1000 * f + 12 * m[lo:hi][rows]))
                reach = size[t]
                post = np.arange(int(reach.sum())) + np.repeat(ix.at[t] - (np.cumsum(reach) - reach), reach)
                score = np.zeros((hi - lo) * width, np.int64)
                np.add.at(score, np.repeat(rows, reach) * width + ix.item[post], np.repeat(gain, reach) * ix.count[post])
                score = score.reshape(hi - lo, width)
                row, item = np.nonzero((score > 0) & (score >= heaps.score[:, -1]))
                if len(row):
                    heaps.add(item, score[row, item], ids[lo + row], null[lo + row])
        item, place = np.nonzero(heaps.score > 0)
        yield pa.record_batch({"item": pa.array(ix.items[item]), "score": pa.array(heaps.score[item, place]),
                               "id": pa.array(heaps.id[item, place], mask=heaps.null[item, place]),
                               "task": pa.array(np.full(len(item), TaskContext.get().partitionId(), np.int32))})
    return run


def _best(heaps: DataFrame, by: list, k: int) -> DataFrame:
    w = Window.partitionBy("item", *by).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def shards(postings: DataFrame, bound: int = SHARD_POSTINGS) -> DataFrame:
    """(item, shard): items in order, a shard holds at most ``bound`` postings and one more item."""
    sizes = value_prefix(postings, "item", {"held": F.lit(1).cast("long")}, x_name="item")
    return sizes.select("item", F.expr(f"cast(held_below div {bound} as int)").alias("shard"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
           item_text: str = "text", bound: int = SHARD_POSTINGS) -> DataFrame:
    """(item_id, rank, id, score) of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    path = run_dir(spark, "ranked")
    texts = items.select(items[item_id].cast("long").alias("id"), items[item_text].alias("text"))
    # An item's number comes from the landed postings, which no retry changes.
    postings = land(texts.mapInArrow(_postings, "item long, item_id long, one long, two long, count long"), f"{path}/postings")
    dealt = land(postings.join(shards(postings, bound), "item"), f"{path}/dealt")
    names = dealt.select("item", "item_id").distinct()
    words = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    last = dealt.agg(F.max("shard")).first()[0]
    found = None
    for s in range(-1 if last is None else last + 1):
        held = dealt.where(F.col("shard") == s).select("one", "two", "item", "count").toArrow()
        ix = Index(*(np.asarray(held.column(c).combine_chunks()) for c in ("one", "two", "item", "count")))
        index = spark.sparkContext.broadcast(ix)
        counts = land(words.mapInArrow(_matched(index), "id long, n long, terms array<int>, counts array<long>"), f"{path}/counts-{s}")
        total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
        df = np.zeros(len(ix.one), np.int64)
        for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row per term of the shard at most
            df[r["t"]] = r["count"]
        n = int(total["docs"])
        weights = spark.sparkContext.broadcast(np.asarray([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df], np.int64))
        heaps = land(counts.where("size(terms) > 0").mapInArrow(_heaps(index, weights, n, int(total["length"] or 0), k),
                                                               "item long, score long, id long, task int"), f"{path}/heaps-{s}")
        tasks = (heaps.agg(F.max("task")).first()[0] or 0) + 1
        part = F.pmod(F.col("task"), F.lit(max(1, math.isqrt(tasks)))).alias("part")
        best = _best(_best(heaps.withColumn("part", part), ["part"], k).drop("rank", "part"), [], k)
        found = best if found is None else found.unionByName(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, id long, score long")
    return found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")
