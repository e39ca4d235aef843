"""Which 64-bit keys do several texts share? Counting and looking up, in sorted blocks.

Keys (window anchors, signatures, word hashes) outnumber documents by hundreds, so they
travel as blocks: a map task sorts the keys of its documents, counts equal ones and cuts
the run into ranges ("buckets"); a row is one bucket's slice. ``count_keys`` merges the
slices of a bucket: a key that a third of all documents hold arrives once per map task,
with the row key (a hash of the text) of one owner, which tells apart a key of several
texts from one of several equal texts.
``look_up`` deals request slices and tables by bucket, the table first, and streams the
slices past it: a table is moved once, however many slices ask, and no bucket is gathered.
``shared_lists`` does both over one cut of the texts and one exchange of their keys.

A key function takes a list of texts (bytes or None) and returns (row in the list, key).
It must depend on the text alone.
"""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import land, mix64, release, text_chunks

Keys = Callable[[list], tuple[np.ndarray, np.ndarray]]

#: Keys per bucket, about: a bucket's table is worked on by one task, at some 40 bytes a key.
BUCKET_KEYS = 1_200_000
#: Keys that a map task gathers before it sorts and sends them. A slice names each of its documents
#: once: the fewer the buckets, the more keys share that, whatever a task gathers.
FLUSH_KEYS = 400_000
#: Keys per bucket where a smaller table is worth more slices.
OWNED_KEYS = 400_000
#: Rows of an answer that are sent back at once, about.
ANSWERED = 1 << 16
#: Keys of a bucket that wait before they are added to those counted so far.
FOLD_KEYS = 400_000


def bucket_count(n_keys: float, each: int = BUCKET_KEYS) -> int:
    return max(12, int(n_keys / each) + 1)


def slices(keys: np.ndarray, buckets: int):
    """(bucket, from, to) of each bucket's part of the sorted ``keys``."""
    of = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cut = np.flatnonzero(np.diff(of)) + 1
    for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(keys)]))):
        if hi > lo:
            yield int(of[lo]), lo, hi


def pairs(row: np.ndarray, key: np.ndarray):
    """Sort by key, then row; distinct (row, key) with how often each occurs."""
    order = np.argsort(key, kind="stable")  # rows come in ascending order
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(key)))


def gathered(batches, keys: Keys, only=None):
    """(d, r, row, key) of about FLUSH_KEYS keys at a time."""
    ds, rs, rows, ks, n, docs = [], [], [], [], 0, 0
    for d, r, texts in text_chunks(batches):
        if only is not None:
            keep = only(d)
            d, r, texts = d[keep], r[keep], [t for t, k in zip(texts, keep) if k]
        row, key = keys(texts)
        ds.append(d), rs.append(r), rows.append(row + docs), ks.append(key)
        n, docs = n + len(key), docs + len(d)
        if n >= FLUSH_KEYS:
            yield tuple(map(np.concatenate, (ds, rs, rows, ks)))
            ds, rs, rows, ks, n, docs = [], [], [], [], 0, 0
    if n:
        yield tuple(map(np.concatenate, (ds, rs, rows, ks)))


def pack(x: np.ndarray) -> bytes:
    """Byte planes: of sorted keys, or small numbers, the upper planes are runs, and the
    shuffle's compression drops them."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


#: A slice: sorted keys, their owner's place among ``owners`` (row keys), and a number.
SENT = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("place", pa.binary()), ("owners", pa.binary()), ("n", pa.binary())])
TABLE = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])


def _starts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)


def _different(owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per group: how many of its owners differ from the first."""
    first = np.repeat(owner[at], np.diff(np.append(at, len(owner))))
    return np.add.reduceat((owner != first).astype(np.int64), at) if len(at) else at


@dataclass(frozen=True)
class _Counted:
    """Distinct sorted keys of slices merged so far: count, one owner, whether another was met."""

    key: np.ndarray
    n: np.ndarray
    owner: np.ndarray
    shared: np.ndarray

    @staticmethod
    def none() -> _Counted:
        return _Counted(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))

    @staticmethod
    def folded(parts: list[_Counted]) -> _Counted:
        key, n, owner, shared = (np.concatenate([getattr(x, f) for x in parts]) for f in ("key", "n", "owner", "shared"))
        if not len(key):
            return _Counted.none()
        order = np.argsort(key, kind="stable")
        key, n, owner, shared = key[order], n[order], owner[order], shared[order]
        at = _starts(key)
        return _Counted(key[at], np.add.reduceat(n, at), owner[at], np.logical_or.reduceat(shared, at) | (_different(owner, at) > 0))


def count_keys(docs: DataFrame, keys: Keys, buckets: int, occurrences: bool = False, only=None) -> DataFrame:
    """(bucket, keys, n) over ``docs`` (d, r, text).

    With ``occurrences`` n is how often a key occurs in all. Otherwise only the keys of at
    least two different texts are kept, with about the number of those (equal texts that
    meet in one task count once); ``only`` picks documents by d.
    """

    def emit(batches):
        for _, r, row, key in gathered(batches, keys, only):
            row, key, times = pairs(row, key)
            at = _starts(key)
            n = np.add.reduceat(times, at) if occurrences else 1 + _different(r[row], at)
            key, row = key[at], row[at]
            for b, i, j in slices(key, buckets):
                here, place = np.unique(row[i:j], return_inverse=True)
                owners = (b"", b"") if occurrences else (pack(place.astype(np.uint32)), r[here].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], f.type) for x, f in zip((b, pack(key[i:j]), *owners, pack(n[i:j].astype(np.uint32))), SENT)], schema=SENT)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, waiting, n_waiting = None, _Counted.none(), [], 0
        for batch in batches:
            for i in range(batch.num_rows):  # one slice in Python's memory at a time
                x = {f.name: batch.column(f.name)[i].as_py() for f in SENT}
                n = unpack(x["n"], np.uint32).astype(np.int64)
                # Without occurrences the slices' owners tell whether a key's texts differ.
                owner = np.zeros(len(n), np.int64) if occurrences else np.frombuffer(x["owners"], np.int64)[unpack(x["place"], np.uint32)]
                waiting.append(_Counted(unpack(x["keys"], np.uint64), n, owner, n > 1))
                bucket, n_waiting = x["bucket"], n_waiting + len(n)
                if n_waiting >= FOLD_KEYS:
                    held, waiting, n_waiting = _Counted.folded([held, *waiting]), [], 0
        held = _Counted.folded([held, *waiting])
        keep = slice(None) if occurrences else held.shared
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((bucket, pack(held.key[keep]), pack(held.n[keep])), TABLE)], schema=TABLE)

    sent = docs.mapInArrow(emit, "bucket int, keys binary, place binary, owners binary, n binary")
    return sent.groupBy("bucket").applyInArrow(merge, "bucket int, keys binary, n binary")


#: A request: sorted keys, their document's place among ``d`` and ``r``, how often each occurs there.
REQUEST = pa.schema([("bucket", pa.int32()), ("asked", pa.binary()), ("place", pa.binary()), ("times", pa.binary()),
                     ("d", pa.binary()), ("r", pa.binary())])


FLUSHED = REQUEST.append(pa.field("flush", pa.int64()))


def look_up(docs: DataFrame, keys: Keys, table: DataFrame, buckets: int, answer, schema: str) -> DataFrame:
    """Each document's keys against a table of ``count_keys``.

    ``answer(d, r, key, times, n)`` gets the hits of one slice (numpy arrays of equal
    length: ids, key, its occurrences in the document, its count) and returns a list of
    columns for ``schema``.
    """

    def ask(batches):
        for d, r, row, key in gathered(batches, keys):
            row, key, times = pairs(row, key)
            for b, i, j in slices(key, buckets):
                here, place = np.unique(row[i:j], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], f.type) for x, f in zip((b, pack(key[i:j]), pack(place.astype(np.uint32)), pack(times[i:j].astype(np.uint32)),
                                                            pack(d[here]), r[here].tobytes()), REQUEST)], schema=REQUEST)

    def resolve(batches):
        bucket, known, n, out, rows = None, None, None, [], 0
        for b in batches:
            for i in range(b.num_rows):  # one slice in Python's memory at a time
                x = {name: b.column(name)[i].as_py() for name in ("bucket", "asked", "place", "times", "d", "r")}
                if x["place"] is None:  # the bucket's table, ahead of its requests
                    bucket, known, n = x["bucket"], unpack(x["asked"], np.uint64), unpack(x["times"], np.int64)
                    continue
                if x["bucket"] != bucket or not len(known):
                    continue
                key = unpack(x["asked"], np.uint64)
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = np.flatnonzero(known[at] == key)
                if not len(hit):
                    continue
                place = unpack(x["place"], np.uint32)[hit]
                out.append(answer(unpack(x["d"], np.int64)[place], np.frombuffer(x["r"], np.int64)[place], key[hit],
                                  unpack(x["times"], np.uint32)[hit].astype(np.int64), n[at[hit]]))
                rows += len(hit)
                if rows >= ANSWERED:
                    yield joined(out)
                    out, rows = [], 0
        if out:
            yield joined(out)

    def joined(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=names)

    names = [p.split()[0] for p in schema.split(", ")]
    asked = docs.mapInArrow(ask, "bucket int, asked binary, place binary, times binary, d binary, r binary")
    none = F.lit(None).cast("binary")
    tables = table.select("bucket", F.col("keys").alias("asked"), none.alias("place"), F.col("n").alias("times"), none.alias("d"), none.alias("r"))
    dealt = tables.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", F.col("place").isNotNull())
    return dealt.mapInArrow(resolve, schema)


#: Partial sums of one flush and bucket: its documents' row keys and two numbers of each.
PARTIAL = pa.schema([("flush", pa.int64()), ("d", pa.binary()), ("r", pa.binary()), ("hits", pa.binary()), ("value", pa.binary())])


def sum_by_document(docs: DataFrame, keys: Keys, table: DataFrame, buckets: int, value: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(d, r, hits, value): how many keys of a document (with repeats) ``table`` has, and the sum
    of ``value(count)`` over them. A document's keys lie in one flush, so the partial sums of
    its buckets travel in blocks and one row per document (and flush) comes out."""

    def ask(batches):
        task = TaskContext.get().partitionId() << 32  # a task run again numbers its flushes alike
        for k, (d, r, row, key) in enumerate(gathered(batches, keys)):
            row, key, times = pairs(row, key)
            for b, i, j in slices(key, buckets):
                here, place = np.unique(row[i:j], return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], f.type) for x, f in zip((b, pack(key[i:j]), pack(place.astype(np.uint32)), pack(times[i:j].astype(np.uint32)),
                                                            d[here].tobytes(), r[here].tobytes(), task + k), FLUSHED)], schema=FLUSHED)

    def resolve(batches):
        for b in batches:
            for i in range(b.num_rows):
                x = {name: b.column(name)[i].as_py() for name in ("asked", "place", "times", "d", "r", "flush", "keys", "n")}
                known, n, key = unpack(x["keys"], np.uint64), unpack(x["n"], np.int64), unpack(x["asked"], np.uint64)
                if not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = np.flatnonzero(known[at] == key)
                place, times = unpack(x["place"], np.uint32)[hit], unpack(x["times"], np.uint32)[hit].astype(np.float64)
                d, r = np.frombuffer(x["d"], np.int64), np.frombuffer(x["r"], np.int64)
                hits = np.bincount(place, times, len(d))
                total = np.bincount(place, times * value(n[at[hit]]), len(d))
                met = np.flatnonzero(hits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip((x["flush"], d[met].tobytes(), r[met].tobytes(), hits[met].tobytes(), total[met].tobytes()), PARTIAL)],
                    schema=PARTIAL)

    def add(part: pa.Table) -> pa.Table:  # at most FLUSH_KEYS and one chunk of documents and buckets
        d, r = (np.concatenate([np.frombuffer(x, np.int64) for x in part.column(c).to_pylist()]) for c in ("d", "r"))
        hits, total = (np.concatenate([np.frombuffer(x, np.float64) for x in part.column(c).to_pylist()]) for c in ("hits", "value"))
        order = np.lexsort((total, r, d))  # a fixed order of summation
        d, r, hits, total = d[order], r[order], hits[order], total[order]
        at = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]))) if len(d) else np.zeros(0, np.int64)
        sums = [np.add.reduceat(x, at) if len(at) else x for x in (hits, total)]
        return pa.table([pa.array(d[at]), pa.array(r[at]), pa.array(sums[0].astype(np.int64)), pa.array(sums[1])], names=["d", "r", "hits", "value"])

    asked = docs.mapInArrow(ask, "bucket int, asked binary, place binary, times binary, d binary, r binary, flush long")
    partial = asked.join(table, "bucket").mapInArrow(resolve, "flush long, d binary, r binary, hits binary, value binary")
    return partial.groupBy("flush").applyInArrow(add, "d long, r long, hits long, value double")


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: sizes the buckets."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


#: A slice of one flush's keys, with the rows of the flush they are of and those rows' owners (row keys);
#: ``head`` instead holds the row keys of a flush.
SLICE = pa.schema([("bucket", pa.int32()), ("flush", pa.int64()), ("keys", pa.binary()), ("place", pa.binary()), ("owners", pa.binary()), ("head", pa.binary())])
#: What a bucket answers to a flush: rows of the flush, their shared keys, the counts of these.
ANSWER = pa.schema([("flush", pa.int64()), ("place", pa.binary()), ("keys", pa.binary()), ("n", pa.binary()), ("head", pa.binary())])
#: Bytes of a bucket's slices that a task keeps in memory until all are counted; the rest waits in its temp folder.
KEPT_BYTES = 1 << 26


def of_texts(keys: Callable):
    """Batches (d, r, text) -> (d, r, row, key, ...), a chunk of texts at a time."""
    def parts(batches):
        for d, r, texts in text_chunks(batches):
            yield d, r, *keys(texts)
    return parts


def of_lists(batches):
    """Batches (d, r, keys) -> (d, r, row, key)."""
    for b in batches:
        lists = b.column("keys")
        yield (np.asarray(b.column("d")), np.asarray(b.column("r")), np.repeat(np.arange(len(lists)), np.asarray(pc.list_value_length(lists))),
               np.asarray(lists.flatten()).view(np.uint64))


def _flushes(parts):
    """Parts of about FLUSH_KEYS keys as one: (d, r, row, key, ...); what follows the keys begins with rows, too."""
    held, n, docs = [], 0, 0
    for d, r, row, key, *more in parts:
        held.append((d, r, row + docs, key, *[x + docs if k == 0 else x for k, x in enumerate(more)]))
        n, docs = n + len(key), docs + len(d)
        if n >= FLUSH_KEYS:
            yield tuple(map(np.concatenate, zip(*held)))
            held, n, docs = [], 0, 0
    if n:
        yield tuple(map(np.concatenate, zip(*held)))


def all_shared(d, r, place, key, n):
    """Every shared key of a row."""
    order = np.argsort(place, kind="stable")
    return place[order], key[order]


def owners_met(owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per key about how many different owners a slice names."""
    return 1 + _different(owner, at)


def owners_told(owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per key a number that tells its owners (each named once in all) from others."""
    return np.add.reduceat(mix64(owner.view(np.uint64)).view(np.int64), at)


def shared_lists(docs: DataFrame, parts: Callable, buckets: int, pick: Callable = all_shared, number: Callable = owners_met) -> DataFrame:
    """(d, r, keys): of each row the keys that at least two different owners (r) have.

    ``parts`` cuts batches of ``docs`` into (d, r, row, key, ...) arrays. Keys are cut and moved
    once: the task of a bucket counts its slices as they come, puts them by, and then tells every
    flush which of its keys are shared. A flush's answers meet again in one task (at most
    FLUSH_KEYS keys and one part), where ``pick(d, r, place, key, n, ...)`` chooses (row of the
    flush, ascending, key) among them; n is the sum over slices of ``number``.
    """

    def emit(batches):
        task = TaskContext.get().partitionId()
        for k, (d, r, row, key, *more) in enumerate(_flushes(parts(batches))):
            flush, out = (task << 32) + k, []  # a task run again numbers its flushes alike
            row, key, _ = pairs(row, key)
            for b, i, j in slices(key, buckets):
                here = np.flatnonzero(np.bincount(row[i:j], minlength=len(d)))
                out.append((b, flush, pack(key[i:j]), pack(row[i:j].astype(np.uint32)), r[here].tobytes(), None))
            out.append(((task + k) % buckets, flush, None, None, None, pickle.dumps((d, r, *more))))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), SLICE)], schema=SLICE)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n_waiting, n_slices = _Counted.none(), [], 0, 0
        with tempfile.SpooledTemporaryFile(KEPT_BYTES) as by:
            for batch in batches:
                for i in range(batch.num_rows):  # one slice in Python's memory at a time
                    x = {f.name: batch.column(f.name)[i].as_py() for f in SLICE}
                    if x["keys"] is None:
                        yield answers([(x["flush"], None, None, None, x["head"])])
                        continue
                    key, row = unpack(x["keys"], np.uint64), unpack(x["place"], np.uint32)
                    # Owners stand in the order of their rows.
                    owner = np.frombuffer(x["owners"], np.int64)[(np.cumsum(np.bincount(row) > 0) - 1)[row]]
                    at = _starts(key)
                    waiting.append(_Counted(key[at], number(owner, at), owner[at], _different(owner, at) > 0))
                    n_waiting, n_slices = n_waiting + len(at), n_slices + 1
                    if n_waiting >= FOLD_KEYS:
                        held, waiting, n_waiting = _Counted.folded([held, *waiting]), [], 0
                    pickle.dump((x["flush"], x["keys"], x["place"]), by)
            held = _Counted.folded([held, *waiting])
            known, n = held.key[held.shared], held.n[held.shared]
            del held, waiting
            by.seek(0)
            out, size = [], 0
            for _ in range(n_slices if len(known) else 0):
                flush, keys, place = pickle.load(by)
                key = unpack(keys, np.uint64)
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = np.flatnonzero(known[at] == key)
                if not len(hit):
                    continue
                out.append((flush, pack(unpack(place, np.uint32)[hit]), pack(key[hit]), pack(n[at[hit]]), None))
                size += len(hit)
                if size >= ANSWERED:
                    yield answers(out)
                    out, size = [], 0
            if out:
                yield answers(out)

    def answers(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), ANSWER)], schema=ANSWER)

    def choose(part: pa.Table) -> pa.Table:
        d, r, *more = pickle.loads(next(x for x in part.column("head").to_pylist() if x is not None))
        place, key, n = (np.concatenate([unpack(x, t) for x in part.column(c).to_pylist() if x is not None] or [np.zeros(0, t)])
                         for c, t in (("place", np.uint32), ("keys", np.uint64), ("n", np.int64)))
        place, key = pick(d, r, place.astype(np.int64), key, n, *more)
        at = _starts(place)
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(place)).astype(np.int32)), pa.array(key.view(np.int64)))
        return pa.table([pa.array(d[place[at]]), pa.array(r[place[at]]), lists], names=["d", "r", "keys"])

    sent = docs.mapInArrow(emit, "bucket int, flush long, keys binary, place binary, owners binary, head binary")
    told = sent.groupBy("bucket").applyInArrow(settle, "flush long, place binary, keys binary, n binary, head binary")
    return told.groupBy("flush").applyInArrow(choose, "d long, r long, keys array<long>")


def shared_keys(docs: DataFrame, keys: Callable, n_keys: float, path: str, each: int = OWNED_KEYS, pick: Callable = all_shared) -> DataFrame:
    """(d, r, keys): the keys of each document (d, r, text) that at least two different texts have, landed
    at ``path``. Rows that repeat (d, r) are rows of their own."""
    out = land(shared_lists(docs, of_texts(keys), bucket_count(n_keys, each), pick), f"{path}/shared")
    release(docs.sparkSession)
    return out
