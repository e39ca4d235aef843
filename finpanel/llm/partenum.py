"""N-gram Jaccard join with PartEnum signatures, and its groups.

Sets (distinct word shingles) are put into size bands such that sets similar enough lie in
one band or in neighbours. In a band, similar sets differ in at most k elements. The
domain of shingles is cut by hash into more than k partitions, so the two sets agree on at
least one of them whole; each partition's content is a signature. Which k + 1 partitions
a set goes by is free, as long as the order depends on the content alone: sets go by
their *rarest* signatures, by a count over all documents. (Proof: of A's k + 1 rarest at
least one is common to A and B, likewise of B's; the rarer-bounded side's is in both
choices.) A set with k + 1 signatures of its own has no partner and drops out, and
passages that many documents share are passed over.

Sets that share a chosen signature are candidates. Equal sets are one class from the
start. First every group's members are compared with its smallest member only; after
connected components, members of one group that are still apart are compared with each
other. So a large group of near copies costs a comparison a member, and every link
between different sets is either found or already implied by the components. Signatures
that the very same sets share (near copies agree on most of theirs) give the same
candidates, so one of them stands for all. Before two
sets are compared whole, their sketches are: element counts in ``CELLS`` hash cells, whose
distance never exceeds the number of differing elements, so no link is lost.

Defined cases: a null text or one without words has the empty set, linked with nothing; a
text of fewer words than a shingle has its whole sequence as its one shingle; a null id
orders last and is shown as null; rows that repeat an id are nodes of their own with that
id (equal texts under one id are one node); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import (Fingerprints, drop, fresh, keyed, land, mix64, needed, public_id, release, row_key, run_dir, same_row,
                                 text_chunks, word_tokens)
from finpanel.llm.keycount import BUCKET_KEYS, bucket_count, of_lists, owners_told, shared_keys, shared_lists, text_bytes

#: Partitions per tolerated difference, and at least.
PARTITIONS, LEAST_PARTITIONS = 1.5, 4096
#: Cells of a set's sketch (one byte each), and members of a group that one task compares with as many others.
CELLS, BLOCK = 128, 256
#: Pairs that a task remembers as found already (a pair found again later is dropped by ``distinct``).
SEEN = 1 << 18
#: Bands up to which LEAST_PARTITIONS holds: small sets, whose shingles then seldom share a partition.
SMALL = 64


def bands(percent: int) -> np.ndarray:
    """Upper sizes of the bands: u = floor(l * 100 / percent), from l = 1 to beyond 2**40."""
    out, low = [], 1
    while low < 1 << 40:
        out.append(low * 100 // percent)
        low = out[-1] + 1
    return np.array(out, np.int64)


def shingle_sets(texts: list, words: int):
    """Distinct shingles of each text: (row, hash), sorted by row, then hash."""
    t = word_tokens(texts, fold=True)
    n = np.where(t.count > 0, np.maximum(t.count - words + 1, 1), 0)
    row = np.repeat(np.arange(len(n)), n)
    i = t.at[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    h = Fingerprints(t.value).of(i, np.minimum(i + words, t.at[row + 1]))
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def _sums(cell: np.ndarray, value: np.ndarray, sparse: np.ndarray, cells: int):
    """The cells in use, ascending, and the sum of their values. Small sets use few of their
    many cells, so theirs are found by sorting; the others' fill most of a dense table."""
    few, first = np.unique(cell[sparse], return_inverse=True)
    few_sums = np.zeros(len(few), np.uint64)
    np.add.at(few_sums, first, value[sparse])
    if sparse.all():
        return few, few_sums
    # Cells of small sets are cut out of the dense table's numbering.
    dense, sums = cell[~sparse], value[~sparse]
    used = np.zeros(cells // 64 + 1, bool)
    used[dense // 64] = True
    page = np.cumsum(used) - 1
    at = page[dense // 64] * 64 + dense % 64
    total, hits = np.zeros((page[-1] + 1) * 64, np.uint64), np.zeros((page[-1] + 1) * 64, bool)
    np.add.at(total, at, sums)
    hits[at] = True
    at = np.flatnonzero(hits)
    many = np.flatnonzero(used)[at // 64] * 64 + at % 64
    out, sums = np.concatenate((few, many)), np.concatenate((few_sums, total[at]))
    order = np.argsort(out, kind="stable")
    return out[order], sums[order]


def signatures(row: np.ndarray, h: np.ndarray, n_rows: int, percent: int):
    """For each set and each band instance it takes part in (its own and, where a partner can
    be there, the next): (instances: row, band, k, partitions in use), (row, signature).
    The low byte of a signature is its band."""
    upper = bands(percent)
    size = np.bincount(row, minlength=n_rows)
    band = np.searchsorted(upper, size)
    most = size * 100 // percent
    value = mix64(h + np.uint64(0x632BE59BD9B4E019))
    found, keys, owners = [], [], []
    for step in (0, 1):
        t = band + step
        inside = (size > 0) & ((step == 0) | (most > upper[band]))
        k = (size + np.minimum(most, upper[t])) * (100 - percent) // (100 + percent)
        k_band = 2 * upper[t] * (100 - percent) // (100 + percent)
        parts = np.where(upper[t] <= SMALL, LEAST_PARTITIONS, np.ceil((k_band + 1) * PARTITIONS)).astype(np.int64)
        parts = np.where(inside, parts, 0)
        at = np.concatenate(([0], np.cumsum(parts)))
        use = inside[row]
        own, x = row[use], h[use]
        p = ((mix64(x ^ (t[own].astype(np.uint64) << np.uint64(8))) >> np.uint64(32)) * parts[own].astype(np.uint64)) >> np.uint64(32)
        cell = at[own] + p.astype(np.int64)
        filled, content = _sums(cell, value[use], upper[t[own]] <= SMALL, at[-1])
        owner = np.searchsorted(at, filled, side="right") - 1
        place = ((filled - at[owner]).astype(np.uint64) << np.uint64(8)) | t[owner].astype(np.uint64)
        key = mix64(content ^ mix64(place))
        keys.append((key & ~np.uint64(255)) | (t[owner].astype(np.uint64) & np.uint64(255)))
        owners.append(owner)
        in_use = np.bincount(owner, minlength=n_rows)
        i = np.flatnonzero(inside)
        found.append((i, t[i], k[i], in_use[i]))
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    return tuple(map(np.concatenate, zip(*found))), (owner[order], key[order])


def _signature_keys(words: int, percent: int):
    """Texts -> (row, signature, and of each band instance: row, band, k, partitions in use)."""
    def keys(texts):
        row, h = shingle_sets(texts, words)
        instances, found = signatures(row, h, len(texts), percent)
        return *found, *instances
    return keys


def _rarest(d, r, place, key, n, own, band, k, used):
    """What each row goes by: in each band its k + 1 rarest signatures (ties included), of which
    those that no other text has need not be sent."""
    of = place << 8 | (key & np.uint64(255)).astype(np.int64)
    order = np.lexsort((n, of))
    of, place, key, n = of[order], place[order], key[order], n[order]
    at = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    size = np.diff(np.append(at, len(of)))
    ids = own << 8 | band
    by = np.argsort(ids)
    i = by[np.searchsorted(ids[by], of[at])]
    want = k[i] + 1 - (used[i] - size)
    bound = np.where(want > 0, n[np.minimum(at + np.clip(want, 1, size) - 1, max(0, len(n) - 1))], -1) if len(n) else n
    bound = np.where(want > size, np.iinfo(np.int64).max, bound)
    taken = n <= np.repeat(bound, size)
    # A set with fewer partitions in use than it has to go by goes by the empty ones, too.
    poor = np.flatnonzero(used <= k)
    empty = (mix64(band[poor].astype(np.uint64) + np.uint64(0xD6E8FEB86659FD93)) & ~np.uint64(255)) | band[poor].astype(np.uint64)
    place, key = np.concatenate((place[taken], own[poor])), np.concatenate((key[taken], empty))
    order = np.argsort(place, kind="stable")
    return place[order], key[order]


def _groups(d, r, place, key, n):
    """The groups of members that each row is in, every one once."""
    order = np.lexsort((n, place))
    place, n = place[order], n[order]
    new = np.ones(len(n), bool)
    new[1:] = (place[1:] != place[:-1]) | (n[1:] != n[:-1])
    return place[new], n[new].view(np.uint64)


def _describe(words: int):
    """Per row: size and digest of the set, and its sketch."""
    def rows(batches):
        for d, r, texts in text_chunks(batches):
            row, h = shingle_sets(texts, words)
            n = len(texts)
            c = []
            for salt in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB):
                total = np.zeros(n, np.uint64)
                np.add.at(total, row, mix64(h ^ np.uint64(salt)))
                c.append(total.view(np.int64))
            cells = np.bincount(row * CELLS + (mix64(h + np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(57)).astype(np.int64), minlength=n * CELLS)
            sketches = np.minimum(cells, 255).astype(np.uint8).reshape(n, CELLS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(r), pa.array(np.bincount(row, minlength=n)), pa.array(c[0]), pa.array(c[1]),
                 pa.array([x.tobytes() for x in sketches], pa.binary())],
                names=["d", "r", "size", "c1", "c2", "sketch"])
    return rows


def _set_rows(words: int):
    def rows(batches):
        for d, r, texts in text_chunks(batches):
            row, h = shingle_sets(texts, words)
            at = np.searchsorted(row, np.arange(len(texts) + 1))
            sets = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(r), sets], names=["d", "r", "set"])
    return rows


def components(edges: DataFrame, path: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternating large-star and small-star steps until nothing changes; each is an aggregate
    and a join on the node, landed, so the driver sees only a checksum per round.
    """
    spark = edges.sparkSession
    now = land(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{path}/0")
    seen, step = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, step = mark, step + 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = land(small, f"{path}/{step}")
    return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def similar(x: Column, y: Column, percent: int) -> Column:
    both = F.size(F.array_intersect(x, y)).cast("long")
    return both * 100 >= (F.size(x) + F.size(y) - both) * percent


def links(pairs: DataFrame, rows: DataFrame, words: int, percent: int, path: str) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar, by their whole sets."""
    pairs = land(pairs.distinct(), f"{path}/pairs")
    need = land(pairs.select(F.explode(F.array("a", "b")).alias("n")).distinct().select("n.d", "n.r"), f"{path}/need")
    sets = needed(rows, need).dropDuplicates(["d", "r"]).mapInArrow(_set_rows(words), "d long, r long, set array<long>")
    sets = land(sets.select(F.struct("d", "r").alias("n"), "set"), f"{path}/sets")
    with_a = pairs.join(sets.withColumnRenamed("set", "x"), F.col("a") == F.col("n")).drop("n")
    with_b = with_a.join(sets.withColumnRenamed("set", "y"), F.col("b") == F.col("n")).drop("n")
    out = land(with_b.where(similar(F.col("x"), F.col("y"), percent)).select("a", "b"), f"{path}/links")
    release(rows.sparkSession)
    return out


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: id, n_shingles, component (smallest id reachable), d, r (its key),
    stays (no set, or the row with its component's smallest key)."""
    spark = docs.sparkSession
    base = run_dir(spark, "partenum")
    rows = keyed(docs, id_col, text_col)
    sets = land(rows.mapInArrow(_describe(words), "d long, r long, size long, c1 long, c2 long, sketch binary"), f"{base}/described")
    classes = land(sets.where("size > 0").groupBy("size", "c1", "c2").agg(
        F.min(F.struct("d", "r")).alias("rep"), F.min_by("sketch", F.struct("d", "r")).alias("sketch")), f"{base}/classes")
    gone_by = shared_keys(rows, _signature_keys(words, percent), text_bytes(rows) / 8, base, BUCKET_KEYS, _rarest)
    # One row of each class; rows alike in d and r have the same keys.
    reps = classes.select("rep.d", "rep.r")
    gone_by = land(gone_by.join(reps, ["d", "r"], "left_semi").groupBy("d", "r").agg(F.any_value("keys").alias("keys")), f"{base}/gone-by")
    drop(spark, f"{base}/shared")
    release(spark)
    # Of the signatures with the same members (told by a hash of them all, which names the group) one stays.
    buckets = bucket_count(gone_by.agg(F.sum(F.size("keys"))).first()[0] or 0, BUCKET_KEYS)
    groups = shared_lists(gone_by, of_lists, buckets, _groups, owners_told)
    chosen = land(groups.select(F.struct("d", "r").alias("node"), F.explode("keys").alias("key")), f"{base}/chosen")
    drop(spark, f"{base}/gone-by")
    release(spark)

    known = classes.select(F.col("rep").alias("node"), "size", "sketch")
    # Landed before it is joined back: AQE can then split a signature that very many sets share.
    lead = land(chosen.groupBy("key").agg(F.min("node").alias("a")), f"{base}/leads")
    members = land(chosen.join(lead, "key"), f"{base}/members")
    for name in ("chosen", "leads"):
        drop(spark, f"{base}/{name}")
    release(spark)
    stars = members.where("node <> a").select("a", F.col("node").alias("b"))
    found = links(_close(stars, known, percent), rows, words, percent, f"{base}/first")
    roots = land(components(found, f"{base}/first-components"), f"{base}/first-roots")
    # Members of one group that are still apart.
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    apart = land(placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key"), f"{base}/apart")
    open_ = land(placed.join(apart, "key", "left_semi"), f"{base}/open")
    for name in ("members", "apart"):
        drop(spark, f"{base}/{name}")
    release(spark)
    tested = spark.read.schema(PAIR).parquet(f"{base}/first/pairs")
    rest = _across(open_, known, percent).distinct().join(tested, ["a", "b"], "left_anti")
    more = links(rest, rows, words, percent, f"{base}/second")
    edges = more.unionByName(roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")))
    final = land(components(edges, f"{base}/second-components"), f"{base}/second-roots")
    for name in ("open", "first", "first-components", "first-roots", "second", "second-components"):
        drop(spark, f"{base}/{name}")
    release(spark)

    of_class = (classes.join(final, F.col("rep") == F.col("node"), "left")
                .select("size", "c1", "c2", F.coalesce("root", "rep").alias("root")))
    return (sets.join(of_class, ["size", "c1", "c2"], "left")
            .select(public_id(F.col("d")).alias("id"), F.col("size").alias("n_shingles"),
                    public_id(F.coalesce(F.col("root.d"), "d")).alias("component"), "d", "r",
                    F.coalesce((F.col("root.d") == F.col("d")) & (F.col("root.r") == F.col("r")), F.lit(True)).alias("stays")))


def _sketch_close(x: np.ndarray, y: np.ndarray, size_x, size_y, percent: int) -> np.ndarray:
    """Could sets with these sketches and sizes be similar? Broadcasts over the first axes."""
    apart = np.abs(x.astype(np.int16) - y).sum(-1)
    small, large = np.minimum(size_x, size_y), np.maximum(size_x, size_y)
    return (small * 100 >= large * percent) & (apart * (100 + percent) <= (small + large) * (100 - percent))


def _close(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    def keep(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(f"sketch_{k}").to_pylist()), np.uint8).reshape(-1, CELLS) for k in "ab")
            ok = _sketch_close(x, y, np.asarray(b.column("size_a")), np.asarray(b.column("size_b")), percent)
            yield b.select(["a", "b"]).filter(pa.array(ok))

    a, b = (known.select(*[F.col(c).alias(n) for c, n in (("node", x), ("size", f"size_{x}"), ("sketch", f"sketch_{x}"))]) for x in "ab")
    return pairs.distinct().join(a, "a").join(b, "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(keep, PAIR)


NODE = "struct<d:long,r:long>"
PAIR = f"a {NODE}, b {NODE}"


def _across(members: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one key with different roots that sizes and sketches allow.

    A key's members are dealt into blocks of about BLOCK, and each pair of blocks is one
    piece of work, so no task holds more than two blocks of a key, however large it is. Keys
    with the same smallest member follow one another: a pair they share is found once."""
    blocks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = (members.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
             .select("node", "key", F.xxhash64("a").alias("lead"), F.xxhash64("root").alias("root"), "block", "blocks").join(known, "node")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("lead", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                     "node.d", "node.r", "root", "size", "sketch"))
    piece = ["lead", "lo", "hi", "key"]
    dealt = dealt.repartition(*piece[:3]).sortWithinPartitions(*piece, "block")

    def work(batches):
        held, seen = [], set()
        for b in batches:
            for x in b.to_pylist():
                if held and any(x[c] != held[0][c] for c in piece):
                    yield from compared(held, seen)
                    if x["lead"] != held[0]["lead"] or len(seen) > SEEN:
                        seen.clear()
                    held = []
                held.append(x)
        if held:
            yield from compared(held, seen)

    def compared(rows, seen):
        if len(rows) < 2 or all(x["root"] == rows[0]["root"] for x in rows):
            return
        sketch = np.frombuffer(b"".join(x["sketch"] for x in rows), np.uint8).reshape(-1, CELLS)
        root, size, block = (np.array([x[c] for x in rows], np.int64) for c in ("root", "size", "block"))
        node = [(x["d"], x["r"]) for x in rows]
        one = rows[0]["lo"] == rows[0]["hi"]
        new = []
        for i in range(len(rows)):
            # Within one block every pair once; between two, those of different blocks.
            j = np.arange(i + 1, len(rows))
            j = j[(root[j] != root[i]) & (one | (block[j] != block[i]))]
            j = j[_sketch_close(sketch[j], sketch[i], size[j], size[i], percent)] if len(j) else j
            for k in j.tolist():
                pair = (min(node[i], node[k]), max(node[i], node[k]))
                if pair not in seen:
                    seen.add(pair)
                    new.append(pair)
        if new:
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array([p[k][0] for p in new], pa.int64()), pa.array([p[k][1] for p in new], pa.int64())], ["d", "r"])
                                              for k in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(work, PAIR)


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that stay: of each group one row, with the smallest id (null last)."""
    base = run_dir(docs.sparkSession, "one-per-group")
    out = land(near_groups(docs, id_col, text_col, words, percent), f"{base}/groups")
    stay = land(out.where("stays").groupBy("d", "r").agg((F.max("n_shingles") > 0).alias("set"), F.count(F.lit(1)).alias("n")), f"{base}/stay")
    # Rows that repeat id and text are one document: where there are any, one of them stays.
    again = stay.where("set AND n > 1")
    drop(docs.sparkSession, f"{base}/groups")
    release(docs.sparkSession)
    if again.isEmpty():
        return docs.join(stay, same_row(docs, id_col, text_col, stay), "left_semi")
    other = stay.where("NOT set OR n = 1")
    d, r = fresh(docs, "key_d"), fresh(docs, "key_r")
    once = docs.join(again, same_row(docs, id_col, text_col, again), "left_semi")
    once = once.withColumns(dict(zip((d, r), row_key(id_col, text_col)))).dropDuplicates([d, r]).drop(d, r)
    return docs.join(other, same_row(docs, id_col, text_col, other), "left_semi").unionByName(once)

