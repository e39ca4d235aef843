"""Benchmark decontamination: BM25 with block-max WAND, then overlap.

The test items are the index, the training texts the queries. Items are cut into units of
up to ``UNIT`` words; a unit's BM25 weights are scaled to sum to 1, so a passage's score
says how much of the unit, by information, it holds, and one threshold serves all items.
Every text is cut into passages of two units' length, half overlapping, so that a leaked
unit lies whole in one. Retrieval finds *all* (passage, unit) with a score of at least
``threshold``, skipping by upper bounds as WAND does, for a whole batch of passages at a
time: passages whose terms' largest weights cannot reach the threshold are dropped; of the
others, blocks of ``BLOCK`` units whose block maxima cannot; the postings of what is left
are scored exactly. Retrieved items are verified in the whole text: of the item's question
part and of its answer part (its last sentence, unless given as columns of their own) at
least ``overlap`` of the word n-grams must occur.

Document frequencies, number of units and mean length come from one aggregate over all
items, so a score does not depend on how many items there are beside. Different item texts
are indexed once, in shards of about ``SHARD`` bytes, each built by a Spark task. Texts are
dealt into parts of about ``PART`` bytes; a task holds one part and reads the shards one
after the other, so nothing of the benchmark but two numbers passes through the driver.

Defined cases: words are runs of letters, digits and non-ASCII bytes, A-Z lower-cased; a
null text has none; items of fewer than ``NGRAM`` words (or null) identify nothing and are
left out; repeated items are reported each; rows that repeat an id are reported each;
without items or texts there are no rows.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import LAST_ID, Fingerprints, Tokens, keyed, land, run_dir, same_row, text_chunks, word_tokens

UNIT, BLOCK, NGRAM = 48, 64, 5
SHARD, PART = 1 << 19, 1 << 25
K1, B = 1.2, 0.75
GAPS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
SENTENCE = re.compile(r"[^.?!\n]*[.?!\n]*")


def tokens(texts: list) -> Tokens:
    return word_tokens(texts, fold=True, gaps=GAPS)


def parts(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last sentence with a word; all of a single one."""
    sentences = [m for m in SENTENCE.findall(text) if re.search(r"\w", m)]
    if len(sentences) < 2:
        return text, text
    return "".join(sentences[:-1]), sentences[-1]


def ngrams(values: np.ndarray, n: int) -> np.ndarray:
    i = np.arange(len(values) - n + 1)
    return Fingerprints(values).of(i, i + n) if len(i) else np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Index:
    terms: np.ndarray      # sorted term hashes
    most: np.ndarray       # term -> its largest weight
    block_most: np.ndarray  # (term, block) -> largest weight there
    begin: np.ndarray      # (term, block) -> first posting; one more at the end
    unit: np.ndarray       # postings by term, then unit
    weight: np.ndarray
    item: np.ndarray       # unit -> item
    ids: list
    question: list         # item -> (n, distinct n-grams)
    answer: list


@dataclass(frozen=True)
class Known:
    """Statistics of all items, for an index of some of them."""
    units: int
    mean: float            # words a unit
    terms: np.ndarray      # sorted term hashes, at least those of the items indexed
    df: np.ndarray         # term -> units that hold it


def units_of(text: str) -> list[np.ndarray]:
    words = tokens([text.encode()]).value
    return np.array_split(words, -(-len(words) // UNIT)) if len(words) >= NGRAM else []


def build(items: list[tuple], known: Known | None = None) -> Index | None:
    """Index of (id, question, answer, whole text) rows, with their own statistics or ``known``."""
    keep, units, owner = [], [], []
    for row in items:
        own = units_of(row[3])
        if own:
            units += own
            owner += [len(keep)] * len(own)
            keep.append(row)
    if not keep:
        return None
    size = np.array([len(u) for u in units])
    at = np.repeat(np.arange(len(units)), size)
    terms, t = np.unique(np.concatenate(units), return_inverse=True)
    cell, tf = np.unique(t.astype(np.int64) * len(units) + at, return_counts=True)
    t, u = np.divmod(cell, len(units))
    known = known or Known(len(units), size.mean(), terms, np.bincount(t, minlength=len(terms)))
    df = known.df[np.searchsorted(known.terms, terms)]
    idf = np.log1p((known.units - df + 0.5) / (df + 0.5))
    w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[u] / known.mean))
    w = (w / np.bincount(u, weights=w, minlength=len(units))[u]).astype(np.float32)
    blocks = -(-len(units) // BLOCK)
    place = t * blocks + u // BLOCK
    block_most = np.zeros(len(terms) * blocks, np.float32)
    np.maximum.at(block_most, place, w)
    begin = np.searchsorted(place, np.arange(len(terms) * blocks + 1))

    def grams(text):
        v = tokens([text.encode()]).value
        n = min(NGRAM, len(v))
        return n, np.unique(ngrams(v, n)) if n else np.zeros(0, np.uint64)

    block_most = block_most.reshape(-1, blocks)
    return Index(terms, block_most.max(1), block_most, begin, u.astype(np.int32), w, np.array(owner), [r[0] for r in keep],
                 [grams(r[1]) for r in keep], [grams(r[2]) for r in keep])


def retrieve(ix: Index, t: Tokens, threshold: float):
    """All (row of the text, unit, best score) with a passage that scores at least ``threshold``."""
    term = np.minimum(np.searchsorted(ix.terms, t.value), len(ix.terms) - 1)
    known = np.flatnonzero(ix.terms[term] == t.value)
    doc, term = t.doc[known], term[known]
    # Word i of a text lies in the passages i // UNIT and i // UNIT - 1 (each two units long).
    per = t.count // UNIT + 1
    base = np.concatenate(([0], np.cumsum(per)))
    half = base[doc] + (known - t.at[doc]) // UNIT
    before = half[half > base[doc]] - 1
    passage = np.concatenate((half, before))
    term = np.concatenate((term, term[half > base[doc]]))
    pair = np.unique(passage * len(ix.terms) + term)
    passage, term = np.divmod(pair, len(ix.terms))
    slack = np.float32(threshold - 1e-4)

    def starts(x):
        return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)

    # Lists: the terms' largest weights.
    at = starts(passage)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    reach = np.add.reduceat(ix.most[term], at) >= slack
    live = np.repeat(reach, np.diff(np.append(at, len(passage))))
    passage, term = passage[live], term[live]
    at = starts(passage)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    # Blocks: their maxima.
    blocks = ix.block_most.shape[1]
    group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(passage))))
    found = []
    for b in range(blocks):
        reach = np.add.reduceat(ix.block_most[term, b], at) >= slack
        use = np.flatnonzero(reach[group])
        if not len(use):
            continue
        # Postings of what is left, scored exactly.
        lo, hi = ix.begin[term[use] * blocks + b], ix.begin[term[use] * blocks + b + 1]
        n = hi - lo
        post = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        cell, where = np.unique(np.repeat(passage[use], n) * len(ix.item) + ix.unit[post], return_inverse=True)
        score = np.bincount(where, weights=ix.weight[post])
        good = score >= threshold - 1e-6
        found.append((cell[good], score[good]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    cell, score = (np.concatenate(x) for x in zip(*found))
    passage, unit = np.divmod(cell, len(ix.item))
    return np.searchsorted(base, passage, side="right") - 1, unit, score


def _shared(part, grams: dict, values: np.ndarray) -> float:
    n, wanted = part
    if n not in grams:
        grams[n] = np.unique(ngrams(values, n)) if n else wanted
    if not len(wanted):
        return 1.0
    have = grams[n]
    if not len(have):
        return 0.0
    return float((have[np.minimum(np.searchsorted(have, wanted), len(have) - 1)] == wanted).mean())


def _leak_rows(ix: Index, threshold: float, overlap: float):
    def rows(batches):
        for d, r, texts in text_chunks(batches):
            t = tokens(texts)
            doc, unit, score = retrieve(ix, t, threshold)
            best: dict = {}
            for o, i, s in zip(doc.tolist(), ix.item[unit].tolist(), score.tolist()):
                best[o, i] = max(s, best.get((o, i), 0.0))
            out, grams, last = [], {}, None
            for (o, i), s in sorted(best.items()):
                if o != last:
                    grams, last = {}, o
                values = t.value[t.at[o]:t.at[o + 1]]
                q, a = _shared(ix.question[i], grams, values), _shared(ix.answer[i], grams, values)
                if q >= overlap and a >= overlap:
                    out.append((None if d[o] == LAST_ID else int(d[o]), int(d[o]), int(r[o]), ix.ids[i], s, q, a))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), KINDS)], names=NAMES)
    return rows


NAMES = ["id", "d", "r", "item", "score", "question_overlap", "answer_overlap"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64(), pa.float64()]
SCHEMA = "id long, d long, r long, item string, score double, question_overlap double, answer_overlap double"


def _measure(batches):
    """Items (k, t) -> k, units, words, and each term with the number of units that hold it."""
    for b in batches:
        for k, t in zip(b.column("k").to_pylist(), b.column("t").to_pylist()):
            own = units_of(t)
            if own:
                terms, n = np.unique(np.concatenate([np.unique(u) for u in own]), return_counts=True)
                yield pa.RecordBatch.from_pylist([{"k": k, "units": len(own), "words": sum(map(len, own)),
                                                   "terms": terms.view(np.int64).tolist(), "held": n.tolist()}], schema=MEASURED)


MEASURED = pa.schema([("k", pa.string()), ("units", pa.int64()), ("words", pa.int64()),
                      ("terms", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])


def _index_rows(units: int, mean: float):
    """The item rows of a shard -> its index, as bytes."""
    def one(table):
        rows = sorted(table.select(["k", "q", "a", "t", "known"]).to_pylist(), key=lambda x: x["k"])
        terms, df = (np.array([e[c] for x in rows for e in x["known"]], np.int64) for c in ("term", "df"))
        terms, at = np.unique(terms.view(np.uint64), return_index=True)
        index = build([(x["k"], *(parts(x["t"]) if x["a"] is None else (x["q"] or "", x["a"])), x["t"]) for x in rows],
                      Known(units, mean, terms, df[at]))
        return pa.table({"shard": table.column("shard")[:1].cast(pa.int64()), "ix": pa.array([pickle.dumps(index)], pa.binary())})
    return one


def _scan(threshold: float, overlap: float):
    """Rows ordered by part, texts before shards: the part's texts are held, the shards pass by."""
    def rows(batches):
        part, held = None, []
        for b in batches:
            p = np.asarray(b.column("part"))
            texts = np.asarray(b.column("shard")) < 0
            cuts = np.flatnonzero((p[1:] != p[:-1]) | (texts[1:] != texts[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(p)]):
                if lo == hi:
                    continue
                if p[lo] != part:
                    part, held = p[lo], []
                if texts[lo]:
                    held.append(b.slice(lo, hi - lo).select(["d", "r", "text"]))
                    continue
                for ix in b.column("ix").slice(lo, hi - lo):
                    yield from _leak_rows(pickle.loads(ix.as_py()), threshold, overlap)(iter(held))
    return rows


def shards_of(items: DataFrame, base: str) -> DataFrame:
    """Items (k, q, a, t, n: how often) -> (shard, ix), weighted by the statistics of all of them."""
    measured = land(items.select("k", "t").mapInArrow(_measure, "k string, units long, words long, terms array<long>, held array<long>")
                    .join(items.select("k", "n", F.octet_length("t").alias("bytes")), "k"), f"{base}/measured")
    units, words, size = measured.agg(F.sum(F.col("n") * F.col("units")), F.sum(F.col("n") * F.col("words")),
                                      F.sum(F.col("bytes").cast("long"))).first()
    cells = measured.select("k", "n", F.explode(F.arrays_zip("terms", "held")).alias("x")).select("k", "n", "x.terms", "x.held")
    df = cells.groupBy(F.col("terms").alias("term")).agg(F.sum(F.col("n") * F.col("held")).alias("df"))
    known = (cells.join(df, F.col("terms") == F.col("term")).groupBy("k")
             .agg(F.collect_list(F.struct("term", "df")).alias("known")))
    shards = -(-(size or 0) // (SHARD // 2)) or 1  # half full on average, so none overflows by far
    dealt = items.join(known, "k").withColumn("shard", F.pmod(F.xxhash64("k"), F.lit(shards)))
    make = _index_rows(units or 0, (words or 0) / (units or 1))
    return land(dealt.select("shard", "k", "q", "a", "t", "known").groupBy("shard").applyInArrow(make, "shard long, ix binary"), f"{base}/shards")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", question_col: str | None = None, answer_col: str | None = None,
          threshold: float = 0.5, overlap: float = 0.5) -> DataFrame:
    """One row per (text, item) found and verified: id, item (as string), score, overlaps, and the row's key (d, r)."""
    base = run_dir(docs.sparkSession, "decontaminate")
    rows = keyed(docs, id_col, text_col).where("text IS NOT NULL")
    whole = F.concat_ws(" ", question_col, answer_col) if question_col and answer_col else F.col(item_text)
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(question_col or item_text).alias("q"),
                             (F.col(answer_col) if answer_col else F.lit(None).cast("string")).alias("a"), whole.alias("t"))
    items = items.where("t IS NOT NULL").withColumn("k", F.sha2(F.to_json(F.struct("q", "a", "t")), 256))
    different = items.groupBy("k").agg(*[F.min(c).alias(c) for c in "qat"], F.count(F.lit(1)).alias("n"))
    shards = shards_of(land(different, f"{base}/items"), base)
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    deal = F.lit(max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PART)))
    # Dealt row by row, whatever the ids and texts are.
    texts = rows.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), deal))
    texts = texts.select("part", F.lit(-1).cast("long").alias("shard"), "d", "r", "text", F.lit(None).cast("binary").alias("ix"))
    spread = shards.select(F.explode(F.sequence(F.lit(0).cast("long"), deal.cast("long") - 1)).alias("part"), "shard",
                           *[F.lit(None).cast(t).alias(c) for c, t in (("d", "long"), ("r", "long"), ("text", "string"))], "ix")
    found = (texts.unionByName(spread).repartition("part").sortWithinPartitions("part", "shard")
             .mapInArrow(_scan(threshold, overlap), SCHEMA).withColumnRenamed("item", "k"))
    return found.join(items.select("k", F.col("id").alias("item")), "k").select(*NAMES)


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    bad = land(leaks(docs, benchmark, id_col, text_col).select("d", "r").distinct(), f"{run_dir(docs.sparkSession, 'leaks')}/rows")
    return docs.join(bad, same_row(docs, id_col, text_col, bad), "left_anti")

