"""Repeated windows: which fixed-length windows also start in a document with a smaller id.

Sending every window would multiply the text. Instead every window points to one of its
own positions, its anchor, chosen by the window's content alone (the operator's method
decides how), so equal windows have equal anchors with equal keys. Then:

0. equal texts are settled as a whole: all but the smallest document lose everything;
1. keys held by one text only are dropped (``keycount``): their windows cannot repeat;
2. the windows that share an anchor are consecutive; they and the text they cover are one
   *reach*. Equal reaches are grouped by a 128-bit fingerprint: all but the smallest
   document lose all their windows at once, however large the group;
3. of the smallest documents, windows whose anchor key also has another reach are grouped
   one by one, by their own 128-bit fingerprint.

A window of the smallest document of a reach can only repeat in an earlier document of
another reach with the same key, whose smallest document has it too; so 2 and 3 find all.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import Fingerprints, Tokens, drop, land, release, run_dir, text_chunks
from finpanel.llm.keycount import shared_keys


@dataclass(frozen=True)
class Scheme:
    """``tokens`` cuts texts; ``anchors`` gives, for each window start of the chunk (also
    those that cross documents, whose value is of no account), anchor position and key."""

    window: int
    tokens: Callable[[list], Tokens]
    anchors: Callable[[Tokens, int], tuple[np.ndarray, np.ndarray]]
    #: (tokens, first, last, anchor) of reaches -> (which reach, key, first, last) of their parts
    #: with a longer key each, again by the windows' content alone; None: as they are.
    refine: Callable | None = None


def starts_of(t: Tokens, window: int) -> np.ndarray:
    """True at each token where a whole window of one document starts (length: tokens - window + 1)."""
    n = len(t.value) - window + 1
    ok = np.zeros(max(0, n), bool)
    if n > 0:
        left = np.repeat(t.at[1:], t.count)[:n] - np.arange(n)
        ok = left >= window
    return ok


def reaches(t: Tokens, scheme: Scheme):
    """(doc, key, first, last, anchor): runs of window starts of one document with one anchor."""
    ok = starts_of(t, scheme.window)
    if not ok.any():
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z, z, z
    at, key = scheme.anchors(t, len(ok))
    p = np.flatnonzero(ok)
    at, key = at[p], key[p]
    new = np.ones(len(p), bool)
    new[1:] = (at[1:] != at[:-1]) | (p[1:] != p[:-1] + 1)
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(p)) - 1
    return np.searchsorted(t.at, p[i], side="right") - 1, key[i], p[i], p[j], at[i]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _lengths(lists: pa.ListArray) -> np.ndarray:
    """How many values each list has; none where it is null."""
    return np.asarray(pc.fill_null(pc.list_value_length(lists), 0))


def _keys_of(scheme: Scheme):
    def keys(texts):
        doc, key, *_ = reaches(scheme.tokens(texts), scheme)
        return doc, key
    return keys


def _reach_rows(scheme: Scheme):
    def rows(batches):
        for d, r, texts, wanted in text_chunks(batches, ("keys",)):
            t = scheme.tokens(texts)
            doc, key, first, last, at = reaches(t, scheme)
            owner = np.repeat(np.arange(len(wanted)), _lengths(wanted))
            hit = _in_pairs(doc, key, owner, np.asarray(wanted.flatten()).view(np.uint64))
            doc, key, first, last, at = (x[hit] for x in (doc, key, first, last, at))
            if not len(doc):
                continue
            if scheme.refine:
                part, key, first, last = scheme.refine(t, first, last, at)
                doc, at = doc[part], at[part]
            end = last + scheme.window
            # The place of the anchor and the length are part of what is equal.
            shape = ((at - first).astype(np.uint64) << np.uint64(32)) | (end - first).astype(np.uint64)
            c = [Fingerprints(t.value, k).of(first, end) ^ (shape * np.uint64(2 * k + 3)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[doc]), pa.array(r[doc]), _signed(key), _signed(c[0]), _signed(c[1]),
                 pa.array((first - t.at[doc]).astype(np.int64)), pa.array((last - t.at[doc]).astype(np.int64))],
                names=["d", "r", "key", "c1", "c2", "first", "last"])
    return rows


def _in_pairs(doc, key, owner, wanted):
    """Which (doc, key) are among (owner, wanted)."""
    if not len(wanted):
        return np.zeros(0, np.int64)
    salt = np.uint64(0x9E3779B97F4A7C15)
    a, b = key ^ (doc.astype(np.uint64) * salt), np.sort(wanted ^ (owner.astype(np.uint64) * salt))
    return np.flatnonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a)


def _window_rows(scheme: Scheme):
    def rows(batches):
        for d, r, texts, spans in text_chunks(batches, ("spans",)):
            t = scheme.tokens(texts)
            doc = np.repeat(np.arange(len(spans)), _lengths(spans))
            first, last = (np.asarray(spans.flatten().field(c)) for c in ("first", "last"))
            n = last - first + 1
            p = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            doc = np.repeat(doc, n)
            g = p + t.at[doc]
            w = [Fingerprints(t.value, k).of(g, g + scheme.window) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(d[doc]), pa.array(r[doc]), _signed(w[0]), _signed(w[1]), pa.array(p)],
                                             names=["d", "r", "w1", "w2", "first"])
    return rows


def covered_spans(rows: DataFrame, scheme: Scheme, n_keys: float) -> DataFrame:
    """(d, r, spans): for documents of ``rows`` (d, r, text) with removed windows, the token
    ranges [first, end) that those cover (they may overlap; an end of -1 is the text's)."""
    spark = rows.sparkSession
    base = run_dir(spark, "repeats")
    texts = land(rows.where("text IS NOT NULL").select("d", "r", F.xxhash64(F.lit(1), "text").alias("x")), f"{base}/texts")
    least = land(texts.groupBy("r", "x").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most")
                 .select("r", "x", "least"), f"{base}/equal")
    equal = land(texts.join(least, ["r", "x"]).where("d > least").select("d", "r"), f"{base}/copies")
    shared = shared_keys(rows, _keys_of(scheme), n_keys, base)
    # Rows alike in both have the same keys.
    wanted = shared.join(equal, ["d", "r"], "left_anti").groupBy("d", "r").agg(F.any_value("keys").alias("keys"))
    reach = land(rows.join(wanted, ["d", "r"]).select("d", "r", "text", "keys").mapInArrow(
        _reach_rows(scheme), "d long, r long, key long, c1 long, c2 long, first long, last long"), f"{base}/reaches")
    drop(spark, f"{base}/shared")
    release(spark)
    # Aggregates are landed before they are joined back, so that both sides of a join are
    # plain shuffles: AQE can then split a reach or window that very many documents hold.
    least = land(reach.groupBy("c1", "c2").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most")
                 .select("c1", "c2", "least"), f"{base}/least")
    judged = land(reach.join(least, ["c1", "c2"], "left"), f"{base}/judged")
    drop(spark, f"{base}/reaches")
    release(spark)
    copies = judged.where("d > least").select("d", "r", "first", (F.col("last") + scheme.window).alias("end"))
    several = land(judged.groupBy("key").agg(F.min(F.struct("c1", "c2")).alias("a"), F.max(F.struct("c1", "c2")).alias("b"))
                   .where("a <> b").select("key"), f"{base}/several")
    open_ = (judged.where("least IS NULL OR d = least").join(several, "key", "left_semi")
             .groupBy("d", "r").agg(F.collect_set(F.struct("first", "last")).alias("spans")))
    windows = land(rows.join(open_, ["d", "r"]).select("d", "r", "text", "spans").mapInArrow(
        _window_rows(scheme), "d long, r long, w1 long, w2 long, first long"), f"{base}/windows")
    release(spark)
    first = land(windows.groupBy("w1", "w2").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most")
                 .select("w1", "w2", "least"), f"{base}/firsts")
    again = (windows.join(first, ["w1", "w2"]).where("d > least")
             .select("d", "r", "first", (F.col("first") + scheme.window).alias("end")))
    whole = equal.select("d", "r", F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("end"))
    out = land(copies.unionByName(again).unionByName(whole).groupBy("d", "r").agg(F.collect_set(F.struct("first", "end")).alias("spans")), f"{base}/spans")
    release(spark)
    return out


def merged(spans: pa.ListArray, size: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first, end): maximal disjoint, non-adjacent ranges of the lists of {first, end} of texts
    of ``size`` tokens each, in order."""
    text = np.repeat(np.arange(len(size)), _lengths(spans))
    first, end = (np.asarray(spans.flatten().field(c)) for c in ("first", "end"))
    whole = end < 0
    keep = ~whole | (size[text] >= window)
    text, first, end = text[keep], first[keep], np.where(whole, size[text], end)[keep]
    if not len(text):
        return text, first, end
    # Texts lie one behind the other, with a token between: no range reaches into the next text.
    base = np.cumsum(size + 1) - (size + 1)
    order = np.lexsort((first, text))
    text, lo, hi = text[order], (base[text] + first)[order], (base[text] + end)[order]
    reach = np.maximum.accumulate(hi)
    i = np.flatnonzero(np.append(True, lo[1:] > reach[:-1]))
    text, lo, hi = text[i], lo[i], reach[np.append(i[1:], len(lo)) - 1]
    return text, lo - base[text], hi - base[text]


def listed(text: np.ndarray, first: np.ndarray, end: np.ndarray, n: int) -> pa.ListArray:
    """The ranges of each of ``n`` texts as a list of {first, end}."""
    at = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(first), pa.array(end)], ["first", "end"]))
