"""Suffix-array dedup: depth-limited radix sort of suffixes, most significant digit first.

A suffix is ordered only through its first ``window`` bytes; suffixes that are equal that
far are one group, and the groups are exactly the repeated windows. Three digit passes,
each over the groups the one before left open:

* digit 1, ``DIGIT`` bytes, of *sampled* suffixes: a window of 50 bytes holds 26 suffixes
  with a whole digit inside; the one with the smallest digit hash stands for the window
  (equal windows choose the same). A digit that one document holds closes its group;
* digit 2, half of the other bytes, on the side of the digit where the window has them;
  windows of one sample and side are one run, and equal runs are settled as a whole;
* digit 3, the remaining suffixes through all ``window`` bytes, one by one.

No pass gathers a group: each is an aggregate by key, combined in the map tasks.

Defined cases: null counts as empty; texts shorter than the window keep every byte; a null
id orders last; rows that repeat an id never remove from one another; an empty table gives
no rows; matches never cross documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from finpanel.llm.common import LAST_ID, Fingerprints, Tokens, byte_tokens, keyed, sliding_min, text_chunks
from finpanel.llm.keycount import text_bytes
from finpanel.llm.repeats import Scheme, covered_spans, listed, merged

DIGIT = 25
_POS_BITS = np.uint64(28)


def _sampled(window: int, digit: int):
    def anchors(t: Tokens, n: int):
        """For each window start the position and hash of its smallest digit (leftmost of ties)."""
        i = np.arange(len(t.value) - digit + 1)
        h = Fingerprints(t.value).of(i, i + digit)
        low = (np.uint64(1) << _POS_BITS) - np.uint64(1)
        best = sliding_min((h & ~low) | (i.astype(np.uint64) & low), window - digit + 1)[:n]
        at = (best & low).astype(np.int64)
        return at, h[at]
    return anchors


def _longer(window: int, digit: int):
    """Half of what a window has besides the digit lies on one side of it whole: windows
    that start early enough extend the digit to the left, the others to the right."""
    more = (window - digit + 1) // 2

    def refine(t: Tokens, first, last, at):
        hashes = Fingerprints(t.value)
        left, right = np.flatnonzero(first <= at - more), np.flatnonzero(last > at - more)
        part = np.concatenate((left, right))
        key = np.concatenate((hashes.of(at[left] - more, at[left] + digit), hashes.of(at[right], at[right] + window - more)))
        lo = np.concatenate((first[left], np.maximum(first[right], at[right] - more + 1)))
        hi = np.concatenate((np.minimum(last[left], at[left] - more), last[right]))
        return part, key, lo, hi

    return refine


def scheme(window: int = 50, digit: int | None = None) -> Scheme:
    digit = digit or (window + 1) // 2
    return Scheme(window, byte_tokens, _sampled(window, digit), _longer(window, digit))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, spans (removed [first, end)), kept (bytes)."""
    s = scheme(window)
    rows = keyed(docs, id_col, text_col)
    spans = covered_spans(rows, s, text_bytes(rows) * 2 / (window - (window + 1) // 2 + 2))

    def cut(batches):
        for d, _, texts, lists in text_chunks(batches, ("spans",)):
            t = byte_tokens(texts)
            text, first, end = merged(lists, t.count, window)
            edge = np.zeros(len(t.data) + 1, np.int64)
            np.add.at(edge, t.at[text] + first, 1)
            np.add.at(edge, t.at[text] + end, -1)
            stays = np.cumsum(edge)[:-1] == 0
            at = np.concatenate(([0], np.cumsum(stays)))[t.at].astype(np.int32)
            kept = pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer(at), pa.py_buffer(t.data[stays])])
            n = len(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, mask=d == LAST_ID), pa.array(t.count), pa.array(t.count - np.diff(at)), pa.array(np.bincount(text, minlength=n)),
                 listed(text, first, end, n), kept], names=CUT_NAMES)

    return rows.join(spans, ["d", "r"], "left").mapInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<first:long,end:long>>, kept binary")


CUT_NAMES = ["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
