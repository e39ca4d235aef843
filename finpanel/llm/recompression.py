"""Substring dedup by recompression.

Words are named, then rounds alternate: runs of one symbol become one symbol, and pairs
whose left symbol falls in one half of the alphabet and whose right symbol falls in the
other become one symbol (the halves are drawn by a hash bit of symbol and round). A new
symbol's name is a fingerprint of what it stands for, so every task gives equal runs and
pairs the same name without a lookup: the naming is global. Symbols longer than the
round's limit sit out ("restricted" recompression), which bounds how far a boundary
between two symbols depends on its surroundings: ``REACH`` words to either side. So equal
substrings get the same interior symbols, and every window of 50 words has symbol
boundaries inside its interior, at most 8 words apart (inside runs, the boundaries of the
run's units serve).

Per window the interior boundary with the smallest name is its anchor; the name covers
the high-level symbols around it, out to ``REACH`` words. Names that several documents
share reveal long repeats; ``repeats`` verifies them over the whole windows.

Defined cases: a null text has no words; texts shorter than the window keep every word
(joined by single spaces); a null id orders last; rows that repeat an id never remove
from one another; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from finpanel.llm.common import LAST_ID, Fingerprints, Tokens, keyed, mix64, sliding_min, text_chunks, word_tokens
from finpanel.llm.keycount import text_bytes
from finpanel.llm.repeats import Scheme, covered_spans, listed, merged

#: The longest symbol, in words, that takes part in each pass of a run and a pair round.
LIMITS = (1, 2, 4)
#: A run round at limit x looks x words further, a pair round too; at limit 1 both are exact neighbours.
REACH = sum(2 * x for x in LIMITS)
_POS_BITS = np.uint64(28)


def _merge(start, sym, length, joined, name):
    """Symbols where ``joined`` go into the one before; ``name(first, count)`` names the others."""
    first = np.flatnonzero(~joined)
    count = np.diff(np.append(first, len(sym)))
    total = np.add.reduceat(length, first)
    return start[first], name(first, count), total


def boundaries(t: Tokens) -> np.ndarray:
    """True at each word where a symbol starts after all rounds, or a unit within a run does."""
    mark = np.zeros(len(t.value), bool)
    if not len(mark):
        return mark
    start, sym, length = np.arange(len(mark)), t.value, np.ones(len(mark), np.int64)
    opens = np.zeros(len(mark) + 1, bool)
    opens[t.at] = True
    for level, limit in enumerate(LIMITS):
        # Runs of one symbol.
        free = (length <= limit) & ~opens[start]
        joined = np.zeros(len(sym), bool)
        joined[1:] = (sym[1:] == sym[:-1]) & free[1:] & (length[:-1] <= limit)
        mark[start[joined]] = True
        start, sym, length = _merge(start, sym, length, joined, lambda i, n: np.where(
            n > 1, mix64(sym[i] + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)), sym[i]))
        # Pairs of a left and a right symbol.
        right = (mix64(sym + np.uint64(level + 1)) >> np.uint64(63)).astype(bool)
        short = length <= limit
        joined = np.zeros(len(sym), bool)
        joined[1:] = right[1:] & ~right[:-1] & short[1:] & short[:-1] & ~opens[start[1:]]
        nxt = np.append(sym[1:], np.uint64(0))
        start, sym, length = _merge(start, sym, length, joined, lambda i, n: np.where(
            n > 1, mix64(sym[i] * np.uint64(0x9E3779B97F4A7C15) + nxt[i]), sym[i]))
    mark[start] = True
    return mark


def _revealing(window: int):
    def anchors(t: Tokens, n: int):
        """For each window start the interior boundary of smallest name, and that name."""
        size = len(t.value)
        i = np.flatnonzero(boundaries(t))
        i = i[(i >= REACH) & (i + REACH <= size)]
        name = np.full(size, np.iinfo(np.uint64).max, np.uint64)
        name[i] = Fingerprints(t.value).of(i - REACH, i + REACH)
        low = (np.uint64(1) << _POS_BITS) - np.uint64(1)
        place = (name & ~low) | (np.arange(size, dtype=np.uint64) & low)
        best = sliding_min(place[REACH:], window - 2 * REACH + 1)[:n]
        at = (best & low).astype(np.int64)
        return at, name[at]
    return anchors


def scheme(window: int = 50) -> Scheme:
    if window < 2 * REACH + 17:
        raise ValueError(f"windows of fewer than {2 * REACH + 17} words have no interior symbol for certain")
    return Scheme(window, word_tokens, _revealing(window))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """One row per input row: id, n_words, n_removed, spans (removed word ranges [first, end)), kept (bytes)."""
    rows = keyed(docs, id_col, text_col)
    spans = covered_spans(rows, scheme(window), text_bytes(rows) / 60)

    def cut(batches):
        for d, _, texts, lists in text_chunks(batches, ("spans",)):
            words = [(text or b"").split() for text in texts]  # bytes.split() cuts at the six ASCII whitespace bytes
            size, n = np.array([len(w) for w in words], np.int64), len(words)
            text, first, end = merged(lists, size, window)
            at = np.searchsorted(text, np.arange(n + 1))
            kept = [b" ".join([w for a, b in zip([0, *end[i:j]], [*first[i:j], len(one)]) for w in one[a:b]]) for one, i, j in zip(words, at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d, mask=d == LAST_ID), pa.array(size), pa.array(np.bincount(text, end - first, n).astype(np.int64)), listed(text, first, end, n),
                 pa.array(kept, pa.binary())], names=CUT_NAMES)

    return rows.join(spans, ["d", "r"], "left").mapInArrow(
        cut, "id long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept binary")


CUT_NAMES = ["id", "n_words", "n_removed", "spans", "kept"]
