"""Sum-of-squares packing of token sequences into training windows.

Every document is encoded once by a public tokenizer and closed with an end id. What fills
whole windows is cut off in front; the rest of each document (shorter than a window) is an
item of the packing. Items are dealt evenly into blocks by a hash of their place in the
landed pieces, and a block places its items one by one, in that hash's order: into a new
window or the fill level of an open one, whichever leaves the least sum of squared counts of
partially filled windows. A level array holds the counts, so that a placement costs one
vector operation, whatever the number of windows.

When a block ends, its open windows are closed without padding. The emptiest are taken apart:
their documents are cut at the powers of two of their length, and these pieces fill the gaps
of the fullest. What is left at last are powers of two; in descending order they fill whole
windows and then sequences of a power of two each, fewer than the window has bits. So a block
of any size is padded by nothing, and only documents of its last windows are cut.

Text is read once; what is landed and shuffled is one row of numbers per piece (and its ids
only on request). All pieces of one document share no task: blocks are independent, their
size is fixed, and one document that a third of all rows repeat is dealt over all blocks.

Null text is empty and has only the end id. A null document id stays null; rows that repeat an
id are documents of their own. An empty table gives no rows. Other columns are never read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import land, run_dir

WINDOW = 2048
#: Items that one task packs, about.
BLOCK = 16_384
#: Words of a generation: a worker keeps the ids of the words of this one and the one before
#: (about 250 bytes a word).
KNOWN_WORDS = 1 << 20

#: A space between two characters that are none: byte-level pre-tokenizers always cut there.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


class Words:
    """Ids of texts, word by word. A text falls apart at every single space into words that a
    byte-level tokenizer encodes independently of each other, so a word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        vocabulary = self.encoder.get_vocab()
        #: Ids whose token begins with a space (as byte-level tokens write it).
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def plain(self, text: str) -> bytes:
        return array("I", self.encoder.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, words) -> None:
        """Ids of words that follow a space; None if a white space at an end makes the cut unsafe."""
        known, older, new = self.known, self.older, []
        for w in words:
            if w in older:
                known[w] = older[w]
            elif not w or w != w.strip():
                known[w] = None
            else:
                new.append(w)
        if not new:
            return
        # Encoded as one text: a word holds no space, so its ids begin where a token opens with one.
        ids = np.asarray(self.encoder.encode_batch_fast([" " + " ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        at = np.flatnonzero(self.opens[ids])
        if len(at) == len(new) and not at[0]:
            data, at = ids.tobytes(), np.append(at, len(ids)) * 4
            at = at.tolist()
            known.update(zip(new, [data[i:j] for i, j in zip(at, at[1:])]))
        else:  # a tokenizer whose added tokens take spaces
            for w, e in zip(new, self.encoder.encode_batch_fast([f" {w}" for w in new], add_special_tokens=False)):
                known[w] = array("I", e.ids).tobytes()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of every text, as little-endian unsigned 32-bit numbers."""
        for lo in range(0, len(texts), 64):
            some = texts[lo:lo + 64]
            split = [t.split(" ") for t in some]
            new = set()
            for words in split:
                new.update(words[1:])
            if len(self.known) > KNOWN_WORDS:
                self.older, self.known = self.known, {}
            self.learn(new.difference(self.known))
            for text, words in zip(some, split):
                yield self._joined(text, words)

    def _joined(self, text: str, words: list[str]) -> bytes:
        if not text:
            return b""
        if words[0] and not words[0][-1].isspace():
            try:
                return self.plain(words[0]) + b"".join(map(self.known.__getitem__, words[1:]))
            except TypeError:  # a word without ids
                pass
        words = SAFE_CUT.split(text)
        # A piece may hold double spaces: those are encoded as they stand.
        return self.plain(words[0]) + b"".join([self.known.get(w) or self.plain(f" {w}") for w in words[1:]])


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def powers_of(length: int) -> list[int]:
    """The powers of two that make up ``length``, largest first."""
    return [1 << b for b in reversed(range(length.bit_length())) if length >> b & 1]


def _pieces(path: str, window: int, end: int, with_ids: bool):
    """Documents -> pieces: whole windows and the rest, with the checksums of the parts it may be cut into."""
    def run(batches):
        words, task, k = words_of(path), TaskContext.get().partitionId(), 0
        close = np.asarray([end], "<u4").tobytes()
        for b in batches:
            ids = b.column("id").to_pylist()
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows = []
            for doc, data in zip(ids, words.ids(texts)):
                data += close
                n = len(data) // 4
                for start in range(0, n, window):
                    piece = data[4 * start:4 * (start + window)]
                    length, at, parts = len(piece) // 4, 0, []
                    for p in powers_of(length) if length < window else ():  # whole windows are never cut
                        parts.append(zlib.crc32(piece[4 * at:4 * (at + p)]))
                        at += p
                    rows.append((task, k, doc, start, length, zlib.crc32(piece), n, parts, piece if with_ids else None))
                    k += 1
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


PIECE = "task long, k long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, parts array<long>, ids binary"
_ARROW = [("task", pa.int64()), ("k", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("parts", pa.list_(pa.int64())), ("ids", pa.binary())]


def _batch(rows: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _ARROW)], names=[n for n, _ in _ARROW])


class Levels:
    """Open windows by their fill, and the placement rule."""

    def __init__(self, window: int):
        self.window = window
        # Squared counts change by 2 (count[h + s] - count[h]) + 2 when an item of size s moves a window from h to h + s.
        # An empty window and a full one have no count: 1/2 and -1/2 in their place make the same formula hold.
        self.count = np.zeros(window + 1)
        self.count[0], self.count[window] = 0.5, -0.5
        self.offered = np.full(window + 1, -np.inf)  # the counts of levels that have a window, else nothing to offer
        self.offered[0] = 0.5
        self.open: list[list] = [[] for _ in range(window + 1)]

    def level(self, size: int) -> int:
        """The best fill level for an item; of equals the fullest."""
        change = (self.count[size:] - self.offered[:self.window - size + 1])[::-1]
        return self.window - size - int(change.argmin())

    def _counted(self, level: int) -> None:
        if 0 < level < self.window:
            n = len(self.open[level])
            self.count[level], self.offered[level] = n, n or -np.inf

    def place(self, item, size: int) -> list | None:
        """Put an item where it costs least; the window's items if that fills it."""
        h = self.level(size)
        held = self.open[h].pop() if h else []
        held.append((item, size))
        self._counted(h)
        if h + size == self.window:
            return held
        self.open[h + size].append(held)
        self._counted(h + size)
        return None

    def rest(self) -> list[tuple[int, list]]:
        """Open windows, the fullest first."""
        return [(h, held) for h in reversed(range(1, self.window)) for held in self.open[h]]


def close(rest: list[tuple[int, list]], window: int, cut) -> Iterator[list]:
    """Sequences without padding from the open windows ``rest`` ((fill, [(item, size)]), the fullest
    first): ``cut`` gives the (part, size) of an item, sizes being powers of two."""
    parts: dict[int, list] = {1 << b: [] for b in range(window.bit_length())}

    def take_apart(held: list) -> None:
        for item, size in held:
            for part, n in cut(item, size):
                parts[n].append(part)

    lo, hi = 0, len(rest) - 1
    while lo <= hi:
        fill, held = rest[lo]
        lo += 1
        if fill & (fill - 1) == 0:
            yield held
            continue
        while fill < window:
            size = next((n for n in powers_below(window - fill) if parts[n]), 0)
            if size:
                held.append((parts[size].pop(), size))
                fill += size
            elif lo <= hi:
                take_apart(rest[hi][1])
                hi -= 1
            else:
                break
        if fill == window:
            yield held
        else:
            take_apart(held)
    left = [(p, n) for n in sorted(parts, reverse=True) for p in parts[n]]
    total, at = sum(n for _, n in left), 0
    bounds = [window] * (total // window) + powers_of(total % window)
    for bound in bounds:
        held, fill = [], 0
        while fill < bound:
            held.append(left[at])
            fill += left[at][1]
            at += 1
        yield held


def powers_below(most: int) -> Iterator[int]:
    n = 1 << most.bit_length() - 1
    while n:
        yield n
        n >>= 1


def _block(window: int):
    """Items of a block -> (task, k, part's start and length, checksum, sequence, offset)."""
    def run(key, table):
        block = key[0].as_py()
        task, k, length = (np.asarray(table.column(c).combine_chunks()) for c in ("task", "k", "length"))
        order = np.lexsort((k, task, np.asarray(table.column("h").combine_chunks())))
        crc, parts = table.column("ids_crc32").to_pylist(), table.column("parts").to_pylist()
        levels, done = Levels(window), []
        # An item is (row, start in the piece, checksum).
        for row in order.tolist():
            full = levels.place((row, 0, crc[row]), int(length[row]))
            if full:
                done.append(full)

        def cut(item, size):
            row, start, _ = item
            if size & (size - 1) == 0:
                return [(item, size)]
            out, at = [], 0
            for p, c in zip(powers_of(size), parts[row]):
                out.append(((row, at, c), p))
                at += p
            return out
        done.extend(close(levels.rest(), window, cut))
        rows = []
        for j, held in enumerate(done):
            at = 0
            for (row, start, c), size in held:
                rows.append((row, start, size, c, (block << 34) + 2 * j + 1, at))
                at += size
        row, start, size, c, seq, at = (np.asarray(x, np.int64) for x in zip(*rows))
        return pa.table({"task": task[row], "k": k[row], "doc_id": table.column("doc_id").combine_chunks().take(pa.array(row)),
                         "start": np.asarray(table.column("start").combine_chunks())[row] + start, "length": size, "ids_crc32": c,
                         "doc_tokens": np.asarray(table.column("doc_tokens").combine_chunks())[row], "sequence_id": seq, "offset": at})
    return run


PLACED = "task long, k long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, end: int, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         block: int = BLOCK, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of every piece.

    ``tokenizer`` is the file of a byte-level tokenizer, found under the same path on every executor; ``end`` closes a document. With
    ``with_ids`` the pieces carry their ids (array<int>). ``window`` is a power of two."""
    if window & (window - 1):
        raise ValueError("the window's length is a power of two")
    path = run_dir(docs.sparkSession, "packing")
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    pieces = land(texts.mapInArrow(_pieces(tokenizer, window, end, with_ids), PIECE), f"{path}/pieces")
    whole = pieces.where(F.col("length") == window).select(
        "task", "k", "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.shiftleft(F.col("task"), 34) + 2 * F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    items = pieces.where(F.col("length") < window)
    blocks = -(-items.count() // block)
    if blocks:
        h = F.xxhash64("task", "k")
        dealt = items.drop("ids").withColumns({"h": h, "block": F.pmod(h, F.lit(blocks)).cast("long")})
        whole = whole.unionByName(land(dealt.groupBy("block").applyInArrow(_block(window), PLACED), f"{path}/placed"))
    if with_ids:
        held = pieces.select("task", "k", F.col("start").alias("piece"), F.col("ids").alias("data"))
        data = F.expr("substring(data, cast(4 * (start - piece) + 1 as int), cast(4 * length as int))")
        whole = whole.join(held, ["task", "k"]).withColumn("ids", _numbers(data)).drop("piece", "data")
    return whole.drop("task", "k")


def _numbers(data):
    """Little-endian 32-bit numbers of a binary column, as array<int>."""
    word = F.hex(data)
    byte = [lambda i, o=o: F.substring(word, (8 * i + 2 * o + 1).cast("int"), F.lit(2)) for o in (3, 2, 1, 0)]
    n = F.octet_length(data) / 4
    return F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.conv(F.concat(*[f(i) for f in byte]), 16, 10).cast("int"))


def sequences(pieces: DataFrame, pad: int, window: int = WINDOW) -> DataFrame:
    """(sequence_id, ids) of pieces that carry their ids: padded to the window except at a power of two."""
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    ids = F.flatten(F.transform("held", lambda x: x["ids"]))
    n = F.size("ids")
    short = n.bitwiseAND(n - 1) != 0
    return held.select("sequence_id", ids.alias("ids")).withColumn(
        "ids", F.when(short, F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - n))).otherwise(F.col("ids")))
