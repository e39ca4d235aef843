"""LM scoring by logistic context mixing.

A byte is coded as its class (5 bits: the 31 most frequent case-folded bytes of all training
texts, and a rest) and then the byte within the class. Each class bit is predicted from the
last 0 to 4 classes (5 bits each, packed) and from a hash of the last 6. A first mixer joins
orders 0 to 4 in the logistic domain, with weights that a gate selects (the bit's depth, how
often the two longest contexts were seen), and an adaptive probability map refines its result;
a second, gated likewise, adds the hashed context. The byte within its class is predicted
from the class before it and that byte's case.

Everything is learned from *all* training positions:

* the byte histogram behind the classes, by one aggregate;
* a table of how often each class follows each context of 6 classes. Map tasks sort and count,
  ranges of the (scrambled) order-4 context are merged; the table is landed and grows with
  the corpus. Shorter contexts and hash slots are sums of it;
* mixing weights and refinement from that table: a training position's inputs depend on its
  context and class alone, so a row of the table stands for its n positions, each with its own
  count taken out. A Spark job over the table sums gradient and Hessian by gate (a few
  thousand numbers a task), a Newton step follows, as often as ``STEPS_OF_WEIGHTS`` says.

For scoring, orders 0 to 4 and the hashed context are laid out as two arrays that are
broadcast (bounded by their key spaces, see ``Model``); from about 2**20 contexts of 6 classes
on, several share a slot. The learned model is then fixed, so scoring does not depend on the
order of documents, nor on retries. A text is scored whole, to its end (an end symbol).

Beside it stands a base score: unigram words with add-one smoothing over the words of all
training documents (``keycount``).

Defined cases: null counts as empty (one token, the end); a null id is neither learned
from nor held out; rows that repeat an id are scored each; with no training documents all
counts are 0; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import LAST_ID, SPACE, keyed, land, public_id, release, run_dir, text_chunks, word_tokens
from finpanel.llm.keycount import bucket_count, count_keys, pack, sum_by_document, text_bytes, unpack

ORDER, HIGH, BITS = 4, 6, 5
PART_BITS, SLOT_BITS = 10, 20  # parts of the count table, slots of the hashed context
CELL_BITS = BITS * (HIGH + 1)  # a cell: order-4 context (scrambled), older classes, class
LOW_MASK = (1 << BITS * ORDER) - 1
INNER_BITS = CELL_BITS - PART_BITS
ODD = 0x9E3779B1  # a fixed odd multiplier; modulo a power of two it only scrambles
UNDO = pow(ODD, -1, LOW_MASK + 1)
SHORT = 32 * 32 * 2 * 256  # (class, class before, case before, byte)
SCORED = 1 << 19  # positions that are scored at a time
HOLD = 1 << 20  # positions, and distinct cells, that a map task holds before it merges, or sends
REST = 31
STEPS_OF_WEIGHTS, DAMPING, LONGEST_STEP = 4, 4.0, 0.5
DELTA = 0.3
STEPS = 33  # of the refinement map, over stretched probabilities -8 .. 8
GATES = 36 * BITS


@dataclass(frozen=True)
class Model:
    """At most (2**20 + 2**15 + 2**20) x 32 halves, 2**20 x 6 bytes and 2 MB."""

    classes: np.ndarray  # byte -> class
    row: np.ndarray      # scrambled order-4 context -> row of ``low``
    low: np.ndarray      # (rows, 32): stretched probability of bit 1 at each node
    low_seen: np.ndarray  # row -> how often seen, 0 to 5
    high: np.ndarray     # (slots, 32): the same from the hashed context
    high_seen: np.ndarray
    weights: np.ndarray  # of the second mixer, by gate
    log_byte: np.ndarray  # (class, class before, case before, byte) flattened: log10 P(byte | class)


def training(d: np.ndarray, folds: int, fold: int) -> np.ndarray:
    return np.array([x != LAST_ID and zlib.crc32(str(x).encode()) % folds != fold for x in d.tolist()], bool)


UPPER = np.zeros(256, bool)
UPPER[65:91] = True


def positions(texts: list, classes: np.ndarray):
    """Of every byte and end of ``texts``: row of the text, cell, cell within class."""
    pad = b"\0" * (HIGH + 1)
    data = np.frombuffer(pad[1:] + b"".join((t or b"") + pad for t in texts), np.uint8)
    c = classes[data].astype(np.uint32)
    n = len(c) - HIGH
    context = np.zeros(n, np.uint32)
    for k in range(1, HIGH + 1):
        context |= c[HIGH - k:HIGH - k + n] << np.uint32(BITS * (k - 1))
    size = np.array([len(t or b"") + 1 for t in texts], np.int64)
    keep = np.arange(int(size.sum())) + np.repeat(np.arange(len(texts)) * HIGH, size)
    context, symbol = context[keep], c[HIGH:][keep]
    spread = (context * np.uint32(ODD)) & np.uint32(LOW_MASK)
    older = BITS * (HIGH - ORDER)
    cell = (spread.astype(np.uint64) << np.uint64(older + BITS)) | (((context >> np.uint32(BITS * ORDER)) << np.uint32(BITS)) | symbol)
    before = data[HIGH - 1:-1][keep]
    byte = (((((symbol << np.uint32(5)) | (context & np.uint32(31))) << np.uint32(1)) | UPPER[before]) << np.uint32(8)) | data[HIGH:][keep]
    return np.repeat(np.arange(len(texts)), size), cell, byte


def slot_in_part(cell: np.ndarray) -> np.ndarray:
    """Slot of the hashed context among those of its part (2**(SLOT_BITS - PART_BITS))."""
    inner = (cell >> np.uint64(BITS)).astype(np.uint32) & np.uint32((1 << INNER_BITS - BITS) - 1)
    return (inner * np.uint32(ODD)) >> np.uint32(32 - (SLOT_BITS - PART_BITS))


CELL = pa.schema([("part", pa.int32()), ("cell", pa.binary()), ("n", pa.binary())])
CELL_SPEC = "part int, cell binary, n binary"
FIRST_SHORT = np.uint64(1 << CELL_BITS)  # cells from here on are those within classes, in 16 parts
SHORT_SHIFT = np.uint64(INNER_BITS - 15)


def _added(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Sums of (cell, n) lists by cell, sorted."""
    cell, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(cell, kind="stable")
    cell, n = cell[order], n[order]
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    return cell[at], np.add.reduceat(n, at) if len(at) else n


def _counted(cells: list) -> tuple[np.ndarray, np.ndarray]:
    cell = np.sort(np.concatenate(cells))
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    return cell[at], np.diff(np.append(at, len(cell)))


def _sent(cell: np.ndarray, n: np.ndarray):
    part = (cell >> np.uint64(INNER_BITS)).astype(np.int64)
    cut = np.flatnonzero(np.diff(part)) + 1
    for i, j in zip(np.append(0, cut), np.append(cut, len(cell))):
        if j > i:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((int(part[i]), pack(cell[i:j]), pack(n[i:j])), CELL)], schema=CELL)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One part: its slices are added up as they come."""
    nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    held, waiting, size = nothing, [], 0
    for b in batches:
        for i in range(b.num_rows):
            waiting.append((unpack(b.column("cell")[i].as_py(), np.uint64), unpack(b.column("n")[i].as_py(), np.int64)))
            size += len(waiting[-1][0])
            if size >= HOLD:
                held, waiting, size = _added([held, *waiting]), [], 0
    yield from _sent(*_added([held, *waiting]))


def gather_counts(rows: DataFrame, classes: np.ndarray, only) -> DataFrame:
    """(part, cell, n): counts of all training texts, a row per part with sorted cells."""

    def emit(batches):
        short = np.zeros(SHORT, np.int64)
        held, waiting, size = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
        for d, _, texts in text_chunks(batches):
            texts = [t for t, k in zip(texts, only(d)) if k]
            if texts:
                _, cell, byte = positions(texts, classes)
                short += np.bincount(byte, minlength=SHORT)
                waiting.append(cell)
                size += len(cell)
            if size >= HOLD:
                held, waiting, size = _added([held, _counted(waiting)]), [], 0
                if len(held[0]) >= HOLD:
                    yield from _sent(*held)
                    held = (held[0][:0], held[1][:0])
        if waiting:
            held = _added([held, _counted(waiting)])
        used = np.flatnonzero(short)
        yield from _sent(*held)
        yield from _sent(FIRST_SHORT + (used.astype(np.uint64) << SHORT_SHIFT), short[used])

    return rows.mapInArrow(emit, CELL_SPEC).groupBy("part").applyInArrow(_merge, CELL_SPEC)


def _tree(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of 32 classes -> counts of bit 0 and bit 1 at the 31 nodes (heap order from 1)."""
    zero, one = np.zeros((len(n), 32), np.float32), np.zeros((len(n), 32), np.float32)
    for depth in range(BITS):
        halves = n.reshape(len(n), 1 << depth, 2, 16 >> depth).sum(3)
        at = slice(1 << depth, 2 << depth)
        zero[:, at], one[:, at] = halves[:, :, 0], halves[:, :, 1]
    return zero, one


#: Bit depth of each node.
DEPTH = np.array([0] + [int(k).bit_length() - 1 for k in range(1, 32)])


def _seen(total: np.ndarray) -> np.ndarray:
    """0, 1, 2-3, 4-15, 16-127, 128 and more."""
    return np.searchsorted(np.array([0.5, 1.5, 3.5, 15.5, 127.5]), total)


def _stretch(zero, one):
    return np.log((one + np.float32(DELTA)) / (zero + np.float32(DELTA)))


def _squash(x):
    return 1 / (1 + np.exp(-np.clip(x, -15, 15)))


def newton_sums(x, gate, bit, n, w) -> np.ndarray:
    """(gates, k + k(k+1)/2): gradient and upper Hessian of the log likelihood, a row counting n times."""
    k = x.shape[1]
    p = _squash((x * w[gate]).sum(-1))
    e, v = n * (bit - p), n * p * (1 - p)
    cols = [e * x[:, a] for a in range(k)] + [v * x[:, a] * x[:, b] for a, b in zip(*np.triu_indices(k))]
    return np.stack([np.bincount(gate, c, GATES) for c in cols], 1)


def newton_step(w: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """A damped step; gates that saw little move little."""
    k = w.shape[1]
    h = np.zeros((GATES, k, k))
    i, j = np.triu_indices(k)
    h[:, i, j] = h[:, j, i] = sums[:, k:]
    step = np.linalg.solve(h + DAMPING * np.eye(k), sums[:, :k, None])[..., 0]
    return w + step / np.maximum(1, np.abs(step).max(1, keepdims=True) / LONGEST_STEP)


class Refinement:
    """An adaptive probability map: what followed at a node when the mixer was that sure."""

    def __init__(self):
        self.hit, self.all = np.zeros((32, STEPS)), np.zeros((32, STEPS))

    @staticmethod
    def step(s):
        return np.clip(np.rint((s + 8) * 2), 0, STEPS - 1).astype(int)

    def sums(self, s, node, bit, n) -> np.ndarray:
        at = node * STEPS + self.step(s)
        return np.stack([np.bincount(at, n * bit, 32 * STEPS), np.bincount(at, n, 32 * STEPS)])

    def learn(self, sums: np.ndarray):
        self.hit, self.all = sums.reshape(2, 32, STEPS)

    def refine(self, s, node):
        """The stretched mean of the mixer's probability and the map's."""
        p, k = _squash(s), self.step(s)
        p = np.clip((p + (self.hit[node, k] + 8 * p) / (self.all[node, k] + 8)) / 2, 1e-6, 1 - 1e-6)
        return np.log(p / (1 - p))


NODES = np.arange(1, 32)


class Part:
    """One part of the count table: its order-4 contexts whole, with all that follows them."""

    def __init__(self, number: int, cell: np.ndarray, n: np.ndarray):
        self.number, self.n = number, n.astype(np.float64)
        spread = (cell >> np.uint64(CELL_BITS - BITS * ORDER)).astype(np.int64)
        self.spread, self.at = np.unique(spread, return_inverse=True)
        self.context = (self.spread * UNDO) & LOW_MASK
        self.symbol = (cell & np.uint64(31)).astype(np.int64)
        self.top = np.bincount(self.at * 32 + self.symbol, self.n, 32 * len(self.spread)).reshape(-1, 32).astype(np.float32)
        self.slot = slot_in_part(cell).astype(np.int64)
        self.slots = np.bincount(self.slot * 32 + self.symbol, self.n, 32 << SLOT_BITS - PART_BITS).reshape(-1, 32).astype(np.float32)


def parts_of(batches) -> Iterator[Part]:
    for b in batches:
        for i in range(b.num_rows):
            yield Part(b.column("part")[i].as_py(), unpack(b.column("cell")[i].as_py(), np.uint64), unpack(b.column("n")[i].as_py(), np.int64))


def summed(table: DataFrame, of_part, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``of_part`` over all parts: each task sends one array of this shape."""

    def run(batches):
        total = np.zeros(shape)
        for part in parts_of(batches):
            total += of_part(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    out = np.zeros(shape)
    for r in table.mapInArrow(run, "sums binary").collect():
        out += np.frombuffer(r.sums).reshape(shape)
    return out


def _path(symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and bits on the way to each class."""
    node = np.stack([(32 | symbol) >> (BITS - d) for d in range(BITS)], 1)
    return node, np.stack([(symbol >> (BITS - 1 - d)) & 1 for d in range(BITS)], 1).astype(np.float32)


def _first_inputs(zero, one):
    """Stretched predictions of orders 0 to 4 and a bias; the gate without the depth."""
    x = [_stretch(z, o) for z, o in zip(zero, one)]
    x.append(np.full_like(x[0], 0.3))
    return np.stack(x, -1).astype(np.float32), _seen(zero[-1] + one[-1]) * 6 + _seen(zero[-2] + one[-2])


class Lower:
    """Orders 0 to 3, from the order-3 counts."""

    def __init__(self, counts: np.ndarray):
        counts = counts.reshape((32,) * ORDER)  # oldest class first, the class predicted last
        self.trees = [_tree(counts.sum(tuple(range(ORDER - 1 - k))).reshape(-1, 32).astype(np.float32)) for k in range(ORDER)]

    def at(self, context: np.ndarray) -> list[tuple]:
        return [(z, o, context & ((1 << BITS * k) - 1)) for k, (z, o) in enumerate(self.trees)]

    def all_nodes(self, context: np.ndarray, top: np.ndarray):
        """Inputs and gate of the first mixer at all nodes after each context."""
        trees = [(z[c, 1:], o[c, 1:]) for z, o, c in self.at(context)] + [tuple(t[:, 1:] for t in _tree(top))]
        x, gate = _first_inputs(*zip(*trees))
        return x, gate * BITS + DEPTH[NODES]

    def observed(self, part: Part):
        """Of each class seen after each order-4 context, bit by bit: which context, class, n; inputs, gate,
        node, bit, with one position's own count taken out."""
        i, symbol = np.nonzero(part.top)
        node, bit = _path(symbol)
        zero, one = [], []
        z4, o4 = _tree(part.top)
        for z, o, c in self.at(part.context) + [(z4, o4, np.arange(len(part.context)))]:
            c = c[i][:, None]
            zero.append(np.maximum(z[c, node] - (1 - bit), 0))
            one.append(np.maximum(o[c, node] - bit, 0))
        x, gate = _first_inputs(zero, one)
        gate = gate * BITS + np.arange(BITS)
        return i, symbol, np.repeat(part.top[i, symbol], BITS), x.reshape(-1, ORDER + 2), gate.reshape(-1), node.reshape(-1), bit.reshape(-1)


def _second_inputs(part: Part, lower: Lower, first: np.ndarray, refinement: Refinement):
    """Inputs, gate, bit and n of the second mixer, for each cell's bits."""
    i, symbol, _, x, gate, node, bit = lower.observed(part)
    s = np.zeros((len(part.context), 32, BITS), np.float32)
    s[i, symbol] = refinement.refine((x * first[gate]).sum(-1), node).reshape(-1, BITS)
    node, bit = _path(part.symbol)
    z, o = _tree(part.slots)
    slot = part.slot[:, None]
    high = _stretch(np.maximum(z[slot, node] - (1 - bit), 0), np.maximum(o[slot, node] - bit, 0))
    gate = _seen(part.slots.sum(1)[part.slot] - 1) * 6 + _seen(part.top.sum(1)[part.at] - 1)
    x = np.stack([s[part.at, part.symbol], high, np.full_like(high, 0.3)], -1).reshape(-1, 3)
    return x, (gate[:, None] * BITS + np.arange(BITS)).reshape(-1), bit.reshape(-1), np.repeat(part.n, BITS)


def _order3(batches):
    """The order-3 cells of a task's parts, as slices of 32 ranges."""
    for part in parts_of(batches):
        cell = ((part.context & ((1 << BITS * (ORDER - 1)) - 1))[:, None] * 32 + np.arange(32))
        used = part.top > 0
        yield from _sent(*_added([(cell[used].astype(np.uint64) << np.uint64(INNER_BITS - 15), part.top[used].astype(np.int64))]))


def _unpacked(rows: list, shift: int, size: int) -> np.ndarray:
    out = np.zeros(size)
    for r in rows:
        cell = unpack(bytes(r.cell), np.uint64) & np.uint64((1 << CELL_BITS) - 1)
        out[(cell >> np.uint64(shift)).astype(np.int64)] = unpack(bytes(r.n), np.int64)
    return out


LAID_OUT = "part int, spread binary, low binary, low_seen binary, high binary, high_seen binary"


def fit(table: DataFrame, classes: np.ndarray) -> Model:
    """The fixed model from the landed count table."""
    within = _unpacked(table.where(F.col("part") >= 1 << PART_BITS).collect(), INNER_BITS - 15, SHORT)  # at most 2**19 cells
    cells = table.where(F.col("part") < 1 << PART_BITS)
    order3 = cells.mapInArrow(_order3, CELL_SPEC).groupBy("part").applyInArrow(_merge, CELL_SPEC).collect()  # at most 2**20 cells
    spark = table.sparkSession
    held = spark.sparkContext.broadcast(Lower(_unpacked(order3, INNER_BITS - 15, 1 << BITS * ORDER)))  # 9 MB

    first, refinement = np.full((GATES, ORDER + 2), 0.3), Refinement()
    for _ in range(STEPS_OF_WEIGHTS):
        def one(part, w=first):
            _, _, n, x, gate, _, bit = held.value.observed(part)
            return newton_sums(x, gate, bit, n, w)
        first = newton_step(first, summed(cells, one, (GATES, (ORDER + 2) * (ORDER + 5) // 2)))

    def refined(part):
        _, _, n, x, gate, node, bit = held.value.observed(part)
        return refinement.sums((x * first[gate]).sum(-1), node, bit, n)
    got = summed(cells, refined, (2, 32 * STEPS))
    refinement.learn(got)

    second = np.tile([0.5, 0.5, 0.0], (GATES, 1))
    for _ in range(STEPS_OF_WEIGHTS):
        def two(part, w=second):
            x, gate, bit, n = _second_inputs(part, held.value, first, refinement)
            return newton_sums(x, gate, bit, n, w)
        second = newton_step(second, summed(cells, two, (GATES, 9)))

    def low_rows(lower, context, top):
        out = np.zeros((len(context), 32), np.float16)
        for i in range(0, len(context), 1 << 13):
            j = slice(i, i + (1 << 13))
            x, gate = lower.all_nodes(context[j], top[j])
            out[j, 1:] = refinement.refine((x * first[gate]).sum(-1), np.broadcast_to(NODES, gate.shape))
        return out

    def lay_out(batches):
        for part in parts_of(batches):
            high = _stretch(*_tree(part.slots)).astype(np.float16)
            values = (part.spread.astype(np.int32), low_rows(held.value, part.context, part.top), _seen(part.top.sum(1)).astype(np.uint8),
                      high, _seen(part.slots.sum(1)).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([part.number], pa.int32())] + [pa.array([v.tobytes()], pa.binary()) for v in values],
                                             names=[c.split()[0] for c in LAID_OUT.split(", ")])

    width, short3 = 1 << SLOT_BITS - PART_BITS, np.arange(1 << BITS * (ORDER - 1))
    low, low_seen = [low_rows(held.value, short3, np.zeros((len(short3), 32), np.float32))], [np.zeros(len(short3), np.uint8)]
    high, high_seen = np.zeros((1 << SLOT_BITS, 32), np.float16), np.zeros(1 << SLOT_BITS, np.uint8)
    row = (((np.arange(LOW_MASK + 1) * UNDO) & LOW_MASK) & (len(short3) - 1)).astype(np.int32)
    size = len(short3)
    for r in cells.mapInArrow(lay_out, LAID_OUT).toLocalIterator():  # the model's own arrays
        spread = np.frombuffer(r.spread, np.int32)
        row[spread] = size + np.arange(len(spread))
        size += len(spread)
        low.append(np.frombuffer(r.low, np.float16).reshape(-1, 32))
        low_seen.append(np.frombuffer(r.low_seen, np.uint8))
        at = slice(r.part * width, (r.part + 1) * width)
        high[at], high_seen[at] = np.frombuffer(r.high, np.float16).reshape(-1, 32), np.frombuffer(r.high_seen, np.uint8)
    held.unpersist()

    by = within.reshape(32, 64, 256)
    member = (classes[None, :] == np.arange(32)[:, None]).astype(float)
    flat = by.sum(1) + member * 0.05
    flat /= np.maximum(flat.sum(1, keepdims=True), 1e-9)
    p = (by + 2 * flat[:, None, :]) / (by.sum(2, keepdims=True) + 2)
    log_byte = np.log10(np.maximum(p, 1e-12)).astype(np.float32).reshape(-1)
    return Model(classes, row, np.concatenate(low), np.concatenate(low_seen), high, high_seen, second.astype(np.float32), log_byte)


def log_probabilities(m: Model, cell, byte) -> np.ndarray:
    """log10 P of each position; a context and class that occur often are worked out once."""
    order = np.argsort(cell)
    ordered = cell[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[:len(cell)]
    value = np.empty(len(cell), np.float32)
    value[order] = _class_log_probabilities(m, ordered[new])[np.cumsum(new) - 1]
    return value + m.log_byte[byte]


def _class_log_probabilities(m: Model, cell) -> np.ndarray:
    """log10 P(class) of each cell."""
    symbol = cell.astype(np.int64) & 31
    row = m.row[cell >> np.uint64(CELL_BITS - BITS * ORDER)]
    slot = (cell >> np.uint64(INNER_BITS)).astype(np.int64) << (SLOT_BITS - PART_BITS) | slot_in_part(cell)
    gate = (m.high_seen[slot].astype(np.int64) * 6 + m.low_seen[row]) * BITS
    low, high, weights = m.low.reshape(-1), m.high.reshape(-1), np.ascontiguousarray(m.weights.T)
    in_low, in_high = row.astype(np.int64) * 32, slot * 32
    out = np.zeros(len(cell), np.float32)
    for d in range(BITS):
        node, g = (32 | symbol) >> (BITS - d), gate + d
        s = weights[0].take(g) * low.take(in_low + node) + weights[1].take(g) * high.take(in_high + node) + weights[2].take(g) * np.float32(0.3)
        up = (symbol >> (BITS - 1 - d)) & 1
        s *= (1 - 2 * up).astype(np.float32)
        out -= np.log1p(np.exp(np.clip(s, -15, 15, out=s), out=s), out=s)
    return out * np.float32(1 / np.log(10))


def byte_histogram(rows: DataFrame, only) -> np.ndarray:
    """How often each byte occurs in all training texts."""

    def count(batches):
        n = np.zeros(256, np.int64)
        for d, _, texts in text_chunks(batches):
            n += np.bincount(np.frombuffer(b"".join(t or b"" for t, k in zip(texts, only(d)) if k), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256), pa.int32()), pa.array(n)], names=["byte", "n"])

    out = np.zeros(256, np.int64)
    for r in rows.mapInArrow(count, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).collect():  # 256 rows
        out[r.byte] = r.n
    return out


def byte_classes(histogram: np.ndarray) -> np.ndarray:
    """The 31 most frequent case-folded bytes get a class each (ties by byte), the others share one."""
    fold = np.arange(256)
    fold[65:91] += 32
    n = np.bincount(fold, histogram, 256)
    n[0] = 0  # the end symbol belongs to the rest
    best = sorted(np.flatnonzero(n), key=lambda b: (-n[b], b))[:REST]
    out = np.full(256, REST, np.uint8)
    for k, b in enumerate(best):
        out[fold == b] = k
    return out


def learn(rows: DataFrame, only, path: str) -> Model:
    """The model of the texts of ``rows`` (d, r, text) that ``only`` picks by d."""
    classes = byte_classes(byte_histogram(rows, only))
    return fit(land(gather_counts(rows, classes, only), path), classes)


def count_words(texts: list) -> np.ndarray:
    """Words of each text."""
    start = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
    inside = ~SPACE[np.frombuffer(b"\n" + b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)]
    return np.diff(np.searchsorted(np.flatnonzero(inside[1:] & ~inside[:-1]), start))


def score_rows(rows: DataFrame, held: Broadcast) -> DataFrame:
    """(d, r, n_bytes, words, score): the held model's log10 probability of each whole text."""

    def score(batches):
        m = held.value
        waiting, size = [], 0

        def done():
            d, r, n_bytes, words, row, cell, byte = (np.concatenate(x) for x in zip(*waiting))
            total = np.bincount(row, weights=log_probabilities(m, cell, byte), minlength=len(d))
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (d, r, n_bytes, words, total)], names=["d", "r", "n_bytes", "words", "score"])

        n = 0
        for d, r, texts in text_chunks(batches):
            row, cell, byte = positions(texts, m.classes)
            waiting.append((d, r, np.array([len(t or b"") for t in texts], np.int64), count_words(texts).astype(np.int64), row + n, cell, byte))
            n, size = n + len(d), size + len(cell)
            if size >= SCORED:
                yield done()
                waiting, size, n = [], 0, 0
        if waiting:
            yield done()

    return rows.mapInArrow(score, "d long, r long, n_bytes long, words long, score double")


def _word_keys(texts):
    t = word_tokens(texts, fold=True)
    return t.doc, t.value


def _table_sums(batches):
    for b in batches:
        n = [unpack(x, np.int64) for x in b.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([int(sum(map(len, n)))]), pa.array([int(sum(x.sum() for x in n))])], names=["v", "n"])


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    base = run_dir(spark, "context-mixing")
    rows = keyed(docs, id_col, text_col)

    def only(d):
        return training(d, folds, fold)

    held = spark.sparkContext.broadcast(learn(rows, only, f"{base}/cells"))  # bounded, see Model
    release(spark)
    scored = land(score_rows(rows, held), f"{base}/scores")
    held.unpersist()

    buckets = bucket_count(text_bytes(rows) / 12)
    words = land(count_keys(rows, _word_keys, buckets, occurrences=True, only=only), f"{base}/words")
    release(spark)
    parts = sum_by_document(rows, _word_keys, words, buckets, lambda n: np.log10(n + 1.0))
    parts = land(parts.groupBy("d", "r").agg(F.sum("hits").alias("known"), F.sum("value").alias("logs")), f"{base}/parts")
    release(spark)
    sums = words.mapInArrow(_table_sums, "v long, n long").agg(F.sum("v"), F.sum("n")).first()
    held_out = F.coalesce(F.crc32(F.col("d").cast("string").cast("binary")) % folds == fold, F.lit(False)) & (F.col("d") != LAST_ID)
    ends = scored.where(~held_out & (F.col("d") != LAST_ID)).count()
    tokens, distinct = (sums[1] or 0) + ends, (sums[0] or 0) + (ends > 0)
    # Rows that repeat id and text were summed together: each has its share.
    again = scored.groupBy("d", "r").agg(F.count(F.lit(1)).alias("rows"))
    joined = scored.join(parts.join(again, ["d", "r"]), ["d", "r"], "left")
    known = F.coalesce(F.col("known") / F.col("rows"), F.lit(0)).cast("long") + F.lit(int(ends > 0))
    n_tokens = F.col("words") + 1
    smooth = F.lit(float(np.log10(tokens + distinct + 1)))
    return joined.select(
        public_id(F.col("d")).alias("id"), held_out.alias("held_out"), n_tokens.alias("n_tokens"), known.alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.coalesce(F.col("logs") / F.col("rows"), F.lit(0.0)) + F.lit(float(np.log10(ends + 1.0))) - n_tokens * smooth).alias("base_score"),
        "score", (-F.col("score") * float(np.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"))
