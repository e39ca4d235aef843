"""Packing: ids as the tokenizer gives them, every id in one piece, no padding, the placement rule."""
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from finpanel.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab.,'1 \n\té \x1c日s!-") | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_word_by_word_is_the_tokenizer(texts):
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.words_of(PATH).ids(texts)]
    assert got == [ids_of(t) for t in texts]


def check(rows, docs, window):
    """Pieces tile documents and sequences; returns the lengths of sequences."""
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
    for doc, text in docs:
        ids = ids_of(text) + [1]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    lengths = []
    for held in seqs.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("window,block", [(64, 50), (64, 10_000), (16, 3)])
def test_pieces_tile_without_padding(docs_of, rng, window, block):
    words = ["the", " of", "Zürich,", "\n\n", "x", "12", "  ", "日本", "don't"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, " "), (203, "long words here " * 3000), (204, "a" * 5000)]
    rows = packing.pack(docs_of(docs), PATH, 1, window=window, block=block).collect()
    lengths = check(rows, docs, window)
    assert all(n == window or n & (n - 1) == 0 for n in lengths)
    blocks = len({r.sequence_id >> 34 for r in rows if r.sequence_id & 1})
    assert sum(n < window for n in lengths) <= blocks * window.bit_length() + sum(n & (n - 1) == 0 for n in lengths if n < window)


def test_sequences_hold_the_ids(docs_of, rng):
    docs = [(i, " ".join(rng.choices(["one", "two", "three."], k=rng.randrange(50)))) for i in range(40)]
    pieces = packing.pack(docs_of(docs), PATH, 1, window=32, with_ids=True)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    held = {i: ids_of(t) + [1] for i, t in docs}
    rows = pieces.collect()
    assert all(r.ids == held[r.doc_id][r.start:r.start + r.length] for r in rows)
    whole = packing.sequences(pieces, pad=0, window=32).collect()
    assert sum(len(r.ids) for r in whole) == sum(map(len, held.values()))


def test_repeats_nulls_and_empty(docs_of):
    same = [(1, "a hot text")] * 400 + [(None, "no id"), (None, None)]
    got = packing.pack(docs_of(same), PATH, 1, window=32, block=60)
    rows = got.collect()
    assert sum(r.length for r in rows) == 400 * (len(ids_of("a hot text")) + 1) + len(ids_of("no id")) + 2
    assert sum(r.length for r in rows if r.doc_id is None) == len(ids_of("no id")) + 2
    assert len({r.sequence_id >> 34 for r in rows}) > 3  # one repeated document is dealt over blocks
    assert packing.pack(docs_of(same).where("doc_id > 5"), PATH, 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs_of(same), PATH, 1, window=48)


def test_rule_is_least_sum_of_squares():
    rng = random.Random(3)
    window, levels, counts = 24, packing.Levels(24), [0] * 25
    for _ in range(600):
        size = rng.randrange(1, 24)

        def squares(h):
            c = list(counts)
            if h:
                c[h] -= 1
            if h + size < window:
                c[h + size] += 1
            return sum(x * x for x in c[1:window])
        best = min([h for h in range(0, window - size + 1) if h == 0 or counts[h]], key=lambda h: (squares(h), -h))
        assert levels.level(size) == best
        levels.place("x", size)
        counts = [0] + [len(levels.open[h]) for h in range(1, window)] + [0]


def test_few_documents_are_cut():
    """Sums of squares leaves few windows open, so few items are cut at the end of a block."""
    rng = random.Random(5)
    levels, cut = packing.Levels(2048), 0
    for k in range(packing.BLOCK):
        levels.place(k, min(2047, 1 + int(rng.expovariate(1 / 500))))

    def apart(item, size):
        nonlocal cut
        cut += 1
        return [((item, p), p) for p in packing.powers_of(size)]
    done = list(packing.close(levels.rest(), 2048, apart))
    assert all(sum(n for _, n in held) in (1 << b for b in range(12)) for held in done)
    assert cut < packing.BLOCK * 0.1


def test_new_words_are_encoded_as_one_text():
    """The words of a batch cost one call with one text, whatever their number; ids are the tokenizer's."""
    words, sent = packing.Words(PATH), []
    encoder = words.encoder

    class Counted:
        encode = encoder.encode

        def encode_batch_fast(self, texts, **kw):
            sent.append(len(texts))
            return encoder.encode_batch_fast(texts, **kw)

    words.encoder = Counted()
    texts = [" ".join(f"word{7 * i + k}," for k in range(7)) for i in range(60)]
    assert [np.frombuffer(b, "<u4").tolist() for b in words.ids(texts)] == [ids_of(t) for t in texts]
    assert sent == [1]


def test_added_tokens_that_take_spaces(tmp_path):
    from tokenizers import AddedToken
    own = Tokenizer.from_file(PATH)
    own.add_tokens([AddedToken("<x>", lstrip=True, rstrip=False)])
    own.save(str(tmp_path / "own.json"))
    words = packing.Words(str(tmp_path / "own.json"))
    texts = ["a <x> b", "some plain words", "<x> <x> c"]
    assert [np.frombuffer(b, "<u4").tolist() for b in words.ids(texts)] == [own.encode(t, add_special_tokens=False).ids for t in texts]
