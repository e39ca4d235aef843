"""Language ID by compression.

Per language a raw-content zstandard dictionary is built from a bounded sample of labelled
texts. A text, letters only and lower-cased, is compressed in blocks with each language's
dictionary; the language with the smallest total wins. The score is the relative margin to
the runner-up, 1 - best / second. Sizes of short texts tie to the byte; so where the margin
is below ``margin``, the text is compressed again behind each piece of each dictionary, in
one frame, and what it adds, over all pieces, is compared the same way: matches and letter
frequencies then count by fractions of a byte. Still below ``margin``, it is rejected as
narrow (with the first language and score).

Learning (``learn``): about ``SAMPLE_ROWS`` rows per language, chosen by a hash of the id,
give one excerpt of ``EXCERPT`` characters each, up to ``DICT_BYTES`` in all. The label
set itself is taken to be small (its dictionaries are held by every task: 32 KiB each).

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected;
equal sizes go to the language with more labelled rows, then by name; rows without a label
or id are classified but not learned from; with no learned language all are ``und``; with
one, the score is 1; every input row gives one row; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finpanel.llm.common import fresh

SAMPLE_ROWS, EXCERPT, DICT_BYTES = 150, 600, 32 << 10
LEVEL, BLOCK = 6, 1024
#: Bytes of dictionary in front of a narrow text, at a time.
PIECE = 2048
MARGIN = 0.004
LETTER = re.compile(r"[^\W\d_]")
#: ASCII letters and all bytes of longer characters stay; every other byte is a space.
LETTERS_ONLY = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
RESULT = "lang string, score double, rejected boolean"


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def prepared(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(LETTERS_ONLY)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, bytes]]:
    """(language, dictionary), most rows first. One aggregate and one filtered scan."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, SAMPLE_ROWS / n)])
    draw = F.xxhash64(F.lit(7), F.col(id_col))
    # Where the excerpt begins is drawn, too.
    begin = F.pmod(F.xxhash64(F.lit(8), F.col(id_col)), F.greatest(F.length(text_col) - EXCERPT, F.lit(1)))
    picked = (rows.where(F.pmod(draw, F.lit(1 << 20)) / (1 << 20) < F.element_at(share, F.col(lang_col)))
              .select(F.col(lang_col).alias("lang"), draw.alias("draw"),
                      F.col(text_col).substr((begin + 1).cast("int"), F.lit(EXCERPT)).alias("text")).collect())
    out = []
    for lang in sorted(counts, key=lambda k: (-counts[k], k)):
        texts = [prepared(r.text) for r in sorted((r for r in picked if r.lang == lang), key=lambda r: (r.draw, r.text))]
        out.append((lang, b" ".join(texts)[:DICT_BYTES]))
    return out


def classify(text: Column, learned: list[tuple[str, bytes]], margin: float = MARGIN) -> Column:
    """struct(lang, score, rejected) of whole texts."""

    @F.pandas_udf(RESULT)
    def smallest(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coders = []
        for lang, content in learned:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
            if d is not None:
                d.precompute_compress(level=LEVEL)
            coders.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                          write_content_size=False, write_dict_id=False)))
        plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False)
        pieces = [[(p, len(plain.compress(p))) for p in (content[i:i + PIECE] for i in range(0, max(len(content), 1), PIECE))]
                  for _, content in learned]

        def added(blocks, k):
            """Bytes that the blocks add to a piece of dictionary k, on average."""
            return sum(len(plain.compress(p + b)) - n for b in blocks for p, n in pieces[k]) / len(pieces[k])

        for texts in parts:
            out = []
            for text in texts:
                if text is None or not coders or not LETTER.search(text):
                    out.append(("und", 0.0, True))
                    continue
                data = prepared(text)
                blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
                sizes = [(sum(len(c.compress(b)) for b in blocks), k) for k, (_, c) in enumerate(coders)]
                sizes.sort()
                score = 1.0 if len(sizes) == 1 else 1.0 - sizes[0][0] / sizes[1][0]
                best = sizes[0][1]
                if score < margin:
                    finer = sorted((max(added(blocks, k), 1.0), k) for k in range(len(coders)))
                    if 1.0 - finer[0][0] / finer[1][0] >= margin:
                        score, best = 1.0 - finer[0][0] / finer[1][0], finer[0][1]
                out.append((coders[best][0], score, score < margin))
            yield pd.DataFrame(out, columns=["lang", "score", "rejected"])

    return smallest(text)


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` with a column struct(lang, score, rejected): ``language``, with underscores where that is taken."""
    return docs.withColumn(fresh(docs, "language"), classify(F.col(text_col), learn(labelled, id_col, text_col, lang_col)))
