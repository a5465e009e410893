"""Quality rules by compression bands (operator 1).

A text is compressed by zstandard as a whole and in fixed chunks. A ratio (bytes by compressed
bytes) above the band for its length means repetition, one below it means noise; texts too short
for a ratio to tell get no verdict. A document is rejected if its whole-text ratio is out of its
band, or if more than ``CHUNK_SHARE`` of its full chunks are out of theirs.

Defined cases: a null or empty text has no words, so n_words is 0 and base_failed is true; a null
doc_id stays null; every row is judged by itself, so equal rows get equal verdicts; an empty table
gives no row; other columns of any name are passed on (``keep_good``) or not read (``measures``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.common import query, table

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: Fixed chunk, in bytes; the rest of a text after its last full chunk counts with the whole only.
CHUNK = 4096
CHUNK_SHARE = 0.5


@dataclass(frozen=True)
class Band:
    """Ratios allowed for texts of at least ``from_bytes`` bytes."""

    from_bytes: int
    low: float
    high: float
    wide_low: float  # the low limit for texts in scripts of several bytes a character


#: Low limits stand between noise of letters and digits (ratios up to 1.09 at 256 bytes, 1.18 at 400, 1.29 at
#: 800, 1.35 at 2 KB, 1.39 beyond) and random lower-case words, denser than prose (at least 1.34, 1.45,
#: 1.57, 1.65 and 1.62). Plain prose has about 2 at 2 KB and 2.5 to 3 beyond.
#: Text in scripts of several bytes a character can be as dense as that noise: its limits are lower.
BANDS = (Band(256, 1.2, 4.0, 1.05), Band(400, 1.32, 4.0, 1.05), Band(800, 1.4, 4.0, 1.05), Band(1024, 1.4, 5.0, 1.2), Band(2048, 1.45, 5.0, 1.2),
         Band(8192, 1.45, 6.0, 1.3), Band(65536, 1.45, 8.0, 1.4))
CHUNK_BAND = Band(CHUNK, 1.45, 5.5, 1.25)
ASCII = bytes(range(128))
#: Share of bytes beyond ASCII from which a text counts as of such a script.
WIDE_SHARE = 0.25


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words in windows that the list holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    if n > 100_000:
        return _repeated_words_long(words, window)
    grams = list(zip(*(words[k:] for k in range(window)), strict=False))
    if len(set(grams)) == n:
        return 0
    count, covered, end = Counter(grams), 0, 0
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered += i + window - max(i, end)
            end = i + window
    return covered


def _repeated_words_long(words: list, window: int) -> int:
    """The same over ranks in numpy, in memory that is a few integers a word."""
    number: dict = {}
    base = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    gram = base
    for k in range(1, window):
        pair = gram[: len(base) - k] * np.int64(len(number)) + base[k:]
        gram = np.unique(pair, return_inverse=True)[1]
    _, which, count = np.unique(gram, return_inverse=True, return_counts=True)
    change = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(count[which] > 1)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return int((np.cumsum(change) > 0).sum())


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    b = text.encode()
    words = b.split()
    lines = [x for x in b.split(b"\n") if x.strip()]
    return (len(words), len(text) - (len(b) - len(b.translate(None, SPACE))), len(b) - len(b.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def band_of(size: int, bands: tuple[Band, ...] = BANDS) -> Band | None:
    return next((x for x in reversed(bands) if size >= x.from_bytes), None)


def in_band(b: bytes, ratio: float, band: Band) -> bool:
    if band.wide_low <= ratio < band.low:
        return len(b.translate(None, ASCII)) >= WIDE_SHARE * len(b)
    return band.low <= ratio <= band.high


def bands_verdict(b: bytes, compress) -> tuple[float | None, int, int, bool]:
    """The whole text's ratio, full chunks, chunks out of their band, and whether the text passes."""
    band = band_of(len(b))
    if band is None:
        return None, 0, 0, True
    ratio = len(b) / len(compress(b))
    n = len(b) // CHUNK
    out = 0
    for k in range(n):
        chunk = b[k * CHUNK : (k + 1) * CHUNK]
        out += not in_band(chunk, CHUNK / len(compress(chunk)), CHUNK_BAND)
    return ratio, n, out, in_band(b, ratio, band) and out <= CHUNK_SHARE * n


def _judge(texts: list[str | None]) -> Iterator[tuple]:
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    for text in texts:
        text = text or ""
        base = base_measures(text)
        failed = base[0] < MIN_WORDS or 100 * base[4] > MAX_REPEATED_PERCENT * base[0]
        ratio, chunks, out, passes = bands_verdict(text.encode(), compress)
        yield *base, failed, ratio, chunks, out, passes and not failed


MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
            "ratio double, n_chunks long, n_chunks_out long, kept boolean")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base measures, the ratio, and the verdict ``kept``."""
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in MEASURES.split(", "))]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_judge(batch.column(1).to_pylist()))
            cols = list(zip(*rows, strict=True)) or [[]] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True))], ["doc_id", *(n for n, _ in fields)])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(judge, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns as they are."""
    at = docs.columns.index(text_col)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([r[-1] for r in _judge(batch.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(good, docs.schema)


@query
def op1_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(table(spark, sf_dir, "documents"))
