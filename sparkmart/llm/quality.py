"""Quality rules: word statistics, and compression bands over whole texts and their chunks.

Text that repeats itself compresses too well, text without structure hardly at all.
Every text gets its zstandard ratio (bytes by compressed bytes) as a whole and for
chunks of a fixed size; a band by length class says which ratios are acceptable, since
longer texts of the same kind compress better. A text is rejected if its whole ratio
lies outside the band of its length or if more than ``bad_chunks`` of its chunks do.
Texts shorter than the first class are not judged by compression.

* A null or empty text has no words, fails the base rules and has no ratios (null).
* Equal rows get equal results; a null id stays null; an empty table gives no row.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from sparkmart.llm.common import WORD, record_batches

_WORD = re.compile(WORD)
_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Bytes that go on with a character of UTF-8.
_INSIDE = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Bands:
    """(bytes, least ratio, greatest ratio), ascending; ratios of prose lie well inside."""

    #: Measured at 256, 400, 512, 700, 1024, 2048 and 4096 bytes. Least of English legal prose: 1.19, 1.27, 1.34, 1.38,
    #: 1.48, 1.81, 2.32. Greatest of base64: 1.08, 1.15, 1.19, 1.23, 1.26, 1.30, 1.31, and of random words of letters and
    #: digits: 1.10, 1.19, 1.24, 1.28, 1.32, 1.36, 1.38. Hexadecimal digits have 1.5 to 2.0, as prose does.
    whole: tuple[tuple[int, float, float], ...] = (
        (256, 1.145, 2.4),
        (400, 1.23, 2.5),
        (512, 1.29, 2.6),
        (700, 1.33, 2.7),
        (1024, 1.40, 2.8),
        (2048, 1.55, 2.9),
        (4096, 1.60, 3.1),
        (16384, 1.60, 3.5),
        (65536, 1.60, 4.2),
    )
    chunk_bytes: int = 1024
    chunk: tuple[float, float] = (1.38, 2.8)
    #: Scripts of several bytes a character say more in a kilobyte, so the lower limits of letters do not hold for them.
    wide: float = 1.5
    wide_least: float = 1.05
    bad_chunks: float = 0.30
    level: int = 3

    def of(self, n: int) -> tuple[float, float] | None:
        """The band for so many bytes, between those of the lengths around it."""
        if n < self.whole[0][0]:
            return None
        sizes, least, most = zip(*self.whole)
        at = np.log(sizes)
        return float(np.interp(np.log(n), at, least)), float(np.interp(np.log(n), at, most))


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    repeat_percent: int = 50
    window: int = 3


def repeated_words(words: list[str], window: int) -> int:
    """Words inside windows of so many words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[str, int] = {}
    numbers = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code = numbers[:n]
    for k in range(1, window):
        # Renumbering keeps the codes exact and small however many words there are.
        code = np.unique(code * len(ids) + numbers[k : n + k], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    return len(lines) - len(set(lines))


class Compression:
    """(whole ratio, share of bad chunks, accepted) of a text's bytes."""

    def __init__(self, bands: Bands):
        self._bands, self._zstd = bands, zstandard.ZstdCompressor(level=bands.level)

    def _ratio(self, data: bytes) -> float:
        return len(data) / len(self._zstd.compress(data))

    def __call__(self, data: bytes) -> tuple[float | None, float | None, bool]:
        bands = self._bands
        if not data:
            return None, None, True
        ratio, band = self._ratio(data), bands.of(len(data))
        size, (least, most) = bands.chunk_bytes, bands.chunk
        if len(data) > bands.wide * len(data.translate(None, _INSIDE)):
            least, band = bands.wide_least, band and (bands.wide_least, band[1])
        # A rest shorter than a chunk is part of the whole ratio only.
        chunks = [self._ratio(data[a : a + size]) for a in range(0, len(data) - size + 1, size)]
        bad = sum(not least <= r <= most for r in chunks) / len(chunks) if chunks else None
        kept = (band is None or band[0] <= ratio <= band[1]) and (bad is None or bad <= bands.bad_chunks)
        return ratio, bad, kept


def judge(docs: DataFrame, limits: Limits = Limits(), bands: Bands = Bands()) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): the counts, ratios and verdicts."""
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("ratio", pa.float64()), ("bad_chunks", pa.float64())]
    )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compression = Compression(bands)

        def rows():
            for batch in batches:
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    text = text or ""
                    words = _WORD.findall(text)
                    repeats = repeated_words(words, limits.window)
                    failed = len(words) < limits.min_words or 100 * repeats > limits.repeat_percent * len(words)
                    ratio, bad, accepted = compression(text.encode())
                    yield (
                        doc_id,
                        len(words),
                        sum(map(len, words)),
                        len(_SYMBOL.findall(text)),
                        duplicate_lines(text),
                        repeats,
                        failed,
                        accepted and not failed,
                        ratio,
                        bad,
                    )

        return record_batches(rows(), schema)

    return docs.select("doc_id", "text").mapInArrow(
        judged,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, bad_chunks double",
    )
