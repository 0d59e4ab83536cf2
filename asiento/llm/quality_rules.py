"""Quality rules: compression bands.

A text is compressed with zstandard twice: as a whole, and in chunks of a fixed number of
bytes. Text that shrinks too much repeats itself; text that hardly shrinks is not language.
What is too much depends on the length and the script, so each length band has limits of its own. The
counts that are reported next to the verdict (words, symbols, repeated lines and windows)
are taken over whole texts.

Everything is a function of one text: one pass, no shuffle. Very long texts are taken whole, one at a time.

Defined results: a NULL or empty text has no words and fails the base rule; copies of a row
are judged alike; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes that go on a code point
FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "whole_ratio double, n_chunks bigint, n_low_chunks bigint, n_high_chunks bigint, "
    "base_failed boolean, kept boolean"
)


@dataclass(frozen=True)
class Band:
    """Ratios (compressed to plain bytes) allowed for texts of at least ``min_bytes``.

    Upper limits by bytes a code point: ``highest`` up to ``Bands.plain``, ``mixed`` up to ``Bands.wide``, ``wide`` above.
    """

    min_bytes: int
    lowest: float
    highest: float
    mixed: float
    wide: float


@dataclass(frozen=True)
class Bands:
    """Limits by length, longest band first.

    Short texts carry the compressor's fixed cost, so below 128 bytes nothing is rejected. A code point of several
    bytes says more than a letter, so scripts such as Chinese shrink less. The upper limits lie above all cuts of a
    band's least length of licence texts and message catalogues in some 200 languages, by 0.01 at least. Where language and
    random words overlap, both stay: random base64 is rejected from 1024 bytes on, letters and digits from
    2048, letters from 4096, hex digits from 8192.
    A text is rejected if the whole is outside its band, or if more than ``chunk_share`` of
    its chunks are outside the band of their own length.
    """

    whole: tuple[Band, ...] = (
        Band(12288, 0.22, 0.475, 0.48, 0.55), Band(8192, 0.22, 0.515, 0.52, 0.59), Band(4096, 0.22, 0.55, 0.56, 0.67), Band(3072, 0.25, 0.59, 0.59, 0.70),
        Band(2048, 0.25, 0.615, 0.645, 0.74), Band(1536, 0.32, 0.645, 0.67, 0.79), Band(1024, 0.32, 0.70, 0.75, 0.85),
        Band(768, 0.32, 0.75, 0.82, 0.88), Band(512, 0.32, 0.83, 0.85, 0.94), Band(384, 0.36, 0.87, 0.90, 0.99),
        Band(256, 0.36, 0.90, 0.93, 1.04), Band(192, 0.36, 0.95, 0.98, 1.08), Band(128, 0.36, 1.01, 1.05, 1.10),
    )
    plain: float = 1.06
    wide: float = 1.3
    chunk_bytes: int = 4096
    chunk_share: float = 0.5
    level: int = 3

    def judge(self, n_bytes: int, ratio: float, n_chars: int | None = None) -> int:
        """-1: repeats itself, 1: does not compress, 0: inside the band or too short to tell."""
        width = n_bytes / (n_chars or n_bytes or 1)
        for band in self.whole:
            if n_bytes >= band.min_bytes:
                highest = band.highest if width <= self.plain else band.mixed if width <= self.wide else band.wide
                return -1 if ratio < band.lowest else int(ratio > highest)
        return 0


def _repeat_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that are found twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    distinct = int(ids.max()) + 1
    pairs = ids[:-1] * distinct + ids[1:]
    if distinct > 1 << 20:  # three ids don't fit 63 bits: number the pairs first
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:n] * distinct + ids[2:]
    inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)[1:]
    repeated = counts[inverse] > 1
    covered = np.zeros(n + 2, dtype=bool)
    for shift in range(3):
        covered[shift : shift + n] |= repeated
    return int(covered.sum())


def measure(text: str | None, bands: Bands, compress) -> tuple:
    """The values of ``FIELDS`` for one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [line for line in data.split(b"\n") if line.strip(SPACES)]
    repeat_words = _repeat_words(ids)
    low = high = chunks = 0
    ratio = len(compress(data)) / len(data) if data else 1.0
    if len(data) > bands.chunk_bytes:
        for start in range(0, len(data), bands.chunk_bytes):
            chunk = data[start : start + bands.chunk_bytes]
            verdict = bands.judge(len(chunk), len(compress(chunk)) / len(chunk), len(chunk.translate(None, FOLLOWING)))
            chunks, low, high = chunks + 1, low + (verdict < 0), high + (verdict > 0)
    base_failed = len(words) < 50 or 100 * repeat_words > 50 * len(words)
    rejected = bands.judge(len(data), ratio, len(text)) != 0 or low + high > bands.chunk_share * chunks
    return (
        len(words),
        len(text) - (len(data) - len(data.translate(None, SPACES))),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words, ratio, chunks, low, high, base_failed, not base_failed and not rejected,
    )


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``doc_id`` and ``FIELDS``, one row for each row of ``docs``."""
    schema = docs.select("doc_id").schema
    names = [part.split()[0] for part in FIELDS.split(", ")]
    types = [{"bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[part.split()[1]] for part in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
        for batch in batches:
            rows = [measure(t.as_py(), bands, compress) for t in batch.column(1)]
            columns = list(zip(*rows)) or [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *names])

    out = f"doc_id {schema[0].dataType.simpleString()}, {FIELDS}"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)
