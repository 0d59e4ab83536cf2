"""Exact substring dedup by prefix-free parsing.

A byte goes if it lies in a string of ``length`` bytes that also starts somewhere else, in any
text. Texts are parsed into phrases. Every window of ``length`` bytes has a trigger:
the ``trigger``-byte string in it with the least rolling hash, leftmost among equals. Windows in a row with the
same trigger form a phrase, which runs from the first one's start to the last one's end. So
trigger and phrase depend on content alone, wherever it stands, every window lies in one phrase, and equal
windows lie in phrases with equal triggers.

* The dictionary is the set of distinct phrases whose trigger is found twice or more. A text of
  its own has no such phrase, and is done.
* Phrases found twice or more repeat as a whole: this settles the inside of repeated text.
* Where one trigger has several phrases (the edges of repeated text), the suffixes of the dictionary's phrases
  are compared to the depth of ``length`` bytes: one representative of each distinct phrase gives
  the hash of each of its windows, and a window is repeated if two distinct phrases have it.

Only equality to a fixed depth is asked for, so runs of equal suffixes are formed by hash, and the order
between unequal suffixes, which would take eight bytes or more for each byte of text, is not made.

Which triggers are found twice, and which occurrences represent a phrase, is passed to the next
scan as a bitmap of fixed size. It may let more through, never less, and exact joins and
counts follow. Each scan is a function of the rows, so a lost task can run again.

Hashes have 64 bits. Texts are treated as UTF-8 bytes; matches never cross texts.

Defined results: NULL and empty texts, and texts shorter than ``length``, lose nothing; rows that
are copies lose all that is ``length`` bytes or longer, each of them. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asiento.llm.tables import write_shared

U = np.uint64


@dataclass(frozen=True)
class Parameters:
    length: int = 200  # bytes of a repeated string
    trigger: int = 140  # bytes of a trigger
    piece: int = 1 << 20  # windows that are looked at together; at most 2^22
    bits: int = 1 << 27  # of a bitmap that every task holds


@lru_cache(1)
def _tables(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of the bytes, and powers of the base and of its inverse modulo 2^64."""
    values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
    base = 0x9E3779B97F4A7C15
    powers, inverse = np.full(size, base, U), np.full(size, pow(base, -1, 2**64), U)
    powers[0] = inverse[0] = 1
    return values, np.cumprod(powers, dtype=U), np.cumprod(inverse, dtype=U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(29))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


@dataclass
class Phrases:
    """The phrases of some texts, as arrays."""

    row: np.ndarray  # which text
    start: np.ndarray  # of the first window in the text
    windows: np.ndarray  # how many
    trigger: np.ndarray  # hash
    phrase: np.ndarray  # hash
    _first: np.ndarray  # of the first window in the piece
    _sums: np.ndarray
    _p: Parameters

    def window_hashes(self, n: int) -> np.ndarray:
        at = np.arange(self._first[n], self._first[n] + self.windows[n])
        inverse = _tables(_room(self._p))[2]
        return _mix((self._sums[at + self._p.length] - self._sums[at]) * inverse[at]).view(np.int64)


def _room(p: Parameters) -> int:
    return 2 * (p.piece + p.length) + 1


def _parse(pieces: list[tuple[int, int, bytes]], p: Parameters) -> Phrases:
    values, powers, inverse = _tables(_room(p))
    data = np.frombuffer(b"".join(d for _, _, d in pieces), np.uint8)
    n = len(data)
    sums = np.zeros(n + 1, U)
    np.cumsum(values[data] * powers[:n], out=sums[1:])

    def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (sums[b] - sums[a]) * inverse[a]

    k = p.trigger
    grams = _mix((sums[k:] - sums[:-k]) * inverse[: n - k + 1])
    # The least hash of each window; the position below it decides for the leftmost.
    least = (grams >> U(24) << U(24)) | np.arange(len(grams), dtype=U)
    span, wide = p.length - k + 1, 1
    while 2 * wide <= span:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    windows = n - p.length + 1
    least = np.minimum(least[:windows], least[span - wide : span - wide + windows])

    sizes = np.array([len(d) for _, _, d in pieces])
    begins = np.cumsum(sizes) - sizes
    edge = np.zeros(n + 1, np.int32)
    edge[begins] += 1
    np.add.at(edge, begins + sizes - p.length + 1, -1)
    inside = np.flatnonzero(np.cumsum(edge)[:windows])  # windows within one text
    place = (least[inside] & U(0xFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(place)) + 1  # windows of two texts share no place
    first, last = inside[np.append(0, new)], inside[np.append(new, len(place)) - 1]
    place = place[np.append(0, new)]
    shape = (place - first).astype(U) * U(0xD6E8FEB86659FD93) + (last - first).astype(U)
    phrase = _mix(hashes(first, last + p.length) + shape)
    piece = np.searchsorted(begins, first, side="right") - 1
    return Phrases(
        np.array([r for r, _, _ in pieces])[piece],
        np.array([o for _, o, _ in pieces])[piece] + first - begins[piece],
        last - first + 1,
        grams[place].view(np.int64),
        phrase.view(np.int64),
        first, sums, p,
    )


def parse(texts: list[bytes], p: Parameters) -> Iterator[Phrases]:
    """The phrases of each text that is long enough; a long text is parsed piece by piece."""
    held, size = [], 0
    for row, data in enumerate(texts):
        for start in range(0, len(data) - p.length + 1, p.piece):
            piece = data[start : start + p.piece + p.length - 1]
            held.append((row, start, piece))
            size += len(piece)
            if size >= p.piece:
                yield _parse(held, p)
                held, size = [], 0
    if held:
        yield _parse(held, p)


class Bitmap:
    """Which 64-bit keys may belong to a set: their low bits, in a fixed number of bytes."""

    def __init__(self, keys: DataFrame, column: str, p: Parameters):
        place = F.pmod(F.col(column), F.lit(p.bits)) + 1
        parts = keys.groupBy(F.bitmap_bucket_number(place).alias("n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b"))
        flat = np.zeros(p.bits // 8, np.uint8)
        size = 4096
        for row in parts.toLocalIterator():  # at most bits / 32768 rows of 4 KB
            flat[(row.n - 1) * size : row.n * size] = np.frombuffer(row.b, np.uint8)[: len(flat)]
        self.shared = keys.sparkSession.sparkContext.broadcast(flat.tobytes())
        self.mask = p.bits - 1

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys & self.mask
        held = np.frombuffer(self.shared.value, np.uint8)
        return (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _texts(batch: pa.RecordBatch, column: int) -> list[bytes]:
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def _slot(found: Phrases, keys: np.ndarray) -> np.ndarray:
    """Names one occurrence of a phrase."""
    return found.phrase ^ keys[found.row] ^ found.start


class Scans:
    """Scans over the texts (doc_id, row_key, text)."""

    def __init__(self, docs: DataFrame, p: Parameters):
        text = F.col("text").cast("string")
        # One number for a row and its copies keeps what is exchanged small.
        key = F.xxhash64(F.col("doc_id"), F.coalesce(text, F.lit("")))
        self.texts = docs.select("doc_id", key.alias("row_key"), text.alias("text"))
        self.id_type = self.texts.schema["doc_id"].dataType.simpleString()
        self.p = p

    def triggers(self) -> DataFrame:
        p = self.p

        def run(batches):
            for batch in batches:
                for found in parse(_texts(batch, 0), p):
                    keys, n = np.unique(found.trigger, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["t", "n"])

        return self.texts.select("text").mapInArrow(run, "t long, n long")

    def occurrences(self, column: str, wanted: Bitmap) -> DataFrame:
        """Phrases whose ``column`` (trigger or phrase) may be among those wanted."""
        p = self.p

        def run(batches):
            for batch in batches:
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                for found in parse(_texts(batch, 1), p):
                    at = np.flatnonzero(wanted.has(getattr(found, column)))
                    columns = (keys[found.row[at]], found.start[at], found.windows[at].astype(np.int32), found.trigger[at], found.phrase[at], _slot(found, keys)[at])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row_key", "start", "windows", "t", "phrase", "slot"])

        out = "row_key long, start long, windows int, t long, phrase long, slot long"
        return self.texts.select("row_key", "text").mapInArrow(run, out)

    def windows(self, representatives: Bitmap, among: Bitmap | None = None) -> DataFrame:
        """``row_key, start, window``: each window of the occurrences that represent a phrase.

        With ``among``, only windows whose hash may be in that set.
        """
        p = self.p

        def run(batches):
            for batch in batches:
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                for found in parse(_texts(batch, 1), p):
                    at = np.flatnonzero(representatives.has(_slot(found, keys)))
                    if not len(at):
                        continue
                    window = np.concatenate([found.window_hashes(n) for n in at])
                    sizes = found.windows[at]
                    owner = np.repeat(keys[found.row[at]], sizes)
                    start = np.repeat(found.start[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(window))
                    kept = among.has(window) if among else slice(None)
                    columns = (owner[kept], start[kept], window[kept])
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row_key", "start", "window"])

        return self.texts.select("row_key", "text").mapInArrow(run, "row_key long, start long, window long")

    def candidates(self, repeated: Bitmap) -> DataFrame:
        """One row for each text; ``packed`` is NULL where no phrase may repeat, and the result is known."""
        p = self.p

        def run(batches):
            pack = zstandard.ZstdCompressor(level=3).compress
            for batch in batches:
                texts = _texts(batch, 2)
                open_rows = np.zeros(len(texts), bool)
                for found in parse(texts, p):
                    open_rows[found.row[repeated.has(found.trigger)]] = True
                packed = [pack(t) if o else None for t, o in zip(texts, open_rows)]
                whole = [None if o else hashlib.sha256(t).hexdigest() for t, o in zip(texts, open_rows)]
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [batch.column(0), batch.column(1), sizes, pa.array(packed, pa.binary()), pa.array(whole, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "n_bytes", "packed", "whole_sha256"])

        return self.texts.mapInArrow(run, f"doc_id {self.id_type}, row_key long, n_bytes long, packed binary, whole_sha256 string")


def repeated_spans(docs: DataFrame, p: Parameters) -> tuple[DataFrame, DataFrame]:
    """Candidate texts, and ``row_key, spans``: runs of windows that repeat."""
    scans = Scans(docs, p)
    often = scans.triggers().groupBy("t").agg(F.sum("n").alias("n")).where("n > 1")
    repeated = Bitmap(often, "t", p)
    dictionary = write_shared(
        scans.occurrences("trigger", repeated).groupBy("phrase").agg(F.count("*").alias("n"), F.min("t").alias("t"), F.min("slot").alias("slot")),
        "phrases",
    )

    # Phrases found twice repeat as a whole.
    whole = dictionary.where("n > 1").select("phrase")
    inside = scans.occurrences("phrase", Bitmap(whole, "phrase", p)).join(whole, "phrase", "left_semi")

    # Where a trigger has several phrases, each phrase brings its windows once. A window that
    # comes twice is in two phrases; should the bitmap let a second occurrence of one phrase through, that
    # phrase is found twice, and its windows do repeat.
    several = dictionary.groupBy("t").agg(F.count("*").alias("phrases")).where("phrases > 1").select("t")
    edges = write_shared(dictionary.join(several, "t", "left_semi").select("n", "slot"), "edges")
    windows = scans.windows(Bitmap(edges, "slot", p)).groupBy("window").agg(F.count("*").alias("n"))
    shared = write_shared(windows.where("n > 1").select("window"), "windows")
    lone = scans.windows(Bitmap(edges.where("n = 1"), "slot", p), Bitmap(shared, "window", p))
    partly = lone.join(shared, "window", "left_semi").select("row_key", "start", F.lit(1).alias("windows"))

    runs = inside.select("row_key", "start", "windows").union(partly)
    spans = runs.groupBy("row_key").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))
    return scans.candidates(repeated), spans


def remove_spans(text: bytes, spans, length: int) -> tuple[bytes, int, int]:
    """What is left, the number of bytes removed, and of maximal runs removed."""
    edge = np.zeros(len(text) + 1, np.int64)
    for span in spans:
        edge[span["start"]] += 1
        edge[span["start"] + span["windows"] - 1 + length] -= 1
    gone = np.cumsum(edge)[:-1] > 0
    runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def remove_repeats(docs: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``, one row for each row of ``docs``.

    ``kept`` holds the remaining bytes of texts that lost some, and is NULL for the others.
    """
    texts, spans = repeated_spans(docs, p)
    joined = texts.join(spans, "row_key", "left").select("doc_id", "n_bytes", "packed", "whole_sha256", "spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for packed, whole, found in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                if packed is None:
                    rows.append((0, 0, whole, None))
                    continue
                text = unpack(packed)
                kept, removed, runs = remove_spans(text, found or [], p.length)
                rows.append((removed, runs, hashlib.sha256(kept).hexdigest(), kept if removed else None))
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
