"""Phrase collocations, counted in quotient filters.

Texts are cut into pieces and words once; what later passes read are streams of word numbers.
A task packs its texts, by language, into blocks of bounded length. The distinct words of a block
ask the dictionary for their numbers: words too rare to be in a candidate have none, and cut the
stream. No table of all words is ever sent to a task.

An n-gram of word numbers is a pair (left, right) of half its bits each. A Feistel network
permutes the pairs, which is invertible, so a permuted pair spreads over the shards like a
hash and still is the n-gram. A counting quotient filter keeps the pairs of one shard in order: the
quotient, the next bits of the left half, is only the place in a table of run lengths, the
remainder is stored in full, and a counter goes with it. Nothing is lost or approximate.
Each block sends one filter for each shard that it has n-grams in, however often they occur; the filters of a shard
are merged in order. A phrase on a third of all places is one entry a block.

Longer n-grams are only counted where both their parts of one word less are frequent. Which n-grams
are, is told to the tasks by a bitmap of 32 bits for each, up to ``max_log_bits``; a full bitmap lets
through more n-grams, whose exact counts then decide. Counts of all parts are joined as rows.

Defined results: NULL texts have no words; NULL languages are ``und``; repeated rows count each time;
ties are ordered by score, count and phrase, so ranks are unique. Very long texts are cut slice by
slice, and a block that ends within a piece hands its last words on. An empty table gives no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.tables import write_shared

UNKNOWN = "und"
# A-Z in lower case, tabs as blanks, and what ends a piece as line feeds.
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
BREAK = b"\n"  # between pieces, number 0 in every block
SLICE = 1 << 22  # bytes of a text that are cut at once
LONGEST = 4
SHARD_WORDS = 1 << 16  # words that get their numbers in one group


@dataclass(frozen=True)
class Parameters:
    min_count: int = 30
    scale: int = 2_000_000
    covered: int = 80  # per cent of a phrase's places that a longer one may take
    top: int = 2000  # of each language
    block: int = 1 << 19  # words in a block
    shard: int = 1 << 21  # n-grams in the filters of a shard, before they are merged
    max_log_bits: int = 28


# -- blocks of words ------------------------------------------------------------------


def tokens(text: str) -> Iterator[list[bytes]]:
    """The words of a text, with BREAK between pieces, slice by slice."""
    data, rest = text.encode("utf-8", "surrogatepass"), b""
    for start in range(0, len(data), SLICE):
        part = rest + data[start : start + SLICE].translate(PLAIN)
        cut = len(part) if start + SLICE >= len(data) else max(part.rfind(b" "), part.rfind(b"\n")) + 1
        part, rest = part[:cut], part[cut:]
        yield [*filter(None, part.replace(BREAK, b" \n ").split(b" "))]
    yield [BREAK]


def place_type(wide: bool) -> type:
    """How the places of a block's words are stored: most blocks have few enough for 16 bits."""
    return np.uint32 if wide else np.uint16


class _Block:
    """Words of one language, gathered by one task."""

    def __init__(self, lang: str, head: list[bytes]):
        self.lang, self.overlap = lang, len(head)
        self.known = defaultdict(count().__next__)
        self.known[BREAK]
        self.parts, self.size = [], 0
        self.add(head)

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def row(self, number: int) -> dict:
        stream = np.concatenate(self.parts)
        counts = np.bincount(stream[self.overlap :], minlength=len(self.known))
        wide = len(self.known) > 1 << 16
        return {
            "block": number, "lang": self.lang, "overlap": self.overlap, "size": self.size, "wide": wide,
            "words": [w.decode("utf-8", "surrogatepass") for w in self.known][1:], "counts": counts[1:].tolist(),
            "stream": stream.astype(place_type(wide)).tobytes(),
        }


BLOCK = "block long, lang string, overlap int, size long, wide boolean, words array<string>, counts array<long>, stream binary"
BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("lang", pa.string()), ("overlap", pa.int32()), ("size", pa.int64()), ("wide", pa.bool_()), ("words", pa.list_(pa.string())),
     ("counts", pa.list_(pa.int64())), ("stream", pa.binary())]
)


def blocks_of(docs: DataFrame, p: Parameters) -> DataFrame:
    """``BLOCK`` rows: distinct words, their counts, and the stream of their places in that list, from 1."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        open_: dict[str, _Block] = {}
        held = 0

        def close(lang: str, last: list[bytes] = []) -> pa.RecordBatch:
            row = open_.pop(lang).row(next(numbers))
            if last:
                open_[lang] = _Block(lang, last)
            return pa.RecordBatch.from_pylist([row], BLOCK_ARROW)

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                for words in tokens(text or ""):
                    for at in range(0, len(words), p.block):
                        some = words[at : at + p.block]
                        if lang not in open_:
                            open_[lang] = _Block(lang, [])
                        open_[lang].add(some)
                        held += len(some)
                        if open_[lang].size >= p.block:
                            held -= open_[lang].size
                            # What is open at the end of the block goes on in the next one.
                            last = some[-(LONGEST - 1) :]
                            last = last[len(last) - last[::-1].index(BREAK) :] if BREAK in last else last
                            yield close(lang, last)
                            held += len(last)
                if held >= 2 * p.block:  # many languages: their blocks stay short
                    for name in [*open_]:
                        yield close(name)
                    held = 0
        for name in [*open_]:
            yield close(name)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    texts = docs.select(F.col("text").cast("string").alias("text"), lang)
    return write_shared(texts.mapInArrow(cut, BLOCK), "blocks")


def dictionary(blocks: DataFrame, p: Parameters) -> DataFrame:
    """``lang, word, f, n, id``: the words frequent enough for a phrase; ids are unique, small, and from 1.

    ``n`` is the number of words of the language.
    """
    pairs = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("at"))
    counted = write_shared(pairs.groupBy("lang", F.col("at.words").alias("word")).agg(F.sum("at.counts").alias("f")), "words")
    sizes = counted.groupBy("lang").agg(F.sum("f").alias("n"))
    often = counted.where(F.col("f") >= p.min_count)
    shards = often.count() // SHARD_WORDS + 1
    shard = F.pmod(F.xxhash64("lang", "word"), F.lit(shards))
    place = F.row_number().over(Window.partitionBy(shard).orderBy("lang", "word")) - 1
    numbered = often.withColumn("id", (place * shards + shard + 1).cast("long"))
    return write_shared(numbered.join(sizes, "lang"), "dictionary")


def streams_of(blocks: DataFrame, words: DataFrame) -> DataFrame:
    """``overlap, ids``: each block as word numbers, 0 for a break or a rare word."""
    asked = blocks.select("block", "lang", F.posexplode("words").alias("place", "word"))
    answers = asked.join(words.select("lang", "word", "id"), ["lang", "word"]).groupBy("block")
    known = answers.agg(F.collect_list(F.struct("place", "id")).alias("known"))  # of the words of one block
    both = blocks.select("block", "overlap", "wide", "stream").join(known, "block")

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                stream = np.frombuffer(batch.column("stream")[row].as_py(), place_type(batch.column("wide")[row].as_py()))
                pairs = batch.column("known")[row].values
                ids = np.zeros(stream.max(initial=0) + 1, np.uint32)
                ids[pairs.field("place").to_numpy() + 1] = pairs.field("id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("overlap").slice(row, 1), pa.array([ids[stream].tobytes()], pa.binary())], ["overlap", "ids"]
                )

    return write_shared(both.mapInArrow(numbered, "overlap int, ids binary"), "streams")


# -- quotient filters -----------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How n-grams of ``words`` words of ``bits`` bits lie in the filters."""

    words: int
    bits: int
    log_shards: int = 0

    @property
    def half(self) -> int:
        return (self.words + 1) // 2 * self.bits

    def pairs(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams with the given words at their places, permuted."""
        halves = []
        for some in (ids[: self.words // 2], ids[self.words // 2 :]):
            packed = np.zeros(len(ids[0]), np.uint64)
            for word in some:
                packed = packed << np.uint64(self.bits) | word.astype(np.uint64)
            halves.append(packed)
        left, right = halves
        for turn in range(4):
            left, right = right, left ^ self._mixed(right, turn)
        return left, right

    def ids(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        """The words of permuted n-grams: the permutation the other way."""
        for turn in reversed(range(4)):
            left, right = right ^ self._mixed(left, turn), left
        found, mask = [], np.uint64((1 << self.bits) - 1)
        for packed, size in ((right, self.words - self.words // 2), (left, self.words // 2)):
            for _ in range(size):
                found.insert(0, packed & mask)
                packed = packed >> np.uint64(self.bits)
        return found

    def _mixed(self, half: np.ndarray, turn: int) -> np.ndarray:
        x = (half + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        return x >> np.uint64(64 - self.half)

    def shard(self, left: np.ndarray) -> np.ndarray:
        return left >> np.uint64(self.half - self.log_shards) if self.log_shards else np.zeros_like(left)

    def _kind(self) -> np.dtype:
        return np.dtype(np.uint16 if self.half <= 16 else np.uint32 if self.half <= 32 else np.uint64)

    def packed(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
        """A filter of pairs of one shard in order: run lengths, left and right remainders, counters.

        There are fewer quotients than pairs, so a filter never takes more than its pairs do.
        """
        low = self.half - self.log_shards
        quotient = min(max(len(left).bit_length() - 3, 0), low)
        inside = left & np.uint64((1 << low) - 1)
        runs = np.bincount((inside >> np.uint64(low - quotient)).astype(np.int64), minlength=1 << quotient) if quotient else np.array([len(left)])
        remainder = inside & np.uint64((1 << low - quotient) - 1)
        kind = self._kind()
        return runs.astype(np.uint32).tobytes(), remainder.astype(kind).tobytes(), right.astype(kind).tobytes(), counts.astype(np.uint32).tobytes()

    def opened(self, shard: int, runs: bytes, remainder: bytes, right: bytes, counts: bytes) -> tuple[np.ndarray, ...]:
        """``left, right, counts`` of a filter."""
        low = self.half - self.log_shards
        runs = np.frombuffer(runs, np.uint32)
        rest = low - (len(runs).bit_length() - 1)
        left = np.frombuffer(remainder, self._kind()).astype(np.uint64)
        if rest < low:
            left = left | np.repeat(np.arange(len(runs), dtype=np.uint64), runs) << np.uint64(rest)
        if shard:
            left = left | np.uint64(shard) << np.uint64(low)
        return left, np.frombuffer(right, self._kind()).astype(np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)


def summed(left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Distinct pairs in order, and the sums of their counts."""
    order = np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.ones(len(left), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    at = np.flatnonzero(first)
    ones = np.ones(len(left), np.int64) if counts is None else counts[order]
    return left[at], right[at], np.add.reduceat(ones, at) if len(at) else ones[:0]


@dataclass(frozen=True)
class Bitmap:
    """Which n-grams of one length may be frequent; no bits stand for all."""

    layout: Layout
    log_bits: int
    bits: bytes

    @staticmethod
    def places(left: np.ndarray, right: np.ndarray, log_bits: int) -> np.ndarray:
        x = (left ^ right * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - log_bits)

    def holds(self, ids: list[np.ndarray]) -> np.ndarray:
        at = self.places(*self.layout.pairs(ids), self.log_bits)
        bits = np.frombuffer(self.bits, np.uint8)
        return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


FILTER = "shard long, runs binary, remainder binary, right binary, counts binary"


def filters_of(streams: DataFrame, layout: Layout, shorter: Bitmap | None) -> DataFrame:
    """``FILTER`` rows: of each block a filter for each shard that it has n-grams in."""
    size = layout.words

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                stream = np.frombuffer(batch.column("ids")[row].as_py(), np.uint32)
                overlap = batch.column("overlap")[row].as_py()
                # An n-gram counts in the block where its last word is new.
                start = max(overlap - size + 1, 0)
                words = [stream[start + k : len(stream) - size + 1 + k] for k in range(size)] if len(stream) >= start + size else []
                if not words:
                    continue
                whole = np.logical_and.reduce([w != 0 for w in words])
                words = [w[whole] for w in words]
                if shorter is not None:
                    good = shorter.holds(words[:-1])
                    words = [w[good] for w in words]
                    good = shorter.holds(words[1:])
                    words = [w[good] for w in words]
                if not len(words[0]):
                    continue
                left, right, counts = summed(*layout.pairs(words))
                shards = layout.shard(left)
                edges = np.flatnonzero(np.diff(shards)) + 1
                out = [
                    (int(shards[a]), *layout.packed(left[a:b], right[a:b], counts[a:b]))
                    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(left)])
                ]
                columns = zip(*out)
                kinds = [pa.int64()] + [pa.binary()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["shard", "runs", "remainder", "right", "counts"])

    return streams.mapInArrow(build, FILTER)


def merged(filters: DataFrame, layout: Layout, p: Parameters) -> DataFrame:
    """``w1 .. w4, f``: the frequent n-grams of all filters, unused places 0."""
    names = [f"w{k}" for k in range(1, LONGEST + 1)] + ["f"]

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        columns = [table.column(c).to_pylist() for c in ("runs", "remainder", "right", "counts")]
        opened = [layout.opened(shard, *one) for one in zip(*columns)]
        left, right, counts = summed(*(np.concatenate(part) for part in zip(*opened)))
        often = counts >= p.min_count
        ids = layout.ids(left[often], right[often])
        ids += [np.zeros(int(often.sum()), np.uint64)] * (LONGEST - layout.words)
        return pa.table([*(w.astype(np.int64) for w in ids), counts[often]], names)

    schema = ", ".join(f"{name} long" for name in names)
    return write_shared(filters.groupBy("shard").applyInArrow(merge, schema), f"grams{layout.words}")


def bitmap_of(grams: DataFrame, layout: Layout, p: Parameters) -> Bitmap:
    """A bitmap of the frequent n-grams; the parts of all tasks are joined by OR in the aggregation."""
    wanted = max(grams.count(), 1) * 32
    log_bits = min(max(wanted.bit_length(), 15), p.max_log_bits)
    words = layout.words

    @F.arrow_udf("long")
    def place(*ids: pa.Array) -> pa.Array:
        at = Bitmap.places(*layout.pairs([w.to_numpy(zero_copy_only=False).astype(np.uint64) for w in ids]), log_bits)
        return pa.array(at.astype(np.int64))

    at = grams.select((place(*[F.col(f"w{k}") for k in range(1, words + 1)]) + 1).alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    bits = bytearray((1 << log_bits) // 8)
    for row in maps.toLocalIterator():  # of at most 2 ** max_log_bits bits
        start = (row.bucket - 1) * 4096
        bits[start : start + 4096] = row.bits
    return Bitmap(layout, log_bits, bytes(bits))


def grams_of(streams: DataFrame, bits: int, total: int, p: Parameters) -> DataFrame:
    """``w1 .. w4, f``: all frequent n-grams of two words and more."""
    found, shorter = None, None
    for size in range(2, LONGEST + 1):
        half = Layout(size, bits).half
        layout = Layout(size, bits, min((total // p.shard).bit_length(), half - 1))
        grams = merged(filters_of(streams, layout, shorter), layout, p)
        found = grams if found is None else found.union(grams)
        if size < LONGEST:
            shorter = bitmap_of(grams, layout, p)
    return found


# -- phrases --------------------------------------------------------------------------


def collocations(docs: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    ``a``, ``l`` and ``r`` count the phrase and the two parts of its weakest cut.
    """
    blocks = blocks_of(docs, p)
    words = dictionary(blocks, p)
    streams = streams_of(blocks, words)
    largest, total = words.agg(F.max("id")).first()[0], blocks.agg(F.sum("size")).first()[0]
    bits = max(int(largest or 1).bit_length(), 1)
    places = [f"w{k}" for k in range(1, LONGEST + 1)]
    zero = F.lit(0).cast("long")
    grams = grams_of(streams, bits, total or 0, p)
    key = F.array_remove(F.array(*places), 0)
    grams = write_shared(grams.select(key.alias("key"), "f"), "grams")
    singles = words.select(F.array("id").alias("key"), "f")

    size = F.size("key")
    cuts = grams.select("key", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    left, right = F.slice("key", 1, F.col("k")), F.slice("key", F.col("k") + 1, size)
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("part")), F.struct(F.lit(1).alias("side"), right.alias("part"))))
    parts = write_shared(cuts.select("key", "f", "k", sides.alias("s")).select("key", "f", "k", "s.*"), "parts")
    known = write_shared(singles.union(grams).toDF("part", "of"), "known")
    side = lambda n: F.max(F.when(F.col("side") == n, F.col("of")))
    cut = parts.join(known, "part").groupBy("key", "k").agg(F.max("f").alias("a"), side(0).alias("l"), side(1).alias("r"))
    score = F.expr(f"(CAST({p.scale} AS DECIMAL(38, 0)) * a) DIV (l + r)")
    weakest = F.min_by(F.struct("l", "r"), F.struct(score, "k")).alias("of")
    scored = cut.groupBy("key").agg(F.max("a").alias("a"), F.min(score).alias("score"), weakest).select("key", "a", "score", "of.*")

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("key", i, m))))
    over = grams.where(size > 2).select(F.explode(inner).alias("key"), "f").groupBy("key").agg(F.max("f").alias("longer"))
    left_over = scored.join(over, "key", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * p.covered))

    # All words of a phrase are of one language, which the first one knows.
    first = words.select(F.col("id").alias("first"), "lang", "n")
    told = left_over.withColumn("first", F.col("key")[0]).join(first, "first")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = write_shared(told.withColumn("place", F.rank().over(order)).where(F.col("place") <= p.top).drop("place", "first"), "best")
    spelled = best.select("key", F.posexplode("key").alias("at", "id")).join(words.select("id", "word"), "id")
    phrase = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ")
    phrases = spelled.groupBy("key").agg(phrase.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.join(phrases, "key").withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= p.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
