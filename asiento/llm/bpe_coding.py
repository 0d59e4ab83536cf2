"""BPE encoding and decoding of whole texts.

``encode_texts`` passes each text through the streaming transducer of ``word_bpe`` in slices, and
the ids it emits through one incremental decoder, whose output is what is hashed; memory does
not grow with the length of a text. It is a function of one text: one pass over the rows, no shuffle.

Text may be cut at any white space, so what lies between two white spaces passes through the transducer
alone. A worker remembers the ids that were emitted for a bounded number of such chunks of up to ``CHUNK`` characters,
and of their pre-tokens; longer ones, and those that a slice cuts, go through the stream each time.

Defined results: NULL counts as empty and gives no ids and an empty decoded text; copies of a
row come out alike; very long texts are looked at slice by slice; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.llm.word_bpe import LAST_SPACE, SPACE, Decoder, Encoder, WordBPE, WordStream

#: Characters of a text that are looked at together.
SLICE = 1 << 16
#: Chunks, and pre-tokens, whose ids a Python worker remembers: so many met of late, and as many before.
REMEMBERED = 200_000
#: Characters of the longest chunk that is remembered.
CHUNK = 64
#: White space to Python's ``split``, but not to the vocabulary's pattern.
ODD = re.compile("[\x1c-\x1f]")

DIGESTS = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"


class Memory(dict):
    """Values of ``make`` for the keys met of late; a key not met for long is forgotten."""

    def __init__(self, make: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.make, self.before = make, {}

    def held(self, key: str) -> tuple[int, ...] | None:
        return self.get(key, self.before.get(key))

    def __missing__(self, key: str) -> tuple[int, ...]:
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= CHUNK:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[key] = found
        return found


class Coder:
    """The transducer with a bounded memory of chunks met before."""

    def __init__(self, path: str):
        self.bpe = WordBPE(path)
        self.words = Memory(self.emitted)
        self.chunks = Memory(self.of_chunk)
        self.decimal = [str(n) for n in range(max(self.bpe.tokens) + 1)]

    def emitted(self, word: str) -> tuple[int, ...]:
        """What the transducer emits for a pre-token."""
        if word in self.bpe.special:
            return (self.bpe.special[word],)
        stream = WordStream(self.bpe)
        return (*stream.feed(word), *stream.finish())

    def of_chunk(self, chunk: str) -> tuple[int, ...]:
        if len(chunk) > CHUNK:
            return tuple(Encoder(self.bpe).feed(chunk, last=True))
        words = self.bpe.pre_tokens(chunk)
        if len(words) == 1:  # the memory of chunks will hold it
            known = self.words.held(words[0])
            return self.emitted(words[0]) if known is None else known
        return tuple(chain.from_iterable(map(self.words.__getitem__, words)))

    def ids(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, stretch by stretch."""
        encoder, known = Encoder(self.bpe), self.chunks.__getitem__
        for start in range(0, len(text), SLICE):
            part, last = text[start : start + SLICE], start + SLICE >= len(text)
            if encoder.waits:
                space = SPACE.search(part)
                cut = space.end() if space else len(part)
                yield [*encoder.feed(part[:cut], last and cut == len(part))]
                part = part[cut:]
            if encoder.waits or ODD.search(part):
                yield [*encoder.feed(part, last)]
                continue
            found = None if last else LAST_SPACE.search(part)
            cut = len(part) if last else found.end() if found else 0
            yield [*chain.from_iterable(map(known, part[:cut].split()))]
            if cut < len(part):
                yield [*encoder.feed(part[cut:])]

    def digests(self, text: str) -> tuple[int, str, str]:
        total, encoded, decoded = 0, hashlib.sha256(), hashlib.sha256()
        decoder, decimal = Decoder(self.bpe), self.decimal.__getitem__
        for ids in self.ids(text):
            if ids:
                encoded.update(((" " if total else "") + " ".join(map(decimal, ids))).encode())
                decoded.update(decoder.feed(ids).encode())
                total += len(ids)
        decoded.update(decoder.feed([], last=True).encode())
        return total, encoded.hexdigest(), decoded.hexdigest()


@lru_cache(2)
def coder(path: str) -> Coder:
    """One for each Python worker."""
    return Coder(path)


def encode(path: str, text: Column) -> Column:
    """The ids of each text."""

    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        bpe = coder(path).bpe
        rows = ([*Encoder(bpe).feed(t or "", last=True)] for t in texts.to_pylist())
        return pa.array(list(rows), pa.list_(pa.int32()))

    return ids(text)


def decode(path: str, ids: Column, joined: bool = True) -> Column:
    """The text of each array of ids; ``joined=False`` gives readable text."""

    @F.arrow_udf("string")
    def texts(rows: pa.Array) -> pa.Array:
        bpe = coder(path).bpe
        return pa.array([Decoder(bpe, joined).feed(r or [], last=True) for r in rows.to_pylist()], pa.string())

    return texts(ids)


def digest(path: str, text: Column) -> Column:
    """``DIGESTS`` of each text: its ids and their decoded text, without holding either."""

    @F.arrow_udf(DIGESTS)
    def digests(texts: pa.Array) -> pa.Array:
        one = coder(path)
        rows = [one.digests(t or "") for t in texts.to_pylist()]
        count, ids, decoded = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digests(text)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, one row for each row of ``docs``."""
    found = docs.select("doc_id", digest(path, F.col("text").cast("string")).alias("found"))
    return found.select("doc_id", "found.*")
