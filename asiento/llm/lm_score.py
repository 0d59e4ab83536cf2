"""Language-model scores by deleted interpolation.

The probability of a token is a mixture of maximum-likelihood estimates of every order from
the n-gram down to the token alone, and of a uniform share. The weights depend on how often
the context was seen: contexts are put into buckets by their frequency, and each bucket's
weights are learned by expectation-maximisation on a part of the training texts that was deleted
from the counts. The final counts are those of all training texts.

How the counts reach the texts:

1. Texts are put into blocks of a bounded number of tokens and written to the shared folder,
   each block with its own numbering of words.
2. A block asks for each distinct n-gram it holds, once, with its own counts. Requests go to the
   range of hashes that a key falls into; there, counts are summed and the sums go back to
   the blocks. So a word that fills a third of the corpus is one entry in each block, and
   the exchanges grow with the distinct n-grams of blocks, not with all pairs of tokens and texts.
3. Blocks score their texts. For the weights, the blocks of the deleted part give a histogram of
   their tokens by bucket and by the logarithms of their estimates, whose size is bounded by its grid.

Defined results: a NULL text is empty and has the end token alone; copies come out as
often as they came in, and count as often; without training texts every estimate but the uniform one
is zero. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from asiento.llm.tables import write_shared

KEPT, DELETED, UNSEEN = 0, 1, 2  # parts: counted, counted only in the end, never counted
END, START = b"\n", b"\r"  # no word holds white space, so neither is a word


@dataclass(frozen=True)
class Parameters:
    order: int = 2  # of the longest n-gram
    block: int = 1_500_000  # tokens
    keys: int = 1_500_000  # about so many in a range of hashes
    deleted: int = 5  # one training text in so many is deleted for the weights
    steps: int = 4  # of the histogram for each doubling of an estimate
    rounds: int = 40  # of expectation-maximisation
    least: float = 1e-6  # weight of the uniform share that always stays


# -- arrays in cells


def pack(values: np.ndarray) -> bytes:
    """Compressed byte planes: the upper ones of small numbers vanish."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes, kind) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# -- blocks


class _Block:
    def __init__(self):
        self.number: dict[bytes, int] = {START: 0, END: 1}
        self.texts: list[np.ndarray] = []
        self.doc_ids: list = []
        self.parts: list[int] = []
        self.size = 0

    def add(self, doc_id, part: int, words: list[bytes]) -> None:
        number = self.number
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint32, len(words))
        self.texts.append(np.append(ids, np.uint32(1)))
        self.doc_ids.append(doc_id)
        self.parts.append(part)
        self.size += len(ids) + 1

    def row(self) -> dict:
        ids = np.concatenate(self.texts)
        order = np.argsort(-np.bincount(ids, minlength=len(self.number)), kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        words = list(self.number)
        lengths = np.array([len(t) for t in self.texts], np.uint32)
        parts = np.array(self.parts, np.uint8)
        return {
            "block": uuid.uuid4().hex,
            "deleted": bool((parts == DELETED).any()),
            "tokens": self.size,
            "kept_tokens": int(lengths[parts == KEPT].sum()),
            "train_tokens": int(lengths[parts != UNSEEN].sum()),
            "words": np.array([xxhash.xxh64_intdigest(words[n]) for n in order], np.uint64).tobytes(),
            "ids": pack(place[ids]),
            "lengths": lengths.tobytes(),
            "parts": parts.tobytes(),
            "doc_ids": self.doc_ids,
        }


def blocks(docs: DataFrame, part: Column, p: Parameters) -> DataFrame:
    """One row for each block; texts of the deleted part have blocks of their own."""
    id_type = docs.schema["doc_id"].dataType
    schema = (
        T.StructType().add("block", "string").add("deleted", "boolean").add("tokens", "long")
        .add("kept_tokens", "long").add("train_tokens", "long").add("words", "binary").add("ids", "binary")
        .add("lengths", "binary").add("parts", "binary").add("doc_ids", T.ArrayType(id_type))
    )
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks = {True: _Block(), False: _Block()}
        for batch in batches:
            for at in range(batch.num_rows):
                doc_id, which, text = (batch.column(c)[at].as_py() for c in range(3))
                words = (text or "").encode("utf-8", "surrogatepass").lower().split()
                block = open_blocks[which == DELETED]
                block.add(doc_id, which, words)
                if block.size >= p.block:
                    yield pa.RecordBatch.from_pylist([block.row()], out)
                    open_blocks[which == DELETED] = _Block()
        for block in open_blocks.values():
            if block.size:
                yield pa.RecordBatch.from_pylist([block.row()], out)

    texts = docs.select("doc_id", part.cast("int").alias("part"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


class Grams:
    """The n-grams of one block: keys at each token, and their distinct keys."""

    def __init__(self, row, p: Parameters):
        word = np.frombuffer(row["words"], np.uint64)
        ids = unpack(row["ids"], np.uint32)
        self.lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
        self.parts = np.frombuffer(row["parts"], np.uint8)
        pads = p.order - 1
        stride = self.lengths + pads
        self.first = np.cumsum(stride) - stride + pads  # of each text's first token
        start = np.uint64(xxhash.xxh64_intdigest(START))
        stream = np.full(int(stride.sum()), start, np.uint64)
        self.token = np.ones(len(stream), bool)
        for pad in range(pads):
            self.token[self.first - pad - 1] = False
        stream[self.token] = word[ids]
        text = np.repeat(np.arange(len(self.lengths)), stride)
        self.part = self.parts[text]
        self.at = np.flatnonzero(self.token)
        self.keys = [stream]
        self.whole = [np.ones(len(stream), bool)]  # places where the n-gram lies in one text
        for order in range(2, p.order + 1):
            before, key = self.keys[-1], np.zeros(len(stream), np.uint64)
            mixed = before[:-1] * np.uint64(0x9E3779B97F4A7C15) + stream[1:] * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            key[1:] = mixed * np.uint64(0xD6E8FEB86659FD93) + np.uint64(order)
            inside = np.zeros(len(stream), bool)
            inside[order - 1 :] = text[order - 1 :] == text[: len(text) - order + 1]
            self.keys.append(key)
            self.whole.append(inside)

    def distinct(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys in order, the place of each n-gram among them, and which n-grams these are."""
        places = np.flatnonzero(self.whole[order - 1])
        keys, inverse = np.unique(self.keys[order - 1][places], return_inverse=True)
        return keys, inverse, places


def range_bits(tokens: int, p: Parameters) -> int:
    return max(0, int(np.ceil(np.log2(max(1, tokens * p.order / p.keys)))))


def requests(written: DataFrame, bits: int, p: Parameters) -> DataFrame:
    """``gram, hashes, block, deleted, keys, kept, train``: what each block asks and brings."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):
                grams = Grams(row, p)
                for order in range(1, p.order + 1):
                    keys, inverse, places = grams.distinct(order)
                    part = grams.part[places]
                    kept = np.bincount(inverse, weights=part == KEPT, minlength=len(keys)).astype(np.uint32)
                    train = np.bincount(inverse, weights=part != UNSEEN, minlength=len(keys)).astype(np.uint32)
                    of_range = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cuts = np.flatnonzero(np.diff(of_range)) + 1
                    for a, b in zip([0, *cuts], [*cuts, len(keys)]):
                        if a < b:
                            yield pd.DataFrame({
                                "gram": [order], "hashes": [int(of_range[a])], "block": [row["block"]], "deleted": [row["deleted"]],
                                "keys": [pack_sorted(keys[a:b])], "kept": [pack(kept[a:b])], "train": [pack(train[a:b])],
                            })

    columns = written.select("block", "deleted", "words", "ids", "lengths", "parts")
    return columns.mapInPandas(run, "gram int, hashes long, block string, deleted boolean, keys binary, kept binary, train binary")


ANSWER = "gram int, hashes long, block string, deleted boolean, kept binary, train binary, kept_words long, train_words long"


def answers(asked: DataFrame) -> DataFrame:
    """The sums for each request, and how many words of the range have counts."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        each = [unpack_sorted(k) for k in frame["keys"]]
        keys, inverse = np.unique(np.concatenate(each), return_inverse=True)
        sums = {}
        for name in ("kept", "train"):
            brought = np.concatenate([unpack(b, np.uint32) for b in frame[name]])
            sums[name] = np.bincount(inverse, weights=brought, minlength=len(keys)).astype(np.uint64)
        start = np.uint64(xxhash.xxh64_intdigest(START))
        cuts = np.cumsum([0, *map(len, each)])
        out = frame[["gram", "hashes", "block", "deleted"]].copy()
        for name in sums:
            out[name] = [pack(sums[name][inverse[a:b]]) for a, b in zip(cuts, cuts[1:])]
            first = np.arange(len(out)) == 0  # once for each range
            out[f"{name}_words"] = np.where(first, int(((sums[name] > 0) & (keys != start)).sum()), 0)
        return out

    return asked.groupBy("gram", "hashes").applyInPandas(run, ANSWER)


# -- estimates


@dataclass(frozen=True)
class Totals:
    tokens: int
    words: int


def estimates(grams: Grams, replies: pd.DataFrame, name: str, total: Totals, p: Parameters):
    """For each token: counts of the token and of its context, and estimates of every order.

    ``found[0]`` is uniform, ``found[k]`` the maximum-likelihood estimate of order k.
    """
    at = grams.at
    found = np.zeros((p.order + 1, len(at)))
    found[0] = 1 / (total.words + 1)
    below = np.full(len(grams.part), float(total.tokens))
    own = None
    for order in range(1, p.order + 1):
        _, inverse, places = grams.distinct(order)
        mine = replies[replies["gram"] == order].sort_values("hashes")
        sums = np.concatenate([unpack(b, np.uint64) for b in mine[name]]).astype(float)
        count = np.zeros(len(grams.part))
        count[places] = sums[inverse]
        context = below[at] if order == 1 else below[at - 1]
        found[order] = np.divide(count[at], context, out=np.zeros(len(at)), where=context > 0)
        own = count[at] if order == 1 else own
        below = count
        last_context = context
    return own, last_context, found


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then one bucket for each doubling of the frequency."""
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def histogram(written: DataFrame, replied: DataFrame, total: Totals, p: Parameters) -> DataFrame:
    """``bucket, logs, n``: tokens of the deleted part by bucket and rounded estimates."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in left.to_dict("records"):
            grams = Grams(row, p)
            _, context, found = estimates(grams, right, "kept", total, p)
            with np.errstate(divide="ignore"):
                logs = np.round(np.log2(found[1:]) * p.steps)
            logs = np.where(np.isfinite(logs), logs, -(2**15)).astype(np.int64)
            cells = np.vstack([bucket(context), logs])[:, grams.part[grams.at] == DELETED]
            kinds, n = np.unique(cells, axis=1, return_counts=True)
            parts.append(pd.DataFrame({"bucket": kinds[0], "logs": list(kinds[1:].T), "n": n}))
        return pd.concat(parts) if parts else pd.DataFrame({"bucket": [], "logs": [], "n": []})

    grouped = written.where("deleted").groupBy("block").cogroup(replied.where("deleted").groupBy("block"))
    found = grouped.applyInPandas(run, "bucket long, logs array<long>, n long")
    return found.groupBy("bucket", "logs").agg(F.sum("n").alias("n"))


def weights(cells: list, total: Totals, p: Parameters) -> np.ndarray:
    """Expectation-maximisation: weights of each bucket; those of empty buckets come from the next lower one."""
    most = 66
    out = np.full((most, p.order + 1), np.nan)
    table: dict[int, list] = {}
    for row in cells:
        table.setdefault(row["bucket"], []).append((row["logs"], row["n"]))
    for b, rows in table.items():
        logs, n = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows], float)
        found = np.column_stack([np.full(len(rows), 1 / (total.words + 1)), np.where(logs <= -(2**15), 0, 2 ** (logs / p.steps))])
        mix = np.full(p.order + 1, 1 / (p.order + 1))
        for _ in range(p.rounds):
            share = mix * found
            mix = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            mix = np.maximum(mix, [p.least, *[0] * p.order])
            mix /= mix.sum()
        out[b] = mix
    before = np.full(p.order + 1, 1 / (p.order + 1))
    for b in range(most):
        before = out[b] = before if np.isnan(out[b]).any() else out[b]
    return out


def scores(written: DataFrame, replied: DataFrame, total: Totals, mix: np.ndarray, p: Parameters) -> DataFrame:
    id_type = written.schema["doc_ids"].dataType.elementType.simpleString()

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for row in left.to_dict("records"):
            grams = Grams(row, p)
            own, context, found = estimates(grams, right, "train", total, p)
            chance = (mix[bucket(context)].T * found).sum(axis=0)
            base = (own + 0.5) / (total.tokens + 0.5 * (total.words + 1))
            first = np.cumsum(grams.lengths) - grams.lengths
            add = lambda values: np.add.reduceat(values, first)  # noqa: E731  every text has its end token
            parts.append(pd.DataFrame({
                "doc_id": pd.Series(list(row["doc_ids"]), dtype=object), "n_tokens": grams.lengths,
                "n_known": add((own > 0).astype(np.int64)), "train_tokens": total.tokens,
                "base_score": add(np.log10(base)), "score": add(np.log10(chance)),
            }))
        return pd.concat(parts) if parts else pd.DataFrame(columns=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    grouped = written.groupBy("block").cogroup(replied.groupBy("block"))
    return grouped.applyInPandas(run, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_texts(docs: DataFrame, training: Column, p: Parameters = Parameters()) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs``.

    ``training`` says which rows the model learns from.
    """
    held_back = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(p.deleted)) == 0
    part = F.when(~F.coalesce(training, F.lit(False)), UNSEEN).when(held_back, DELETED).otherwise(KEPT)
    written = write_shared(blocks(docs, part, p), "blocks")
    size = written.agg(F.sum("tokens"), F.sum("kept_tokens"), F.sum("train_tokens")).first()
    tokens, kept_tokens, train_tokens = (n or 0 for n in size)
    replied = write_shared(answers(requests(written, range_bits(tokens, p), p)), "answers")
    words = replied.where("gram = 1").agg(F.sum("kept_words"), F.sum("train_words")).first()
    kept, train = Totals(kept_tokens, words[0] or 0), Totals(train_tokens, words[1] or 0)
    mix = weights(histogram(written, replied, kept, p).collect(), kept, p)
    return scores(written, replied, train, mix, p)
