"""Token counts: pieces are counted once for each distinct pre-token.

1. Each task counts the pre-tokens of its texts; a sum over all tasks gives every distinct
   pre-token with its frequency.
2. Pieces are counted once for each of them, and the table is written to the shared folder.
3. Each text becomes (pre-token, frequency) rows, which are joined to that table and summed.
   The ``head`` most frequent pre-tokens, which fill most of the text, are few enough to be
   sent to every task (their number is the bound), so only the others take part in the
   shuffle. A pre-token outside the head is never hot: it is at most one in ``head``.

Ids are never put together for a text.

Defined results: NULL and empty texts have no bytes and no tokens; copies of a row come out
as often as they came in, whatever their ``doc_id``; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asiento.llm.tables import row_key, write_shared
from asiento.llm.word_bpe import WordBPE

#: A task passes its counts on whenever it holds this many pre-tokens.
HELD = 400_000


@lru_cache(2)
def vocabulary(path: str) -> WordBPE:
    """One for each Python worker."""
    return WordBPE(path)


def _frequencies(path: str):
    def batch_of(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["piece", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = vocabulary(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(bpe.pre_tokens(text or ""))
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    return run


def _pieces(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            counts = [len(bpe.encode_word(word)) for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], ["piece", "n", "n_pieces"])

    return run


def _rows(path: str, head):
    """For each text one row with what the head gives, and one for each other pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, known = vocabulary(path), head.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(2).to_pylist()
                owner, word, times, fixed, size = [], [], [], [], []
                for n, text in enumerate(texts):
                    total = 0
                    for piece, count in Counter(bpe.pre_tokens(text or "")).items():
                        each = known.get(piece)
                        if each is None:
                            owner.append(n)
                            word.append(piece)
                            times.append(count)
                            fixed.append(None)
                            size.append(None)
                        else:
                            total += each * count
                    owner.append(n)
                    # A blank never begins a pre-token, so this finds no partner; it differs
                    # from text to text, so these rows spread.
                    word.append(f" {part.column(1)[n].as_py()}")
                    times.append(0)
                    fixed.append(total)
                    size.append(len((text or "").encode()))
                at = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(word, pa.string()), pa.array(times, pa.int64()), pa.array(fixed, pa.int64()), pa.array(size, pa.int64())],
                    ["doc_id", "row_key", "piece", "times", "fixed", "size"],
                )

    return run


def token_counts(docs: DataFrame, path: str, head: int = 65536) -> DataFrame:
    """``doc_id, n_bytes, n_tokens``, one row for each row of ``docs``."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", row_key(text).alias("row_key"), text.alias("text"))

    found = texts.select("text").mapInArrow(_frequencies(path), "piece string, n bigint")
    distinct = found.groupBy("piece").agg(F.sum("n").alias("n"))
    table = write_shared(distinct.mapInArrow(_pieces(path), "piece string, n bigint, n_pieces bigint"), "pieces")
    frequent = table.orderBy(F.desc("n"), "piece").limit(head).select("piece", "n_pieces")
    held = frequent.toArrow()  # at most ``head`` rows
    known = spark.sparkContext.broadcast(dict(zip(*(c.to_pylist() for c in held.columns))))

    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, row_key bigint, piece string, times bigint, fixed bigint, size bigint"
    rows = texts.mapInArrow(_rows(path, known), schema)
    each = F.coalesce("fixed", F.col("times") * F.col("n_pieces"))
    sums = (
        rows.join(table.select("piece", "n_pieces"), "piece", "left")
        .groupBy("doc_id", "row_key")
        .agg(F.sum(each).alias("total"), F.max("size").alias("n_bytes"), F.count("fixed").alias("copies"))
    )
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    tokens = (F.col("total") / F.col("copies")).cast("bigint")
    return sums.select("doc_id", "n_bytes", tokens.alias("n_tokens"), copy.alias("copy")).drop("copy")
