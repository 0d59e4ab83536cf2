"""The trie of conversation prefixes, screened by a count-min sketch.

A conversation is a sequence of turns; two conversations share a node of the trie for every
prefix of turns they have in common. Each prefix gets a digest of 128 bits, the running
exclusive-or of hashes of (place, role, text), so the texts themselves never move. Runs of
``CHUNK`` turns are numbered and digested apart and joined by their totals: a conversation
of any length is never a single group.

A count-min sketch counts the digests of all prefixes. Its estimate is never below the count, so
an estimate of one proves that a prefix belongs to one conversation: its node is made on the
spot. Only prefixes that may be shared are grouped exactly by digest. The sketch follows the
number of prefixes up to ``max_log_width``; what reaches the tasks is one bit a cell, whether it counts more
than one (50 MB at most by default). A fuller sketch only sends more prefixes to the exact grouping.

Sums over subtrees need no walk of the tree. Of the conversations below a node exactly one, the
smallest, stands for it, and it does so for all nodes from some depth r on. So leaves and children
of a node, and the bytes that its subtree stores once instead of n times, are sums over its
conversations of what r and the length of each tell.

The digest of the conversations that end at a node reads their ids in order. They are packed in
chunks of 512 neighbours first, and the chunks of a node pass through one SHA-256 state, row
by row; SHA-256 has no way around one reader, and it holds one batch of chunks at a time.

Defined results: turns are ordered by ``turn``, NULL first, and turns of equal number by the hash
of role and text; NULL role and text are empty; repeated rows are turns of their own; rows without ``conv_id``
belong to no conversation and are left out. Very long texts are hashed where they are. An empty table
has no nodes. Other columns are left alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.tables import fold_of, streamed, write_shared

CHUNK = 1024  # turns of one conversation that are numbered and digested together
ENDS = 512  # conversation ids packed in one string
BITS = 1 << 15  # that one of Spark's bitmaps holds
KEY = ["depth", "d1", "d2"]


@dataclass(frozen=True)
class Parameters:
    rows: int = 3  # of the sketch
    cells: int = 4  # of a row for each prefix
    max_log_width: int = 27


# -- turns and prefixes ---------------------------------------------------------------


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, a1, a2, bytes``: the turns, numbered from 1, with the digest of role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a1"),
        F.xxhash64(F.lit(2), role, text).alias("a2"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    turns = write_shared(turns.withColumn("chunk", F.expr(f"turn div {CHUNK}L")), "turns")
    sizes = turns.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy(F.col("chunk").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    later = sizes.withColumn("skipped", F.sum("n").over(before)).where("skipped > 0").alias("l")
    order = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "a1", "a2")
    local = turns.withColumn("at", F.row_number().over(order)).alias("t")
    same = (F.col("t.conv_id") == F.col("l.conv_id")) & F.col("t.chunk").eqNullSafe(F.col("l.chunk"))
    pos = F.col("at") + F.coalesce(F.col("skipped"), F.lit(0))
    return write_shared(local.join(later, same, "left").select("t.conv_id", pos.alias("pos"), "a1", "a2", "bytes"), "placed")


def members_of(turns: DataFrame) -> DataFrame:
    """``conv_id, len``: each conversation and its number of turns."""
    return turns.groupBy("conv_id").agg(F.count("*").alias("len"))


def branched(turns: DataFrame, apart: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start like another one: ``turns`` with ``len``, and the members.

    Conversation c takes the first h turns of conversation c - c % ``apart``, and its own after its
    first h; h is a hash of c, from 0 to ``most``.
    """
    own = members_of(turns)
    held = own.select(
        "conv_id", "len", (F.col("conv_id") - F.col("conv_id") % apart).alias("base"), fold_of(F.col("conv_id"), most + 1).cast("bigint").alias("h")
    ).alias("c")
    bases = own.select(F.col("conv_id").alias("base"), F.col("len").alias("base_len")).alias("b")
    taken = F.least("h", F.coalesce("base_len", F.lit(0)))
    members = write_shared(
        held.join(bases, "base", "left").select(
            "conv_id", "base", "h", taken.alias("m"), (taken + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("len")
        ),
        "members",
    )
    rest = turns.join(members, "conv_id").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("m"))
    first = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base").join(members, "base").where("pos <= h")
    columns = ["conv_id", "pos", "a1", "a2", "bytes", "len"]
    return rest.select(columns).union(first.select(columns)), members.select("conv_id", "len")


def prefixes_of(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row for each conversation and prefix of it, the empty one included.

    ``conv_id, len, depth``; ``d1, d2`` the digest of the prefix, ``p1, p2`` that of its parent;
    ``bytes`` of its last text and ``before`` of the texts before.
    """
    mark = lambda seed: F.xxhash64(F.lit(seed), F.col("pos").cast("bigint"), "a1", "a2")
    marked = turns.select("conv_id", "len", F.col("pos").cast("bigint").alias("depth"), "bytes", mark(3).alias("f1"), mark(4).alias("f2"))
    marked = write_shared(marked.withColumn("chunk", F.expr(f"depth div {CHUNK}L")), "marked")
    run = lambda over: [F.bit_xor("f1").over(over), F.bit_xor("f2").over(over), F.sum("bytes").over(over)]
    chunks = marked.groupBy("conv_id", "chunk").agg(F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"), F.sum("bytes").alias("bytes"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    o1, o2, bytes_before = run(before)
    later = chunks.select("conv_id", "chunk", o1.alias("o1"), o2.alias("o2"), bytes_before.alias("ob")).where("ob IS NOT NULL")
    d1, d2, upto = run(Window.partitionBy("conv_id", "chunk").orderBy("depth"))
    local = marked.select("*", d1.alias("x1"), d2.alias("x2"), upto.alias("upto"))
    both = local.join(later, ["conv_id", "chunk"], "left").na.fill(0, ["o1", "o2", "ob"])
    both = both.withColumn("d1", F.col("x1").bitwiseXOR(F.col("o1"))).withColumn("d2", F.col("x2").bitwiseXOR(F.col("o2")))
    p1, p2 = F.col("d1").bitwiseXOR(F.col("f1")), F.col("d2").bitwiseXOR(F.col("f2"))
    inner = both.select(
        "conv_id", "len", "depth", "d1", "d2", p1.alias("p1"), p2.alias("p2"), "bytes", (F.col("upto") + F.col("ob") - F.col("bytes")).alias("before")
    )
    zero = F.lit(0).cast("bigint")
    roots = members.select("conv_id", "len", *[zero.alias(c) for c in inner.columns[2:]])
    return write_shared(inner.union(roots), "prefixes")


# -- the sketch -----------------------------------------------------------------------


@dataclass(frozen=True)
class Sketch:
    """Of a count-min sketch, which cells count more than one prefix."""

    rows: int
    log_width: int
    crowded: bytes

    def cells(self, depth: Column, d1: Column, d2: Column) -> list[Column]:
        """The cell of a digest in each row, over all rows."""
        return [
            F.shiftrightunsigned(F.xxhash64(F.lit(n), depth, d1, d2), 64 - self.log_width) + (n << self.log_width) for n in range(self.rows)
        ]

    def lone(self, depth: Column, d1: Column, d2: Column) -> Column:
        """Whether the estimate is one, which proves that no other conversation has the prefix."""
        crowded = np.frombuffer(self.crowded, np.uint8)

        @F.arrow_udf("boolean")
        def lone(*cells: pa.Array) -> pa.Array:
            many = np.ones(len(cells[0]), bool)
            for cell in cells:
                at = cell.to_numpy(zero_copy_only=False)
                many &= (crowded[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            return pa.array(~many)

        return lone(*self.cells(depth, d1, d2))


def sketch_of(prefixes: DataFrame, p: Parameters) -> Sketch:
    """Partial counts meet in the aggregation; one bit a cell, of a bounded number, reaches the driver."""
    wanted = math.ceil(math.log2(max(p.cells * prefixes.count(), 1)))
    empty = Sketch(p.rows, min(max(wanted, 15), p.max_log_width), b"")
    own = empty.cells(*[F.col(c) for c in KEY])
    counts = prefixes.select(F.explode(F.array(*own)).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    at = F.col("cell") + 1  # Spark numbers buckets from 1
    maps = counts.where("n > 1").groupBy(F.bitmap_bucket_number(at).alias("bucket"))
    crowded = bytearray((p.rows << empty.log_width) // 8)
    for row in streamed(maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")), "crowded"):
        start = (row.bucket - 1) * BITS // 8
        crowded[start : start + BITS // 8] = row.bits
    return Sketch(p.rows, empty.log_width, bytes(crowded))


# -- the trie -------------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the chunks of each node, which come in order; one batch is held at a time."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    now, state = None, None

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done) if done else ([],) * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*KEY, "ends"])

    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if key == now:
                state.update(b"," + ids.encode())
                continue
            if now is not None:
                done.append((*now, state.hexdigest()))
            now, state = key, hashlib.sha256(ids.encode())
        yield rows(done)
    if now is not None:
        yield rows([(*now, state.hexdigest())])


def ends_of(shared: DataFrame, members: DataFrame) -> DataFrame:
    """``depth, d1, d2, ends``: digest of the ids that end at each node where some end."""
    # After a sort by range the row numbers rise with the ids, so chunks of them are neighbours.
    ranged = members.select("conv_id").repartitionByRange("conv_id").sortWithinPartitions("conv_id")
    chunks = write_shared(ranged.withColumn("chunk", F.expr(f"monotonically_increasing_id() div {ENDS}L")), "ends")
    ended = shared.where("depth = len").select(*KEY, "conv_id").join(chunks, "conv_id")
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    packed = write_shared(ended.groupBy(*KEY, "chunk").agg(ids.alias("ids")), "packed")
    ordered = packed.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    return ordered.select(*KEY, "ids").mapInArrow(_digests, "depth long, d1 long, d2 long, ends string")


def trie(turns: DataFrame, members: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """The nodes: ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    ``turns`` holds ``conv_id, pos, a1, a2, bytes, len``, ``members`` ``conv_id, len``.
    """
    prefixes = prefixes_of(turns, members)
    sketch = sketch_of(prefixes, p)
    own, parent = sketch.lone(*[F.col(c) for c in KEY]), sketch.lone(F.col("depth") - 1, F.col("p1"), F.col("p2"))
    screened = write_shared(prefixes.withColumn("lone", own).withColumn("parent_lone", parent), "screened")
    lone, shared = screened.where("lone"), screened.where("NOT lone")
    top = members.agg(F.min("conv_id")).first()[0]

    ending = (F.col("depth") == F.col("len")).cast("bigint")
    groups = write_shared(
        shared.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.sum(ending).alias("n_ends"), F.min("before").alias("before")
        ),
        "groups",
    )
    # From which depth on a conversation stands for its nodes, and whether it does for its last one.
    stands = groups.select("conv_id", "depth", "before", (F.col("n_ends") == F.col("n")).alias("leaf")).union(
        lone.select("conv_id", "depth", "before", (F.col("depth") == F.col("len")).alias("leaf"))
    )
    first = stands.groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("first"), F.bool_or("leaf").alias("leaf"))
    marks = write_shared(first.select("conv_id", F.col("first.depth").alias("r"), F.col("first.before").alias("upto"), "leaf"), "marks")
    # A conversation that stands for nothing is saved to its end, which is a shared node.
    whole = shared.where("depth = len").select("conv_id", (F.col("before") + F.col("bytes")).alias("total"))
    held = shared.join(marks, "conv_id", "left").join(whole, "conv_id", "left")
    child = (F.col("r") <= F.col("depth") + 1) & (F.col("depth") < F.col("len"))
    saved = F.greatest(F.coalesce("upto", "total") - F.col("before"), F.lit(0))
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("bigint"))
    summed = held.groupBy(*KEY).agg(
        F.min(F.struct("conv_id", "r")).alias("least"), F.count("*").alias("n_convs"), count(child).alias("n_children"),
        count(F.col("leaf")).alias("n_leaves"), F.sum(saved).alias("saved_tokens"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    nothing = F.sha2(F.lit(""), 256)
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    columns = ["conv_id", "depth", "p1", "p2", *numbers, "ends_sha256", "heads"]
    grouped = summed.join(ends_of(shared, members), KEY, "left").select(
        F.col("least.conv_id").alias("conv_id"), "depth", "p1", "p2", *numbers,
        F.coalesce("ends", nothing).alias("ends_sha256"), (F.col("least.r") == F.col("depth")).alias("heads"),
    )
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    tails = lone.select(
        "conv_id", "depth", "p1", "p2", one.alias("n_convs"), (F.col("len") > F.col("depth")).cast("bigint").alias("n_children"),
        one.alias("n_leaves"), none.alias("saved_tokens"),
        F.when(F.col("depth") == F.col("len"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
        (~F.col("parent_lone")).alias("heads"),
    )
    nodes = write_shared(grouped.select(columns).union(tails.select(columns)), "nodes")
    # Where a conversation does not stand for the parent, the groups know who does; the root is known.
    top_id = F.lit(top).cast("bigint")
    near = nodes.where("NOT heads OR depth <= 1")
    own_parent = F.when(F.col("depth") == 0, None).when(F.col("depth") == 1, top_id).otherwise(F.col("conv_id"))
    parents = groups.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    far = nodes.where("heads AND depth > 1").join(parents, ["depth", "p1", "p2"], "left")
    out = ["conv_id", "depth", "parent_conv_id", *numbers, "ends_sha256"]
    return near.withColumn("parent_conv_id", own_parent).select(out).union(far.select(out))


def prefix_trie(conversations: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = turns_of(conversations)
    members = write_shared(members_of(turns), "members")
    return trie(turns.join(members, "conv_id"), members, p)


def branched_trie(conversations: DataFrame, apart: int = 5, most: int = 8, p: Parameters = Parameters()) -> DataFrame:
    """The trie of the conversations after each was started like its neighbour (``branched``)."""
    turns, members = branched(turns_of(conversations), apart, most)
    return trie(turns, members, p)
