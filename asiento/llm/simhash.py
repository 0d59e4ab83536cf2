"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 bits: the majority of the hashes of a text's word shingles, bit by bit.
Equal fingerprints become one node first, so a group of copies costs one row.

With the bits in m partitions and thresholds t_i that sum to (distance - m + 1), two
fingerprints within the distance differ by at most t_i bits in some partition i; t_i = -1
leaves a partition out. Bits that go together are put into one partition, so that what is
left for the others tells fingerprints apart. Dynamic programming picks the thresholds with the
smallest estimated number of probes and candidates, counted over all fingerprints.

Probing: a fingerprint is a candidate if it meets another one under a partition's key and, by
the same principle once more, under one of three slices of the other bits.
Verifying: two fingerprints are within distance 2 exactly if both are within one flip of some
value. Candidates are grouped by these values; geometry allows no more than 65 in a group,
and each is tied to the group's smallest after their distance is checked. So the rows grow in
proportion to the fingerprints, however many of them lie close together.

Defined results: NULL and empty texts have fingerprint zero, linked like any other. NULL ids
never become a component's id unless it has no other. Copies come out as often as they came
in; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asiento.llm.components import components
from asiento.llm.tables import row_key, write_shared

BITS = 64


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint of one text, as a signed integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles), np.uint64, n)
    total = np.zeros(BITS, np.int64)
    for start in range(0, n, 1 << 15):
        part = hashes[start : start + (1 << 15)].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t, shingle) for t in texts.to_pylist()], pa.int64())

    return fingerprints(text.cast("string"))


# -- partitions and thresholds


def bit_statistics(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how many have bits j and k both set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start in range(0, len(values), 1 << 14):
                part = values[start : start + (1 << 14)]
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
                both += bits.T @ bits
            n += len(values)
        j, k = np.divmod(np.arange(BITS * BITS + 1), BITS)  # the last row holds the number
        sums = np.append(both.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(j), pa.array(k), pa.array(sums)], ["j", "k", "n"])

    rows = nodes.select("fp").mapInArrow(run, "j long, k long, n long").groupBy("j", "k").agg(F.sum("n").alias("n"))
    table = {(r.j, r.k): r.n for r in rows.collect()}  # 64 x 64 + 1 rows
    both = np.array([[table.get((j, k), 0) for k in range(BITS)] for j in range(BITS)], float)
    return table.get((BITS, 0), 0), both


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """m partitions of about equal width; each next bit is the one most correlated with its partition."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    related[spread < 1e-5, :] = related[:, spread < 1e-5] = 1  # constant bits tell nothing: together
    np.fill_diagonal(related, 0)
    left, out = set(range(BITS)), []
    for part in range(m):
        width = len(left) // (m - part)
        rest = sorted(left)
        mine = [max(rest, key=lambda b: related[b, rest].max())]
        while len(mine) < width:
            rest = sorted(left - set(mine))
            mine.append(max(rest, key=lambda b: related[b, mine].mean()))
        left -= set(mine)
        out.append(sorted(mine))
    return out


def part_of(fp: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> 63 else mask))


def equal_pairs(nodes: DataFrame, parts: list[list[int]]) -> list[int]:
    """For each partition, the pairs of fingerprints that agree in it: exact, without pairing."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), part_of(F.col("fp"), b).alias("key")) for i, b in enumerate(parts)]))
    sizes = nodes.select(keys.alias("k")).select("k.*").groupBy("i", "key").count()
    pairs = F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)
    found = {r.i: r.pairs for r in sizes.groupBy("i").agg(pairs.alias("pairs")).collect()}
    return [found.get(i, 0) for i in range(len(parts))]


def allocate(costs: list[list[float]], total: int) -> list[int]:
    """Thresholds from -1 up that sum to ``total`` at the least cost; ``costs[i][t + 1]``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t, more in enumerate(options, start=-1):
                at = (cost + more, [*chosen, t])
                if spent + t not in after or at < after[spent + t]:
                    after[spent + t] = at
        best = after
    return best[total][1]


def plan(nodes: DataFrame, distance: int, m: int) -> list[tuple[list[int], int]]:
    """Partitions and their thresholds."""
    n, both = bit_statistics(nodes)
    parts = group_bits(n, both, m)
    share = np.diag(both) / max(n, 1)
    differ = np.clip(2 * share * (1 - share), 0, 0.5)
    costs = []
    for bits, pairs in zip(parts, equal_pairs(nodes, parts)):
        # Candidates within t bits: those that agree, times what t differing bits add.
        odds = differ[bits] / (1 - differ[bits])
        wider, candidates, options = 1.0, [], [0.0]
        for t in range(distance + 1):
            candidates.append(pairs * wider)
            wider += odds.sum() ** (t + 1)
            probes = n * (1 if t == 0 else 1 + len(bits))
            options.append(probes + candidates[-1])
        costs.append(options)
    return list(zip(parts, allocate(costs, distance - m + 1)))


# -- probe and verify


def _bit(b: int) -> Column:
    return F.lit((1 << b) - (1 << BITS) if b == 63 else 1 << b)


def _keys(fp: Column, bits: list[int], threshold: int) -> list[Column]:
    """The value of a partition, and each value one flip away if the threshold needs it."""
    value = part_of(fp, bits)
    return [value, *(value.bitwiseXOR(_bit(b)) for b in bits if threshold > 0)]


def _probe_keys(fp: Column, bits: list[int], threshold: int, distance: int, i: int) -> list[Column]:
    """Keys of one partition, each with one slice of the other bits.

    Whatever agrees on the partition differs in at most ``distance`` of the other bits, so of
    ``distance + 1`` slices of these at least one agrees as well.
    """
    rest = sorted(set(range(BITS)) - set(bits))
    slices = [rest[k :: distance + 1] for k in range(distance + 1)]
    return [
        F.struct(F.lit(i * BITS + j).alias("i"), key.alias("key"), part_of(fp, bits_of).alias("rest"))
        for key in _keys(fp, bits, threshold)
        for j, bits_of in enumerate(slices)
    ]


def links(nodes: DataFrame, distance: int = 2, partitions: int = 3) -> DataFrame:
    """Links ``a < b`` that connect whatever lies within ``distance``, from distinct ``fp``."""
    if not 0 <= distance <= 2:
        raise ValueError("a meeting of one-flip neighbourhoods decides distances up to 2")
    fp = F.col("fp")
    keys = [
        key
        for i, (bits, t) in enumerate(plan(nodes, distance, partitions))
        if t >= 0
        for key in _probe_keys(fp, bits, t, distance, i)
    ]
    probes = nodes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.*")
    place = ["i", "key", "rest"]
    shared = probes.groupBy(*place).agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low < high")
    candidates = probes.join(shared, place, "left_semi").select("fp").distinct()
    candidates = write_shared(candidates, "candidates")
    near = F.array(fp, *(fp.bitwiseXOR(_bit(b)) for b in range(BITS)))
    met = candidates.select("fp", F.explode(near).alias("value")).groupBy("value").agg(F.collect_set("fp").alias("fps"))
    tied = met.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return tied.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, distance)).distinct()


def grouped(docs: DataFrame, shingle: int = 3, distance: int = 2, partitions: int = 3) -> DataFrame:
    """``doc_id, row_key, fp, root, component_id``; ``root`` is the component's least fingerprint."""
    own = docs.select("doc_id", row_key(F.col("text")).alias("row_key"), fingerprint(F.col("text"), shingle).alias("fp"))
    own = write_shared(own, "fingerprints")
    nodes = write_shared(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = components(links(nodes, distance, partitions)).toDF("fp", "root")
    rooted = nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").select("fp", "root", "component_id")
    return own.join(named, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, partitions: int = 3) -> DataFrame:
    """``doc_id, row_key, fp, component_id``, one row for each row of ``docs``."""
    return grouped(docs, shingle, distance, partitions).drop("root")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2, partitions: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id."""
    # Ids may repeat or be NULL, so components are told apart by their root; the key of the text
    # decides between rows of one id.
    least = grouped(docs, shingle, distance, partitions).groupBy("root")
    first = least.agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("r"))
    stays = first.select(F.col("r.doc_id").alias("stay_id"), F.col("r.row_key").alias("stay_key")).distinct()
    held = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("stay_id"), row_key(F.col("text")).alias("stay_key"))
    both = held["stay_id"].eqNullSafe(stays["stay_id"]) & (held["stay_key"] == stays["stay_key"])
    kept = held.join(stays, both, "left_semi")
    # Copies may differ in other columns: the order of whole rows decides, so a task that runs again keeps the same one.
    copy = Window.partitionBy("stay_id", "stay_key").orderBy(F.xxhash64(F.to_json("row")))
    return kept.withColumn("copy", F.row_number().over(copy)).where("copy = 1").select("row.*")
