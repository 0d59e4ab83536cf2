"""Collocations, the prefix trie and the source mix against plain statements, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from asiento.llm import collocations as co
from asiento.llm import mixing, prefix_trie
from asiento.llm.queries import QUERIES
from asiento.llm.tables import ship

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


# -- collocations


def plain_collocations(rows, p):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        phrases = {g: a for g, a in f.items() if len(g) > 1 and a >= p.min_count}
        longer = Counter()
        for g, a in phrases.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i : i + m]] = max(longer[g[i : i + m]], a)
        found = []
        for g, a in phrases.items():
            if longer[g] and 100 * longer[g] >= p.covered * a:
                continue
            score, k = min((p.scale * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: p.top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("p", [co.Parameters(), co.Parameters(min_count=2, top=50, block=500, shard=1000)])
def test_collocations_of_the_table(spark, sf_dir, p):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    wanted = plain_collocations(zip(table["lang"].to_pylist(), table["text"].to_pylist()), p)
    assert rows_of(co.collocations(docs, p)) == wanted
    if p == co.Parameters():
        assert rows_of(QUERIES["op11_collocations"](spark, sf_dir)) == wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_across_blocks_and_slices(spark, monkeypatch, seed):
    """Pieces longer than a block or a slice, ties, NULLs, and words that few have."""
    monkeypatch.setattr(co, "SLICE", 64)
    rng = random.Random(seed)
    words = ["Aa", "b", "É", "c-1", " d", "x" * 90]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 200))) for _ in range(30)]
    texts += ["b " * 500, "b\t" * 500, None, "", " .,; \n", "rare words only"]
    rows = [(rng.choice(["en", "fr", None, "und"]), t) for t in texts]
    p = co.Parameters(min_count=3, top=40, block=64, shard=50)
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "lang string, text string, id long, key string").repartition(3)
    assert rows_of(co.collocations(docs, p)) == plain_collocations(rows, p)


def test_collocations_of_blocks_with_many_words(spark):
    """Places of a block's words take 16 bits, and 32 where it has more words than these tell apart."""
    many = " ".join(f"w{n}" for n in range(70_000))
    rows = [("aa", f"{many}. w69998 w69999 w3 w4."), ("bb", "one two one two")]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    p = co.Parameters(min_count=2)
    widths = {r.lang: len(r.stream) // (r.size + r.overlap) for r in co.blocks_of(docs, p).collect()}
    assert widths == {"aa": 4, "bb": 2}
    assert rows_of(co.collocations(docs, p)) == plain_collocations(rows, p)


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None)], [("en", "one two three")]):
        assert co.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


@pytest.mark.parametrize("words", [2, 3, 4])
@pytest.mark.parametrize("bits", [1, 7, 16, 17, 32])
def test_filters_lose_nothing(words, bits):
    rng = np.random.default_rng(words * bits)
    ids = [rng.integers(0, 1 << bits, 3000, dtype=np.uint64) for _ in range(words)]
    for log_shards in {0, min(3, (words + 1) // 2 * bits - 1)}:
        layout = co.Layout(words, bits, log_shards)
        left, right, counts = co.summed(*layout.pairs(ids))
        shards, back = layout.shard(left), Counter()
        for shard in np.unique(shards):
            here = shards == shard
            filtered = layout.packed(left[here], right[here], counts[here])
            found = layout.opened(int(shard), *filtered)
            assert all((a == b[here]).all() for a, b in zip(found, (left, right, counts)))
            for *gram, n in zip(*layout.ids(*found[:2]), found[2]):
                back[tuple(map(int, gram))] += int(n)
        assert back == Counter(tuple(map(int, gram)) for gram in zip(*ids))


# -- the prefix trie


def plain_trie(rows, apart=5, folds=9):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: t[0])
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % folds
        built[conv] = [t[1:] for t in own.get(conv - conv % apart, [])[:h]] + [t[1:] for t in turns[h:]]
    nodes, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(conv)
    children.update(node[:-1] for node in nodes if node)
    for node, members in nodes.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members) - 1) * len(node[-1][1].encode()) if node else 0
    out = set()
    for node, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(node))))
        parent = min(nodes[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(members), len(node), parent, len(members), children[node], leaves[node], saved[node], digest))
    return out


def test_trie_of_the_table(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table]
    assert rows_of(QUERIES["op12_prefix_trie"](spark, sf_dir)) == plain_trie(rows)


CONVERSATION = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("p", [prefix_trie.Parameters(), prefix_trie.Parameters(rows=1, cells=1, max_log_width=15)])
@pytest.mark.parametrize("chunk", [1024, 3])
def test_trie_of_many_copies(spark, monkeypatch, p, chunk):
    """Hot nodes, conversations longer than a chunk, NULLs, gaps in the turns, several chunks of ids."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "ENDS", 4)
    rng = random.Random(chunk)
    rows = []
    for conv in [*range(-7, 90), *range(1000, 1200, 3), 2**40]:
        for place in range(rng.choice([1, 2, 2, 5, 14])):
            turn = None if place == 0 and rng.random() < 0.2 else 3 * place + rng.randint(0, 2)
            rows.append((conv, turn, rng.choice([None, "", "user"]) if place % 5 == 4 else "user", rng.choice(["é", "é", "b", None])))
    rows.append((None, 1, "user", "of no conversation"))
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{CONVERSATION}, depth int, len string").repartition(3)
    # Turns of one number differ in nothing that the order of equals could show.
    assert len({r[:2] for r in rows}) == len(rows)
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert rows_of(prefix_trie.branched_trie(df.where("conv_id IS NULL OR conv_id >= 0"), p=p)) == plain_trie(positive)
    assert rows_of(prefix_trie.prefix_trie(df, p)) == plain_trie(rows, folds=1)


def test_trie_of_few_rows(spark):
    trie = lambda rows: rows_of(prefix_trie.branched_trie(spark.createDataFrame(rows, CONVERSATION)))
    assert trie([]) == set() and trie([(None, 1, "a", "b")]) == set()
    for rows in ([(3, 1, "a", "b")], [(0, 1, None, None), (0, 1, None, None)], [(4, 0, "u", "x" * 100_000)]):
        assert trie(rows) == plain_trie(rows)


# -- the mix


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    target, left, open_ = {}, Fraction(sum(sizes.values())), set(order)
    while True:
        whole = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / whole > most * sizes[s]}
        if not above:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in above:
            target[s] = Fraction(most * sizes[s])
        left -= sum(target[s] for s in above)
        open_ -= above


def check_mix(found, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, size(t)) for d, t, _ in docs)
    sizes, taken, rows = Counter(), Counter(), Counter()
    for _, text, source in docs:
        sizes[source] += size(text)
        rows[source] += 1
    targets = plain_targets(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(targets[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    return targets, taken


def test_mix_of_the_table(spark, sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    docs = list(zip(*(table[c].to_pylist() for c in ("doc_id", "text", "source"))))
    found = QUERIES["op13_source_mix"](spark, sf_dir).collect()
    targets, taken = check_mix(found, docs)
    # The table's copies have ids of their own, so nothing is lost among copies.
    assert all(taken[s] == int(t) for s, t in targets.items())
    assert sorted(found) == sorted(QUERIES["op13_source_mix"](spark, sf_dir).collect())


def test_mix_with_full_sources_and_copies(spark):
    rng = random.Random(4)
    docs = [(n, "w " * rng.randint(0, 30), rng.choice(["a", "b", "b", "b", "é", "", None])) for n in range(200)]
    docs += [(300, "one two three", "c"), (301, None, "d"), (None, " \n", "d"), (302, "x " * 5000, "b"), (303, "huge " * 3000, "zz")]
    docs += [(7, "the same seven words in every copy", "e")] * 40
    schema = "doc_id long, text string, source string, size string, target int, key string, row int"
    df = spark.createDataFrame([(*d, "s", 1, "k", 2) for d in docs], schema).repartition(4)
    targets, taken = check_mix(mixing.mix(df).collect(), docs)
    assert any(t == 3 * s for t, s in ((targets["c"], 3), (targets["e"], 280)))
    for source, target in targets.items():
        assert int(target) - 40 < taken[source] <= int(target)
    assert {r.taken for r in mixing.mix(df).where("source = 'd'").collect()} == {0}
    assert mixing.mix(df.limit(0)).collect() == []


def test_the_mix_itself(spark):
    docs = [(n, f"  a{n} b\n c  d ", "s" if n % 3 else "t") for n in range(30)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    words, copies = Counter(), defaultdict(list)
    for r in mixing.mixture(df).collect():
        words[r.row.doc_id] += len(r.mixed.split())
        copies[r.row.doc_id].append(r.epoch)
        assert r.mixed == r.row.text or r.row.text.split()[: len(r.mixed.split())] == r.mixed.split()
    assert words == {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken}
    assert all(sorted(e) == list(range(1, len(e) + 1)) for e in copies.values())


def test_targets_do_not_depend_on_the_order(spark):
    sizes = {f"s{n}": n * n % 17 * 10 for n in range(14)}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(df).collect()}
    assert found == pytest.approx({s: float(t) for s, t in plain_targets(sizes).items()}, rel=1e-12)
    assert all(r.target == 0 for r in mixing.targets(df.withColumn("source_size", F.lit(0).cast("long"))).collect())


def test_the_sketch_reaches_the_driver_in_few_jobs(spark, sf_dir):
    """Not in one job for each partition of the aggregation."""
    prefixes = spark.range(2000).selectExpr("id % 5 depth", "id % 700 d1", "id d2").unionAll(spark.range(9).selectExpr("id % 5", "id", "id"))
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.sparkContext.setJobGroup("sketch", "sketch")
    try:
        sketch = prefix_trie.sketch_of(prefixes, prefix_trie.Parameters())
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("sketch")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert any(sketch.crowded)
    assert len(jobs) < 40
