"""Each operator against a plain statement of its result, on small data."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
import corpus_pipeline
from asiento.llm import language_id, lm_score, quality_rules, simhash, suffix_dedup, word_bpe
from asiento.llm.queries import ORACLE, QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet")
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- against SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert check.compare(spark, check.database(sf_dir), sf_dir, name)[0] == "ok"


def test_short_items_and_runs_equal_sql(spark, tmp_path):
    import duckdb

    rng = random.Random(5)
    words = ["Aa", "b", "É", "c1", "d"]
    docs = [(i, " - ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    items = [(i, ", ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 5, 10, 12])))) for i in range(30)]
    docs += [(100, None), (101, ""), (102, docs[3][1]), (102, docs[3][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op3_decontamination"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert check.canonical(got).equals(check.canonical(con.execute(ORACLE["op3_decontamination"]).df()))


# -- language-model scores


def test_base_scores_and_counts(spark, sf_dir, texts):
    tokens = {i: t.encode().lower().split() + [b"\n"] for i, t in texts.items()}
    learned = {i for i in tokens if zlib.crc32(str(i).encode()) % 5 != 1}
    seen = Counter(w for i in learned for w in tokens[i])
    total = sum(seen.values())
    found = by_id(QUERIES["op1_lm_score"](spark, sf_dir))
    assert found.keys() == tokens.keys()
    for i, words in tokens.items():
        base = sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (len(seen) + 1))) for w in words)
        row = found[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in seen for w in words), total)
        assert row.held_out == (i not in learned) and row.base_score == pytest.approx(base, rel=1e-9)
    held_out = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("size", [(10**6, 10**6), (40, 16)])
def test_scores_mix_the_estimates(spark, monkeypatch, order, size):
    """With weights given, every score is the mixture, whatever blocks and ranges are."""
    mix = np.linspace(0.1, 0.5, order + 1) / np.linspace(0.1, 0.5, order + 1).sum()
    monkeypatch.setattr(lm_score, "weights", lambda *_: np.tile(mix, (66, 1)))
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    p = lm_score.Parameters(order=order, block=size[0], keys=size[1])
    found = by_id(lm_score.score_texts(df, F.col("doc_id") % 4 != 0, p))
    padded = {i: ["^"] * (order - 1) + t.split() + ["$"] for i, t in docs}
    count = Counter()
    for i, words in padded.items():
        for k in range(1, order + 1):
            count.update(tuple(words[a : a + k]) for a in range(len(words) - k + 1) if i % 4)
    total = sum(n for g, n in count.items() if len(g) == 1 and g != ("^",))
    kinds = sum(1 for g in count if len(g) == 1 and g != ("^",))
    for i, words in padded.items():
        score = 0.0
        for at in range(order - 1, len(words)):
            chance = mix[0] / (kinds + 1)
            for k in range(1, order + 1):
                gram = tuple(words[at - k + 1 : at + 1])
                context = count[gram[:-1]] if k > 1 else total
                chance += mix[k] * count[gram] / context if context else 0
            score += math.log10(chance)
        assert found[i].score == pytest.approx(score, rel=1e-9)


def test_weights_climb_the_likelihood():
    p, total = lm_score.Parameters(), lm_score.Totals(100, 9)
    cells = [{"bucket": 3, "logs": [-8, -4], "n": 5}, {"bucket": 3, "logs": [-20, -(2**15)], "n": 2}]
    mix = lm_score.weights(cells, total, p)
    assert mix.sum(axis=1) == pytest.approx(1) and mix[3, 2] > mix[3, 1]

    def likelihood(m):
        return 5 * math.log(m @ [0.1, 0.25, 0.5]) + 2 * math.log(m @ [0.1, 2**-5, 0])

    assert all(likelihood(mix[3]) >= likelihood(np.array(m)) - 1e-6 for m in ([0.3, 0, 0.7], [0.2, 0.1, 0.7], [0.5, 0, 0.5]))


# -- language


def test_held_out_accuracy_and_rejection(spark, sf_dir, texts):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op2_language_id"](spark, sf_dir).collect()
    held_out = [r for r in rows if r.held_out]
    assert len(rows) == len(texts) and len(held_out) > 20
    assert sum(r.lang_pred == labels[r.doc_id] for r in held_out) / len(held_out) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    model = language_id.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    odd = spark.createDataFrame([(1, "ψψ χχχ ωω ψχ ωωω χψ ωψχ χχ ψψψ ωω ψχω χω"), (2, "12 34!"), (3, None)], "doc_id long, text string")
    found = by_id(language_id.identify(odd, model))
    assert all(r.rejected for r in found.values())
    assert found[2].lang_pred == found[3].lang_pred == "und" and found[1].lang_pred != "und"


# -- quality


def plain_measure(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(inside), len(words) < 50 or 100 * len(inside) > 50 * len(words),
    )


def test_quality_counts_and_bands(spark, sf_dir, texts):
    found = by_id(QUERIES["op7_compression_bands"](spark, sf_dir))
    for i, text in texts.items():
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain_measure(text)
        assert not (r.base_failed and r.kept)
    rng = random.Random(2)
    noise = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60)) for _ in range(90))
    words = ["w%d" % n for n in range(3000)]
    turns = " ".join(f"{a} {b} same old filler words again" for a, b in zip(words, reversed(words)))
    rows = [(1, noise), (2, "é" * 9 + " x" * 70), (3, " ".join(["a"] * 60)), (4, turns)]
    found = by_id(quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found[1].whole_ratio > 0.7 and found[2].base_failed and found[3].n_words == 1
    bands = quality_rules.Bands()
    assert bands.judge(5000, 0.1) == -1 and bands.judge(5000, 0.5) == 0 and bands.judge(5000, 0.95) == 1 and bands.judge(50, 3.0) == 0
    assert found[4].kept == (bands.judge(len(turns), found[4].whole_ratio) == 0 and found[4].n_low_chunks * 2 <= found[4].n_chunks)


# From how many bytes on words of these letters shrink less than language, for each length of words.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
RANDOM_WORDS = [
    ("0123456789abcdef", 8192), (LETTERS, 4096), (LETTERS + "0123456789", 2048), (LETTERS + LETTERS.upper() + "0123456789+/", 1024),
]


def test_random_words_are_rejected_and_prose_stays(spark, texts):
    rng, bands = random.Random(3), quality_rules.Bands()
    edges = sorted(b.min_bytes for b in bands.whole) + [16000, 40000]
    rows = []
    for letters, least in RANDOM_WORDS:
        for length in (4, 8, 60):
            for n in {e - 1 for e in edges if e > least} | {e for e in edges if e >= least}:
                words = ["".join(rng.choice(letters) for _ in range(length)) for _ in range(n // length + 1)]
                rows.append((len(rows), " ".join(words)[:n]))
    found = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows) and not any(r.kept for r in found)
    compress = quality_rules.zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress
    for text in texts.values():
        whole = text.encode()
        for data in [whole, *(whole[:e] for e in edges if e <= len(whole))]:
            assert bands.judge(len(data), len(compress(data)) / len(data)) <= 0


# -- exact repeats


def plain_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "trigger", "piece"), [(12, 8, 40), (9, 9, 30), (20, 5, 1000)])
def test_repeats_equal_brute_force(spark, length, trigger, piece):
    rng = random.Random(length)
    rows = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 50))) for _ in range(50)]
    rows += ["a" * 100, "ab" * 60, "é" * 30, None, "", *["xyz" * 9] * 3]
    rows += ["".join(rng.choice("abcdefgh") for _ in range(300)) for _ in range(2)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = by_id(suffix_dedup.remove_repeats(df, suffix_dedup.Parameters(length, trigger, piece, 1 << 16)))
    for i, expected in enumerate(plain_repeats([(t or "").encode() for t in rows], length)):
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == expected


def test_repeats_of_the_table(spark, sf_dir, texts):
    found = by_id(QUERIES["op6_suffix_dedup"](spark, sf_dir))
    for i, expected in zip(texts, plain_repeats([t.encode() for t in texts.values()], 200)):
        assert (found[i].n_bytes, found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == expected


# -- near-duplicates


def plain_components(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_equals_all_pairs(spark, sf_dir, texts):
    prints = {i: simhash.fingerprint_of(t, 3) % 2**64 for i, t in texts.items()}
    expected = plain_components(prints)
    found = by_id(QUERIES["op8_simhash"](spark, sf_dir))
    assert {i: (r.fingerprint, r.component_id) for i, r in found.items()} == {i: (f"{prints[i]:016x}", expected[i]) for i in prints}


@pytest.mark.parametrize("partitions", [1, 2, 3])
def test_links_of_chains_and_dense_clusters(spark, partitions):
    rng = random.Random(partitions)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for base in list(prints)[:4]:
        prints |= {base ^ (1 << a) ^ (1 << b) for a in range(8) for b in range(8)}
        at = base
        for _ in range(12):  # a chain, each two bits from the last
            at ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            prints.add(at)
    signed = {p: p - 2**64 if p >> 63 else p for p in prints}
    nodes = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    linked = simhash.components(simhash.links(nodes, 2, partitions)).collect()
    groups = {}
    for r in linked:
        groups.setdefault(r.root, set()).add(r.node % 2**64)
    expected = {}
    for p, root in plain_components({p: p for p in prints}).items():
        expected.setdefault(root, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_thresholds_keep_the_sum_and_take_the_least():
    assert simhash.allocate([[0, 5, 9, 12], [0, 1, 2, 3], [0, 9, 99, 999]], 0) == [-1, 2, -1]
    assert sum(simhash.allocate([[0, 3, 50, 90]] * 3, 0)) == 0
    parts = simhash.group_bits(100, np.full((64, 64), 25.0) + 25 * np.eye(64), 3)
    assert sorted(b for part in parts for b in part) == list(range(64))


# -- tokens


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def bpe():
    return word_bpe.WordBPE(PATH)


ODD = [
    "", "<|endoftext|>", "a<|startoftext|>B", "ΑΣ ΣΑΣ", "x" * 3000, "don't I'll 'S", "é" * 900 + "é" * 900, "漢字" * 2000,
    "!" * 5000 + "'s", "ab" * 4000 + "<|endoftext|>" + "c" * 100, "İstanbul ǅ ﬁ", "\x1c\x1d a\x85b c", "½²Ⅷ 12", "한국어" * 1500,
    "한" * 900, "<|end", "<|endoftext|>" * 400, "a" * 5000 + "<|endof", "😀" * 2500, "antidisestablish" * 400, "\0\x01",
]


def test_streaming_equals_library(library, bpe):
    rng = random.Random(1)
    odd = ODD + ["".join(rng.choice(letters) for _ in range(n)) for n in (20, 6000) for letters in ("ab", "the ing'sSt", "<|endoftext|>aé", "Σσ ́e")]
    for text in odd:
        ids = library.encode(text, add_special_tokens=False).ids
        assert [*word_bpe.Encoder(bpe).feed(text, last=True)] == ids
        encoder, out, at = word_bpe.Encoder(bpe, keep=50), [], 0
        while at < len(text):
            step = rng.choice([1, 7, 500])
            out += encoder.feed(text[at : at + step])
            at += step
        assert [*out, *encoder.feed("", last=True)] == ids
        assert [i for w in bpe.pre_tokens(text) for i in bpe.encode_word(w)] == ids
        decoder = word_bpe.Decoder(bpe)
        halves = decoder.feed(ids[:7]) + decoder.feed(ids[7:], last=True)
        assert halves == library.decode(ids, skip_special_tokens=False)


def test_readable_decoding_gives_the_words_back(bpe):
    text = "naïve café 漢字 😀 don't"
    decoder, out = word_bpe.Decoder(bpe, joined=False), ""
    for one in word_bpe.Encoder(bpe).feed(text, last=True):
        out += decoder.feed([one])
    assert (out + decoder.feed([], last=True)).split() == bpe.pre_tokens(text)


def test_memory_of_the_stream_is_bounded(bpe):
    encoder, most = word_bpe.Encoder(bpe), 0
    for _ in range(40):
        for _ in encoder.feed("abcde" * 1000):
            pass
        most = max(most, len(encoder.held) + (len(encoder.open.data) if encoder.open else 0))
    assert most < 8 * (bpe.lookahead + 4096)


def test_tables_equal_library(spark, sf_dir, texts, library):
    coded = by_id(QUERIES["op9_bpe_coding"](spark, sf_dir))
    counted = by_id(QUERIES["op10_token_counts"](spark, sf_dir))
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert (coded[i].n_tokens, coded[i].ids_sha256, coded[i].decoded_sha256) == (len(ids), digest, decoded)
        assert (counted[i].n_bytes, counted[i].n_tokens, counted[i].over_limit) == (len(text.encode()), len(ids), len(ids) > 2048)


# -- pipeline


def test_pipeline_stage_by_stage(spark, sf_dir):
    """Each stage against its operator's own verdicts on its own input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], sf_dir)
        kept.append(corpus_pipeline.write_shared(out, name))
        if name != "bpe_coding":
            assert kept[-1].columns == docs.columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    prints = {r.doc_id: simhash.fingerprint_of(r.text, 3) % 2**64 for r in kept[2].collect()}
    assert ids[3] == set(plain_components(prints).values())
    text = {r.doc_id: r.text for r in kept[3].collect()}
    dirty = {r.doc_id for r in corpus_pipeline.read_table(spark, sf_dir, "documents").limit(0).collect()}
    from asiento.llm.decontaminate import contamination

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    dirty |= {r.doc_id for r in contamination(kept[3], benchmark).where("n_hit > 0").collect()}
    assert ids[4] == text.keys() - dirty and ids[5] == ids[4]
    final = corpus_pipeline.run(spark, sf_dir)
    assert {tuple(r) for r in final.collect()} == {tuple(r) for r in kept[5].collect()}
