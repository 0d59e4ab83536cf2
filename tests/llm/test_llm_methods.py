"""That operators work by their methods: decoding decodes, letters are letters, centroids are recomputed plainly."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import regex
from tokenizers import Tokenizer

from asiento.llm import bpe_coding, language_id
from asiento.llm.queries import QUERIES
from asiento.llm.tables import ship

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", " ", "<|endoftext|>", "a<|startoftext|>B c", "ΑΣ ΣΑΣ", "x" * 3000 + " y", "don't I'll 'S", "é" * 900 + " " + "é" * 900, "漢字" * 2000,
    "!" * 500 + "'s", "\x1c\x1d a\x85b\xa0c", "a \x1f b", "½²Ⅷ 12", "한" * 900, "<|end oftext|>", "\n\n a\tb\r\n", "́a ́", "a b　c", "\0\x01 z",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("size", [1 << 16, 40, 7])
def test_coding_in_slices_equals_library(library, monkeypatch, size):
    monkeypatch.setattr(bpe_coding, "SLICE", size)
    monkeypatch.setattr(bpe_coding, "REMEMBERED", 50)
    rng, coder = random.Random(size), bpe_coding.Coder(PATH)
    words = ["the", "Thing,", "étés", "<|endoftext|>", "x" * 70, "'s", "漢字", "½", "\x1e", "é"]
    texts = TEXTS + ["".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n"]) for _ in range(60)) for _ in range(30)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert coder.digests(text) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))


def test_a_wrong_token_shows_in_what_is_decoded():
    coder = bpe_coding.Coder(PATH)
    text = "the quick brown fox " * 3
    before = coder.digests(text)
    first = next(coder.ids(text))[0]
    coder.bpe.tokens = {**coder.bpe.tokens, first: "wrong"}
    after = coder.digests(text)
    assert before[:2] == after[:2] and before[2] != after[2]


def test_numbers_are_no_letters(spark, sf_dir):
    ship(spark)
    rows = [(n, t) for n, t in enumerate(["½ ²", "Ⅷ", "①②", "12", "", None, "é", "ª", "漢"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = language_id.fit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))
    found = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    for n, text in rows:
        known = bool(regex.search(r"\p{L}", text or ""))
        assert (found[n].lang_pred != "und") == known and (known or found[n].score == 0)


@pytest.mark.parametrize("size", [1 << 16, 5])
def test_counts_of_slices(monkeypatch, size):
    monkeypatch.setattr(language_id, "SLICE", size)
    p, rng = language_id.Parameters(), random.Random(size)
    for length in (1, 2, 5, 9, 10, 400):
        text = "".join(rng.choice("aBé1 -漢") for _ in range(length)) + "z"
        total, letters = language_id.counts(text, p)
        wanted = np.zeros(p.slots)
        for slot, n in plain_counts(text, p).items():
            wanted[slot] = n
        assert (total == wanted).all() and letters == len(regex.findall(r"\p{L}", text.lower()))


def plain_counts(text, p):
    """Slots of the letter n-grams, by the arithmetic of the hash in plain integers."""
    plain, found = " " + " ".join(regex.findall(r"\p{L}+", text.lower())) + " ", Counter()
    for order in range(1, p.orders + 1):
        for at in range(len(plain) - order + 1):
            key = 0
            for letter in plain[at : at + order]:
                key = (key * 0x100000001B3 + ord(letter)) % 2**64
            found[((key ^ order) * 0x9E3779B97F4A7C15 % 2**64 >> 40) % p.slots] += 1
    return found


def test_predictions_recomputed(spark, sf_dir):
    """TF-IDF vectors, spherical k-means and cosines over the whole small table, without the operator's code."""
    from zlib import crc32

    p = language_id.Parameters()
    table = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    has_letter = lambda t: bool(regex.search(r"\p{L}", t or ""))
    learned = {(r["lang"], r["text"]) for r in table if crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] and has_letter(r["text"])}
    counts = {t: plain_counts(t, p) for t in {r["text"] for r in table if has_letter(r["text"])}}
    seen = Counter(slot for _, t in learned for slot in counts[t])
    idf = np.array([math.log((1 + len(learned)) / (1 + seen[s])) + 1 for s in range(p.slots)])

    def vector(text):
        row = np.zeros(p.slots)
        for slot, n in counts[text].items():
            row[slot] = math.log1p(n) * idf[slot]
        return row / np.linalg.norm(row)

    vectors = {t: vector(t) for t in counts}
    unit = lambda row: row / np.linalg.norm(row)
    centres = {}
    for lang in {lang for lang, _ in learned}:
        rows = np.array([vectors[t] for language, t in sorted(learned) if language == lang])
        chosen = [unit(rows.mean(axis=0))]
        while len(chosen) < min(p.centroids, len(rows)):
            chosen.append(rows[min(range(len(rows)), key=lambda n: max(float(rows[n] @ c) for c in chosen))])
        for _ in range(p.rounds):
            nearest = [max(range(len(chosen)), key=lambda c: float(row @ chosen[c])) for row in rows]
            groups = [[row for row, c in zip(rows, nearest) if c == n] for n in range(len(chosen))]
            chosen = [unit(np.mean(g, axis=0)) if g else c for g, c in zip(groups, chosen)]
        centres[lang] = chosen
    found = {r.doc_id: r for r in QUERIES["op2_language_id"](spark, sf_dir).collect()}
    for row in table:
        if row["text"] not in vectors:
            assert (found[row["doc_id"]].lang_pred, found[row["doc_id"]].score) == ("und", 0)
            continue
        cosines = {lang: max(float(vectors[row["text"]] @ c) for c in some) for lang, some in centres.items()}
        best = max(cosines.values())
        assert found[row["doc_id"]].score == pytest.approx(best, abs=2e-3)
        assert cosines[found[row["doc_id"]].lang_pred] == pytest.approx(best, abs=2e-3)
