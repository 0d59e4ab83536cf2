"""Licence rules: wrapped texts of every rule, next to the check statement and its own wordings."""

from __future__ import annotations

import random
import textwrap

import check
import pytest

from asiento.llm.licence_rules import RULES, SENTENCES
from asiento.llm.licences import licences
from asiento.llm.queries import ORACLE, QUERIES

SEQUENCES = {tuple(names): licence for licence, variants in RULES.items() for names in variants}


def every(name):
    known = SENTENCES[name]
    return (known,) if isinstance(known, str) else known


def wording(rng, name):
    return rng.choice(every(name))


def wrapped(rng, names, gap="\n\n"):
    return gap.join(textwrap.fill(wording(rng, n), rng.choice((24, 40, 60, 78)), break_long_words=False, break_on_hyphens=False) for n in names)


def test_rules_are_sound():
    assert len(RULES) >= 30 and len(SEQUENCES) == sum(map(len, RULES.values()))
    # The longest sentence is taken, so one that tells a licence must not begin another that doesn't.
    alone = [w.rstrip(".") for names in SEQUENCES if len(names) == 1 for w in every(names[0])]
    begun = {n for n in SENTENCES for w in every(n) if any(w != a and w.rstrip(".") != a and w.startswith(a) for a in alone)}
    assert all((n,) in SEQUENCES for n in begun) and "apache2-grant" in begun
    assert {n for names in SEQUENCES for n in names} == set(SENTENCES)
    # Rules taken from the left give what dropping covered rules gives, as no rule ends in the beginning of another.
    for one in SEQUENCES:
        for other in SEQUENCES:
            assert not any(one[-k:] == other[:k] for k in range(1, min(len(one), len(other))))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    rows = []
    for names, licence in SEQUENCES.items():
        rows.append((f"Notes on {licence}\n\n" + wrapped(rng, names) + "\n\nother words", [licence]))
        numbered = "Terms:\n" + "\n".join(f"{n}. {textwrap.fill(wording(rng, s), 50)}" for n, s in enumerate(names, 1))
        rows.append((numbered, None if "copy-at" in names else [licence]))  # after a line without an end, a number is a word
        words = wrapped(rng, names).split(" ")
        words[len(words) // 2] += " odd"
        rows.append((" ".join(words), None))  # a sentence changed: whatever is left
    rows += [(text, []) for text in (None, "", " \n\t", "1. \n2. \n", "MIT", "the MIT License", "-\n-\n-", "ä• ß\n• x")]
    both = wrapped(rng, RULES["BSD-3-Clause"][0]) + "\n\n" + wrapped(rng, RULES["MIT"][0])
    rows += [(both, ["BSD-3-Clause", "MIT"]), (both + "\n" + both, ["BSD-3-Clause", "MIT"])]
    rows.append(("\n1. Licensed under CC BY 4.0.\n\n2. Licensed under CC BY-SA 4.0", ["CC-BY-4.0", "CC-BY-SA-4.0"]))
    return rows


def test_wrapped_licences_equal_the_statement(spark, tmp_path, rows):
    table = spark.createDataFrame([(n, text) for n, (text, _) in enumerate(rows)], "doc_id long, text string")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op4_licences"](spark, str(tmp_path)).toPandas()
    by_id = dict(zip(found.doc_id, found.licences))
    for n, (text, wanted) in enumerate(rows):
        assert wanted is None or by_id[n] == ",".join(wanted), text
    con = check.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    stated = con.execute(ORACLE["op4_licences"]).df()
    stated = {r.doc_id: (r.licences, r.n_matches) for r in stated.itertuples()}
    differing = [(rows[r.doc_id][0], (r.licences, r.n_matches), stated[r.doc_id]) for r in found.itertuples() if stated[r.doc_id] != (r.licences, r.n_matches)]
    assert len(found) == len(stated) and not differing, differing[:3]


def test_a_changed_sentence_is_not_found(spark):
    rng = random.Random(9)
    rows = []
    for licence, variants in RULES.items():
        text = wrapped(rng, variants[-2] if len(variants) > 2 else variants[0])
        rows.append((licence, text.replace(text.split()[2], "altered", 1)))
    found = {r.doc_id: r.licences for r in licences(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert all(licence not in found[licence] for licence in RULES)


def test_a_very_long_text(spark):
    text = "plain words of a long text. " * 80_000 + "\n" + wrapped(random.Random(1), RULES["ISC"][-1]) + "\n" + "more of it\n" * 50_000
    found = licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r.licences, r.n_matches) for r in found] == [(["ISC"], 1)]


def test_own_sentences_and_rules(spark):
    sentences = {"a": "First one.", "b": ("Second one.", "Another second."), "c": "Third."}
    rules = {"AB": [["a", "b"]], "ABC": [["a", "b", "c"]], "C": [["c"]]}
    rows = [(1, "first one. second ONE. third."), (2, "First\none.\nAnother second!\nx\nThird"), (3, "third. third."), (4, "second one. first one.")]
    found = {r.doc_id: (r.licences, r.n_matches) for r in licences(spark.createDataFrame(rows, "doc_id long, text string"), sentences, rules).collect()}
    assert found == {1: (["ABC"], 1), 2: (["AB", "C"], 2), 3: (["C"], 2), 4: ([], 0)}
