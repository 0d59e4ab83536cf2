"""NULLs, empty and long texts, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from asiento.llm.bpe_coding import decode, encode, encode_texts
from asiento.llm.decontaminate import clean, contamination
from asiento.llm.language_id import fit, identify, keep_known
from asiento.llm.licences import licences
from asiento.llm.line_dedup import Parameters as LineParameters
from asiento.llm.line_dedup import drop_boilerplate, without_boilerplate
from asiento.llm.lm_score import score_texts
from asiento.llm.quality_rules import quality_rules
from asiento.llm.simhash import fingerprint_of, near_duplicates, one_of_each
from asiento.llm.suffix_dedup import remove_repeats
from asiento.llm.token_counts import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
CLASHES = "row string, found string, kept long, score string, h long, words string, n long, key string, id string, row_key string, fp string, stay_id string, copy int, site string, own_id int, text_ string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"
LONG = " ".join(f"w{n % 997}{'x' * (n % 7)}" for n in range(60_000))
PLAIN = "The cat sat on the mat and looked at the moon for a very long time indeed"

TEXTS = [
    (1, None, None, None), (None, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", "en", None), (4, PLAIN, "en", "a"),
    (4, PLAIN, "en", "a"), (None, PLAIN, None, "b"), (None, PLAIN, None, "b"), (5, LONG, "en", "c"), (6, "12 34 ...", "fr", "d"),
    (4, "another text under an id that is taken", "fr", "e"), (7, "Released under the MIT License.\n" + PLAIN, "en", "f"),
]


@pytest.fixture(scope="module")
def docs(spark):
    fill = ["x", "y", 1, "z", 2, "v", 3, "k", "i", "r", "f", "s", 4, "t", 5, "u"]
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *fill) for i, t, g, s in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PLAIN), (1, PLAIN), (None, "very long time"), (2, None), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("win", F.lit(1)).withColumn("size", F.lit("s"))


OPERATORS = {
    "lm_score": lambda d, b: score_texts(d, F.col("doc_id") != 4),
    "language_id": lambda d, b: identify(d, fit(d)),
    "contamination": lambda d, b: contamination(d, b),
    "licences": lambda d, b: licences(d),
    "line_dedup": lambda d, b: without_boilerplate(d).select("row.doc_id", "n_lines", "n_removed", "kept"),
    "suffix_dedup": lambda d, b: remove_repeats(d),
    "quality_rules": lambda d, b: quality_rules(d),
    "simhash": lambda d, b: near_duplicates(d),
    "bpe_coding": lambda d, b: encode_texts(d, PATH),
    "token_counts": lambda d, b: token_counts(d, PATH),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(docs, benchmark, name):
    """Also with few rows of their own, so that no copy is lost or doubled."""
    out = OPERATORS[name](docs, benchmark).select("doc_id").collect()
    assert sorted(map(str, (r.doc_id for r in out))) == sorted(map(str, (t[0] for t in TEXTS)))


@pytest.mark.parametrize("name", OPERATORS)
def test_copies_come_out_alike(docs, benchmark, name):
    rows = [tuple(map(str, r)) for r in OPERATORS[name](docs.where(F.col("text") == PLAIN), benchmark).collect()]
    assert len(rows) == 4 and len({r[1:] for r in rows}) == 1


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, benchmark, name):
    assert OPERATORS[name](docs.limit(0), benchmark.limit(0)).collect() == []


def test_empty_benchmark_and_no_labels(docs, benchmark):
    assert all(r.n_hit == 0 for r in contamination(docs, benchmark.limit(0)).collect())
    assert all(r.rejected for r in identify(docs, fit(docs.where("lang = 'none'"))).collect())


def test_hits_of_the_edge_table(docs, benchmark):
    rows = contamination(docs, benchmark).collect()
    hit = {(r.doc_id, r.n_hit, tuple(r["items"])) for r in rows if r.n_hit}
    assert hit == {(4, 17, ("1", "null")), (None, 17, ("1", "null")), (7, 17, ("1", "null"))}
    assert clean(docs, benchmark).count() == len(rows) - 5


STAGES = {
    "keep_known": lambda d, b: keep_known(d, fit(d)),
    "drop_boilerplate": lambda d, b: drop_boilerplate(d),
    "one_of_each": lambda d, b: one_of_each(d),
    "clean": lambda d, b: clean(d, b),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns(docs, benchmark, name):
    out = STAGES[name](docs, benchmark)
    assert out.columns == docs.columns and out.count() <= len(TEXTS)
    assert STAGES[name](docs.limit(0), benchmark).count() == 0


def test_one_of_each_group_stays(docs):
    out = one_of_each(docs).collect()
    assert sum(r.text == PLAIN for r in out) == 1 and sum((r.text or "").strip() == "" for r in out) == 1
    assert [r.doc_id for r in out if r.text == PLAIN] == [4]


def test_groups_are_components_and_not_ids(spark, docs):
    """Unlinked texts under one id stay; of linked texts without ids one stays."""
    assert sorted(r.text for r in one_of_each(docs).collect() if r.doc_id == 4) == [PLAIN, "another text under an id that is taken"]
    words = [f"w{n}" for n in range(3000)]
    near = [" ".join(words[: n // 2] + [f"x{n}"] + words[n // 2 + 1 :]) for n in range(200, 240)]
    prints = [fingerprint_of(t, 3) % 2**64 for t in near]
    a, b = next((i, j) for i in range(40) for j in range(i) if 1 <= (prints[i] ^ prints[j]).bit_count() <= 2)
    rows = [(None, near[a]), (None, near[b]), (None, PLAIN), (1, "yet one more text"), (1, "quite another text"), (1, near[a] + " far" * 2000)]
    out = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 5 and sum(r.text in (near[a], near[b]) for r in out) == 1


def test_unknown_texts_are_rejected(docs):
    kept = keep_known(docs, fit(docs)).collect()
    assert all(any(c.isalpha() for c in r.text or "") for r in kept) and sum(r.text == PLAIN for r in kept) == 4


def test_lines_by_sites(spark):
    rows = [(n, f"own line {n}\n  Menu \nHome", f"s{n % 5}") for n in range(10)]
    rows += [(10, "Menu\nHome", "s1"), (11, "Menu\n\nstays", "s9"), (12, None, "s3"), (13, "", None), (14, "two\nsites", "s1"), (15, "two", "s2")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in without_boilerplate(df, p=LineParameters(min_sites=5)).select("row.doc_id", "n_lines", "n_removed", "kept").collect()}
    assert found[3] == (3, 2, "own line 3") and found[10] == (2, 0, "Menu\nHome")
    assert found[11] == (3, 1, "\nstays") and found[12] == (0, 0, None) and found[13] == (0, 0, "")
    assert found[14] == (2, 0, "two\nsites")


def test_rules_need_all_sentences_in_order(spark):
    one = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    two = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    three = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    rows = [(1, "\n".join(("x", one, two, three))), (2, "\n".join((two, one, three))), (3, " ".join((one.upper(), two, three)) * 1),
            (4, "\n".join((one, two, "between", three))), (5, "Released under the MIT License. Released, under the MIT license.")]
    found = {r.doc_id: (r.licences, r.n_matches) for r in licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: (["BSD-2-Clause"], 1), 2: ([], 0), 3: (["BSD-2-Clause"], 1), 4: ([], 0), 5: (["MIT"], 2)}


HEAD = "Some Package\nCopyright (c) 2020 A. Author\n\n"
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
UNLICENSE = "This is free and unencumbered software released into the public\ndomain."
STANDARD = {
    "MIT": (MIT, ["MIT"]), "ISC": (ISC, ["ISC"]), "BSD2": (BSD2, ["BSD-2-Clause"]), "BSD3": (BSD3, ["BSD-3-Clause"]),
    "APACHE": (APACHE, ["Apache-2.0"]), "GPL": (GPL, ["GPL-3.0"]), "MPL": (MPL, ["MPL-2.0"]), "UNLICENSE": (UNLICENSE, ["Unlicense"]),
    "bullets": (BSD2.replace("1.", "\u2022").replace("2.", "*"), ["BSD-2-Clause"]), "letters": (BSD2.replace("1.", "(a)").replace("2.", "(b)"), ["BSD-2-Clause"]),
    "notice": ("Licensed under the Apache\nLicense, Version 2.0.\nThis work is licensed under the GNU General Public License, version\n3. More.", ["Apache-2.0", "GPL-3.0"]),
    "others": ("Licensed under\nCC BY 4.0.\nLicensed under CC\nBY-NC 4.0. All rights\nreserved.", ["All-rights-reserved", "CC-BY-4.0", "CC-BY-NC-4.0"]),
}


def test_standard_wrapped_licences_are_found(spark):
    wrapped = {
        (name, form): change(HEAD + text)
        for name, (text, _) in STANDARD.items()
        for form, change in {
            "plain": str, "comment": lambda t: "".join(f" * {x}\n" for x in t.split("\n")), "hash": lambda t: "".join(f"# {x}\n" for x in t.split("\n")),
            "crlf": lambda t: t.replace("\n", "\r\n"), "one line": lambda t: t if "\u2022" in t else "\n".join(" ".join(x.split()) for x in t.split("\n\n")),
        }.items()
    }
    rows = [(f"{name} {form}", text) for (name, form), text in wrapped.items()]
    found = {r.doc_id: (r.licences, r.n_matches) for r in licences(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert found == {f"{name} {form}": (STANDARD[name][1], len(STANDARD[name][1])) for name, form in wrapped}


def test_pieces_of_a_rule_are_not_enough(spark):
    broken = [MIT.replace("free of charge", "free\nof all charge"), "x " + UNLICENSE, UNLICENSE[:-1] + " at last", BSD2.replace("\n\n2.", "\nbetween\n\n2.")]
    rows = [(n, text) for n, text in enumerate(broken)]
    assert all(r.licences == [] and r.n_matches == 0 for r in licences(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_ids_and_text_of_columns(docs):
    out = docs.select("text", encode(PATH, F.col("text")).alias("ids")).withColumn("again", decode(PATH, F.col("ids"), joined=False))
    for r in out.collect():
        assert r.again.split() == (r.again.strip().split() if r.text else [])
        assert bool(r.ids) == bool((r.text or "").strip())


def test_pipeline_over_an_empty_table(spark, sf_dir, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
