import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from helpers import AWKWARD, docs_of
from tokenizers import Tokenizer

from halfstar.llm import decontaminate as D
from halfstar.llm import licences as N
from halfstar.llm import lines as L
from halfstar.llm import quality as Q
from halfstar.llm import tokens as T

BPE = public_tokenizers.path("word_bpe_49k.json")


# --- lines ---


def slow_clean(rows, sites, chars):
    seen, first = defaultdict(set), {}
    for i, t, s in rows:
        for line in (t or "").split("\n"):
            line = line.strip(" \t\r")
            if len(line) >= chars:
                seen[line].add(s)
                first[line] = min(first.get(line, (i is None, i or 0)), (i is None, i or 0))
    out = []
    for i, t, s in rows:
        kept = [
            x for x in (t or "").split("\n")
            if len(seen.get(x.strip(" \t\r"), ())) < sites or first[x.strip(" \t\r")] == (i is None, i or 0)
        ]
        gone = len((t or "").split("\n")) - len(kept)
        out.append((str(i), str("\n".join(kept) if gone else t), gone))
    return sorted(out)


def boilerplate_rows():
    rnd = random.Random(2)
    nav = ["Home, news and everything about us", "All the rights of this site are reserved", "short one"]
    rows = []
    for i in range(60):
        body = [f"Sentence number {rnd.randint(0, 10**6)} of this text." for _ in range(3)]
        if i % 3 == 0:
            body.insert(1, nav[i % 2] + " \r")
        if i % 4 == 0:
            body.insert(0, nav[2])
        rows.append((100 + i, "\n".join(body), f"site{i % 7}"))
    return rows


@pytest.mark.parametrize("sites", [2, 5, 7, 8])
def test_lines_against_brute_force(spark, sites):
    rows = boilerplate_rows() + AWKWARD
    got = L.remove_boilerplate(docs_of(spark, rows, clash=True), min_sites=sites)
    assert sorted((str(r.doc_id), str(r.text), r.n_removed) for r in got.collect()) == slow_clean(rows, sites, 20)


def test_lines_many_sites_stay_exact_near_the_threshold(spark):
    rows = [(i, f"the very same line everywhere\nown line number {i} of many", f"s{i}") for i in range(400)]
    for sites, gone in ((399, 399), (400, 399), (401, 0)):
        got = L.remove_boilerplate(docs_of(spark, rows), min_sites=sites)
        assert got.filter("n_removed > 0").count() == gone


def test_clean_lines_keeps_columns_and_drops_emptied(spark):
    rows = [(i, "this line is on every single site", f"s{i}") for i in range(9)] + [(50, "", "s1"), (51, None, "s2")]
    docs = docs_of(spark, rows, clash=True)
    kept = L.clean_lines(docs)
    assert kept.columns == docs.columns and kept.schema["n_chars"] == docs.schema["n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, 50, 51]
    assert L.clean_lines(docs_of(spark, [])).count() == 0


# --- tokens ---


def library(texts):
    t = Tokenizer.from_file(BPE)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_token_counts_equal_the_library(spark):
    rows = AWKWARD + [(20, "x" * 9000, "s"), (21, "don't 'll we've I'M 's 12 3³ <|startoftext|>", "s")]
    got = T.token_counts(docs_of(spark, rows, clash=True), BPE).collect()
    texts = [t or "" for _, t, _ in rows]
    expected = [(i, len(t.encode()), n, n > 2048) for (i, _, _), t, n in zip(rows, texts, library(texts))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert T.token_counts(docs_of(spark, []), BPE).count() == 0


def test_token_lookup_on_random_latin_text(monkeypatch):
    monkeypatch.setattr(T, "PIECE", 40)
    monkeypatch.setattr(T, "CACHE_WORDS", 50)
    spec = open(BPE, encoding="utf-8").read()
    tokenizer = Tokenizer.from_str(spec)
    count = T.counter(spec, T.frequent_lengths(tokenizer))
    rnd = random.Random(4)
    alphabet = "abcXYZ' st re ve \n\t\r0123²½.,!?#$%&*|<>\"-_«»" + "".join(map(chr, range(0xA1, 0x180)))
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 150))) for _ in range(1500)]
    assert count(texts) == library(texts)


# --- quality ---


def quality_rows(n=300, seed=3):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = [rnd.choice(["stone", "river", "the", "of", "light", "under", "walked", "slow"]) + rnd.choice(["", "s", "ed"]) for _ in range(rnd.randint(5, 120))]
        text = " ".join(words) if good else rnd.choice([" ".join(w.upper() + "!!" for w in words), " | ".join(words), "%%% ".join(words), "spam " * len(words)])
        rows.append((i, text, f"s{i % 3}"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark):
    rows, labels = quality_rows()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.quality_scores(docs_of(spark, rows), marks).collect()
    import zlib

    truth = {i: y for i, y, _ in labels}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_quality_ignores_held_out_labels_ids_and_sources(spark):
    import zlib

    rows, labels = quality_rows()
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y, 1) for i, y, _ in labels]
    one, two = (
        Q.quality_scores(docs_of(spark, r), spark.createDataFrame(m, "doc_id long, quality int, toxic int"))
        for r, m in ((rows, labels), ([(i, t, "z") for i, t, _ in rows], flipped))
    )
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_quality_of_awkward_rows(spark):
    rows, labels = quality_rows(80)
    awkward = [(i and i + 1000, t, s) for i, t, s in AWKWARD]
    marks = spark.createDataFrame([*labels, (None, 1, 0), (3, None, 0), (1, 0, 0), (1, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, rows + awkward, clash=True)
    got = Q.quality_scores(docs, marks).collect()
    assert len(got) == len(rows) + len(awkward) and all(r.score is not None for r in got)
    assert Q.keep_quality(docs, marks).columns == docs.columns
    nothing = marks.limit(0)
    assert Q.keep_quality(docs, nothing).count() == docs.count()
    assert Q.keep_quality(docs_of(spark, []), marks).count() == 0


def test_pairwise_fit_orders_the_sides():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 0.5 * x[:, 2] > -0.6).astype(int)
    weights, cut = Q.fit(x, y)
    score = np.clip((x - weights[0]) / weights[1], -8, 8) @ weights[2]
    assert np.mean((score >= cut) == (y == 1)) > 0.97


# --- decontamination ---


def bench_and_docs():
    rnd = random.Random(6)
    pool = [f"word{i}" for i in range(3000)]
    items = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randint(10, 70)))) for i in range(40)]
    rows, truth = [], set()
    for d in range(160):
        around = [rnd.choice(pool) for _ in range(80)]
        if d % 2:
            i, text = items[rnd.randrange(40)]
            w = text.split()
            for _ in range(rnd.randint(0, int(D.EDITS * len(w)))):
                at = rnd.randrange(len(w))
                rnd.choice([lambda: w.pop(at), lambda: w.insert(at, "zzz"), lambda: w.__setitem__(at, "yyy")])()
            middle = " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)
            rows.append((d, " ".join(around[:40]) + ". " + middle + ",\n" + " ".join(around[40:]), "s"))
            truth.add((d, i))
        else:
            rows.append((d, " ".join(around), "s"))
    return items, rows, truth


def slow_hits(items, rows):
    out = set()
    for d, t, _ in rows:
        code = {}
        doc = np.array([code.setdefault(w, len(code)) for w in D.words(t or "")] or [-1])
        for i, text in items:
            w = D.words(text)
            item = np.array([code.get(x, -2 - n) for n, x in enumerate(w)])
            if len(w) >= D.MIN_WORDS and D.edit_distance(item, doc) <= int(D.EDITS * len(w)):
                out.add((d, i))
    return out


def test_decontamination_against_brute_force(spark):
    items, rows, truth = bench_and_docs()
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = slow_hits(items, rows)
    assert truth <= expected
    for block in (D.BLOCK_WORDS, 300):
        got = {(r.doc_id, r.item_id) for r in D.contaminated(docs_of(spark, rows), bench, block_words=block).collect()}
        assert got <= expected
        assert len(got) >= 0.95 * len(expected)


def edited(rnd, w, edits):
    """``w`` after exactly so many edits at different words."""
    w = list(w)
    for at in sorted(rnd.sample(range(len(w)), edits), reverse=True):
        rnd.choice([lambda: w.pop(at), lambda: w.insert(at, "zzz"), lambda: w.__setitem__(at, "yyy")])()
    return w


@pytest.mark.parametrize("length", [7, 12, 60, 120, 300, 400])
def test_copies_at_the_threshold_are_found_whatever_the_length(length):
    rnd = random.Random(length)
    pool = [f"word{i}" for i in range(3000)]
    items = [[rnd.choice(pool) for _ in range(length)] for _ in range(60)]
    index = D.Index([(i, " ".join(w)) for i, w in enumerate(items)])
    texts = []
    for w in items:
        around = [rnd.choice(pool) for _ in range(80)]
        texts.append([x.encode() for x in around[:40] + edited(rnd, w, int(D.EDITS * length)) + around[40:]])
    hits = index.search(texts)
    assert sum(i in {p for p, _, _ in h} for i, h in enumerate(hits)) == len(items)
    assert all(e <= int(D.EDITS * length) for h in hits for _, _, e in h)


def test_short_items_are_found(spark):
    items = [(1, "Paris"), (2, "the red fox"), (3, "who wrote the book of seven"), (4, "how many legs has a spider then")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [
        (10, "She went to Paris, at last.", "s"),
        (11, "a red fox", "s"),
        (12, "See the red\nfox", "s"),
        (13, "Asked: who wrote the book of seven?", "s"),
        (14, "who wrote a book of seven", "s"),
        (15, "how many legs has the spider then", "s"),
        (16, "how many arms has the spider then", "s"),
    ]
    got = {(r.doc_id, r.item_id, r.edits) for r in D.contaminated(docs_of(spark, rows), bench).collect()}
    assert got == {(10, 1, 0), (12, 2, 0), (13, 3, 0), (15, 4, 1)}


def test_edit_distance_by_hand():
    a = np.array([1, 2, 3, 4])
    assert D.edit_distance(a, np.array([9, 1, 2, 3, 4, 9])) == 0
    assert D.edit_distance(a, np.array([9, 1, 3, 4, 9])) == 1
    assert D.edit_distance(a, np.array([1, 2, 7, 3, 4])) == 1
    assert D.edit_distance(a, np.array([5, 6])) == 4
    assert D.edit_distance(a, np.array([], int)) == 4


def test_decontamination_of_awkward_rows(spark):
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "too few words"), (None, "a text without any id at all but with words"), (5, "no one has these nine words in this order"), (5, "no one has these nine words in this order")],
        "item_id long, text string",
    )
    docs = docs_of(spark, AWKWARD, clash=True)
    got = D.contaminated(docs, bench).collect()
    assert [(r.doc_id, r.item_id, r.edits) for r in got] == [(None, None, 0)]
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(AWKWARD) - 1
    assert D.drop_contaminated(docs, bench.limit(0)).count() == len(AWKWARD)
    assert D.contaminated(docs_of(spark, []), bench).count() == 0


# --- licences ---


def test_known_sentences_are_normal_and_triggered():
    for name, text in N.SENTENCES.items():
        assert text == " ".join(re.findall(r"[a-z0-9]+", text)), name
        assert any(t in text for t in N.TRIGGERS) or name in {"mit-grant", "mit-liable", "apache-comply", "cc-by"}
    assert {n for _, _, names in N.RULES for n in names} == set(N.SENTENCES)


def test_licences_by_hand(spark):
    mit = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation "
        "files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software "
        "is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
        "included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\nOUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE\nSOFTWARE."
    )
    rows = [
        (1, f"Something before\n{mit}\nand after.", "s"),
        (2, "Text here\nLicensed under CC BY-NC 4.0.\nMore text. Released under the MIT License. All rights reserved.", "s"),
        (3, "Licensed under CC BY-NC 4.0 by someone else.", "s"),
        (4, "The licence of nobody. warranty", "s"),
    ]
    got = {(r.doc_id, r.licence, r.rule, r.sentences) for r in N.licence_scan(docs_of(spark, rows + [(i and i + 50, t, s) for i, t, s in AWKWARD], clash=True)).collect()}
    assert got == {(1, "MIT", "text", 4), (2, "CC-BY-NC-4.0", "notice", 1), (2, "MIT", "notice", 1), (2, "proprietary", "reserved", 1)}
    assert N.licence_scan(docs_of(spark, [])).count() == 0


def gnu(title, version, work="program", first=":", late=","):
    return (
        f"    This {work} is free software{first} you can redistribute it and/or modify\n    it under the terms of the {title} as published by\n"
        f"    the Free Software Foundation{late} either version {version} of the License, or\n    (at your option) any later version.\n\n"
        f"    This {work} is distributed in the hope that it will be useful,\n    but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        f"    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n    {title} for more details.\n"
    )


APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\n'
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to "
    'in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
    "express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.\n"
)
BSD = (
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the "
    "documentation\n   and/or other materials provided with the distribution.\n\n"
)
BSD3 = BSD + (
    "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
    "   this software without specific prior written permission.\n"
)


@pytest.mark.parametrize(
    "text,licence,rule",
    [
        (gnu("GNU General Public License", "3"), "GPL-3.0", "header"),
        (gnu("GNU General Public License", "2", first=";", late=";"), "GPL-2.0", "header"),
        (gnu("GNU Lesser General Public License", "2.1", "library", ";", ";"), "LGPL-2.1", "header"),
        (gnu("GNU Lesser General Public License", "3"), "LGPL-3.0", "header"),
        (gnu("GNU Affero General Public License", "3"), "AGPL-3.0", "header"),
        (APACHE, "Apache-2.0", "header"),
        ("\n".join(f"# {x}".rstrip() for x in APACHE.split("\n")), "Apache-2.0", "header"),
        (BSD, "BSD-2-Clause", "text"),
        (BSD3, "BSD-3-Clause", "text"),
        (
            "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
            "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            "MPL-2.0", "notice",
        ),
        (
            "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
            "copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\n"
            "WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS.",
            "ISC", "text",
        ),
        ("This is free and unencumbered software released into the public\ndomain.", "Unlicense", "text"),
        ("CC0 1.0 Universal\n\nStatement of Purpose", "CC0-1.0", "text"),
        ("All rights\nreserved.", "proprietary", "reserved"),
    ],
)
def test_standard_notices(text, licence, rule):
    assert [m[:2] for m in N.matches(f"Something before.\n\n{text}\n\nand after.")] == [(licence, rule)]


def test_scan_of_whole_table_against_plain_search(spark):
    import pyarrow.parquet as pq
    from conftest import TESTDATA

    from halfstar.llm.queries import op9_licences

    notices = {
        "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    }
    table = pq.read_table(f"{TESTDATA}/documents.parquet").to_pylist()
    expected = {(r["doc_id"], name) for r in table for name, line in notices.items() if line in r["text"].split("\n")}
    got = {(r.doc_id, r.licence) for r in op9_licences(spark, TESTDATA).collect() if r.licence in notices}
    assert expected and got == expected


@pytest.mark.parametrize("holder", ["Example Inc.", "the University", "the copyright holder", "the <organization>", "Foo Bar, Baz & Co"])
def test_bsd3_with_any_name_is_never_bsd2(holder):
    text = BSD + (
        f"\n3. Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.\n"
    )
    assert [m[0] for m in N.matches(text)] == ["BSD-3-Clause"]


@pytest.mark.parametrize(
    "text,licence,rule",
    [
        ("This project is released under the MIT License.", "MIT", "reference"),
        ("The code is licensed under the MIT license", "MIT", "reference"),
        ("Our tool, as a whole, is distributed under the terms of the GNU General Public License version 2 only.", "GPL-2.0", "reference"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0", "reference"),
        ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0", "reference"),
        ("// SPDX-License-Identifier: Apache-2.0\nint main() {}", "Apache-2.0", "spdx"),
        ("# SPDX-License-Identifier: GPL-3.0-or-later\n", "GPL-3.0", "spdx"),
    ],
)
def test_names_of_licences_in_prose_and_spdx_lines(text, licence, rule):
    assert [m[:2] for m in N.matches(text)] == [(licence, rule)]


def test_mit_alone_is_no_licence():
    assert N.matches("MIT.\nShe studied at MIT. The license of her car was renewed.") == []


def test_quality_fit_reads_every_labelled_row(spark, monkeypatch):
    """Rows of ids beyond any sample count; groups of any size give the weights of all rows at hand."""
    rng = np.random.default_rng(5)
    y = (rng.random(21_000) < 0.3).astype(int)
    x = rng.normal(size=(len(y), len(Q.FEATURES)))
    x[:, 2] += y * 1.5
    table = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(len(y)), "x": list(x)}), "doc_id long, x array<double>")
    labels = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(len(y)), "quality": y}), "doc_id long, quality int")
    seen = []
    real = Q.grouped
    monkeypatch.setattr(Q, "grouped", lambda marked, *rest: seen.append(marked.count()) or real(marked, *rest))
    model = Q.fit_model(table, labels)
    assert seen == [len(y)]
    score = np.clip((x - x.mean(0)) / x.std(0), -8, 8) @ model.weights[2]
    assert np.allclose(model.weights[:2], [x.mean(0), x.std(0)])
    assert (score < model.cut).sum() == (y == 0).sum()  # the quantile of all rows, not of some
    assert model.weights[2].argmax() == 2


def test_rank_by_counts(spark, monkeypatch):
    monkeypatch.setattr(Q, "BINS", 4)
    values = [0.5, 3.0, 3.0, 3.0, -1e9, 7.25, 1e9, *[2 + i / 1000 for i in range(60)]]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    assert [Q.ranked(df, k) for k in (0, 1, 30, 63, 66)] == [sorted(values)[k] for k in (0, 1, 30, 63, 66)]
