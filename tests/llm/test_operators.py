"""Each operator on odd rows: nulls, empty texts, ties, repeated rows, empty tables, extra columns."""

import itertools
import random
import zlib

import numpy as np
import pytest

from pagetally.llm import (boilerplate, chat, decontamination, language, licenses, neighbours,
                           packing, rollups, toxicity)

DOCS = "doc_id long, text string, lang string, source string, score string, length int"


def docs_of(spark, *texts):
    return spark.createDataFrame(
        [(i, t, "en", "s", "x", 1) for i, t in enumerate(texts)], DOCS)


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\lb <s>", None, "", "\\", "<<ROLE>>x<</ROLE>>", "<", "[",
             " plain \n", "<<SYS>>", "\\b\\q"]
    rows = [(c, t, role, text, "x") for c, (role, text) in enumerate(
        itertools.product(("user", "assistant", "system", "tool</s>", None), texts)) for t in (1, 0)]
    frame = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, formatted string")
    read = chat.read_conversations(chat.format_conversations(frame)).collect()
    assert len(read) == 55
    for row in read:
        role, text = rows[row.conv_id * 2][2:4]
        assert [(t.role, t.text) for t in row.turns] == [(role or "", text or "")] * 2
    spans = chat.loss_spans(chat.format_conversations(frame)).count()
    assert spans == 2 * len(texts)
    assert chat.format_conversations(frame.limit(0)).collect() == []


def test_packing_is_whole_and_gapless(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice((1, 9, 60, 200, 900))))
             for _ in range(60)] + [None, "", "é <|endoftext|> ü", "x", "x", " " * 1_000_000,
                                    "a" + "\n" * 700_000 + " b"]
    rows = packing.pack(docs_of(spark, *texts), 128).collect()
    for doc, text in enumerate(texts):
        ids = theirs.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 128)))
        assert all(r.ids_crc32 == zlib.crc32(np.array(
            ids[r.start:r.start + r.length], "<u4").tobytes()) for r in own)
        assert sum(r.length for r in own) == len(ids)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)),
                                      key=lambda r: r.sequence_id):
        place = 0
        for row in group:
            assert row.offset == place
            place += row.length
        assert place <= 128
    assert packing.pack(docs_of(spark, "x").limit(0)).collect() == []


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(5000)]
    ranges = packing.plan({n: sizes.count(n) for n in set(sizes)}, 100)
    bins = {}
    for length, _, number, first, each, offset in ranges:
        for k in range(number):
            bins.setdefault(first + k // each, []).append(length)
    assert sorted(itertools.chain(*bins.values())) == sorted(sizes)
    assert max(map(sum, bins.values())) <= 100 and len(bins) <= 1.02 * sum(sizes) / 100 + 1


def test_language(spark):
    rng = random.Random(3)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    rows = [(i, " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(20)), lang)
            for i, (lang, letters) in enumerate(list(alphabets.items()) * 30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(frame, ~language.held_out())
    found = {r.doc_id: r for r in language.predict(frame, model).collect()}
    assert all(found[i].lang_pred == lang and 0 <= found[i].score <= 1 for i, _, lang in rows)
    odd = docs_of(spark, None, "", "123 !?", "abc", "ab" * 300_000)
    assert [r.lang_pred for r in language.predict(odd, model).orderBy("doc_id").collect()] == [
        "und", "und", "und", "aa", "aa"]
    assert language.identified(odd, model).count() == 2
    nothing = language.fit(frame.limit(0))
    assert language.predict(odd, nothing).select("lang_pred").distinct().collect()[0][0] == "und"
    for n in (1, 2, 4, 7, 20):
        code = language.codewords(n)
        assert len({tuple(row) for row in code.tolist()}) == n


def test_decontamination_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    items = [(i, words(rng.choice((3, 12, 30)))) for i in range(12)] + [(98, None), (99, "?!")]
    texts = [words(40) + "; " + (items[i % 12][1].upper() if i % 3 else "") for i in range(24)]
    docs = docs_of(spark, *texts, None, "", items[0][1], items[0][1])
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {r.doc_id: r for r in decontamination.search(docs, bench).collect()}
    assert whole[24].n_words == 0 and whole[26].n_hit == whole[26].n_words
    assert all(whole[i].n_hit > 0 and str(i % 12) in whole[i].items for i in range(24) if i % 3)
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in whole.items() if not r.n_hit}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    parts = {r.doc_id: r for r in decontamination.search(docs, bench).collect()}
    assert {i: (r.n_words, r.n_hit, r.items) for i, r in parts.items()} == {
        i: (r.n_words, r.n_hit, r.items) for i, r in whole.items()}
    assert decontamination.search(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_toxicity(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(3000)}" for _ in range(30)]
        if i % 8 == 0:
            words[rng.randrange(30)] = rng.choice(("nasty", "vile"))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 8 == 0), "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels + [(None, 1, "y"), (3, None, "y")],
                                  "doc_id long, toxic int, score string")
    model = toxicity.fit(docs, known, ~toxicity.held_out())
    found = toxicity.scores(docs, model).collect()
    assert sum((r.score >= 0.7) == (r.doc_id % 8 == 0) for r in found) > 0.97 * len(found)
    odd = docs_of(spark, None, "", "nasty", "w1 " * 100_000)
    assert [r.score >= 0.7 for r in toxicity.scores(odd, model).orderBy("doc_id").collect()] == [
        False, False, True, False]
    assert toxicity.clean(odd, model).count() == 3
    assert toxicity.scores(odd, toxicity.fit(docs, known.limit(0))).count() == 4


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("just words", "just words") , ("<nav>a</nav>", ""),
    ("<article><p>One &amp; two\n three<p>Four<br>five</article><footer>x</footer>",
     "One & two three\nFour five"),
    ("<main><p>Text.</p><div class='comments'><p>Nice!</p></div></main>", "Text."),
    ("<main><form><p>Mail</p></form><script>var a='<p>';</script><p>b</p></main><p", "b"),
])
def test_page_text(spark, html, text):
    frame = spark.createDataFrame([(1, "u", html, "z")],
                                  "page_id long, url string, html string, text string")
    row = boilerplate.extract(frame).first()
    assert row.n_chars == len(row.text) and (row.text == text or html == "just words")


LONG = "This long paragraph tells the reader in some detail what happened on that day in town. "


@pytest.mark.parametrize("html, text", [
    # a mark on one element only does not decide for the rest of the page
    (f"<h1 class='entry-title'>T</h1><div class='wrap'><p>{LONG}</p><p>{LONG}</p></div>",
     f"T\n{LONG}\n{LONG}"),
    (f"<div class='post-meta'><p>By A B</p></div><section><p>{LONG}</p></section>",
     f"By A B\n{LONG}"),
    # text outvotes a word of the class, short text does not
    (f"<div class='promotion'><article><p>{LONG}</p></article></div>", LONG),
    (f"<main><p>{LONG}</p><div class='sidebar'><p>More here</p><p>Top</p></div></main>", LONG),
    (f"<main><p>{LONG}</p><div class='comments'><p>{LONG}</p><p>{LONG}</p></div></main>", LONG),
    (f"<article><p>{LONG}</p><div class='ad'>{LONG * 4}</div><p>{LONG}</p></article>",
     f"{LONG}\n{LONG}"),
    # neighbours change a label: without markers, and inside of a marker
    ("<div><p>Oh yes</p></div>", ""),
    (f"<div><p>{LONG}</p><p>Oh yes</p><p>{LONG}</p></div>", f"{LONG}\nOh yes\n{LONG}"),
    ("<article><p><a href='/s'>Source</a></p></article>", ""),
    (f"<article><p>{LONG}</p><p><a href='/s'>Source</a></p><p>{LONG}</p></article>",
     f"{LONG}\nSource\n{LONG}"),
    # what is boilerplate by its kind stays so
    (f"<article><p>{LONG}</p><nav><p>{LONG}</p></nav><footer>{LONG}</footer></article>", LONG),
    (f"<article><p>{LONG}</p><p>All rights reserved.</p></article>"
     "<p>All rights reserved.</p>", f"{LONG}\nAll rights reserved."),
])
def test_page_text_is_cut(html, text):
    def clean(lines):
        return "\n".join(" ".join(line.split()) for line in lines.split("\n"))
    assert boilerplate.main_text(html) == clean(text)


@pytest.mark.parametrize("html, text", [
    ("<article><p>So <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup>"
     "<annotation>E=mc^2</annotation></math> holds.</p></article>", "So E=mc2 holds."),
    (f"<article><object data='x'><p>{LONG}</p></object><button>Go</button></article>", LONG),
    (f"<head><noscript>{LONG}</noscript></head><noscript>Please enable JavaScript.</noscript>"
     f"<article><p>{LONG}</p></article>", LONG),
    (f"<body><noscript><p>{LONG * 3}</p></noscript></body>", LONG * 3),
])
def test_page_text_of_fallbacks(html, text):
    assert boilerplate.main_text(html) == " ".join(text.split())


@pytest.mark.parametrize("html,text", [
    ("<body><form id='aspnetForm'><article><p>Short one.</p></article></form>", "Short one."),
    ("<body><form id='aspnetForm'><div><p>" + "word " * 30 + "end.</p></div></form>",
     "word " * 30 + "end."),
    ("<h1>A title here</h1><form><p>Subscribe to our letter and get the best stories now.</p></form>", ""),
    ("<article><p>" + "word " * 30 + "end.</p><form><p>Leave " + "some " * 20 + "words.</p></form>",
     "word " * 30 + "end.")])
def test_page_text_and_forms(html, text):
    assert boilerplate.main_text(html) == text


def test_odd_markup_takes_linear_time():
    import time
    start = time.monotonic()
    for html in ("<a " * 300_000, "<![CDATA[ > " * 90_000, '<a ">"' * 170_000, '<a "' * 250_000,
                 "<b><i><p>one two three.</p>" * 30_000, "<b>" * 100_000 + "</x>" * 200_000,
                 "<" * 1_000_000, "<!--" * 250_000, "<p <p >" * 100_000):
        boilerplate.main_text(html)
    assert time.monotonic() - start < 60


def test_cut_equals_brute_force():
    rng = random.Random(6)
    for _ in range(200):
        n = rng.randint(1, 7)
        c, b = ([rng.choice((0, 0, 1, 2, 3.5)) for _ in range(n)] for _ in range(2))
        e = {(i, j): rng.choice((0.5, 1, 2)) for i in range(n) for j in range(i + 1, n)
             if rng.random() < 0.4}

        def cost(x):
            return sum(c[i] if x[i] else b[i] for i in range(n)) + sum(
                w for (i, j), w in e.items() if x[i] != x[j])
        least = min(map(cost, itertools.product((0, 1), repeat=n)))
        assert abs(cost(boilerplate.cut(c, b, e)) - least) < 1e-9


def test_rollup_deltas(spark, tmp_path):
    docs = docs_of(spark, "one two", None, "three")
    counts = rollups.counted(docs, "words/1")
    rollup = rollups.Rollup(spark, str(tmp_path / "log"))
    assert rollup.commit("a", rollups.changes(inserted=counts))
    assert not rollup.commit("a", rollups.changes(inserted=counts))
    assert rollup.totals().first()[3:] == (3, 3, 12)
    assert rollup.commit("empty", rollups.changes(inserted=counts.limit(0)))
    assert rollup.commit("b", rollups.changes(deleted=counts.filter("doc_id = 0")))
    revised = rollups.counted(docs, "bpe50k/1")
    assert rollup.commit("c", rollups.changes(revised=(counts.filter("doc_id > 0"),
                                                       revised.filter("doc_id > 0"))))
    rows = rollup.totals().collect()
    assert len(rows) == 1 and rows[0].tokenizer == "bpe50k/1" and rows[0].documents == 2


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 150)
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(600, 16)).astype(np.float32)
    vectors[300:400] = vectors[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)] + [
        (1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0),
        (1003, [None] * 16, 0), (1004, [], 0), (None, [1.0] * 16, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = neighbours.nearest(frame, frame.filter("vec_id % 20 = 0")).collect()
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    hits = total = 0
    for q in range(0, 600, 20):
        near = np.round(unit @ unit[q], 9)
        near[q] = -9
        want = np.lexsort((np.arange(600), -near))[:5].tolist()
        got = [r.vec_id for r in sorted((r for r in found if r.query_id == q),
                                        key=lambda r: r["rank"])]
        hits, total = hits + len(set(got) & set(want)), total + 5
        if q == 0 or 300 <= q < 400:
            assert got == want
    assert hits / total >= 0.95 and {r.query_id for r in found} == set(range(0, 600, 20))
    few = frame.filter("vec_id < 3")
    assert neighbours.nearest(few, few).count() == 6
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).collect() == []


def test_licenses(spark):
    grant = licenses.TEMPLATES["mit-notice"]
    filler = " ".join(f"w{i}" for i in range(500))
    edited = grant.replace("free of charge", "without any charge").replace("deal in", "deal with")
    docs = docs_of(spark, f"{filler} {grant} {filler}", edited, "Released under the MIT License.",
                   None, "", filler, "licensed under THE apache license, version 2.0!",
                   f"{filler} released UNDER the mit license")
    rows = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert rows[0].licenses == ["mit-notice"] and rows[0].first_words == [500]
    assert rows[1].licenses == ["mit-notice"] and 0.75 <= rows[1].containments[0] < 1
    assert rows[2].licenses == ["mit"] and "apache-2.0" in rows[6].licenses
    assert rows[7].licenses == ["mit"] and all(rows[i].n_licenses == 0 for i in (3, 4, 5))
    for similarity in (0.05, 0.3, 0.6, 0.9):
        bands, width = licenses.bands_for(similarity)
        assert (1 - similarity ** width) ** bands <= licenses.MISS * 1.001


def test_license_families(spark):
    filler = " ".join(f"w{i}" for i in range(60))
    every = licenses.all_templates()
    texts = {
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.":
            ["lgpl-2.1-notice"],
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.": ["agpl-notice"],
        "This work is licensed under a Creative Commons Attribution 4.0 International License.":
            ["cc-by-4.0-long"],
        "a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License":
            ["cc-by-nc-sa-3.0-long"],
        "This work is licensed under the GNU General Public License, version 3.": ["gpl-3.0"],
        "This work is licensed under the GNU General Public License, version 2.": ["gpl-2.0"],
        "SPDX-License-Identifier: MIT": ["spdx-mit"],
        every["isc"]: ["isc"], every["zlib"]: ["zlib"], every["gpl-notice"]: ["gpl-notice"],
        every["epl-2.0-notice"]: ["epl-2.0-notice"], every["gpl-notice"] + every["lgpl-2.1-notice"]:
            ["gpl-notice", "lgpl-2.1-notice"],
        every["unlicense-text"]: ["unlicense-notice", "unlicense-text"],
        every["cc0-1.0-text"]: ["cc0-1.0-text"], every["lgpl-3.0-text"]: ["lgpl-3.0-text"],
        every["gpl-2.0-text"]: ["gpl-2.0-notice", "gpl-2.0-text"],
        every["epl-1.0-text"]: ["epl-1.0-text"],
    }
    docs = docs_of(spark, *(f"{filler} {text} {filler}" for text in texts))
    rows = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == list(texts.values())


def test_short_license_templates(spark):
    templates = {"one": "Copyleft", "three": "All rights reserved", "five": "a b c d e"}
    docs = docs_of(spark, "w x All Rights Reserved. y z w x", "copyleft", "a b c copyleft d e f g",
                   "all rights", None, "a b c d e")
    rows = {r.doc_id: (r.licenses, r.first_words)
            for r in licenses.scan(docs, templates).collect()}
    assert rows == {0: (["three"], [2]), 1: (["one"], [0]), 2: (["one"], [3]), 3: ([], []),
                    4: ([], []), 5: (["five"], [0])}
