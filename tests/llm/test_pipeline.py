"""Every stage of the corpus pipeline, and all of them, against plain Python on a small corpus."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pagetally.llm import toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def one_of_each(docs):
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i for i in docs if find(i) == i}


def clean_of(docs, items):
    windows = set()
    for text in items:
        words = plain_words(text)
        size = min(10, len(words))
        windows |= {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if size else set()
    sizes = {len(w) for w in windows}
    kept = set()
    for i, text in docs.items():
        words = plain_words(text)
        if not any(tuple(words[j:j + n]) in windows for n in sizes for j in range(len(words) - n + 1)):
            kept.add(i)
    return kept


def pieces_of(docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = set()
    for i, text in docs.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for piece, (start, stop) in enumerate(zip(cuts, cuts[1:])):
            found.add((i, piece, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())))
    return found


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    alphabets = {"aa": "abcdeo", "bb": "fghiju", "cc": "klmnoi"}

    def words(lang, n):
        return ["".join(rng.choices(alphabets[lang], k=rng.randrange(3, 8))) for _ in range(n)]
    items = [" ".join(words("aa", n)) for n in (4, 12, 30)]
    rows, toxic = [], set()
    for i in range(260):
        lang = rng.choice(sorted(alphabets))
        text = words(lang, rng.choice((3, 30, 60)))
        if i % 6 == 0:
            text[rng.randrange(len(text))] = rng.choice(("nastyword", "vileword"))
            toxic.add(i)
        rows.append([i, " ".join(text), lang, "hot" if i % 3 else None, 0])
    for i in range(30):                     # copies, near copies, passages, texts without letters
        base = rows[1 + 6 * i][1]
        rows.append([300 + i, [base, base.upper(), base + " tail", None, "", "12 34 !?",
                               " ".join(words("bb", 20)) + " " + items[i % 3] + " end",
                               " " * 5000 + "abcde\n" * 900, "word <|endoftext|> " + base,
                               " ".join(words("cc", 1500))][i % 10], "aa", "x", 0])
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(260)],
                          "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        str(folder / "labels.parquet"))
    spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(9, None)],
                          "item_id long, text string").coalesce(1).write.parquet(
        str(folder / "benchmark.parquet"))
    return str(folder), items, toxic


def texts(frame):
    rows = frame.collect()
    found = {r.doc_id: r.text for r in rows}
    assert len(found) == len(rows)
    return found


def test_every_stage_and_the_run(spark, corpus):
    folder, items, toxic = corpus
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language_id", "toxicity", "jaccard_join", "benchmark_decontamination",
                           "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = texts(docs)

    told = corpus_pipeline.written(stage["language_id"](spark, docs, folder), "told")
    assert told.columns == docs.columns
    after = texts(told)
    assert set(after) == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}

    clean = corpus_pipeline.written(stage["toxicity"](spark, told, folder), "clean")
    model = toxicity.fit(told, spark.read.parquet(f"{folder}/labels.parquet"), ~toxicity.held_out())
    wanted = {i for i, t in after.items() if model.score(t.encode()) < toxicity.THRESHOLD}
    assert set(texts(clean)) == wanted and clean.columns == docs.columns
    assert len(toxic - wanted) >= 0.8 * len(toxic) and len(wanted) >= 0.8 * len(set(after) - toxic)
    after = {i: after[i] for i in wanted}

    single = corpus_pipeline.written(stage["jaccard_join"](spark, clean, folder), "single")
    wanted = one_of_each(after)
    assert set(texts(single)) == wanted and len(wanted) < len(after)
    assert single.columns == docs.columns
    after = {i: after[i] for i in wanted}

    kept = corpus_pipeline.written(stage["benchmark_decontamination"](spark, single, folder), "kept")
    wanted = clean_of(after, items)
    assert set(texts(kept)) == wanted and len(wanted) < len(after)
    after = {i: after[i] for i in wanted}

    packed = stage["best_fit_packing"](spark, kept, folder).collect()
    assert {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed} == pieces_of(after)
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed)
    used = {}
    for r in whole:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 1024
