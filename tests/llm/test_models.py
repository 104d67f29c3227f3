"""Language decoding, toxicity risk and license containment against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pagetally.llm import language, licenses, toxicity


def letters_of(lang):
    return {"aa": "abcde", "bb": "defgh", "cc": "ghijk", "dd": "jklma"}[lang]


def byte_grams(text):
    """(size, bytes) of the 3- and 4-grams of the lower-case letters of a text."""
    data = " " + " ".join(re.findall(r"[a-z]+", text.lower())) + " "
    return [data[i:i + n] for n in (3, 4) for i in range(len(data) - n + 1)]


def bucket(gram):
    value = int.from_bytes(gram.encode(), "big")
    return value * (2654435761 if len(gram) == 3 else 2246822519) % 2 ** 32 >> 17


def test_language_equals_plain_decoding(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choices(letters_of(lang), k=4)) for _ in range(rng.randrange(1, 9))),
             lang) for i in range(160) for lang in [rng.choice(["aa", "bb", "cc", "dd"])]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(frame)
    langs = ["aa", "bb", "cc", "dd"]
    counts = {lang: Counter() for lang in langs}
    for _, text, lang in rows:
        counts[lang].update(map(bucket, byte_grams(text)))
    total = {lang: sum(c.values()) + 0.5 * language.BUCKETS for lang, c in counts.items()}
    code = language.codewords(4).tolist()
    assert len(code[0]) == 7 and len({tuple(r) for r in code}) == 4

    def margins(text):
        found = byte_grams(text)
        out = []
        for bit in range(7):
            sides = [[lang for lang, word in zip(langs, code) if word[bit] == side] for side in (1, -1)]
            value = 0.0
            for gram in found:
                share = [sum((counts[x][bucket(gram)] + 0.5) / total[x] for x in side) / len(side)
                         for side in sides]
                value += math.log(share[0]) - math.log(share[1])
            out.append(value / len(found))
        return out
    told = {i: margins(text) for i, text, _ in rows}
    scale = [sum(np.mean([abs(told[i][bit]) for i, _, x in rows if x == lang]) for lang in langs) / 4
             for bit in range(7)]
    trust = [[max(0.05, np.mean([told[i][bit] * word[bit] > 0 for i, _, x in rows if x == lang]))
              for bit in range(7)] for lang, word in zip(langs, code)]
    for row in language.predict(frame, model).collect():
        losses = [sum(t / sum(own) * math.log1p(math.exp(-2 * word[b] * told[row.doc_id][b] / scale[b]))
                      for b, t in enumerate(own)) * 7 for own, word in zip(trust, code)]
        order = sorted(range(4), key=lambda k: losses[k])
        if losses[order[1]] - losses[order[0]] > 1e-3:
            assert row.lang_pred == langs[order[0]]
        assert abs(row.score - 1 / sum(math.exp(losses[order[0]] - x) for x in losses)) < 1e-3
        gap = losses[order[1]] - losses[order[0]]
        if abs(gap - language.AMBIGUOUS * 7) > 1e-3:
            assert row.ambiguous == (gap < language.AMBIGUOUS * 7)


def test_toxicity_risk_goes_down_where_labels_are_few():
    """The non-negative risk of the trained weights is below that of none and of ignoring the prior."""
    rng = np.random.default_rng(3)
    prior, n = 0.2, 40

    def text(bad):
        own = set(rng.integers(4, n, 2).tolist())
        return np.array(sorted(own | ({int(rng.integers(0, 4))} if bad else set())))
    positive = [text(True) for _ in range(80)]
    unlabelled = [text(rng.random() < prior) for _ in range(600)]

    def risk(weights, bias):
        def loss(rows, sign):
            z = np.array([weights[r].sum() + bias for r in rows])
            return (1 / (1 + np.exp(sign * z))).mean()
        return prior * loss(positive, 1) + max(0.0, loss(unlabelled, -1) - prior * loss(positive, -1))
    weights, bias = toxicity.train(positive, unlabelled, n, prior)
    assert risk(weights, bias) < 0.5 * risk(np.zeros(n), -1.0)
    assert min(weights[:4]) > max(weights[4:])
    fresh = [(text(bad), bad) for bad in rng.random(400) < prior]
    right = np.mean([(weights[r].sum() + bias > 0) == bad for r, bad in fresh])
    assert right > 0.95


def plain_shingles(words, size):
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


@pytest.mark.parametrize("edits", [0, 1, 4])
def test_licenses_equal_containment(spark, edits):
    """Templates with some words replaced, anywhere in long texts, against plain shingle sets."""
    rng = random.Random(edits)
    words = [f"w{i}" for i in range(3000)]
    templates = {f"t{n}": " ".join(rng.choices(words, k=n)) for n in (5, 12, 40, 200)}
    rows = []
    for i in range(60):
        text = rng.choices(words, k=rng.randrange(0, 400))
        name = rng.choice([None, *templates])
        if name:
            own = templates[name].split()
            for place in rng.sample(range(len(own)), min(edits, len(own) - 1)):
                own[place] = "edited"
            at = rng.randrange(len(text) + 1)
            text[at:at] = own
        rows.append((i, " ".join(text).upper() if i % 2 else ", ".join(text)))
    frame = spark.createDataFrame(rows + [(90, None), (91, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in licenses.scan(frame, templates).collect()}
    assert found[90].n_licenses == found[91].n_licenses == 0
    some = 0
    for i, text in rows:
        held = [w.lower() for w in re.findall(r"\w+", text)]
        for name, template in templates.items():
            own = plain_shingles(template.split(), min(licenses.SHINGLE, len(template.split())))
            share = len(own & plain_shingles(held, licenses.SHINGLE)) / len(own)
            got = dict(zip(found[i].licenses, found[i].containments)).get(name)
            assert (got is not None) == (share >= licenses.CONTAINED), (i, name, share, got)
            if got is not None:
                assert abs(got - share) < 1e-9
                some += 1
    assert some >= 10
