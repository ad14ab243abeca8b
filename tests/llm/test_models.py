"""Operators 4, 5 and 10: learned models against held-out rows and brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import language, toxicity
from cohortwise.llm.backoff_lm import LmSettings, language_model_scores
from cohortwise.llm.common import crc32_of_id

SYLLABLES = {"aa": "ka to mi ru se no".split(), "bb": "streng wald icht ung ber".split(), "cc": "eau ois ille ment que".split()}


def made_up(rng, lang, n=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_language_on_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, made_up(rng, lang), lang) for i in range(300) for lang in [rng.choice(list(SYLLABLES))]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held_out = F.col("doc_id") % 4 == 0
    model = language.fit(docs, ~held_out)
    got = language.predict(docs.drop("lang"), model, ("doc_id",)).collect()
    truth = {i: lang for i, _, lang in rows}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in got if r.doc_id % 4 == 0]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    other = spark.createDataFrame([(1, "zzyx qwfp xxjj vvkk"), (2, "123 ..."), (3, None), (4, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in language.predict(other, model, ("doc_id",)).collect()}
    assert found[1].rejected and found[1].lang_pred in SYLLABLES
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (2, 3, 4))


def test_language_of_odd_tables(odd, empty):
    model = language.fit(odd, crc32_of_id() % 4 != 2)
    rows = language.predict(odd, model, ("doc_id", "key0")).collect()
    assert len(rows) == odd.count() and {r.lang_pred for r in rows} <= {"en", "fr", "und"}
    nothing = language.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language.predict(odd, nothing, ("doc_id",)).collect()} == {"und"}
    assert language.predict(empty, model, ("doc_id",)).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(2)
    bad, rows, labels = ["vilegrub", "scumdrop", "trashfen"], [], []
    for i in range(900):
        words, toxic = made_up(rng, "aa", 40).split(), int(rng.random() < 0.25)
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic if i != 5 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + labels[:3] + [(None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r for r in toxicity.score(docs, model, ("doc_id",)).collect()}
    right = [got[i].predicted == t for i, t in labels if i % 5 == 0 and t is not None]
    assert np.mean(right) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_toxicity_of_odd_tables(spark, odd, empty):
    marks = spark.createDataFrame([(1, 1), (7, 0), (8, None), (99, 1)], "doc_id long, toxic int")
    model = toxicity.fit(odd, marks, F.lit(True))
    rows = toxicity.score(odd, model, ("doc_id", "label")).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    one_class = toxicity.fit(odd, marks.filter("toxic = 0"), F.lit(True))
    assert {r.predicted for r in toxicity.score(odd, one_class, ("doc_id",)).collect()} == {0}
    assert toxicity.fit(empty, marks.limit(0), F.lit(True)).intercept == 0.0
    assert toxicity.score(empty, model, ("doc_id",)).count() == 0


def brute_scores(rows):
    docs = []
    for i, text in rows:
        lower = (text or "").translate({k: k + 32 for k in range(65, 91)})
        held = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
        docs.append((i, held, re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]))
    words, pairs, texts = Counter(), Counter(), 0
    for _, held, tokens in docs:
        if not held:
            words.update(tokens)
            pairs.update(zip([0, *tokens[:-1]], tokens))
            texts += 1
    n, v = sum(words.values()), len(words)
    history = {**words, 0: texts}
    tokens_of, single = Counter(), Counter()
    for (a, _), c in pairs.items():
        bits = history[a].bit_length()
        tokens_of[bits] += c
        single[bits] += c == 1
    out = []
    for i, held, tokens in docs:
        base = score = 0.0
        for a, b in zip([0, *tokens[:-1]], tokens):
            low = (words[b] + 1) / (n + v + 1)
            c = history.get(a, 0)
            e = (single[c.bit_length()] + 1) / (tokens_of[c.bit_length()] + 2) if c else 1.0
            base += math.log10(low)
            score += math.log10((1 - e) * (pairs[a, b] / c if c else 0) + e * low)
        out.append((i, held, len(tokens), sum(words[t] > 0 for t in tokens), n, base, score))
    return out


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_scores_equal_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("The the cat dog of sat a".split()) for _ in range(rng.randint(0, 25)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in language_model_scores(docs, LmSettings(block, 500)).collect())
    for own, other in zip(got, sorted(brute_scores(rows))):
        assert own[:5] == other[:5] and own[5:] == pytest.approx(other[5:], rel=1e-9)


def test_scores_of_odd_tables(odd, empty):
    got = language_model_scores(odd).collect()
    expected = brute_scores([(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    order = lambda r: (r[0] is not None, r[0] or 0, r[2])
    for own, other in zip(sorted((tuple(r) for r in got), key=order), sorted(expected, key=order)):
        assert own[:5] == other[:5] and own[5:] == pytest.approx(other[5:], rel=1e-9)
    assert language_model_scores(empty).count() == 0


def test_ratios_shrink_with_their_error():
    from cohortwise.llm.toxicity import ToxicitySettings, ratios

    settings = ToxicitySettings()
    n = np.array([1000, 1000])
    # codes: rare and common with the same ratio, a chance difference, none at all
    counts = np.array([[2, 100, 50, 0], [20, 1000, 55, 0]])
    got = ratios(counts, n, settings)
    share = (counts + 0.5) / (n[:, None] + 1)
    raw = np.log(share[1] / share[0])
    assert 0 < got[0] < 0.8 * raw[0] and 0.9 * raw[1] < got[1] < raw[1] and got[2] == got[3] == 0
    assert np.allclose(ratios(counts[::-1], n, settings), -got)
