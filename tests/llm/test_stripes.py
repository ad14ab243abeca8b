"""Operator 12: collocations against brute force, and the parts of its stripes."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from cohortwise.llm import stripes
from cohortwise.llm.stripes import CollocationSettings, collocations, key_filter, word_totals

COLUMNS = ("rank", "a", "l", "r", "n", "score")


def brute(rows, settings):
    """(language, phrase) -> rank, a, l, r, n, score."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in range(1, settings.words + 1):
                counts["und" if lang is None else lang].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = {}
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= settings.least}
        most = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    most[p[i : i + m]] = max(most[p[i : i + m]], a)
        kept = []
        for p, a in candidates.items():
            if most[p] and 100 * most[p] >= settings.inside * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[: settings.rows], 1):
            out[lang, phrase.decode()] = (rank, -a, left, right, n, -score)
    return out


def found(df, settings):
    rows = collocations(df, settings).collect()
    got = {(r.lang, r.phrase): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


def random_rows(seed, n=400):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "a", "new", "york", "city", "x y", "😀", "k2", "\x1f"]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?", " ! "]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts += ["new york city" if rng.random() < 0.1 else rng.choice(words[: rng.randint(1, 12)]), rng.choice(marks)]
        out.append((rng.choice(["en", "fr", None, "und", ""]), "".join(parts)))
    return out


def test_against_brute_force(spark):
    rows = random_rows(1)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for settings in (CollocationSettings(), CollocationSettings(least=2, rows=40), CollocationSettings(words=2, least=5)):
        assert found(df, settings) == brute(rows, settings)


def test_odd_rows(spark, odd, empty):
    df = odd.withColumn("key", F.lit(1)).withColumn("prefix", F.lit("x")).withColumn("n", F.lit(2))
    rows = [(r.lang, r.text) for r in odd.collect()]
    for least in (1, 30):
        settings = CollocationSettings(least=least)
        assert found(df, settings) == brute(rows, settings)
    assert found(empty, CollocationSettings()) == {}


def test_split_stripes_and_full_bitmap(spark, monkeypatch):
    """Hot prefixes in parts, and a bitmap that lets nearly everything through."""
    rows = random_rows(2, 150) + [("en", "the new york city of the new ÿork " * 900)] * 2
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(2)
    settings = CollocationSettings(least=3)
    expected = brute(rows, settings)
    monkeypatch.setattr(stripes, "HOT", 10**9)
    assert found(df, settings) == expected
    monkeypatch.setattr(stripes, "BITS_PER_KEY", 0)
    monkeypatch.setattr(stripes, "REGION_BITS", 3)
    assert found(df, settings) == expected


def test_long_texts_are_cut_between_words(monkeypatch):
    text = ("the new, york city. of\tthe new ÿork " * 900 + "x" * 5000 + " end").encode()
    data, bounds = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    salts = np.array([5], np.uint64)
    keys, group, *_ = stripes._words(data, bounds, salts)
    monkeypatch.setattr(stripes, "LONG", 1000)
    parts = list(stripes._parts(data, bounds))
    assert len(parts) > 20 and [p[4] for p in parts] == [False] + [True] * (len(parts) - 1)
    assert b"".join(p[0].tobytes() for p in parts) == text
    found, base = [], 0
    for part, edges, *_ in parts:
        k, g, *_ = stripes._words(part, edges, salts)
        found.append((k, g + base))
        base += int(stripes.PIECE[part].sum())
    assert (np.concatenate([k for k, _ in found]) == keys).all()
    assert (np.concatenate([g for _, g in found]) == group).all()


def test_key_filter_holds_all_keys(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**63), 2**63, 50_000)
    df = spark.createDataFrame([(int(k),) for k in keys[:40_000]], "key long")
    for most in (20, 30):
        bitmap = key_filter(df, most)
        assert bitmap.has(keys[:40_000].view(np.uint64)).all()
    assert bitmap.has(keys[40_000:].view(np.uint64)).mean() < 0.1
    assert not key_filter(df.limit(0)).has(keys.view(np.uint64)).any()


def test_word_totals(spark):
    df = spark.createDataFrame([("en", "Über über x. X,x"), ("fr", "x")], "lang string, text string")
    got = {(r.lang, r.word): r.n for r in word_totals(df).collect()}
    assert got == {("en", "Über"): 1, ("en", "über"): 1, ("en", "x"): 3, ("fr", "x"): 1}
