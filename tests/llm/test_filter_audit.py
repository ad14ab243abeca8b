"""Operator 13: tries, prefix ranges and the audit, against brute force."""

import random
import re
from bisect import bisect_right
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from cohortwise.llm.filter_audit import AuditSettings, filter_audit
from cohortwise.llm.tries import RadixTrie, prefix_bounds, shared

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def test_trie_holds_least_ids():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))).encode() for _ in range(3000)] + [b"", b"\xc3\xa9" * 50]
    trie, least, nodes = RadixTrie(), {}, {}
    for key, text in enumerate(rng.sample(texts, len(texts))):
        given = None if key % 7 == 0 else key
        assert nodes.setdefault(text, trie.insert(text, given)) == trie.insert(text, given)
        least.setdefault(text, []).append(given)
    found = list(trie.texts())
    assert [t for _, t in found] == sorted(least)
    for node, text in found:
        assert nodes[text] == node
        assert trie.least[node] == min((k for k in least[text] if k is not None), default=None)
    assert shared(b"abc", b"xabd", 1) == 2 and shared(b"", b"a") == 0


def brute(rows, labels, settings=AuditSettings()):
    masks = []
    for key, text, lang in rows:
        text = text or ""
        words = WORDS.findall(text)
        fails = (
            len(words) < settings.words,
            100 * len(set(words)) < settings.distinct * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > settings.capitals * len(text),
            any(c in "#$%&*|" for c in text),
            key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows),
        )
        marks = [v for k, *v in labels if k is not None and k == key]
        masks.append((lang or "", dict(zip("ABCDE", fails)), any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out = {}
    for part in {m[0] for m in masks}:
        mine = [m for m in masks if m[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, x in enumerate(order):
                left = [m for m in mine if not any(m[1][y] for y in order[:step])]
                removed = [m for m in left if m[1][x]]
                shapley[x] += len(removed)
                out[part, order, step + 1] = [
                    len(left) - len(removed), len(removed), sum(m[1][x] for m in mine) - len(removed),
                    sum(m[1][x] and sum(m[1].values()) == 1 for m in mine),
                    sum(m[2] for m in removed), sum(m[3] for m in removed),
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def audited(df, labels, settings=AuditSettings()):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = filter_audit(df, labels, settings).collect()
    found = {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (7, 1, 1), (9, None, 1), (None, 1, 1), (99, 1, 1), (4, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x")).withColumn("mask", F.lit(3))


def test_audit_of_odd_rows(spark, odd, empty, labels):
    df = odd.withColumn("part", F.lit("y")).withColumn("n", F.lit(1))
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    marks = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    for settings in (AuditSettings(), AuditSettings(words=3, range_bytes=64)):
        assert audited(df, labels, settings) == brute(rows, marks, settings)
    assert audited(empty, labels) == {}
    assert audited(odd, labels.limit(0)) == brute(rows, [])


def random_rows(seed, n):
    """Copies, a hot text, texts that share long beginnings, null ids and repeated ids."""
    rng = random.Random(seed)
    start = "Same Beginning of many texts. " * 40  # longer than a head
    texts = [start + "".join(rng.choice("ab é") for _ in range(rng.randint(0, 6))) for _ in range(30)]
    texts += ["".join(rng.choice("AB #") for _ in range(rng.randint(0, 5))) for _ in range(30)] + [None, ""]
    out = []
    for i in range(n):
        text = "hot " * 30 if rng.random() < 0.3 else rng.choice(texts)
        key = None if rng.random() < 0.1 else 5 if rng.random() < 0.1 else i
        out.append((key, text, rng.choice(["en", "fr", None, ""])))
    return out


def test_audit_of_copies_over_many_ranges(spark, labels):
    rows = random_rows(1, 600)
    marks = [(r.doc_id, r.quality, r.toxic) for r in labels.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    settings = AuditSettings(words=3, range_bytes=300)
    assert audited(df, labels, settings) == brute(rows, marks, settings)


def test_ranges_are_of_bounded_size(spark):
    rows = random_rows(2, 800)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bounds = prefix_bounds(df, 2000)
    assert bounds[0] == b"" and bounds == sorted(set(bounds))
    sizes, kinds = {}, {}
    for _, text, _ in rows:
        data = (text or "").encode()
        at = bisect_right(bounds, data) - 1
        sizes[at] = sizes.get(at, 0) + len(data) + 16
        kinds.setdefault(at, set()).add(data)
    # a range is above its size by at most one node, unless it holds a single text
    assert all(s <= 4000 or len(kinds[at]) == 1 for at, s in sizes.items())
    assert prefix_bounds(df.limit(0)) == [b""]
