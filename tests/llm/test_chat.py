"""Operator 11: escapes, offsets, masks and digests, against brute force."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings as run_settings
from hypothesis import strategies as st

from cohortwise.llm import chat
from cohortwise.llm.chat import CLOSE, MIDDLE, OPEN, ChatEncoder, ChatSettings, Escapes, digests, format_conversations, turn_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["\\", "<", "|", "<|", OPEN, MIDDLE, CLOSE, "</s>", "[INST]", "<<SYS>>", "<<", "im_end|>", "é", "😀", "\n", " ", "word", "\\n", ""]
SAID = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return ChatEncoder(file.read(), chat.RESERVED)


@run_settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(SAID, SAID), max_size=5))
def test_turns_read_back(turns):
    escapes = Escapes(chat.RESERVED)
    record = chat.Record(1)
    for role, text in turns:
        body = escapes.escape(text)
        assert not any(c in body for c in escapes.controls)
        assert escapes.unescape(body) == text
        record.add(role, text, escapes)
    rendered = "".join(record.parts)
    assert len(rendered) == record.size
    assert chat.read_turns(rendered) == turns
    assert [rendered[a:b] for _, a, b in record.turns] == [escapes.escape(t) for _, t in turns]


def test_control_strings_must_be_breakable():
    for bad in ("x", "a\\b", ">x", "|><s>", "a<|"):
        with pytest.raises(ValueError):
            Escapes((bad,))
    with pytest.raises(ValueError):
        chat.read_turns("text without a turn")


def test_token_spans_by_binary_search():
    rng = random.Random(5)
    for _ in range(200):
        edges = np.cumsum([rng.randint(1, 4) for _ in range(30)])
        starts, ends = edges[:-1], edges[1:]
        begin = np.sort(np.array([rng.randint(0, int(edges[-1])) for _ in range(8)]))
        end = begin + np.array([rng.randint(0, 9) for _ in range(8)])
        for a, b, i, j in zip(begin, end, *turn_tokens(starts, ends, begin, end)):
            met = [k for k in range(len(starts)) if starts[k] < b and ends[k] > a and b > a]
            assert list(range(i, j)) == met


def test_parts_have_the_ids_of_the_whole(encoder, monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice(["a", " ", "\n", "é", "don't", " 12", "😀", "  ", CLOSE + "\n" + OPEN]) for _ in range(3000))
    whole = encoder.tokenizer.encode(text, add_special_tokens=False)
    monkeypatch.setattr(chat, "PART_CHARS", 50)
    ids, starts, ends = encoder.encode(text)
    assert ids.tolist() == whole.ids and list(zip(starts.tolist(), ends.tolist())) == whole.offsets
    covered = np.zeros(len(text), bool)
    for a, b in zip(starts, ends):
        covered[a:b] = True
    assert covered.all()


def brute(rows):
    """conv_id -> digests, from the turns alone."""
    escapes = Escapes(chat.RESERVED)
    out = {}
    for key in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == key), key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
        turns = [(role or "", text or "") for _, role, text in turns]
        learned = "".join(text for role, text in turns if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for role, text in turns)
        chars = sum(len(escapes.escape(r)) + len(escapes.escape(t)) + len(OPEN + MIDDLE + CLOSE) + 1 for r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[key] = (len(turns), sha(every), len(learned), sha(learned), chars)
    return out


def digested(records):
    rows = digests(records).collect()
    got = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def conversations(spark, rows, partitions=4):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(partitions)
    return df.select("*", *(F.lit(f"x{i}").alias(c) for i, c in enumerate(("segment", "spread", "ids", "_giant", "chars", "turns"))))


def random_rows(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        key = None if rng.random() < 0.05 else 3 if rng.random() < 0.3 else rng.randint(10, 60)
        role = rng.choice(["user", "assistant", "assistant", "system", None, "as" + CLOSE, ""])
        text = None if rng.random() < 0.05 else "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 20)))
        out.append((key, None if rng.random() < 0.05 else rng.randint(0, 40), role, text))
    return out + out[:20] + [(7, 0, "assistant", "very long " * 30_000), (8, 1, "assistant", ""), (9, 1, "user", "x")]


@pytest.mark.parametrize("limit", [1 << 18, 300])
def test_digests_of_records(spark, limit):
    rows = random_rows(1, 700)
    records = format_conversations(conversations(spark, rows), ChatSettings(PATH, segment_chars=limit))
    assert digested(records) == brute(rows)
    found = records.groupBy("conv_id").count().collect()
    if limit == 300:
        assert max(r["count"] for r in found) > 10
    else:
        assert all(r["count"] == 1 for r in found if r.conv_id != 7)


def test_records(spark, encoder):
    rows = [(1, 0, "user", "Hi </s>"), (1, 1, "assistant", " é😀 \\ok "), (1, 2, "assistant", "")]
    r = format_conversations(conversations(spark, rows), ChatSettings(PATH)).first()
    ids, loss = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.loss, np.uint8)
    whole = encoder.tokenizer.encode(r.text, add_special_tokens=False)
    assert ids.tolist() == whole.ids and len(loss) == len(ids)
    # the ids under the mask are those of the text by itself
    assert ids[loss == 1].tolist() == encoder.tokenizer.encode(encoder.escapes.escape(rows[1][3])).ids
    specials = {encoder.tokenizer.token_to_id(m) for m in (OPEN, MIDDLE, CLOSE)}
    assert sum(i in specials for i in ids.tolist()) == 9
    assert [(t.role, r.text[t.start : t.end], t.trained) for t in r.turns] == [
        (role, encoder.escapes.escape(text), role == "assistant") for _, _, role, text in rows
    ]
    assert r.turns[2].first == r.turns[2].last and json.loads(json.dumps(r.n_turns)) == 3


def test_empty_table_has_no_records(spark):
    records = format_conversations(conversations(spark, []), ChatSettings(PATH))
    assert records.count() == 0 and digested(records) == {}
