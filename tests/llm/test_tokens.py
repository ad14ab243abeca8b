"""Operators 1 and 6: tokens, coded files, packing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortwise.llm import rans
from cohortwise.llm.packing import PackSettings, first_fit_decreasing, pack_documents, sequences
from cohortwise.llm.token_files import TokenFileSettings, read_token_files, write_token_files
from cohortwise.llm.tokens import PartEncoder, read_description

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {
    cut: (PartEncoder(read_description(path), cut), Tokenizer.from_file(path))
    for path, cut in ((WORD, "words"), (BYTE, "spaced"))
}
ODD_PARTS = st.sampled_from(
    ["the", " of", "\n", "\n\n", "  ", " \n", "é", "É", "é", "Σ", "ß", "don't", "'s ", "<|endoftext|>",
     "<|ENDOFTEXT|>", "12", ".,", "…", " ", "\x1c", "\x85", "İ", "中", "😀", "\t", "New York,", "x!"]
)


@given(st.lists(st.one_of(ODD_PARTS, st.text(max_size=6)), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_parts_give_the_ids_of_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    for own, whole in ENCODERS.values():
        assert own.ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids


@given(st.lists(st.one_of(st.none(), st.lists(st.one_of(ODD_PARTS, st.text(max_size=6)), max_size=10).map("".join)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_a_column_has_the_ids_of_its_texts(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    for own, whole in ENCODERS.values():
        ids, bounds = own.encode_column(column)
        assert len(bounds) == len(texts) + 1 and bounds[-1] == len(ids)
        for text, a, b in zip(texts, bounds, bounds[1:]):
            assert ids[a:b].tolist() == whole.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 63, 64, 1000, 70_000, 300_001])
def test_coded_ids_come_back(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 40_000).astype(np.uint32)
    counts = np.bincount(np.append(ids, 7), minlength=49_408)
    table = rans.FrequencyTable.of(counts)
    assert int(table.frequencies.sum()) == 1 << table.bits and (table.frequencies[counts > 0] > 0).all()
    payload = rans.Payload(rans.encode(ids, table, 1 << 14), table)
    assert (payload.ids() == ids).all()
    for k in reversed(range(payload.segments)):  # checkpoints are independent
        first = k * payload.per_segment * payload.lanes
        part = payload.segment(k)
        assert (part == ids[first : first + len(part)]).all()


def test_damage_is_noticed():
    ids = np.arange(5000, dtype=np.uint32) % 300
    table = rans.FrequencyTable.of(np.bincount(ids))
    data = bytearray(rans.encode(ids, table))
    data[-40] ^= 1
    with pytest.raises(ValueError):
        rans.Payload(bytes(data), table).ids()


def test_single_symbol_and_many_symbols():
    one = rans.FrequencyTable.of(np.array([0, 9]))
    assert (rans.Payload(rans.encode(np.ones(500, np.uint32), one), one).ids() == 1).all()
    many = rans.FrequencyTable.of(np.append(np.ones(200_000, np.int64), 10**9), bits=16)
    assert int(many.frequencies.sum()) == 1 << many.bits and many.frequencies.min() >= 1


def test_files_of_odd_documents(spark, odd, empty, tmp_path):
    settings = TokenFileSettings(WORD, block_ids=5000)
    write_token_files(odd, str(tmp_path / "a"), settings)
    got = read_token_files(spark, str(tmp_path / "a")).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORD)
    expected = sorted(
        (r.doc_id if r.doc_id is not None else -1, (tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]))
        for r in odd.select("doc_id", "text").collect()
    )
    found = [(r.doc_id if r.doc_id is not None else -1, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
    assert sorted(found) == expected and [k for k, _ in found] == sorted(k for k, _ in found)
    ends = np.cumsum([r.n_tokens for r in got])
    assert [r.start for r in got] == [0, *ends[:-1]]
    write_token_files(empty, str(tmp_path / "b"), settings)
    assert read_token_files(spark, str(tmp_path / "b")).count() == 0


def brute_first_fit(lengths, capacity):
    room, out = [], []
    for n in lengths:
        k = next((i for i, r in enumerate(room) if r >= n), len(room))
        if k == len(room):
            room.append(capacity)
        out.append((k, capacity - room[k]))
        room[k] -= n
    return out


def test_tournament_tree_is_first_fit():
    rng = random.Random(4)
    for _ in range(60):
        capacity = rng.choice([1, 7, 64])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 120))), reverse=True)
        bins, offsets = first_fit_decreasing(np.array(lengths, np.int64), capacity)
        assert list(zip(bins.tolist(), offsets.tolist())) == brute_first_fit(lengths, capacity)


def test_packing_of_odd_documents(odd, empty):
    settings = PackSettings(BYTE, sequence=64, group_pieces=50)
    rows = pack_documents(odd, settings).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    texts = defaultdict(list)
    for r in odd.select("doc_id", "text").collect():
        texts[r.doc_id].append(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4"))
    expected = sorted(
        (k if k is not None else -1, s, zlib.crc32(ids[s : s + 64].tobytes()))
        for k, all_ids in texts.items()
        for ids in all_ids
        for s in range(0, len(ids), 64)
    )
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.ids_crc32) for r in rows) == expected
    sequences_of = defaultdict(list)
    for r in rows:
        sequences_of[r.sequence_id].append((r.offset, r.length, r.padded_length))
    for parts in sequences_of.values():
        at = 0
        for offset, length, padded in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and padded in (at, 64) and (padded == 64 or at & (at - 1) == 0)
    assert pack_documents(empty, settings).count() == 0


def test_sequences_hold_their_pieces(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i * 3 % 17)) for i in range(40)], "doc_id long, text string")
    settings = PackSettings(BYTE, sequence=32)
    placed = pack_documents(docs, settings)
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(docs, placed, settings).collect()}
    for r in placed.collect():
        part = ids[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32


def test_sequences_of_a_mix_hold_each_copy_once(spark):
    rows = [(i % 12 if i % 7 else None, f"text {i} " * (i * 3 % 17)) for i in range(30)]
    docs = spark.createDataFrame([r for k, r in enumerate(rows) for _ in range(1 + k % 3)], "doc_id long, text string")
    settings = PackSettings(BYTE, sequence=32)
    placed = pack_documents(docs, settings).collect()
    table = spark.createDataFrame(placed)
    ids = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(docs, table, settings).collect()}
    lengths = {}
    for r in placed:
        lengths[r.sequence_id] = lengths.get(r.sequence_id, 0) + r.length
        assert zlib.crc32(ids[r.sequence_id][r.offset : r.offset + r.length].tobytes()) == r.ids_crc32
    assert {k: len(v) for k, v in ids.items()} == lengths


def test_forgetting_parts_changes_nothing(monkeypatch):
    monkeypatch.setattr("cohortwise.llm.tokens.REMEMBERED", 3)
    text = "one two three four five one two\nthree, four. five six seven one\n"
    for cut, path in (("words", WORD), ("spaced", BYTE)):
        own = PartEncoder(read_description(path), cut)
        for _ in range(3):
            assert own.ids(text).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert len(own.words) <= 3 and len(own.spaced) <= 3 and len(own.spaced.before) <= 3
