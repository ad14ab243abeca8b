"""Conversations as training records: one template, one encoding, a loss mask aligned by offsets.

A turn becomes ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line end. Control strings inside roles and
texts (the template's, the tokenizer's and ``reserved`` ones) are broken by a backslash after their first
character, and backslashes are doubled, so no text can end its turn and every text can be read back.

A conversation is rendered whole and encoded once. Turns know where their texts lie in the rendered
characters, tokens know theirs; two binary searches in the sorted token spans give the tokens of each turn. The
template's strings are tokens of their own, so no token reaches from a text into the template.

Conversations longer than ``segment_chars`` are spread over tasks and stored as several records, cut between
turns; as the cut is at a template token, the ids are those of the whole. A text longer than that is encoded
in parts which end before a space after something else, where this kind of tokenizer always cuts.
"""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, small_side
from cohortwise.llm.tokens import CUT, read_description

OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
RESERVED = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
PART_CHARS = 1 << 16

RECORDS = (
    "conv_id long, segment long, n_turns long, text string, ids binary, starts binary, ends binary, loss binary, "
    "turns array<struct<role: string, start: long, end: long, first: long, last: long, trained: boolean>>"
)


@dataclass(frozen=True)
class ChatSettings:
    """Tokenizer file, roles that are learned, further control strings, characters of a record."""

    tokenizer: str
    trained: tuple[str, ...] = ("assistant",)
    reserved: tuple[str, ...] = RESERVED
    segment_chars: int = 1 << 18


class Escapes:
    """Breaks control strings, reversibly."""

    def __init__(self, controls: tuple[str, ...]):
        self.controls = tuple(dict.fromkeys((OPEN, MIDDLE, CLOSE, *controls)))
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"not a control string: {c!r}")
            for mark in (OPEN, MIDDLE, CLOSE):
                for k in range(1, len(c)):
                    # neither a text before a mark nor one after it may complete a control string
                    if mark.startswith(c[k:]) or c[k:].startswith(mark) or mark.endswith(c[:k]) or c[:k].endswith(mark):
                        raise ValueError(f"{c!r} overlaps {mark!r}")
        self.breaks = re.compile(r"\\|(?=" + "|".join(map(re.escape, self.controls)) + ").", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.breaks.sub(lambda m: m[0] + "\\", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


class ChatEncoder:
    """Ids and character spans of rendered turns."""

    def __init__(self, description: str, reserved: tuple[str, ...]):
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        special = tuple(t["content"] for t in json.loads(description).get("added_tokens", []))
        self.escapes = Escapes((*special, *reserved))
        self.tokenizer.add_special_tokens([AddedToken(m, normalized=False, special=True) for m in (OPEN, MIDDLE, CLOSE)])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, starts and ends of the tokens of a rendered text."""
        cuts, at = [0], 0
        while len(text) - at > PART_CHARS:
            found = CUT.search(text, at + PART_CHARS)
            if found is None:
                break
            at = found.start()
            cuts.append(at)
        cuts.append(len(text))
        out = []
        for a, b in zip(cuts, cuts[1:]):
            coded = self.tokenizer.encode(text[a:b], add_special_tokens=False)
            spans = np.array(coded.offsets, np.int64).reshape(-1, 2) + a
            out.append((np.array(coded.ids, "<u4"), spans[:, 0], spans[:, 1]))
        return tuple(np.concatenate(c) for c in zip(*out))


_ENCODERS: dict = {}


def _encoder(description: str, reserved: tuple[str, ...]) -> ChatEncoder:
    key = hash(description), reserved
    if key not in _ENCODERS:
        _ENCODERS[key] = ChatEncoder(description, reserved)
    return _ENCODERS[key]


def turn_tokens(starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and the one after the last that meet each span, by binary search; an empty span has none."""
    first = np.searchsorted(ends, begin, "right")
    last = np.searchsorted(starts, end, "left")
    return first, np.where(end > begin, np.maximum(first, last), first)


class Record:
    """The turns of a conversation, or of a stretch of a long one."""

    def __init__(self, key):
        self.key, self.parts, self.turns, self.size = key, [], [], 0

    def add(self, role: str, text: str, escapes: Escapes) -> None:
        head = f"{OPEN}{escapes.escape(role)}{MIDDLE}"
        body = escapes.escape(text)
        start = self.size + len(head)
        self.parts += (head, body, CLOSE, "\n")
        self.turns.append((role, start, start + len(body)))
        self.size = start + len(body) + len(CLOSE) + 1

    def row(self, encoder: ChatEncoder, trained: tuple[str, ...], segment: int) -> dict:
        text = "".join(self.parts)
        ids, starts, ends = encoder.encode(text)
        begin, end = (np.array([t[i] for t in self.turns], np.int64) for i in (1, 2))
        first, last = turn_tokens(starts, ends, begin, end)
        loss, turns = np.zeros(len(ids), np.uint8), []
        for (role, a, b), i, j in zip(self.turns, first.tolist(), last.tolist()):
            learned = role in trained
            loss[i:j] |= learned
            turns.append({"role": role, "start": a, "end": b, "first": i, "last": j, "trained": learned})
        packed = {"ids": ids, "starts": starts.astype("<u4"), "ends": ends.astype("<u4"), "loss": loss}
        return {
            "conv_id": self.key, "segment": segment, "n_turns": len(self.turns), "text": text, "turns": turns,
            **{name: values.tobytes() for name, values in packed.items()},
        }


_TURN = pa.struct(
    [("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("trained", pa.bool_())]
)
_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("segment", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string())]
    + [(c, pa.binary()) for c in ("ids", "starts", "ends", "loss")]
    + [("turns", pa.list_(_TURN))]
)


def format_conversations(conversations: DataFrame, settings: ChatSettings) -> DataFrame:
    """Records of all conversations: rendered text, ids, token spans, loss mask and turn spans.

    ``conversations`` needs ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. Turns are
    taken by ``turn``, then role and text, nulls first; rows that repeat a turn, or are equal, stay turns of
    their own. A null role or text is an empty one. Rows without ``conv_id`` are one conversation without an id.
    ``ids``, ``starts`` and ``ends`` are unsigned 32-bit integers, ``loss`` is a byte for each token; spans count
    code points. The records of a conversation follow one another by ``segment``. An empty table has no records.
    """
    spark = conversations.sparkSession
    description = spark.sparkContext.broadcast(read_description(settings.tokenizer))
    trained, reserved, limit = settings.trained, settings.reserved, settings.segment_chars
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    sizes = rows.groupBy("conv_id").agg(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 30).alias("chars"))
    giants = small_side(sizes.filter(F.col("chars") > limit).select(F.col("conv_id").alias("_giant"), F.lit(True).alias("spread")))
    marked = rows.join(giants, rows["conv_id"].eqNullSafe(giants["_giant"]), "left")
    # a conversation that fits in a record has one key, so that ranges never part it
    keys = [F.when(F.col("spread"), c) for c in (F.col("turn"), F.col("role"), F.substring("text", 1, 64))]
    dealt = (
        marked.repartitionByRange(F.col("conv_id"), *keys)
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )

    def work(batches):
        encoder = _encoder(description.value, reserved)
        segment = TaskContext.get().partitionId() << 32
        record, out, size = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for key, role, text in zip(*columns):
                if record is not None and (key != record.key or record.size > limit):
                    out.append(record.row(encoder, trained, segment))
                    size += record.size
                    segment, record = segment + 1, None
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_pylist(out, _SCHEMA)
                        out, size = [], 0
                if record is None:
                    record = Record(key)
                record.add(role or "", text or "", encoder.escapes)
        if record is not None:
            out.append(record.row(encoder, trained, segment))
        yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    return arrow_map(dealt, work, RECORDS)


TURNS = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}\n", re.DOTALL)


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of the turns of a rendered text."""
    found, at = [], 0
    for m in TURNS.finditer(text):
        if m.start() != at:
            break
        found.append((Escapes.unescape(m[1]), Escapes.unescape(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError("not a rendered conversation")
    return found


def learned_texts(text: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The texts under the runs of learned tokens."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss, [0]]).astype(np.int8)))
    return [Escapes.unescape(text[starts[a] : ends[b - 1]]) for a, b in edges.reshape(-1, 2).tolist()]


class _Digest:
    def __init__(self, key):
        self.key, self.turns, self.chars, self.learned = key, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, starts, ends, loss) -> None:
        for role, said in read_turns(text):
            self.all.update(f"{role}\n{said}\n".encode())
            self.turns += 1
        for said in learned_texts(text, starts, ends, loss):
            self.loss.update(said.encode())
            self.learned += len(said)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.key, self.turns, self.all.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


def digests(records: DataFrame) -> DataFrame:
    """Per conversation, read from its records alone: counts and sha256 of all turns and of what is learned.

    A digest runs over its text in order, so the records of one conversation pass through one task; it
    holds one record at a time.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def work(batches):
        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 6, kinds)], names=names)

        digest, out = None, []
        for batch in batches:
            packed = (batch.column(c) for c in ("starts", "ends", "loss"))
            for key, text, starts, ends, loss in zip(
                batch.column("conv_id").to_pylist(), batch.column("text").to_pylist(), *(c.to_pylist() for c in packed)
            ):
                if digest is None or key != digest.key:
                    if digest is not None:
                        out.append(digest.row())
                    digest = _Digest(key)
                digest.add(text, np.frombuffer(starts, "<u4"), np.frombuffer(ends, "<u4"), np.frombuffer(loss, np.uint8))
            if out:
                yield batch_of(out)
                out = []
        yield batch_of([digest.row()] if digest is not None else [])

    rows = records.select("conv_id", "segment", "text", "starts", "ends", "loss").repartition("conv_id")
    return arrow_map(
        rows.sortWithinPartitions("conv_id", "segment"), work,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
