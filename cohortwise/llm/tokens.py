"""Token ids of many texts, exactly as the given tokenizer makes them, with repeated parts remembered.

Byte-pair tokenizers split a text into pieces that never cross certain places, so a text may be cut
there and its parts be looked up in a bounded memory of parts met before. Two cuts are offered:

``words``
    for tokenizers that drop white space and lower-case: between words.
``spaced``
    for byte-level tokenizers that keep the space with the word after it: before a space or line end
    that follows something other than white space.

Parts that are plain Latin letters go to the byte-pair model itself; every other part goes through
the whole tokenizer. Whether the short way agrees is probed once per process, and without agreement
it is not taken.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortwise.llm.common import bytes_of, pieces

REMEMBERED = 250_000
PART_BYTES = 2 << 20
LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = ".,;:!?"
SPACE_RUN = re.compile("[\\s\u180e][ \n]")
CUT = re.compile("(?<=[^\\s\u180e])(?=[ \n])")
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
# Bytes that begin white space beyond ASCII; texts with one are cut by the pattern.
WIDE = np.zeros(256, bool)
WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
WIDE_SPACE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
PROBES = ("the", "Of", "tokens,", "Été.", "señor", "größe!", "Über;", "x", "a,", "New", "I")


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level tokenizers: bytes that do not print follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return table


class Memory(dict):
    """Parts met before. When half of it is full, the other half, not used since, is forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, part):
        ids = self.before.get(part)
        if ids is None:
            ids = self.make(part)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[part] = ids
        return ids


class PartEncoder:
    """Ids of texts as packed unsigned integers of 2 or 4 bytes."""

    def __init__(self, description: str, cut: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.model = self.tokenizer.model
        self.cut = cut
        self.kind = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 65536 else np.uint32)
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.alphabet = _byte_alphabet()
        self.space = self.alphabet[32]
        self.lower = '"Lowercase"' in json.dumps(json.loads(description).get("normalizer"))
        self.words = Memory(lambda part: self._part(part.decode()))
        self.bare = Memory(self._part)
        self.spaced = Memory(lambda part: self._part(part, " "))
        self.short = True
        self.short = all(
            self._piece(lead + p) == self._whole(lead + p) for p in PROBES for lead in ("", " ", "\n") if cut == "spaced" or not lead
        )

    def _whole(self, part: str) -> bytes:
        return array(self.code, self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()

    def _model(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha():  # letters stand for themselves
            text = self.space + piece[1:] if piece[0] == " " else piece
        else:
            text = piece.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()

    def _piece(self, part: str) -> bytes | None:
        """Ids of letters with at most one space or line end before and one mark after; else nothing."""
        lead = part[0] if part[0] in " \n" else ""
        body = part[len(lead) :]
        mark = body[-1] if body and body[-1] in MARKS else ""
        body = body[:-1] if mark else body
        if not (body.isascii() and body.isalpha()) and not LATIN.fullmatch(body) or (lead and self.cut == "words"):
            return None
        if self.lower:
            body = body.lower()
        if lead == "\n":
            ids = self.bare[lead] + (self.bare[body] if mark else self._model(body))
        elif mark:
            ids = self.spaced[body] if lead else self.words[body.encode()] if self.cut == "words" else self.bare[body]
        else:
            ids = self._model(lead + body)
        return ids + (self.words[mark.encode()] if self.cut == "words" else self.bare[mark]) if mark else ids

    def _part(self, part: str, lead: str = "") -> bytes:
        ids = self._piece(lead + part) if self.short and part else None
        return self._whole(lead + part) if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        """The packed ids of one whole text; null is empty."""
        if not text:
            return b""
        if self.cut == "words":
            data = text.encode()
            # lowering is part of the tokenizer, but names of special tokens keep their case
            parts = (data.lower() if self.lower and b"<|" not in data else data).split()
            return b"".join(map(self.words.__getitem__, parts))
        if SPACE_RUN.search(text):
            return b"".join(map(self.bare.__getitem__, CUT.split(text)))
        out, lead, spaced = [], "", self.spaced.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            first = lead + first
            if first:
                out.append(self.bare[first])
            out += map(spaced, rest)
            lead = "\n"
        return b"".join(out)

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.kind)

    def _word_parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts, and where each text's parts begin."""
        if self.lower:
            named = pc.match_substring(texts, "<|")  # names of special tokens keep their case
            texts = pc.if_else(named, texts, pc.ascii_lower(texts))
        parts = pc.ascii_split_whitespace(texts)
        return parts.flatten().cast(pa.binary()), np.asarray(parts.offsets, np.int64) - parts.offsets[0].as_py()

    def _spaced_parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        data, bounds = bytes_of(texts)
        blank = BLANK[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = ((data[1:] == 32) | (data[1:] == 10)) & ~blank[:-1]
        wide = np.flatnonzero(WIDE[data])
        for i in np.unique(np.searchsorted(bounds, wide, "right") - 1).tolist():
            text = data[bounds[i] : bounds[i + 1]].tobytes().decode()
            if WIDE_SPACE.search(text):  # a space after wide white space is no place to cut
                for m in WIDE_SPACE.finditer(text):
                    if text[m.end() : m.end() + 1] in (" ", "\n"):
                        cut[bounds[i] + len(text[: m.end()].encode())] = False
        cut[bounds] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        edges = np.append(starts, len(data))
        parts = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))]
        )
        return parts, np.searchsorted(edges[:-1], bounds, "left")

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, and where each text begins.

        Texts are taken a few megabytes at a time; each distinct part of those is looked up once.
        """
        texts = column.fill_null("") if column.null_count else column
        found, bounds, total = [np.zeros(0, self.kind)], [np.zeros(1, np.int64)], 0
        for a, b in pieces(bytes_of(texts)[1], PART_BYTES):
            ids, at = self._encoded(texts.slice(a, b - a))
            found.append(ids)
            bounds.append(at[1:] + total)
            total += len(ids)
        return np.concatenate(found), np.concatenate(bounds)

    def _encoded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts, at = self._word_parts(texts) if self.cut == "words" else self._spaced_parts(texts)
        coded = parts.dictionary_encode()
        if self.cut == "words":
            found = [self.words[p] if p else b"" for p in coded.dictionary.to_pylist()]
        else:
            found = [self.bare[p.decode()] for p in coded.dictionary.to_pylist()]
        width = self.kind.itemsize
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // width
        flat, starts = np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = flat[np.repeat(starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[at]


_ENCODERS: dict[tuple[int, str], PartEncoder] = {}


def encoder(description: str, cut: str) -> PartEncoder:
    """The encoder of this process for a tokenizer description."""
    key = (zlib.crc32(description.encode()), cut)
    if key not in _ENCODERS:
        _ENCODERS[key] = PartEncoder(description, cut)
    return _ENCODERS[key]


def read_description(path: str) -> str:
    """The tokenizer file, read by the driver; its size does not depend on the data."""
    with open(path, encoding="utf-8") as file:
        return file.read()
