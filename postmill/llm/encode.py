"""Token ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit bytes.

The two public byte-pair files split a text at white space before merging, so a piece between spaces always gets the same ids.
Texts are cut into pieces by array operations; the distinct pieces of a chunk are looked up in a bounded memory of the worker,
and only new ones go to the library's model. Whatever is not plain (other white space than space and newline, special token
strings, rare letters) goes to the library's encode as a whole. Each encoder compares itself with the library on a sample of
awkward texts when it is made; if they differed (another version, another file), all texts would go to the library.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

from postmill.llm import words as W

PIECES, PARTS, CHUNK_BYTES, ROWS = 450_000, 50_000, 3 << 20, 1000
#: marks that end a piece; a run of them after a word is a part of its own in both files
MARKS = ".,;:!?"
_ids = attrgetter("id")
WHITE = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0     　") + tuple(map(chr, range(0x2000, 0x200B)))
SAMPLE = ("a<|endoftext|>b <|startoftext|>", "It's a  test,\n\n of THE encoder: 12.5% (or so)...  we'll see; naïve Übung\n", " x\n y \n\n\n z", "don't!? a_b-c/d@e #1\t\u00a0end", "\u4e2d\u6587 \U0001f600 e\u0301", "")
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d|"


class _Memory(dict):
    """piece -> ids; the older half is dropped when it is full."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most, self.older = find, most // 2, {}

    def known(self, piece: str) -> bytes | None:
        return self.get(piece) or self.older.get(piece)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.find(piece)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return dict(zip([b for b in range(256) if b not in own], range(256, 512), strict=False))


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of rows begin, and the end: a word with one space before it, and the white space between.

    Of white space that ends in a newline before a word, that newline is a piece of its own.
    """
    blank, first = (data == 0x20) | (data == 0x0A), np.zeros(len(data) + 1, bool)
    first[offsets] = True
    after = np.r_[False, blank[:-1]] if len(blank) else blank
    word = np.flatnonzero(~blank & (after | first[:-1]))
    inner = word[~first[word]]
    cut = first.copy()
    cut[:-1] |= blank & ~after
    cut[word] = True
    spaced = inner[data[inner - 1] == 0x20]
    cut[spaced] = first[spaced]
    cut[inner - 1] = True
    return np.flatnonzero(cut)


class Encoder:
    def __init__(self, path: str, plain: bool = False):
        """plain: strings of special tokens in a text are ordinary text."""
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are packed as the machine's 32-bit little-endian integers")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            setup = json.load(file)
        self.tokenizer.encode_special_tokens = plain
        self.special = () if plain else tuple(x["content"] for x in setup["added_tokens"])
        before = setup["pre_tokenizer"] or {}
        self.letters, self.model, self.fold, self.strip, self.simple = _byte_letters(), self.tokenizer.model, str, False, True
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not setup["normalizer"]:
            self.parts = regex.compile(CONTRACTIONS + r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+").findall
            self.plain = re.compile("[ -~\xa1-ɏ]+").fullmatch
        elif before.get("type") == "Sequence" and setup["model"].get("end_of_word_suffix") == "</w>" and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in json.dumps(before).replace("\\\\", "\\"):
            self.strip = True
            found = regex.compile(CONTRACTIONS + r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
            self.parts, self.fold = lambda piece: found(piece.lower()), str.lower
            self.plain = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
        else:
            self.simple = False
        if self.simple and hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)  # the memories below take its place
        self.of_part = _Memory(self._part, PARTS)
        self.of_piece = _Memory(self._stripped if self.strip else self._piece, PIECES)
        self.simple = self.simple and list(self.encode_all(pa.array(SAMPLE))) == [self._whole(x) for x in SAMPLE]

    def _part(self, part: str) -> bytes:
        # of ASCII, a plain part holds only printable letters and spaces
        letters = part.replace(" ", "\u0120") if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return array("I", map(_ids, self.model.tokenize(letters))).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        word = piece[1:] if piece[0] == " " else piece
        if not piece.isascii():
            if piece.isspace() or not self.plain(piece):
                return self._whole(piece)
        elif not piece.isprintable():
            return self._whole(piece)
        if word.isalpha():
            return self._part(self.fold(piece))
        core = piece.rstrip(MARKS)
        if len(core) < len(piece) and core[-1:].isalpha() and core[len(piece) - len(word) :].isalpha():
            # the word is often known without its marks
            return (self.of_piece.known(core) or self._part(self.fold(core))) + self.of_part[piece[len(core) :]]
        if piece.isspace():
            return self._whole(piece)
        parts = self.parts(piece)
        return self._part(piece) if len(parts) == 1 and parts[0] == piece else b"".join(map(self.of_part.__getitem__, parts))

    def _stripped(self, piece: str) -> bytes:
        bare = piece.strip(" \n")
        return self._piece(bare) if bare else b""

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all(pa.array([text], pa.string())))

    def encode_all(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text in turn; null counts as empty. A chunk of texts is held at a time."""
        for a in range(0, len(column), ROWS):
            part = column.slice(a, ROWS)
            texts = part.to_pylist()
            odd = {i: self._whole(t) for i, t in enumerate(texts) if t and (not self.simple or any(c in t for c in WHITE) or any(s in t for s in self.special))}
            if odd:
                mask = np.zeros(len(texts), bool)
                mask[list(odd)] = True
                part = pc.if_else(pa.array(mask), "", part)
            for row, data, offsets in W.chunks(part, CHUNK_BYTES):
                for i, ids in enumerate(self._chunk(data, offsets), row):
                    yield odd.get(i, ids)

    def _chunk(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        cuts = pieces(data, offsets)
        array_ = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        found = array_.dictionary_encode()
        # as objects of an array: several times as fast as to_pylist()
        ids = list(map(self.of_piece.__getitem__, found.dictionary.to_numpy(zero_copy_only=False).tolist()))
        flat, sizes, at = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4, found.indices.to_numpy()
        starts, n = (np.cumsum(sizes) - sizes)[at], sizes[at]
        ends = np.cumsum(n)
        tokens = flat[np.repeat(starts - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        rows = 4 * np.r_[0, ends][np.searchsorted(cuts, offsets)]
        return [tokens[a:b] for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]


@cache
def encoder(path: str, plain: bool = False) -> Encoder:
    """One per worker process and file."""
    return Encoder(path, plain)
