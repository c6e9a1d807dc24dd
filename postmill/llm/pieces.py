"""Pre-tokens of a sentencepiece model: runs of a text that the model segments independently of their neighbours.

In the public piece file no piece has U+2581 (its sign for a space) behind another character, and new lines and tabs are in no
piece at all, so merges never cross the place before a run of spaces or before such a character. A text is cut there; each
pre-token begins with a space or such a character and always gets the same pieces. A text's own U+2581 counts as a space, and the
model puts one space before every text that is not empty. For another model without these properties the whole text is one
pre-token. A model compares the pieces of cut texts with the library's on a sample of awkward texts when it is loaded.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from sentencepiece import SentencePieceProcessor

from postmill.llm import words as W

SPACE_SIGN = "▁"
SAMPLE = ("It's a  test,\n\n of THE encoder: 12.5% (or so)...  naïve Übung\n", " x\n \ty \n\n\n z", "中文 \U0001f600 é▁▁x", "<s> </s><0x0A>", "a\r\n b\x00c\t\t", "   ", "\n", "▁", "")


class Pieces:
    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        byte = [self.model.is_byte(i) for i in range(n)]
        joined = "\x01".join(name for name, b in zip(names, byte, strict=True) if not b)
        #: bytes of each piece's text, a byte piece being one
        self.texts = [bytes([int(name[3:5], 16)]) if b else name.replace(SPACE_SIGN, " ").encode() for name, b in zip(names, byte, strict=True)]
        self.breaks = [ord(c) for c in "\n\t" if c not in joined]
        self.cuttable = ord("\n") in self.breaks and not any(SPACE_SIGN in name.lstrip(SPACE_SIGN) for name in names)
        self.cuttable = self.cuttable and self._sample_agrees()

    def _sample_agrees(self) -> bool:
        column = self.prepared(pa.array(SAMPLE))
        for _, data, offsets in W.chunks(column):
            found, indices, rows = self.pre_tokens(data, offsets)
            ids = self.ids(found.to_pylist())
            for r, text in enumerate(SAMPLE):
                if [x for i in indices[rows == r] for x in ids[i]] != self.model.encode(text):
                    return False
        return True

    @staticmethod
    def prepared(texts: pa.Array) -> pa.Array:
        """What the model segments: a space before each text that is not empty, and spaces for U+2581; null as empty."""
        texts = pc.fill_null(texts, "")
        spaced = pc.replace_substring(texts, SPACE_SIGN, " ") if pc.any(pc.match_substring(texts, SPACE_SIGN)).as_py() else texts
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(pa.scalar(""), spaced, " "))

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the pre-tokens of prepared rows begin, and the end."""
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        if self.cuttable:
            for sign in (0x20, *self.breaks):
                here = data == sign
                first[:-1] |= here
                first[1:-1] &= ~(here[1:] & here[:-1])
            first[offsets] = True
        return np.flatnonzero(first)

    def pre_tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct pre-tokens, the number of each occurrence's in them, its row) of prepared rows."""
        cuts = self.starts(data, offsets)
        column = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))
        found = column.dictionary_encode()
        return found.dictionary, found.indices.to_numpy(), np.searchsorted(offsets[1:], cuts[:-1], side="right")

    def ids(self, pre_tokens: list[str]) -> list[list[int]]:
        """The ids of each pre-token. A new line before it keeps the model's own space away; both are cut off again."""
        if self.cuttable:
            return [x[2:] for x in self.model.encode(["\n" + p for p in pre_tokens])]
        return self.model.encode([p[1:] for p in pre_tokens])


@cache
def pieces(path: str) -> Pieces:
    """One per worker process and file."""
    return Pieces(path)
