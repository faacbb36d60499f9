"""Pre-tokens of whole texts, and the pieces of each distinct pre-token.

A tokenizer file of the tokenizers library is applied in two halves: texts are cut into pre-tokens, and the merges run once
for each distinct pre-token of a block of texts. Texts of Latin letters, digits and common marks are cut here by the file's
own split rule (fixed below); all others are cut by the library, and texts that hold a special token are encoded by it.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from martloom.llm.common import text_bytes

# The split rule of the file for lower-cased text, over the code points below LATIN and the marks U+2010-2027.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
WHITE = "\t\n\x0b\x0c\r \x85\xa0"
LATIN = 0x180
CACHE = 1 << 19


def _in_class(kind: str) -> str:
    # Lower-casing letters below LATIN stays below LATIN, apart from a combining dot that is a mark.
    return "".join(re.escape(chr(c)) for c in range(LATIN) if unicodedata.category(chr(c))[0] == kind)


_L, _N = _in_class("L"), _in_class("N")
_FIND = re.compile("|".join([*CONTRACTIONS, f"[{_L}]+", f"[{_N}]", f"[^{re.escape(WHITE)}{_L}{_N}]+"]))


def _byte_alphabet() -> dict[int, str]:
    """The visible character that byte-level tokenizers use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in names:
            names[b] = chr(0x100 + len(names) - len(shown))
    return names


_BYTES = _byte_alphabet()


class Pieces(dict):
    """The number of each pre-token met so far, and the ids of each number. Bounded: between blocks a full one starts anew."""

    def __init__(self, tokenizer_json: str) -> None:
        super().__init__()
        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.flat, self.sizes = array("I"), array("I")

    def _model_tokens(self, pretoken: str) -> list:
        return self.library.model.tokenize("".join([_BYTES[b] for b in pretoken.encode("utf-8")]))

    def size(self, pretoken: str) -> int:
        """The number of pieces; nothing is remembered."""
        return len(self._model_tokens(pretoken))

    def __missing__(self, pretoken: str) -> int:
        ids = [t.id for t in self._model_tokens(pretoken)]
        self.flat.extend(ids)
        self.sizes.append(len(ids))
        self[pretoken] = number = len(self.sizes) - 1
        return number

    def begin_block(self) -> None:
        if len(self) >= CACHE:
            self.clear()
            self.flat, self.sizes = array("I"), array("I")

    def cut(self, text: str, plain: bool) -> list[str] | None:
        """Pre-tokens of a text; None if the library has to encode the whole text."""
        if "<" in text and any(s in text for s in self.special):
            return None
        if plain:
            return _FIND.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)


_HELD: dict[str, Pieces] = {}


def held_pieces(tokenizer_json: str) -> Pieces:
    """The pieces of this vocabulary that stay with the worker, so that its next tasks need not tokenise the same pre-tokens again."""
    if tokenizer_json not in _HELD:
        _HELD.clear()
        _HELD[tokenizer_json] = Pieces(tokenizer_json)
    return _HELD[tokenizer_json]


def plain_rows(column: pa.Array) -> np.ndarray:
    """For each row whether all its code points are below LATIN or marks of U+2010-2027."""
    data, offsets = text_bytes(column)
    odd = data >= 0xC6
    lead = np.flatnonzero(data[:-2] == 0xE2) if len(data) > 2 else np.zeros(0, np.int64)
    lead = lead[(data[lead + 1] == 0x80) & (data[lead + 2] >= 0x90) & (data[lead + 2] <= 0xA7)]
    odd[lead] = False
    sums = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
    return sums[offsets[1:]] == sums[offsets[:-1]]


@dataclass
class Block:
    """A block of texts: pre-token numbers in order and their bounds per row; size of each number's ids and all those ids one
    after the other; and the ids of rows that only the library can encode."""

    code: np.ndarray
    bounds: np.ndarray
    sizes: np.ndarray
    flat: np.ndarray
    wholes: dict[int, np.ndarray]


def block_pieces(column: pa.Array, pieces: Pieces) -> Block:
    pieces.begin_block()
    found: list[str] = []
    bounds, wholes = [0], {}
    for i, (text, plain) in enumerate(zip(column.to_pylist(), plain_rows(column), strict=True)):
        cut = pieces.cut(text, plain) if text else []
        if cut is None:
            wholes[i] = pieces.whole(text)
        else:
            found += cut
        bounds.append(len(found))
    code = np.fromiter(map(pieces.__getitem__, found), np.int64, len(found))
    return Block(code, np.array(bounds), np.array(pieces.sizes, np.int64), np.array(pieces.flat, np.uint32), wholes)
