"""Token ids of whole texts by the tokenizers library, with the ids of frequent chunks remembered.

Both vocabularies cut a text at places that a few neighbouring bytes decide, so a text can be cut
at some of those places beforehand and its chunks encoded one by one: the ids are those of the
whole text. The cuts used here are

* between an ASCII letter and ASCII punctuation or a digit, either way round, but for the
  apostrophe, which may begin a contraction;
* "word" kind, which drops white space and lower-cases: at ASCII white space;
* "byte" kind, where a space goes with the word after it: before a space that follows a character
  which is no white space for certain (printable ASCII, or two bytes with a first byte from C3).

A text that holds the beginning of a special token's string is cut at white space only.
"""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

import numpy as np

#: Chunks remembered by a Python worker, and the longest that is. The first ones seen stay: frequent chunks come early.
CACHE_ENTRIES = 150_000
CACHED_BYTES = 40
#: Bytes of text cut at once, whole documents.
GROUP_BYTES = 1 << 18

_CUT = b"\xff"  # in no UTF-8 text
#: Letters below are taken as such by every version of Unicode.
_LATIN = "\u0250"
#: How byte-level vocabularies write bytes that aren't printable Latin-1: as the characters from U+0100 on.
_WRITTEN = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE))}
_LETTER, _MARK, _SPACE, _TAIL, _LEAD = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[[b for b in range(0x21, 0x7F) if not chr(b).isalpha() and b != 0x27]] = _MARK
_CLASS[0x20] = _SPACE
_CLASS[0x80:0xC0] = _TAIL
_CLASS[0xC3:0xE0] = _LEAD


class ChunkEncoder(dict):
    """Encodes whole texts to little-endian unsigned 32-bit ids; as a dict, the chunks it remembers."""

    def __init__(self, path: str, kind: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.kind = kind

    def chunks(self, text: bytes) -> list[bytes]:
        plain = b"<|" in text
        if self.kind == "word":
            if plain:
                return text.split()
            text = text.lower()
        data = np.frombuffer(text, np.uint8)
        kinds = _CLASS[data]
        before, after = kinds[:-1], kinds[1:]
        cut = np.zeros(len(before), bool) if plain else (before | after) == (_LETTER | _MARK)
        if self.kind == "word":
            return np.insert(data, np.flatnonzero(cut) + 1, 0x20).tobytes().split()
        solid = (before & (_LETTER | _MARK)) != 0
        solid |= data[:-1] == 0x27
        solid[1:] |= (before[1:] == _TAIL) & (before[:-1] == _LEAD)
        cut |= (after == _SPACE) & solid
        breaks = np.flatnonzero((data[1:-1] == 0x0A) & solid[:-1] & ((after[1:] & (_LETTER | _MARK)) != 0))
        cut[breaks] = True
        cut[breaks + 1] = True
        return np.insert(data, np.flatnonzero(cut) + 1, 0xFF).tobytes().split(_CUT)

    def __missing__(self, chunk: bytes) -> bytes:
        ids = array("I", self._ids(chunk)).tobytes()
        if len(self) < CACHE_ENTRIES and len(chunk) <= CACHED_BYTES:
            self[chunk] = ids
        return ids

    def _ids(self, chunk: bytes) -> list[int]:
        text = chunk.decode("utf-8", "replace")
        word = text[1:] if self.kind == "byte" and text[:1] == " " else text
        if len(chunk) <= CACHED_BYTES and word.isalpha() and (word.isascii() or max(word) < _LATIN and is_normalized("NFC", word)) and (self.kind == "byte" or word == word.lower()):
            # a run of letters is one piece for the vocabulary's merges; bytes are written as letters
            piece = chunk.decode("latin-1").translate(_WRITTEN) if not word.isascii() else word if word is text else "\u0120" + word
            return [t.id for t in self.merge(piece)]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, self.chunks(x))) if x else b"" for x in texts]

    def encode(self, text: bytes) -> bytes:
        return self.encode_all([text])[0]


def in_groups(items, text_at: int):
    """Lists of consecutive rows whose texts have GROUP_BYTES or so together."""
    group, held = [], 0
    for row in items:
        group.append(row)
        held += len(row[text_at] or b"")
        if held >= GROUP_BYTES:
            yield group
            group, held = [], 0
    if group:
        yield group


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, kind: str) -> ChunkEncoder:
    """One encoder for each Python worker and vocabulary."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = ChunkEncoder(path, kind)
    return _ENCODERS[path, kind]


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, the default of the operators' path parameters."""
    import public_tokenizers

    return public_tokenizers.path(name)
