"""Token ids of a public tokenizer, with the ids of pieces kept for the next time they occur.

The tokenizer lowers the case, cuts a text into pieces by a pattern, white space in none of them, and looks up the
ids of each piece in its BPE model. For plain characters the same is done here for a whole text at once, and a piece goes
to the tokenizer's own model only if it wasn't used lately. A word with any other character, or with what may be
a special token, goes to the tokenizer as it is.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable
from functools import cache

from tokenizers import Tokenizer

#: Pieces kept per Python worker in each of two generations, about 40 MB in all.
KEPT_PIECES = 80_000
#: Characters of a longer piece, which isn't kept.
LONG = 64
#: Characters of text that are cut into pieces at a time, about.
BLOCK = 1 << 18
#: Characters other than white space, printable ASCII and letters whose case or composition does not depend on
#: their neighbours, and the beginning of a special token.
_ODD = re.compile(r"[^\t-\r -~À-ÖØ-öø-ÿ]|<\|")
_PLAIN = bytes(b for b in range(256) if not _ODD.match(chr(b)))
_LOWER = bytes(ord(chr(b).lower()) for b in range(256))
#: Fixed value: the pieces other than runs of letters that the tokenizer file names in its pre-tokenizer.
_SIGNS = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff\s]+")
_SPACE = re.compile(r"[ \t-\r]")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself if printable, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Recent(dict):
    """Keys and what ``make`` gave for them; those not used while ``most`` others were are forgotten, LONG ones at once."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key):
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
            if len(key) > LONG:
                return found
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


class TextIds:
    """Text → its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, ordinary_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary_specials
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.packed = [struct.pack("<I", i) for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = Recent(self._piece, KEPT_PIECES)

    def _piece(self, piece: bytes) -> bytes:
        text = piece.decode("latin-1")
        if not piece.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.packed[x.id] for x in self.model.tokenize(text)])

    def _plain(self, text: bytes) -> bytes:
        """The ids of plain text in Latin-1: what isn't letters is set apart, then white space cuts all pieces."""
        pieces = _SIGNS.sub(rb" \g<0> ", text.translate(_LOWER)).split()
        return b"".join(map(self.pieces.__getitem__, pieces))

    def _block(self, text: str) -> bytes:
        try:
            raw = text.encode("latin-1")
            if b"<|" not in raw and not raw.translate(None, _PLAIN):
                return self._plain(raw)
        except UnicodeEncodeError:
            pass
        out, at = [], 0
        while odd := _ODD.search(text, at):
            start, space = odd.start(), _SPACE.search(text, odd.end())
            while start > at and not _SPACE.match(text, start - 1):
                start -= 1
            out.append(self._plain(text[at:start].encode("latin-1")))
            at = space.start() if space else len(text)
            ids = self.tokenizer.encode(text[start:at], add_special_tokens=False).ids
            out.append(b"".join([self.packed[i] for i in ids]))
        out.append(self._plain(text[at:].encode("latin-1")))
        return b"".join(out)

    def text(self, text: str) -> bytes:
        """The ids of a whole text."""
        if len(text) <= BLOCK:
            return self._block(text)
        out, at = [], 0
        while at < len(text):
            space = _SPACE.search(text, at + BLOCK)
            end = space.start() if space else len(text)
            out.append(self._block(text[at:end]))
            at = end
        return b"".join(out)


@cache
def text_ids(path: str, ordinary_specials: bool = False) -> TextIds:
    """One cache of pieces per worker process."""
    return TextIds(path, ordinary_specials)
