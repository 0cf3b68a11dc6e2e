"""Pre-tokens and their pieces, for vocabularies of the tokenizers library.

The library does all the work on texts with unusual characters. Texts made of common ones only (PLAIN) are
cut into pre-tokens by an equal pattern of the standard `re` module, which is several times faster, and each
distinct pre-token goes through the library's BPE model once.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from functools import cache

import numpy as np
from tokenizers import Tokenizer

# Characters for which the patterns below and the library's own agree: printable ones below U+0180.
PLAIN_END = 0x180
NOT_PLAIN = re.compile("[^\t\n\r -~¡-ſ]")


def _category(first: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(PLAIN_END) if unicodedata.category(chr(c))[0] == first)


_L, _N = _category("L"), _category("N")
_SHORT = "'(?:s|t|re|ve|m|ll|d)"

# The pre-tokenizer patterns of the two vocabularies, with the classes spelled out for plain
# characters and letters moved to the front, which no other branch can begin with.
BYTE_LEVEL = re.compile(rf" ?[{_L}]+|{_SHORT}| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
WORD_LEVEL = re.compile(rf"[{_L}]+|{_SHORT}|[{_N}]|[^\s{_L}{_N}]+")


@cache
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in a byte-level vocabulary: itself, or the next above 255."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def as_alphabet(pre_token: str) -> str:
    if pre_token.isascii() and pre_token.isalnum():
        return pre_token  # stand-ins of themselves
    return pre_token.encode().decode("latin-1").translate(byte_alphabet())


class Vocabulary:
    """One tokenizer file, with the pre-tokens seen lately and their ids.

    They are held in two generations: when the young one is full it becomes the old one, which goes when the
    next is full. What is asked for again moves up, so frequent pre-tokens stay.
    """

    REMEMBERED = 250_000  # pre-tokens of a generation

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.lower = self.library.normalizer is not None
        self.pattern = WORD_LEVEL if self.lower else BYTE_LEVEL
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def plain(self, text: str) -> bool:
        """True if pre_tokens gives what the library would."""
        return not NOT_PLAIN.search(text) and not any(s in text for s in self.special)

    def pre_tokens(self, text: str) -> list[str]:
        return self.pattern.findall(text.lower() if self.lower else text)

    def count_of(self, pre_token: str) -> int:
        """Number of pieces of one pre-token."""
        return len(self.library.model.tokenize(as_alphabet(pre_token)))

    def _ids_of(self, pre_token: str) -> bytes:
        ids = self._older.get(pre_token)
        if ids is None:
            tokens = self.library.model.tokenize(as_alphabet(pre_token))
            ids = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        if len(self._known) >= self.REMEMBERED:
            self._older = dict(self._known)
            self._known.clear()  # the same object, which encode() has in hand
        self._known[pre_token] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit values, special tokens not added."""
        if not self.plain(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known, make = self._known, self._ids_of
        return b"".join([known.get(p) or make(p) for p in self.pre_tokens(text)])

    def library_parts(self, text: str) -> list[str | None]:
        """Pre-tokens of any text cut by the library; None stands for a special token found in the text."""
        parts: list[str | None] = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text) if self.special else [text]:
            if part in self.special:
                parts.append(None)
            elif part:
                shown = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                cut = self.library.pre_tokenizer.pre_tokenize_str(shown)
                parts.extend(shown[a:b] for _, (a, b) in cut)
        return parts


@cache
def vocabulary(path: str) -> Vocabulary:
    """One instance per Python worker."""
    return Vocabulary(path)
