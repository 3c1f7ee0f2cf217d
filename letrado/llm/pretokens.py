"""Splitting text into pieces that byte-level BPE handles independently.

The public GPT-2 style pattern attaches one leading blank to the token after
it.  A single blank between two non-space characters is therefore always a
token boundary, so a text can be cut there first and the (slow) pattern needs
to run only on pieces that were not seen before.
"""

from __future__ import annotations

import re
from functools import lru_cache

import regex

_ODD_BLANK = re.compile(r" \s|[^\S ] ")          # a blank beside other white space
_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")


def split_pieces(text: str) -> list[str]:
    """Cut ``text`` at every blank between two non-space characters.

    The blank is dropped: all pieces but the first stand for ``" " + piece``.
    The empty text gives no piece.
    """
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or _ODD_BLANK.search(text):
        return _SAFE_BLANK.split(text)
    return text.split(" ")


class RecentCache:
    """Key -> value for the keys of recent batches, bounded in bytes.

    ``encode`` takes a list of distinct strings and returns one value each.  When
    the entries may exceed ``limit`` bytes, all go but those of the current
    batch: frequent keys stand in every batch, so they stay.  Keys over
    ``longest`` characters (a text without a blank is one) are never kept.
    """

    #: bounds of an entry's bytes: its two objects and its share of the dict, and what a character can add to key and value
    ENTRY, CHARACTER = 300, 20

    def __init__(self, encode, limit: int = 96 << 20, longest: int = 64):
        self.encode, self.limit, self.longest = encode, limit, longest
        self.held: dict = {}
        self.size = 0
        self.long: list = []

    def fill(self, wanted: set) -> dict:
        """Values of all ``wanted`` keys (and perhaps of others)."""
        # not a difference of sets: that would walk the whole cache
        new = [k for k in wanted if k not in self.held]
        if new:
            self.held.update(zip(new, self.encode(new)))
            self.size += self._bytes(new)
            self.long += [k for k in new if len(k) > self.longest]
        return self.held

    def settle(self, wanted: set) -> None:
        """To be called when the values of a batch have been used."""
        for k in self.long:
            del self.held[k]
        self.size -= self._bytes(self.long)
        self.long = []
        if self.size > self.limit:
            kept = [k for k in wanted if k in self.held]
            size = self._bytes(kept)
            self.held, self.size = ({k: self.held[k] for k in kept}, size) if size <= self.limit else ({}, 0)

    def _bytes(self, keys: list) -> int:
        return self.ENTRY * len(keys) + self.CHARACTER * sum(map(len, keys))


class PieceCache:
    """Texts -> encoded values of their pieces; pieces of recent batches are remembered (``RecentCache``)."""

    def __init__(self, encode, limit: int = 96 << 20):
        self.first = RecentCache(encode, limit // 4)
        self.inner = RecentCache(lambda pieces: encode([" " + p for p in pieces]), limit)

    def lookup(self, texts: list[str]) -> list[list]:
        """For each text the encoded values of its pieces, in order."""
        cut = [split_pieces(t) for t in texts]
        starts, pieces = {c[0] for c in cut if c}, set().union(*[c[1:] for c in cut])
        first, inner = self.first.fill(starts), self.inner.fill(pieces)
        out = []
        for c in cut:
            values = list(map(inner.__getitem__, c[1:]))
            if c:
                values.insert(0, first[c[0]])
            out.append(values)
        self.first.settle(starts)
        self.inner.settle(pieces)
        return out


#: letters below this code point are written out as ranges; a text of such characters is cut by the ``re`` module
LATIN_END = 0x250
BEYOND_LATIN = re.compile(f"[^\\x00-\\u{LATIN_END - 1:04x}]")


@lru_cache(maxsize=1)
def _latin_pattern():
    """The public pattern with its classes written out for code points below LATIN_END: ``re`` knows no ``\\p{L}``,
    but runs twice as fast as ``regex``."""
    def members(kind: str) -> str:
        return "".join(f"\\u{c:04x}" for c in range(LATIN_END) if regex.match(kind, chr(c)))
    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      rf"|[{space}]+(?![^{space}])|[{space}]+")


def latin_tokens(text: str) -> list[str] | None:
    """The pre-tokens of a text of Latin characters; None for any other."""
    return None if BEYOND_LATIN.search(text) else _latin_pattern().findall(text)


class TokenCache:
    """Texts -> encoded values of their pre-tokens; pre-tokens of recent batches are remembered.

    ``cut`` gives the pre-tokens of one text, ``encode`` one value for each of a list of distinct ones.
    """

    def __init__(self, cut, encode, limit: int = 96 << 20):
        self.cut, self.known = cut, RecentCache(encode, limit)

    def lookup(self, texts: list[str]) -> list[list]:
        """For each text the encoded values of its pre-tokens, in order."""
        cut = list(map(self.cut, texts))
        wanted = set().union(*cut)
        values = self.known.fill(wanted)
        out = [list(map(values.__getitem__, c)) for c in cut]
        self.known.settle(wanted)
        return out


def compiled(pattern: str):
    return regex.compile(pattern)
