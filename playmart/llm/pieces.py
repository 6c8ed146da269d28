"""Texts cut into pieces whose token ids don't depend on each other, each distinct piece encoded once.

A byte-level pre-token takes at most one blank, in front, so a text may be cut
before every blank that is not inside a longer run of white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import regex

from .common import slices

#: The pattern that splits a text before merging.
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
              r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: A blank inside or at the end of a longer run of white space: the text isn't cut at blanks then.
UNSAFE_BLANK = re.compile(r"\s (?:\s|\Z)")
#: Texts are worked on in slices of about so many characters, to bound memory.
SLICE_CHARS = 6_000_000
#: Pieces remembered by a worker; those unused for long are encoded again, so the bound changes no result.
CACHE = 300_000


class Pieces(dict):
    """piece -> ids, in two generations: pieces unused for a whole generation are let go."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = self.old[piece]
        return ids

    def has(self, piece: str) -> bool:
        return piece in self or piece in self.old

    def age(self) -> None:
        if len(self) > self.most // 2:
            self.old = dict(self)
            self.clear()


class PieceEncoder:
    """Base of the encoders: ``encode_new`` gives the ids of pieces not met before."""

    def __init__(self, special: list[str]):
        self.pieces = Pieces(CACHE)
        self.split = regex.compile(PRE_TOKENS)
        self.special = set(special)
        self.special_pattern = (re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
                                if special else None)

    def forget(self) -> None:
        """Let go of the remembered pieces."""
        self.pieces = Pieces(CACHE)

    def encode_new(self, pieces: list[str]) -> Iterable[tuple[str, bytes]]:
        raise NotImplementedError

    def segments(self, text: str) -> list[str]:
        """The text in pieces whose encodings don't depend on each other; joined they give the text."""
        if UNSAFE_BLANK.search(text):
            return self.split.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def cut(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.segments(text)
        return [y for x in self.special_pattern.split(text) for y in ([x] if x in self.special else self.segments(x))]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        for a, b in slices([len(t) for t in texts], SLICE_CHARS):
            cut = [self.cut(t) for t in texts[a:b]]
            self.pieces.age()
            self.pieces.update(self.encode_new([p for p in set(chain.from_iterable(cut)) if not self.pieces.has(p)]))
            for pieces in cut:
                yield b"".join(map(self.pieces.__getitem__, pieces))
