"""Encode many texts with a byte-level tokenizer, each different chunk once.

The pattern (``public_tokenizers.PATTERN``) never matches a space inside a token unless
white space surrounds it, so a single space between two other characters always begins a new token.
Chunks between such spaces repeat far more often than texts do.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_SPACE_BEFORE, _SPACE_AFTER = re.compile(r" \s"), re.compile(r" (?<=\s )")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def chunks(text: str) -> list[str]:
    """The chunks of a text; all but the first stand for a space and the chunk."""
    odd = text[:1] == " " or text[-1:] == " " or _SPACE_BEFORE.search(text) or _SPACE_AFTER.search(text)
    return _CUT.split(text) if odd else text.split(" ")


class ChunkEncoder:
    """Texts -> bytes of ids, by a function that encodes a list of strings on their own.

    ``most`` bounds the memory of chunks kept from one batch to the next, nothing else.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 300_000):
        self.encode, self.most, self.known = encode, most, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [chunks(text) for text in texts]
        firsts = self.encode([parts[0] for parts in cut])
        if len(self.known) > self.most:
            self.known.clear()
        new = set().union(*[parts[1:] for parts in cut]) - self.known.keys()
        if new:
            new = list(new)
            self.known.update(zip(new, self.encode([" " + c for c in new])))
        known = self.known.__getitem__
        return [b"".join([first, *map(known, parts[1:])]) for first, parts in zip(firsts, cut)]
