"""Encoding of texts piece by piece with a cache.

A single space between two characters that are not white space is a place that no match of the pre-token
pattern crosses: the space belongs to the match after it.  So a text may be cut there, and every piece is
encoded once per worker for as long as the cache holds it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import islice

CUT = re.compile(r"(?<=\S) (?=\S)")
ENTRIES = 800_000  # pieces that a cache holds before it is cut back
KEPT = 250_000  # pieces that are left then: the first that came, so the frequent ones
LONGEST = 64  # characters of a piece that is worth keeping


class Pieces:
    """Encode whole texts as the concatenation of what their pieces give.

    `encode` takes pieces as they stand in a text and gives the bytes for each.  The cache holds pieces
    that follow a space, without that space; none of them is empty or has white space at an end.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.known = encode, {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Encoded texts, in order."""
        heads, tails, new = [], [], set()
        for text in texts:
            head, space, rest = text.partition(" ")
            heads.append(head)
            tails.append(rest.split(" ") if space else [])
            new.update(set(tails[-1]).difference(self.known))
        odd = {x for x in new if not x or x[0].isspace() or x[-1].isspace()}
        plain = [not head[-1:].isspace() and (not odd or odd.isdisjoint(tail)) for head, tail in zip(heads, tails)]
        if len(self.known) + len(new) > ENTRIES:
            self.trim()
            new = {x for tail in tails for x in tail}.difference(self.known)
        missing = list(new - odd)
        self.known.update(zip(missing, self.encode([" " + x for x in missing])))
        out = [head + b"".join(map(self.known.__getitem__, tail)) if ok else self._odd(text)
               for text, tail, head, ok in zip(texts, tails, self.encode(heads), plain)]
        for x in missing:
            if len(x) > LONGEST:
                del self.known[x]
        return out

    def trim(self) -> None:
        """Cut the cache back; a worker that goes idle holds no more than that."""
        if len(self.known) > KEPT:
            self.known = dict(islice(self.known.items(), KEPT))

    def _odd(self, text: str) -> bytes:
        """A text with white space beside a space: only its safe places are cut."""
        first, *rest = CUT.split(text)
        return b"".join(self.encode([first, *[" " + x for x in rest]]))
