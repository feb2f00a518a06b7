"""Cuts text into pre-tokens as a tokenizer library does.

The libraries' pattern is run by the ``regex`` module. Its tables of letters and digits may be of another
Unicode version than the library's; code points on which they differ are found once per worker by asking the
library, and stand-ins of the library's class take their places while a text that has them is cut.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

#: Below this all Unicode versions in use agree.
HIGH = regex.compile("[^\x00-˿]")


def assigned(classes: dict[str, Callable[[str], str]]) -> dict[int, str]:
    """Code point -> stand-in, where the ``regex`` module puts it into another class than ``classes`` do.

    ``classes``: pattern of a class (letters, digits, white space) -> function that keeps only its characters.
    """
    everything = "".join(chr(c) for c in range(0x300, 0x110000) if not 0xD800 <= c < 0xE000)
    stand = {r"\p{L}": "a", r"\p{N}": "0", r"\s": "\xa0"}
    own = {k: set(regex.findall(k, everything)) for k in stand}
    theirs = {k: set(classes[k](everything)) for k in stand}
    changed: set[str] = set().union(*(own[k] ^ theirs[k] for k in stand))
    return {ord(c): next((s for k, s in stand.items() if c in theirs[k]), "!") for c in changed}


class Splitter:
    """``classes`` is called when the first text with high code points comes."""

    def __init__(self, pattern: str, classes: Callable[[], dict[str, Callable[[str], str]]]):
        self.pattern = regex.compile(pattern)
        self.classes = classes
        self.table: dict[int, str] | None = None

    def __call__(self, text: str) -> list[str]:
        if not HIGH.search(text):
            return self.pattern.findall(text)
        if self.table is None:
            self.table = assigned(self.classes())
            self.odd = frozenset(map(chr, self.table))
        if self.odd.isdisjoint(text):
            return self.pattern.findall(text)
        out, at = [], 0
        for piece in self.pattern.findall(text.translate(self.table)):
            out.append(text[at : at + len(piece)])
            at += len(piece)
        return out
