"""Word shingles of whole texts as 64-bit hashes, and their circulant MinHash signatures, by arrays.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z become lower case. A text's set has the hashes of its runs of
``WIDTH`` words; of a text of fewer words, but not none, the hash of all of them. Hashes are compared instead of
words: two unlike shingles of ordinary texts are taken for one with a chance of about 2 to the power -64. Words up to
``LONG`` bytes are hashed by a polynomial modulo 2 to the 64, for which someone who sets out to can make
words that collide; the known way to do so needs longer words, and these are hashed by blake2b.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np

from tributary.llm.worker import held

WIDTH = 5
LONG = 256
#: Bytes of text that are hashed together; what is made on the way takes some 60 times as much.
TOGETHER = 250_000

U = np.uint64
BASE = 0x9E3779B97F4A7C15
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every bit depends on every bit."""
    x = x ^ (x >> U(33))
    x = x * U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U(33))
    x = x * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd number and of its inverse, modulo 2 to the 64."""
    back = pow(BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([[U(1)], np.full(n, BASE, U)]), dtype=U)
        down = np.cumprod(np.concatenate([[U(1)], np.full(n, back, U)]), dtype=U)
    return up, down


#: Odd numbers, one for each place of a word in its shingle.
PLACES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], U)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The words' hashes and the places of their first bytes."""
    raw = np.frombuffer(data, np.uint8)
    word = np.concatenate([[False], ~SPACES[raw], [False]])
    edge = np.flatnonzero(word[1:] != word[:-1])
    start, end = edge[::2], edge[1::2]
    size = 1 << max(16, int(len(raw)).bit_length())
    up, down = powers(size)
    sums = np.concatenate([[U(0)], np.cumsum((raw.astype(U) + U(1)) * up[: len(raw)], dtype=U)])
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(U))
    for i in np.flatnonzero(end - start > LONG):
        hashes[i] = int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little")
    return hashes, start


def shingle_sets(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text the sorted, distinct hashes of its shingles."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode().lower()  # bytes: only A-Z are lowered
        if group and size + len(data) > TOGETHER:
            yield from together(group)
            group, size = [], 0
        group.append(data)
        size += len(data) + 1
    if group:
        yield from together(group)


def together(group: list[bytes]) -> Iterator[np.ndarray]:
    words, start = word_hashes(b" ".join(group))
    ends = np.cumsum([len(x) + 1 for x in group])
    last = np.searchsorted(start, ends)
    n = max(0, len(words) - WIDTH + 1)
    total = np.zeros(n, U)
    for k in range(WIDTH):
        total += words[k : k + n] * PLACES[k]
    total = mixed(total + U(WIDTH))
    begin = 0
    for end in last.tolist():
        if end - begin >= WIDTH:
            yield np.unique(total[begin : end - WIDTH + 1])
        elif end > begin:
            yield mixed((words[begin:end] * PLACES[: end - begin]).sum(keepdims=True, dtype=U) + U(end - begin))
        else:
            yield np.zeros(0, U)
        begin = end


class Circulant:
    """Signatures from two permutations of a universe of 2 to the ``bits``: one deals the hashes out, the other ranks.

    Coordinate ``k`` is the least rank after the second permutation is shifted round by ``k``; all coordinates of
    an element are neighbours in its table. Hashes that meet in the universe count as one, which can only make
    two sets look more alike.
    """

    def __init__(self, coordinates: int, bits: int = 22, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.shift = U(64 - bits)
        self.deal = rng.permutation(1 << bits).astype(np.uint32)
        rank = rng.permutation(1 << bits).astype(np.uint32)
        self.windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([rank, rank[: coordinates - 1]]), coordinates)

    def sign(self, hashes: np.ndarray, step: int = 2_048) -> np.ndarray:
        places = self.deal[hashes >> self.shift]
        least = self.windows[places[:step]].min(axis=0)
        for i in range(step, len(places), step):
            np.minimum(least, self.windows[places[i : i + step]].min(axis=0), out=least)
        return least


def circulant(coordinates: int) -> Circulant:
    """One per worker, until it goes on to what needs none."""
    return held(Circulant, coordinates)
