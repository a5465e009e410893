"""Words of many texts at once: where they are, and a 64-bit hash of each (numpy)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

MUL = 0x9E3779B97F4A7C15 | 1
INV = pow(MUL, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64, by doubling."""
    p = np.empty(n, np.uint64)
    p[0] = have = 1
    while have < n:
        more = min(have, n - have)
        p[have : have + more] = p[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return p


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class SpanHasher:
    """Polynomial hashes of spans of a buffer, from one running sum (modulo 2**64, so that the
    difference of two sums is exact)."""

    def __init__(self) -> None:
        self.up, self.down = powers(MUL, 1 << 16), powers(INV, 1 << 16)

    def hashes(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        if len(buf) > len(self.up):
            self.up, self.down = powers(MUL, len(buf) * 9 // 8), powers(INV, len(buf) * 9 // 8)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.up[: len(buf)], out=total[1:])
        return mixed((total[e] - total[s]) * self.down[s] + (e - s).astype(np.uint64))


@dataclass
class Words:
    """Words of some texts: ``raw[begin[i]:end[i]]``; text k has words first[k] to first[k + 1]."""

    raw: bytes
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


_HASHER: list[SpanHasher] = []


def words_of(texts: list[bytes]) -> Words:
    """Words are runs of bytes other than space and \\t\\n\\v\\f\\r."""
    if not _HASHER:
        _HASHER.append(SpanHasher())
    raw = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(raw, np.uint8)
    gap = _SPACE[buf]
    change = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edges = change if gap[0] else np.concatenate([[0], change])
    s, e = edges[0::2], edges[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    return Words(raw, s, e, _HASHER[0].hashes(buf, s, e), np.concatenate([[0], np.searchsorted(s, ends)]))


def in_parts(texts: list[str | None], at_once: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts as bytes), about ``at_once`` bytes at a time; null is empty."""
    some: list[bytes] = []
    size = first = 0
    for k, text in enumerate(texts):
        some.append((text or "").encode())
        size += len(some[-1])
        if size >= at_once:
            yield first, some
            some, size, first = [], 0, k + 1
    if some:
        yield first, some


def ngram_hashes(word_hash: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive words (one for each place but the last k - 1)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(MUL) + word_hash[j : j + n]
    return mixed(total)
