"""Tokenizing helper shared by the token-file and packing operators.

Texts are encoded by the ``tokenizers`` library. The vocabulary in use drops white space, and its
normalisation, splitting rules and merges never reach across it, so the ids of a text are the ids
of its pieces one after another (``tests/llm`` compares this with whole-text encoding). Texts are
cut at spaces and line feeds, and before a full stop or comma that follows an ASCII letter or
digit, which always begins a token. Each distinct piece is encoded once per worker; pieces are told
apart by a 64-bit hash that numpy computes for all of them at once.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np

from cohortflow.llm.word_hashes import SpanHasher

DEFAULT_VOCAB = "word_bpe_49k.json"
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def vocab_path(name: str = DEFAULT_VOCAB) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class PieceEncoder:
    """Ids of whole texts. At most ``capacity`` pieces are kept (about 50 bytes each)."""

    def __init__(self, path: str, capacity: int = 2_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.size = self.tok.get_vocab_size()
        self.capacity = capacity
        self.hasher = SpanHasher()
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.at = np.zeros(0, np.int64)  # where each key's ids begin in flat
        self.n = np.zeros(0, np.int64)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        if len(self.keys) + len(keys) > max(self.capacity, len(keys)):
            raise OverflowError
        encode = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        ids = [e.ids for e in encode(pieces, add_special_tokens=False)]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        need = self.used + int(n.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(need, len(self.flat)), np.uint32)])
        self.flat[self.used : need] = np.fromiter((i for x in ids for i in x), np.uint32, need - self.used)
        at = self.used + np.cumsum(n) - n
        self.used = need
        place = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.n = (np.insert(a, place, b) for a, b in ((self.keys, keys), (self.at, at), (self.n, n)))

    def _encode(self, docs: list[bytes]) -> list[np.ndarray]:
        raw = b"\n".join(docs) + b"\n"
        buf = np.frombuffer(raw, np.uint8)
        gap = (buf == 32) | (buf == 10)
        begin = ~gap
        begin[1:] &= gap[:-1] | (((buf[1:] == 46) | (buf[1:] == 44)) & _ALNUM[buf[:-1]])
        edge = np.flatnonzero(gap | begin)
        k = np.flatnonzero(begin[edge])
        s, e = edge[k], edge[np.minimum(k + 1, len(edge) - 1)]
        h = self.hasher.hashes(buf, s, e)
        keys, first, which = np.unique(h, return_index=True, return_inverse=True)
        for _ in range(2):
            j = np.searchsorted(self.keys, keys)
            if len(self.keys):
                new = self.keys[np.minimum(j, len(self.keys) - 1)] != keys
            else:
                new = np.ones(len(keys), bool)
            if not new.any():
                break
            try:
                self._learn(keys[new], [raw[a:b].decode() for a, b in zip(s[first[new]].tolist(), e[first[new]].tolist(), strict=True)])
            except OverflowError:
                self._forget()
                self._learn(keys, [raw[a:b].decode() for a, b in zip(s[first].tolist(), e[first].tolist(), strict=True)])
        j = np.searchsorted(self.keys, keys)
        n = self.n[j][which]
        done = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.at[j][which] - done[:-1], n) + np.arange(done[-1])]
        ends = np.cumsum([len(d) + 1 for d in docs])
        cuts = done[np.searchsorted(s, ends)]
        return np.split(ids, cuts[:-1])

    def encode(self, texts: Iterable[str | None], at_once: int = 1 << 21) -> Iterator[np.ndarray]:
        """The ids (uint32) of each text, in order; a null text has none. About ``at_once`` bytes are
        encoded at a time; longer texts are cut at a space."""
        some, size = [], 0
        for text in texts:
            b = (text or "").encode()
            if b"<|" not in b and b.isascii():
                b = b.lower()  # as the normaliser does
            if size + len(b) > at_once and some:
                yield from self._encode(some)
                some, size = [], 0
            if len(b) > at_once:
                yield np.concatenate([x for part in _parts(b, at_once) for x in self._encode([part])])
                continue
            some.append(b)
            size += len(b)
        if some:
            yield from self._encode(some)


def _parts(b: bytes, size: int) -> Iterator[bytes]:
    at = 0
    while len(b) - at > size:
        cut = b.rfind(b" ", at, at + size)
        if cut <= at and (cut := b.find(b" ", at + size)) < 0:
            break
        yield b[at:cut]
        at = cut
    yield b[at:]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
