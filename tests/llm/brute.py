"""Plain Python versions of the operators' contracts, for small tables."""

import collections
import hashlib
import math
import re

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    grams = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
SECRETS = [("assign", ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
           ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]


def secrets(text):
    """Counts by kind and the digest of the base spans."""
    found = [(m.start(), k, name, m.end()) for k, (name, r, ok) in enumerate(SECRETS) for m in r.finditer(text or "") if ok(m)]
    spans = [f"{name}:{a}:{b}" for a, _, name, b in sorted(found)]
    return (*[sum(s.startswith(name) for s in spans) for name, _, _ in SECRETS], sha(",".join(spans)), spans)


def luhn(s):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


PRIVATE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x[-9:]) <= 255 and not x[:-9].strip("0") for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def private(text):
    spans = [f"{k}:{m.start()}:{m.end()}" for k, p, ok in PRIVATE for m in re.finditer(p, text or "") if ok(m[0])]
    return (*[sum(s.startswith(k + ":") for s in spans) for k, _, _ in PRIVATE], sha(",".join(spans)), spans)


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(ASCII_LOWER))


def contamination(docs, items, size=13):
    """{key: (n_words, n_hit, n_items, items_sha256, contaminated)} for (key, text) pairs."""
    wins = collections.defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[k : k + size])].add(str(item))
    sizes = {len(k) for k in wins}
    out = {}
    for key, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out[key] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def substring(docs, size=13):
    """{key: (n_words, n_removed, kept_sha256)} for (key, doc_id, text)."""
    least = {}
    for _, doc_id, text in docs:
        w = words(text)
        if doc_id is not None:
            for k in range(len(w) - size + 1):
                g = tuple(w[k : k + size])
                least[g] = min(least.get(g, doc_id), doc_id)
    out = {}
    for key, doc_id, text in docs:
        w = words(text)
        gone = {j for k in range(len(w) - size + 1) if doc_id is not None and least[tuple(w[k : k + size])] < doc_id for j in range(k, k + size)}
        out[key] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_classes(texts, threshold=0.8):
    """For each text the index of the first of its class."""
    sets = []
    for text in texts:
        w = (text or "").encode().split()
        sets.append(collections.Counter([tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []))
    u = Union(len(texts))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            na, nb = sum(a.values()), sum(b.values())
            if min(na, nb) >= threshold * max(na, nb) and (common := sum((a & b).values())) >= threshold * (na + nb - common):
                u.join(i, j)
    return [u.find(k) for k in range(len(texts))]


def kept_lines(docs, threshold=0.8):
    """The kept text of each (doc_id, text), in the order given."""
    rows = [(i, line) for i, (_, text) in enumerate(docs) if text is not None for line in text.split("\n")]
    first, u, uniq = {}, Union(len(rows)), []
    index = collections.defaultdict(list)
    sets = {}
    for k, (_, line) in enumerate(rows):
        if not line:
            continue
        if line in first:
            u.join(k, first[line])
        else:
            first[line] = k
            uniq.append(k)
            sets[k] = frozenset(line[j : j + 5] for j in range(max(1, len(line) - 4)))
    common = collections.Counter(g for k in uniq for g in sets[k])
    for k in uniq:
        own = sorted(sets[k], key=lambda g: (common[g], g))
        prefix = own[: len(own) - math.ceil(threshold * len(own)) + 1]
        for j in {j for g in prefix for j in index[g]}:
            c = len(sets[j] & sets[k])
            if c >= threshold * (len(sets[j]) + len(own) - c):
                u.join(k, j)
        for g in prefix:
            index[g].append(k)
    out = [None if text is None else [] for _, text in docs]
    for k, (i, line) in enumerate(rows):
        if not line or u.find(k) == k:
            out[i].append(line)
    return [None if x is None else "\n".join(x) for x in out]


def whole_ids(texts, end):
    """Ids of whole texts by the library itself, with the end id."""
    from tokenizers import Tokenizer

    from cohortflow.llm.tokens import vocab_path

    tok = Tokenizer.from_file(vocab_path())
    return [np.array([*e.ids, end], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packing(rows, ids, capacity=2048):
    """rows: (key, piece, start, length, crc, sequence, offset); ids: {key: array}. Number of sequences."""
    import zlib

    total = collections.Counter()
    by_sequence = collections.defaultdict(list)
    for key, piece, start, length, crc, sequence, offset in rows:
        assert start == piece * capacity and crc == zlib.crc32(ids[key][start : start + length].tobytes())
        assert length == min(capacity, len(ids[key]) - start)
        total[key] += length
        by_sequence[sequence].append((offset, length))
    assert dict(total) == {k: len(v) for k, v in ids.items()}
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)
