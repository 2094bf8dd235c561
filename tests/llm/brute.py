"""The operators in plain Python, row by row, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import xxhash

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode())


def passages(docs, window):
    """Per row: words, removed words, digest of the kept words."""
    first = {}
    order = lambda d: -math.inf if d is None else d
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, math.inf), order(doc))
    out = []
    for doc, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < order(doc):
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def lines(docs, least=10):
    """Per row: lines, dropped lines, digest of the kept lines."""
    order = lambda d: -math.inf if d is None else d
    strip = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            holders[strip(line)].add(order(doc))
    out = []
    for doc, text in docs:
        all_lines = (text or "").split("\n")
        kept = [
            x
            for x in all_lines
            if len(strip(x)) < least or len(holders[strip(x)]) < 2 or min(holders[strip(x)]) == order(doc)
        ]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept))))
    return out


def contamination(docs, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = pattern.findall(lower(text))
        size = min(window, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = pattern.findall(lower(text))
        hit, found = set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def simhash(text, size=4):
    w = lower(text).encode().split()
    shingles = [b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else []
    if w and not shingles:
        shingles = [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """Smallest reachable id of every (id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least[root(i)] = min(doc, least.get(root(i), doc))
    return [least[root(i)] for i in range(len(prints))]


def quality(text):
    w = words(text)
    rows = [x for x in (text or "").split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(rows) - len(set(rows)), len(inside), failed


class ContextTree:
    """Context-tree weighting by its recursive definition."""

    def __init__(self, texts, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.children = defaultdict(list)
        for text in texts:
            for context, byte in self.symbols(text):
                for node, bit in self.bits(byte):
                    for d in range(depth + 1):
                        self.counts[context[:d], node][bit] += 1
        for context, node in self.counts:
            if context:
                self.children[context[:-1], node].append((context, node))
        self.weighted = lru_cache(None)(self._weighted)

    def symbols(self, text):
        body = b" ".join(w.encode() for w in words(lower(text))) + b"\xff"
        padded = b"\xff" * self.depth + body
        for i, byte in enumerate(body):
            yield padded[i : i + self.depth][::-1], byte

    @staticmethod
    def bits(byte):
        for k in range(8):
            yield (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1

    def own(self, s):
        a, b = self.counts[s]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def _weighted(self, s):
        own = self.own(s)
        if len(s[0]) == self.depth:
            return own
        deeper = sum(self.weighted(c) for c in self.children[s])
        top = max(own, deeper)
        return top + math.log(math.exp(own - top) + math.exp(deeper - top)) - math.log(2)

    def log10(self, text):
        total = 0.0
        for context, byte in self.symbols(text):
            for node, bit in self.bits(byte):
                chance = None
                for d in range(self.depth, -1, -1):
                    s = context[:d], node
                    if s in self.counts:
                        own = (self.counts[s][bit] + 0.5) / (sum(self.counts[s]) + 1)
                        weight = 1 if d == self.depth else math.exp(self.own(s) - math.log(2) - self.weighted(s))
                        chance = weight * own + (1 - weight) * (own if chance is None else chance)
                total += math.log10(0.5 if chance is None else chance)
        return total


def unigram(docs, learned):
    counts = Counter()
    for doc, text in docs:
        if learned(doc):
            counts.update(words(lower(text)))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for _, text in docs:
        tokens = [*words(lower(text)), None]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((len(tokens), sum(counts[t] > 0 for t in tokens), n, base))
    return out
