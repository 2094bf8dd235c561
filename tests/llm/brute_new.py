"""Hard negatives, secret patterns and token alignment in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict


def hard_negatives(rows, positives=5, negatives=3):
    """(vec_id, vector, label) rows; whole-number scores with Python's own integers."""
    sound = []
    for vec, vector, label in rows:
        if vec is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        if sum(x * x for x in whole) < 9.2e18:
            sound.append((vec, whole, (label + 1) % 10 if vec % 7 == 0 else label))
    out = []
    for i, (anchor, a, label) in enumerate(sound):
        if anchor % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a, v, strict=False)), vec, own == label)
            for j, (vec, v, own) in enumerate(sound)
            if j != i
        ]
        for minus, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted(s for s in scored if not s[2] and 50 * -minus <= 100 * -s[0] <= 95 * -minus)
            for rank, (other, negative, _) in enumerate(fit[:negatives], 1):
                out.append((anchor, positive, rank, negative, -minus, -other))
    return out


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)


def base_spans(text):
    """(start, kind, end) of the three patterns, kinds by their place in the list."""
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def written(spans, kinds=("assign", "access", "hex", "cnn")):
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)


def alignment(docs, encode_a, encode_b, a_bytes, b_bytes):
    """Per row: n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    links, each = Counter(), []
    for _, text in docs:
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            each.append(None)
            continue
        stops = {}
        at = 0
        for k, i in enumerate(b):
            at += len(b_bytes[i])
            stops[at] = k
        own, groups, at, done_a, done_b = [], [], 0, 0, 0
        for k, i in enumerate(a):
            at += len(a_bytes[i])
            if at in stops:
                j = stops[at]
                groups.append(",".join(map(str, a[done_a : k + 1])) + "|" + ",".join(map(str, b[done_b : j + 1])))
                own.append((i, b[j]))
                done_a, done_b = k + 1, j + 1
        links.update(own)
        each.append((len(a), len(b), groups, own))
    best = defaultdict(int)
    for (_, b), n in links.items():
        best[b] = max(best[b], n)
    out = []
    for found in each:
        if found is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, own = found
        counts = [links[x] for x in own]
        n_best = sum(n == best[b] for n, (_, b) in zip(counts, own, strict=True))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(own), n_best, sum(counts), digest))
    return out
