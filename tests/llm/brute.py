"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def raw(text):
    return (text or "").encode()


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in raw(text))


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shingle_set(text, size):
    words = lowered(text).split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def components(rows, size, percent):
    """``{id: (set size, smallest id reachable)}``"""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def earlier_words(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = raw(text).split()
        gone = [False] * len(words)
        for at in range(len(words) - length + 1):
            key = tuple(words[at:at + length])
            if key in seen:
                gone[at:at + length] = [True] * length
            seen.add(key)
        kept = [w for w, g in zip(words, gone) if not g]
        out[i] = (len(words), sum(gone), digest(b" ".join(kept)))
    return out


def repeated_bytes(rows, length):
    count = Counter(raw(t)[k:k + length] for _, t in rows for k in range(len(raw(t)) - length + 1))
    out = {}
    for i, text in rows:
        data = raw(text)
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if count[data[k:k + length]] > 1:
                mark[k:k + length] = b"\x01" * length
        kept = bytes(b for b, m in zip(data, mark) if not m)
        out[i] = (len(data), sum(mark), len(re.findall(b"\x01+", bytes(mark))), digest(kept))
    return out


def leaks(rows, items, window):
    owners = defaultdict(set)
    for name, text in items:
        words = WORDS.findall(lowered(text))
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            owners[tuple(words[at:at + size])].add(name)
    out = {}
    for i, text in rows:
        words = WORDS.findall(lowered(text))
        hit, found = [0] * len(words), set()
        for size in {len(k) for k in owners}:
            for at in range(len(words) - size + 1):
                own = owners.get(tuple(words[at:at + size]))
                if own:
                    found |= own
                    hit[at:at + size] = [1] * size
        names = sorted({str(x) for x in found if x is not None})
        out[i] = (len(words), sum(hit), len(names), digest(",".join(names).encode()), any(hit))
    return out


def base_counts(text):
    words = raw(text).split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    twice = [0] * len(words)
    for i in range(len(words) - 2):
        if windows[tuple(words[i:i + 3])] > 1:
            twice[i:i + 3] = [1] * 3
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), sum(twice))


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _only(value):
    return re.sub("[^0-9]", "", value)


RULES = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(_only(v)) <= 19 and _luhn(_only(v))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(_only(v)) <= 15),
}


def base_spans(text):
    return [f"{kind}:{m.start()}:{m.end()}" for kind, (rule, good) in RULES.items()
            for m in re.finditer(rule, text or "") if good(m[0])]


def redacted(text, spans):
    """``spans`` (start, stop, kind) in order; a span that starts inside an earlier one only lengthens it."""
    out, at = [], 0
    for start, stop, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, stop)
    return "".join(out) + text[at:]
