"""Plain versions of the operators, for small inputs."""

from __future__ import annotations


def shingle_set(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def groups(n, pairs):
    """The smallest index of each component."""
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard_pairs(texts, threshold=0.8):
    """All pairs of at least the threshold, by an inverted index."""
    sets, holders, pairs = [shingle_set(t) for t in texts], {}, set()
    for i, one in enumerate(sets):
        for shingle in one:
            holders.setdefault(shingle, []).append(i)
    seen = set()
    for held in holders.values():
        for x, i in enumerate(held):
            for j in held[x + 1 :]:
                seen.add((i, j))
    for i, j in seen:
        if jaccard(sets[i], sets[j]) >= threshold:
            pairs.add((i, j))
    return pairs


def base_spans(text):
    """Personal data of the four fixed kinds, with Python's own regular expressions in their plain form."""
    import re

    text, out = text or "", []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
