"""Plain Python versions of what the operators return."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPECIAL = "<|endoftext|>"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def luhn(d: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def secret_base(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    assign = r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    out += [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def pii_base(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    out += [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 13 <= len(only_digits(m[0])) <= 19 and luhn(only_digits(m[0]))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


def text_of_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def shingles(text: str | None) -> frozenset:
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def components(ids, links) -> dict:
    """Smallest id reachable from each."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_links(docs: dict[int, str | None]) -> list[tuple[int, int]]:
    sets = {i: shingles(t) for i, t in docs.items()}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    return [p for p, n in shared.items() if 100 * n >= 75 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
