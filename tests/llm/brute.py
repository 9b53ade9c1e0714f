"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

ODD_TEXTS = [
    None,
    "",
    "   \t\n ",
    "A.",
    "one two",
    "same words here and there again and again",
    "same words here and there again and again",
    "ünï çødé 日本語 \U0001d4b3 x",
    "nul \x00 byte\x1f and \x7f",
    "tab\tand\vvertical\fform\rfeed\nline",
    "x" * 5000,
    "word " * 3000,
]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(nodes: list[int], links: list[tuple[int, int]]) -> dict[int, int]:
    root = {n: n for n in nodes}

    def top(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text: str | None, size: int) -> set:
    w = spaced(lowered(text))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def similar(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {d: shingles(t, size) for d, t in rows}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    comp = components(ids, links)
    return {d: (len(sets[d]), comp[d]) for d in ids}


def contamination(rows: list[tuple[int, str | None]], items: list[tuple[int, str | None]]) -> dict[int, tuple]:
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    wins: dict[tuple, set] = {}
    for i, t in items:
        w = find(lowered(t))
        for k in range(max(len(w) - 12, 1 if w else 0)):
            wins.setdefault(tuple(w[k : k + 13]), set()).add(i)
    out = {}
    for d, t in rows:
        w = find(lowered(t))
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for k in range(len(w) - size + 1):
                if own := wins.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    found |= own
        out[d] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def deduplicated(rows: list[tuple[int, str | None]], width: int = 50) -> dict[int, tuple]:
    least: dict[tuple, int] = {}
    words = {d: spaced(t) for d, t in sorted(rows)}
    for d, w in words.items():
        for k in range(len(w) - width + 1):
            least.setdefault(tuple(w[k : k + width]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for k in range(len(w) - width + 1):
            if least[tuple(w[k : k + width])] < d:
                gone |= set(range(k, k + width))
        out[d] = (len(w), len(gone), sha(" ".join(p for k, p in enumerate(w) if k not in gone)))
    return out


SECRETS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def secrets(text: str | None) -> str:
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        found += [(m.start(), place, kind, m.end()) for m in re.finditer(pattern, text or "", re.ASCII) if len(m[group]) >= least]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))
