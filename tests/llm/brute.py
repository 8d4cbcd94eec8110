"""Plain-Python versions of the operators' definitions, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def words(t: str | None) -> list[str]:
    return WORD.findall(t or "")


def quality(t: str | None) -> tuple:
    t = t or ""
    w = words(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k in range(len(w) - 2) if seen[tuple(w[k:k + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def quality_rejects(t: str | None) -> bool:
    t = t or ""
    n, chars, symbols, dup, covered = quality(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    lettered = sum(any(c.isalpha() for c in w) for w in words(t))
    return (n < 50 or 100 * covered > 50 * n or 10 * symbols > n or chars < 3 * n or chars > 10 * n
            or 100 * dup > 40 * len(lines) or 10 * lettered < 8 * n or 10 * sum("A" <= c <= "Z" for c in t) > 4 * chars)


def fingerprint(t: str | None) -> int:
    w = words(lower(t or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k:k + 3]) for k in range(max(len(w) - 2, 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(ids: list, fps: list[int], radius: int = 3) -> list:
    parent = list(range(len(fps)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                parent[find(a)] = find(b)
    low = defaultdict(list)
    for k, i in enumerate(ids):
        low[find(k)].append(i)
    return [min((x for x in low[find(k)] if x is not None), default=None) for k in range(len(ids))]


def contamination(t: str | None, items: list[tuple], width: int = 10) -> tuple:
    w = ITEM_WORD.findall(lower(t or ""))
    hit, found, windows = set(), set(), defaultdict(set)
    for item, text in items:
        q = ITEM_WORD.findall(lower(text or ""))
        for k in range(max(len(q) - width, 0) + 1 if q else 0):
            windows[tuple(q[k:k + width])].add(item)
    for size in {len(x) for x in windows}:
        for p in range(len(w) - size + 1):
            if tuple(w[p:p + size]) in windows:
                hit.update(range(p, p + size))
                found |= windows[tuple(w[p:p + size])]
    joined = ",".join(sorted(str(x) for x in found if x is not None))
    return (len(w), len(hit), len(found), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))


def targets(sizes: dict, weights=(5, 2, 1), most: int = 3) -> dict:
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total = sum(sizes.values())
    capped: set = set()
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else share[s] for s in names}
        capped |= over


def crc_mod(i, m: int) -> int:
    return zlib.crc32(("" if i is None else str(i)).encode()) % m


RULES = {"net/": ("net", "/", "block"), "example.net/en/": ("example.net", "/en/", "allow"),
         "example.com/de/": ("example.com", "/de/", "block"), "org/fr/": ("org", "/fr/", "allow")}


def host_path(url: str | None) -> tuple[str, str]:
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def rule(url: str | None) -> tuple:
    host, path = host_path(url)
    fit = [(len(n), n, v) for n, (h, p, v) in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def filter_audit(rows: list[tuple], labels: list[tuple]) -> dict:
    """(part, order, step) -> kept, removed, redundant, good_lost, toxic_lost, unique_fails, shapley; rows: (id, text, part)."""
    import itertools

    def fails(i, t):
        t = t or ""
        w = words(t)
        return {x for x, bad in zip("ABCDE", (
            len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
            any(c in "#$%&*|" for c in t),
            i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows))) if bad}

    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    judged = [(i, part or "", fails(i, t)) for i, t, part in rows]
    out, share = {}, Counter()
    for part in {p for _, p, _ in judged}:
        mine = [(i, f) for i, p, f in judged if p == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = mine
            for k, x in enumerate(order, 1):
                gone = [(i, f) for i, f in alive if x in f]
                alive = [(i, f) for i, f in alive if x not in f]
                share[part, x] += len(gone)
                out[part, order, k] = [len(alive), len(gone), sum(x in f for _, f in mine) - sum(x in f for _, f in gone),
                                       sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                                       sum(f == {x} for _, f in mine)]
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def source_divergence(rows: list[tuple], top: int = 200) -> list[tuple]:
    """(lang, source, part, item, value, rank); rows: (text, lang, source)."""
    docs = [(g or "", s or "", TERM.findall(lower(t or ""))) for t, g, s in rows]
    out = []
    for lang in {g for g, _, _ in docs}:
        mine = [(s, w) for g, s, w in docs if g == lang]
        seen = Counter(x for _, w in mine for x in set(w))
        kept = {x for x, n in seen.items() if n >= 3}
        total = Counter(x for _, w in mine for x in w if x in kept)
        by = {s: Counter() for s, _ in mine}
        for s, w in mine:
            by[s].update(x for x in w if x in kept)

        def scaled(c):
            return {x: 1 + 10**9 * (c[x] + 1) // (c.total() + len(kept)) for x in kept}

        p, q = {s: scaled(c) for s, c in by.items()}, scaled(total)
        for s in by:
            pairs = [(sum((p[s][x] - p[o][x]) ** 2 // p[o][x] for x in kept), o) for o in by if o != s]
            terms = [((p[s][x] - q[x]) ** 2 // q[x], x) for x in kept if by[s][x] and p[s][x] > q[x]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, x, v, k) for k, (v, x) in enumerate(found[:top] if part == "term" else found, 1)]
    return sorted(out)
