"""Brute-force versions of the training-data operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def repeats(rows: list[tuple[int, str | None]], length: int) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) from a table of all
    strings of ``length`` bytes."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g))))
    return out


def weighted_shingles(text: str | None, size: int = 5) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def near_classes(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, int]:
    """doc_id -> smallest doc_id of its class, from all pairs."""
    sets = {d: weighted_shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(set)
    for d, s in sets.items():
        for g in s:
            holders[g].add(d)
    for d, s in sets.items():
        for e in {e for g in s for e in holders[g] if e > d}:
            if similarity(s, sets[e]) >= threshold:
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: find(d) for d in sets}


def contaminated(docs, items, n: int = 10) -> list[tuple]:
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            wins[tuple(w[k:k + size])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in wins}:
            for p in range(len(w) - size + 1):
                if (g := tuple(w[p:p + size])) in wins:
                    hit.update(range(p, p + size))
                    found |= wins[g]
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_pii(text: str | None) -> dict[str, list[tuple[int, int]]]:
    out = {}
    for kind, rule in PII.items():
        out[kind] = []
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out[kind].append((m.start(), m.end()))
    return out


def copies(rows: list[tuple[int, str | None]]) -> list[tuple]:
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc))
    out = []
    for doc, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[norm])[1]
        out.append((doc, keep, len(groups[norm]), doc == keep, sha(norm)))
    return out


BEHIND = (1 << 63) - 1


def earlier_windows(rows, size: int) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256); a null doc_id is behind all others."""
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, w in texts:
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            least[g] = min(least.get(g, BEHIND), BEHIND if d is None else d)
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - size + 1):
            if least[tuple(w[i:i + size])] < (BEHIND if d is None else d):
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def trie(rows) -> list[tuple]:
    """Nodes of the trie of rebuilt conversations, from all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, role, sha(f"{len(role.encode())}:{role}{text}"), text))
    own = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = (*own.get(c - int(math.fmod(c, 100)), [])[:h], *turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children.update(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1]) if path else 0
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
             sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items()]


def runs(words: list, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, period by period."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i + q < len(words) and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                part = words[start:i + q]
                if len(part) >= max(least, 2 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.append((start, len(part), q))
                start = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc, text: str | None, edited: bool = True) -> tuple:
    w = (text or "").encode().split()
    if edited and doc is not None and w:
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return (doc, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))
