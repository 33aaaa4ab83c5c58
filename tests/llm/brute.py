"""Plain, slow forms of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import xxhash

WORD10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


def simhash(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(rows, max_bits=3):
    prints = {i: simhash(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= max_bits]
    root = components(prints, links)
    return {i: (f"{prints[i]:016x}", root[i]) for i in prints}


def contamination(rows, items, window=10):
    windows = {}
    for item, text in items:
        words = WORD10.findall(ascii_lower(text or ""))
        for k in range(max(1, len(words) - window + 1)):
            if words:
                windows.setdefault(tuple(words[k : k + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in rows:
        words = WORD10.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                w = tuple(words[k : k + n])
                if w in windows:
                    hit.update(range(k, k + n))
                    found |= windows[w]
        out[i] = (len(words), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit))
    return out


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    found = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), rank, kind, m.end()))
    return sorted(found)


def pii_row(text):
    found = pii(text)
    counts = [sum(f[2] == k for f in found) for k in PII]
    return (*counts, sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in found)))
