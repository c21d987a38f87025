"""Plain single-machine versions of the corpus operators, to hold results against."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash


def groups(nodes, links):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def vectors(rows, threshold=0.95):
    """{id: (links, component)} of (id, vector) rows with different ids."""
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            good[i] = x / np.linalg.norm(x)
    links = [
        (a, b) for a in good for b in good
        if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold
    ]
    count = Counter(x for pair in links for x in pair)
    root = groups([i for i, _ in rows], links)
    return {i: (count[i], root[i]) for i, _ in rows}


def repeats(docs, width):
    """{id: (bytes, removed, spans, kept)} of (id, text) rows with different ids."""
    data = {i: (t or "").encode() for i, t in docs}
    seen = Counter(d[p:p + width] for d in data.values() for p in range(len(d) - width + 1))
    out = {}
    for i, d in data.items():
        gone = np.zeros(len(d) + 1, dtype=bool)
        for p in range(len(d) - width + 1):
            if seen[d[p:p + width]] > 1:
                gone[p:p + width] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])))
        out[i] = (len(d), int(gone.sum()), len(edges) // 2, bytes(x for x, g in zip(d, gone) if not g))
    return out


def simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words)] if len(words) < 3 else [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhashes(docs, most=2):
    """{id: (hex, component)} of (id, text) rows with different ids."""
    prints = {i: simhash(t) for i, t in docs}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= most]
    root = groups(prints, links)
    return {i: (f"{prints[i]:016x}", root[i]) for i in prints}


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(max(len(words) - width, 0) + 1)}


def jaccard(left, right):
    a, b = shingles(left), shingles(right)
    return len(a & b) / len(a | b)


def warc(pages, least=0):
    """{id: (bytes, digest, type, refers_to)} of (id, html) rows with different ids."""
    by_payload = defaultdict(list)
    for i, html in pages:
        by_payload[(html or "").encode()].append(i)
    out = {}
    for payload, ids in by_payload.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        head = max(ids)
        for i in ids:
            revisit = i != head and len(payload) >= least
            out[i] = (len(payload), digest, "revisit" if revisit else "response", head if revisit else None)
    return out


def edited(docs):
    """{id: (code points, edited text, next id)} of (id, text) rows with different ids."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for (i, text), (j, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        third = len(text) // 3
        out[i] = (len(text), text[:len(text) - third] + after[:third], j)
    return out


def crc_of_ids(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def kept_lines(docs, least=20, documents=3):
    """{id: (lines, dropped, kept text)} of (id, text) rows with different ids."""
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(i)
    out = {}
    for i, text in docs:
        every = (text or "").split("\n")
        kept = [x for x in every if len(holders[key(x)]) < documents or max(holders[key(x)]) == i]
        out[i] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out


def ranking(docs, items, top=10):
    """{(item, rank): (id, score)} of (id, text) rows with different ids."""
    def words(text):
        return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text or ""))

    bags = {i: Counter(words(t)) for i, t in docs}
    bags = {i: b for i, b in bags.items() if b}
    total = sum(b.total() for b in bags.values())
    held = Counter(t for b in bags.values() for t in b)
    out = {}
    for item, text in items:
        scores = []
        for i, bag in bags.items():
            m = 100 - 90 + (90 * bag.total() * len(bags)) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * held[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in set(words(text)) if t in bag
            )
            if score > 0:
                scores.append((-score, i))
        out |= {(item, n): (i, -s) for n, (s, i) in enumerate(sorted(scores)[:top], 1)}
    return out


def alignment(texts, encode_a, spell_a, encode_b, spell_b):
    """Per text: tokens of A, of B, groups as text, links (pairs of ids)."""
    out = []
    for text in texts:
        wanted = (" " + (text or "")).encode()
        a, b = (encode_a(" " + text), encode_b(text)) if text else ([], [])
        if not text or b"".join(map(spell_a, a)) != wanted or b"".join(map(spell_b, b)) != wanted:
            out.append((0, 0, "", []))
            continue
        ends = []
        for ids, spell in ((a, spell_a), (b, spell_b)):
            at, here = 0, {}
            for place, i in enumerate(ids):
                at += len(spell(i))
                here[at] = place
            ends.append(here)
        groups, links, p, q = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            x, y = ends[0][end] + 1, ends[1][end] + 1
            groups.append(",".join(map(str, a[p:x])) + "|" + ",".join(map(str, b[q:y])))
            links.append((a[x - 1], b[y - 1]))
            p, q = x, y
        out.append((len(a), len(b), ";".join(groups), links))
    return out
