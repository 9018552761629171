"""Plain single-process versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def op4(docs, items, window=10):
    """{(doc_id, text): (n_words, n_hit, sorted item ids)}"""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    runs = defaultdict(set)
    for item, text in items:
        words = pattern.findall(_lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            runs[tuple(words[i:i + n])].add("" if item is None else str(item))
    lengths = {len(r) for r in runs}
    out = {}
    for doc_id, text in docs:
        words = pattern.findall(_lower(text))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if (key := tuple(words[i:i + n])) in runs:
                    hit.update(range(i, i + n))
                    found |= runs[key]
        out[doc_id, text] = (len(words), len(hit), sorted(found))
    return out


def sha(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def simhash(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    if not words:
        return 0
    k = min(shingle, len(words))
    values = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def op5(docs, max_bits=4, prints=None):
    """[(doc_id, hex fingerprint, component id)] in the order of docs"""
    prints = prints or [simhash(t) for _, t in docs]
    distinct = sorted(set(prints))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    smallest = {}
    for (doc_id, _), f in zip(docs, prints):
        if doc_id is not None:
            smallest[find(f)] = min(doc_id, smallest.get(find(f), doc_id))
    return [(doc_id, f"{f:016x}", smallest.get(find(f))) for (doc_id, _), f in zip(docs, prints)]


def op8(docs, run_words=50):
    """{(doc_id, text): set of deleted line numbers}; docs in order of (id, tie)"""
    first, table = {}, {}
    for doc_id, text in docs:
        if text is None or (doc_id, text) in table:
            continue
        units = [(i, line.strip(" "), len(re.findall(r"[^\x20\x09-\x0D]+", line)))
                 for i, line in enumerate(text.split("\n"))]
        units = [u for u in units if u[2]]
        spans = set()
        for i in range(len(units)):
            total = 0
            for j in range(i, len(units)):
                total += units[j][2]
                if total >= run_words:
                    # shortest from its first line; shorten it to the shortest that ends here as well
                    spans.add((i, j))
                    a, rest = i, total
                    while rest - units[a][2] >= run_words:
                        rest -= units[a][2]
                        a += 1
                    spans.add((a, j))
                    break
            total = 0
            for a in range(i, -1, -1):
                total += units[a][2]
                if total >= run_words:
                    spans.add((a, i))
                    break
        table[doc_id, text] = (units, spans)
    for n, (units, spans) in enumerate(table.values()):
        for a, b in sorted(spans):
            key = tuple(u[1] for u in units[a:b + 1])
            first[key] = min(first.get(key, (n, a)), (n, a))
    out = {}
    for n, (row, (units, spans)) in enumerate(table.items()):
        gone = set()
        for a, b in spans:
            if first[tuple(u[1] for u in units[a:b + 1])] < (n, a):
                gone |= {u[0] for u in units[a:b + 1]}
        out[row] = gone
    return out


def op6(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(runs)
    repeated = {p for i, r in enumerate(runs) if seen[r] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), len(words) < 10 or 100 * len(repeated) > 20 * len(words))


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
