"""Plain Python versions of the operators, row by row."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def line_dedup(rows, least_docs=3, least_chars=20):
    """rows (doc_id, text) -> [(doc_id, n_lines, n_dropped, kept text)]."""
    key = lambda line: small(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k].append(i)
    top = {}
    for k, held in holders.items():
        if len(held) >= least_docs:
            top[k] = max((rows[i][0] for i in held if rows[i][0] is not None), default=None)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in top or top[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, shingle=3):
    words = WORD.findall(small(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(prints, max_bits=3):
    """Root of each distinct fingerprint, by comparing all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                parent[root(b)] = root(a)
    return {p: root(p) for p in prints}


def components(rows, max_bits=3):
    """rows (doc_id, text) -> [(doc_id, fingerprint, component_id)]."""
    prints = [fingerprint(text) for _, text in rows]
    roots = groups(prints, max_bits)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    return [(doc_id, p, least.get(roots[p])) for (doc_id, _), p in zip(rows, prints)]


def contamination(rows, items, window=13):
    """rows (doc_id, text), items (item_id, text) -> [(doc_id, n_words, n_hit, sorted item ids as text)]."""
    owners = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(small(text))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            owners[tuple(words[i : i + window])].add(item)
    sizes = {len(w) for w in owners}
    out = []
    for doc_id, text in rows:
        words = ALNUM.findall(small(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in owners:
                    hit.update(range(i, i + n))
                    found |= owners[tuple(words[i : i + n])]
        out.append((doc_id, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def proximity(rows, items, window=13, slop=4):
    """rows (doc_id, text), items (item_id, text) -> {doc_id: windows whose two rarest words that occur in the rows
    stand within ``slop`` of their distance, at places of their own, in a text without the phrase}."""
    texts = {doc_id: ALNUM.findall(small(text)) for doc_id, text in rows}
    counts = Counter(w for words in texts.values() for w in words)
    windows = set()
    for _, text in items:
        words = ALNUM.findall(small(text))
        windows |= {tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1) if words else 0)}
    out = {}
    for doc_id, words in texts.items():
        out[doc_id] = 0
        for own in windows:
            rarest = sorted((counts[w], w, i) for i, w in enumerate(own) if counts[w])[:2]
            if len(rarest) < 2 or any(tuple(words[i : i + len(own)]) == own for i in range(len(words))):
                continue
            (_, a, i), (_, b, j) = rarest
            out[doc_id] += any(
                p != q and x == a and y == b and abs((q - j) - (p - i)) <= slop
                for p, x in enumerate(words) for q, y in enumerate(words)
            )
    return out
