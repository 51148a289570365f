"""Plain versions of the operators, one text or one pair at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
_TOKENIZERS: dict = {}


def ids(name, text):
    if name not in _TOKENIZERS:
        _TOKENIZERS[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _TOKENIZERS[name].encode(text or "", add_special_tokens=False).ids


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def fingerprint(text, n=3):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=2):
    """{id: fingerprint} -> {id: smallest id reachable}."""
    label = {i: i for i in prints}
    keys = sorted(prints)
    changed = True
    links = [(a, b) for k, a in enumerate(keys) for b in keys[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= radius]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def shingle_components(texts, n=5, least=0.8):
    """Of each text the first one that links of this similarity reach."""
    sets = [{tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if (w := (t or "").lower().split()) else set() for t in texts]
    label = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dups = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = set()
    for k in range(len(words) - 7):
        if windows[tuple(words[k : k + 8])] > 1:
            hit.update(range(k, k + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit), n < 20 or 100 * len(hit) > 30 * n)


BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def contamination(text, items, window=10):
    words, hit, names = bench_words(text), set(), set()
    where = {}
    for n in {min(window, len(bench_words(t))) for _, t in items}:
        for k in range(len(words) - n + 1):
            where.setdefault(tuple(words[k : k + n]), []).append(k)
    for i, t in items:
        own = bench_words(t)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            w = tuple(own[k : k + window])
            for at in where.get(w, ()):
                hit.update(range(at, at + len(w)))
                if i is not None:
                    names.add(str(i))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


def lm(texts, order=3, backoff=0.4, least=1):
    docs = [[w for w in WORD.findall((t or "").translate(LOWER))] for t in texts]
    counts = Counter(tuple(d[k - n + 1 : k + 1]) for d in docs for n in range(1, order + 1) for k in range(n - 1, len(d)))
    total = sum(map(len, docs))

    def value(d, k, n):
        if n == 1:
            return counts[(d[k],)] / total
        if k - n + 1 < 0:
            return value(d, k, n - 1)
        gram = tuple(d[k - n + 1 : k + 1])
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= least else backoff * value(d, k, n - 1)

    return [math.fsum(math.log(value(d, k, order)) for k in range(len(d))) for d in docs]


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def url(u, strict, soft, needed=2):
    host = path = ""
    if u and "://" in u:
        rest = u.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = m[1].translate(LOWER), m[2]
    best = None
    for verdict, text in RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[1])):
            best = (verdict, text)
    if best:
        return host, path, best[1], best[0]
    low = (u or "").translate(LOWER)
    found = lambda w: re.search(rf"(?<![^\W_]){re.escape(w)}(?![^\W_])", low)
    bad = any(found(w) for w in strict) or sum(1 for w in soft if found(w)) >= needed
    return host, path, None, "block" if bad else "allow"
