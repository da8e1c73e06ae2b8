"""Brute-force versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    n = len(words)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update((i, i + 1, i + 2))
    repeats = len(covered)
    failed = n < 50 or 100 * repeats > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats, failed


def fingerprint(text):
    words = WORDS.findall(lower(text))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, distance=4):
    """Root place of each fingerprint."""
    a, up = np.array(prints, dtype=np.uint64), list(range(len(prints)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(a)):
        for j in np.nonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= distance)[0].tolist():
            x, y = root(i), root(i + 1 + j)
            up[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(a))]


def item_windows(items, width=10):
    owners = defaultdict(set)
    for item, text in items:
        w = ITEM_WORDS.findall(lower(text))
        for k in range(max(1, len(w) - width + 1)):
            if w[k : k + width]:
                owners[tuple(w[k : k + width])].update([] if item is None else [str(item)])
    return owners


def contamination(text, owners):
    w, covered, found = ITEM_WORDS.findall(lower(text)), set(), set()
    for size in {len(x) for x in owners}:
        for i in range(len(w) - size + 1):
            if (own := owners.get(tuple(w[i : i + size]))) is not None:
                covered.update(range(i, i + size))
                found |= own
    return len(w), sorted(covered), sorted(found)


PATTERNS = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def base_spans(text):
    out = []
    for k, (name, regex) in enumerate(PATTERNS.items()):
        for m in regex.finditer(text or ""):
            if (len(m[2]) if k == 0 else len(m[0])) >= (6, 20, 24)[k]:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def longest_first(sizes, shards):
    loads = [0] * shards
    for size in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += size
    return sorted(loads)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
