"""Runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import WORDS

from callweave.llm import periodicity
from callweave.llm.queries import QUERIES, with_repeats


def brute_runs(w, least=12):
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(least, 2 * p):
                if not any(w[start : start + length - q] == w[start + q : start + length] for q in range(1, p)):
                    out.append((start, length, p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def brute_runs_fast(w, least=12):
    """The same by one comparison of arrays per period, for longer texts."""
    ids = np.unique(np.array(w, dtype=object).astype(str), return_inverse=True)[1] if w else np.zeros(0, int)
    n, seen = len(w), set()
    for p in range(1, n // 2 + 1):
        same = np.concatenate([[0], (ids[:-p] == ids[p:]).astype(int), [0]])
        change = np.flatnonzero(np.diff(same))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            if b - a + p >= 2 * p and not any((a, b - a + p, q) in seen for q in range(1, p) if p % q == 0):
                seen.add((a, b - a + p, p))
    # of one stretch the least period counts; by Fine and Wilf all others are its multiples
    return sorted((r for r in seen if r[1] >= least), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [1, 2, 5, 12])
def test_random_sequences(least):
    rng = random.Random(least)
    for _ in range(800):
        n = rng.randint(0, 60)
        w = [rng.randrange(rng.choice([1, 2, 3, 4, 8, 30])) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        assert [tuple(r) for r in periodicity.find_runs(w, least).tolist()] == brute_runs(w, least)


def test_extensions_are_what_they_say():
    rng = random.Random(7)
    for n in (1, 2, 40, 300):
        text = [rng.randrange(2) for _ in range(n)]
        found = periodicity.Extensions(text)
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        pairs = rng.sample(pairs, min(len(pairs), 2000))
        i, j = np.array(pairs).T

        def common(a, b):
            k = 0
            while max(a, b) + k < n and text[a + k] == text[b + k]:
                k += 1
            return k

        assert found.common(i, j).tolist() == [common(a, b) for a, b in pairs]
        assert sorted(range(n + 1), key=lambda a: [x + 1 for x in text[a:]]) == np.argsort(found.rank).tolist()


def test_fibonacci_words_and_long_texts():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert [tuple(r) for r in periodicity.find_runs(b, 2).tolist()] == brute_runs(b, 2)
    assert periodicity.find_runs(["a"] * 60_000).tolist() == [[0, 60_000, 1]]
    rng = random.Random(3)
    once = [str(rng.random()) for _ in range(30_000)]
    assert periodicity.find_runs(once * 2 + once[:7]).tolist() == [[0, 60_007, 30_000]]
    assert len(periodicity.find_runs(once)) == 0


DOCS = "doc_id long, text string, runs string, N_WORDS int"


def test_odd_rows(spark):
    phrase = "one two three four "
    texts = [None, "", " \t\n", phrase * 3, phrase * 3, "x\x0by\fx y " * 5, "\x1c a " * 12, ("é" * 5000 + " ") * 12, phrase * 30_000]
    docs = spark.createDataFrame([(None if k == 4 else k, t, "z", 1) for k, t in enumerate(texts)], DOCS)
    found = periodicity.periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    for r in found.collect():
        w = WORDS.findall(r.text or "")
        want = brute_runs(w) if len(w) < 1000 else [(0, len(w), 4)]
        assert r.n_words == len(w) and [tuple(x) for x in r.runs] == want and r.collapsed == brute_collapsed(w, want)
    assert found.count() == len(texts)
    assert periodicity.periodic_runs(docs.where("false")).count() == 0


def test_query(spark, sf_dir):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op11_periodicity"](spark, sf_dir).collect()}
    assert set(got) == set(rows)
    changed = 0
    for i, text in rows.items():
        w = WORDS.findall(text or "")
        h, n = zlib.crc32(str(i).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        runs = brute_runs_fast(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        r = got[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(w, runs).encode()).hexdigest()
    assert changed


def test_repeats_of_odd_rows(spark):
    texts = [None, "", " \t ", "one", "a\x0bb c", "x y z " * 30]
    rows = [(k, t) for k in (None, *range(60)) for t in texts]
    found = with_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    got = sorted((r.doc_id is None, r.doc_id or 0, (r.text is None, r.text or "")) for r in found)

    def want(i, text):
        w, h = WORDS.findall(text or ""), zlib.crc32(b"" if i is None else str(i).encode())
        if h % 10 or not w:
            return text
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(w[k] if k < a else w[a + (k - a) % p] for k in range(n))

    assert got == sorted((i is None, i or 0, ((x := want(i, t)) is None, x or "")) for i, t in rows)
