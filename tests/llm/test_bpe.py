"""BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.llm import bpe
from callweave.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(bpe.default_tokenizer())
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(None)


def ids(encoded):
    return [np.frombuffer(x, "<i4").tolist() for x in encoded]


PARTS = [
    "a", "the", "in", "ing", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", ".", "!!", "é", "ß", "中", "🙂", "\x1c", "\x85", "\u2028",
    "<|endoftext|>", "<|endof", "\t", "th", "on", "x" * 50, "aaaa", "zq", "\0", "\ufffd",
]


def test_random_texts(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, "".join(rng.choices("abcdefgh", k=20000)), "", " " * 300, "=-" * 200]
    assert ids(own.encode(texts)) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_signs_next_to_each_other(own, library):
    signs = [chr(c) for c in [*range(0x3000), *range(0xFE00, 0x10400, 3), *range(0x1F300, 0x1F700, 5)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1 {c}{c}b  {c}.{c} \n" for c in signs]
    assert ids(own.encode(texts)) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_side_by_side_and_heap_agree(own):
    rng = random.Random(2)
    words = ["".join(rng.choices("aeinst rhl", k=rng.randint(1, 40))).encode() for _ in range(2000)]
    exact = [own.merges.exact(w) for w in words]
    assert ids(own.merges.exact_many(words)) == exact == ids(own.merges.encode_words(words))


def test_pairs_hold_exactly_if_merging_leaves_them(own):
    rng = random.Random(3)
    table = own.merges
    pairs = []
    for i in rng.sample(sorted(i for i, b in table.bytes_of.items() if len(b) > 1), 3000):
        word = table.bytes_of[i] + table.bytes_of[rng.randrange(40000)][:2]
        cut = rng.randrange(1, len(word))
        pairs.append((table.exact(word[:cut])[-1], table.exact(word[cut:])[0]))
    a, b = np.array(pairs).T
    want = [table.exact(table.bytes_of[x] + table.bytes_of[y]) == [x, y] for x, y in pairs]
    assert table.compatible(a, b).tolist() == want
    assert 0 < sum(want) < len(want)


def test_kept_pieces_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 50)
    small = bpe.Encoder(bpe.default_tokenizer())
    rng = random.Random(4)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcde", k=4)) for _ in range(30)) + " y" * 90 + "z" * 100 for _ in range(3)]
        assert ids(small.encode(texts)) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
        assert len(small.kept) <= 50 + 93


def test_odd_rows(spark, library):
    texts = [None, "", "<|endoftext|>", "same", "same", "word " * 60_000, "é🙂" * 40_000]
    docs = spark.createDataFrame([(None if k == 3 else k, t, [9]) for k, t in enumerate(texts)], "doc_id long, text string, IDS array<int>")
    rows = bpe.decode(bpe.encode(docs), out="back").orderBy(F.col("doc_id").asc_nulls_first()).collect()
    got = sorted((r.text or "", r.ids, r.back) for r in rows)
    assert got == sorted((t or "", library.encode(t or "", add_special_tokens=False).ids, t or "") for t in texts)
    assert bpe.encode(docs.where("false")).columns == ["doc_id", "text", "ids"]
    assert bpe.decode(bpe.encode(docs.where("false"))).count() == 0
    both = bpe.round_trip(docs)
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted((r.text or "", r.ids, r.decoded) for r in both.collect()) == got


def test_decoding_as_the_library_does(spark, library):
    rng = random.Random(5)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 40))] for _ in range(200)] + [[50256, 188, 50256], [], None, [99999, 5]]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, ids array<int>")
    for r in bpe.decode(docs).collect():
        assert r.text == library.decode([i for i in lists[r.k] or [] if i < 50257], skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        bpe.Merges(public_tokenizers.path("word_bpe_49k.json"))


def test_query(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_bpe"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        want = library.encode(text, add_special_tokens=False).ids
        back = library.decode(want, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest(),
        )
