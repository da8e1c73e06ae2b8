"""Benchmark decontamination with an FM-index per training shard.

A task collects documents into shards of a bounded number of words. The shard's words become
numbers of the benchmark's vocabulary; a word outside it ends a segment, since no window can
cross it, and segments too short for any window are left out. Over the segments an
FM-index is built: suffix array, Burrows-Wheeler transform in a wavelet tree, suffix positions
sampled every ``rate`` words and at segment starts. All windows of the benchmark are searched
backwards at once, their occurrences located by walking to a sampled position, and the
covered words merged into removal spans.

Benchmarks larger than ``max_block_words`` are taken in blocks, one pass over the documents
each, whose spans and items are merged; so what is broadcast is bounded.

Defined cases: null and empty texts have no words and no hits; null or wordless items
have no windows; items with a null id cover words but are not listed; repeated items with one id
count once; empty tables on either side give no hits. All input columns stay in ``doc``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import repeat
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import released, stored

#: Bytes to lower case, and every byte that is no part of a word to a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def word_list(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def benchmark_windows(items: list[tuple[str | None, str | None]], width: int) -> SimpleNamespace:
    """The distinct windows of some benchmark items as numbers of their vocabulary: ``vocabulary``,
    ``owners`` (ids of each window's items), ``lengths``, ``shortest``, and ``words``, right-aligned
    with 0 before the first word of a short window."""
    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in word_list(text)]
        for i in range(max(1, len(ids) - width + 1)):
            if window := tuple(ids[i : i + width]):
                owners.setdefault(window, set()).update([] if item is None else [item])
    lengths = np.array([len(w) for w in owners], dtype=np.int64)
    words = np.zeros((len(owners), width), dtype=np.int64)
    for k, w in enumerate(owners):
        words[k, width - len(w) :] = w
    return SimpleNamespace(
        vocabulary=vocabulary, owners=[sorted(x) for x in owners.values()], lengths=lengths,
        shortest=int(lengths.min()) if owners else 0, words=words,
    )


def suffix_array(stream: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; zeros end a segment and sort by place."""
    n = len(stream)
    ends = stream == 0
    rank = np.where(ends, np.cumsum(ends) - 1, stream + ends.sum())
    step = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:] + 1 if step < n else 0
        key = rank * (int(rank.max()) + 2 if step == 1 else n + 1) + after if step < n else rank
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletTree:
    """Symbols level by level, highest bit first, zeros before ones in the next level."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones, self.zeros, self.bits = [], [], []
        now = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            self.bits.append(bit)
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(len(now) - int(bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))
        self.start = self._down(np.arange(top + 1), np.zeros(top + 1, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            one = self.ones[k][at]
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, self.zeros[k] + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._down(symbol, at) - self.start[symbol]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbol = np.zeros(len(at), dtype=np.int64)
        for k in range(self.levels):
            bit, one = self.bits[k][at], self.ones[k][at]
            at = np.where(bit, self.zeros[k] + one, at - one)
            symbol = symbol * 2 + bit
        return symbol, at - self.start[symbol]


class FMIndex:
    """Backward search and locating over a stream of segments, each ended by a zero."""

    def __init__(self, stream: np.ndarray, top: int, rate: int = 8):
        order = suffix_array(stream)
        before = stream[order - 1]
        self.n = len(stream)
        self.tree = WaveletTree(before, top)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(stream, minlength=top + 1))))[:-1]
        self.sampled = (order % rate == 0) | (before == 0)
        self.sample_at = np.cumsum(self.sampled) - 1
        self.samples = order[self.sampled]

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-last row of the suffixes that begin with each row of ``words``."""
        low, high = np.zeros(len(words), np.int64), np.full(len(words), self.n, np.int64)
        live = np.arange(len(words))
        for k in range(words.shape[1] - 1, -1, -1):
            symbol = words[live, k]
            go = symbol > 0
            at, symbol = live[go], symbol[go]
            low[at] = self.first[symbol] + self.tree.rank(symbol, low[at])
            high[at] = self.first[symbol] + self.tree.rank(symbol, high[at])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Place in the stream of each row's suffix."""
        place, walked = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_, at = np.arange(len(rows)), rows.copy()
        while len(open_):
            done = self.sampled[at]
            place[open_[done]] = self.samples[self.sample_at[at[done]]] + walked[open_[done]]
            open_, at = open_[~done], at[~done]
            symbol, rank = self.tree.symbol_and_rank(at)
            at = self.first[symbol] + rank
            walked[open_] += 1
        return place


def _occurrences(docs: list[np.ndarray], windows: SimpleNamespace, rate: int, rows_at_once: int = 1_000_000):
    """(document, first word, window) of every occurrence, in blocks."""
    if not len(windows.lengths):
        return
    parts, doc_of, word_of = [], [], []
    for k, ids in enumerate(docs):
        known = np.concatenate(([False], ids > 0, [False]))
        edge = np.nonzero(known[1:] != known[:-1])[0]
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= windows.shortest:
                parts += [ids[a:b], np.zeros(1, np.int64)]
                doc_of.append(np.full(b - a + 1, k))
                word_of.append(np.arange(a, b + 1))
    if not parts:
        return
    stream, doc_of, word_of = np.concatenate(parts), np.concatenate(doc_of), np.concatenate(word_of)
    index = FMIndex(stream, len(windows.vocabulary), rate)
    low, high = index.search(windows.words)
    hit = np.nonzero(low < high)[0]
    counts = high[hit] - low[hit]
    total = np.cumsum(counts)
    for a in range(0, int(total[-1]) if len(total) else 0, rows_at_once):
        flat = np.arange(a, min(a + rows_at_once, int(total[-1])))
        which = np.searchsorted(total, flat, side="right")
        rows = low[hit][which] + flat - (total[which] - counts[which])
        place = index.locate(rows)
        yield doc_of[place], word_of[place], hit[which]


def _merge(covered: np.ndarray) -> list[dict]:
    edge = np.nonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))[0].tolist()
    return [{"first": a, "past": b} for a, b in zip(edge[::2], edge[1::2])]


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("past", T.LongType())]))
RESULT = [
    T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
]
SPANS_ARROW = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


@released
def _scan(batches: Iterator[pa.RecordBatch], block, rate: int, shard_words: int, cut: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, n_words, spans, items): the last three from earlier blocks, merged with this one's.
    ``cut``: the words of all spans are cut out of ``text``."""
    windows = block.value
    get = windows.vocabulary.get

    def shard(held: list[pa.RecordBatch], docs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        steps: dict[int, np.ndarray] = {}
        items: dict[int, set] = {}
        for doc, word, window in _occurrences(docs, windows, rate):
            past = word + windows.lengths[window]
            order = np.argsort(doc, kind="stable")
            cuts = np.nonzero(np.diff(doc[order]))[0] + 1
            for some in np.split(order, cuts):
                k = int(doc[some[0]])
                step = steps.setdefault(k, np.zeros(len(docs[k]) + 1, np.int64))
                np.add.at(step, word[some], 1)
                np.add.at(step, past[some], -1)
                found = items.setdefault(k, set())
                for w in np.unique(window[some]).tolist():
                    found.update(windows.owners[w])
        at = 0
        for batch in held:
            n = batch.num_rows
            old_spans, old_items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for r in range(n):
                if at + r in steps:
                    covered = np.cumsum(steps[at + r])[:-1] > 0
                    for s in old_spans[r]:
                        covered[s["first"] : s["past"]] = True
                    old_spans[r] = _merge(covered)
                    old_items[r] = sorted({*old_items[r], *items[at + r]})
            texts = batch.column("text")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    pa.array(_cut(texts, old_spans), pa.string()) if cut else texts,
                    pa.array([len(d) for d in docs[at : at + n]], pa.int64()),
                    pa.array(old_spans, SPANS_ARROW),
                    pa.array(old_items, pa.list_(pa.string())),
                ],
                names=["doc", "text", "n_words", "spans", "items"],
            )
            at += n

    held, docs, words = [], [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, 1000):
            piece = batch.slice(a, 1000)
            held.append(piece)
            for t in piece.column("text").to_pylist():
                parts = word_list(t)
                docs.append(np.fromiter(map(get, parts, repeat(0)), np.int64, len(parts)))
                words += len(parts)
            if words >= shard_words:
                yield from shard(held, docs)
                held, docs, words = [], [], 0
    if held:
        yield from shard(held, docs)


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = 10, rate: int = 8, shard_words: int = 1_000_000, max_block_words: int = 2_000_000,
    payload: list[str] | None = None, cut: bool = False,
) -> DataFrame:
    """``(doc, text, n_words, spans, items)`` per row of ``docs``.

    ``doc`` is the struct of the ``payload`` columns (all by default), ``spans`` the merged word
    ranges that occurrences of windows cover, ``items`` the ids (as text, sorted) they come from.
    With ``cut`` the last pass also cuts the covered words out of ``text``: a pass of its own would hold
    a second Python worker for every core."""
    spark = docs.sparkSession
    body = F.struct(*(F.col(f"`{c}`") for c in (payload or docs.columns)))
    rows = docs.select(
        body.alias("doc"), F.col(text).cast("string").alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    source = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text"))
    total = source.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    blocks = max(1, math.ceil(total / max_block_words))
    schema = T.StructType([*rows.schema.fields[:2], *RESULT])
    for k in range(blocks):
        part = source.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        block = spark.sparkContext.broadcast(benchmark_windows([tuple(r) for r in part.collect()], width))
        scan = partial(_scan, block=block, rate=rate, shard_words=shard_words, cut=cut and k == blocks - 1)
        rows = rows.mapInArrow(scan, schema)
        if k < blocks - 1:
            rows = stored(rows, f"contaminated{k}")
    return rows


def _cut(texts: pa.Array, spans: list) -> list[str | None]:
    import re

    out = []
    for t, cut in zip(texts.to_pylist(), spans):
        if cut:
            raw = t.encode("utf-8", "surrogatepass")
            ends = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(WORD_BYTES).translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")))]
            kept, at = [], 0
            for s in cut:
                kept.append(raw[at : ends[s["first"]][0]])
                at = ends[s["past"] - 1][1]
            t = b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")
        out.append(t)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the covered words; rows of which no word is left go, wordless rows stay.

    A column ``n_chars`` follows the new text."""
    others = [c for c in docs.columns if c != text]  # the text travels once
    cut = contaminated_spans(docs, benchmark, text, payload=others, cut=True, **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["past"] - s["first"])
    cut = cut.where((hit == 0) | (hit < F.col("n_words")))

    def column(name: str):
        if name == text:
            return F.col("text").alias(name)
        if name == "n_chars":
            kind = docs.schema[name].dataType
            old = F.col("doc")[name]
            return F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(old).alias(name)
        return F.col("doc")[name].alias(name)

    return cut.select(*(column(c) for c in docs.columns))
