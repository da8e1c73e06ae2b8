"""Byte-level BPE encoding by speculation and verification, and decoding.

A word's tokens are guessed by greedy longest match. A sequence of tokens is what the merges give
if and only if every token is the merges' own encoding of its bytes and no two neighbours would have
been merged across their border. The second is decided for the pairs of all new words of a batch
at once: the merges that made the two neighbours are undone, the latest first, and at each
step the two tokens at the border must not form a merge that comes before the one just undone. Only words
with a pair that fails are merged exactly, through a heap in time n log n.

Texts are cut at the tokenizer's added tokens, then at white space, and each piece is encoded once
while it is kept (two generations of a bounded number of pieces in each Python worker; long pieces are
not kept). Decoding gathers the bytes of all tokens of a batch by index.

Defined cases: null and empty texts have no ids, null ids are the empty text; ids without a
token are passed over; bytes that are no UTF-8 become the replacement mark; repeated rows are encoded
each; an empty table gives an empty table; all columns are kept, and one named like the result is replaced, as
``withColumn`` does. Tokenizers other than plain byte-level BPE raise ``ValueError``.
"""

from __future__ import annotations

import heapq
import json
import sys
from collections.abc import Iterator
from functools import partial
from itertools import chain
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import free_name

KEPT_PIECES = 400_000
KEPT_LENGTH = 64  # characters up to which a piece is kept
SIDE_BY_SIDE = 64  # bytes up to which words are merged many at a time
ROWS = 400  # texts encoded at a time
NEVER = np.int64(1) << 40

# How byte-level models cut texts, and the white space that cut is made at.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte: printable Latin-1 for itself, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokens:
    """The bytes of each token."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        signs = byte_signs()
        model = self.spec["model"]
        self.added = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self.bytes_of = {i: bytes(signs[c] for c in t) for t, i in model["vocab"].items() if all(c in signs for c in t)}
        self.size = max([*model["vocab"].values(), *self.added.values()]) + 1
        blobs = [b""] * self.size
        for i, b in chain(self.bytes_of.items(), ((i, t.encode()) for t, i in self.added.items())):
            blobs[i] = b
        self.lengths = np.array([len(b) for b in blobs], np.int64)
        self.starts = np.append(0, np.cumsum(self.lengths))[:-1]
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)


class Merges(Tokens):
    """Tokens and merges of a byte-level model, as arrays by token id."""

    def __init__(self, path: str):
        super().__init__(path)
        model, cut = self.spec["model"], self.spec["pre_tokenizer"] or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd or self.spec["normalizer"] or cut.get("type") != "ByteLevel" or cut["add_prefix_space"] or not cut.get("use_regex", True):
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in self.spec["added_tokens"]):
            raise ValueError("added tokens must be matched as they are")
        size = self.size
        self.left, self.right = np.arange(size), np.arange(size)
        self.rank = np.full(size, -1, np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = []
        for k, (a, b) in enumerate(pairs):
            x, y, made = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            if self.rank[made] >= 0 or max(self.rank[x], self.rank[y]) >= k:
                raise ValueError("merges must make each token once, from earlier ones")
            self.left[made], self.right[made], self.rank[made] = x, y, k
            keys.append(x * size + y)
        self.made = {key: (k, model["vocab"][a + b]) for k, (key, (a, b)) in enumerate(zip(keys, pairs))}
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max), np.append(order, NEVER)
        self.pair_made = np.append(np.array([m[1] for m in self.made.values()], np.int64)[order], 0)
        self.byte_ids = np.zeros(256, np.int64)
        for i, b in self.bytes_of.items():
            if len(b) == 1:
                self.byte_ids[b[0]] = i
        self._trie()
        del self.spec

    def _own(self) -> set[int]:
        """Tokens that the merges make of their own bytes; no other token occurs in an encoding."""
        ids = np.flatnonzero(self.rank >= 0)
        kept = dict(zip(ids.tolist(), self.compatible(self.left[ids], self.right[ids], self.rank[ids]).tolist()))
        own = set(self.byte_ids.tolist())
        for i in ids[np.argsort(self.rank[ids])].tolist():
            if kept[i] and self.left[i] in own and self.right[i] in own:
                own.add(i)
        return own

    def _trie(self) -> None:
        nodes, edges, own = {b"": 0}, {}, self._own()
        for i in own:
            for k, byte in enumerate(b := self.bytes_of[i]):
                edges[nodes[b[:k]] * 256 + byte] = nodes.setdefault(b[: k + 1], len(nodes))
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.edge_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.edge_ends = np.append(np.fromiter(edges.values(), np.int64, len(edges))[order], 0)
        self.token_at = np.full(len(nodes), -1, np.int64)
        for i in own:
            self.token_at[nodes[self.bytes_of[i]]] = i

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """Of each pair of neighbours: does no merge before ``limit`` cross their border?"""
        good, live = np.ones(len(a), bool), np.arange(len(a))
        limit = np.broadcast_to(np.asarray(limit, np.int64), a.shape)
        while len(live):
            key = a * self.size + b
            at = np.searchsorted(self.pair_keys, key)
            crossed = np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER) < limit
            good[live[crossed]] = False
            made_a, made_b = self.rank[a], self.rank[b]
            left = made_a > made_b  # equal merges run from the left, so the right one came later
            go = ~crossed & (np.maximum(made_a, made_b) >= 0)
            limit = np.where(left, made_a, made_b + 1)[go]  # at an equal rank the border, left of b, goes first
            a, b = np.where(left, self.right[a], a)[go], np.where(left, b, self.left[b])[go]
            live = live[go]
        return good

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of all words at once, down a trie: tokens word by word, and how many each has."""
        sizes = np.array([len(w) for w in words], np.int64)
        text, ends = np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.cumsum(sizes)
        place, owners, tokens = ends - sizes, [], []
        active = np.flatnonzero(sizes)
        while len(active):
            at, end = place[active], ends[active]
            node, best, past = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64), at.copy()
            live = np.arange(len(active))
            while len(live):
                key = node[live] * 256 + text[at[live]]
                edge = np.searchsorted(self.edge_keys, key)
                there = self.edge_keys[edge] == key
                live, down = live[there], self.edge_ends[edge[there]]
                node[live] = down
                at[live] += 1
                token = self.token_at[down]
                stop = token >= 0
                best[live[stop]], past[live[stop]] = token[stop], at[live[stop]]
                live = live[at[live] < end[live]]
            owners.append(active)
            tokens.append(best)
            place[active] = past
            active = active[past < end]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate(owners)
        return np.concatenate(tokens)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def exact_many(self, words: list[bytes]) -> list[bytes]:
        """All merges in order of rank, from the left, of many short words side by side."""
        out = [b""] * len(words)
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        while len(ids):
            key = ids[:-1] * self.size + ids[1:]
            at = np.searchsorted(self.pair_keys, key)
            there = (self.pair_keys[at] == key) & (owner[1:] == owner[:-1])
            rank = np.append(np.where(there, self.pair_ranks[at], NEVER), NEVER)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(first, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, first), sizes)
            done = least == NEVER
            if done.any():
                for k, x in zip(first[done[first]].tolist(), sizes[done[first]].tolist()):
                    out[owner[k]] = ids[k : k + x].astype("<i4").tobytes()
            here = np.flatnonzero((rank == least) & ~done)
            here = here[np.append(True, owner[here][1:] != owner[here][:-1])] if len(here) else here
            ids[here] = self.pair_made[at[here]]
            stay = ~done
            stay[here + 1] = False
            ids, owner = ids[stay], owner[stay]
        return out

    def exact(self, word: bytes) -> list[int]:
        """All merges in order of rank, from the left."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n, size, made = len(ids), self.size, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(made[k][0], i, k) for i in range(n - 1) if (k := ids[i] * size + ids[i + 1]) in made]
        heapq.heapify(heap)
        while heap:
            _, i, key = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] * size + ids[j] != key:
                continue
            ids[i], ids[j] = made[key][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (k := ids[i] * size + ids[after[i]]) in made:
                    heapq.heappush(heap, (made[k][0], i, k))
            if before[i] >= 0 and (k := ids[before[i]] * size + ids[i]) in made:
                heapq.heappush(heap, (made[k][0], before[i], k))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as 32-bit numbers: guessed, checked pair by pair, merged only where the guess fails."""
        flat, sizes = self.propose(words)
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        failed = np.unique(owner[inner[~self.compatible(flat[inner], flat[inner + 1])]]).tolist()
        ids, ends = flat.astype("<i4").tobytes(), np.append(0, np.cumsum(4 * sizes)).tolist()
        found = [ids[a:b] for a, b in zip(ends, ends[1:])]
        short = [k for k in failed if len(words[k]) <= SIDE_BY_SIDE]
        for k, exact in zip(short, self.exact_many([words[k] for k in short])):
            found[k] = exact
        for k in failed:
            if len(words[k]) > SIDE_BY_SIDE:
                found[k] = np.array(self.exact(words[k]), "<i4").tobytes()
        return found


class Encoder:
    """Ids of texts; pieces between white space are kept."""

    def __init__(self, path: str):
        import re

        import regex

        self.merges = Merges(path)
        self.pieces, self.words = re.compile(PIECES).findall, regex.compile(WORDS).findall
        added = sorted(self.merges.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")" if added else "(?!)")
        self.kept = {t: np.array([i], "<i4").tobytes() for t, i in self.merges.added.items()}
        self.older: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        cut = [self.words(p) for p in pieces]
        words = list(set(chain.from_iterable(cut)))
        ids = dict(zip(words, self.merges.encode_words([w.encode("utf-8", "replace") for w in words])))
        self.kept.update(zip(pieces, (b"".join(map(ids.__getitem__, ws)) for ws in cut)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit numbers."""
        cut = [self._cut(t) for t in texts]
        seen = set(chain.from_iterable(cut)).difference(self.kept)
        self.kept.update((p, self.older[p]) for p in seen.intersection(self.older))
        new = list(seen.difference(self.older))
        self._learn(new)
        out = [b"".join(map(self.kept.__getitem__, pieces)) for pieces in cut]
        for p in new:
            if len(p) > KEPT_LENGTH:
                del self.kept[p]
        if len(self.kept) > KEPT_PIECES:
            self.older, self.kept = self.kept, {t: self.kept[t] for t in self.merges.added}
        return out

    def _cut(self, text: str) -> list[str]:
        if not self.added.search(text):
            return self.pieces(text)
        parts = self.added.split(text)  # every second one is an added token
        return list(chain.from_iterable([x] if k % 2 else self.pieces(x) for k, x in enumerate(parts)))


def _once(kind: type, path: str | None):
    """What the worker has made of a tokenizer file, once."""
    path = path or default_tokenizer()
    kept = sys.modules.setdefault("_callweave_bpe", SimpleNamespace(made={}))
    if (kind.__name__, path) not in kept.made:
        kept.made[kind.__name__, path] = kind(path)
    return kept.made[kind.__name__, path]


def encoder(path: str | None) -> Encoder:
    return _once(Encoder, path)


def _with(rows: pa.RecordBatch, keep: list[str], name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*rows.columns[:-1], values], [*keep, name])


def _encoded(batches: Iterator[pa.RecordBatch], keep: list[str], out: str, path: str | None) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            rows = batch.slice(a, ROWS)
            ids = encode([t or "" for t in rows.columns[-1].to_pylist()])
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            yield _with(rows, keep, out, pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4"))))


def _decoded(batches: Iterator[pa.RecordBatch], keep: list[str], out: str, path: str | None) -> Iterator[pa.RecordBatch]:
    table = _once(Tokens, path)
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            rows = batch.slice(a, ROWS)
            lists = rows.columns[-1].cast(pa.list_(pa.int64()))
            flat = lists.flatten().fill_null(-1).to_numpy()
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)
            known = (flat >= 0) & (flat < table.size)
            flat, row = flat[known], row[known]
            n = table.lengths[flat]
            past = np.cumsum(n)
            data = table.blob[np.repeat(table.starts[flat] - (past - n), n) + np.arange(int(n.sum()))].tobytes()
            ends = np.append(0, np.cumsum(np.bincount(row, n, len(sizes)))).astype(np.int64).tolist()
            texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(ends, ends[1:])]
            yield _with(rows, keep, out, pa.array(texts, pa.string()))


def _round_trip(batches: Iterator[pa.RecordBatch], keep: list[str], ids: str, out: str, path: str | None) -> Iterator[pa.RecordBatch]:
    encoded = _encoded(batches, keep, ids, path)
    twice = (pa.RecordBatch.from_arrays([*b.columns, b.columns[-1]], [*b.schema.names, "in"]) for b in encoded)
    return _decoded(twice, [*keep, ids], out, path)


def _mapped(df: DataFrame, step, column: str, out: str, kind: T.DataType, keep: list[str] | None, path: str | None) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name.lower() != out.lower() and (keep is None or f.name in keep)]
    step = partial(step, keep=[f.name for f in kept], out=out, path=path)
    return df.select(*(F.col(f"`{f.name}`") for f in kept), F.col(column).alias(free_name(df, "in"))).mapInArrow(
        step, T.StructType([*kept, T.StructField(out, kind)])
    )


def encode(docs: DataFrame, text: str = "text", out: str = "ids", keep: list[str] | None = None, tokenizer: str | None = None) -> DataFrame:
    """``docs`` (of its columns ``keep``, or all) with the token ids of ``text`` as ``out``, an array of int."""
    return _mapped(docs, _encoded, text, out, T.ArrayType(T.IntegerType()), keep, tokenizer)


def decode(docs: DataFrame, ids: str = "ids", out: str = "text", keep: list[str] | None = None, tokenizer: str | None = None) -> DataFrame:
    """``docs`` (of its columns ``keep``, or all) with the text of the token ids ``ids`` as ``out``."""
    return _mapped(docs, _decoded, ids, out, T.StringType(), keep, tokenizer)


def round_trip(
    docs: DataFrame, text: str = "text", ids: str = "ids", out: str = "decoded", keep: list[str] | None = None, tokenizer: str | None = None
) -> DataFrame:
    """``decode`` of ``encode`` in one pass of the same workers: ``docs`` with ``ids`` and ``out``."""
    taken = {ids.lower(), out.lower()}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken and (keep is None or f.name in keep)]
    step = partial(_round_trip, keep=[f.name for f in kept], ids=ids, out=out, path=tokenizer)
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.StringType())])
    return docs.select(*(F.col(f"`{f.name}`") for f in kept), F.col(text).alias(free_name(docs, "in"))).mapInArrow(step, schema)
