"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of tokens. Every window of ``length`` tokens takes from the queues by
their target shares; what a share falls short of or exceeds in whole tokens is its deficit
and is carried into the next window. The round-robin is hierarchical: at each node of a tree over
the queues the tokens go to two halves, and the remainder of that division is the
deficit carried. So how much a queue has given before any window is known from the window's
number alone, and tasks fill all windows at once, each from its own documents: deficits carry
across windows and partitions without a running pass, and no token is shuffled.

Targets default to the queues' sizes, so all end together. With other targets, a new phase begins
whenever a queue runs dry, with the shares of those left. The last tokens, fewer than a window,
form sequences of power-of-two lengths, so nothing is padded.

Defined cases: null texts are empty and have the end token only; a null source is a queue of its
own; repeated rows are rows of their own; an empty table gives no pieces; with more sources than a window
has tokens, a queue's deficit lets it pass over windows until a whole token is due. The plan holds one line per queue,
so beyond ``MAX_QUEUES`` sources those without a target share that many queues, by hash; a target is never given up.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import partial
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import released, small, stored

CACHED_PIECES = 100_000  # of words: what is left of them in lower case, between signs
CACHED_LONG = 20_000  # words that don't fit the table, up to LONG_BYTES each
LONG_BYTES = 256
PLACES = 1 << 20  # in the table of words; 42 bytes each
WAYS = 4  # places a word may take
WORD_BYTES, WORD_IDS = 23, 8  # most of a word in the table
SEGMENT = 1 << 19  # bytes of text encoded at once, cut between words
SLICE = 1 << 23  # bytes of text in one batch of tokens, unless one row is longer
MAX_QUEUES = 4096


# --------------------------------------------------------------------------
# Tokens
# --------------------------------------------------------------------------
def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Recent(dict):
    """What ``make`` gives for a key. Of two generations the older one goes when the newer is full,
    so what is common stays."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def word_encoder(path: str | None):
    """``(encode, dtype)``: ids of a word as bytes of ``dtype``, equal to the tokenizer's own.

    Pieces of words are kept; common words go straight to the tokenizer's model, all others
    through the whole tokenizer."""
    import json
    import re

    import regex
    from tokenizers import Tokenizer

    path = path or default_tokenizer()
    whole = Tokenizer.from_file(path)
    model = whole.model
    dtype = np.dtype("<u2") if whole.get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.dtype("<u4")
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec["added_tokens"]]
    split = next((p["pattern"]["Regex"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"), None)
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    simple = steps == ["NFC", "Replace", "Lowercase"] and split is not None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level models write as themselves
    others = [b for b in range(256) if b not in plain]
    shown = {b: chr(256 + k) for k, b in enumerate(others)} | {b: chr(b) for b in plain}
    pieces = regex.compile(split) if simple else None
    common = re.compile("[\x21-\x7e\xa1-įı-ɏ]+")  # NFC, and lower case character by character
    code = "H" if dtype.itemsize == 2 else "I"
    has_special = re.compile("|".join(map(re.escape, special)) or r"(?!)").search

    def encode_piece(piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(shown)
        return array(code, [t.id for t in model.tokenize(piece)]).tobytes()

    ids_of = Recent(encode_piece, CACHED_PIECES).__getitem__

    def encode_word(word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if simple and (text.isascii() and text.isprintable() or common.fullmatch(text)):
            low = text.lower()
            if low.isalpha():
                return ids_of(low) if len(low) <= LONG_BYTES else encode_piece(low)
            if not has_special(text):
                found = pieces.findall(low)
                return b"".join(map(ids_of if len(low) <= LONG_BYTES else encode_piece, found))
        return array(code, whole.encode(text, add_special_tokens=False).ids).tobytes()

    return encode_word, dtype


class WordTable:
    """Ids of all words of texts, from ``encode``, which gives those of one word.

    The tokenizer drops white space and never joins across it, so words are encoded once each and kept:
    in arrays by their bytes themselves, looked up for many words at once. A word has ``WAYS`` places; a new one
    takes an empty place, or else one not used since a word was last put there. Words that don't fit the arrays
    are kept apart. The bounds on both are fixed."""

    def __init__(self, encode, dtype: np.dtype, places: int = PLACES):
        self.encode, self.dtype, self.sets = encode, dtype, np.uint64(places // WAYS)
        self.keys = np.zeros((3, places), np.uint64)  # bytes of a word, its length in the last; 0 where empty
        self.ids = np.zeros((places, WORD_IDS), dtype)
        self.n = np.zeros(places, np.uint8)
        self.used = np.zeros(places, bool)
        self.long = Recent(encode, CACHED_LONG)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        """The first place of each key."""
        h = keys[0] * np.uint64(0x9E3779B97F4A7C15)
        for k, m in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
            h ^= h >> np.uint64(32)
            h = (h + keys[k]) * np.uint64(m)
        h ^= h >> np.uint64(32)
        return (h % self.sets).astype(np.int64) * WAYS

    def _find(self, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it has none."""
        place = np.full(len(first), -1)
        left = None  # not found so far: all
        for way in range(WAYS):
            at = (first if left is None else first[left]) + way
            want = keys if left is None else keys[:, left]
            same = (self.keys[2][at] == want[2]) & (self.keys[0][at] == want[0]) & (self.keys[1][at] == want[1])
            here = np.flatnonzero(same)
            place[here if left is None else left[here]] = at[here]
            left = np.flatnonzero(~same) if left is None else left[~same]
        return place

    def _put(self, keys: np.ndarray, first: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """Keeps new keys; of several for one place the first, the others are left out."""

        def put(which, at):
            at, one = np.unique(at, return_index=True)
            which = which[one]
            self.keys[:, at], self.ids[at], self.n[at], self.used[at] = keys[:, which], ids[which], n[which], False
            return which

        left = np.arange(len(first))
        for way in range(WAYS):
            at = first[left] + way
            free = self.keys[2][at] == 0
            left = np.setdiff1d(left, put(left[free], at[free]), assume_unique=True)
        ways = first[left][:, None] + np.arange(WAYS)
        used = self.used[ways]
        put(left, first[left] + np.argmin(used, axis=1))
        self.used[ways[used.all(axis=1)]] = False

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, counts)``: the ids of the words of ``data`` one after another, and how many each has.
        ``data`` goes on for ``WORD_BYTES`` + 1 bytes past the last word's beginning."""
        size = ends - starts
        counts = np.zeros(len(starts), np.int64)
        rows = np.empty((len(starts), WORD_IDS), self.dtype)
        fits = size <= WORD_BYTES
        short = np.flatnonzero(fits)
        eight = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 7,), (1,))
        keys = np.empty((3, len(short)), np.uint64)
        bytes_of = size[short]
        for k in range(3):
            kept = np.clip(bytes_of - 8 * k, 0, 8)
            keys[k] = eight[starts[short] + 8 * k] & _MASKS[kept]
        keys[2] |= bytes_of.astype(np.uint64) << np.uint64(56)
        first = self._first(keys)
        place = self._find(keys, first)
        hit = place >= 0
        at = place[hit]
        self.used[at] = True
        rows[short[hit]], counts[short[hit]] = self.ids[at], self.n[at]

        more = {}  # ids of words with more than fit a row
        new = np.flatnonzero(~hit)
        if len(new):
            order = new[np.lexsort(keys[:, new])]
            differs = np.r_[True, (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)]
            one, kind = order[differs], np.cumsum(differs) - 1
            a, b = starts[short[one]], ends[short[one]]
            found = [self.encode(data[i:j].tobytes()) for i, j in zip(a.tolist(), b.tolist())]
            n = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
            few = n <= WORD_IDS
            ids = np.zeros((len(found), WORD_IDS), self.dtype)
            ids[(np.arange(WORD_IDS) < n[:, None]) & few[:, None]] = np.frombuffer(
                b"".join(f for f, ok in zip(found, few.tolist()) if ok), self.dtype
            )
            rows[short[order]], counts[short[order]] = ids[kind], n[kind]
            for k in np.flatnonzero(~few[kind]).tolist():
                more[int(short[order[k]])] = found[kind[k]]
            one = one[few]
            self._put(keys[:, one], first[one], ids[few], n[few])
        for k in np.flatnonzero(~fits).tolist():
            word = data[starts[k] : ends[k]].tobytes()
            more[k] = self.long[word] if len(word) <= LONG_BYTES else self.encode(word)
            counts[k] = len(more[k]) // self.dtype.itemsize

        inline = counts.copy()
        inline[list(more)] = 0
        flat = rows[np.arange(WORD_IDS) < inline[:, None]]
        if more:  # set between the others
            out, apart = np.empty(counts.sum(), self.dtype), np.zeros(counts.sum(), bool)
            place = np.cumsum(counts) - counts
            for k, found in more.items():
                out[place[k] : place[k] + counts[k]] = np.frombuffer(found, self.dtype)
                apart[place[k] : place[k] + counts[k]] = True
            out[~apart] = flat
            flat = out
        return flat, counts

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)``: the ids of all texts, each with ``end_id`` behind it, and where each text ends in them."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        base, stop = int(offsets[0]), int(offsets[-1])
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[base:stop] if buffer is not None else np.zeros(0, np.uint8)
        borders = offsets - base
        done, before, total, a = [], np.zeros(len(borders), np.int64), 0, 0
        row, reach = 0, SEGMENT
        while a < len(data):
            b = min(a + reach, len(data))
            part = np.zeros(b - a + WORD_BYTES + 9, np.uint8)
            part[: b - a] = data[a:b]
            inner = borders[row : np.searchsorted(borders, b, "right")] - a
            inside = np.zeros(b - a + 2, bool)  # of a word; shifted by one
            inside[1:-1] = _IN_WORD[part[: b - a]]
            starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
            edges = inner[inside[inner + 1] & inside[inner]]  # texts that meet without a space
            starts[edges] = ends[edges] = True
            starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
            if b < len(data) and len(ends) and ends[-1] == b - a and borders[np.searchsorted(borders, b)] != b:
                if starts[-1] == 0:  # the word may go on: a longer part, or from its beginning next
                    reach *= 2
                    continue
                b = a + int(starts[-1])
                starts, ends = starts[:-1], ends[:-1]
                inner = inner[inner <= b - a]
            ids, counts = self.words(part, starts, ends) if len(starts) else (np.zeros(0, self.dtype), np.zeros(0, np.int64))
            sums = np.r_[0, np.cumsum(counts)]
            before[row : row + len(inner)] = total + sums[np.searchsorted(starts, inner)]
            row, total, a, reach = row + len(inner), total + len(ids), b, SEGMENT
            done.append(ids)
        before[row:] = total
        counts = np.diff(before) + 1
        ends = np.cumsum(counts)
        out, is_end = np.empty(total + len(texts), self.dtype), np.zeros(total + len(texts), bool)
        is_end[ends - 1] = True
        out[is_end] = end_id
        if done:
            out[~is_end] = np.concatenate(done)
        return out, ends


_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_table(path: str | None) -> WordTable:
    """The table of a tokenizer's words; it lives as long as the Python worker."""
    import sys

    kept = sys.modules.setdefault("_callweave_encoders", SimpleNamespace(by_path={}))
    path = path or default_tokenizer()
    if path not in kept.by_path:
        kept.by_path[path] = WordTable(*word_encoder(path))
    return kept.by_path[path]


@released
def _token_batches(batches: Iterator[pa.RecordBatch], tokenizer: str | None, end_id: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, queue, text) to (id, queue, part, start, n, ids): ``start`` counts tokens of the queue in this task."""
    from pyspark import TaskContext

    table = word_table(tokenizer)
    width = table.dtype.itemsize
    part, given = TaskContext.get().partitionId(), {}
    for batch in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < batch.num_rows:
            b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + SLICE, "right"))
            b = min(max(b, a + 1), a + 500)
            rows = batch.slice(a, b - a)
            a = b
            ids, ends = table.texts(rows.column(2), end_id)
            sizes, starts = np.diff(ends, prepend=0).tolist(), []
            for queue, n in zip(rows.column(1).to_pylist(), sizes):
                starts.append(given.get(queue, 0))
                given[queue] = starts[-1] + n
            places = pa.array(np.r_[0, ends * width], pa.int32()).buffers()[1]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0), rows.column(1), pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64()),
                    pa.array(sizes, pa.int64()), pa.Array.from_buffers(pa.binary(), len(sizes), [None, places, pa.py_buffer(ids)]),
                ],
                names=["id", "queue", "part", "start", "n", "ids"],
            )


# --------------------------------------------------------------------------
# The mixture
# --------------------------------------------------------------------------
def shares_tree(weights: dict) -> dict:
    """Per queue its path from the root: ``(left, total, right?)`` at each node."""
    paths: dict = {q: [] for q in weights}

    def split(queues: list) -> int:
        if len(queues) == 1:
            return weights[queues[0]]
        half = len(queues) // 2
        left, right = split(queues[:half]), split(queues[half:])
        for q in queues[:half]:
            paths[q].append((left, left + right, False))
        for q in queues[half:]:
            paths[q].append((left, left + right, True))
        return left + right

    queues = [q for q in weights if weights[q] > 0]
    if queues:
        split(queues)
    return {q: paths[q][::-1] for q in queues}


def given_before(path: list, tokens: int) -> int:
    """How many of the first ``tokens`` dealt at the root this queue gave."""
    for left, total, right in path:
        part = tokens * left // total
        tokens = tokens - part if right else part
    return tokens


def place_in_window(path: list, low: int, high: int) -> int:
    """Tokens of earlier queues between the root's ``low`` and ``high``."""
    before = 0
    for left, total, right in path:
        a, b = low * left // total, high * left // total
        if right:
            before += b - a
            low, high = low - a, high - b
        else:
            low, high = a, b
    return before


def phases(sizes: dict, targets: dict | None, length: int) -> list[tuple[int, int, int, dict, dict]]:
    """``(first window, windows, tokens per window, paths, given before)`` until all queues are empty.

    Within a phase the shares are fixed; it ends when some queue can't fill its share of another
    window. Then that queue gives the rest of what it has in a window of its own shares."""
    left = {q: n for q, n in sorted(sizes.items()) if n > 0}
    out, window, given = [], 0, {q: 0 for q in left}
    targets = targets or {}
    while left:
        total = sum(left.values())
        weights = {q: max(1, int(targets[q])) if q in targets else 0 for q in left} if targets else dict(left)
        if not sum(weights.values()):
            weights = dict(left)  # only queues without a target are left
        paths = shares_tree(weights)
        low, high = 0, total // length
        while low < high:  # the most whole windows that no queue falls short in
            middle = (low + high + 1) // 2
            if all(given_before(p, middle * length) <= left[q] for q, p in paths.items()):
                low = middle
            else:
                high = middle - 1
        if low == 0:
            size = min(length, total)
            share = {q: min(left[q], given_before(paths[q], size) if q in paths else 0) for q in left}
            for q in left:  # what dry queues lack the others give
                more = min(size - sum(share.values()), left[q] - share[q])
                share[q] += more
            paths, count = shares_tree(share), 1
        else:
            size, count = length, low
        out.append((window, count, size, paths, {q: given[q] for q in paths}))
        for q, p in paths.items():
            used = given_before(p, size * count)
            given[q] += used
            left[q] -= used
        left = {q: n for q, n in left.items() if n > 0}
        window += count
    return out


def _power_pieces(size: int) -> list[tuple[int, int]]:
    """``size`` as (offset, length) of falling powers of two."""
    out, at = [], 0
    for bit in range(size.bit_length() - 1, -1, -1):
        if size >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def _window_at(plan: list, queue, at: int) -> tuple[int, int, int, int, int]:
    """Of the window that takes the queue's token ``at``: number, its size, the queue's tokens
    before it and past it, and the place of the first of them in the window."""
    for first, count, size, paths, given in plan:
        path = paths.get(queue)
        if path is None:
            continue
        here = at - given[queue]
        if here >= given_before(path, count * size):
            continue
        low, high = 0, count - 1
        guess = here
        for left, total, right in reversed(path):  # about where an even flow would put it
            guess = guess * total // max(1, total - left if right else left)
        guess //= size
        span = 2
        while True:  # bracket, then halve
            a, b = max(low, guess - span), min(high, guess + span)
            if (a == low or given_before(path, a * size) <= here) and (b == high or given_before(path, (b + 1) * size) > here):
                break
            span *= 4
        while a < b:
            middle = (a + b) // 2
            if given_before(path, (middle + 1) * size) > here:
                b = middle
            else:
                a = middle + 1
        low, high = a * size, (a + 1) * size
        return (
            first + a, size, given[queue] + given_before(path, low), given[queue] + given_before(path, high),
            place_in_window(path, low, high),
        )
    raise AssertionError("a token past its queue's end")


@released
def _piece_batches(batches: Iterator[pa.RecordBatch], plan: list, length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, queue, from, n, ids) to pieces; ``from`` is the document's place in its queue."""
    last = plan[-1][0] if plan else 0
    current: dict = {}
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def flush(cols: list[list], like: pa.RecordBatch, rows: list[int]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [like.column(0).take(pa.array(rows, pa.int32())), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=names
        )

    for batch in batches:
        for a in range(0, batch.num_rows, 500):
            part = batch.slice(a, 500)
            cols, owner = [[] for _ in names[1:]], []
            columns = [part.column(k).to_pylist() for k in range(1, 5)]
            for row, (queue, base, n, data) in enumerate(zip(*columns)):
                data = np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()
                at = base
                while at < base + n:
                    window = current.get(queue)
                    if window is None or not window[2] <= at < window[3]:
                        window = current[queue] = _window_at(plan, queue, at)
                    number, size, low, high, place = window
                    stop, offset, sequence = min(high, base + n), place + at - low, number
                    if size < length:  # the last tokens, in powers of two
                        for k, (first, many) in enumerate(_power_pieces(size)):
                            if first <= offset < first + many:
                                stop, sequence, offset = min(stop, at + first + many - offset), last + k, offset - first
                                break
                    owner.append(row)
                    for c, v in zip(cols, (at - base, stop - at, data[4 * (at - base) : 4 * (stop - base)], n, sequence, offset)):
                        c.append(v)
                    at = stop
            yield flush(cols, part, owner)


def pack(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", length: int = 4096,
    end_id: int = 2, tokenizer: str | None = None, targets: dict[str | None, int] | None = None,
) -> DataFrame:
    """Pieces ``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``; ``ids`` are
    little-endian unsigned 32-bit. ``targets``: integer weights by source (sources without one come last)."""
    name = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null"))
    rows = docs.select(F.col(doc_id).alias("id"), name.alias("queue"), F.col(text).cast("string").alias("text"))
    named = {("null" if k is None else f"s{k}"): v for k, v in targets.items()} if targets else None
    if rows.select("queue").distinct().count() > MAX_QUEUES:
        shared = F.concat(F.lit("p"), F.pmod(F.xxhash64("queue"), F.lit(MAX_QUEUES)).cast("string"))
        rows = rows.withColumn("queue", F.when(F.col("queue").isin(list(named)), F.col("queue")).otherwise(shared) if named else shared)
    schema = T.StructType(
        [
            rows.schema["id"], T.StructField("queue", T.StringType()), T.StructField("part", T.IntegerType()),
            T.StructField("start", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ids", T.BinaryType()),
        ]
    )
    tokens = stored(rows.mapInArrow(partial(_token_batches, tokenizer=tokenizer, end_id=end_id), schema), "packing-tokens")
    parts = tokens.groupBy("queue", "part").agg(F.sum("n").alias("tokens"))
    # few rows: one per task and queue
    before = F.sum("tokens").over(W.partitionBy("queue").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = stored(parts.select("queue", "part", "tokens", F.coalesce(before, F.lit(0)).alias("base")), "packing-bases")
    sizes = {r[0]: r[1] for r in bases.groupBy("queue").agg(F.sum("tokens")).collect()}  # at most MAX_QUEUES, and those with targets
    plan = phases(sizes, named, length)
    width = word_table(tokenizer).dtype.itemsize
    placed = tokens.join(small(bases.drop("tokens")), ["queue", "part"]).select(
        "id", "queue", (F.col("base") + F.col("start")).alias("from"), "n", "ids"
    )
    schema = T.StructType(
        [
            rows.schema["id"], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
        ]
    )
    pieces = placed.mapInArrow(partial(_piece_batches, plan=plan, length=length, width=width), schema)
    return pieces.withColumnRenamed("id", "doc_id")


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences, one row each."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))
