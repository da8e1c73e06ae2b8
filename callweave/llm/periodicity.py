"""Runs of periodic words in texts: repeated stretches found by suffix trees and Lyndon roots.

A run is a longest possible stretch of words with a least period q and at least two periods. Every run
begins, somewhere in its first period, the longest Lyndon word of its place under one of two opposite orders of
the words. So for each place both longest Lyndon words are candidates for a root: they end at the next suffix
that is smaller, or larger. Each candidate is extended to the right and to the left by the longest common
extension of two places, and is a run's root if it then covers two periods. Extensions are depths of lowest common
ancestors in the suffix trees (Ukkonen) of the words and of their reversal, read off in constant time from
the Euler tour: the least depth among the parents of the nodes entered between two leaves, by block minima.

Trees are built only over stretches that may hold a run, which is exact: a run of ``least`` words or more cannot hold
2k-1 words whose k k-grams occur once each, for any k with 2k-1 <= ``least``, since k-grams of a run recur a period
away but for at most k-1 in its middle. Memory is in proportion to the longest such stretch of one text, some 300
bytes a word; a text is worked on in one task.

Defined cases: null and empty texts have no words and no runs; repeated rows are rows each; an empty table
gives an empty table; of equally long runs none is dropped; all columns are kept, and those named like a result are
replaced, as ``withColumn`` does.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import free_name

ROWS = 200  # texts in one Arrow batch of results
GRAMS = 4  # words up to which grams are looked at to find where runs may be
BLOCK = 16  # entries of the Euler tour under one minimum
RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]))


# --------------------------------------------------------------------------
# Suffix trees
# --------------------------------------------------------------------------
def suffix_tree(text: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Ukkonen's tree of ``text`` and an end mark, which is smaller than any word.

    Per node: its parent, the place in the text where the label of the edge into it begins, and the length
    of the path to it. Node 0 is the root; leaves have as length what their suffix has, end mark included, so the leaf
    of suffix i is known by it."""
    text = [*(w + 1 for w in text), 0]
    n, width = len(text), max(text) + 1
    parent, begin, depth, link = [0], [0], [0], [0]
    child: dict[int, int] = {}  # (node, first word of the edge) -> node
    long = n + 1  # longer than any edge of an inner node
    size = [0]  # of the edge into a node; leaves are open to the end
    node = edge = along = pending = 0
    for i in range(n):
        word, pending, fresh = text[i], pending + 1, 0
        while pending:
            if not along:
                edge = i
            key = node * width + text[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(parent)
                parent.append(node)
                begin.append(i)
                depth.append(0)
                link.append(0)
                size.append(long)
                if fresh:
                    link[fresh] = node
                fresh = node
            else:
                if along >= size[below]:
                    edge += size[below]
                    along -= size[below]
                    node = below
                    continue
                if text[begin[below] + along] == word:
                    along += 1
                    if fresh and node:
                        link[fresh] = node
                    break
                middle = len(parent)
                child[key] = middle
                parent += (node, middle)
                begin += (begin[below], i)
                depth += (depth[node] + along, 0)
                link += (0, 0)
                size += (along, long)
                child[middle * width + word] = middle + 1
                child[middle * width + text[begin[below] + along]] = below
                parent[below] = middle
                begin[below] += along
                if size[below] < long:
                    size[below] -= along
                if fresh:
                    link[fresh] = middle
                fresh = middle
            pending -= 1
            if node:
                node = link[node]
            elif along:
                along -= 1
                edge = i - pending + 1
    for v in range(1, len(parent)):
        if size[v] == long:
            depth[v] = depth[parent[v]] + n - begin[v]
    return parent, begin, depth


class Extensions:
    """Longest common extensions of any two places of a text, by its suffix tree."""

    def __init__(self, text: list[int]):
        n = len(text)
        parent, begin, depth = map(np.asarray, suffix_tree(text))
        word = np.append(np.asarray(text, np.int64) + 1, 0)[begin]
        # children in the order of their words, then one walk that notes when each node is entered
        order = np.lexsort((word, parent))
        order = order[order != 0]
        first = np.searchsorted(parent[order], np.arange(len(parent)))
        last = np.searchsorted(parent[order], np.arange(len(parent)), side="right")
        children, a, b = order.tolist(), first.tolist(), last.tolist()
        tour, stack = [], [0]
        while stack:
            v = stack.pop()
            tour.append(v)
            if a[v] < b[v]:
                stack += children[a[v] : b[v]][::-1]
        tour = np.array(tour)
        leaf = (last == first)[tour]
        suffix = n + 1 - depth[tour[leaf]]
        self.entered = np.empty(n + 1, np.int64)
        self.entered[suffix] = np.flatnonzero(leaf)
        self.rank = np.empty(n + 1, np.int64)  # of the suffixes in order
        self.rank[suffix] = np.arange(n + 1)
        self._minima(depth[parent[tour]])

    def _minima(self, values: np.ndarray) -> None:
        """Minima before and after each entry within its block, and of 1, 2, 4, ... blocks."""
        blocks = -(-len(values) // BLOCK)
        grid = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        grid[: len(values)] = values
        self.values, grid = grid, grid.reshape(blocks, BLOCK)
        self.before = np.minimum.accumulate(grid, 1).ravel()
        self.after = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        self.table = [grid.min(1)]
        while 2 << len(self.table) - 1 <= blocks:
            half, row = 1 << len(self.table) - 1, self.table[-1]
            self.table.append(np.minimum(row[:-half], row[half:]))

    def _least(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Minimum of the entries ``a`` to ``b``, both included."""
        x, y = a // BLOCK, b // BLOCK
        out = np.minimum(self.after[a], self.before[b])
        same = np.flatnonzero(x == y)
        if len(same):
            low, high = a[same], b[same]
            found = self.values[low]
            for k in range(1, BLOCK):
                found = np.minimum(found, self.values[np.minimum(low + k, high)])
            out[same] = found
        far = np.flatnonzero(y - x > 1)
        if len(far):
            low, many = x[far] + 1, y[far] - x[far] - 1
            level = np.frexp(many)[1] - 1
            for k in np.unique(level).tolist():
                at = level == k
                i, row = low[at], self.table[k]
                inner = np.minimum(row[i], row[i + many[at] - (1 << k)])
                out[far[at]] = np.minimum(out[far[at]], inner)
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` and from ``j`` on are equal (i != j; the length of the text is a place, too)."""
        a, b = self.entered[i], self.entered[j]
        return self._least(np.minimum(a, b) + 1, np.maximum(a, b))


# --------------------------------------------------------------------------
# Runs
# --------------------------------------------------------------------------
def _next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one of smaller rank, or the length."""
    out, stack = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def all_runs(words: np.ndarray) -> np.ndarray:
    """All runs (start, length, period) of a sequence of word numbers, in order."""
    n = len(words)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    ahead = Extensions(words.tolist())
    rank = ahead.rank
    roots = []
    for ranks in (rank, -rank):
        ends = np.array(_next_smaller(ranks.tolist()))[:n]
        places = np.flatnonzero(ends <= n)  # a word that takes the end mark in is no root
        roots.append(np.stack([places, ends[places] - places], 1))
    i, p = np.concatenate(roots).T
    right = ahead.common(i, i + p)
    del ahead
    left = Extensions(words[::-1].tolist()).common(n - i, n - i - p)
    whole = left + right >= p
    found = np.stack([(i - left), (left + p + right), p], 1)[whole]
    return np.unique(found, axis=0)


def stretches(words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Bounds of the stretches that may hold a run of ``least`` words or more; every such run lies within one.

    Longer and longer grams cut what shorter ones have left, each stretch for itself."""
    starts, sizes = np.zeros(1, np.int64), np.array([len(words)], np.int64)
    for k in range(1, min(GRAMS, (least + 1) // 2) + 1):
        kept = sizes >= least
        starts, sizes = starts[kept], sizes[kept]
        if not len(starts):
            break
        ends = np.cumsum(sizes)
        label = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(int(ends[-1])) + (starts - (ends - sizes))[label]  # in the text
        single = np.unique(label * (int(words.max()) + 1) + words[place], return_inverse=True)[1]
        gram = single
        for j in range(1, k):
            gram = np.unique(gram[:-1] * (len(place) + 1) + single[j:], return_inverse=True)[1]
        once = np.bincount(gram)[gram] == 1
        once &= label[: len(gram)] == label[k - 1 :]
        seen = np.append(0, np.cumsum(once))
        first = np.flatnonzero((seen[k:] - seen[:-k] == k) & (label[: len(gram) - k + 1] == label[2 * k - 2 :]))
        # windows that no run holds: a stretch ends before the last word of one, the next begins after its first
        inner = first[first + 1 < ends[label[first]]] + 1
        borders = np.sort(np.concatenate([ends - sizes, inner]))
        after = np.searchsorted(first, borders)  # the next window that begins here or later
        past = ends[label[borders]]
        if len(first):
            inside = after < len(first)
            past[inside] = np.minimum(past[inside], first[after[inside]] + 2 * k - 2)
        starts, sizes = place[borders], past - borders
    return [(a, a + n) for a, n in zip(starts.tolist(), sizes.tolist()) if n >= least]


def find_runs(words: list, least: int = 12) -> np.ndarray:
    """Runs (start, length, period) of at least ``least`` words, by start, then period."""
    numbers: dict = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    out = [np.zeros((0, 3), np.int64)]
    for a, b in stretches(ids, least):
        part = np.unique(ids[a:b], return_inverse=True)[1]
        found = all_runs(part)
        found = found[found[:, 1] >= least]
        found[:, 0] += a
        out.append(found)
    runs = np.concatenate(out)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def kept_words(words: list, runs: np.ndarray) -> list:
    """The words of no run, and of each run its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    inside = np.cumsum(change)[:-1]
    return [w for w, x in zip(words, inside.tolist()) if not x]


def _found(batches: Iterator[pa.RecordBatch], names: list[str], least: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            rows = batch.slice(a, ROWS)
            counts, runs, texts = [], [], []
            for text in rows.columns[-1]:
                words = (text.as_py() or "").encode("utf-8", "replace").split()  # at the same six signs
                found = find_runs(words, least)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
                texts.append(b" ".join(kept_words(words, found) if len(found) else words).decode())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())], names
            )


def periodic_runs(docs: DataFrame, text: Column | str = "text", least: int = 12, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (of its columns ``keep``, or all) with ``n_words``, ``runs`` and ``collapsed``.

    Words are what lies between space, tab, line feed, vertical tab, form feed and carriage return. ``runs`` holds start (word
    number), length and period of each run of at least ``least`` words, by start, then period; ``collapsed`` is the words
    outside runs and the first period of each run, joined by one space."""
    added = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUN), T.StructField("collapsed", T.StringType())]
    taken = {f.name for f in added}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken and (keep is None or f.name in keep)]
    schema = T.StructType([*kept, *added])
    text = F.col(text) if isinstance(text, str) else text
    columns = [*(F.col(f"`{f.name}`") for f in kept), text.cast("string").alias(free_name(docs, "in"))]
    return docs.select(*columns).mapInArrow(partial(_found, names=schema.names, least=least), schema)
