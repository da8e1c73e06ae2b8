"""Near-duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Fingerprints are compared only once each, whatever the number of copies. For at most
``distance`` differing bits, 64 bits are cut into ``distance + 2`` blocks: two of them are
equal in any linked pair, so a pair meets in the bucket of that choice of blocks. Inside a
bucket the fingerprints are sorted by Gray rank and indexed as a tree: a node holds the bits
its whole group shares, children only those their parent lacks; a search adds up the bits in
which a query differs from these patterns and leaves a group as soon as they exceed the
distance. Links found in a bucket are thinned to a forest, which loses no connection.

Buckets with more than ``max_bucket`` fingerprints are cut by further blocks of their
remaining bits, again so that every linked pair shares a finer bucket.

Defined cases: null and empty texts have fingerprint zero and link like any other; rows
repeated or with equal ids are rows of their own; an empty table gives none; ids may be null and
count as no id in ``component_id``; other columns stay and never clash, since only a row number
and the fingerprint travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import stored
from callweave.llm.graph import components

BITS = 64


# --------------------------------------------------------------------------
# Fingerprints
# --------------------------------------------------------------------------
def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Bits set in over half of the XXH64 hashes of the word shingles."""
    import xxhash

    if not text:
        return 0
    lower = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
    parts = text.encode("utf-8", "surrogatepass").translate(lower).split(b" ")
    parts = [p for p in parts if p] if b"" in parts else parts
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(parts) - words + 1].tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends)], dtype=np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.nonzero(2 * ones > len(hashes))[0].tolist())


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        prints = np.fromiter(
            (fingerprint(t.as_py(), words, seed) for t in texts), np.uint64, batch.num_rows
        ).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(prints)], names=[*batch.schema.names[:-1], "fp"]
        )


def fingerprints(df: DataFrame, text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """The columns of ``df`` but ``text``, and its fingerprint ``fp`` as a signed long."""
    keep = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("fp", T.LongType())])
    rows = df.select(*(F.col(f"`{c}`") for c in keep), F.col(text))
    return rows.mapInArrow(partial(_fingerprint_batches, words=words, seed=seed), schema)


# --------------------------------------------------------------------------
# The index of one bucket
# --------------------------------------------------------------------------
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each number in the reflected Gray order."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Tree over fingerprints in Gray order; ``fan`` children to a node."""

    def __init__(self, sorted_prints: np.ndarray, fan: int = 8):
        self.fan, n = fan, len(sorted_prints)
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        ones, zeros = [sorted_prints], [~sorted_prints]  # bits set, and bits clear, in the whole group
        while len(ones[-1]) > 1:
            at = np.arange(0, len(ones[-1]), fan)
            ones.append(np.bitwise_and.reduceat(ones[-1], at))
            zeros.append(np.bitwise_and.reduceat(zeros[-1], at))
        shared = [a | b for a, b in zip(ones, zeros)]
        self.pattern = ones[::-1]
        shared = shared[::-1]
        # bits a node adds to those its ancestors share
        self.mask = [shared[0]] + [
            shared[k] & ~shared[k - 1][np.arange(len(shared[k])) // fan] for k in range(1, len(shared))
        ]
        self.mask[-1] = (full & ~shared[-2][np.arange(n) // fan]) if len(shared) > 1 else np.full(n, full)
        self.sizes = [len(p) for p in self.pattern]

    def search(self, queries: np.ndarray, alive: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query number, place) within ``distance``, among places that are ``alive``."""
        levels, live = [alive], alive
        for size in self.sizes[::-1][1:]:
            live = np.logical_or.reduceat(live, np.arange(0, len(live), self.fan))
            levels.append(live)
        levels = levels[::-1]
        q = np.arange(len(queries))
        node = np.zeros(len(queries), np.int64)
        spent = np.bitwise_count((queries ^ self.pattern[0][0]) & self.mask[0][0]).astype(np.int64)
        ok = (spent <= distance) & levels[0][0]
        q, node, spent = q[ok], node[ok], spent[ok]
        for k in range(1, len(self.pattern)):
            child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
            q, spent = np.repeat(q, self.fan), np.repeat(spent, self.fan)
            ok = child < self.sizes[k]
            q, child, spent = q[ok], child[ok], spent[ok]
            ok = levels[k][child]
            q, child, spent = q[ok], child[ok], spent[ok]
            spent = spent + np.bitwise_count((queries[q] ^ self.pattern[k][child]) & self.mask[k][child])
            ok = spent <= distance
            q, node, spent = q[ok], child[ok], spent[ok]
        return q, node


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def bucket_links(prints: np.ndarray, distance: int, work: int = 200_000) -> list[tuple[int, int]]:
    """A forest with the same connections as all pairs of distinct ``prints`` within ``distance``.

    Places found by a search join the next searches and are no longer searched for, so a tight
    group costs little more than its size; the number of searches at a time follows the pairs found."""
    n, links = len(prints), []
    if n < 2:
        return links
    if n <= 16:
        for i in range(n - 1):
            near = np.nonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance)[0]
            links += [(i, i + 1 + j) for j in near.tolist()]
        if len(links) >= n:
            forest = _Forest(n)
            links = [p for p in links if forest.join(*p)]
        return links
    order = np.argsort(gray_rank(prints), kind="stable")
    ranked = prints[order]
    index, forest = GrayIndex(ranked), _Forest(n)
    alive, waiting, fresh, batch = np.ones(n, bool), [], 0, 16
    while True:
        now = waiting[:batch]
        waiting = waiting[batch:]
        while len(now) < batch and fresh < n:
            if alive[fresh]:
                now.append(fresh)
                alive[fresh] = False
            fresh += 1
        if not now:
            break
        asked = np.array(now)
        # those asked together must meet each other and those that wait, which are no
        # longer alive; what is connected already needs no further link
        near = np.array(now + waiting)
        roots = np.array([forest.root(i) for i in near.tolist()])
        for k in range(len(now)):
            ok = roots[k + 1 :] != roots[k]
            if not ok.any():
                continue
            rest = near[k + 1 :][ok]
            rest = rest[np.bitwise_count(ranked[rest] ^ ranked[now[k]]) <= distance]
            links += [(now[k], b) for b in rest.tolist() if forest.join(now[k], b)]
        q, place = index.search(ranked[asked], alive, distance)
        for a, b in zip(asked[q].tolist(), place.tolist()):
            if forest.join(a, b):
                links.append((a, b))
        found = np.unique(place)
        alive[found] = False
        waiting += found.tolist()
        per_query = max(1, len(place) // len(asked))
        batch = int(min(256, max(1, work // (per_query * 64))))
    return [(int(order[a]), int(order[b])) for a, b in links]


def _link_partition(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, fp) sorted by bucket, one bucket in memory at a time, as links (u, v)."""
    held: list[np.ndarray] = []
    name = None

    def links() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if sum(map(len, held)) > 1:
            prints = np.unique(np.concatenate(held))
            pairs = bucket_links(prints, distance)
            if pairs:
                a = np.array(pairs)
                yield prints[a[:, 0]], prints[a[:, 1]]

    def out(found: list) -> pa.RecordBatch:
        u, v = (np.concatenate([x[k] for x in found]).view(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    ready: list = []
    for batch in batches:
        buckets = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(buckets):
            continue
        cuts = np.nonzero(buckets[1:] != buckets[:-1])[0] + 1
        edges = [0, *cuts.tolist(), len(buckets)]
        for a, b in zip(edges, edges[1:]):
            if name is not None and buckets[a] != name:
                ready += links()
                held = []
            name = buckets[a]
            held.append(prints[a:b])
        if sum(len(x[0]) for x in ready) > 10_000:
            yield out(ready)
            ready = []
    ready += links()
    if ready:
        yield out(ready)


# --------------------------------------------------------------------------
# Buckets
# --------------------------------------------------------------------------
def _cuts(bits: list[int], parts: int) -> list[list[int]]:
    size, rest = divmod(len(bits), parts)
    out, at = [], 0
    for k in range(parts):
        end = at + size + (k < rest)
        out.append(bits[at:end])
        at = end
    return out


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >= 1 << 63 else value


def _bucketed(prints: DataFrame, distance: int, max_bucket: int, levels: int = 3) -> DataFrame:
    """``(bucket, fp)``: every pair within ``distance`` shares a bucket."""
    blocks = _cuts(list(range(BITS)), distance + 2)
    first = [_mask(blocks[a] + blocks[b]) for a, b in combinations(range(distance + 2), 2)]
    keyed = prints.select("fp", F.explode(F.array(*(F.lit(m).cast("long") for m in first))).alias("mask"))
    done = None
    for level in range(levels + 1):
        named = keyed.withColumn("bucket", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))))
        if level == levels:
            part = named.select("bucket", "fp")
            return part if done is None else done.unionByName(part)
        hot = stored(
            named.groupBy("bucket", "mask").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_bucket),
            f"simhash-hot{level}",
        )
        masks = [r[0] for r in hot.select("mask").distinct().collect()]  # block choices only, not buckets
        if not masks:
            part = named.select("bucket", "fp")
            return part if done is None else done.unionByName(part)
        cool = named.join(hot.select("bucket"), "bucket", "left_anti").select("bucket", "fp")
        done = cool if done is None else done.unionByName(cool)
        finer = F.lit(None).cast("array<bigint>")
        for m in masks:
            free = [b for b in range(BITS) if not (m >> b) & 1]
            options = [_mask([b for b in range(BITS) if (m >> b) & 1] + c) for c in _cuts(free, distance + 1)]
            finer = F.when(F.col("mask") == m, F.array(*(F.lit(o).cast("long") for o in options))).otherwise(finer)
        heavy = named.join(hot.select("bucket"), "bucket", "left_semi")
        keyed = heavy.select("fp", F.explode(finer).alias("mask")).distinct()
    raise AssertionError


def links(prints: DataFrame, distance: int = 4, max_bucket: int = 100_000) -> DataFrame:
    """Links (u, v) with the connections of all pairs of the distinct ``fp`` within ``distance`` bits."""
    rows = _bucketed(prints, distance, max_bucket)
    rows = rows.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(partial(_link_partition, distance=distance), "u long, v long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4,
    max_bucket: int = 100_000, payload: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``fp``, ``component_id`` (least id of its component)
    and ``chosen`` (true for one row of each component, the one of the least id).

    With ``payload`` the columns of ``docs`` come along as the struct ``doc``."""
    body = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if payload else F.lit(None).cast("int")
    rows = docs.select(F.col(doc_id).alias("id"), body.alias("doc"), F.col(text).cast("string").alias("text"))
    rows = fingerprints(rows, "text", words).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "simhash-rows")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "row"))).alias("a"), F.min("row").alias("r")
    prints = stored(rows.groupBy("fp").agg(*first), "simhash-prints")
    found = stored(links(prints.select("fp"), distance, max_bucket), "simhash-links")
    roots = components(found)
    roots = prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "a", "r", F.coalesce("root", "fp").alias("root")
    )
    heads = roots.groupBy("root").agg(F.min("a").alias("head"), F.min("r").alias("least"))
    heads = stored(
        roots.select("fp", "root").join(heads, "root").select(
            F.col("fp").alias("fp_"),
            F.col("head.id").alias("component_id"),
            F.coalesce("head.row", "least").alias("head_row"),
        ),
        "simhash-heads",
    )
    out = rows.join(heads, F.col("fp") == F.col("fp_"), "left")
    return out.select(
        F.col("id").alias("doc_id"), "doc", "fp", "component_id", (F.col("row") == F.col("head_row")).alias("chosen")
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, with its columns only."""
    return near_duplicates(docs, payload=True, **options).where("chosen").select("doc.*")
