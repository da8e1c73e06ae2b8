"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is the sequence of its turns' digests (128 bits of role and text). Sorted, conversations that
share their first turns are neighbours, and two neighbours share as many turns as their sequences have in common.
Each task holds one range of the sorted sequences and joins neighbours in descending order of what they share:
every join of two components makes a branching node, and the nodes without branches lie between it and
the components' own. What lies on the path of a range's first or last sequence may go on in other ranges: such
nodes leave the task as parts, and the forests of all ranges, contracted to these, are merged by node in Spark.

Sequences are cut into segments of ``segment`` turns, so no row grows with a conversation: segment k is sorted
under the hash of all turns before it, each such prefix has a trie of its own, and a trie's sums are handed to all nodes above
it through the conversation that stands for it (suffix sums along that conversation).
Copies of one conversation spread over ranges, as its id is part of the order.

What stays in one task, as a stream and without being held: the segment hashes of one conversation, and the ids
of conversations that end at one node, since a digest runs over them in order.

Defined cases: null roles and texts are empty; rows without a conversation id belong to none and are left
out; repeated rows are turns each; ties of ``turn`` stand by role, then text; an empty table has no nodes, not even
the root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callweave.llm.common import small, stored, text_or_empty

SEGMENT = 64
RANGE_ROWS = 20_000  # segments that one task sorts and joins
NO_PREFIX = bytes(16)
DIGEST = 16


# --------------------------------------------------------------------------
# Turns as digests with their place
# --------------------------------------------------------------------------
def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, ...) with the number of their range and their place, from 0, among the conversation's rows in it."""
    from pyspark import TaskContext

    part, who, place = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        places = []
        for conv in batch.column(0).to_pylist():
            place = place + 1 if conv == who else 0
            who = conv
            places.append(place)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())],
            names=[*batch.schema.names, "part", "place"],
        )


def number_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, pos, digest, bytes)``: turns in order from 0; ranges are cut within long conversations, too."""
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text")
    )
    ordered = rows.repartitionByRange("conv", "turn", "role").sortWithinPartitions("conv", "turn", "role", "text")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    lean = ordered.select("conv", F.unhex(F.md5(said)).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    placed = stored(lean.mapInArrow(_places, "conv long, digest binary, bytes long, part int, place long"), "trie-turns")
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    # a range begins within one conversation at most, so these are no more than the ranges
    offsets = parts.select("conv", "part", F.sum("n").over(earlier).alias("before")).where("before is not null")
    joined = placed.join(small(stored(offsets, "trie-offsets")), ["conv", "part"], "left")
    return joined.select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes")


# --------------------------------------------------------------------------
# Segments
# --------------------------------------------------------------------------
def node_hash(seg: Column, prefix: Column, key: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.unhex(F.lpad(F.hex(seg), 16, "0")), prefix, key)))


def _first_hash(seg: int, prefix: bytes):
    return hashlib.md5(seg.to_bytes(8, "big") + prefix)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (conv, seg, key) in order to (conv, seg, prefix): the hash of all turns before each."""
    who, prefix = None, NO_PREFIX
    for batch in batches:
        prefixes = []
        for conv, seg, key in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if conv != who:
                who, prefix = conv, NO_PREFIX
            prefixes.append(prefix)
            node = _first_hash(seg, prefix)
            node.update(key)
            prefix = node.digest()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prefixes, pa.binary())], ["conv", "seg", "prefix"])


def segments(turns: DataFrame, conversations: DataFrame, segment: int) -> DataFrame:
    """``(conv, seg, prefix, key, sizes, more)``; a conversation without turns has one empty segment.

    ``more``: the conversation goes on in another segment."""
    seg = F.floor(F.col("pos") / segment).cast("long").alias("seg")
    cut = turns.groupBy("conv", seg).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "bytes"))).alias("t"))
    # digests are joined as hex, since binary arrays have no join
    key = F.unhex(F.array_join(F.transform("t.digest", F.hex), ""))
    cut = cut.select("conv", "seg", key.alias("key"), F.col("t.bytes").alias("sizes"))
    empty = conversations.select("conv").distinct().join(turns.where("pos = 0").select("conv"), "conv", "left_anti").select(
        "conv", F.lit(0).cast("long").alias("seg"), F.lit(b"").alias("key"), F.array().cast("array<long>").alias("sizes")
    )
    cut = stored(cut.unionByName(empty), "trie-cut")
    long = cut.where("seg > 0").groupBy("conv").agg(F.max("seg").alias("last"))
    linked = cut.join(small(stored(long, "trie-long")), "conv").select("conv", "seg", "key", "last")
    chained = linked.select("conv", "seg", "key").repartition("conv").sortWithinPartitions("conv", "seg")
    prefixes = chained.mapInArrow(_chain, "conv long, seg long, prefix binary").join(linked, ["conv", "seg"])
    prefixes = stored(prefixes.select("conv", "seg", "prefix", (F.col("seg") < F.col("last")).alias("more")), "trie-prefixes")
    found = cut.join(small(prefixes), ["conv", "seg"], "left")
    return found.select(
        "conv", "seg", F.coalesce("prefix", F.lit(NO_PREFIX)).alias("prefix"), "key", "sizes", F.coalesce("more", F.lit(False)).alias("more")
    )


# --------------------------------------------------------------------------
# One range
# --------------------------------------------------------------------------
NODE, PART, END = 0, 1, 2
_FOREST = (
    "kind int, hash binary, parent binary, parent_conv long, conv long, seg long, depth int, n long, kids long, "
    "leaves long, saved long, bytes long, more boolean, ends string, path array<binary>"
)


def ids_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


class _Component:
    """Neighbouring segments that share their first ``depth`` turns, and the node at that depth."""

    __slots__ = ("low", "high", "depth", "n", "conv", "kids", "leaves", "saved", "more", "ends", "below")

    def __init__(self, row: int, depth: int, conv: int, more: bool):
        self.low = self.high = row
        self.depth, self.n, self.conv, self.more = depth, 1, conv, more
        self.kids = self.leaves = self.saved = 0  # of children that lie wholly in this range
        self.ends = [] if more else [conv]
        self.below: list[int] = []

    def join(self, other: _Component) -> None:
        """Two components at the same node become one; ``other`` follows."""
        self.high = other.high
        self.n += other.n
        self.conv = min(self.conv, other.conv)
        self.kids += other.kids
        self.leaves += other.leaves
        self.saved += other.saved
        self.more |= other.more
        big, less = (self.ends, other.ends) if len(self.ends) >= len(other.ends) else (other.ends, self.ends)
        big += less
        self.ends = big
        big, less = (self.below, other.below) if len(self.below) >= len(other.below) else (other.below, self.below)
        big += less
        self.below = big


def range_forest(rows: list[tuple]) -> list[list]:
    """Nodes of the tries over sorted segments ``(seg, prefix, key, conv, sizes, more)``; see ``_FOREST``."""
    out: list[list] = []
    last = len(rows) - 1
    hashes: dict[int, list[bytes]] = {}

    def path(row: int) -> list[bytes]:
        """Hashes of the nodes along a segment."""
        if row not in hashes:
            seg, prefix, key = rows[row][:3]
            node = _first_hash(seg, prefix)
            found = [node.digest()]
            for at in range(0, len(key), DIGEST):
                node.update(key[at : at + DIGEST])
                found.append(node.digest())
            hashes[row] = found
        return hashes[row]

    def close(c: _Component) -> None:
        """Write the component's node and go one turn up."""
        seg, prefix, _, _, sizes, _ = rows[c.low]
        nodes, d = path(c.low), c.depth
        # the first turn of a later segment hangs on the node that the prefix leads to
        own = [nodes[d] if d or not seg else prefix, None if not d else nodes[d - 1] if d > 1 or not seg else prefix]
        size = sizes[d - 1] if d else 0
        at = len(out)
        if c.low == 0 or c.high == last:
            out.append([PART, *own, None, c.conv, seg, d, c.n, c.kids, c.leaves, c.saved, size, c.more, None, nodes[: d + 1]])
            out.extend([END, own[0], None, None, conv, seg, d, *[None] * 8] for conv in c.ends)
            gone = (0, 0, 0)
        else:
            leaves, saved = c.leaves + int(not c.kids and not c.more), c.saved + (c.n - 1) * size
            out.append([NODE, *own, None, c.conv, seg, d, c.n, c.kids, leaves, saved, size, c.more, ids_digest(c.ends), None])
            if d or not seg:  # else the node is one of the segment before, which may have more members
                for k in c.below:
                    out[k][3] = c.conv
            gone = (1, leaves, saved)
        c.depth, c.ends, c.below, c.more = d - 1, [], [at], False
        c.kids, c.leaves, c.saved = gone

    def lift(c: _Component, depth: int) -> _Component:
        while c.depth > depth:
            close(c)
        return c

    # what neighbours share; -1 between tries
    edges = []
    for i in range(last):
        (sa, pa_, a), (sb, pb, b) = rows[i][:3], rows[i + 1][:3]
        shared = -1
        if sa == sb and pa_ == pb:
            shared, most = 0, min(len(a), len(b))
            if a[:most] == b[:most]:
                shared = most // DIGEST
            else:
                while a[DIGEST * shared : DIGEST * (shared + 1)] == b[DIGEST * shared : DIGEST * (shared + 1)]:
                    shared += 1
        edges.append((-shared, i))
    edges.sort()
    found = {i: _Component(i, len(r[2]) // DIGEST, r[3], r[5]) for i, r in enumerate(rows)}
    up = list(range(len(rows)))  # the first row of each component stands for it

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for less, i in edges:
        if less <= 0:
            a, b = root(i), root(i + 1)
            lift(found[a], -less).join(lift(found.pop(b), -less))
            up[b] = a
    for c in found.values():
        lift(c, -1)
    return out


def _forest_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(6)))]
    if rows:
        found = range_forest(rows)
        for a in range(0, len(found), 10_000):
            columns = zip(*found[a : a + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("hash", pa.binary()), ("parent", pa.binary()), ("parent_conv", pa.int64()), ("conv", pa.int64()),
        ("seg", pa.int64()), ("depth", pa.int32()), ("n", pa.int64()), ("kids", pa.int64()), ("leaves", pa.int64()),
        ("saved", pa.int64()), ("bytes", pa.int64()), ("more", pa.bool_()), ("ends", pa.string()), ("path", pa.list_(pa.binary())),
    ]
)


# --------------------------------------------------------------------------
# All ranges
# --------------------------------------------------------------------------
def _ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (hash, conv) to the digest of each hash's ids, as a stream."""
    node, state = None, None
    for batch in batches:
        out: list[tuple] = []
        for h, conv in zip(*(batch.column(k).to_pylist() for k in range(2))):
            if h != node:
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = h, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())], ["hash", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["hash", "ends"])


def _merged(forest: DataFrame) -> DataFrame:
    """The nodes that ranges share, from their parts."""
    parts = forest.where(F.col("kind") == PART)
    sums = parts.groupBy("hash", "depth").agg(
        *(F.min(c).alias(c) for c in ("parent", "conv", "seg", "bytes", "path")),
        *(F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")), F.max("more").alias("more"),
    )
    sums = stored(sums, "trie-parts")
    children = sums.where("depth > 0").groupBy(F.col("parent").alias("hash"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("shared"))
    whole = sums.join(children, ["hash", "depth"], "left").withColumn("kids", F.col("kids") + F.coalesce("shared", F.lit(0)))
    leaf = F.when((F.col("kids") == 0) & ~F.col("more"), 1).otherwise(0)
    whole = whole.withColumns({"own_leaves": F.col("leaves") + leaf, "own_saved": F.col("saved") + (F.col("n") - 1) * F.col("bytes")})
    whole = stored(whole.drop("shared", "leaves", "saved"), "trie-whole")
    above = whole.select(F.posexplode("path").alias("depth", "node"), "own_leaves", "own_saved", "seg", "path")
    # a later segment's trie begins at the node its prefix leads to, whose hash is not the first of the path
    totals = above.groupBy("node").agg(F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved"))
    whole = whole.join(totals, F.element_at("path", -1) == F.col("node")).drop("node")
    ended = forest.where(F.col("kind") == END).select("hash", "conv").repartition("hash").sortWithinPartitions("hash", "conv")
    digests = stored(ended.mapInArrow(_ends_digests, "hash binary, ends string"), "trie-ends")
    nothing = F.lit(ids_digest([]))
    whole = whole.join(digests, "hash", "left").withColumn("ends", F.coalesce("ends", nothing))
    return whole.withColumn("parent_conv", F.lit(None).cast("long"))


def prefix_trie(turns: DataFrame, conversations: DataFrame, segment: int = SEGMENT, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per node: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    ``turns``: (conv, pos, digest, bytes), places gapless from 0; ``conversations``: (conv), all of them, so that those without
    turns are members of the root. ``saved_tokens`` sums, over the subtree, a node's further members times the bytes of its last turn."""
    cut = stored(segments(turns, conversations, segment), "trie-segments")
    spark = cut.sparkSession
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cut.count() // range_rows))
    order = ["seg", "prefix", "key", "conv"]
    ordered = cut.select(*order, "sizes", "more").repartitionByRange(many, *order).sortWithinPartitions(*order)
    forest = stored(ordered.mapInArrow(partial(_forest_batches, schema=_ARROW), _FOREST), "trie-forest")
    columns = ["hash", "parent", "parent_conv", "conv", "seg", "depth", "n", "kids", "leaves", "saved", "ends", "more"]
    merged = stored(_merged(forest).select(*columns), "trie-merged")
    nodes = forest.where(F.col("kind") == NODE).select(*columns).unionByName(merged)

    # tries of later segments: their root is the node that the prefix leads to
    roots = nodes.where("depth = 0 and seg > 0").select("hash", "conv", "seg", "kids", "leaves", "saved")
    later = stored(roots, "trie-roots")
    owned = cut.where("seg > 0").select("conv", "seg").join(later.select("conv", "seg", "leaves", "saved"), ["conv", "seg"], "left")
    below = W.partitionBy("conv").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, 0)
    carried = owned.select("conv", (F.col("seg") - 1).alias("seg"), F.sum("leaves").over(below).alias("leaves"), F.sum("saved").over(below).alias("saved"))
    carried = carried.where("leaves is not null").join(cut.select(*order), ["conv", "seg"])
    steps = carried.select("seg", "prefix", "key", "leaves", "saved", F.explode(F.sequence(F.lit(0), F.floor(F.octet_length("key") / DIGEST).cast("int"))).alias("d"))
    steps = steps.where("d > 0 or seg = 0")
    hashed = node_hash(F.col("seg"), F.col("prefix"), F.expr(f"substring(key, 1, {DIGEST} * d)"))
    zero = F.lit(0).cast("long")
    extra = steps.select(hashed.alias("hash"), zero.alias("kids"), "leaves", "saved").unionByName(later.select("hash", "kids", zero.alias("leaves"), zero.alias("saved")))
    extra = extra.groupBy("hash").agg(*(F.sum(c).alias(f"more_{c}") for c in ("kids", "leaves", "saved")))
    extra = small(stored(extra, "trie-extra"))

    kept = nodes.where("depth > 0 or seg = 0").withColumn("depth", (F.col("seg") * segment + F.col("depth")).cast("long"))
    kept = kept.join(extra, "hash", "left")
    # parents in another range or segment
    ends = kept.where(F.col("more_kids") > 0).select(F.col("hash").alias("parent"), F.col("conv").alias("above"))
    shared = merged.where("depth > 0 or seg = 0").select(F.col("hash").alias("parent"), F.col("conv").alias("above"))
    parents = small(stored(ends.unionByName(shared).distinct(), "trie-parents"))
    known = kept.where("parent_conv is not null or parent is null")
    open_ = kept.where("parent_conv is null and parent is not null").join(parents, "parent", "left")
    open_ = open_.withColumn("parent_conv", F.col("above")).select(*known.columns)
    plus = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).cast("long")
    return known.unionByName(open_).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        plus("kids").alias("n_children"), plus("leaves").alias("n_leaves"), plus("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
