"""The trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import difference, tables

from callweave.llm import conversation_trie as trie
from callweave.llm.queries import ORACLES, QUERIES, rebuilt_conversations

TURNS = "conv_id long, turn long, role string, text string, digest string, part int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        own = (len(who) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += own
    out = []
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        out.append((
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[1], r[0]))


def rows_of(found):
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=lambda r: (r[1], r[0]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], TURNS)


def random_rows(rng, convs=60, longest=12):
    rows, said = [], []
    for c in range(convs):
        n = rng.randint(1, longest)
        own = [(rng.choice("ua"), rng.choice(["", "é", "b", "cc"])) for _ in range(n)]
        if said and rng.random() < 0.7:  # like an earlier one, at first or wholly
            other = rng.choice(said)
            k = rng.randint(0, len(other))
            own = other[:k] + (own if rng.random() < 0.5 else [])
            own = own or other[:1]
        said.append(own)
        rows += [(c * 3 % 101, k, r, t) for k, (r, t) in enumerate(own)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "segment", "range_rows"), [(1, 64, 20_000), (2, 3, 5), (4, 2, 1)])
def test_random_conversations(spark, seed, segment, range_rows):
    rows = random_rows(random.Random(seed))
    turns = trie.number_turns(frame(spark, rows).repartition(3))
    found = trie.prefix_trie(turns, turns.select("conv"), segment, range_rows)
    assert rows_of(found) == brute_trie(ordered(rows))


def test_rebuilt_conversations(spark):
    rows = random_rows(random.Random(9), 40, 14)
    turns = trie.number_turns(frame(spark, rows))
    assert rows_of(trie.prefix_trie(*rebuilt_conversations(turns), 4, 8)) == brute_trie(rebuilt(ordered(rows)))


def test_odd_rows(spark):
    rows = [(None, 1, "u", "a"), (1, None, "u", "n"), (1, 0, None, None), (1, 1, "", ""), (2, None, "u", "n"), (2, 0, "", "")]
    rows += [(2, 0, "", "")] * 3 + [(-4, 5, "u", "é" * 50_000), (7, 5, "u", "é" * 50_000)] + [(8, k, "u", "w") for k in range(300)]
    turns = trie.number_turns(frame(spark, rows))
    ids = turns.select("conv").unionByName(spark.createDataFrame([(77,), (77,), (1,)], "conv long"))
    want = {**ordered(rows), 77: []}
    assert rows_of(trie.prefix_trie(turns, ids)) == brute_trie(want)
    none = trie.number_turns(frame(spark, rows).where("false"))
    assert rows_of(trie.prefix_trie(none, none.select("conv"))) == []
    assert rows_of(trie.prefix_trie(none, ids.where("conv = 77"))) == brute_trie({77: []})


def test_copies_spread_over_ranges(spark):
    rows = [(c, k, "u", str(k)) for c in range(300) for k in range(3 if c % 3 else 5)]
    turns = trie.number_turns(frame(spark, rows).repartition(4))
    assert rows_of(trie.prefix_trie(turns, turns.select("conv"), 2, 20)) == brute_trie(ordered(rows))


def test_one_range():
    key = [bytes([k]) * 16 for k in range(4)]
    paths = [[0], [0, 1], [2, 1], [2, 1], [3]]
    rows = sorted((0, trie.NO_PREFIX, b"".join(key[k] for k in p), c, [5] * len(p), False) for c, p in enumerate(paths))
    found = trie.range_forest(rows)
    # the first and the last path may go on elsewhere; below the inner ones all is known
    nodes = sorted((r[6], r[4], r[3], *r[7:11]) for r in found if r[0] == trie.NODE)
    assert nodes == [(1, 2, None, 2, 1, 1, 10), (2, 1, None, 1, 0, 1, 0), (2, 2, 2, 2, 0, 1, 5)]
    assert sorted((r[6], r[4], *r[7:11]) for r in found if r[0] == trie.PART) == [(0, 0, 5, 1, 1, 10), (1, 0, 2, 1, 1, 0), (1, 4, 1, 0, 0, 0)]
    assert sorted((r[6], r[4]) for r in found if r[0] == trie.END) == [(1, 0), (1, 4)]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_conversation_trie"](spark, sf_dir)) == brute_trie(rebuilt(ordered(rows)))
    name = "op12_conversation_trie"
    assert difference(spark, tables(sf_dir), sf_dir, QUERIES[name], ORACLES[name]) is None
