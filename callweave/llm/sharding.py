"""Sharding by longest-processing-time scheduling.

Documents of equal text form a group that stays together. Groups go to shards in falling
order of their bytes, each to the least-loaded shard. The schedule depends on the multiset of
groups alone, so it runs over classes (document size, copies) with their counts: for a class of
many equal groups the heap's choices follow from the shards' loads in closed form.
Classes are few: distinct sizes of texts summing to B bytes number at most about sqrt(2 B). They pass through the
driver in order as a stream and are not held there.
Ranks of groups in a class are counted in salted pieces and copies of a group per task of the
table, so neither a frequent size nor a group with a large share of all rows meets in one task.

Defined cases: null texts are empty and equal to empty ones; ids may be null or repeated; an
empty table gives no rows; ties go to the lower shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callweave.llm.common import small, stored, text_or_empty
from callweave.session import work_path

PLAN_ROWS = 50_000  # classes written at a time
PIECE = 20_000  # rows of one key that are numbered together


def deal_equal(loads: list[int], weight: int, many: int) -> list[int]:
    """How many of ``many`` groups of equal ``weight`` each shard gets if each in turn goes to the
    least-loaded shard, the lower one on ties."""
    shards = len(loads)
    if many <= 2 * shards:
        heap = [(load, k) for k, load in enumerate(loads)]
        heapq.heapify(heap)
        got = [0] * shards
        for _ in range(many):
            load, k = heap[0]
            got[k] += 1
            heapq.heapreplace(heap, (load + weight, k))
        return got

    def below(level: int) -> list[int]:  # choices made at a load under ``level``
        return [max(0, -((load - level) // weight)) for load in loads]

    low, high = min(loads), max(loads) + weight * (many + 1)
    while low < high:
        middle = (low + high + 1) // 2
        if sum(below(middle)) <= many:
            low = middle
        else:
            high = middle - 1
    got = below(low)
    rest = many - sum(got)
    for k in range(shards):
        if rest and loads[k] + weight * got[k] == low:
            got[k] += 1
            rest -= 1
    return got


def schedule(classes: Iterable[tuple[int, int, int]], shards: int) -> Iterator[tuple[int, int, int, list[int], list[int]]]:
    """Classes (size, copies, groups), in falling order of a group's bytes, with the first rank and the first slot of
    each shard. What is held is one number of bytes and of rows per shard, however many classes there are."""
    loads, slots = [0] * shards, [0] * shards
    for size, copies, groups in classes:
        got = deal_equal(loads, size * copies, groups)
        base, at, ranks = list(slots), 0, []
        for k, n in enumerate(got):
            ranks.append(at)
            at += n
            loads[k] += n * size * copies
            slots[k] += n * copies
        yield size, copies, groups, ranks, base


def _planned(classes: DataFrame, shards: int) -> DataFrame:
    """The schedule as a table. Sorted classes pass through the driver as a stream, part by part, and are written in
    parts of ``PLAN_ROWS``."""
    spark = classes.sparkSession
    path = work_path(spark, "sharding-plan")
    schema = "size long, copies long, groups long, first array<long>, base array<long>"
    weight = F.col("size") * F.col("copies")
    ordered = stored(classes, "sharding-classes").orderBy(weight.desc(), F.col("size").desc())
    dealt = schedule((tuple(r) for r in ordered.select("size", "copies", "groups").toLocalIterator()), shards)
    part = list(islice(dealt, PLAN_ROWS))
    spark.createDataFrame(part, schema).write.parquet(path)
    while part := list(islice(dealt, PLAN_ROWS)):
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _numbered(df: DataFrame, keys: list[str], many: Column, order: str, out: str, label: str) -> DataFrame:
    """``df`` with ``out``: a gapless number from 0 within ``keys``, by salted pieces of ``order``.

    ``many`` is the known number of rows of the row's key."""
    pieces = F.ceil(many / PIECE).cast("int")
    df = df.withColumn("piece", F.pmod(F.xxhash64(order), pieces).cast("int"))
    counts = df.where(pieces > 1).groupBy(*keys, "piece").agg(F.count(F.lit(1)).alias("n_"))
    # one row per piece of keys with more than one
    before = F.sum("n_").over(W.partitionBy(*keys).orderBy("piece").rowsBetween(W.unboundedPreceding, -1))
    offsets = small(stored(counts.select(*keys, "piece", before.alias("before_")), label))
    own = F.row_number().over(W.partitionBy(*keys, "piece").orderBy(order)) - 1
    df = df.withColumn(out, own).join(offsets, [*keys, "piece"], "left")
    return df.withColumn(out, (F.col(out) + F.coalesce("before_", F.lit(0))).cast("long")).drop("piece", "before_")


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, key, shard, slot)`` per row; ``size`` is the text's bytes and one more."""
    body = text_or_empty(text)
    rows = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sharding-rows",
    )
    # copies are counted per task of the table first, so a group with many rows is never in one place
    rows = rows.withColumn("part", F.shiftright("row", 33))
    parts = stored(rows.groupBy("key", "part").agg(F.min("size").alias("size"), F.count(F.lit(1)).alias("n")), "sharding-parts")
    groups = stored(parts.groupBy("key").agg(F.min("size").alias("size"), F.sum("n").alias("copies")), "sharding-groups")
    classes = groups.groupBy("size", "copies").agg(F.count(F.lit(1)).alias("groups"))
    plan = small(_planned(classes, shards))
    ranked = _numbered(groups.join(plan, ["size", "copies"]), ["size", "copies"], F.col("groups"), "key", "rank", "sharding-ranks")
    shard = F.size(F.filter("first", lambda x: x <= F.col("rank"))) - 1
    placed = ranked.withColumn("shard", shard).select(
        F.col("key"), "copies", "shard",
        (F.element_at("base", F.col("shard") + 1) + (F.col("rank") - F.element_at("first", F.col("shard") + 1)) * F.col("copies")).alias("first_slot"),
    )
    placed = stored(placed, "sharding-placed")
    earlier = F.sum("n").over(W.partitionBy("key").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.select("key", "part", F.coalesce(earlier, F.lit(0)).alias("before")).join(placed, "key")
    starts = starts.select("key", "part", "shard", (F.col("first_slot") + F.col("before")).alias("start"))
    copy = F.row_number().over(W.partitionBy("key", "part").orderBy("row")) - 1
    numbered = rows.join(starts, ["key", "part"]).withColumn("slot", (F.col("start") + copy).cast("long"))
    return numbered.select("doc_id", "size", "text_crc32", "key", "shard", "slot")
