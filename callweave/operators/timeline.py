"""One ordered timeline per subscriber over the three record types."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.session import work_path
from callweave.specs import TIME_FORMAT, RecordSpec, spec_for

# Records of equal time stand in this order.
SOURCE_ORDER = ("cdr", "ipdr", "edr")
SORT_KEYS = ("subscriber", "ts", "source_rank", "payload")


def timeline_entries(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Clean rows of one type in the common shape, the whole row as JSON payload."""
    shown = [
        F.date_format(f, TIME_FORMAT).alias(f) if spec.kind(f) == "timestamp" else F.col(f) for f in spec.fields
    ]
    return df.select(
        F.col(spec.subscriber).alias("subscriber"),
        F.col(spec.event_time).alias("ts"),
        F.lit(spec.name).alias("source"),
        F.lit(SOURCE_ORDER.index(spec.name)).alias("source_rank"),
        F.col("is_fraud"),
        F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}).alias("payload"),
    )


def merge_entries(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [timeline_entries(tables[n], spec_for(n)) for n in SOURCE_ORDER if n in tables]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def subscriber_timeline(tables: dict[str, DataFrame]) -> DataFrame:
    """All records in order of subscriber and time.

    Range partitioning on the full sort key spreads a subscriber with very
    many records (such as the id that stands for all missing ids) over several
    tasks, which hashing by subscriber would not.
    """
    return merge_entries(tables).orderBy(*SORT_KEYS).drop("source_rank")


def numbered_timeline(tables: dict[str, DataFrame]) -> DataFrame:
    """As ``subscriber_timeline`` with ``seq``, each record's place in its timeline.

    The range-partitioned order is written to the shared folder with each row's partition and
    place in it, counted along the sorted rows. A subscriber who goes on in later partitions gets the
    sizes of the earlier ones added. Payloads are shuffled once, and no task ever holds more of a
    subscriber than one partition does. The table lives as long as the result is read from it.
    """
    entries = merge_entries(tables)
    spark = entries.sparkSession
    path = work_path(spark, "timeline")
    placed = T.StructType([*entries.schema.fields, T.StructField("slice", T.IntegerType()), T.StructField("place", T.LongType())])
    ordered = entries.repartitionByRange(*SORT_KEYS).sortWithinPartitions(*SORT_KEYS)
    ordered.mapInArrow(_places, placed).write.parquet(path)
    rows = spark.read.schema(placed).parquet(path)
    slices = rows.groupBy("subscriber", "slice").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("subscriber").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # a slice begins in the middle of one subscriber at most, so these are no more than the slices
    offsets = slices.select(
        F.col("subscriber").alias("_who"), F.col("slice").alias("_slice"), F.sum("size").over(earlier).alias("_before")
    ).where("_before is not null")
    same = F.col("subscriber").eqNullSafe(F.col("_who")) & (F.col("slice") == F.col("_slice"))
    return rows.join(F.broadcast(offsets), same, "left").select(
        "subscriber",
        (F.coalesce("_before", F.lit(0)) + F.col("place")).alias("seq"),
        "ts",
        "source",
        "is_fraud",
        "payload",
    )


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the number of their partition and their place, from 1, among the
    subscriber's rows in it."""
    from pyspark import TaskContext

    part, who, place = TaskContext.get().partitionId(), object(), 0
    for batch in batches:
        many = batch.num_rows
        if not many:
            continue
        codes = batch.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1])
        runs = np.diff(np.append(starts, many))
        places = np.arange(1, many + 1, dtype=np.int64) - np.repeat(starts, runs)
        if batch.column(0)[0].as_py() == who:  # goes on from the batch before
            places[: runs[0]] += place
        who, place = batch.column(0)[many - 1].as_py(), int(places[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(many, part, np.int32)), pa.array(places)],
            names=[*batch.schema.names, "slice", "place"],
        )


def fraud_alerts(df: DataFrame) -> DataFrame:
    """Clean rows flagged as fraud; works on streams and tables."""
    return df.where(F.col("is_fraud"))
