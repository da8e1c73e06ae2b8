"""De-duplication over whole rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each row. Copies fold within each task before the shuffle, so a
    row that makes up a large share of the data arrives once per task."""
    return df.dropDuplicates()


#: Column of ``with_copies``.
COPIES = "_copies"


def with_copies(df: DataFrame, sums: Sequence[str] = ()) -> DataFrame:
    """As ``distinct_rows``, with the number of copies each row had and, of the columns ``sums``, which
    do not tell rows apart, the sum over the copies."""
    keys = [c for c in df.columns if c not in sums]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(COPIES), *[F.sum(c).alias(c) for c in sums])


def _fold_batches(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        folded = table.group_by(columns, use_threads=False).aggregate([])
        yield from folded.select(columns).cast(table.schema).to_batches()


def fold_copies(df: DataFrame) -> DataFrame:
    """Drop copies within each Arrow batch, without shuffle or state.

    The streaming de-duplication has no map-side step of its own: a hot row
    would send every copy to one state partition. This is that step.
    """
    return df.mapInArrow(partial(_fold_batches, columns=df.columns), df.schema)


#: Columns of ``with_row_key``.
ROW_KEY = ("_key_high", "_key_low")


def with_row_key(df: DataFrame) -> DataFrame:
    """``df`` with 128 bits that stand for the whole row, nulls included, in two columns."""
    # the hash passes over nulls, so whether there is one is a value of its own
    values = [part for c in df.columns for part in (F.col(c).isNull(), F.col(c))]
    high, low = F.xxhash64(F.lit("high"), *values), F.xxhash64(F.lit("low"), *values)
    return df.withColumns(dict(zip(ROW_KEY, (high, low))))


def distinct_stream(
    df: DataFrame,
    event_time: str | None = None,
    delay: str | None = None,
    fold_first: bool = True,
) -> DataFrame:
    """One of each row across the micro-batches of a stream.

    The state holds 128 bits for each row seen, not the row (and, with ``delay``, when it may go).
    Without ``delay`` every row ever seen stays in the state store and late
    rows are never refused. With ``delay`` the state of a row is let go once
    the watermark on ``event_time`` passes it, and rows later than that are
    dropped: bounded state for streams that run for months.
    """
    if delay is not None and event_time is None:
        raise ValueError("a delay needs the event-time column")
    rows = with_row_key(fold_copies(df) if fold_first else df)
    if delay is None:
        return rows.dropDuplicates(list(ROW_KEY)).drop(*ROW_KEY)
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(ROW_KEY)).drop(*ROW_KEY)
