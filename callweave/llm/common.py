"""Helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import work_path

#: Rows up to which a table may be broadcast; past it Spark joins by shuffle.
BROADCAST_ROWS = 200_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and a
    lost executor costs no recomputation of what came before."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, *keep: str, **columns: Column) -> DataFrame:
    """``keep`` plus ``columns``, each computed once per row: a generator is not
    merged into later projections, so no later use repeats the work."""
    body = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select(*keep, F.inline(F.array(body)))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is.

    For stored tables of numbers: the count reads only their footers."""
    return F.broadcast(df) if df.count() <= rows else df


def released(make: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``make``, which makes a task's batches; behind them Arrow's unused memory goes back to the machine.

    Spark keeps idle Python workers, and beside them the next job's JVM wants its whole heap."""

    @wraps(make)
    def batches(*args, **options):
        try:
            yield from make(*args, **options)
        finally:
            pa.default_memory_pool().release_unused()

    return batches


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves no remainder by 5; a null id counts as its text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0
