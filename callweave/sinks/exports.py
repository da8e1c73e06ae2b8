"""Exports as JSON, CSV and XML, plain or gzipped."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.sinks.tables import PLAIN_CSV


def export_json(df: DataFrame, path: str, gzip: bool = False) -> None:
    """One object per line, nulls written out."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.option("compression", "gzip") if gzip else writer).json(path)


def _join_arrays(batches: Iterator[pa.RecordBatch], rows_per_file: int) -> Iterator[pa.RecordBatch]:
    def array(bodies: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": ["[" + ",".join(bodies) + "]"]})

    waiting: list[str] = []
    for batch in batches:
        waiting += batch.column(0).to_pylist()
        while len(waiting) >= rows_per_file:
            yield array(waiting[:rows_per_file])
            waiting = waiting[rows_per_file:]
    if waiting:
        yield array(waiting)


def export_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000, gzip: bool = False) -> None:
    """Files that are one JSON array of at most ``rows_per_file`` objects each.

    Arrays are put together within each partition, without a shuffle; the row
    limit bounds what a task holds. One map column is taken as the object.
    """
    if len(df.columns) == 1 and isinstance(df.schema[0].dataType, T.MapType):
        body = F.to_json(df.columns[0])
    else:
        body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    join = partial(_join_arrays, rows_per_file=rows_per_file)
    arrays = df.select(body.alias("body")).mapInArrow(join, "value string")
    # The text writer cannot name its files .json, the CSV writer can. JSON text holds
    # neither raw control characters nor line ends, so one plain column needs no quoting.
    writer = (
        arrays.write.mode("overwrite")
        .option("maxRecordsPerFile", 1)
        .option("extension", "json")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escape", "")
        .option("header", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
    )
    (writer.option("compression", "gzip") if gzip else writer).csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Header and all columns, nulls empty."""
    df.write.mode("overwrite").options(header="true", **PLAIN_CSV).csv(path)


def export_xml(df: DataFrame, path: str, root_tag: str, row_tag: str) -> None:
    """One element per row; nulls are left out, booleans lower case."""
    df.write.mode("overwrite").format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)
