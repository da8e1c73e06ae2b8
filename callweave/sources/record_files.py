"""Readers for record files: JSON, CSV, XML, gzipped JSON and zipped CSV.

Each reader lists files below ``paths`` by a name pattern, keeps those whose
path routes to the record type (the filter is on file metadata, so other files
are pruned before any is opened) and returns ragged ``record`` maps in record
order with their ``path``.

JSON arrays, gzip, zip and XML files count whole or not at all: content that cannot be parsed, for whatever reason, gives
one row with an ``error`` instead of records. Errors of storage are not caught; they fail the task, which Spark runs again.
Files above ``WHOLE_LIMIT`` bytes are read as streams (``sources.splits``), JSON arrays by many tasks each.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from callweave.operators.naming import column_places, resolve_records, resolve_values
from callweave.session import work_path
from callweave.sources import content, splits
from callweave.sources.listing import record_type_of, suffix_glob
from callweave.specs import RecordSpec

PATH = "_metadata.file_path"
#: Bytes up to which a file is held as one value.
WHOLE_LIMIT = 64_000_000
#: Records of a file that are held until its end is known to be sound; longer files are parsed twice.
HELD_ROWS = 100_000
#: Files up to which their list of headers is broadcast; past it Spark joins by shuffle.
BROADCAST_FILES = 200_000


def _reader(spark: SparkSession, glob: str) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)


def _routed(df: DataFrame, spec: RecordSpec | None) -> DataFrame:
    return df if spec is None else df.where(record_type_of(F.col(PATH)) == spec.name)


# --------------------------------------------------------------------------
# Files read whole
# --------------------------------------------------------------------------
_PARSED = "path string, record map<string,string>, error string"
_ARROW_RECORD = pa.map_(pa.string(), pa.string())
_ROWS_PER_BATCH = 10_000


def record_batch(path: str, records: list, error: str | None = None) -> pa.RecordBatch:
    n = len(records)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * n, pa.string()), pa.array(records, _ARROW_RECORD), pa.array([error] * n, pa.string())],
        names=["path", "record", "error"],
    )


def _kinds(row_tag: str | None) -> dict[str, Callable[[content.Chunks], Iterator[content.Pairs]]]:
    return {
        "json": content.json_records,
        "gzip_json": content.gzip_records,
        "zip_csv": content.zip_records,
        "xml": partial(content.xml_records, row_tag=row_tag),
    }


def _parse(batches: Iterator[pa.RecordBatch], kind: str, row_tag: str | None) -> Iterator[pa.RecordBatch]:
    rows_of = _kinds(row_tag)[kind]
    for files in batches:
        for path, data in zip(files.column(0), files.column(1)):
            path, data = path.as_py(), data.as_py()
            rows: list[content.Pairs] = []
            held = True
            try:  # to its end before any row goes out, so that a damaged file gives none
                for row in rows_of(content.chunks_of(data)):
                    if held:
                        rows.append(row)
                        held = len(rows) <= HELD_ROWS
                        if not held:
                            rows.clear()
            except Exception as bad:  # of content in memory, so never one of storage
                yield record_batch(path, [None], content.fault(bad))
                continue
            if held:
                for a in range(0, len(rows), _ROWS_PER_BATCH):
                    yield record_batch(path, rows[a : a + _ROWS_PER_BATCH])
                continue
            for row in rows_of(content.chunks_of(data)):
                rows.append(row)
                if len(rows) == _ROWS_PER_BATCH:
                    yield record_batch(path, rows)
                    rows = []
            yield record_batch(path, rows)


def parse_files(files: DataFrame, kind: str, row_tag: str | None = None) -> DataFrame:
    """``(path, record, error)`` from ``(path, content)`` of files of one format."""
    return files.select("path", "content").mapInArrow(partial(_parse, kind=kind, row_tag=row_tag), _PARSED)


def scan_files(spark: SparkSession, paths: Sequence[str], glob: str) -> DataFrame:
    """Files with their bytes, not yet read; to be shared by several types."""
    return _reader(spark, glob).format("binaryFile").load(list(paths))


def read_whole(
    spark: SparkSession,
    paths: Sequence[str],
    kind: str,
    spec: RecordSpec | None = None,
    glob: str | None = None,
    scan: DataFrame | None = None,
) -> DataFrame:
    """Files of a format that counts whole as ``(path, record, error)``.

    Small files are held and parsed by one task each; larger ones, if there are any, are read as streams now,
    into a table in the shared folder."""
    glob = glob or suffix_glob(kind)
    files = _routed(scan if scan is not None else scan_files(spark, paths, glob), spec)
    small = files.where(F.col("length") <= WHOLE_LIMIT).select(F.col(PATH).alias("path"), "content")
    row_tag = spec.row_tag if spec else None
    parsed = parse_files(small, kind, row_tag)
    large = files.where(F.col("length") > WHOLE_LIMIT)
    if large.select("length").isEmpty():
        return parsed

    def pieces(separator: str) -> DataFrame:
        read = _reader(spark, glob).option("lineSep", separator)
        if kind == "gzip_json":
            read = read.option("ignoreCorruptFiles", "true")
        rows = _routed(read.text(list(paths)), spec)
        return rows.where(F.col("_metadata.file_size") > WHOLE_LIMIT)

    if kind == "json":
        return parsed.unionByName(splits.json_arrays(pieces))
    rows_of = {**_kinds(row_tag), "zip_csv": content.zip_stream_records}[kind]
    return parsed.unionByName(splits.streamed(pieces, kind, rows_of))


def _good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("record").isNotNull()).select("path", "record")


def file_errors(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("path", "error")


def read_json_arrays(
    spark: SparkSession,
    paths: Sequence[str],
    spec: RecordSpec | None = None,
    glob: str | None = None,
    scan: DataFrame | None = None,
) -> DataFrame:
    """Files that are one JSON array of objects each, as ``(path, record)``."""
    return _good(read_whole(spark, paths, "json", spec, glob, scan))


def read_gzip_json(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec | None = None, scan: DataFrame | None = None
) -> DataFrame:
    return _good(read_whole(spark, paths, "gzip_json", spec, scan=scan))


def read_zip_csv(
    spark: SparkSession,
    paths: Sequence[str],
    spec: RecordSpec | None = None,
    glob: str | None = None,
    errors: bool = False,
    scan: DataFrame | None = None,
) -> DataFrame:
    """The first entry of each zip archive as ``(path, record)``, or with ``errors`` the unreadable
    archives as ``(path, error)``."""
    parsed = read_whole(spark, paths, "zip_csv", spec, glob, scan)
    return file_errors(parsed) if errors else _good(parsed)


def read_xml_records(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec, glob: str | None = None, scan: DataFrame | None = None
) -> DataFrame:
    """XML files, one record per record element at any depth, as ``(path, record)``."""
    return _good(read_whole(spark, paths, "xml", spec, glob, scan))


def read_xml_files(spark: SparkSession, paths: Sequence[str], spec: RecordSpec) -> DataFrame:
    """XML files as standard rows with ``path``."""
    return resolve_records(read_xml_records(spark, paths, spec), spec, keep=["path"])


# --------------------------------------------------------------------------
# Files that split
# --------------------------------------------------------------------------
def scan_json_lines(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec | None = None, glob: str | None = None
) -> DataFrame:
    """``(path, record, error)`` of one object per line; a line that is none is an error row."""
    lines = _routed(_reader(spark, glob or suffix_glob("json_lines")).text(list(paths)), spec)
    parsed = lines.where(F.trim("value") != "").select(
        F.col(PATH).alias("path"), F.from_json("value", "map<string,string>").alias("record")
    )
    return parsed.withColumn("error", F.when(F.col("record").isNull(), F.lit("line is no JSON object")))


def read_json_lines(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec | None = None, glob: str | None = None
) -> DataFrame:
    """One object per line, as ``(path, record)``: the form that splits within a file."""
    return _good(scan_json_lines(spark, paths, spec, glob))


def _once_each(names: list) -> list[str]:
    """Column names of a header; of equal names the last holds the value, so earlier ones get none."""
    names = [n or "" for n in names]
    return [n if n not in names[i + 1 :] else f"\0{i}" for i, n in enumerate(names)]


def _header_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [_once_each(next(csv.reader([(header or "").removeprefix("\ufeff")]), [])) for header in batch.column("header").to_pylist()]
        columns = [batch.column(c) for c in ("path", "header", "quoted_breaks")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.list_(pa.string()))], names=["path", "header", "quoted_breaks", "names"])


def _value_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = pa.array([_once_each(x) for x in batch.column(1).to_pylist()], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), names], names=["path", "names"])


def csv_headers(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec | None = None, glob: str | None = None
) -> DataFrame:
    """``(path, header, quoted_breaks, names)`` of each CSV file, written to the shared folder.

    ``quoted_breaks`` marks files where a line holds an odd number of quotes,
    so a quoted value may run over a line end. Only those need their splits' states
    (``sources.splits``). The lines are read once for this, in splits.
    """
    lines = _routed(_reader(spark, glob or suffix_glob("csv")).text(list(paths)), spec)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    placed = lines.select(
        F.col(PATH).alias("path"),
        "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        (F.col("value").contains('"') & (quotes % 2 == 1)).alias("odd"),
    )
    # collect_set (of two values at most) makes Spark aggregate by hash; with
    # text and struct buffers alone it would sort every line by path first
    files = placed.groupBy("path").agg(
        F.min_by("value", "place").alias("header"),
        F.array_contains(F.collect_set("odd"), True).alias("quoted_breaks"),
    )
    named = files.mapInArrow(_header_names, "path string, header string, quoted_breaks boolean, names array<string>")
    target = work_path(spark, "csv-headers")
    named.write.parquet(target)
    return spark.read.schema(named.schema).parquet(target)


#: Files with quoted line ends up to which they are told apart by name, so that each scan opens its own files only.
NAMED_FILES = 1_000


def _csv_values(
    spark: SparkSession, paths: Sequence[str], spec: RecordSpec | None, glob: str | None, headers: DataFrame | None
) -> list[tuple[DataFrame, DataFrame]]:
    """Data rows ``(path, values)`` and their files' ``(path, names)``: of files whose lines are
    records, and, if there are any, of files with quoted line ends."""
    headers = csv_headers(spark, paths, spec, glob) if headers is None else headers
    glob = glob or suffix_glob("csv")
    width, broken = headers.agg(F.max(F.size("names")), F.count_if("quoted_breaks")).first()
    columns = [f"c{i}" for i in range(max(width or 0, 1))]
    named = [r[0] for r in headers.where("quoted_breaks").select("path").limit(NAMED_FILES + 1).collect()] if broken <= NAMED_FILES else None
    rows = (
        _reader(spark, glob)
        .schema(", ".join(f"{c} string" for c in columns))
        .option("header", "true")
        .option("escape", '"')
        .csv(list(paths))
    )
    rows = _routed(rows, spec)
    if named:
        rows = rows.where(~F.col(PATH).isin(named))
    values = F.array(*[F.when(F.col(c) != "", F.col(c)) for c in columns])
    plain = headers.where(~F.col("quoted_breaks") & (F.size("names") > 0)).select("path", "names")
    parts = [(rows.select(F.col(PATH).alias("path"), values.alias("values")), plain)]
    if not broken:
        return parts
    marked = headers.where("quoted_breaks").select(F.col("path").alias("_path"))

    def pieces(separator: str) -> DataFrame:
        lines = _routed(_reader(spark, glob).option("lineSep", separator).text(list(paths)), spec)
        if named is not None:
            return lines.where(F.col(PATH).isin(named))
        return lines.join(F.broadcast(marked) if broken <= BROADCAST_FILES else marked, F.col(PATH) == F.col("_path"), "left_semi")

    found = splits.split_records(pieces, splits.CsvLines)
    names = found.where("first").select("path", "record").mapInArrow(_value_names, "path string, names array<string>")
    target = work_path(spark, "csv-names")
    names.write.parquet(target)
    names = spark.read.schema(names.schema).parquet(target)
    return [*parts, (found.where("not first").select("path", F.col("record").alias("values")), names)]


def _with_header(rows: DataFrame, names: DataFrame) -> DataFrame:
    return rows.join(F.broadcast(names) if names.count() <= BROADCAST_FILES else names, "path")


def read_csv_records(
    spark: SparkSession,
    paths: Sequence[str],
    spec: RecordSpec | None = None,
    glob: str | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """CSV files with headers of their own, as ``(path, record)``; empty values are null.

    All layouts share one scan: rows are read by position and named by their file's header, which a
    join on the path brings along, so neither paths nor layouts reach the driver or the plan. Files with quoted
    line ends are read in splits by a second scan, which knows of each split whether it begins within a value.
    ``headers`` hands in what ``csv_headers`` found, to share it between types.
    """

    def part(rows: DataFrame, names: DataFrame) -> DataFrame:
        # rows as long as their header; what is missing is null
        filled = F.transform("names", lambda _, i: F.get("values", i))
        return _with_header(rows, names).select("path", F.map_from_arrays("names", filled).alias("record"))

    first, *rest = (part(*p) for p in _csv_values(spark, paths, spec, glob, headers))
    return first.unionByName(rest[0]) if rest else first


def read_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    spec: RecordSpec,
    policy: str = "first_non_null",
    glob: str | None = None,
    headers: DataFrame | None = None,
) -> DataFrame:
    """CSV files with headers of their own, as standard rows with ``path``; names are looked up once per file."""

    def part(rows: DataFrame, names: DataFrame) -> DataFrame:
        places = names.select("path", column_places(F.col("names"), spec).alias("places"))
        places = places.where(F.exists("places", lambda p: F.size(p) > 0))
        return resolve_values(_with_header(rows, places), spec, policy=policy, keep=["path"])

    first, *rest = (part(*p) for p in _csv_values(spark, paths, spec, glob, headers))
    return first.unionByName(rest[0]) if rest else first
