"""Large files read in splits, and files read as streams.

Spark's text reader splits a file at any separator, so a split's content arrives as pieces in order. What lies
before a split decides how it is to be read: whether it begins inside quotes and, in JSON, how deeply nested. So every
split first computes what it does to either state, all splits' effects are composed in order of their place (a few numbers a
split), and then each task parses the records that lie wholly in its split. What runs over a border is put together
from the parts, at most two a split. JSON files whose states show damage give their error then and are not parsed, so no
task holds the rest of a file that is cut off.

CSV is scanned as Python's csv module and RFC 4180 read it: a quote opens a value only at its beginning. JSON content of
this size must be UTF-8. Both scans of a file must split it alike; a split that the first has not seen fails the task.
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callweave.session import work_path
from callweave.sources import content

#: Splits or files up to which their table is broadcast; past it Spark joins by shuffle.
BROADCAST_SPLITS = 200_000
ROWS_PER_BATCH = 10_000

Pieces = Callable[[str], DataFrame]


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _settings(spark: SparkSession, **settings: str):
    names = {f"spark.sql.files.{k}": v for k, v in settings.items()}
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        yield
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def _same_splits(spark: SparkSession):
    """Splits must not follow the number of executors that happen to be there."""
    many = spark.conf.get("spark.sql.files.minPartitionNum", None)
    return _settings(spark, minPartitionNum=many or str(spark.sparkContext.defaultParallelism))


#: More bytes than a file has. A split may hold so many, and opening a file counts as many, so each has a task of its own.
ANY_SIZE = 1 << 44


def _file_per_task(spark: SparkSession):
    """Files unsplit and one a task, so that their pieces come in order."""
    return _settings(spark, maxPartitionBytes=str(ANY_SIZE), openCostInBytes=str(ANY_SIZE))


# --------------------------------------------------------------------------
# What a piece does to the state
# --------------------------------------------------------------------------
_ESCAPED = re.compile(rb"\\.", re.DOTALL)


class JsonArray:
    """Records are the objects at depth 1; pieces end at closing braces."""

    separator = "}"
    record_type, arrow_type = "map<string,string>", pa.map_(pa.string(), pa.string())

    @staticmethod
    def measure(piece: bytes, final: bool = False) -> tuple[bool, bool, int, int]:
        """Is the end inside a string if the beginning is not, if it is; the change of depth in either case."""
        parts = (_ESCAPED.sub(b"", piece) if b"\\" in piece else piece).split(b'"')
        flips = len(parts) % 2 == 0
        out, inside = (sum(p.count(b"{") + p.count(b"[") - p.count(b"]") for p in parts[k::2]) for k in (0, 1))
        closing = not final
        return flips, not flips, out - (closing and not flips), inside - (closing and flips)

    @staticmethod
    def whole(inside: bool, depth: int) -> bool:
        return not inside and depth == 1

    @staticmethod
    def sound(inside, depth, pieces, read, size, least):
        """Of a whole file; its last piece counts a closing brace that is not there. ``least`` is the depth that no
        earlier piece ends below: the array stays open until the last one."""
        return ~inside & (depth == -1) & (pieces + read == size + 1) & F.coalesce(least >= 1, F.lit(True))

    @staticmethod
    def parse(text: bytes, first: bool, closed: bool) -> list:
        body = text.removeprefix(b"\xef\xbb\xbf") if first else text
        body = body.lstrip(b" \t\n\r")
        if body[:1] != (b"[" if first else b"," if closed else b"]"):
            raise ValueError("array is cut off or damaged")
        body = body[1:].strip(b" \t\n\r")
        if closed:
            return [content.json_object(body.decode("utf-8"))]
        if body != (b"]" if first else b""):
            raise ValueError("content after the array")
        return []


_FIELD = rb'(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+)'
_FROM_START = re.compile(_FIELD + rb"(?:," + _FIELD + rb")*+", re.DOTALL)
_FROM_QUOTED = re.compile(rb'(?:[^"]|"")*+"[^,]*+(?:,' + _FIELD + rb")*+", re.DOTALL)


class CsvLines:
    """Records are lines that do not end inside quotes; values by position, empty ones null."""

    separator = "\n"
    record_type, arrow_type = "array<string>", pa.list_(pa.string())

    @staticmethod
    def measure(piece: bytes, final: bool = False) -> tuple[bool, bool, int, int]:
        if b'"' not in piece:
            return False, True, 0, 0
        return not _FROM_START.fullmatch(piece), not _FROM_QUOTED.fullmatch(piece), 0, 0

    @staticmethod
    def whole(inside: bool, depth: int) -> bool:
        return not inside

    @staticmethod
    def sound(inside, depth, pieces, read, size, least):
        return F.lit(True)

    @staticmethod
    def parse(text: bytes, first: bool, closed: bool) -> list:
        csv.field_size_limit(sys.maxsize)
        text = text.decode("utf-8-sig" if first else "utf-8", "replace")
        return [[v or None for v in row] for row in csv.reader(io.StringIO(text, newline="")) if row]


# --------------------------------------------------------------------------
# Splits
# --------------------------------------------------------------------------
def _split_groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, Iterator[bytes]]]:
    """Sorted rows (path, block, ..., value) as (path, block, ...) and the pieces of each split."""
    rows = chain.from_iterable(zip(*(b.column(k).to_pylist() for k in range(columns + 1))) for b in batches)
    row = next(rows, None)
    while row is not None:
        key = row[:columns]

        def pieces() -> Iterator[bytes]:
            nonlocal row
            while row is not None and row[:columns] == key:
                piece, row = row[columns], next(rows, None)
                yield piece

        of_split = pieces()
        yield key, of_split
        for _ in of_split:
            pass


def _measured(batches: Iterator[pa.RecordBatch], grammar: type) -> Iterator[pa.RecordBatch]:
    out = []
    for (path, block, size), pieces in _split_groups(batches, 3):
        from_out, from_in, out_depth, in_depth, many, read = False, True, 0, 0, 0, 0
        out_least = in_least = None  # past any piece but the split's last
        for piece in pieces:
            if many:
                out_least = out_depth if many == 1 else min(out_least, out_depth)
                in_least = in_depth if many == 1 else min(in_least, in_depth)
            a, b, x, y = grammar.measure(piece)
            out_depth += y if from_out else x
            in_depth += y if from_in else x
            from_out, from_in = (b if from_out else a), (b if from_in else a)
            many += 1
            read += len(piece)
        out.append((path, block, size, from_out, from_in, out_depth, in_depth, many, read, out_least, in_least))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), *[pa.int64()] * 6]
    names = ["path", "block", "size", "from_out", "from_in", "out_depth", "in_depth", "pieces", "read", "out_least", "in_least"]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names)


_MEASURE = (
    "path string, block long, size long, from_out boolean, from_in boolean, out_depth long, in_depth long, pieces long, read long, "
    "out_least long, in_least long"
)


def _located(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"),
    )


def split_states(measured: DataFrame) -> DataFrame:
    """Per split whether it begins inside quotes and how deep, whether it is its file's last, and the file's end state.

    The effects of all earlier splits are composed: the last one that ends alike in either case decides, and each later
    one that swaps the two cases turns it over."""
    order = W.partitionBy("path").orderBy("block")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    fixed = F.col("from_out") == F.col("from_in")
    swaps = F.sum(F.when(F.col("from_out") & ~F.col("from_in"), 1).otherwise(0))
    rows = measured.withColumns({"turned": swaps.over(order.rowsBetween(W.unboundedPreceding, 0))})
    rows = rows.withColumn("anchor", F.last(F.when(fixed, F.struct("from_out", "turned")), ignorenulls=True).over(before))
    turned = F.coalesce(F.lag("turned").over(order), F.lit(0)) - F.coalesce("anchor.turned", F.lit(0))
    inside = F.coalesce(F.col("anchor.from_out").cast("int"), F.lit(0)) + turned
    rows = rows.withColumn("inside", inside % 2 == 1)
    change = F.when(F.col("inside"), F.col("in_depth")).otherwise(F.col("out_depth"))
    rows = rows.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0)))
    least = F.col("depth") + F.when(F.col("inside"), F.col("in_least")).otherwise(F.col("out_least"))
    begin = F.when(F.lag("block").over(order).isNotNull(), F.col("depth"))  # where the split before ends
    return rows.withColumns({
        "last": F.lead("block").over(order).isNull(),
        "end_inside": F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out")),
        "end_depth": F.col("depth") + change,
        "all_pieces": F.sum("pieces").over(order), "all_read": F.sum("read").over(order),
        "all_least": F.min(F.least(least, begin)).over(order),
    })


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.string(), kind, pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    names = ["path", "record", "error", "first", "block", "part", "text", "closed"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def _parsed(grammar: type, path: str, text: bytes, first: bool, closed: bool) -> list[tuple]:
    try:
        found = grammar.parse(text, first, closed)
    except Exception as bad:  # of content in memory, so never one of storage
        return [(path, None, content.fault(bad), first, None, None, None, None)]
    return [(path, r, None, first and not k, None, None, None, None) for k, r in enumerate(found)]


def _split_records(batches: Iterator[pa.RecordBatch], grammar: type) -> Iterator[pa.RecordBatch]:
    """Whole records parsed; the parts of records that run over the split's borders as they are."""
    end, out = grammar.separator.encode(), []
    for (path, block, inside, depth, last), pieces in _split_groups(batches, 5):
        if inside is None:
            raise RuntimeError(f"{path} was split in another way before, at {block}")
        first, parts, part = block == 0, [], 0
        own = block == 0 or grammar.whole(inside, depth)  # the split begins with a record
        piece = next(pieces, None)
        while piece is not None:
            after = next(pieces, None)
            final = last and after is None
            a, b, x, y = grammar.measure(piece, final)
            inside, depth = (b if inside else a), depth + (y if inside else x)
            parts.append(piece)
            if not final:
                parts.append(end)
            if grammar.whole(inside, depth):
                text = b"".join(parts)
                if own:
                    found = _parsed(grammar, path, text, first, True)
                    out += found
                    first = first and not found  # a blank line is no header
                else:
                    out.append((path, None, None, False, block, part, text, True))
                    part += 1
                    first = False
                parts, own = [], True
            piece = after
            if len(out) >= ROWS_PER_BATCH:
                yield _batch(out, grammar.arrow_type)
                out = []
        if parts:
            out.append((path, None, None, first, block, part, b"".join(parts), False))
    yield _batch(out, grammar.arrow_type)


def _joined_records(batches: Iterator[pa.RecordBatch], grammar: type) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path, first, closed, parts in zip(*(batch.column(k).to_pylist() for k in range(4))):
            out += _parsed(grammar, path, b"".join(p["text"] for p in parts), first, closed)
        yield _batch(out, grammar.arrow_type)


def split_records(pieces: Pieces, grammar: type) -> DataFrame:
    """``(path, record, error, first)`` of files read in splits, as a stored table; ``first`` marks a file's first record.

    Error rows stand beside what could be parsed of a damaged file, which is nothing where its states show the damage."""
    rows = _located(pieces(grammar.separator))
    spark = rows.sparkSession
    out = f"path string, record {grammar.record_type}, error string, first boolean, block long, part long, text binary, closed boolean"
    with _same_splits(spark):
        measured = _stored(rows.select("path", "block", "size", "value").mapInArrow(partial(_measured, grammar=grammar), _MEASURE), "splits")
        states = split_states(measured)
        end = (F.col(c) for c in ("end_inside", "end_depth", "all_pieces", "all_read", "size", "all_least"))
        whole_file = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        states = _stored(states.withColumn("sound", F.last(grammar.sound(*end)).over(whole_file)), "split-states")
        known = states.select("path", "block", "inside", "depth", "last", "sound")
        if known.count() <= BROADCAST_SPLITS:  # the other side keeps its order
            placed = rows.join(F.broadcast(known), ["path", "block"], "left")
        else:
            placed = rows.withColumn("n", F.monotonically_increasing_id()).join(known, ["path", "block"], "left")
            placed = placed.repartition("path", "block").sortWithinPartitions("path", "block", "n")
        placed = placed.where(F.coalesce("sound", F.lit(True))).select("path", "block", "inside", "depth", "last", "value")
        found = _stored(placed.mapInArrow(partial(_split_records, grammar=grammar), out), "split-records")
    open_ = found.where("text is not null")
    before = W.partitionBy("path").orderBy("block", "part").rowsBetween(W.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.col("closed").cast("int")).over(before), F.lit(0))
    joined = open_.withColumn("number", number).groupBy("path", "number").agg(
        F.max("first").alias("first"), F.max("closed").alias("closed"), F.sort_array(F.collect_list(F.struct("block", "part", "text"))).alias("parts")
    )
    joined = joined.select("path", "first", "closed", "parts").mapInArrow(partial(_joined_records, grammar=grammar), out)
    columns = ["path", "record", "error", "first"]
    faults = states.where(F.col("last") & ~F.col("sound")).select("path", F.lit(None).cast(grammar.record_type).alias("record"), F.lit("content is cut off or damaged").alias("error"), F.lit(False).alias("first"))
    whole = found.where("text is null").select(*columns)
    return whole.unionByName(_stored(joined.select(*columns).unionByName(faults), "split-joined"))


def whole_or_nothing(parsed: DataFrame) -> DataFrame:
    """``(path, record, error)`` of a stored table: of a file with an error that one row only."""
    faults = _stored(parsed.where("error is not null").groupBy("path").agg(F.min("error").alias("error")), "faults")
    some = F.broadcast(faults) if faults.count() <= BROADCAST_SPLITS else faults
    good = parsed.where("record is not null").select("path", "record", "error").join(some.select("path"), "path", "left_anti")
    return good.unionByName(faults.select("path", F.lit(None).cast(parsed.schema["record"].dataType).alias("record"), "error"))


def json_arrays(pieces: Pieces) -> DataFrame:
    """``(path, record, error)`` of files that are one JSON array each, every one read by as many tasks as it has splits."""
    return whole_or_nothing(split_records(pieces, JsonArray))


# --------------------------------------------------------------------------
# Streams
# --------------------------------------------------------------------------
_SEPARATORS = {"gzip_json": "}", "zip_csv": "\n", "xml": ">"}


def _file_runs(batches: Iterator[pa.RecordBatch], separator: bytes) -> Iterator[tuple[tuple, bytes]]:
    """Pieces (path, size, value) as (path, size) and the bytes of those of one batch, the separators between put back."""
    for batch in batches:
        paths, at = batch.column(0), 0
        while at < batch.num_rows:
            rest = paths.slice(at)
            many = pc.index(pc.not_equal(rest, rest[0]), True).as_py() if rest[0] != rest[-1] else len(rest)
            pieces = pa.ListArray.from_arrays([0, many], batch.column(2).slice(at, many))
            yield (rest[0].as_py(), batch.column(1)[at].as_py()), pc.binary_join(pieces, separator)[0].as_py()
            at += many


def _stream_records(batches: Iterator[pa.RecordBatch], rows_of, separator: bytes, counted: bool) -> Iterator[pa.RecordBatch]:
    """Pieces (path, size, value), in order and one file after the other, to records."""
    def restored(runs: Iterator[bytes], size: int) -> Iterator[bytes]:
        """The file's bytes; whether it ends in a separator follows from its size, and unpacked content does not."""
        seen = 0
        for run in runs:
            if seen:
                yield separator
            seen += len(run) + 1
            yield run
        if counted and seen <= size:
            yield separator

    def batch(path: str, rows: list, error: str | None = None) -> pa.RecordBatch:
        many = len(rows)
        columns = [pa.array([path] * many, pa.string()), pa.array(rows, JsonArray.arrow_type), pa.array([error] * many, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["path", "record", "error"])

    for (path, size), runs in groupby(_file_runs(batches, separator), key=itemgetter(0)):
        rows, read = [], restored((data for _, data in runs), size)
        try:
            for row in rows_of(_Guarded(read)):
                rows.append(row)
                if len(rows) == ROWS_PER_BATCH:
                    yield batch(path, rows)
                    rows = []
        except StorageError as gone:
            raise gone.__cause__
        except Exception as bad:
            yield batch(path, [None], content.fault(bad))
            continue
        yield batch(path, rows)


class StorageError(Exception):
    """What went wrong in reading, not in parsing."""


class _Guarded:
    """Chunks whose reading fails the task, whatever a parser does with other exceptions."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks = chunks

    def __iter__(self):
        return self

    def __next__(self) -> bytes:
        try:
            return next(self.chunks)
        except StopIteration:
            raise
        except Exception as bad:
            raise StorageError() from bad


def streamed(pieces: Pieces, kind: str, rows_of) -> DataFrame:
    """``(path, record, error)`` of files that do not split, each read front to back by one task in bounded memory: the
    pieces come in order from the one split of the file, without a shuffle or sort.

    Of packed JSON Spark unpacks the content itself; what it cannot unpack ends there, so the array counts as cut."""
    separator = _SEPARATORS[kind]
    located = _located(pieces(separator))
    packed = kind == "gzip_json"
    if packed:
        rows_of = content.json_records
    work = partial(_stream_records, rows_of=rows_of, separator=separator.encode(), counted=not packed)
    found = located.select("path", "size", "value").mapInArrow(work, "path string, record map<string,string>, error string")
    with _file_per_task(located.sparkSession):
        stored = _stored(found, "streamed")
    return whole_or_nothing(stored)
