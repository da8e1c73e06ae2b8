"""Live jobs: a message stream cleaned, de-duplicated and appended."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callweave.operators.cleaning import clean_live, dropped_messages
from callweave.operators.distinct import distinct_stream
from callweave.operators.quality import count_on_the_way, counts_seen
from callweave.sinks.tables import append_jdbc
from callweave.specs import RecordSpec

BatchSink = Callable[[DataFrame, int], None]

#: How late a row may come and how long its copies are looked for. None keeps every row for ever.
DELAY = "2 days"


def live_rows(
    messages: DataFrame,
    spec: RecordSpec,
    match: str = "casefold",
    delay: str | None = DELAY,
    fold_first: bool = True,
) -> DataFrame:
    """Clean, distinct rows of a message stream. ``delay`` bounds the state (see
    ``distinct_stream``); with None rows are kept for ever and none is late."""
    cleaned = clean_live(messages, spec, match)
    return distinct_stream(cleaned, spec.event_time, delay, fold_first)


def live_outputs(
    messages: DataFrame, spec: RecordSpec, match: str = "casefold", delay: str | None = DELAY, fold_first: bool = True
) -> DataFrame:
    """``live_rows`` and, with null in every field, what cleaning leaves out with ``body`` and ``faults``.

    One stream, so both go with the same epochs; the source is read for each of the two. Copies of dropped messages all
    stay. Rows that come later than ``delay`` are refused by the watermark and are in neither."""
    kept = live_rows(messages, spec, match, delay, fold_first)
    return kept.unionByName(dropped_messages(messages, spec, match), allowMissingColumns=True)


def _folders(spark: SparkSession, path: str) -> list[str]:
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(there)] if files.exists(there) else []


def epoch_sink(path: str) -> BatchSink:
    """Each micro-batch in a folder of its query and epoch, replaced when it is replayed: a batch
    run again after a failure leaves no rows twice.

    A query with a new checkpoint counts its epochs from 0 again, so a target that another query
    has written is refused; nothing there is overwritten or read twice."""
    root = path.rstrip("/")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        own = f"query={spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'none'}"
        others = [f for f in _folders(spark, root) if f.startswith("query=") and f != own]
        if others:
            raise RuntimeError(f"{root} holds the rows of {others[0]}: restart from its checkpoint or take a new target")
        batch.write.mode("overwrite").parquet(f"{root}/{own}/epoch={epoch}")

    write.reads_once = True
    return write


def read_epochs(spark: SparkSession, path: str, spec: RecordSpec) -> DataFrame:
    """What ``epoch_sink`` has written; no rows if nothing has come yet."""
    try:
        return spark.read.schema(spec.table_schema).parquet(path).select(*spec.fields)
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], spec.table_schema)


def split_sink(sink: BatchSink, spec: RecordSpec, quarantine: str | None, totals: str | None) -> BatchSink:
    """Rows of ``live_outputs``: kept ones to ``sink``, dropped ones to the folder ``quarantine``, the numbers of
    both to the folder ``totals``, the latter two per query and epoch as ``epoch_sink`` does.

    A sink that says so (``reads_once``) gets rows that are counted as it writes them, so without
    ``quarantine`` nothing is held; else the micro-batch is, as it is read several times."""
    dropped = F.col("faults").isNotNull()
    in_one_go = totals and not quarantine and getattr(sink, "reads_once", False)

    def write(batch: DataFrame, epoch: int) -> None:
        if in_one_go:
            rows, seen = count_on_the_way(batch, dropped=F.count_if(dropped))
            sink(rows.where(~dropped).select(*spec.fields), epoch)
            left = counts_seen(seen)
            gone = left.get("dropped") or 0
            counts = batch.sparkSession.createDataFrame([((left.get("records") or 0) - gone, gone)], "kept long, dropped long")
            epoch_sink(totals)(counts, epoch)
            return
        batch.persist()
        try:
            sink(batch.where(~dropped).select(*spec.fields), epoch)
            if quarantine:
                epoch_sink(quarantine)(batch.where(dropped).select("body", "faults"), epoch)
            if totals:
                counts = batch.agg(F.count_if(~dropped).alias("kept"), F.count_if(dropped).alias("dropped"))
                epoch_sink(totals)(counts, epoch)
        finally:
            batch.unpersist()

    return write


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``(body, faults)`` of the messages a live job has dropped; none if it has not dropped any yet."""
    schema = "body string, faults array<string>"
    return spark.read.schema(schema).parquet(path).select("body", "faults") if _folders(spark, path) else spark.createDataFrame([], schema)


def read_totals(spark: SparkSession, path: str, checkpoint: str, name: str) -> dict[str, int]:
    """Records kept and dropped by a live job since its checkpoint began, over all its starts.

    An epoch counts once the stream has committed it; what a failed one has written is replaced by its replay."""
    commits = [int(n) for n in _folders(spark, f"{checkpoint.rstrip('/')}/{name}/commits") if n.isdigit()]
    if not commits or not _folders(spark, path):
        return {"kept": 0, "dropped": 0}
    epochs = spark.read.schema("kept long, dropped long, epoch long").option("basePath", path).parquet(path)
    row = epochs.where(F.col("epoch") <= max(commits)).agg(F.sum("kept").alias("kept"), F.sum("dropped").alias("dropped")).first()
    return {k: v or 0 for k, v in row.asDict().items()}


def jdbc_sink(url: str, table: str, options: dict[str, str]) -> BatchSink:
    """Append each micro-batch that holds rows (at least once: a replay appends again)."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                append_jdbc(batch, url, table, options)
        finally:
            batch.unpersist()

    return write


def start_sink(
    rows: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    name: str,
    interval: str | None = "10 seconds",
) -> StreamingQuery:
    """Run ``sink`` per micro-batch, every ``interval`` or (None) until the input is read."""
    writer = (
        rows.writeStream.foreachBatch(sink)
        .queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def start_live(
    messages: DataFrame,
    spec: RecordSpec,
    sink: BatchSink,
    checkpoint: str,
    interval: str | None = "10 seconds",
    match: str = "casefold",
    delay: str | None = DELAY,
    fold_first: bool = True,
    quarantine: str | None = None,
    totals: str | None = None,
) -> StreamingQuery:
    """The live job of one record type. Start one per type and wait on
    ``spark.streams.awaitAnyTermination()``; they share the application.

    ``quarantine`` is a folder for the messages that cleaning drops (``read_quarantine``), ``totals`` one for
    the numbers of records (``read_totals``); a checkpoint belongs to a job with both, either or none."""
    if not quarantine and not totals:
        return start_sink(live_rows(messages, spec, match, delay, fold_first), sink, checkpoint, spec.table, interval)
    rows = live_outputs(messages, spec, match, delay, fold_first)
    return start_sink(rows, split_sink(sink, spec, quarantine, totals), checkpoint, spec.table, interval)
