"""The four jobs, each one call."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.operators.cleaning import clean_batch, key_missing, published_values
from callweave.operators.distinct import COPIES, with_copies
from callweave.operators.messages import to_messages
from callweave.operators.quality import count_on_the_way, counts_seen, field_coverage
from callweave.session import prepare, work_path
from callweave.sinks.tables import write_merged
from callweave.sources.crawl import crawl_type, errors_of, open_tree, parse_type
from callweave.sources.listing import file_manifest, file_report, record_folders
from callweave.sources.merged import read_merged
from callweave.specs import SPECS, RecordSpec, spec_for
from callweave.streaming.live import BatchSink, start_live

TableSink = Callable[[DataFrame, RecordSpec], None]


def standardize_files(
    spark: SparkSession, root: str, target: str, fmt: str = "csv", mode: str = "overwrite", **policies: str
) -> dict[str, DataFrame]:
    """Crawl ``root``, write one merged set per type that has files, return the coverage of each.

    With ``mode="append"`` merged sets and report are added to those below ``target``, for trees that land in portions;
    coverage is that of ``root`` alone. What was read, per file, and what could not be read and why, is written below ``target``
    (``read_report``). Files are parsed once per type, into a table in the shared folder;
    merged set, coverage and report come from it.
    """
    prepare(spark)
    coverage: dict[str, DataFrame] = {}
    folders = record_folders(root)
    try:
        manifest = kept(file_manifest(spark, folders), "manifest")
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return coverage
    present = {r[0] for r in manifest.where("format is not null").select("record_type").distinct().collect()}
    tree, paths, errors = open_tree(spark, folders), [], []
    for name, spec in SPECS.items():
        if name not in present:
            continue
        parsed = {k: kept(p, f"parsed-{name}-{k}") for k, p in parse_type(tree, spec).items()}
        rows = kept(crawl_type(tree, spec, parsed=parsed, **policies), f"standard-{name}")
        write_merged(rows, spec, target, fmt, mode)
        coverage[name] = field_coverage(rows, spec.fields)
        paths.append(rows.select("path"))
        errors.append(errors_of(parsed))
    if paths:
        report = file_report(manifest, reduce(DataFrame.unionByName, paths), reduce(DataFrame.unionByName, errors))
    else:
        report = file_report(manifest, manifest.select("path").where("false"))
    report.write.mode(mode).parquet(_report_path(target))
    return coverage


def kept(df: DataFrame, label: str) -> DataFrame:
    """A frame by way of a table in the shared folder, so that it is made once."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _report_path(target: str) -> str:
    return f"{target.rstrip('/')}/report"


def read_report(spark: SparkSession, target: str) -> DataFrame:
    """One row per file of the last ``standardize_files`` and those it was appended to: type, format, bytes, records, errors, and for
    files not or not wholly read the ``reason`` and a ``detail``."""
    return spark.read.parquet(_report_path(target))


def process_batch(
    spark: SparkSession,
    source: str,
    sink: TableSink,
    types: list[str] | None = None,
    run_ts: datetime | str | None = None,
    header: bool | None = None,
    multi_line: bool | None = None,
    **options,
) -> list[dict]:
    """Clean the merged files of each type and append them to its table.

    One pass per type: the counts before and after de-duplication are taken while the sink writes.
    They come after the shuffle, from the number of copies of each row, so stages that run
    again after a lost executor count nothing twice. Returns one metrics record per type, with
    the rows whose key was null or ``unknown`` before cleaning repaired it.
    """
    prepare(spark)
    batch_id = str(uuid.uuid4())
    run_ts = run_ts or datetime.now(timezone.utc).replace(microsecond=0)
    log = []
    for name in types or list(SPECS):
        spec, start = spec_for(name), time.time()
        raw = read_merged(spark, source, spec, header, multi_line)
        lacking = {k: f"_missing_{k}" for k in spec.keys if k in raw.columns}
        flagged = raw.withColumns({flag: key_missing(k).cast("long") for k, flag in lacking.items()})
        flags = list(lacking.values())
        copies = with_copies(clean_batch(flagged, spec, run_ts, keep=flags, **options), flags)
        copies, seen = count_on_the_way(
            copies, before=F.sum(COPIES), fraud_records=F.count_if("is_fraud"), **{f: F.sum(f) for f in flags}
        )
        sink(copies.drop(COPIES, *flags), spec)
        left = counts_seen(seen)
        before, after = left.get("before") or 0, left.get("records", 0)
        log.append(
            {
                "batch_id": batch_id,
                "table": spec.table,
                "records_before_cleaning": before,
                "records_after_cleaning": after,
                "dropped_records": before - after,
                "fraud_records": left.get("fraud_records", 0),
                "missing_keys": {k: left.get(flag) or 0 for k, flag in lacking.items()},
                "processing_time_seconds": round(time.time() - start, 3),
                "timestamp": datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"),
            }
        )
    return log


def published_messages(rows: DataFrame, spec: RecordSpec, keyed: bool = False) -> DataFrame:
    """Text rows of a type as normalised messages on its topic."""
    return to_messages(published_values(rows, spec), spec.topic, keyed)


def publish(
    spark: SparkSession,
    source: str,
    send: Callable[[DataFrame], None],
    types: list[str] | None = None,
    keyed: bool = False,
    multi_line: bool | None = None,
) -> list[dict]:
    """Send the merged file of each type as messages; one log record per topic."""
    prepare(spark)
    batch_id, log = str(uuid.uuid4()), []
    for name in types or list(SPECS):
        spec, start = spec_for(name), time.time()
        rows = read_merged(spark, source, spec, multi_line=multi_line)
        messages, seen = count_on_the_way(published_messages(rows, spec, keyed))
        fault = None
        try:
            send(messages)
        except Exception as error:  # the other topics are still sent; the log says which one failed
            fault = f"{type(error).__name__}: {error}"[:500]
        elapsed, sent = time.time() - start, 0 if fault else counts_seen(seen).get("records", 0)
        log.append(
            {
                "topic": spec.topic,
                "batch_id": batch_id,
                "records_sent": sent,
                "errors": int(fault is not None),
                "error": fault,
                "records_per_second": round(sent / elapsed, 2),
                "elapsed_seconds": round(elapsed, 2),
            }
        )
    return log


def start_all_live(
    spark: SparkSession,
    messages: Callable[[RecordSpec], DataFrame],
    sink: Callable[[RecordSpec], BatchSink],
    checkpoint: str,
    **options,
) -> dict:
    """A live query per record type in one application, by type name."""
    prepare(spark)
    return {
        name: start_live(messages(spec), spec, sink(spec), checkpoint, **options)
        for name, spec in SPECS.items()
    }
