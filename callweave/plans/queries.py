"""The registered queries: every operator over whole tables.

Each takes ``(spark, sf_dir)``. Inputs are the raw views of ``raw_views``, or
files and message folders that Spark writes from them.
"""

from __future__ import annotations

import io
import time
import zipfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave import functions as V
from callweave.operators import cleaning, distinct, messages, naming, quality, timeline
from callweave.plans import jobs
from callweave.plans.jobs import process_batch
from callweave.plans.raw_views import raw_records, table_portions
from callweave.session import prepare, scratch, work_path
from callweave.sinks import exports
from callweave.sinks import messages as message_sinks
from callweave.sinks import tables as table_sinks
from callweave.sources import crawl, listing, merged, record_files, streams
from callweave.specs import (
    CALL_TYPES,
    CDR,
    EDR,
    ENUM_FALLBACK,
    EVENT_TYPES,
    IPDR,
    NETWORK_TYPES,
    PROTOCOLS,
    PUBLISHED_EVENT_TYPES,
    SPECS,
    TEXT_DEFAULTS,
    TIME_FORMAT,
    UNKNOWN,
    RecordSpec,
    spec_for,
)
from callweave.streaming import live

Query = Callable[[SparkSession, str], DataFrame]

LATE_BEFORE = "2024-01-20 00:00:00"  # where the watermark query cuts the events
RUN_TS = "2024-06-01 00:00:00"  # the run time batch queries fill in, fixed so that results repeat
#: Rows of the base tables that land as files at once; a row takes about 0.8 kB as files in `_crawl_root`, 1.7 in `_damaged_root`.
CRAWL_ROWS, DAMAGED_ROWS = 8_000_000, 3_000_000


# --------------------------------------------------------------------------
# Inputs
# --------------------------------------------------------------------------
def ragged_records(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """``(rid, record)``: each row under one of the accepted names per column.

    Every eleventh row carries a second name for its last text column, first in
    record order and null; rows of one small share hold foreign names only.
    """
    spec = spec_for(kind)
    raw = raw_records(spark, sf_dir, kind)
    double = doubled_field(spec)
    names, values = [], []
    for i, field in enumerate(spec.fields):
        known = spec.accepted(field)
        options = F.array(*[F.lit(n) for n in known])
        pick = (F.col("rid") + i) % len(known)
        if field == double:
            other = F.get(options, ((pick + 1) % len(known)).cast("int"))
            extra = F.col("rid") % 11 == 0
            names.append(F.when(extra, F.array(other)).otherwise(F.array().cast("array<string>")))
            values.append(
                F.when(extra, F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
            )
        names.append(F.array(F.get(options, pick.cast("int"))))
        values.append(F.array(F.col(field)))
    full = F.map_from_arrays(F.concat(*names), F.concat(*values))
    foreign = F.create_map(F.lit("vendor_code"), F.col("rid").cast("string"), F.lit("memo"), F.lit("x"))
    record = F.when(is_foreign(spec), foreign).otherwise(full)
    return raw.select("rid", F.explode(F.array(record)).alias("record"))  # built once, not per later use


def doubled_field(spec: RecordSpec) -> str:
    return {"cdr": "imei", "ipdr": "domain", "edr": "event_type"}[spec.name]


def is_foreign(spec: RecordSpec):
    """Rows whose record holds no known name."""
    field = {"cdr": "cell_id", "ipdr": "duration", "edr": "user_id"}[spec.name]
    value = {"cdr": "CELL_777", "ipdr": "50", "edr": "100000000007"}[spec.name]
    return F.col(field) == value


def message_bodies(spark: SparkSession, sf_dir: str, kind: str, copies: bool = True) -> DataFrame:
    """JSON bodies as a live feed sends them; every thirteenth one is cut off."""
    spec = spec_for(kind)
    raw = raw_records(spark, sf_dir, kind, copies)
    typed = []
    for field, type_name in spec.columns:
        if type_name == "timestamp":
            known = F.when(F.col("rid") % 7 < 4, F.col("tidy_time")).otherwise(F.col(field))
            typed.append(known.alias(field))
        elif type_name == "int":
            typed.append(F.col(field).try_cast("int").alias(field))
        elif type_name == "boolean":
            typed.append(V.canonical_flag(F.col(field)).alias(field))
        else:
            typed.append(F.col(field))
    body = F.to_json(F.struct(*typed), {"ignoreNullFields": "false"})
    cut = F.when(F.col("rid") % 13 == 0, F.substring(body, 1, 20)).otherwise(body)
    return raw.select(cut.alias("value"))


def landed_messages(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """A folder of message files written from the table."""
    path = work_path(spark, f"messages-{kind}")
    message_sinks.land_messages(message_bodies(spark, sf_dir, kind), path)
    return path


def landed_halves(spark: SparkSession, sf_dir: str, kind: str, feed: str) -> Iterator[None]:
    """Lands the messages in two parts, one at each step; the bodies are made once, for both."""
    made = work_path(spark, f"bodies-{kind}")
    bodies = message_bodies(spark, sf_dir, kind)
    bodies.withColumn("part", F.abs(F.xxhash64("value") % 2)).write.partitionBy("part").parquet(made)
    staged = spark.read.schema("value string, part long").parquet(made)
    for part in (0, 1):
        message_sinks.land_messages(staged.where(F.col("part") == part).select("value"), feed)
        yield


def standard_rows(
    spark: SparkSession, sf_dir: str, kind: str, policy: str = "first_present", times: bool = False
) -> DataFrame:
    records = ragged_records(spark, sf_dir, kind)
    return naming.resolve_records(records, spec_for(kind), policy=policy, keep=["rid"], times=times)


def cleaned_rows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Batch-clean rows that still hold their copies."""
    spec = spec_for(kind)
    raw = raw_records(spark, sf_dir, kind, copies=True)
    mapped = naming.resolve_wide(raw.select(*spec.fields), spec, times=True)
    return cleaning.clean_batch(mapped, spec, RUN_TS)


def clean_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return distinct.distinct_rows(cleaned_rows(spark, sf_dir, kind))


def shown(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare alike everywhere."""
    return df.select(
        *[
            F.date_format(f.name, TIME_FORMAT).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
            for f in df.schema
        ]
    )


# --------------------------------------------------------------------------
# Names
# --------------------------------------------------------------------------
def alias_resolve(kind: str) -> Query:
    return lambda spark, sf: standard_rows(spark, sf, kind)


def alias_first_non_null(kind: str) -> Query:
    return lambda spark, sf: standard_rows(spark, sf, kind, "first_non_null")


def alias_wide(policy: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = raw_records(spark, sf, "edr")
        odd = F.col("rid") % 2 == 1
        wide = raw.select(
            "rid",
            F.when(odd, F.col("event_type")).alias("action"),
            F.when(~odd, F.col("event_type")).alias("event_type"),
            F.when(odd, F.col("user_id")).alias("msisdn"),
            F.col("event_time").alias("log_time"),
            F.col("os_type").alias("platform"),
            F.lit("x").alias("vendor_code"),
        )
        return naming.resolve_wide(wide, EDR, policy, keep=["rid"])

    return run


def unmapped_records(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        naming.unmapped_records(ragged_records(spark, sf, k), spec).select(F.lit(k).alias("record_type"), "rid")
        for k, spec in SPECS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def missing_field_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per column the records that carry no name for it; some are made to lack one or two."""
    records = ragged_records(spark, sf, "edr")
    known = {f: F.array(*[F.lit(n) for n in EDR.accepted(f)]) for f in ("location", "os_type")}
    drop = F.concat(
        *[
            F.when(F.col("rid") % each == 0, known[f]).otherwise(F.array().cast("array<string>"))
            for f, each in (("location", 5), ("os_type", 7))
        ]
    )
    records = records.select("rid", "record", drop.alias("drop")).select(
        "rid", F.map_filter("record", lambda k, _: ~F.array_contains("drop", k)).alias("record")
    )
    lacking = records.select(F.explode(naming.missing_fields(EDR)).alias("field"))
    return quality.row_totals(lacking, "field")


def legacy_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf, "ipdr")
    old = raw.select(
        *[F.col(f).alias({"bytes_sent": "bytes", "vpn_usage": "vpn"}.get(f, f)) for f in IPDR.fields]
    )
    return shown(cleaning.clean_batch(old, IPDR, RUN_TS, legacy=True))


# --------------------------------------------------------------------------
# Values
# --------------------------------------------------------------------------
def normalize_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        raw_records(spark, sf, k).select(
            F.lit(k).alias("record_type"), "rid", V.canonical_time(F.col(spec.event_time)).alias("event_time")
        )
        for k, spec in SPECS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def normalize_boolean(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf, "edr")
    return raw.select(
        "rid",
        V.canonical_flag(F.col("roaming_status")).alias("roaming_status"),
        V.canonical_flag(F.col("is_fraud")).alias("is_fraud"),
        V.canonical_flag(F.concat(F.lit(" "), F.col("rid").cast("string"))).alias("from_number"),
    )


def parse_boolean(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf, "edr")
    return raw.select(
        "rid",
        V.flag_or_false(F.col("roaming_status")).alias("roaming_status"),
        V.flag_or_false(F.col("is_fraud")).alias("is_fraud"),
        V.published_flag(F.col("roaming_status")).alias("published"),
    )


def parse_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf, "cdr")
    return raw.select("rid", F.date_format(V.strict_time(F.col("call_start")), TIME_FORMAT).alias("call_start"))


def string_clean_defaults(spark: SparkSession, sf: str) -> DataFrame:
    edr = raw_records(spark, sf, "edr")
    texts = ["event_id", "user_id", "device_model", "os_type", "network_type", "location", "event_type"]
    return edr.select("rid", *[V.scrub_text(F.col(c), TEXT_DEFAULTS.get(c, UNKNOWN)).alias(c) for c in texts])


def blank_text_to_null(spark: SparkSession, sf: str) -> DataFrame:
    imei = F.col("imei")
    return raw_records(spark, sf, "cdr").select(
        "rid",
        V.blank_to_null(imei).alias("from_csv"),
        V.blank_to_null(F.coalesce(imei, F.lit("None")), "None").alias("from_xml"),
    )


def int_bool_defaults(spark: SparkSession, sf: str) -> DataFrame:
    ipdr = raw_records(spark, sf, "ipdr")
    numbers = ["port", "duration", "bytes_sent", "bytes_received"]
    return ipdr.select(
        "rid",
        *[V.whole_number(F.col(c)).alias(c) for c in numbers],
        V.whole_number(F.col("port"), 0, cut_fraction=False).alias("port_digits_only"),
        V.flag_or_false(F.col("vpn_usage")).alias("vpn_usage"),
    )


def key_repair(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for kind, spec in SPECS.items():
        raw = raw_records(spark, sf, kind)
        repaired = cleaning.repair_keys(cleaning.scrub(raw, spec), spec, RUN_TS)
        keys = [F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(k for k in spec.keys if k != spec.event_time)]
        parts.append(
            repaired.select(
                F.lit(kind).alias("record_type"),
                "rid",
                *keys,
                F.date_format(spec.event_time, TIME_FORMAT).alias("event_time"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


CATEGORIES = {
    "call_type": ("cdr", CALL_TYPES),
    "protocol": ("ipdr", PROTOCOLS),
    "event_type": ("edr", EVENT_TYPES),
    "network_type": ("edr", NETWORK_TYPES),
}


def enum_check(field: str, match: str) -> Query:
    kind, valid = CATEGORIES[field]

    def run(spark: SparkSession, sf: str) -> DataFrame:
        raw = raw_records(spark, sf, kind)
        return raw.select("rid", V.category(F.col(field), valid, ENUM_FALLBACK[field], match).alias(field))

    return run


def enum_published_event_type(spark: SparkSession, sf: str) -> DataFrame:
    value = V.category(V.published_text(F.col("event_type")), PUBLISHED_EVENT_TYPES, "app_launch")
    return raw_records(spark, sf, "edr").select("rid", value.alias("event_type"))


# --------------------------------------------------------------------------
# Cleaning profiles, union, de-duplication
# --------------------------------------------------------------------------
def clean_batch(kind: str) -> Query:
    return lambda spark, sf: shown(clean_table(spark, sf, kind))


def clean_batch_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns a file does not have at all: text is `unknown`, the rest null or False."""
    some = raw_records(spark, sf, "cdr").select("caller_id", "call_start", "call_duration", "imei")
    return shown(distinct.distinct_rows(cleaning.clean_batch(some, CDR, RUN_TS)))


def clean_batch_with_lineage(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_records(spark, sf, "edr").select(*EDR.fields)
    return shown(cleaning.clean_batch(raw, EDR, RUN_TS, batch_id="run-1", fold_defaults=True))


def clean_stream(kind: str, match: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = cleaning.clean_live(message_bodies(spark, sf, kind), spec_for(kind), match)
        return shown(distinct.distinct_rows(rows))

    return run


def quarantine_live(spark: SparkSession, sf: str) -> DataFrame:
    """The parsed messages the live profile drops: their keys and which of them are at fault."""
    parts = []
    for kind, spec in SPECS.items():
        parsed = cleaning.parse_messages(message_bodies(spark, sf, kind), spec)
        dropped = cleaning.lacking_required(cleaning.live_values(parsed, spec), spec)
        keys = [F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(spec.keys)]
        parts.append(dropped.select(F.lit(kind).alias("record_type"), F.array_join("faults", ",").alias("faults"), *keys))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return quality.row_totals(found, *found.columns)


def publish(kind: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spec = spec_for(kind)
        source, feed = work_path(spark, f"publish-{kind}"), work_path(spark, f"sent-{kind}")
        rows = raw_records(spark, sf, kind).select(*spec.fields, F.lit("feed").alias("source"))
        rows.write.options(header="true", **table_sinks.PLAIN_CSV).csv(f"{source}/{spec.merged_files[0]}")
        (log,) = jobs.publish(spark, source, lambda df: message_sinks.land_messages(df, feed), types=[kind])
        if log["errors"]:
            raise RuntimeError(log["error"])
        return spark.read.parquet(feed).withColumn("records_sent", F.lit(log["records_sent"]).cast("long"))

    return run


def message_key(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for kind, spec in SPECS.items():
        rows = raw_records(spark, sf, kind)
        sent = messages.to_messages(rows.select(*spec.fields, "rid"), spec.topic, keyed=True)
        parts.append(sent.select("topic", "key", F.get_json_object("value", "$.rid").cast("long").alias("rid")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def dedup_all_columns(spark: SparkSession, sf: str) -> DataFrame:
    return distinct.distinct_rows(raw_records(spark, sf, "ipdr", copies=True).select(*IPDR.fields))


def union_merge_types(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets of one type merged without de-duplication; one of them lacks columns."""
    ragged = standard_rows(spark, sf, "edr").drop("rid")
    wide = naming.resolve_wide(raw_records(spark, sf, "edr").select(*EDR.fields), EDR)
    short = wide.drop("location", "os_type")
    rows = naming.merge_standard([ragged, wide, short], EDR)
    return quality.row_totals(rows, "event_type", "os_type")


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------
def key_quality(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        quality.key_quality(raw_records(spark, sf, k, copies=True), spec).withColumn("record_type", F.lit(k))
        for k, spec in SPECS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def fraud_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fraud_count(clean_table(spark, sf, "cdr"))


def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The log of the batch job over merged files of all three types."""
    source, target = work_path(spark, "merged"), work_path(spark, "tables")
    for kind, spec in SPECS.items():
        rows = raw_records(spark, sf, kind, copies=True).select(*spec.fields)
        table_sinks.write_merged(naming.resolve_wide(rows, spec), spec, source)
    log = process_batch(
        spark, source, lambda df, spec: table_sinks.append_parquet(df, f"{target}/{spec.table}"), run_ts=RUN_TS
    )
    counts = ("records_before_cleaning", "records_after_cleaning", "dropped_records", "fraud_records")
    return spark.createDataFrame(
        [(r["table"], *(r[c] for c in counts), ",".join(f"{k}={n}" for k, n in r["missing_keys"].items())) for r in log],
        "table string, " + ", ".join(f"{c} long" for c in counts) + ", missing_keys string",
    )


def field_coverage(kind: str) -> Query:
    return lambda spark, sf: quality.field_coverage(standard_rows(spark, sf, kind), spec_for(kind).fields)


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    """A file path per order, of every kind the routing rules tell apart."""
    raw = spark.read.parquet(f"{sf}/orders.parquet")
    return raw.selectExpr(
        "o_orderkey as rid",
        """concat('/in/', case o_orderkey % 4 when 0 then 'ipdr_subdir' when 1 then 'EDR_subdir'
                          when 2 then 'cdr_subdir/deep' else 'misc' end,
                  '/', case o_orderkey % 5 when 0 then 'ipdr_' when 1 then 'EDR_cdr_' when 2 then 'cdr' else 'part' end,
                  cast(o_custkey as string),
                  case o_orderkey % 7 when 0 then '.json' when 1 then '.csv' when 2 then '.XML' when 3 then '.json.gz'
                       when 4 then '.csv.zip' when 5 then '.parquet' else '.gz' end) as path""",
    )


def route_record_type(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).select("rid", listing.record_type_of(F.col("path")).alias("record_type"))


def detect_format(spark: SparkSession, sf: str) -> DataFrame:
    return _paths(spark, sf).select("rid", listing.format_of(F.col("path")).alias("format"))


# --------------------------------------------------------------------------
# Timeline and alerts
# --------------------------------------------------------------------------
def subscriber_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return shown(timeline.subscriber_timeline({k: clean_table(spark, sf, k) for k in SPECS}))


def numbered_timeline(spark: SparkSession, sf: str) -> DataFrame:
    return shown(timeline.numbered_timeline({k: clean_table(spark, sf, k) for k in SPECS}))


def fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return shown(timeline.fraud_alerts(clean_table(spark, sf, "edr")))


def labelled_export(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "labelled")
    table_sinks.export_labelled(clean_table(spark, sf, "cdr"), CDR, path, period="yyyy-MM")
    return spark.read.parquet(path).groupBy(F.col("event_date").cast("string").alias("event_month")).agg(
        F.count(F.lit(1)).alias("records"), F.count_if("is_fraud").alias("fraud_records")
    )


# --------------------------------------------------------------------------
# Files: written by Spark from the views, read back by the sources
# --------------------------------------------------------------------------
def read_json(spark: SparkSession, sf: str, gzip: bool = False) -> DataFrame:
    path = work_path(spark, "edr-json")
    exports.export_json_arrays(ragged_records(spark, sf, "edr").select("record"), path, 5_000, gzip)
    read = record_files.read_gzip_json if gzip else record_files.read_json_arrays
    return naming.resolve_records(read(spark, [path]), EDR)


def read_json_gz(spark: SparkSession, sf: str) -> DataFrame:
    return read_json(spark, sf, gzip=True)


def read_json_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "cdr-lines")
    exports.export_json(raw_records(spark, sf, "cdr").select(*CDR.fields), path, gzip=True)
    return naming.resolve_records(record_files.read_json_lines(spark, [path], glob="*.json.gz"), CDR)


def read_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Two layouts of the same records under one folder, merged without de-duplication."""
    path = work_path(spark, "ipdr-csv")
    raw = raw_records(spark, sf, "ipdr")
    exports.export_csv(raw.select(*IPDR.fields), f"{path}/ipdr_a")
    turned = [F.col(f).alias(IPDR.accepted(f)[-1]) for f in reversed(IPDR.fields)]
    exports.export_csv(raw.select(F.lit("x").alias("vendor_code"), *turned), f"{path}/ipdr_b")
    return record_files.read_csv_files(spark, [path], IPDR).drop("path")


def read_xml(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "cdr-xml")
    named = [F.col(f).alias(CDR.accepted(f)[-1]) for f in CDR.fields]
    exports.export_xml(raw_records(spark, sf, "cdr").select(*named), path, "cdr_data", CDR.row_tag)
    return record_files.read_xml_files(spark, [path], CDR).drop("path")


def _zip_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("edr_records.csv", batch.to_pandas().to_csv(index=False))
            archive.writestr("notes.txt", "not read")
        yield pa.RecordBatch.from_pydict({"path": ["edr.csv.zip"], "content": [packed.getvalue()]})


def read_csv_zip(spark: SparkSession, sf: str) -> DataFrame:
    """Zipped CSV archives made per Arrow batch of the view, unpacked by the source."""
    raw = raw_records(spark, sf, "edr").select(*EDR.fields)
    archives = raw.mapInArrow(_zip_up, "path string, content binary")
    records = record_files.parse_files(archives, "zip_csv").where("record is not null")
    return naming.resolve_records(records, EDR, policy="first_non_null")


def _by_portions(
    spark: SparkSession, sf: str, kinds: Sequence[str], most_rows: int, step: Callable[[dict[str, DataFrame]], None]
) -> None:
    """Calls ``step`` with the tables of each portion in turn, to land and crawl them; the files and work tables it made are
    let go before the next. Files take up many times their table's bytes, so all at once would need a disk to match."""
    with scratch(spark, "landing"):
        for tables in table_portions(spark, sf, kinds, most_rows):
            with scratch(spark, "portion"):
                step(tables)


def _at_once(writes: Sequence[Callable[[], object]]) -> None:
    """Some writes at a time, so that cores which one leaves idle serve the next."""
    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def _crawl_root(spark: SparkSession, sf: str, tables: dict[str, DataFrame]) -> str:
    """A folder tree with JSON, gzipped JSON, CSV and XML files of each type."""
    root, writes = work_path(spark, "crawl"), []
    for kind, spec in SPECS.items():
        base = f"{root}/{kind}_subdir"
        raw = raw_records(spark, sf, kind, table=tables[kind]).select(*spec.fields)
        writes += [
            partial(exports.export_json_arrays, raw, f"{base}/{kind}_json", 5_000),
            partial(exports.export_json_arrays, raw, f"{base}/{kind}_gz", 5_000, gzip=True),
            partial(exports.export_csv, raw, f"{base}/{kind}_csv"),
            partial(exports.export_xml, raw, f"{base}/{kind}_xml", f"{kind}_data", spec.row_tag),
        ]
    _at_once(writes)
    return root


def crawl_files(spark: SparkSession, sf: str) -> DataFrame:
    """The whole crawl: per type and event time the merged rows over all formats, summed over the portions that land."""
    counts = work_path(spark, "crawl-counts")

    def step(tables: dict[str, DataFrame]) -> None:
        found = crawl.crawl(spark, _crawl_root(spark, sf, tables))
        parts = [
            quality.row_totals(rows, SPECS[kind].event_time, "is_fraud").select(
                F.lit(kind).alias("record_type"), F.col(SPECS[kind].event_time).alias("event_time"), "is_fraud", "records"
            )
            for kind, rows in found.items()
        ]
        parts[0].unionByName(parts[1]).unionByName(parts[2]).write.mode("append").parquet(counts)

    _by_portions(spark, sf, list(SPECS), CRAWL_ROWS, step)
    return spark.read.parquet(counts).groupBy("record_type", "event_time", "is_fraud").agg(F.sum("records").alias("records"))


def crawl_report(spark: SparkSession, sf: str) -> DataFrame:
    """Files listed, routed and counted; unreadable ones are reported, not fatal."""
    reports = work_path(spark, "reports")

    def step(tables: dict[str, DataFrame]) -> None:
        folders = listing.record_folders(_damaged_root(spark, sf, tables))
        tree = crawl.open_tree(spark, folders)
        parsed = {k: jobs.kept(p, f"parsed-{k}") for k, p in crawl.parse_type(tree, CDR).items()}
        records = crawl.crawl_type(tree, CDR, parsed=parsed)
        report = listing.file_report(
            listing.file_manifest(spark, folders), records.select("path"), crawl.errors_of(parsed)
        )
        report.write.mode("append").parquet(reports)

    _by_portions(spark, sf, ["cdr"], DAMAGED_ROWS, step)
    return _report_totals(spark.read.parquet(reports))


def _report_totals(report: DataFrame) -> DataFrame:
    """The report without paths and numbers of files, which depend on how Spark wrote them."""
    whole = ~F.col("format").eqNullSafe("json_lines")
    return report.groupBy("record_type", "format", "reason").agg(
        F.sum("records").alias("records"),
        F.sum(F.when(~whole, F.col("errors")).otherwise(0)).cast("long").alias("damaged_lines"),
    )


def _write_lines(df: DataFrame, path: str, extension: str) -> None:
    """One text column as lines of files with this name ending."""
    options = {"extension": extension, "sep": "\u0001", "quote": "", "escape": "", "header": "false"}
    df.write.options(**options, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)


def _damaged_root(spark: SparkSession, sf: str, tables: dict[str, DataFrame]) -> str:
    """A tree of call files, half of them no good: arrays and XML cut off, lines cut, arrays too deep for the
    parser, XML in an encoding nobody knows, other files."""
    root = work_path(spark, "damaged")
    base = f"{root}/cdr_subdir"
    raw = raw_records(spark, sf, "cdr", table=tables["cdr"])
    calls = raw.select(*CDR.fields)
    body = F.to_json(F.struct(*CDR.fields), {"ignoreNullFields": "false"})
    cut = F.when(F.col("rid") % 13 == 0, F.substring(body, 1, 20)).otherwise(body)
    element = F.concat(F.lit("<cdr_data><cdr_record><caller_id>"), F.col("rid").cast("string"), F.lit("</caller_id></cdr_record>"))
    deep = F.concat(F.lit("["), F.repeat(F.lit('{"a":['), F.lit(50_000)), body)
    odd = F.concat(F.lit('<?xml version="1.0" encoding="x-nobody"?>'), element, F.lit("</cdr_data>"))
    some = raw.where("rid % 500 = 0")
    _at_once([
        partial(exports.export_json_arrays, calls, f"{base}/cdr_json", 5_000),
        partial(exports.export_csv, calls, f"{base}/cdr_csv"),
        partial(exports.export_csv, calls, f"{base}/misc"),  # no type in the name or folder
        partial(_write_lines, raw.select(body.alias("value")), f"{base}/cdr_cut_json", "json"),  # lines, no array
        partial(_write_lines, raw.select(cut.alias("value")), f"{base}/cdr_lines", "jsonl"),
        partial(_write_lines, raw.select(element.alias("value")), f"{base}/cdr_cut_xml", "xml"),  # never closed
        partial(_write_lines, some.select(deep.alias("value")), f"{base}/cdr_deep", "json"),
        partial(_write_lines, some.select(odd.alias("value")), f"{base}/cdr_odd_xml", "xml"),
        partial(_write_lines, raw.select(body.alias("value")), f"{base}/cdr_notes", "txt"),
    ])
    return root


def standardize_job(spark: SparkSession, sf: str) -> DataFrame:
    """The crawl job over a tree with damaged files: its report and, of the merged set, rows and coverage."""
    target = work_path(spark, "standardized")

    def step(tables: dict[str, DataFrame]) -> None:
        coverage = jobs.standardize_files(spark, _damaged_root(spark, sf, tables), target, mode="append")
        if set(coverage) != {"cdr"}:
            raise RuntimeError("a merged set without files")

    _by_portions(spark, sf, ["cdr"], DAMAGED_ROWS, step)
    if listing.existing(spark, [f"{target}/{EDR.merged_files[0]}"]):
        raise RuntimeError("a merged set without files")
    rows = merged.read_merged(spark, target, CDR)
    total = rows.agg(
        F.lit("cdr").alias("record_type"), F.lit("merged").alias("format"), F.lit(None).cast("string").alias("reason"),
        F.count(F.lit(1)).alias("records"), F.lit(0).cast("long").alias("damaged_lines"),
    )
    return _report_totals(jobs.read_report(spark, target)).unionByName(total)


def merged_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Standard rows written as merged CSV, loaded again and cleaned by the batch job."""
    source, target = work_path(spark, "merged"), work_path(spark, "tables")
    table_sinks.write_merged(
        naming.resolve_wide(raw_records(spark, sf, "cdr", copies=True).select(*CDR.fields), CDR), CDR, source
    )
    process_batch(
        spark,
        source,
        lambda df, spec: table_sinks.append_parquet(df, f"{target}/{spec.table}"),
        types=["cdr"],
        run_ts=RUN_TS,
    )
    return shown(spark.read.parquet(f"{target}/cdr"))


def headerless_merged(spark: SparkSession, sf: str) -> DataFrame:
    source = work_path(spark, "headerless")
    rows = raw_records(spark, sf, "edr").select(*EDR.fields)
    rows.write.options(**table_sinks.PLAIN_CSV).csv(f"{source}/{EDR.merged_files[1]}")  # under the alternative name
    return merged.read_merged(spark, source, EDR)  # the first line names nothing


def source_check(spark: SparkSession, sf: str) -> DataFrame:
    root = work_path(spark, "check")
    paths = {k: f"{root}/final_{k}.csv" for k in SPECS}
    for kind in ("cdr", "ipdr"):
        table_sinks.write_merged(raw_records(spark, sf, kind), spec_for(kind), root)
    checked = merged.source_check(spark, paths)
    # bytes depend on how Spark wrote the files; that there are some does not
    return checked.select("topic", "exists", "records", (F.col("megabytes") > 0).alias("has_bytes"))


# --------------------------------------------------------------------------
# Streams: message folders read to their end
# --------------------------------------------------------------------------
def _run_live(spark: SparkSession, kind: str, landings: list[DataFrame], delay: str | None = None) -> DataFrame:
    """The live job started once per landing of message files, each time from its checkpoint."""
    spec = spec_for(kind)
    feed, target, checkpoint = (work_path(spark, f"{label}-{kind}") for label in ("messages", "live", "checkpoint"))
    for bodies in landings:
        message_sinks.land_messages(bodies, feed)
        query = live.start_live(
            streams.file_messages(spark, feed), spec, live.epoch_sink(target), checkpoint, interval=None, delay=delay
        )
        query.awaitTermination()
    return live.read_epochs(spark, target, spec)


def stream_dedup(kind: str) -> Query:
    """With the default bound on state; in one landing no row is late, so the result is that of a table."""
    return lambda spark, sf: shown(_run_live(spark, kind, [message_bodies(spark, sf, kind)], live.DELAY))


def stream_dedup_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """With bounded state: first the rows from ``LATE_BEFORE`` on, then all. Copies of the first are
    dropped while their state lasts, and rows more than the delay behind the newest are refused."""
    bodies = message_bodies(spark, sf, "edr")
    newer = F.get_json_object("value", "$.event_time") >= LATE_BEFORE
    return shown(_run_live(spark, "edr", [bodies.where(newer), bodies], delay="1 day"))


def stream_restart(spark: SparkSession, sf: str) -> DataFrame:
    """Stopped and started again from its checkpoint: nothing twice, nothing lost."""
    bodies = message_bodies(spark, sf, "cdr")
    half = F.xxhash64("value") % 2 == 0
    again = F.xxhash64("value") % 3 == 0  # of these some have come before, some not
    return shown(_run_live(spark, "cdr", [bodies.where(half), bodies.where(~half | again)]))


def stream_fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    feed = landed_messages(spark, sf, "edr")
    target, checkpoint = work_path(spark, "alerts"), work_path(spark, "checkpoint-alerts")
    rows = live.live_rows(streams.file_messages(spark, feed), EDR, delay=None)
    query = live.start_sink(timeline.fraud_alerts(rows), live.epoch_sink(target), checkpoint, "alerts", None)
    query.awaitTermination()
    return shown(live.read_epochs(spark, target, EDR))


def stream_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Messages read per topic by cleaning streams that are stopped and started again, from the totals they keep."""
    rows = []
    for kind, spec in SPECS.items():
        feed, target, totals, checkpoint = (work_path(spark, f"{label}-{kind}") for label in ("messages", "rate", "totals", "checkpoint"))
        sink = live.split_sink(live.epoch_sink(target), spec, None, totals)
        for _ in landed_halves(spark, sf, kind, feed):
            both = cleaning.live_messages(streams.file_messages(spark, feed), spec)  # without de-duplication: every message counts
            live.start_sink(both, sink, checkpoint, spec.topic, None).awaitTermination()
        rows.append((spec.topic, sum(live.read_totals(spark, totals, checkpoint, spec.topic).values())))
    return spark.createDataFrame(rows, "topic string, records long")


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What live jobs drop, read back from the bodies they have kept, after a restart: as ``quarantine_live``."""
    parts = []
    for kind, spec in SPECS.items():
        feed, target, dropped, checkpoint = (work_path(spark, f"{label}-{kind}") for label in ("messages", "live", "dropped", "checkpoint"))
        for _ in landed_halves(spark, sf, kind, feed):
            query = live.start_live(
                streams.file_messages(spark, feed), spec, live.epoch_sink(target), checkpoint, interval=None, delay=None, quarantine=dropped
            )
            query.awaitTermination()
        parsed = cleaning.parse_messages(live.read_quarantine(spark, dropped), spec, "body", ["faults"])
        rows = cleaning.live_values(parsed, spec, keep=["faults"])
        columns = F.array_join(F.array_remove("faults", "body"), ",")  # that a body is no JSON object shows in its columns, too
        keys = [F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(spec.keys)]
        parts.append(rows.select(F.lit(kind).alias("record_type"), columns.alias("faults"), *keys))
    found = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return quality.row_totals(found, *found.columns)


# --------------------------------------------------------------------------
# Flagship
# --------------------------------------------------------------------------
def edr_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Ragged device events mapped, cleaned, de-duplicated and counted per event type."""
    mapped = standard_rows(spark, sf, "edr", times=True).drop("rid")
    table = distinct.distinct_rows(cleaning.clean_batch(mapped, EDR, RUN_TS))
    return table.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("is_fraud").alias("fraud_records")
    )


def _registry() -> dict[str, Query]:
    found: dict[str, Query] = {"edr_overview": edr_overview}
    for kind in SPECS:
        found[f"alias_resolve_{kind}"] = alias_resolve(kind)
        found[f"alias_first_non_null_{kind}"] = alias_first_non_null(kind)
        found[f"clean_batch_{kind}"] = clean_batch(kind)
        found[f"clean_stream_{kind}"] = clean_stream(kind, "casefold")
        found[f"clean_stream_reference_{kind}"] = clean_stream(kind, "reference")
        found[f"publish_{kind}"] = publish(kind)
        found[f"field_coverage_{kind}"] = field_coverage(kind)
        found[f"stream_dedup_{kind}"] = stream_dedup(kind)
    for field in CATEGORIES:
        found[f"enum_casefold_{field}"] = enum_check(field, "casefold")
        found[f"enum_reference_{field}"] = enum_check(field, "reference")
    for policy in naming.POLICIES:
        found[f"alias_wide_{policy}"] = alias_wide(policy)
    for query in (
        unmapped_records,
        missing_field_report,
        legacy_names,
        normalize_timestamp,
        normalize_boolean,
        parse_boolean,
        parse_timestamp,
        string_clean_defaults,
        blank_text_to_null,
        int_bool_defaults,
        key_repair,
        enum_published_event_type,
        clean_batch_missing_columns,
        clean_batch_with_lineage,
        quarantine_live,
        message_key,
        dedup_all_columns,
        union_merge_types,
        key_quality,
        fraud_count,
        batch_metrics,
        route_record_type,
        detect_format,
        subscriber_timeline,
        numbered_timeline,
        fraud_alerts,
        labelled_export,
        read_json,
        read_json_gz,
        read_json_lines,
        read_csv,
        read_xml,
        read_csv_zip,
        crawl_files,
        crawl_report,
        standardize_job,
        merged_batch,
        headerless_merged,
        source_check,
        stream_dedup_watermark,
        stream_restart,
        stream_fraud_alerts,
        stream_throughput,
        stream_quarantine,
    ):
        found[query.__name__] = query
    return found


def _prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {name: _prepared(query) for name, query in _registry().items()}
