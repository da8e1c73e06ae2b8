"""Row cleaning: the batch, live and publish profiles.

The profiles treat the same defect differently on purpose: batch repairs rows,
live drops rows that lack a required value, publish only tidies values.
None of them counts or shuffles; de-duplication and metrics are separate.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions import (
    category,
    flag_or_false,
    published_flag,
    published_text,
    scrub_text,
    strict_time,
    whole_number,
)
from callweave.specs import ENUM_FALLBACK, LEGACY_NAMES, TEXT_DEFAULTS, TIME_FORMAT, UNKNOWN, RecordSpec


def _typed_as(df: DataFrame, field: str, kind: type[T.DataType]) -> bool:
    return isinstance(df.schema[field].dataType, kind)


def key_missing(field: str) -> Column:
    """The quality test of a key: null or ``unknown``."""
    return F.col(field).isNull() | (F.col(field).cast("string") == UNKNOWN)


def default_key(field: str) -> str:
    return f"default_{field.removesuffix('_id')}"


def run_time(value: datetime | str | None) -> Column:
    """The time a run fills in: a given one, so that runs can be repeated, or now.

    Times with a zone are converted to UTC; text and times without one are UTC already."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(timezone.utc)
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(text), TIME_FORMAT)


def scrub(df: DataFrame, spec: RecordSpec, fold_defaults: bool = False) -> DataFrame:
    """Every present column in its table type with defaults for missing values.

    Text is scrubbed, integers and flags are filled; event times stay null
    where they cannot be read (``repair_keys`` fills them).
    """

    def value(field: str) -> Column:
        c, kind = F.col(field), spec.kind(field)
        if kind == "timestamp":
            return c if _typed_as(df, field, T.TimestampType) else strict_time(c.cast("string"))
        if kind == "int":
            return whole_number(c.cast("string"))
        if kind == "boolean":
            is_flag = _typed_as(df, field, T.BooleanType)
            return F.coalesce(c, F.lit(False)) if is_flag else flag_or_false(c.cast("string"))
        return scrub_text(c.cast("string"), TEXT_DEFAULTS.get(field, UNKNOWN), fold_defaults)

    others = [c for c in df.columns if c not in spec.fields]
    return df.select(*[value(f).alias(f) for f in spec.fields if f in df.columns], *others)


def repair_keys(df: DataFrame, spec: RecordSpec, run_ts: datetime | str | None = None) -> DataFrame:
    """Missing ids become ``default_...``, missing event times the run time."""
    fixed = {}
    for key in spec.keys:
        if key not in df.columns:
            continue
        if key == spec.event_time:
            fixed[key] = F.coalesce(F.col(key), run_time(run_ts))
        else:
            fixed[key] = F.when(key_missing(key), F.lit(default_key(key))).otherwise(F.col(key))
    return df.withColumns(fixed)


def complete_columns(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Add absent columns: ``False`` for the fraud flag, ``unknown`` for the rest."""
    absent = {
        f: F.lit(False) if f == "is_fraud" else F.lit(UNKNOWN) for f in spec.fields if f not in df.columns
    }
    return df.withColumns(absent)


def check_categories(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """The batch profile's category checks; an event type left null is ``unknown``."""
    checked = {
        f: category(F.col(f), spec.enums[f], ENUM_FALLBACK[f], match="exact") for f in spec.batch_enums
    }
    if spec.name == "edr":
        checked["event_type"] = F.coalesce(F.col("event_type"), F.lit(UNKNOWN))
    return df.withColumns(checked)


def to_table_types(df: DataFrame, spec: RecordSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the table's columns and types, and ``keep``; what cannot be cast is null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in spec.table_schema], *keep)


def with_lineage(df: DataFrame, batch_id: str, run_ts: datetime | str | None = None) -> DataFrame:
    """Add the run id and run time to every row."""
    return df.withColumns({"batch_id": F.lit(batch_id), "processing_timestamp": run_time(run_ts)})


def clean_batch(
    df: DataFrame,
    spec: RecordSpec,
    run_ts: datetime | str | None = None,
    fold_defaults: bool = False,
    legacy: bool = False,
    batch_id: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The batch profile, row by row; follow with ``distinct_rows``.

    ``batch_id`` keeps the lineage columns in the result; ``keep`` names further columns to carry along.
    """
    if legacy:
        old = LEGACY_NAMES[spec.name]
        df = df.withColumnsRenamed({n: f for f, n in old.items() if n in df.columns and f not in df.columns})
    present = df.select(*[f for f in spec.fields if f in df.columns], *keep)
    cleaned = (
        present.transform(scrub, spec, fold_defaults)
        .transform(repair_keys, spec, run_ts)
        .transform(complete_columns, spec)
        .transform(check_categories, spec)
        .transform(to_table_types, spec, keep)
    )
    return with_lineage(cleaned, batch_id, run_ts) if batch_id else cleaned


def parse_messages(df: DataFrame, spec: RecordSpec, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON message bodies as columns, after those of ``keep``; a body that is no such JSON gives nulls.

    The generator has each body parsed once. As a projection the parser would
    be copied into every later filter and column that reads a field.
    """
    body = F.from_json(F.col(value).cast("string"), spec.message_schema)
    return df.select(*keep, F.inline(F.array(body)))


def live_values(df: DataFrame, spec: RecordSpec, match: str = "casefold", keep: Sequence[str] = ()) -> DataFrame:
    """The live profile's value rules on parsed messages."""

    def value(field: str) -> Column:
        c, kind = F.col(field), spec.kind(field)
        if kind == "timestamp":
            return strict_time(c)
        if kind == "boolean":
            return F.coalesce(c, F.lit(False))
        if field in spec.zero_filled:
            return F.coalesce(c, F.lit(0))
        if field in spec.enums:
            return category(c, spec.enums[field], ENUM_FALLBACK[field], match)
        return c

    return df.select(*keep, *[value(f).alias(f) for f in spec.fields])


def has_required(spec: RecordSpec, columns: list[str]) -> Column:
    """True where every required column present holds a value that is not blank."""
    tests = [
        F.col(k).isNotNull() & (F.trim(F.col(k).cast("string")) != "") for k in spec.keys if k in columns
    ]
    return reduce(and_, tests, F.lit(True))


def keep_required(df: DataFrame, spec: RecordSpec) -> DataFrame:
    return df.where(has_required(spec, df.columns))


def _faults(spec: RecordSpec, columns: list[str]) -> Column:
    faults = [
        F.when(F.col(k).isNull() | (F.trim(F.col(k).cast("string")) == ""), F.lit(k))
        for k in spec.keys
        if k in columns
    ]
    return F.array_compact(F.array(*faults))


def lacking_required(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """The rows ``keep_required`` drops, with the names of the columns at fault."""
    return df.where(~has_required(spec, df.columns)).withColumn("faults", _faults(spec, df.columns))


def clean_live(df: DataFrame, spec: RecordSpec, match: str = "casefold", value: str = "value") -> DataFrame:
    """The live profile from message bodies, row by row; works on streams and tables."""
    return (
        df.transform(parse_messages, spec, value)
        .transform(live_values, spec, match)
        .transform(keep_required, spec)
    )


def dropped_messages(df: DataFrame, spec: RecordSpec, match: str = "casefold", value: str = "value") -> DataFrame:
    """What ``clean_live`` leaves out, as ``(body, faults)``: the raw body and the columns at fault, with ``body`` itself
    first among them where it is no JSON object."""
    bodies = df.select(F.col(value).cast("string").alias("body"))
    rows = parse_messages(bodies, spec, "body", ["body"]).transform(live_values, spec, match, ["body"])
    foreign = F.from_json("body", "map<string,string>").isNull()
    faults = F.when(foreign, F.concat(F.array(F.lit("body")), "faults")).otherwise(F.col("faults"))
    return lacking_required(rows, spec).select("body", faults.alias("faults"))


def live_messages(df: DataFrame, spec: RecordSpec, match: str = "casefold", value: str = "value") -> DataFrame:
    """``clean_live`` and ``dropped_messages`` in one frame, each message read and parsed once: fields of kept rows, ``body`` and
    ``faults`` of dropped ones, the rest null."""
    bodies = df.select(F.col(value).cast("string").alias("body"))
    rows = parse_messages(bodies, spec, "body", ["body"]).transform(live_values, spec, match, ["body"])
    rows = rows.withColumn("_kept", has_required(spec, rows.columns))
    foreign = F.from_json("body", "map<string,string>").isNull()
    faults = F.when(foreign, F.concat(F.array(F.lit("body")), _faults(spec, rows.columns))).otherwise(_faults(spec, rows.columns))
    return rows.select(
        *[F.when(F.col("_kept"), F.col(f)).alias(f) for f in spec.fields],
        F.when(~F.col("_kept"), F.col("body")).alias("body"),
        F.when(~F.col("_kept"), faults).alias("faults"),
    )


def published_values(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """The publish profile on text rows: columns as they go into a message.

    Numbers are 64-bit with fractions cut. A message column has one JSON type, so a value that
    is no number is 0 where the type fills zeros and null elsewhere (``call_duration``)."""

    def value(field: str) -> Column:
        c, kind = F.col(field), spec.kind(field)
        if kind == "boolean":
            return c if _typed_as(df, field, T.BooleanType) else published_flag(c)
        if field in spec.published_enums:
            return category(published_text(c), spec.published_enums[field], ENUM_FALLBACK[field])
        if kind == "int":
            default = 0 if field in spec.zero_filled else None
            return whole_number(published_text(c.cast("string")), default, kind="bigint")
        return published_text(c.cast("string"))

    kept = df.drop("source")
    return kept.select(*[value(c).alias(c) if c in spec.fields else F.col(c) for c in kept.columns])
