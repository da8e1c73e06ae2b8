"""Rows as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def message_key(columns: list[str]) -> Column:
    """The user, else the caller, else an empty key."""
    ids = [F.col(c).cast("string") for c in ("user_id", "caller_id") if c in columns]
    return F.coalesce(*ids, F.lit(""))


def to_messages(df: DataFrame, topic: str, keyed: bool = False) -> DataFrame:
    """``topic`` and JSON ``value`` (nulls written out), with ``key`` if asked for."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    parts = [F.lit(topic).alias("topic"), value.alias("value")]
    if keyed:
        parts.insert(1, message_key(df.columns).alias("key"))
    return df.select(*parts)
