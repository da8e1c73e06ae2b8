"""Counts and ratios about data sets, each in a single pass."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from callweave.operators.cleaning import key_missing
from callweave.specs import RecordSpec


def key_quality(df: DataFrame, spec: RecordSpec) -> DataFrame:
    """Per key column: rows, and rows where the key is null or ``unknown``."""
    keys = [k for k in spec.keys if k in df.columns]
    counts = df.agg(
        F.count(F.lit(1)).alias("records"), *[F.count_if(key_missing(k)).alias(k) for k in keys]
    )
    return counts.unpivot("records", keys, "field", "missing").select("field", "records", "missing")


def fraud_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("records"), F.count_if("is_fraud").alias("fraud_records"))


def clean_metrics(cleaned: DataFrame, table: str) -> DataFrame:
    """Rows before and after de-duplication and the fraud share, from clean rows
    that still hold their copies: one scan and one shuffle give all counts."""
    copies = cleaned.groupBy(*cleaned.columns).agg(F.count(F.lit(1)).alias("_copies"))
    before, after = F.coalesce(F.sum("_copies"), F.lit(0)), F.count(F.lit(1))
    return copies.agg(
        F.lit(table).alias("table"),
        before.alias("records_before_cleaning"),
        after.alias("records_after_cleaning"),
        (before - after).alias("dropped_records"),
        F.count_if("is_fraud").alias("fraud_records"),
    )


def count_on_the_way(df: DataFrame, **extra: Column) -> tuple[DataFrame, Observation]:
    """Count rows while another action reads them; ask the observation afterwards."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("records"), *[c.alias(n) for n, c in extra.items()]), seen


def counts_seen(seen: Observation) -> dict:
    """What an observation counted. Where Spark sees at run time that no row can
    come, it drops the step with its counters, so nothing counted means no rows."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "java.lang.AssertionError" in str(error):
            return {}
        raise


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per column the percentage of rows that hold a value; null where there are no rows."""
    share = df.agg(*[(F.try_divide(F.count(f), F.count(F.lit(1))) * F.lit(100.0)).alias(f) for f in fields])
    return share.unpivot([], list(fields), "field", "coverage")


def row_totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("records"))
