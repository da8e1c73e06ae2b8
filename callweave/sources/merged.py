"""Merged files per record type, and a check that they are there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.operators.naming import name_positional
from callweave.sources import splits
from callweave.sources.listing import existing
from callweave.specs import RecordSpec


def _flat(spark: SparkSession, header: bool, multi_line: bool):
    return (
        spark.read.option("header", str(header).lower())
        .option("escape", '"')
        .option("multiLine", str(multi_line).lower())
    )


def _odd_quotes(lines: DataFrame) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return lines.where(F.col("value").contains('"') & (quotes % 2 == 1))


def _split_rows(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """Rows of a file with quoted line ends, read in splits whose states are known."""
    columns = _flat(spark, header, True).csv(path).columns  # of the first record; no row is read
    found = splits.split_records(lambda separator: spark.read.option("lineSep", separator).text(path), splits.CsvLines)
    rows = found.where("not first") if header else found
    return rows.select(*(F.get("record", F.lit(k)).alias(c) for k, c in enumerate(columns)))


def read_merged(
    spark: SparkSession, source: str, spec: RecordSpec, header: bool | None = None, multi_line: bool | None = None
) -> DataFrame:
    """The merged CSV of a type as text columns, under the first of its names that exists.

    No type inference, hence no extra scan. Without header the columns take
    the table's names by position; unless ``header`` says so, a first line without a single
    known name is taken for data. Files split in any case; if some line holds an odd number of
    quotes, so that a quoted value may run over a line end, the state of each split is found first.
    ``multi_line`` says so beforehand and saves that look at the lines.
    """
    missing: AnalysisException | None = None
    for name in spec.merged_files:
        path = f"{source.rstrip('/')}/{name}"
        try:
            breaks = not _odd_quotes(spark.read.text(path)).isEmpty() if multi_line is None else multi_line
            rows = _split_rows(spark, path, header is not False) if breaks else _flat(spark, header is not False, False).csv(path)
        except AnalysisException as gone:
            if gone.getCondition() != "PATH_NOT_FOUND":
                raise
            missing = gone
            continue
        known = {*spec.fields, *spec.name_lookup(legacy=True)}
        if header or (header is None and known & set(rows.columns)):
            return rows
        if header is not False:
            rows = _split_rows(spark, path, False) if breaks else _flat(spark, False, False).csv(path)
        return name_positional(rows, spec)
    raise missing


def source_check(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Per topic: does its CSV exist, how many MB and records does it hold."""
    frames = []
    for topic, path in paths.items():
        if not existing(spark, [path]):
            frames.append(
                spark.range(1).select(
                    F.lit(topic).alias("topic"),
                    F.lit(False).alias("exists"),
                    F.lit(0.0).alias("megabytes"),
                    F.lit(0).cast("long").alias("records"),
                )
            )
            continue
        lines = spark.read.text(path)
        per_file = lines.groupBy("_metadata.file_path").agg(
            F.max("_metadata.file_size").alias("bytes"),
            (F.count(F.lit(1)) - 1).alias("records"),
        )
        frames.append(
            per_file.agg(
                F.lit(topic).alias("topic"),
                F.lit(True).alias("exists"),
                (F.coalesce(F.sum("bytes"), F.lit(0)) / F.lit(1024 * 1024)).alias("megabytes"),
                F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
            )
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
