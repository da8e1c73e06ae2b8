"""Which files there are, of which record type and format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The order in which type names are looked for in a file name,
# and the suffix of each format, longest first.
ROUTING_ORDER = ("ipdr", "edr", "cdr")
FORMAT_SUFFIXES = (
    (".json.gz", "gzip_json"),
    (".csv.zip", "zip_csv"),
    (".jsonl", "json_lines"),
    (".json", "json"),
    (".csv", "csv"),
    (".xml", "xml"),
)
SUBFOLDERS = ("ipdr_subdir", "edr_subdir", "cdr_subdir")


def record_type_of(path: Column) -> Column:
    """Type by file name, else by the folder it lies in, else null."""
    parts = F.split(F.lower(path), "/")
    name = F.try_element_at(parts, F.lit(-1))
    folder = F.try_element_at(parts, F.lit(-2))
    return F.coalesce(
        *[
            F.when(place.contains(kind), F.lit(kind))
            for place in (name, folder)
            for kind in ROUTING_ORDER
        ]
    )


def format_of(path: Column) -> Column:
    """Format by suffix, upper case allowed; null for anything else."""
    low = F.lower(path)
    return F.coalesce(*[F.when(low.endswith(suffix), F.lit(fmt)) for suffix, fmt in FORMAT_SUFFIXES])


def suffix_glob(fmt: str) -> str:
    """A name pattern for the files of a format, upper case allowed."""
    suffix = next(s for s, name in FORMAT_SUFFIXES if name == fmt)
    return "*" + "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist (a missing subfolder is skipped, not an error)."""

    def there(path: str) -> bool:
        try:
            spark.read.format("binaryFile").load(path)
        except AnalysisException as gone:
            if gone.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    return [p for p in paths if there(p)]


def record_folders(root: str) -> list[str]:
    """The record folders below ``root`` as one glob, which passes over missing ones."""
    return [f"{root.rstrip('/')}/{{{','.join(SUBFOLDERS)}}}"]


def file_manifest(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row per file below ``paths``; no file content is read.

    Spark's listing leaves out files of no bytes and names that start with a
    dot or an underscore.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    path = F.col("_metadata.file_path")
    return files.select(
        path.alias("path"),
        F.col("_metadata.file_size").alias("bytes"),
        record_type_of(path).alias("record_type"),
        format_of(path).alias("format"),
    )


def file_report(manifest: DataFrame, records: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """The manifest with the standard rows each file gave and, for files that gave none or are
    damaged, the reason. ``records`` holds a ``path`` column; ``errors`` holds ``path`` and ``error``,
    of which the report counts the rows (damaged lines) and shows one as ``detail``."""
    totals = records.groupBy("path").agg(F.count(F.lit(1)).alias("records"))
    joined = manifest.join(totals, "path", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    if errors is None:
        joined = joined.withColumns({"errors": F.lit(0).cast("long"), "detail": F.lit(None).cast("string")})
    else:
        faults = errors.groupBy("path").agg(F.count(F.lit(1)).alias("errors"), F.min("error").alias("detail"))
        joined = joined.join(faults, "path", "left").withColumn("errors", F.coalesce("errors", F.lit(0)))
    reason = (
        F.when(F.col("format").isNull(), "unsupported format")
        .when(F.col("record_type").isNull(), "unknown record type")
        .when(F.col("errors") > 0, "damaged")
        .when(F.col("records") == 0, "no valid records")
    )
    return joined.withColumn("reason", reason)
