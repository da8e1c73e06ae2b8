"""Clean tables and merged files as Parquet, CSV or JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.specs import RecordSpec

# Rows per JDBC round trip.
JDBC_BATCH_SIZE = 1000

# Spark's CSV writer trims values and escapes quotes with a backslash unless told otherwise.
PLAIN_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_merged(df: DataFrame, spec: RecordSpec, target: str, fmt: str = "csv", mode: str = "overwrite") -> str:
    """The merged set of a type in table column order, as CSV with header or Parquet."""
    path = f"{target.rstrip('/')}/final_{spec.name}.{fmt}"
    writer = df.select(*spec.fields).write.mode(mode)
    if fmt == "csv":
        writer.options(header="true", **PLAIN_CSV).csv(path)
    else:
        writer.format(fmt).save(path)
    return path


def jdbc_options(user: str, password: str, driver: str, connections: int = 32) -> dict[str, str]:
    """Options of a JDBC append. ``connections`` caps the tasks that write at once,
    since each holds a connection. The last option is PostgreSQL's batch rewrite."""
    return {
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(JDBC_BATCH_SIZE),
        "numPartitions": str(connections),
        "reWriteBatchedInserts": "true",
    }


def append_jdbc(df: DataFrame, url: str, table: str, options: dict[str, str]) -> None:
    """The shuffle keeps the cap on connections to the write; without it Spark would run the
    stages before it in that many tasks, too."""
    many = options.get("numPartitions")
    (df.repartition(int(many)) if many else df).write.jdbc(url, table, mode="append", properties=options)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def export_labelled(df: DataFrame, spec: RecordSpec, path: str, period: str = "yyyy-MM-dd") -> None:
    """A clean table for model training, one folder per event date (or other ``period``).

    The rebalance hint lets Spark split a busy date over several files and
    join small ones, by the sizes it sees at run time.
    """
    dated = df.withColumn("event_date", F.date_format(spec.event_time, period))
    dated.hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date").parquet(path)
