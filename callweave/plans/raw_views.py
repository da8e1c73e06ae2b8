"""Raw record views with typical defects, derived from the star-schema tables.

The base tables hold no nulls, copies or odd spellings, so the views put them
in with plain SQL expressions that Spark and DuckDB both take; where the two
dialects differ (text type, date formatting, unnesting) there is a placeholder.
Each view keeps every row of its table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.session import spread, work_path

_TEXT = {"spark": "string", "duckdb": "varchar"}


def _time_text(ts: str, key: str, dialect: str) -> str:
    """A timestamp as text in one of five forms, null or junk, by ``key``."""
    if dialect == "spark":
        forms = (
            f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')",
            f"date_format({ts}, 'dd/MM/yyyy HH:mm:ss')",
            f"date_format({ts}, 'MM/dd/yyyy HH:mm:ss')",
            f"cast(cast(floor(unix_micros(cast({ts} as timestamp)) / 1000000) as bigint) as string)",
            f"""date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")""",
        )
    else:
        forms = (
            f"strftime({ts}, '%Y-%m-%d %H:%M:%S')",
            f"strftime({ts}, '%d/%m/%Y %H:%M:%S')",
            f"strftime({ts}, '%m/%d/%Y %H:%M:%S')",
            f"cast(cast(floor(epoch_us({ts}) / 1000000) as bigint) as varchar)",
            f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%gZ')",
        )
    cases = " ".join(f"when {i} then {form}" for i, form in enumerate(forms))
    return f"case {key} % 7 {cases} when 5 then null else '  n/a ' end"


def _clean_time_text(ts: str, dialect: str) -> str:
    return (
        f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss')"
        if dialect == "spark"
        else f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
    )


# (table, [(column, expression)]) per type; {S} is the text type, {time} the messy
# event time, {tidy} the canonical one. `rid` identifies the row.
_VIEWS = {
    "edr": (
        "events",
        ("ts", "event_id"),
        [
            ("rid", "event_id"),
            ("event_id", "case when event_id % 19 = 0 then null else concat('E', cast(event_id as {S})) end"),
            ("user_id", "cast(100000000000 + user_id as {S})"),
            (
                "device_model",
                "case event_id % 4 when 0 then 'Pixel 7' when 1 then '\"iPhone 14\"' when 2 then 'NaN' else ' ' end",
            ),
            ("os_type", "case event_id % 3 when 0 then 'Android 13' when 1 then 'iOS 16' else null end"),
            (
                "roaming_status",
                "case event_id % 6 when 0 then 'true' when 1 then 'N' when 2 then '1' when 3 then '-3'"
                " when 4 then null else 'maybe' end",
            ),
            (
                "network_type",
                "case event_id % 5 when 0 then 'WiFi' when 1 then '4G' when 2 then '5G' when 3 then '3G' else '2G' end",
            ),
            ("event_time", "{time}"),
            (
                "location",
                "concat(cast(user_id % 180 - 90 as {S}), '.5,', cast(event_id % 360 - 180 as {S}), '.25')",
            ),
            (
                "event_type",
                "case event_type when 'click' then 'app_launch' when 'view' then 'LOGIN' when 'signup' then 'SIM switch'"
                " when 'purchase' then 'payment' else 'power_on' end",
            ),
            ("is_fraud", "case when event_id % 20 = 0 then 'true' else 'False' end"),
            ("tidy_time", "{tidy}"),
        ],
    ),
    "cdr": (
        "orders",
        ("o_orderdate", "o_orderkey"),
        [
            ("rid", "o_orderkey"),
            (
                "caller_id",
                "case when o_orderkey % 23 = 0 then null else cast(1000000000000 + o_custkey as {S}) end",
            ),
            ("callee_id", "cast(1000000000000 + o_orderkey % 997 as {S})"),
            ("call_start", "{time}"),
            ("call_duration", "cast(cast(floor(o_totalprice) as bigint) % 3600 as {S})"),
            (
                "call_type",
                "case o_orderkey % 6 when 0 then 'voice_in' when 1 then 'VOICE_OUT' when 2 then 'sms_in'"
                " when 3 then 'video_in' when 4 then null else 'conference' end",
            ),
            ("cell_id", "concat('CELL_', cast(100 + o_orderkey % 900 as {S}))"),
            ("location", "concat(cast(o_custkey % 180 - 90 as {S}), '.1,', cast(o_orderkey % 360 - 180 as {S}), '.7')"),
            (
                "imei",
                "case o_orderkey % 9 when 0 then null when 1 then '' when 2 then '\"NaN\"'"
                " else concat('IMEI_', cast(100000 + o_custkey % 899999 as {S})) end",
            ),
            ("is_fraud", "case when o_orderkey % 20 = 0 then 'true' else 'false' end"),
            ("tidy_time", "{tidy}"),
        ],
    ),
    "ipdr": (
        "lineitem",
        ("l_shipdate", "(l_orderkey + l_linenumber)"),
        [
            ("rid", "l_orderkey * 100 + l_linenumber"),
            ("user_id", "cast(100000000000 + l_suppkey as {S})"),
            ("timestamp", "{time}"),
            (
                "domain",
                "case when l_partkey % 29 = 0 then null else concat('D', cast(l_partkey % 10 as {S}), '.example') end",
            ),
            ("ip_dst", "concat('10.', cast(l_suppkey % 256 as {S}), '.', cast(l_partkey % 256 as {S}), '.1')"),
            (
                "port",
                "case when l_orderkey % 17 = 0 then '443.0' when l_orderkey % 17 = 1 then 'x'"
                " else cast(1 + l_partkey % 65535 as {S}) end",
            ),
            (
                "protocol",
                "case l_linenumber % 5 when 0 then 'TCP' when 1 then 'udp' when 2 then 'HTTP' when 3 then null"
                " else 'DNS' end",
            ),
            ("duration", "cast(cast(floor(l_quantity) as bigint) as {S})"),
            ("bytes_sent", "cast(cast(floor(l_extendedprice) as bigint) as {S})"),
            (
                "bytes_received",
                "case when l_suppkey % 13 = 0 then null"
                " else cast(cast(floor(l_extendedprice * 10) as bigint) as {S}) end",
            ),
            ("vpn_usage", "case when l_returnflag = 'R' then 'yes' else 'no' end"),
            ("is_fraud", "case when l_orderkey % 20 = 0 then 'T' else 'f' end"),
            ("tidy_time", "{tidy}"),
        ],
    ),
}


def view_columns(kind: str, dialect: str) -> list[tuple[str, str]]:
    _, (ts, key), columns = _VIEWS[kind]
    return [
        (
            name,
            expr.replace("{S}", _TEXT[dialect])
            .replace("{time}", _time_text(ts, key, dialect))
            .replace("{tidy}", _clean_time_text(ts, dialect)),
        )
        for name, expr in columns
    ]


def base_table(kind: str) -> str:
    return _VIEWS[kind][0]


def read_base(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{base_table(kind)}.parquet")


def table_portions(
    spark: SparkSession, sf_dir: str, kinds: Sequence[str], most_rows: int
) -> Iterator[dict[str, DataFrame]]:
    """The base tables of ``kinds`` by portions that hold about ``most_rows`` rows together, each row in one portion.

    Tables of no more rows come as they are. Others are dealt out evenly, whatever their keys, into one folder a portion,
    so a portion costs no more than its own rows. Only the columns of the views are kept.
    """
    tables = {kind: read_base(spark, sf_dir, kind) for kind in kinds}
    many = -(-sum(table.count() for table in tables.values()) // most_rows)
    if many <= 1:
        yield tables
        return
    dealt = {}
    for kind, table in tables.items():
        used = " ".join(expr for _, expr in view_columns(kind, "spark"))
        kept = table.select(*[c for c in table.columns if c in used])
        portioned = kept.repartition(many * spark.sparkContext.defaultParallelism).withColumn(
            "portion", F.spark_partition_id() % many
        )
        path = work_path(spark, f"portions-{kind}")
        portioned.write.partitionBy("portion").parquet(path)
        dealt[kind] = spark.read.schema(portioned.schema).parquet(path)
    for k in range(many):
        yield {kind: table.where(F.col("portion") == k).drop("portion") for kind, table in dealt.items()}


def raw_records(
    spark: SparkSession, sf_dir: str, kind: str, copies: bool = False, table: DataFrame | None = None
) -> DataFrame:
    """A raw view as text columns; ``copies`` repeats every fiftieth row, ``table`` gives a portion of the base table."""
    table = spread(read_base(spark, sf_dir, kind) if table is None else table)
    view = table.selectExpr(*[f"{expr} as `{name}`" for name, expr in view_columns(kind, "spark")])
    if copies:
        view = view.selectExpr("*", "explode(sequence(1, if(rid % 50 = 0, 2, 1))) as copy_no")
    return view


def raw_sql(kind: str, copies: bool = False) -> str:
    """The same view for DuckDB."""
    picked = ", ".join(f'{expr} as "{name}"' for name, expr in view_columns(kind, "duckdb"))
    view = f"select {picked} from {base_table(kind)}"
    if copies:
        view = f"select *, unnest(range(0, case when rid % 50 = 0 then 2 else 1 end)) as copy_no from ({view}) v"
    return view
