"""Trees that land by portions: whole results, and a disk that holds one portion's files at a time."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from callweave.plans import queries as Q
from callweave.plans.raw_views import table_portions
from callweave.session import scratch, work_path

ROWS = 1800


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Small tables of the given schema, a tenth of the rows twice, some keys and values null."""
    path = str(tmp_path_factory.mktemp("base"))
    key = F.when(F.col("id") % 97 != 5, F.col("id"))
    when = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 as int))")
    tables = {
        "orders": [
            key.alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"),
            (F.col("id") * 1.5).alias("o_totalprice"), when.alias("o_orderdate"),
        ],
        "lineitem": [
            key.alias("l_orderkey"), F.when(F.col("id") % 31 != 3, F.col("id") % 40).alias("l_partkey"), (F.col("id") % 20).alias("l_suppkey"),
            (F.col("id") % 7).cast("int").alias("l_linenumber"), (F.col("id") % 9 * 1.0).alias("l_quantity"),
            (F.col("id") * 2.5).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"), when.alias("l_shipdate"),
        ],
        "events": [
            key.alias("event_id"), (F.col("id") % 60).alias("user_id"), when.alias("ts"),
            F.when(F.col("id") % 2 == 0, "click").alias("event_type"),
        ],
    }
    for name, columns in tables.items():
        rows = spark.range(0, ROWS, 1, 4).select(F.explode(F.when(F.col("id") % 10 == 0, F.array("id", "id")).otherwise(F.array("id"))).alias("id"))
        rows.select(*columns).write.parquet(f"{path}/{name}.parquet")
    return path


def landed(spark):
    """The record files in the shared folder."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    return {p for kind in ("json", "jsonl", "json.gz", "xml", "txt") for p in shared.rglob(f"*.{kind}")}


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "query, limit, tree, many",
    [("crawl_files", "CRAWL_ROWS", "_crawl_root", 5940), ("crawl_report", "DAMAGED_ROWS", "_damaged_root", 1980), ("standardize_job", "DAMAGED_ROWS", "_damaged_root", 1980)],
)
def test_portions_give_the_whole_result_with_one_tree_at_a_time(spark, base, monkeypatch, query, limit, tree, many):
    before, make, trees = landed(spark), getattr(Q, tree), []

    def watched(*given):
        assert landed(spark) == before  # of the tree before this one nothing is left
        root = make(*given)
        trees.append(len(landed(spark) - before))
        return root

    monkeypatch.setattr(Q, tree, watched)
    whole = rows_of(Q.QUERIES[query](spark, base))
    assert len(trees) == 1 and trees[0] > 0 and landed(spark) == before
    monkeypatch.setattr(Q, limit, many // 2)
    by_portion = rows_of(Q.QUERIES[query](spark, base))
    assert len(trees) == 3 and landed(spark) == before
    assert by_portion == whole


def test_each_row_is_in_one_portion(spark, base):
    want = {k: spark.read.parquet(f"{base}/{t}.parquet") for k, t in (("cdr", "orders"), ("edr", "events"))}
    got, sizes = {k: Counter() for k in want}, []
    for tables in table_portions(spark, base, list(want), 1000):
        for kind, table in tables.items():
            got[kind] += rows_of(table.select(*want[kind].columns))
        sizes.append(sum(table.count() for table in tables.values()))
    assert got == {k: rows_of(df) for k, df in want.items()}
    assert len(sizes) == 4 and max(sizes) < 1200


def test_tables_within_the_limit_are_read_as_they_are(spark, base):
    (tables,) = table_portions(spark, base, ["cdr"], 1980)
    assert tables["cdr"].inputFiles() == spark.read.parquet(f"{base}/orders.parquet").inputFiles()


def test_no_rows_are_one_portion(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/orders.parquet")
    assert [list(t) for t in table_portions(spark, str(tmp_path), ["cdr"], 10)] == [["cdr"]]


def test_scratch_lets_its_files_go_also_after_a_failure(spark):
    kept = work_path(spark, "kept")
    with scratch(spark, "outer") as outer:
        first = work_path(spark, "a")
        spark.range(10).write.parquet(first)
        with pytest.raises(ZeroDivisionError), scratch(spark, "inner") as inner:
            spark.range(10).write.parquet(work_path(spark, "b/c"))
            1 / 0
        assert inner.startswith(outer) and first.startswith(outer)
        assert spark.read.parquet(inner).isEmpty() and not [p for p in Path(inner).iterdir() if p.is_dir()]
        assert spark.read.parquet(first).count() == 10
    assert not [p for p in Path(outer).iterdir() if p.is_dir()]
    assert Path(work_path(spark, "kept")).parent == Path(kept).parent
