"""Skewed fixtures against brute force, and the shape of plans."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from callweave.operators import cleaning, distinct, naming, quality, timeline
from callweave.plans import queries as Q
from callweave.plans.raw_views import raw_records
from callweave.session import work_path
from callweave.specs import CDR, EDR, IPDR


PYTHON_STEPS = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "MapInPython")


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def calls(spark, n, hot_share):
    """Calls of which a share belongs to one caller, some at the very same time."""
    hot = F.col("id") < int(n * hot_share)
    return spark.range(0, n, 1, 4).select(
        F.when(hot, F.lit("default_caller")).otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("caller_id"),
        F.col("id").cast("string").alias("callee_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("id") / 40)).alias("call_start"),
        F.col("id").cast("int").alias("call_duration"),
        F.lit("voice_in").alias("call_type"),
        F.lit("x").alias("cell_id"),
        F.lit("y").alias("location"),
        F.lit("z").alias("imei"),
        (F.col("id") % 20 == 0).alias("is_fraud"),
    )


def brute_force(rows):
    ordered = sorted(rows, key=lambda r: (r.subscriber, r.ts, r.source_rank, r.payload))
    seq, out = {}, []
    for r in ordered:
        seq[r.subscriber] = seq.get(r.subscriber, 0) + 1
        out.append((r.subscriber, seq[r.subscriber], r.payload))
    return out


def test_timeline_of_a_hot_subscriber(spark):
    df = calls(spark, 4000, 0.4)
    want = brute_force(timeline.merge_entries({"cdr": df}).collect())
    got = timeline.numbered_timeline({"cdr": df}).collect()
    assert sorted((r.subscriber, r.seq, r.payload) for r in got) == sorted(want)
    ordered = timeline.subscriber_timeline({"cdr": df}).collect()
    assert [(r.subscriber, r.payload) for r in ordered] == [(s, p) for s, _, p in want]


def test_hot_subscriber_lies_in_several_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        entries = timeline.merge_entries({"cdr": calls(spark, 4000, 0.5)})
        parts = entries.repartitionByRange(8, *timeline.SORT_KEYS).withColumn("p", F.spark_partition_id())
        sizes = {r.p: r["count"] for r in parts.groupBy("p").count().collect()}
        hot = parts.where("subscriber = 'default_caller'").select("p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert hot >= 3 and max(sizes.values()) < 4000 / 4


def test_hot_row_folds_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 4).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    assert distinct.distinct_rows(df).count() == 20001
    text = plan(distinct.distinct_rows(df))
    assert text.count("HashAggregate") >= 2 and "SortAggregate" not in text


def test_metrics_in_one_scan(spark, sf_dir):
    text = plan(quality.clean_metrics(Q.cleaned_rows(spark, sf_dir, "edr"), "edr"))
    assert text.count("Scan parquet") <= 2  # listed once in the tree, once in the details
    assert not any(word in text for word in PYTHON_STEPS)


def test_scans_read_only_the_columns_needed(spark, sf_dir):
    df = raw_records(spark, sf_dir, "ipdr").select("rid", "protocol")
    schema = next(line for line in plan(df).splitlines() if line.startswith("ReadSchema"))
    assert schema == "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>"


def test_bodies_are_parsed_once(spark, sf_dir):
    messages = spark.createDataFrame([("{}",)], "value string")
    text = plan(cleaning.clean_live(messages, IPDR))
    assert text.count("from_json(") == 1 and not any(word in text for word in PYTHON_STEPS)


def test_names_are_translated_once(spark):
    records = spark.createDataFrame([({"a": "b"},)], "record map<string,string>")
    text = plan(naming.resolve_records(records, IPDR))
    assert text.count("lambdafunction(map(") <= 1 and not any(word in text for word in PYTHON_STEPS)


def test_files_of_other_types_are_not_opened(spark, tmp_path):
    from callweave.sources.record_files import _reader, _routed

    for kind in ("cdr", "edr", "ipdr"):
        (tmp_path / f"{kind}.json").write_text("[]")
    spark.conf.set("spark.sql.files.openCostInBytes", "134217728")  # a partition per file
    try:
        files = _routed(_reader(spark, "*.json").text([str(tmp_path)], wholetext=True), EDR)
        assert files.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_clean_is_idempotent(spark, sf_dir):
    once = Q.clean_table(spark, sf_dir, "cdr")
    again = cleaning.clean_batch(once, CDR, Q.RUN_TS)
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()


def test_work_path_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        work_path(Session(), "x")


def test_places_count_on_over_batches(spark):
    """Subscribers, null among them, that go on from one Arrow batch to the next."""
    import pyarrow as pa

    from callweave.operators.timeline import _places

    def parts(rows):
        for part in rows:
            yield from _places(
                pa.RecordBatch.from_pydict({"subscriber": pa.array(b, pa.string()), "ts": pa.array(range(len(b)))})
                for b in ([], [None, None, "a"], ["a"], ["a", "a", "b", "c", "c"], ["d"], ["e"])
            )

    # the workers' task context is there in a job only
    got = spark.sparkContext.parallelize([0], 1).mapPartitions(lambda r: [b.to_pydict() for b in parts(r)]).collect()
    assert [p for b in got for p in b["place"]] == [1, 2, 1, 2, 3, 4, 1, 1, 2, 1, 1]
    assert {s for b in got for s in b["slice"]} == {0}
