import random
import time

import pytest
from pyspark.sql import functions as F

from callweave.operators import cleaning, distinct
from callweave.plans import jobs
from callweave.sources import streams
from callweave.specs import CDR, EDR, SPECS
from callweave.streaming import live, progress


def body(i, time="2024-01-01 00:00:00", user="u"):
    return (
        f'{{"event_id":"e{i}","user_id":"{user}","event_time":"{time}","event_type":"SIM switch",'
        f'"network_type":"4g","is_fraud":true}}'
    )


def land(spark, path, bodies):
    spark.createDataFrame([(b,) for b in bodies], "value string").coalesce(1).write.mode("append").parquet(path)


def run(spark, feed, out, spec=EDR, **options):
    options = {"delay": None, **options}
    query = live.start_live(
        streams.file_messages(spark, feed, 1), spec, live.epoch_sink(f"{out}/t"), f"{out}/c", interval=None, **options
    )
    query.awaitTermination()
    return query


def ids(spark, out):
    return sorted(r.event_id for r in live.read_epochs(spark, f"{out}/t", EDR).collect())


def test_copies_across_batches_and_restart(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    assert live.read_epochs(spark, f"{out}/t", EDR).count() == 0
    land(spark, feed, [body(1), body(1), body(2)])
    land(spark, feed, [body(2), body(3), "not json", body(4, user=" "), body(5, time="bad")])
    run(spark, feed, out)
    assert ids(spark, out) == ["e1", "e2", "e3"]
    land(spark, feed, [body(3), body(6)])  # a copy of a row seen before the restart
    run(spark, feed, out)
    assert ids(spark, out) == ["e1", "e2", "e3", "e6"]


def test_quarantine_and_totals_over_restarts(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    places = {"quarantine": f"{out}/q", "totals": f"{out}/n"}
    assert live.read_quarantine(spark, f"{out}/q").count() == 0
    assert live.read_totals(spark, f"{out}/n", f"{out}/c", EDR.table) == {"kept": 0, "dropped": 0}
    land(spark, feed, [body(1), body(1), "not json", "[1]", body(4, user=" ")])
    run(spark, feed, out, **places)
    assert live.read_totals(spark, f"{out}/n", f"{out}/c", EDR.table) == {"kept": 1, "dropped": 3}
    land(spark, feed, [body(1), body(2), body(5, time="bad"), "not json"])
    run(spark, feed, out, **places)
    run(spark, feed, out, **places)  # nothing new
    assert ids(spark, out) == ["e1", "e2"]
    got = sorted((r.body, r.faults) for r in live.read_quarantine(spark, f"{out}/q").collect())
    foreign = ["body", "event_id", "user_id", "event_time"]
    assert got == sorted(
        [("[1]", foreign), ("not json", foreign), ("not json", foreign), (body(4, user=" "), ["user_id"]), (body(5, time="bad"), ["event_time"])]
    )
    assert live.read_totals(spark, f"{out}/n", f"{out}/c", EDR.table) == {"kept": 2, "dropped": 5}
    # an epoch that was written but never committed does not count yet
    spark.createDataFrame([(9, 9)], "kept long, dropped long").write.parquet(f"{out}/n/query=x/epoch=99")
    assert live.read_totals(spark, f"{out}/n", f"{out}/c", EDR.table) == {"kept": 2, "dropped": 5}


def test_state_holds_keys_not_rows(spark, tmp_path):
    feed = str(tmp_path / "in")
    rng = random.Random(1)
    land(spark, feed, [body(i, user=f"{rng.getrandbits(1600):x}") for i in range(2000)])

    def state_bytes(name, step):
        rows = cleaning.clean_live(streams.file_messages(spark, feed), EDR)
        live.start_sink(step(rows), live.epoch_sink(str(tmp_path / f"t{name}")), str(tmp_path / f"c{name}"), "q", None).awaitTermination()
        assert spark.read.parquet(str(tmp_path / f"t{name}")).count() == 2000
        return sum(f.stat().st_size for f in (tmp_path / f"c{name}" / "q" / "state").rglob("*") if f.is_file())

    whole = state_bytes("whole", lambda df: df.dropDuplicates())
    keys = state_bytes("keys", lambda df: distinct.distinct_stream(df))
    bounded = state_bytes("bounded", lambda df: distinct.distinct_stream(df, "event_time", "2 days"))
    assert keys < whole / 2 and bounded < whole / 2


def test_row_keys_tell_nulls_apart(spark):
    rows = spark.createDataFrame([("a", None, 1), (None, "a", 1), (None, None, None), ("", None, 1), ("a", "", 1)], "x string, y string, z int")
    keys = distinct.with_row_key(rows.unionByName(rows)).select(*distinct.ROW_KEY).collect()
    assert len(set(keys)) == 5 and len({k[0] for k in keys} | {k[1] for k in keys}) == 10


def test_without_folding_first(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, feed, [body(1), body(1)])
    run(spark, feed, out, fold_first=False, match="reference")
    (row,) = live.read_epochs(spark, f"{out}/t", EDR).collect()
    assert (row.event_type, row.network_type) == ("app_launch", "4g")


def test_watermark_drops_late_rows_only_when_asked(spark, tmp_path):
    feed = str(tmp_path / "in")
    land(spark, feed, [body(1, "2024-01-10 00:00:00")])
    land(spark, feed, [body(2, "2024-01-10 00:00:01")])
    land(spark, feed, [body(3, "2024-01-01 00:00:00")])
    run(spark, feed, str(tmp_path / "a"))
    assert ids(spark, str(tmp_path / "a")) == ["e1", "e2", "e3"]
    run(spark, feed, str(tmp_path / "b"), delay="1 day")
    assert ids(spark, str(tmp_path / "b")) == ["e1", "e2"]
    with pytest.raises(ValueError):
        distinct.distinct_stream(spark.range(1), None, "1 day")


def test_replayed_epoch_leaves_no_row_twice(spark, tmp_path):
    write = live.epoch_sink(str(tmp_path / "t"))
    rows = spark.createDataFrame([("e", "u")], "event_id string, user_id string")
    write(rows, 0)
    write(rows, 0)
    write(rows, 1)
    assert live.read_epochs(spark, str(tmp_path / "t"), EDR).count() == 2


def test_nan_token_and_odd_numbers(spark):
    df = spark.createDataFrame(
        [('{"caller_id":"a","callee_id":"b","call_start":"2024-01-01 00:00:00","imei":NaN,"call_duration":443.0}',)],
        "value string",
    )
    (row,) = cleaning.clean_live(df, CDR).collect()
    assert row.imei == '"NaN"' and row.call_duration is None and row.call_type == "voice_in"
    batch = cleaning.clean_batch(spark.createDataFrame([('"NaN"',)], "imei string"), CDR, "2024-01-01 00:00:00")
    assert batch.first().imei == "unknown"


def test_fold_copies_folds_within_batches_and_keeps_all_values(spark):
    df = spark.range(0, 5000, 1, 2).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 3 > 0, F.lit(None).cast("int")).otherwise(F.col("id").cast("int")).alias("b"),
        F.lit(None).cast("timestamp").alias("c"),
    )
    folded = distinct.fold_copies(df)
    assert folded.schema == df.schema
    assert folded.count() < 1700 + 10
    assert folded.distinct().exceptAll(df.distinct()).isEmpty() and df.distinct().exceptAll(folded.distinct()).isEmpty()


def test_three_live_queries_in_one_application(spark, tmp_path):
    feed = str(tmp_path / "in")
    land(spark, feed, [body(1)])
    queries = jobs.start_all_live(
        spark,
        lambda spec: streams.file_messages(spark, feed),
        lambda spec: live.epoch_sink(str(tmp_path / spec.table)),
        str(tmp_path / "c"),
        interval=None,
    )
    assert set(queries) == set(SPECS)
    for query in queries.values():
        query.awaitTermination()
    assert live.read_epochs(spark, str(tmp_path / "edr"), EDR).count() == 1


def test_throughput_counts_all_batches(spark, tmp_path):
    seen = progress.ThroughputLog(keep=3)
    spark.streams.addListener(seen)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            land(spark, str(tmp_path / "in"), [body(i), body(i + 1)])
        run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
        deadline = time.time() + 20  # events arrive on a thread of their own
        while "edr" not in seen.ended and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(seen)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert seen.records == {"edr": 10} and seen.errors == {"edr": 0}
    assert len(seen.entries) == 3 and max(e["records"] for e in seen.entries) == 10


def test_new_checkpoint_overwrites_nothing(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, feed, [body(1)])
    run(spark, feed, out)
    query = live.start_live(
        streams.file_messages(spark, feed), EDR, live.epoch_sink(f"{out}/t"), f"{out}/other", interval=None
    )
    with pytest.raises(Exception, match="holds the rows of"):
        query.awaitTermination()
    assert ids(spark, out) == ["e1"]


def test_state_is_bounded_by_default(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, feed, [body(1, "2024-01-10 00:00:00")])
    land(spark, feed, [body(2, "2024-01-01 00:00:00")])
    run(spark, feed, out, delay=live.DELAY)
    land(spark, feed, [body(3, "2024-01-01 00:00:00")])
    run(spark, feed, out, delay=live.DELAY)
    assert ids(spark, out) in (["e1"], ["e1", "e2"])  # the first two may share a batch


def test_jdbc_sink_skips_empty_batches(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(live, "append_jdbc", lambda df, url, table, options: calls.append(df.count()))
    write = live.jdbc_sink("jdbc:x", "edr", {})
    write(spark.range(0), 0)
    write(spark.range(3), 1)
    assert calls == [3]


def test_batch_and_live_agree_on_clean_rows(spark):
    values = {
        "caller_id": "1", "callee_id": "2", "call_start": "2024-01-01 00:00:00", "call_duration": 5,
        "call_type": "sms_in", "cell_id": "cell_1", "location": "1,2", "imei": "imei_1", "is_fraud": False,
    }
    flat = spark.createDataFrame([tuple(str(v) for v in values.values())], ", ".join(f"{k} string" for k in values))
    typed = flat.withColumn("call_duration", F.col("call_duration").cast("int")).withColumn("is_fraud", F.lit(False))
    message = typed.select(F.to_json(F.struct("*")).alias("value"))
    assert cleaning.clean_live(message, CDR).collect() == cleaning.clean_batch(flat, CDR).collect()


def test_live_messages_are_kept_and_dropped_in_one(spark):
    """One parse gives what the two frames give."""
    from callweave.operators import cleaning
    from callweave.specs import SPECS

    bodies = ["", "{", "[]", "null", "{}", '{"event_id": " "}', '{"event_id": "E1", "user_id": "1", "event_time": "2024-01-02 03:04:05"}',
              '{"event_id": "E1", "user_id": "1", "event_time": "later"}', '{"user_id": "1", "timestamp": "2024-01-02 03:04:05", "domain": "d"}',
              '{"caller_id": "1", "call_start": "2024-01-02 03:04:05", "callee_id": "2"}', None]
    df = spark.createDataFrame([(b,) for b in bodies], "value string")
    for spec in SPECS.values():
        want = cleaning.clean_live(df, spec).unionByName(cleaning.dropped_messages(df, spec), allowMissingColumns=True)
        got = cleaning.live_messages(df, spec)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_totals_alone_hold_no_batch(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from callweave.operators import cleaning
    from callweave.specs import EDR
    from callweave.streaming import live

    def refuse(*_):
        raise AssertionError("micro-batch held")

    good = '{"event_id": "E%d", "user_id": "1", "event_time": "2024-01-02 03:04:05"}'
    df = spark.createDataFrame([(good % k,) for k in range(7)] + [("{",)] * 3, "value string")
    batch = cleaning.live_messages(df, EDR)
    write = live.split_sink(live.epoch_sink(str(tmp_path / "rows")), EDR, None, str(tmp_path / "totals"))
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "persist", refuse)
        write(batch, 0)
    assert spark.read.parquet(str(tmp_path / "totals")).select("kept", "dropped").first() == (7, 3)
    assert live.read_epochs(spark, str(tmp_path / "rows"), EDR).count() == 7


def test_state_lies_on_disk_in_sessions_made_elsewhere(spark):
    from callweave.session import ROCKSDB, STATE_PROVIDER, prepare

    other = spark.newSession()
    other.conf.unset(STATE_PROVIDER)
    before = STATE_PROVIDER in other.conf.getAll
    prepare(other)
    assert before or other.conf.get(STATE_PROVIDER) == ROCKSDB
    other.conf.set(STATE_PROVIDER, "x.Own")
    assert prepare(other).conf.get(STATE_PROVIDER) == "x.Own"


def test_bodies_of_both_halves_are_made_once(spark, sf_dir, tmp_path, monkeypatch):
    from callweave.plans import queries

    made = []
    bodies = queries.message_bodies(spark, sf_dir, "edr")
    monkeypatch.setattr(queries, "message_bodies", lambda *a: made.append(a) or bodies)
    counts = [spark.read.parquet(str(tmp_path / "feed")).count() for _ in queries.landed_halves(spark, sf_dir, "edr", str(tmp_path / "feed"))]
    assert len(made) == 1 and 0 < counts[0] < counts[1] == bodies.count()
