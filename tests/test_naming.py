import json

import pytest
from pyspark.sql import functions as F

from callweave.operators import naming
from callweave.specs import CDR, EDR, IPDR, SPECS, spec_for


def records(spark, *maps):
    bodies = spark.createDataFrame([(json.dumps(m),) for m in maps], "body string")  # a dict would lose its order
    return bodies.select(F.from_json("body", "map<string,string>").alias("record"))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_number_of_accepted_names():
    # connection_time counts for two columns of a session, so 40 of its 41 entries are distinct
    assert [len(SPECS[k].name_lookup()) for k in ("ipdr", "edr", "cdr")] == [40, 37, 33]


def test_unknown_type():
    with pytest.raises(ValueError):
        spec_for("sms")


def test_first_present_name_wins_even_if_null(spark):
    df = records(spark, {"url": None, "host": "h"})
    assert one(naming.resolve_records(df, IPDR))["domain"] is None
    assert one(naming.resolve_records(df, IPDR, policy="first_non_null"))["domain"] == "h"


def test_record_order_decides(spark):
    df = records(spark, {"host": "a", "domain": "b"})
    assert one(naming.resolve_records(df, IPDR))["domain"] == "a"


def test_connection_time_is_a_duration_for_sessions_only(spark):
    df = records(spark, {"connection_time": "05/03/2023 01:02:03", "session_duration": "5"})
    row = one(naming.resolve_records(df, IPDR))
    assert row["timestamp"] is None and row["duration"] == "05/03/2023 01:02:03"
    assert one(naming.resolve_records(df, CDR))["call_start"] == "2023-03-05 01:02:03"


def test_home_network_is_taken_as_roaming(spark):
    assert one(naming.resolve_records(records(spark, {"home_network": "yes"}), EDR))["roaming_status"] is True


def test_foreign_records(spark):
    df = records(spark, {"zzz": "1"}, {"user_id": None}, {})
    assert naming.resolve_records(df, EDR).count() == 1
    assert naming.resolve_records(df, EDR, policy="first_non_null").count() == 1
    assert naming.unmapped_records(df, EDR).count() == 2


def test_missing_fields(spark):
    df = records(spark, {"user_id": None, "log_time": "5"})
    missing = df.select(naming.missing_fields(EDR).alias("m")).first().m
    assert missing == [f for f in EDR.fields if f not in ("user_id", "event_time")]


def test_legacy_names_only_on_request(spark):
    df = records(spark, {"bytes": "7", "user_id": "u"})
    assert one(naming.resolve_records(df, IPDR))["bytes_sent"] is None
    assert one(naming.resolve_records(df, IPDR, legacy=True))["bytes_sent"] == "7"


def test_wide_columns(spark):
    df = spark.createDataFrame([(None, "b", "x")], "host string, domain string, other string")
    assert one(naming.resolve_wide(df, IPDR))["domain"] == "b"
    assert one(naming.resolve_wide(df, IPDR, policy="first_present"))["domain"] is None
    assert naming.resolve_wide(df.select("other"), IPDR).count() == 0


def test_positional_names(spark):
    df = spark.createDataFrame([("a", "b")], "_c0 string, _c1 string")
    assert naming.name_positional(df, CDR).columns == ["caller_id", "callee_id"]


def test_policy_is_checked(spark):
    with pytest.raises(ValueError):
        naming.resolve_records(records(spark, {"a": "b"}), CDR, policy="last")


def test_merge_keeps_copies(spark):
    a = spark.createDataFrame([("x",)], "caller_id string")
    merged = naming.merge_standard([a, a.withColumn("imei", F.lit("i"))], CDR)
    assert merged.columns == list(CDR.fields)
    assert sorted((r.caller_id, r.imei or "") for r in merged.collect()) == [("x", ""), ("x", "i")]
