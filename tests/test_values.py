"""Truth tables of the value functions."""

import pytest
from pyspark.sql import functions as F

from callweave import functions as V
from callweave.specs import CALL_TYPES, EVENT_TYPES, NETWORK_TYPES, PROTOCOLS


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


TIMES = {
    None: None,
    "2023-01-02 03:04:05": "2023-01-02 03:04:05",
    " 2023-1-2 3:4:5 ": "2023-01-02 03:04:05",
    "2023-01-02  03:04:05": "2023-01-02 03:04:05",
    "05/03/2023 01:02:03": "2023-03-05 01:02:03",
    "12/13/2023 01:02:03": "2023-12-13 01:02:03",
    "31/02/2023 01:02:03": "31/02/2023 01:02:03",
    "13/13/2023 01:02:03": "13/13/2023 01:02:03",
    "2023-01-01T01:02:03.123Z": "2023-01-01 01:02:03",
    "2023-01-01t01:02:03.123456z": "2023-01-01 01:02:03",
    "2023-01-01T01:02:03Z": "2023-01-01T01:02:03Z",
    "2023-02-30 01:02:03": "2023-02-30 01:02:03",
    "2023-01-01 25:02:03": "2023-01-01 25:02:03",
    "1685000000": "2023-05-25 07:33:20",
    "1.5e9": "2017-07-14 02:40:00",
    "5": "1970-01-01 00:00:05",
    "-5": "1969-12-31 23:59:55",
    "1685000000000": "1685000000000",
    "nan": "nan",
    "1e300": "1e300",
    "1d": "1d",
    " n/a ": "n/a",
    "": "",
    "20230102 03:04:05": "20230102 03:04:05",
    "12023-01-02 03:04:05": "12023-01-02 03:04:05",
}


def test_canonical_time(spark):
    assert apply(spark, V.canonical_time, list(TIMES)) == list(TIMES.values())


def test_canonical_flag(spark):
    yes = ["TRUE", " t ", "Yes", "y", "1", "2", "-1", "+7", "9" * 50]
    no = ["False", "f", "NO", "n", "0", "00", "-0"]
    none = [None, "0.5", "x", "", "1e3", "--1"]
    assert apply(spark, V.canonical_flag, yes) == [True] * len(yes)
    assert apply(spark, V.canonical_flag, no) == [False] * len(no)
    assert apply(spark, V.canonical_flag, none) == [None] * len(none)


def test_flag_or_false(spark):
    assert apply(spark, V.flag_or_false, ["T", "yes", "1", "Y"]) == [True] * 4
    assert apply(spark, V.flag_or_false, [" true ", "2", None, "x"]) == [False] * 4


def test_published_flag(spark):
    assert apply(spark, V.published_flag, [" TRUE", "t", "1", "yes", "y", "no", None]) == [
        True, True, True, True, False, False, None,
    ]


def test_strict_time(spark):
    values = ["2023-01-02 03:04:05", "2023-1-2 03:04:05", "x", None, "2023-02-30 00:00:00"]
    out = apply(spark, lambda c: V.strict_time(c).cast("string"), values)
    assert out == ["2023-01-02 03:04:05", None, None, None, None]


def test_whole_number_as_in_non_ansi_cast(spark):
    values = ["443", " 443 ", "443.0", "443.9", "-1.9", ".5", "5.", "1e3", "x", None, "3000000000", ".", "3000000000.5"]
    assert apply(spark, V.whole_number, values) == [443, 443, 443, 443, -1, 0, 5, 0, 0, 0, 0, 0, 0]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = apply(spark, lambda c: F.coalesce(c.cast("int"), F.lit(0)), values)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert apply(spark, V.whole_number, values) == plain


def test_whole_number_strict(spark):
    assert apply(spark, lambda c: V.whole_number(c, 0, cut_fraction=False), ["443", "443.0", "x", None]) == [443, 0, 0, 0]
    assert apply(spark, lambda c: V.whole_number(c, None, cut_fraction=False), ["443", "443.0"]) == [443, None]


def test_scrub_text(spark):
    values = [None, "  ", "NaN", '"NaN"', '"iPhone 14"', '"a" ', "", "UNKNOWN", 'a"b']
    assert apply(spark, V.scrub_text, values) == [
        "unknown", "unknown", "unknown", "unknown", "iphone 14", 'a"', "unknown", "unknown", 'a"b',
    ]
    assert apply(spark, lambda c: V.scrub_text(c, "TCP"), [None, "UDP"]) == ["TCP", "udp"]
    assert apply(spark, lambda c: V.scrub_text(c, "TCP", fold_default=True), [None, "UDP"]) == ["tcp", "udp"]


@pytest.mark.parametrize(
    ("valid", "fallback", "value", "casefold", "reference"),
    [
        (PROTOCOLS, "tcp", "UDP", "udp", "tcp"),
        (NETWORK_TYPES, "4g", "5G", "5g", "4g"),
        (EVENT_TYPES, "app_launch", "SIM switch", "sim switch", "app_launch"),
        (EVENT_TYPES, "app_launch", "LOGIN", "login", "login"),
        (CALL_TYPES, "voice_in", "VOICE_OUT", "voice_out", "voice_out"),
        (CALL_TYPES, "voice_in", None, "voice_in", "voice_in"),
    ],
)
def test_category(spark, valid, fallback, value, casefold, reference):
    assert apply(spark, lambda c: V.category(c, valid, fallback), [value]) == [casefold]
    assert apply(spark, lambda c: V.category(c, valid, fallback, "reference"), [value]) == [reference]


def test_category_mode_is_checked():
    with pytest.raises(ValueError):
        V.category(F.lit("x"), ["x"], "y", "fuzzy")


def test_blank_to_null(spark):
    assert apply(spark, V.blank_to_null, ["", "None", "a", None]) == [None, "None", "a", None]
    assert apply(spark, lambda c: V.blank_to_null(c, "None"), ["", "None", "a", None]) == [None, None, "a", None]


def test_run_times_are_utc(spark, monkeypatch):
    from datetime import datetime, timedelta, timezone

    from callweave.operators import cleaning
    from callweave.specs import CDR

    monkeypatch.setenv("TZ", "Asia/Kolkata")
    aware = datetime(2024, 6, 1, 12, 0, tzinfo=timezone(timedelta(hours=5)))
    df = spark.createDataFrame([("1",)], "caller_id string").withColumn("call_start", F.lit(None).cast("string"))
    for given, shown in ((aware, "2024-06-01 07:00:00"), (datetime(2024, 6, 1, 12), "2024-06-01 12:00:00")):
        row = cleaning.clean_batch(df, CDR, given).select(F.date_format("call_start", "yyyy-MM-dd HH:mm:ss")).first()
        assert row[0] == shown


def test_published_numbers_are_whole_and_long(spark):
    from callweave.operators import cleaning
    from callweave.specs import CDR, IPDR

    values = ["443.0", "abc", "3000000000", " 7 ", None]
    calls = spark.createDataFrame([(v,) for v in values], "call_duration string")
    assert [r[0] for r in cleaning.published_values(calls, CDR).collect()] == [443, None, 3000000000, 7, None]
    ports = spark.createDataFrame([(v,) for v in values], "port string")
    assert [r[0] for r in cleaning.published_values(ports, IPDR).collect()] == [443, 0, 3000000000, 7, 0]
