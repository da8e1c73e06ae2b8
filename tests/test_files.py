"""Hand-made files: odd layouts, broken files, routing."""

import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from callweave.operators import naming, quality
from callweave.plans import jobs
from callweave.sinks import exports, tables
from callweave.sources import crawl, listing, merged, record_files
from callweave.specs import CDR, EDR, IPDR

CALL = {"a_number": "1", "b_number": "2", "setup_time": "1685000000", "duration": 7, "imei": None, "is_fraud": True}


@pytest.fixture
def tree(tmp_path):
    for sub in ("cdr_subdir/deep", "edr_subdir"):
        (tmp_path / sub).mkdir(parents=True)
    cdr, edr = tmp_path / "cdr_subdir", tmp_path / "edr_subdir"
    (cdr / "a.json").write_text(json.dumps([CALL, {"zzz": 1}], indent=2))
    (cdr / "cut.json").write_text(json.dumps([CALL], indent=2)[:40])
    (cdr / "object.json").write_text(json.dumps(CALL))
    (cdr / "numbers.json").write_text("[1, 2]")
    (cdr / "empty.json").write_text("")
    with gzip.open(cdr / "b.json.gz", "wt") as f:
        json.dump([CALL, CALL], f)
    (cdr / "c.csv").write_text('imei,called_party,calling_party,imei\n,9,8,I7\n"x",9,8\n1,2,3,4,5\n\n')
    (cdr / "quoted break.csv").write_text('caller_id,location\n3,"1.0,\n2.0"\n4,"say ""hi"""\n')
    (cdr / "deep" / "cdr_x.xml").write_text(
        '<?xml version="1.0" ?>\n<cdr_data>\n  <cdr_record>\n    <caller_id>007</caller_id>\n'
        "    <is_fraud>TRUE</is_fraud><bts_id>None</bts_id><imei></imei></cdr_record>\n"
        "  <more><cdr_record><a_number>8</a_number></cdr_record></more>\n</cdr_data>"
    )
    with zipfile.ZipFile(cdr / "d.csv.zip", "w") as z:
        z.writestr("first.csv", 'caller_id,location,note\n5,"1,2",n\n6,,\n')
        z.writestr("second.csv", "caller_id\n99\n")
    (cdr / "bad.csv.zip").write_bytes(b"no archive")
    (cdr / "EDR_cdr.json").write_text(json.dumps([{"event_id": "e"}]))
    (edr / "part1.json").write_text(json.dumps([{"session_id": "s", "NaN": "x"}]))
    (edr / "notes.txt").write_text("x")
    return tmp_path


def folders(spark, tree):
    return listing.record_folders(str(tree))


def test_missing_subfolder_is_skipped(spark, tree):
    assert listing.file_manifest(spark, folders(spark, tree)).count() > 0
    assert crawl.crawl(spark, str(tree / "cdr_subdir" / "deep")) == {}


def test_json(spark, tree):
    rows = naming.resolve_records(record_files.read_json_arrays(spark, folders(spark, tree), CDR), CDR, keep=["path"])
    (row,) = rows.collect()
    assert row.path.endswith("a.json")
    assert (row.caller_id, row.call_start, row.call_duration, row.is_fraud) == ("1", "2023-05-25 07:33:20", "7", True)
    edr = record_files.read_json_arrays(spark, folders(spark, tree), EDR)
    assert sorted(r.path.rsplit("/", 1)[1] for r in edr.collect()) == ["EDR_cdr.json", "part1.json"]


def test_gzip(spark, tree):
    assert record_files.read_gzip_json(spark, folders(spark, tree), CDR).count() == 2


def test_csv(spark, tree):
    rows = record_files.read_csv_files(spark, folders(spark, tree), CDR)
    got = sorted((r.caller_id, r.callee_id or "", r.imei or "", r.location or "") for r in rows.collect())
    assert got == [
        ("3", "", "", "1.0,\n2.0"),
        ("3", "2", "4", ""),
        ("4", "", "", 'say "hi"'),
        ("8", "9", "", ""),
        ("8", "9", "I7", ""),
    ]
    assert record_files.read_csv_files(spark, folders(spark, tree), IPDR).count() == 0


def test_only_files_with_quoted_breaks_lose_splitting(spark, tree):
    headers = record_files.csv_headers(spark, folders(spark, tree), CDR).collect()
    assert {h.header.split(",")[0]: h.quoted_breaks for h in headers} == {"imei": False, "caller_id": True}
    plain = record_files.read_csv_records(spark, folders(spark, tree), CDR)
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("FileScan csv") == 1


def test_xml(spark, tree):
    rows = record_files.read_xml_files(spark, folders(spark, tree), CDR).collect()
    got = sorted((r.caller_id, r.is_fraud, r.cell_id, r.imei) for r in rows)
    assert got == [("007", True, None, None), ("8", None, None, None)]


def test_xml_session_with_two_duration_names(spark, tmp_path):
    (tmp_path / "ipdr.xml").write_text(
        "<d><ipdr_record><connection_time>t</connection_time><duration>5</duration></ipdr_record></d>"
    )
    (row,) = record_files.read_xml_files(spark, [str(tmp_path)], IPDR).collect()
    assert row.duration == "t"
    (tmp_path / "ipdr.xml").write_text(
        "<d><ipdr_record><duration>5</duration><connection_time>t</connection_time></ipdr_record></d>"
    )
    (row,) = record_files.read_xml_files(spark, [str(tmp_path)], IPDR).collect()
    assert row.duration == "5"  # record order decides


def test_damaged_files_count_whole_or_not_at_all(spark, tmp_path):
    good = "<d><cdr_record><caller_id>1</caller_id></cdr_record><cdr_record><imei>None</imei></cdr_record>"
    (tmp_path / "cdr_cut.xml").write_text(good)
    (tmp_path / "cdr_whole.XML").write_text(good + "</d>")
    packed = gzip.compress(json.dumps([CALL] * 50_000).encode())
    (tmp_path / "cdr_cut.json.gz").write_bytes(packed[: len(packed) // 2])
    (tmp_path / "cdr_mixed.json").write_text(json.dumps([CALL, 1]))
    (tmp_path / "cdr_lines.jsonl").write_text(json.dumps(CALL) + "\n{\"a_number\": \n\n" + json.dumps(CALL) + "\n")
    tree = crawl.open_tree(spark, [str(tmp_path)])
    parsed = crawl.parse_type(tree, CDR)
    rows = crawl.crawl_type(tree, CDR, parsed=parsed)
    got = sorted((r.path.rsplit("/", 1)[1], r.caller_id or "") for r in rows.collect())
    assert got == [("cdr_lines.jsonl", "1"), ("cdr_lines.jsonl", "1"), ("cdr_whole.XML", ""), ("cdr_whole.XML", "1")]
    report = listing.file_report(listing.file_manifest(spark, [str(tmp_path)]), rows, crawl.errors_of(parsed))
    faults = {r.path.rsplit("/", 1)[1]: (r.reason, r.errors) for r in report.collect()}
    assert faults == {
        "cdr_cut.xml": ("damaged", 1), "cdr_whole.XML": (None, 0), "cdr_cut.json.gz": ("damaged", 1),
        "cdr_mixed.json": ("damaged", 1), "cdr_lines.jsonl": ("damaged", 1),
    }


def odd_files(folder):
    """Files that Python's parsers refuse in ways of their own."""
    (folder / "deep.json").write_text('[{"a":' * 100_000)
    (folder / "encoding.xml").write_text('<?xml version="1.0" encoding="x-nobody"?><d><cdr_record/></d>')
    (folder / "bytes.xml").write_bytes(b"<d><cdr_record><a>\xff\xfe</a></cdr_record></d>")
    (folder / "bytes.json").write_bytes(b'[{"a": "\xff\xfe"}]')
    (folder / "halves.json").write_text('[{"a_number": "\\ud800", "\\udfff": 1}]')
    with zipfile.ZipFile(folder / "plain.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "caller_id,note\n" + "4," + "w" * 1_000_000 + "\n")
    data = (folder / "plain.csv.zip").read_bytes()
    central = data.rindex(b"PK\1\2")

    def changed(name, local, directory, value):
        odd = bytearray(data)
        odd[local], odd[central + directory] = value, value
        (folder / name).write_bytes(bytes(odd))

    changed("locked.csv.zip", 6, 8, 1)  # encrypted
    changed("method.csv.zip", 8, 10, 97)  # packed in a way that is not supported
    with zipfile.ZipFile(folder / "no entry.csv.zip", "w"):
        pass
    (folder / "no gzip.json.gz").write_bytes(b"[]")
    (folder / "bomb.json.gz").write_bytes(gzip.compress(b"[" + b" " * 30_000_000 + b'{"a_number": 3}' + b" " * 30_000_000))


ODD = {
    "deep.json": "RecursionError", "encoding.xml": "encoding", "bytes.xml": "ParseError", "bytes.json": "Unicode",
    "locked.csv.zip": "RuntimeError", "method.csv.zip": "NotImplementedError", "no%20entry.csv.zip": "IndexError",
    "no%20gzip.json.gz": "error", "bomb.json.gz": "ValueError",
}


def test_no_file_ends_a_crawl(spark, tree, tmp_path):
    odd_files(tree / "cdr_subdir")
    merged_dir = str(tmp_path / "final")
    jobs.standardize_files(spark, str(tree), merged_dir)
    report = {r.path.rsplit("/", 1)[1]: r for r in jobs.read_report(spark, merged_dir).collect()}
    for name, said in ODD.items():
        assert report[name].reason == "damaged" and report[name].records == 0 and said in report[name].detail, report[name]
    assert report["a.json"].records == 1 and report["plain.csv.zip"].records == 1 and report["halves.json"].records == 1
    rows = merged.read_merged(spark, merged_dir, CDR)
    assert rows.count() == 12 + 2  # those of the tree, the wide one, the one with halves of signs


def test_long_files_are_parsed_twice_in_bounded_memory(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(record_files, "HELD_ROWS", 10)
    (tmp_path / "cdr.json").write_text(json.dumps([CALL] * 25_000))
    (tmp_path / "cdr_cut.json").write_text(json.dumps([CALL] * 100)[:-1])
    found = record_files.read_whole(spark, [str(tmp_path)], "json")
    assert found.where("record is not null").count() == 25_000 and found.where("error is not null").count() == 1


def test_zip(spark, tree):
    rows = record_files.read_zip_csv(spark, folders(spark, tree), CDR).collect()
    assert [(r.record["caller_id"], r.record["location"]) for r in rows] == [("5", "1,2"), ("6", None)]
    (bad,) = record_files.read_zip_csv(spark, folders(spark, tree), CDR, errors=True).collect()
    assert bad.path.endswith("bad.csv.zip") and "BadZipFile" in bad.error


def test_zip_with_bad_text_counts_for_nothing(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "cdr.csv.zip", "w") as z:
        z.writestr("a.csv", b"caller_id\n5\n\xff\xfe\n")
    assert record_files.read_zip_csv(spark, [str(tmp_path)], CDR).count() == 0


def test_crawl_and_report(spark, tree):
    found = crawl.crawl(spark, str(tree))
    assert {k: v.count() for k, v in found.items()} == {"cdr": 1 + 2 + 5 + 2 + 2, "ipdr": 0, "edr": 2}
    report = listing.file_report(
        listing.file_manifest(spark, folders(spark, tree)),
        found["cdr"].select("path").unionByName(found["edr"].select("path")),
    )
    faults = {r.path.rsplit("/", 1)[1]: r.reason for r in report.collect() if r.reason}
    assert faults == {
        "cut.json": "no valid records",
        "object.json": "no valid records",
        "numbers.json": "no valid records",
        "bad.csv.zip": "no valid records",
        "notes.txt": "unsupported format",
    }


def test_routing(spark):
    paths = {
        "x/ipdr_a.csv": ("ipdr", "csv"),
        "edr_subdir/part1.json": ("edr", "json"),
        "in/EDR_cdr.xml": ("edr", "xml"),
        "misc/a.csv": (None, "csv"),
        "cdr/deep/a.json.gz": (None, "gzip_json"),
        "cdr/a.CSV.ZIP": ("cdr", "zip_csv"),
        "cdr/a.parquet": ("cdr", None),
    }
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    rows = df.select("p", listing.record_type_of(F.col("p")).alias("t"), listing.format_of(F.col("p")).alias("f"))
    assert {r.p: (r.t, r.f) for r in rows.collect()} == paths


def test_exports_keep_values(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a, b", ' "q" ', True), (None, "é\\n", False)], "caller_id string, location string, is_fraud boolean"
    )
    want = {(r.caller_id, r.location, r.is_fraud) for r in rows.collect()}

    def got(df):
        return {(r.caller_id, r.location, r.is_fraud) for r in df.collect()}

    exports.export_csv(rows, str(tmp_path / "cdr_csv"))
    assert got(record_files.read_csv_files(spark, [str(tmp_path / "cdr_csv")], CDR)) == want
    exports.export_json_arrays(rows, str(tmp_path / "j"), rows_per_file=1)
    assert got(naming.resolve_records(record_files.read_json_arrays(spark, [str(tmp_path / "j")]), CDR)) == want
    exports.export_json(rows, str(tmp_path / "l"), gzip=True)
    lines = record_files.read_json_lines(spark, [str(tmp_path / "l")], glob="*.json.gz")
    assert got(naming.resolve_records(lines, CDR)) == want
    exports.export_xml(rows, str(tmp_path / "cdr_x"), "cdr_data", "cdr_record")
    assert got(record_files.read_xml_files(spark, [str(tmp_path / "cdr_x")], CDR)) == want
    text = "".join(p.read_text() for p in (tmp_path / "cdr_x").glob("part-*"))
    assert "<cdr_data>" in text and "null" not in text


def test_merged_under_alternative_name_and_absent(spark, tmp_path):
    (tmp_path / "finaledr.csv").write_text("event_id,user_id\ne,u\n")
    assert merged.read_merged(spark, str(tmp_path), EDR).first().event_id == "e"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        merged.read_merged(spark, str(tmp_path), CDR)


def test_jobs_end_to_end(spark, tree, tmp_path):
    merged_dir = str(tmp_path / "final")
    coverage = jobs.standardize_files(spark, str(tree), merged_dir)
    shares = {r.field: r.coverage for r in coverage["cdr"].collect()}
    assert shares["caller_id"] == 100.0 and all(0 <= v <= 100 for v in shares.values())
    assert set(coverage) == {"cdr", "edr"}  # no empty set for a type without files
    report = {r.path.rsplit("/", 1)[1]: r for r in jobs.read_report(spark, merged_dir).collect()}
    assert report["a.json"].records == 1 and report["a.json"].reason is None
    assert report["bad.csv.zip"].reason == "damaged" and "BadZipFile" in report["bad.csv.zip"].detail
    assert report["notes.txt"].reason == "unsupported format"

    written = {}
    log = jobs.process_batch(
        spark,
        merged_dir,
        lambda df, spec: written.update({spec.name: df.collect()}),
        types=["cdr", "edr"],
        run_ts="2024-06-01 00:00:00",
    )
    by_table = {m["table"]: m for m in log}
    assert by_table["cdr"]["records_before_cleaning"] == 12
    assert by_table["cdr"]["records_after_cleaning"] == len(written["cdr"]) == 10  # three equal calls fold to one
    assert by_table["cdr"]["dropped_records"] == 2
    assert all(r.caller_id and r.call_start for r in written["cdr"])

    sent = []
    report = jobs.publish(spark, merged_dir, lambda df: sent.extend(df.collect()), types=["cdr"], keyed=True)
    assert report[0]["records_sent"] == len(sent) == 12
    body = json.loads(sent[0].value)
    assert set(body) == set(CDR.fields) and sent[0].topic == "cdr" and sent[0].key == body["caller_id"]

    def refuse(df):
        raise OSError("broker gone")

    (failed,) = jobs.publish(spark, merged_dir, refuse, types=["cdr"])
    assert failed["errors"] == 1 and "broker gone" in failed["error"] and failed["records_sent"] == 0
    assert quality.field_coverage(spark.createDataFrame([], "a string"), ["a"]).first().coverage is None


def test_jdbc_options():
    options = tables.jdbc_options("u", "p", "org.postgresql.Driver", connections=8)
    assert options["batchsize"] == "1000" and options["numPartitions"] == "8"


def test_labelled_export(spark, tmp_path):
    df = spark.sql("select 'u' user_id, timestamp'2024-01-02 03:04:05' event_time, true is_fraud")
    tables.export_labelled(df, EDR, str(tmp_path / "x"))
    assert (tmp_path / "x" / "event_date=2024-01-02").is_dir()
