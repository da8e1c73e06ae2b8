"""Large files in splits and as streams against the same files read whole."""

import csv
import gzip
import io
import json
import random
import zipfile

import pytest

from callweave.sources import content, merged, record_files, splits
from callweave.specs import CDR


@pytest.fixture
def tiny_splits(spark, monkeypatch):
    """Every file counts as large and is cut into splits of 1000 bytes."""
    monkeypatch.setattr(record_files, "WHOLE_LIMIT", 10)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(json.dumps([r.path.rsplit("/", 1)[1], r.record], sort_keys=True) for r in df.collect())


def faults_of(df):
    return {r.path.rsplit("/", 1)[1] for r in df.collect() if r.error is not None}


VALUES = ["x", "", "é🙂", 'q"q', "}", "{", "]", "\\", 'a\\"}', "l\nl", None, True, 7, 1.5, {"n": [{"m": "}"}]}, [1, {"z": "]"}], "w" * 900]


def random_records(rng, many):
    return [{k: rng.choice(VALUES) for k in rng.sample(["a", "b}", "c\"", "d"], rng.randint(0, 4))} for _ in range(many)]


def write_arrays(folder):
    rng = random.Random(5)
    arrays = {"empty.json": [], "one.json": [{"a": "}"}]} | {f"r{k}.json": random_records(rng, 40) for k in range(4)}
    for k, (name, records) in enumerate(arrays.items()):
        (folder / name).write_text(json.dumps(records, indent=k % 3 or None, ensure_ascii=k % 2 == 0), encoding="utf-8")
    whole = json.dumps(random_records(rng, 30))
    damaged = {
        "cut.json": whole[: len(whole) // 2], "cut2.json": whole[:-1], "tail.json": whole + " x", "twice.json": whole + whole,
        "mixed.json": "[1, " + whole[1:], "comma.json": whole[:-1] + ",]", "missing.json": whole.replace("}, {", "} {", 1),
        "object.json": json.dumps({"a": [1]}), "quote.json": whole[:-1] + ', {"a": "}]', "words.json": "no json at all, but long enough",
    }
    for name, text in damaged.items():
        (folder / name).write_text(text, encoding="utf-8")
    return set(damaged)


def test_json_arrays_in_splits(spark, tmp_path, tiny_splits, monkeypatch):
    damaged = write_arrays(tmp_path)
    found = record_files.read_whole(spark, [str(tmp_path)], "json")
    measured = record_files._reader(spark, "r0.json").option("lineSep", "}").text(str(tmp_path))
    assert measured.rdd.getNumPartitions() > 3  # one file, several tasks
    got, bad = rows_of(found.where("record is not null")), faults_of(found)
    monkeypatch.setattr(record_files, "WHOLE_LIMIT", 10**9)
    whole = record_files.read_whole(spark, [str(tmp_path)], "json")
    assert got == rows_of(whole.where("record is not null")) and len(got) == 161
    assert bad == faults_of(whole) == damaged
    assert found.where("error is not null").count() == len(damaged)


def test_gzip_as_stream(spark, tmp_path, tiny_splits):
    records = random_records(random.Random(6), 200)
    data = json.dumps(records).encode()
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(data))
    (tmp_path / "members.json.gz").write_bytes(gzip.compress(data[:700]) + gzip.compress(data[700:]))
    (tmp_path / "cut.json.gz").write_bytes(gzip.compress(data)[:-300])
    (tmp_path / "end.json.gz").write_bytes(gzip.compress(data[:-1]))
    found = record_files.read_whole(spark, [str(tmp_path)], "gzip_json")
    assert faults_of(found) == {"cut.json.gz", "end.json.gz"}
    assert found.where("record is not null").count() == 400


def test_zip_as_stream(spark, tmp_path, tiny_splits):
    text = 'a,b,a\n1,"x\ny",\n2,' + "w" * 300_000 + ",3\n\n" + "".join(f"{k},v,\n" for k in range(2000))
    for name, method in (("packed", zipfile.ZIP_DEFLATED), ("stored", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(tmp_path / f"{name}.csv.zip", "w", method) as z:
            z.writestr("first.csv", text)
            z.writestr("second.csv", "a\n99\n")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open("first.csv", "w", force_zip64=True) as entry:
        entry.write(text.encode())
    (tmp_path / "wide.csv.zip").write_bytes(out.getvalue())
    packed = bytearray((tmp_path / "packed.csv.zip").read_bytes())
    (tmp_path / "cut.csv.zip").write_bytes(packed[:500])
    packed[14] ^= 1
    (tmp_path / "crc.csv.zip").write_bytes(bytes(packed))
    found = record_files.read_whole(spark, [str(tmp_path)], "zip_csv")
    assert faults_of(found) == {"cut.csv.zip", "crc.csv.zip"}
    assert found.where("record is not null").count() == 3 * 2002
    assert found.where("record['b'] = 'x\ny' and record['a'] is null").count() == 3


def test_xml_as_stream(spark, tmp_path, tiny_splits, monkeypatch):
    body = "".join(
        f"<cdr_record><caller_id>{k}</caller_id><location>a &gt; b</location><more><cdr_record><imei>i{k}</imei></cdr_record></more></cdr_record>\n"
        for k in range(60)
    )
    (tmp_path / "a.xml").write_text(f"<?xml version='1.0'?>\n<d>{body}</d>\n")
    (tmp_path / "cut.xml").write_text(f"<d>{body}")
    (tmp_path / "cdr_subdir").mkdir()
    for name in ("a.xml", "cut.xml"):
        (tmp_path / "cdr_subdir" / name).write_text((tmp_path / name).read_text())
    found = record_files.read_whole(spark, [str(tmp_path)], "xml", CDR, glob="*.xml")
    found = found.where("path like '%/cdr_subdir/%'")
    assert faults_of(found) == {"cut.xml"} and found.where("record is not null").count() == 120
    monkeypatch.setattr(record_files, "WHOLE_LIMIT", 10**9)
    whole = record_files.read_whole(spark, [str(tmp_path)], "xml", CDR, glob="*.xml").where("path like '%/cdr_subdir/%'")
    assert rows_of(found.where("record is not null")) == rows_of(whole.where("record is not null"))


def random_csv(rng, rows):
    out = ["caller_id,location,imei"]
    cells = ["", "1", '"a,b"', '"l\nl"', '"q""q"', '"\n\n"', 'st"ray', '"x"y', "é", '"' + "w\n" * 300 + '"', '""']
    out += [",".join(rng.choices(cells, k=rng.choice([2, 3, 3, 3, 4]))) for _ in range(rows)]
    return "\n".join(out) + rng.choice(["", "\n", "\n\n"])


def test_csv_with_quoted_breaks_in_splits(spark, tmp_path, tiny_splits):
    folder = tmp_path / "cdr_subdir"
    folder.mkdir()
    rng, want = random.Random(8), []
    for k in range(3):
        text = random_csv(rng, 40)
        (folder / f"f{k}.csv").write_text(text, encoding="utf-8", newline="")
        header, *data = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
        want += [[f"f{k}.csv", {n: (r[i] or None) if i < len(r) else None for i, n in enumerate(header)}] for r in data]
    (folder / "split_head.csv").write_text('"caller_id","two\nlines"\n5,6\n')
    (folder / "plain.csv").write_text("caller_id,imei\n8,9\n")
    want += [["split_head.csv", {"caller_id": "5", "two\nlines": "6"}], ["plain.csv", {"caller_id": "8", "imei": "9"}]]
    found = record_files.read_csv_records(spark, [str(tmp_path)], CDR)
    assert rows_of(found) == sorted(json.dumps(w, sort_keys=True) for w in want)
    flat = record_files.read_csv_files(spark, [str(tmp_path)], CDR)
    got = sorted((r.path.rsplit("/", 1)[1], r.caller_id or "", r.location or "", r.imei or "") for r in flat.collect())
    assert got == sorted((n, r.get("caller_id") or "", r.get("location") or "", r.get("imei") or "") for n, r in want)
    assert "map_from_arrays" not in flat._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("grammar", [splits.JsonArray, splits.CsvLines])
def test_measures_compose(grammar):
    """A piece's effect is that of its parts, one after the other."""
    rng = random.Random(9)
    separator = grammar.separator.encode()
    for _ in range(2000):
        pieces = [b"".join(rng.choices([b"{", b"[", b'"', b"\\\\", b'\\"', b"]", b",", b"a"], k=rng.randint(0, 9))) for _ in range(3)]
        for inside in (False, True):
            state, depth, text = inside, 0, b""
            for p in pieces:
                a, b, x, y = grammar.measure(p)
                state, depth, text = (b if state else a), depth + (y if state else x), text + p + separator
            if grammar is splits.CsvLines:
                # as Python's reader sees it: inside if the next line still belongs to the value
                rows = list(csv.reader(io.StringIO(('"' if inside else "") + text.decode() + "END,END", newline="")))
                assert state == (rows[-1] != ["END", "END"])
            else:
                quoted = escaped = False
                want, quoted = 0, inside
                for c in text.decode():
                    if escaped:
                        escaped = False
                    elif c == "\\":
                        escaped = True
                    elif c == '"':
                        quoted = not quoted
                    elif not quoted:
                        want += (c in "{[") - (c in "}]")
                assert (state, depth) == (quoted, want)


def test_long_json_records_come_in_chunks():
    text = json.dumps([{"a": "x" * 3_000_000}, {"b": [1.50, 10**400]}, {"c": "\\u12"}]).encode()
    small = (text[k : k + 1000] for k in range(0, len(text), 1000))
    got = [dict(r) for r in content.json_records(small)]
    assert len(got[0]["a"]) == 3_000_000 and got[1]["b"].startswith("[") and got[2]["c"] == "\\u12"
    assert [dict(r) for r in content.json_records(iter([json.dumps([{"é": "ü"}], ensure_ascii=False).encode("utf-16")]))] == [{"é": "ü"}]
    assert [dict(r) for r in content.json_records(iter([b'[{"a": "\\ud800x"}]']))] == [{"a": "�x"}]


@pytest.mark.parametrize("header", [True, False])
def test_merged_files_with_quoted_breaks_split(spark, tmp_path, tiny_splits, header):
    rng = random.Random(12)
    text = random_csv(rng, 120)
    body = text if header else text.split("\n", 1)[1]
    (tmp_path / CDR.merged_files[0]).write_text(body, encoding="utf-8", newline="")
    rows = [r for r in csv.reader(io.StringIO(body, newline="")) if r][header:]
    found = merged.read_merged(spark, str(tmp_path), CDR)
    width = len(found.columns)
    assert found.columns == (["caller_id", "location", "imei"] if header else list(CDR.fields[:width]))
    got = [tuple(r) for r in found.collect()]
    want = [tuple((r[k] or None) if k < len(r) else None for k in range(width)) for r in rows]
    key = lambda r: tuple(v or "" for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 3


@pytest.fixture
def stored_tables(monkeypatch):
    """What the readers store, by label: the table and, taken while it is written, partitions and plan."""
    seen, store = {}, splits._stored

    def stored(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        many = df.rdd.getNumPartitions()
        seen[label] = store(df, label), many, plan
        return seen[label][0]

    monkeypatch.setattr(splits, "_stored", stored)
    return seen


def test_damaged_arrays_are_not_held(spark, tmp_path, tiny_splits, stored_tables):
    """No task gets what follows the damage as one record."""
    line = json.dumps({"a": "x" * 50})
    texts = {
        "lines": f"{line}\n" * 200, "cut": f"[{line}" + f",{line}" * 200, "deep": ('[{"a":[' * 400 + line + "\n") * 20,
        "closed_early": f"[{line}]" + f",{line}" * 200 + "]", "unclosed": "[" + '{"a":[' * 3000, "sound": f"[{line}" + f",\n{line}" * 200 + "]",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = record_files.read_whole(spark, [str(tmp_path)], "json")
    assert faults_of(found) == {f"{n}.json" for n in texts if n != "sound"}
    assert found.where("error is not null").count() == 5 and found.where("record is not null").count() == 201
    parts = stored_tables["split-records"][0].where("text is not null")
    assert parts.where("path not like '%/sound.json'").count() == 0


def test_streams_are_read_in_order_without_sorting(spark, tmp_path, tiny_splits, stored_tables):
    """Files are unsplit and one a task, so a task's memory does not grow with them."""
    body = "".join(f"<cdr_record><imei>{k}</imei></cdr_record>" for k in range(500))
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.xml").write_text(f"<d>{body}</d>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = splits.streamed(
        lambda separator: spark.read.option("lineSep", separator).text(str(tmp_path)), "xml",
        record_files._kinds("cdr_record")["xml"],
    )
    _, many, plan = stored_tables["streamed"]
    assert many == 3 and "Exchange" not in plan and "Sort" not in plan
    assert found.where("record is not null").count() == 1500 and not faults_of(found)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
