"""Readers, writers, consolidation, streams, the entry points."""

from __future__ import annotations

import json
import zlib

import pytest
from pyspark.sql import functions as F

from lexmill.runtime import shared_dir
from lexmill.sources import catalogs, compaction
from lexmill.streaming import fragments as stream


def test_catalogues(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"rf_shortname": "A", "rf_text": "text"}, {"rf_shortname": "B"}]))
    assert {(r.license, r.text) for r in catalogs.read_array_catalogue(spark, str(tmp_path / "a.json")).collect()} == {("A", "text"), ("B", None)}
    (tmp_path / "list.json").write_text(json.dumps({"licenses": [{"licenseId": "X-1.0"}, {"licenseId": "Y"}]}))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "X.json").write_text(json.dumps({"licenseId": "X-1.0", "licenseText": "body"}))
    assert {(r.license, r.text) for r in catalogs.read_list_catalogue(spark, str(tmp_path / "list.json"), str(tmp_path / "d")).collect()} == {("X-1.0", "body"), ("Y", None)}
    (tmp_path / "e.json").write_text(json.dumps({"exceptions": [{"reference": "./e.html", "licenseExceptionId": "E"}]}))
    assert catalogs.exception_urls(spark, str(tmp_path / "e.json"), "https://b/").first()["url"] == "https://b/e.html"
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "E.json").write_text(json.dumps({"licenseExceptionId": "E", "licenseExceptionText": "may link"}))
    assert [tuple(r) for r in catalogs.read_exceptions(spark, str(tmp_path / "e.json"), "https://b/", str(tmp_path / "e")).collect()] == [("E", "exceptions", "https://b/e.html", "may link")]
    (tmp_path / "dict.json").write_text(json.dumps({"A": "x", "B": "y\nz"}))
    assert {(r.license, r.text) for r in catalogs.read_text_dict(spark, str(tmp_path / "dict.json")).collect()} == {("A", "x"), ("B", "y\nz")}


def test_folders_and_tables(spark, tmp_path):
    root = tmp_path / "root"
    for name, body in (("A/A-1.txt", r"caf\xe9"), ("A/A-2.TXT", ""), ("B/sub/B-1.txt", "z"), ("B/x.md", "no")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    got = {(r.license, r.text) for r in catalogs.read_text_folder(spark, str(root)).collect()}
    assert ("A", "café") in got and ("sub", "z") in got and not any(t == "no" for _, t in got)
    assert catalogs.read_text_folder(spark, str(root), only_txt=False).count() >= 3
    (tmp_path / "r.csv").write_text('License,Regex\nA,"x ""y"", z"\n')
    assert tuple(catalogs.read_regex_table(spark, str(tmp_path / "r.csv")).first()) == ("A", 'x "y", z')
    (tmp_path / "s.in").write_text("# c\n%ENTRY% _LT_A\n%STR% \"x\"\n")
    assert catalogs.read_catalogue_lines(spark, str(tmp_path / "s.in")).where("line = 2").first()["value"] == "%ENTRY% _LT_A"
    df = spark.createDataFrame([("A", 1, "one"), ("A", 2, None), ("B", 1, "two")], "license string, seq int, fragment string")
    out = catalogs.write_fragment_files(df, f"file://{tmp_path}/frag").collect()
    assert len(out) == 3 and (tmp_path / "frag/A/A-1.txt").read_text() == "one" and (tmp_path / "frag/A/A-2.txt").read_text() == ""
    catalogs.write_by_license(df.drop("seq"), str(tmp_path / "by"))
    assert spark.read.parquet(str(tmp_path / "by")).where("license = 'A'").count() == 2
    catalogs.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3


LANDED = "file_path string, landed_at timestamp, n_bytes long, payload string, line string"


def landed(spark, *payloads):
    rows = [(f"p{k}", None, len(p.encode()) if p is not None else None, p, "clash") for k, p in enumerate(payloads)]
    return spark.createDataFrame(rows, LANDED)


def line(i, text="x", flip=False):
    body = {"file_id": i, "dirname": "L", "content": text}
    return json.dumps(dict(reversed(body.items())) if flip else body)


def test_consolidation(spark):
    long = "é" * 100_000
    files = landed(
        spark, line(1) + "\n" + line(2, "") + "\n", line(1, flip=True) + "\r\n" + line(3, long) + "\r\n", line(4) + "\n" + line(5)[:-9], line(6), "", None, "\n\n",
        line(1) + "\n" + line(2, "") + "\n", '{"dirname": "L"}\n', line(7, "a b\x85\r") + "\n",
    )
    path, check = compaction.consolidate(files, target_bytes=150_000)
    row = check.first()
    assert row.valid and row.records == 6
    assert (row.files, row.complete_lines, row.torn_lines, row.wrong_length) == (9, 9, 2, 0) and row.source_bytes == sum(r.n_bytes for r in files.where("payload IS NOT NULL").collect())
    got = {r.file_id: r.content for r in compaction.consolidated_records(files).collect()}
    assert got == {1: "x", 2: "", 3: long, 4: "x", 6: "x", 7: "a b\x85\r"}
    raw = [r.line for r in compaction.read_consolidated(spark, path).collect()]
    assert sorted(raw) == sorted([line(1), line(2, ""), line(3, long), line(4), line(6), line(7, "a b\x85\r")])
    assert sum(zlib.crc32(x.encode()) for x in raw) == row.checksum and path.startswith(shared_dir(spark))
    assert compaction.consolidated_records(files.limit(0)).count() == 0
    path, check = compaction.consolidate(files, header="h")
    assert check.first()["valid"] and spark.read.text(path).where("value = 'h'").count() == 1


@pytest.mark.parametrize("raw, whole", [(line(1, 'a "b" \\ {"file_id": 7, }'), True), (line(2, 'x\\'), True), (line(3)[:-1], False), (line(4) + "x", False), ('{"file_id": 5, "content": "a', False), ('{"file_id": 5}', True), ('{"file_id": 5, }', False), ('{"x": 1}', False), ('{"file_id": 6, "content": null}', True)])
def test_whole_lines(spark, raw, whole):
    got = compaction.payload_lines(landed(spark, raw)).collect()
    assert [r.kind for r in got] == ["complete" if whole else "torn"] and (not whole or got[0].key == json.loads(raw)["file_id"])


def test_lost_records_are_noticed(spark):
    files = landed(spark, line(1) + "\n" + line(2) + "\n")
    path, _ = compaction.consolidate(files)
    told = compaction.source_tally(files)
    assert told["keys"] == 2 and told["source_bytes"] == told["complete_bytes"] + told["end_bytes"]
    assert not compaction.consolidate(files.withColumn("n_bytes", F.lit(1).cast("long")))[1].first()["wrong_length"] == 0


def test_one_record_sent_often(spark):
    files = landed(spark, *[line(1) + "\n" + line(k) + "\n" for k in range(2, 40)])
    assert compaction.consolidated_records(files).count() == 39


def test_frames(spark):
    import zstandard

    parts = [zstandard.ZstdCompressor().compress(f"line {k}\n".encode()) for k in range(5)]
    joined = compaction.join_frames([parts[0], b"", parts[1] + parts[2]])
    assert zstandard.ZstdDecompressor().stream_reader(joined, read_across_frames=True).read() == b"line 0\nline 1\nline 2\n"
    with pytest.raises(ValueError):
        compaction.join_frames([parts[0][:-3]])
    with pytest.raises(ValueError):
        compaction.join_frames([b"text"])
    df = spark.createDataFrame([(f"p{k}", bytearray(p)) for k, p in enumerate(parts)] + [("q", None)], "file_path string, payload binary")
    back = compaction.split_frames(compaction.join_frame_files(compaction.as_frames(landed(spark, "a\nb\n", "", None, "c")))).collect()
    assert [(r.n_files, r.n_bytes, r.n_lines) for r in back] == [(2, 5, 2)]
    row = compaction.join_frame_files(df).collect()
    assert len(row) == 1 and row[0].n_files == 5 and zlib.crc32(bytes(row[0].payload)) == row[0].crc


def test_streams(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = spark.createDataFrame([("A", "s", "a. b"), ("B", "s", None), ("A", "s", "c")], "license string, source string, text string")
    rows.withColumn("loaded_at", F.lit("2025-01-02 03:04:05").cast("timestamp")).write.parquet(src)
    q = stream.fragment_stream(stream.read_stream(spark, src)).writeStream.format("memory").queryName("frags").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("frags").where("kind = 'window'").count() == 4
    q = stream.count_stream(stream.read_stream(spark, src)).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.license, r["count"]) for r in spark.table("counts").collect()} == {("A", 2), ("B", 1)}


def test_entry_points(spark):
    import __spark_entry__ as e

    names = set(e.queries())
    assert set(e.oracle_sql()) <= names and {"p2_found", "ngram_cdf"} <= names
