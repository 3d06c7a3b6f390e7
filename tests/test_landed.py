import base64
import gzip
import io
import json
import zipfile

from pyspark.sql import functions as F

from airloom.functions import text as tx
from airloom.operators import match
from airloom.sources import landed


def test_json_scans(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps([{"stream_id": 7, "name": "A", "category_id": "1"}, {"stream_id": "8", "name": None, "category_id": "9"}]))
    (tmp_path / "c.json").write_text(json.dumps([{"category_id": "1", "category_name": "UK | News"}]))
    rows = landed.read_streams(spark, f"file://{tmp_path}/s.json", f"file://{tmp_path}/c.json").collect()
    assert {(r.stream_id, r.cat_name) for r in rows} == {("7", "UK | News"), ("8", "")}
    (tmp_path / "m.json").write_text(json.dumps({"7": {"name": "A", "candidates": [{"source": "s", "source_id": "x", "method": "exact", "confidence": 1}]}, "8": {"name": "B", "candidates": []}}))
    m = {r.stream_id: r for r in landed.read_mapping(spark, f"file://{tmp_path}/m.json").collect()}
    assert m["7"].candidates[0].source_id == "x" and m["8"].candidates == [] and m["8"].country is None
    (tmp_path / "p.json").write_text(json.dumps({"geo": [{"title": "T", "start": "2026-01-01T10:00:00+05:00", "stop": None}], "none": []}))
    assert [tuple(r) for r in landed.read_scraped(spark, f"file://{tmp_path}/p.json").collect()] == [("geo", 0, "T", "2026-01-01T10:00:00+05:00", None)]


def test_downloads_and_archives(spark, tmp_path):
    good = b'<?xml version="1.0"?><tv><channel id="a"/></tv>'
    for name, content in {"a.xml": good, "b.gz": gzip.compress(good), "c.gz": gzip.compress(good)[:-9], "d.xml": b"  <!DOCTYPE html>", "f.xml": b"{}"}.items():
        (tmp_path / name).write_bytes(content)
    got = landed.check_downloads(spark.read.format("binaryFile").load(f"file://{tmp_path}")).collect()
    assert {r.path[-5:]: r.fault for r in got} == {"a.xml": None, "/b.gz": None, "/c.gz": "bad gzip", "d.xml": "html page", "f.xml": "no guide"}
    assert landed.fault_of(b"") == landed.fault_of(None) == "empty"  # the source itself leaves empty files out
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("x.txt", "hi")
        f.writestr("big.txt", "x" * 2000)
    (tmp_path / "z.zip").write_bytes(z.getvalue())
    (tmp_path / "bad.zip").write_bytes(b"no")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(f"file://{tmp_path}")
    got = {(r.member, r.text, r.fault) for r in landed.read_archives(files, 1000).collect()}
    assert got == {("x.txt", "hi", None), ("big.txt", None, "too large"), (None, None, "bad archive")}


def test_seed_and_breaker(spark):
    ok = base64.b64encode(gzip.compress(b'{"a": 1}')).decode()
    df = spark.createDataFrame([(1, ok), (2, "###"), (3, None), (4, base64.b64encode(gzip.compress(b"x" * 3000)).decode())], "i int, v string")
    assert {r.i: r.t for r in df.select("i", landed.decode_seed(F.col("v"), 1000).alias("t")).collect()} == {1: '{"a": 1}', 2: None, 3: None, 4: None}
    tries = [("h", i, i in (0, 3)) for i in range(9)] + [("k", 0, False), ("k", 1, False), ("k", 2, True), ("k", 3, False)]
    got = landed.breaker(spark.createDataFrame(tries, "host string, n int, ok boolean"), "host", ["n"], "ok")
    assert {(r.host, r.n) for r in got.filter("skipped").collect()} == {("h", 7), ("h", 8)}


def test_phases(spark):
    s = spark.createDataFrame([(1, "news"), (2, "film")], "stream_id long, norm_name string")
    c = spark.createDataFrame([("a", "i", "news 24")], "source string, id string, norm_name string")
    alias = match.alias_match(s, spark.createDataFrame([("news", "news 24")], "norm_name string, alias string"), c)
    assert [tuple(r)[:3] for r in alias.collect()] == [(1, "a", "i")]
    fixed = match.override_match(s, spark.createDataFrame([(2, "b", "k"), (9, "b", "l")], "stream_id long, source string, source_id string"))
    both = match.combine({"override": fixed.withColumn("confidence", F.lit(1.0)), "alias": alias.withColumn("confidence", F.lit(0.9))}, spark.createDataFrame([("a", 1)], "source string, trust int"))
    assert {(r.stream_id, r.source, r.match_method, r["rank"]) for r in both.collect()} == {(1, "a", "alias", 1), (2, "b", "override", 1)}
    df = spark.createDataFrame([("Тихая Жизнь",), ("ΕΡΤ Χώρα",), ("x",), (None,)], "n string")
    assert [r[0] for r in df.select(tx.transliterate("n")).collect()] == ["tykhaia zhyzn", "ert chora", "x", None]
