import pytest

from airloom.plans import feeds
from airloom.sources import landed, playlists, xmltv


def test_guide_and_playlist_faults(spark):
    c = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "id string")
    p = spark.createDataFrame([("a", "x"), ("z", " "), ("b", None)], "channel string, title string")
    assert {r.fault: r.n_rows for r in xmltv.guide_faults(c, p).collect()} == {"repeated id": 1, "empty id": 1, "undeclared channel": 1, "no title": 2}
    assert {r.fault for r in xmltv.guide_faults(c.filter("false"), p.filter("false")).collect()} == {"no channels", "no programmes"}
    e = spark.createDataFrame([("a", "https://x/1"), ("a", None), (None, "https://x/2")], "id string, url string")
    assert {r.fault: r.n_rows for r in playlists.playlist_faults(e, spark.createDataFrame([("a",), ("q",)], "id string"), 3).collect()} == {
        "no id": 1, "no address": 1, "repeated id": 1, "missing id": 1
    }
    assert playlists.playlist_faults(e.filter("id = 'a' and url is not null"), c.filter("id = 'a'"), 1).count() == 0


def test_last_file_and_events(spark, tmp_path):
    rows = spark.createDataFrame([("i", "old", 1), ("i", "new", 2), ("k", None, 1)], "id string, name string, f int")
    assert {tuple(r) for r in landed.last_file_wins(rows, ["id"], "f").collect()} == {("i", "new", 2), ("k", None, 1)}
    (tmp_path / "d.json").write_text('{"channels": [{"sid": "7", "events": [{"st": 100, "d": 60, "t": "A"}, {"st": 100, "d": 90, "t": "B"}, {"st": null, "d": 5}, {"st": 5, "d": 0}]}, {"sid": "8", "events": null}]}')
    assert [tuple(r) for r in landed.read_event_days(spark, f"file://{tmp_path}/d.json", "no:").collect()] == [("no:7", 100, 160, "A", None)]


def test_guide_with_channels(spark, tmp_path):
    rows = spark.createDataFrame([("a&b", 0, 60, "T", "News")], "channel string, start long, stop long, title string, category string")
    names = spark.createDataFrame([("a&b", ["One", 'Tw"o'], "https://i/1"), ("c", [], "")], "channel string, display_names array<string>, shown_icon string")
    xmltv.write_guide(rows, f"file://{tmp_path}/g", "none", names)
    assert {tuple(r) for r in xmltv.read_channels(spark, f"file://{tmp_path}/g").collect()} >= {("a&b", 1, "One", "https://i/1"), ("a&b", 2, 'Tw"o', "https://i/1")}
    assert [(r.channel, r.category) for r in xmltv.read_programmes(spark, f"file://{tmp_path}/g").collect()] == [("a&b", "News")]


@pytest.mark.parametrize("name", ["provider_join", "substring_join", "manifest_check", "guide_channels", "host_breaker", "event_days"])
def test_queries_against_sql(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    import glob
    import os

    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        at = f"{f}/*.parquet" if os.path.isdir(f) else f
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{at}'")
    want = con.sql(feeds.oracle_sql()[name])
    cols = sorted(want.columns)
    got = feeds.queries()[name](spark, small)
    assert sorted(got.columns) == cols
    assert sorted(repr(tuple(r)) for r in got.select(*cols).collect()) == sorted(map(repr, con.sql(f"select {', '.join(cols)} from want").fetchall()))
