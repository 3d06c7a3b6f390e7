import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from airloom.functions import text as tx
from airloom.operators import cascade, match, measure, schedule, sequence
from airloom.session import scratch_path
from airloom.sources import playlists, xmltv
from airloom.streaming import monitor

ROWS = "channel string, start long, stop long, title string"


def brute_islands(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r[1:])
    out = []
    for k, v in by.items():
        islands = []
        for a, b, t in sorted(v):
            if islands and a < islands[-1][1]:
                islands[-1][1] = max(islands[-1][1], b)
                islands[-1][2].append(t)
            else:
                islands.append([a, b, [t]])
        out += [(k, a, b, t[0], len(t)) for a, b, t in islands if len({x.lower() for x in t}) == 1]
    return sorted(out)


def test_islands_against_brute_force(spark):
    rng = random.Random(4)
    rows = {(rng.choice("abb"), s): s + rng.randrange(1, 9) for s in (rng.randrange(400) for _ in range(260))}
    rows = [(k, s, e, rng.choice(["News", "news", "Film"])) for (k, s), e in ((k, v) for k, v in rows.items())]
    got = schedule.overlap_islands(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(map(tuple, got)) == brute_islands(rows)


def test_row_filters(spark):
    rows = [("a", 10, 20, "x"), ("a", 20, 10, "x"), ("a", None, 5, "x"), ("a", 1, 10**9, "x"), ("a", 1, 5, "x"), ("a", 10, 30, " "), (None, 10, 40, "y")]
    df = spark.createDataFrame(rows, ROWS)
    assert {r.reason: r.n_rows for r in schedule.drop_reasons(df, 8).collect()} == {"kept": 2, "not_positive": 1, "malformed": 1, "too_long": 1, "past": 1, "no_title": 1}
    assert schedule.usable(df.filter("false"), 8).count() == 0
    (on,) = schedule.active_at(df.filter("channel = 'a' and stop < 100"), 12).collect()
    assert (on.start, on.stop, on.title) == (10, 30, " ")


def test_half_day_clock(spark):
    rows = [("a", 1, 600, 660), ("a", 2, 660, 60), ("a", 3, 60, 120), ("b", 1, 30, 20), ("b", 2, 25, 50)]
    df = spark.createDataFrame(rows, "k string, o int, s long, e long")
    got = sorted(map(tuple, schedule.half_day_clock(df, "k", ["o"], "s", "e", bucket=1).collect()))
    assert got == [("a", 1, 600, 660), ("a", 2, 660, 780), ("a", 3, 780, 840), ("b", 1, 30, 740), ("b", 2, 745, 770)]


def test_half_day_clock_against_loop(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), i, rng.randrange(720), rng.randrange(720)) for i in range(300)]
    want, last = [], {}
    for k, o, s, e in rows:
        while k in last and s < last[k] - 15:
            s, e = s + 720, e + 720
        while e < s:
            e += 720
        last[k] = e
        want.append((k, o, s, e))
    df = spark.createDataFrame(rows, "k string, o int, s long, e long")
    for bucket in (7, 10**6):
        assert sorted(map(tuple, schedule.half_day_clock(df, "k", ["o"], "s", "e", bucket=bucket).collect())) == sorted(want)
    assert schedule.half_day_clock(df.filter("false"), "k", ["o"], "s", "e").count() == 0


def test_sequences_against_loop(spark):
    """Buckets, NULL keys and NULL places don't change what a plain walk gives."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 60, 4)]), i, rng.choice([None, 1, 2, 5])) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, at long, o int, v int")
    want = {}
    for k in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        total, top, last = None, None, None
        for i, r in enumerate(own):
            v = r[3]
            if v is not None:
                total, top, last = (total or 0) + v, max(top or 0, v), v
            want[r[2]] = (total, top, last, own[i + 1][3] if i + 1 < len(own) else None, own[i - 1][3] if i else None)
    c = {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "l": ("last", F.col("v"))}
    for bucket in (5, 1000):
        out = sequence.running(df, ["k"], "at", ["o"], c, bucket=bucket)
        out = sequence.neighbour(out, ["k"], "at", ["o"], F.col("v"), "n", bucket=bucket)
        out = sequence.neighbour(out, ["k"], "at", ["o"], F.col("v"), "p", step=-1, bucket=bucket)
        assert {r.o: (r.s, r.m, r.l, r.n, r.p) for r in out.collect()} == want


def test_cascade_steps(spark):
    rows = [
        ("keeps", 1, "exact", 0, 10, "Film"), ("keeps", 2, "fuzzy", 0, 10, "News"),
        ("off", 1, "exact", 20, 30, "Film"), ("off", 2, "fuzzy", 0, 10, "Other"), ("off", 3, "alias", 0, 10, "News"),
        ("filler", 1, "exact", 0, 10, "TBA"), ("filler", 1, "exact", 20, 30, "Film"), ("filler", 2, "fuzzy", 0, 10, "News"),
        ("empty", 1, "exact", 20, 30, "Teleshopping"), ("empty", 2, "exact", 20, 30, "Film"),
        ("clash", 1, "exact", 0, 10, "Alpine Rescue"), ("clash", 1, "exact", 20, 30, "Film"), ("clash", 2, "override", 0, 10, "Football Night"),
        ("near", 1, "exact", 0, 10, "Garden Hour"), ("near", 2, "exact", 0, 10, "The Garden Hour"),
    ]
    df = spark.createDataFrame(rows, "stream string, rank int, match_method string, start long, stop long, title string")
    picked = cascade.pick(cascade.candidate_summary(df, 5))
    assert {r.stream: (r.rank, r.step, r.conflict) for r in picked.collect()} == {
        "keeps": (1, 1, False), "off": (3, 2, False), "filler": (2, 3, False), "empty": (2, 4, False), "clash": (1, 1, True), "near": (1, 1, False)
    }
    assert {(r.channel, r.title) for r in cascade.merge(df, picked, 5).collect()} == {
        ("keeps", "Film"), ("off", "News"), ("filler", "News"), ("empty", "Film"), ("clash", "Film"), ("near", "Garden Hour")
    }
    assert cascade.pick(cascade.candidate_summary(df.filter("false"), 5)).count() == 0


def test_placeholders(spark):
    got = {t: p for t, p in spark.createDataFrame([(t,) for t in ("Live Football", "Into the Unknown", "Teleshopping", "To Be Announced: News Special", "To  be ANNOUNCED ", "tba", "", None)], "t string").select("t", cascade.placeholder("t")).collect()}
    assert {t for t, p in got.items() if p} == {"Teleshopping", "To  be ANNOUNCED ", "tba"}


def test_names_and_icon(spark):
    df = spark.createDataFrame([("A", "", "B", "i"), ("A", "x", "a", "i"), (None, None, "B", None), ("", " ", "", "")], "name string, icon string, source_name string, source_icon string")
    got = [(r.display_names, r.shown_icon) for r in cascade.display_parts(df, F.lower("name") == F.lower("source_name")).collect()]
    assert got == [(["A", "B"], "i"), (["A"], "x"), (["B"], ""), ([], "")]


def test_title_conflicts_all_pairs(spark, tmp_path):
    """Middle titles conflict, two notations are one instant, fillers and near titles are left out."""
    import difflib

    from airloom.plans import reference

    titles = ["Alpine Rescue", "Football Night", "Garden Hour", "garden  hour", "The Garden Hour", "Zebra", "TBA", "No information", " ", None]
    starts = ["20240115120000 +0000", "2024-01-15T13:00:00+01:00"]
    rows = [("s", "c", starts[i % 2], t) for i, t in enumerate(titles)] + [("s", "c", "rubbish", "Other"), ("s", None, starts[0], "Other"), ("s", "d", starts[0], "Other")]
    spark.createDataFrame(rows, "source string, channel string, start_at string, title string").write.parquet(f"file://{tmp_path}/programme.parquet")
    spark.createDataFrame([("s", "UTC")], "source string, tz_name string").write.parquet(f"file://{tmp_path}/sources.parquet")
    got = {(r.channel, r.start, r.a, r.b) for r in reference.queries()["title_conflicts"](spark, f"file://{tmp_path}").collect()}
    names = ["alpine rescue", "football night", "garden hour", "the garden hour", "zebra"]
    want = {("c", 1705320000, a, b) for a in names for b in names if a < b and difflib.SequenceMatcher(None, a, b).ratio() < 0.68}
    assert got == want and ("c", 1705320000, "football night", "garden hour") in got


def test_fuzzy_against_brute_force(spark):
    rng = random.Random(7)
    words = "red green blue news film kids plus two".split()
    names = sorted({" ".join(rng.sample(words, rng.randrange(1, 6))) for _ in range(60)})
    left, right = names[:30], names[15:]
    got = match.fuzzy_match(spark.createDataFrame([(n,) for n in left], "lname string"), spark.createDataFrame([("s", n) for n in right], "source string, rname string"), top=10**6)
    want = set()
    for a in left:
        for b in right:
            x, y = set(a.split()), set(b.split())
            plus = ("plus" in x) == ("plus" in y) and ("plus" not in x or x - {"plus"} == y - {"plus"} or len(x & y - {"plus"}) >= 2)
            if a != b and len(x & y) >= 2 and 2 * len(x & y) / (len(x) + len(y)) >= 0.85 and plus:
                want.add((a, b))
    assert {(r.lname, r.rname) for r in got.collect()} == want and want


def test_fuzzy_rules(spark):
    left = spark.createDataFrame([("movies twenty four plus",), ("sport one two three plus 1",), ("a b c d e f g",)], "lname string")
    right = spark.createDataFrame([
        ("s", "movies twenty four", "1"), ("s", "sport one two three plus", "2"), ("s", "a b c d e f", "3"), ("s", "b c d e f g", "4"), ("s", "b c d e f g", "5"),
    ], "source string, rname string, id string")
    got = {(r.lname, r.rname) for r in match.fuzzy_match(left, right).collect()}
    assert got == {("sport one two three plus 1", "sport one two three plus"), ("a b c d e f g", "a b c d e f")}


def test_raw_names_resolve(spark):
    s = spark.createDataFrame([(1, "x one", "X One"), (2, "x one", "x ONE hd"), (3, "y", "Y")], "stream_id long, norm_name string, raw_name string")
    c = spark.createDataFrame([("a", "i", "x one", "X one "), ("a", "k", "x one", "X One TV"), ("a", "m", "y", "other")], "source string, id string, norm_name string, raw_name string")
    assert {(r.stream_id, r.source_id, r.n_ids) for r in match.exact_match(s, c).collect()} == {(1, "i", 2), (2, None, 2), (3, "m", 1)}


def test_provider_identity_and_call_signs(spark):
    s = spark.createDataFrame([
        (1, "a.uk", "a.uk", "x", "UK"), (2, "b.uk", "xtream:2", "x", "UK"), (3, None, "xtream:3", "x", "UK"), (4, "", "xtream:4", "x", "DE"), (5, "", "xtream:5", "x", None), (6, None, "xtream:6", "two", None)
    ], "stream_id long, epg_channel_id string, canonical_id string, norm_name string, country string")
    names = spark.createDataFrame([("n.gb", "x"), ("p", "two"), ("q", "two")], "id string, norm_name string")
    assert {(r.stream_id, r.source_id, r.match_method) for r in match.provider_match(s, names).collect()} == {(1, "a.uk", "epg-id"), (3, "n.gb", "name"), (5, "n.gb", "name")}
    ids = match.identity_join(s, spark.createDataFrame([(1, "k"), (2, "k")], "stream_id long, canonical_id string"))
    assert {(r.stream_id, r.canonical_id, r.is_unique) for r in ids.collect() if r.stream_id < 4} == {(1, "k", False), (2, "k", False), (3, "xtream:3", True)}
    t = spark.createDataFrame([(1, "wtvt", None), (2, "wabc", None), (3, "wabc", "wabc-dt2"), (4, "kxyz", None), (5, None, None)], "stream_id long, call_sign string, sub_feed string")
    c = spark.createDataFrame([("u", "WTVT.us", "wtvt"), ("u", "WABC-DT2.us", "wabc"), ("u", "WABC.us", "wabc"), ("u", "k1", "kxyz"), ("v", "k1", "kxyz")], "source string, id string, call_sign string")
    assert {(r.stream_id, r.source, r.source_id) for r in match.call_sign_match(t, c).collect()} == {(1, "u", "WTVT.us"), (3, "u", "WABC-DT2.us")}


def test_substrings_against_all_pairs(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab ") for _ in range(rng.randrange(1, 9))).strip() for _ in range(60)})
    a, b = words[::2] + [""], words[1::2]
    got = match.substring_match(spark.createDataFrame([(w,) for w in a], "name string"), spark.createDataFrame([(w, i) for i, w in enumerate(b)], "service string, ord int"))
    want = {w: next(s for s in b if s and (w in s or s in w)) for w in a if w and any(s and (w in s or s in w) for s in b)}
    assert {r.name: r.service for r in got.collect()} == want


def test_exact_and_collision(spark):
    s = spark.createDataFrame([(1, "news"), (2, "film"), (3, ""), (4, None)], "stream_id long, norm_name string")
    c = spark.createDataFrame([("a", "i", "news"), ("a", "i", "news"), ("a", "k", "film"), ("a", "l", "film")], "source string, id string, norm_name string")
    assert {(r.stream_id, r.source_id, r.n_ids) for r in match.exact_match(s, c).collect()} == {(1, "i", 1), (2, None, 2)}
    e = spark.createDataFrame([(1, "a.uk"), (2, "b.uk"), (3, "B.uk "), (4, "none"), (5, None), (6, "x.EPG"), (7, "Sky.de"), (8, " Sky.de")], "stream_id long, epg_channel_id string")
    assert {r.stream_id: r.canonical_id for r in match.collision_split(e).collect()} == {1: "a.uk", 2: "b.uk", 3: "B.uk", 4: "none", 5: "xtream:5", 6: "xtream:6", 7: "xtream:7", 8: "xtream:8"}


def test_norm_forms(spark):
    df = spark.createDataFrame([("BBC One+1 HD",), ("A&B TV 24.uk",), ("4K Film 4 K",), ("",), (None,)], "n string")
    assert [r[0] for r in df.select(tx.norm_ascii("n")).collect()] == ["bbc one plus 1", "a and b 24", "film 4 k", "", None]
    assert [r[0] for r in df.select(tx.norm("n")).collect()][:2] == ["bbc one plus 1", "a and b 24"]
    assert tx.norm_text("ＥＲＴ ερτ1 Café") == "ert ερτ1 cafe" and tx.norm_text("Aaj Tak HD.in") == "aaj tak"
    assert tx.norm_text("News18 Canal+ The TV5 x.inc 1080p") == "news 18 canal plus 5 x inc"


def test_norm_ascii_equals_full_form(spark):
    rng = random.Random(3)
    parts = ["BBC", "One", "tv5", "HD", ".uk", ".in", "x.de", "4K", "4 K", "+1", "&", "news18", "a_b", "720p", "-", "The", ".", "24h"]
    names = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 6))) for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for n, got in df.select("n", tx.norm_ascii("n")).collect():
        assert got == tx.norm_text(n), n


def test_gates_and_trend(spark):
    now, old = spark.createDataFrame([(95, 10)], "a long, b long"), spark.createDataFrame([(100, 10)], "a long, b long")
    got = {r.metric: r.passed for r in measure.regression_gate(now, old, {"a": 0.96, "b": 1.0}, {"b": 10}).collect()}
    assert got == {"a": False, "b": True}
    t = measure.trend(spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int"), "k")
    assert sorted(map(tuple, t.collect())) == [(1, "new"), (3, "lost")]


def test_xmltv_files(spark):
    rows = spark.createDataFrame([("a&b", 0, 60, 'Tom "<Jerry>"', "d" * 900), ("c", 60, 120, "Ünï", None), ("c", 120, 180, None, "x")], ROWS + ", descr string")
    path = scratch_path(spark, "xml")
    xmltv.write_guide(rows, path, "gzip")
    got = {(r.channel, r.start_at): (r.title, r.descr) for r in xmltv.read_programmes(spark, path).collect()}
    assert got == {("a&b", "19700101000000 +0000"): ('Tom "<Jerry>"', "d" * 500), ("c", "19700101000100 +0000"): ("Ünï", None), ("c", "19700101000200 +0000"): (None, "x")}
    wanted = spark.createDataFrame([("c",)], "channel string")
    assert xmltv.read_programmes(spark, path, wanted).count() == 2


def test_playlists_and_tables(spark, tmp_path):
    rows = spark.createDataFrame([("i1", 'N"1\n', "g", "https://h/1"), ("i2", None, None, "https://h/2")], "id string, name string, group string, url string")
    entries = [r.entry for r in playlists.m3u_entries(rows).orderBy("id").collect()]
    f = tmp_path / "x.m3u"
    f.write_text("#EXTM3U\n" + "\n".join(entries) + "\n#EXTINF:-1,broken\nhttp://h/3\n")
    got = [(r.id, r.name, r.url) for r in playlists.read_m3u(spark, f"file://{f}").orderBy("ord").collect()]
    assert got == [("i1", "N'1", "https://h/1"), ("i2", "", "https://h/2"), (None, "broken", None)]
    page = "<table><tr><th>A<th>B</tr><tr><td rowspan=2>x</td><td>1</td></tr><tr><td>2</td></tr></table>".replace("<th>A<th>B", "<th>A</th><th>B</th>")
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "id long, html string")
    assert [r.cells for r in playlists.read_tables(pages, "id", "html").orderBy("row_ord").collect()] == [["A", "B"], ["x", "1"], ["x", "2"]]
    j = tmp_path / "r.json"
    j.write_text('{"schema_version": 1, "sources": [{"source": "a", "countries": ["DE"], "output": "a.xml"}, {"source": "b", "countries": [], "output": "b.xml"}, {"source": "c", "countries": ["X"], "output": "../c"}]}')
    assert [r.fault for r in playlists.read_registry(spark, f"file://{j}").orderBy("ord").collect()] == [None, "no country", "output"]


def test_streams(spark, small):
    batch = spark.read.parquet(f"{small}/events.parquet").groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").alias("w"), "event_type").count()
    stream = monitor.read_rows(spark, f"{small}/events.parquet", "ts")
    out = monitor.run_once(monitor.window_counts(stream, "ts", "event_type"), "t", "complete")
    assert out.count() == batch.count() and out.agg(F.sum("n_rows")).first()[0] == batch.agg(F.sum("count")).first()[0]


@pytest.mark.parametrize("name", ["usable_rows", "cascade_pick", "candidate_rank", "coverage_grouping_sets", "fuzzy_dice"])
def test_queries_against_sql(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    import glob
    import os

    from airloom.plans import reference

    con = duckdb.connect()
    for f in glob.glob(f"{small}/*.parquet"):
        at = f"{f}/*.parquet" if os.path.isdir(f) else f
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{at}'")
    want = con.sql(reference.oracle_sql()[name])
    cols = sorted(want.columns)
    text = lambda rows: sorted(map(repr, rows))
    got = reference.queries()[name](spark, small)
    assert sorted(got.columns) == cols
    assert text(tuple(r) for r in got.select(*cols).collect()) == text(con.sql(f"select {', '.join(cols)} from want").fetchall())
