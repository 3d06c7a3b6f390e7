import datetime as dt
import random
import re
from collections import defaultdict
from zoneinfo import ZoneInfo

from airloom.operators.intervals import coverage
from airloom.operators.snapshots import snapshot_changes
from airloom.operators.timestamps import normalise_instants
from airloom.plans.problems import whole_number
from pyspark.sql import functions as F


def brute_spans(rows):
    by = defaultdict(list)
    for k, a, b in rows:
        if k is not None and a is not None and b is not None and b > a:
            by[k].append((a, b))
    out = []
    for k, v in by.items():
        periods = []
        for a, b in sorted(v):
            if periods and a <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], b)
            else:
                periods.append([a, b])
        out += [(k, "period", a, b) for a, b in periods]
        out += [(k, "gap", x[1], y[0]) for x, y in zip(periods, periods[1:])]
    return sorted(out)


def test_coverage_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(3000):
        k = rng.choice(["hub", "hub", "hub", "a", "b", None])
        a = rng.choice([rng.randrange(0, 4000), rng.randrange(-50, 50), None])
        b = None if a is None or rng.random() < 0.02 else a + rng.choice([-3, 0, 1, 2, 5, 5, 9, 400])
        rows.append((k, a, b, "x"))
    df = spark.createDataFrame(rows, "key string, f long, t long, span_from string")
    got = coverage(df, "key", "f", "t", bucket_seconds=64)
    assert sorted(map(tuple, got.collect())) == brute_spans([r[:3] for r in rows])


def test_coverage_of_nothing(spark):
    df = spark.createDataFrame([], "key string, f long, t long")
    assert coverage(df, "key", "f", "t").count() == 0


def test_snapshots(spark):
    rows = [
        (1, "7", "a", None, 1), (1, "7", "a", "", 2), (1, "8", "b", "x", 1), (1, None, "z", "z", 1),
        (2, "7", "a", "", 1), (2, "9", "c", None, 1),
        (3, "7", "A", "", 1), (3, "8", "b", "x", 1), (3, "9", "c", "new", 1),
    ]
    df = spark.createDataFrame(rows, "s int, k string, name string, epg string, ord int")
    got = snapshot_changes(df, "s", "k", ["name", "epg"], [F.col("ord")])
    assert {(r.s, r.k, r.change_kind) for r in got.collect()} == {
        (2, "8", "removed"), (2, "9", "added"), (3, "7", "changed"), (3, "8", "added"), (3, "9", "changed"),
    }
    (r,) = got.filter("s = 3 and k = '7'").collect()
    assert (r.old["name"], r.new["name"]) == ("a", "A")
    assert snapshot_changes(df.filter("s = 1"), "s", "k", ["name"], [F.col("ord")]).count() == 0
    assert snapshot_changes(df.filter("false"), "s", "k", ["name"], [F.col("ord")]).count() == 0


def test_whole_number(spark):
    df = spark.createDataFrame([(x,) for x in [" 0012 ", "12.0", "12", "1.2e1", "x", "", None, "12.5"]], "v string")
    assert [r[0] for r in df.select(whole_number("v")).collect()] == [12, 12, 12, 12, None, None, None, None]


CASES = [
    ("20260329030000 +0200", "utc", "2026-03-29T01:00:00"),
    ("202603290300 +0200", "utc", "2026-03-29T01:00:00"),
    ("20260329030000+0530", "utc", "2026-03-28T21:30:00"),
    ("20260101120000 GMT-5", "utc", "2026-01-01T17:00:00"),
    ("20260101120000 CEST", "utc", "2026-01-01T10:00:00"),
    ("20260101120000", "de", "2026-01-01T11:00:00"),
    ("2026-07-01 12:00:00", "de", "2026-07-01T10:00:00"),
    ("2026-07-01 12:00:00 America/New_York", "de", "2026-07-01T16:00:00"),
    ("2026-07-01T12:00:00.123456+02:00", "de", "2026-07-01T10:00:00"),
    ("2026-07-01T12:00Z", "de", "2026-07-01T12:00:00"),
    ("01/02/2026 00:10", "none", "2026-02-01T00:10:00"),
    ("1 Feb 2026 12:05 AM", "none", "2026-02-01T00:05:00"),
    ("1 Feb 2026 12:05 PM", "none", "2026-02-01T12:05:00"),
    ("25/10/2026 02:30", "de", "2026-10-25T00:30:00"),  # twice: the first
    ("29/03/2026 02:30", "de", "2026-03-29T01:30:00"),  # skipped: moved on
    ("1769904000", "de", "2026-02-01T00:00:00"),
    ("1769904000999", "de", "2026-02-01T00:00:00"),
    *[(x, "de", None) for x in ["", None, "TBA", "0", "00000000000000", "2026-13-40T25:00:00Z", "31/02/2026 10:00",
                                "20260101250000", "1 Foo 2026 1:00 PM", "13 Feb 2026 13:00 PM", "2026-01-01 10:00:00 No/Where"]],
]


def test_timestamps(spark):
    df = spark.createDataFrame([(i, s, t) for i, (t, s, _) in enumerate(CASES)], "i int, source string, t string")
    zones = spark.createDataFrame([("de", "Europe/Berlin"), ("none", None), ("utc", "UTC")], "source string, tz_name string")
    got = {r.i: r.e for r in normalise_instants(df, zones, {"t": "e"}).collect()}
    for i, (text, _, want) in enumerate(CASES):
        want = want and int(dt.datetime.fromisoformat(want).replace(tzinfo=dt.UTC).timestamp())
        assert got[i] == want, (text, got[i], want)
    last = normalise_instants(df, zones, {"t": "e"}, ambiguous="last", nonexistent="null")
    got = {r.t: r.e for r in last.collect()}
    assert got["25/10/2026 02:30"] == int(dt.datetime(2026, 10, 25, 1, 30, tzinfo=dt.UTC).timestamp())
    assert got["29/03/2026 02:30"] is None


def test_local_times_against_zoneinfo(spark, small):
    """Every slash time of the small table, read a second way."""
    p, s = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("programme", "sources"))
    zones = {r.source: r.tz_name for r in s.collect()}
    rows = normalise_instants(p, s, {"start_at": "e"}).filter("start_at like '%/%:%'").collect()
    seen = 0
    for r in rows:
        m = re.fullmatch(r"(\d\d)/(\d\d)/(\d{4}) (\d\d):(\d\d)", r.start_at)
        if m:
            d, mo, y, h, mi = map(int, m.groups())
            at = dt.datetime(y, mo, d, h, mi, tzinfo=ZoneInfo(zones[r.source] or "UTC"))
            assert r.e == int(at.timestamp())
            seen += 1
    assert seen > 50
