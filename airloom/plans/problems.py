"""Queries of the general problems: snapshots (2), intervals (4), timestamps (5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators.intervals import coverage
from airloom.operators.snapshots import snapshot_changes
from airloom.operators.timestamps import canonical, normalise_instants
from airloom.session import spread, table, tune


def whole_number(c: Column | str) -> Column:
    """The number that an id stands for: blanks, leading zeros, a zero fraction and powers of ten don't matter; NULL for anything else.

    Exact up to 18 digits; a number with a fraction is none.
    """
    text = F.regexp_replace(c, r"\s", "")
    n = F.when(text.rlike(r"^[0-9]{1,18}(\.0*)?$|^[0-9]{1,18}(\.[0-9]{0,18})?[eE][+]?[0-9]{1,2}$"), text.try_cast("decimal(38,18)"))
    return F.when((n == F.floor(n)) & (n < F.lit(10**18)), n.cast("long"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    s = table(spark, sf_dir, "streams").withColumn("sid", whole_number("stream_id"))
    out = snapshot_changes(s, "snapshot_no", "sid", ["name", "epg_channel_id"], [F.col("delivered_at"), F.col("row_ord")])
    return out.select("snapshot_no", F.col("sid").alias("stream_id"), "change_kind")


P2_SQL = r"""
WITH s AS (
  SELECT snapshot_no, CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id,
         max(coalesce(name, '')) AS name, max(coalesce(epg_channel_id, '')) AS epg
  FROM streams GROUP BY 1, 2)
SELECT n.snapshot_no, n.stream_id, 'added' AS change_kind FROM s n
  LEFT JOIN s o ON o.stream_id = n.stream_id AND o.snapshot_no = n.snapshot_no - 1
  WHERE n.snapshot_no > 1 AND o.stream_id IS NULL
UNION ALL
SELECT CAST(o.snapshot_no + 1 AS INTEGER), o.stream_id, 'removed' FROM s o
  LEFT JOIN s n ON o.stream_id = n.stream_id AND o.snapshot_no = n.snapshot_no - 1
  WHERE o.snapshot_no < (SELECT max(snapshot_no) FROM s) AND n.stream_id IS NULL
UNION ALL
SELECT n.snapshot_no, n.stream_id, 'changed' FROM s n
  JOIN s o ON o.stream_id = n.stream_id AND o.snapshot_no = n.snapshot_no - 1
  WHERE n.name <> o.name OR n.epg <> o.epg
"""


def _instants(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    p = table(spark, sf_dir, "programme").select("source", "start_at", "stop_at", *columns)
    return normalise_instants(spread(p), table(spark, sf_dir, "sources"), {"start_at": "start_epoch", "stop_at": "stop_epoch"})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    rows = _instants(spark, sf_dir, "channel").filter("trim(channel) <> ''")
    return coverage(rows, "channel", "start_epoch", "stop_epoch")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    rows = _instants(spark, sf_dir, "prog_id").filter(~(canonical(F.col("start_at")) & canonical(F.col("stop_at"))))
    return rows.filter("start_epoch is not null and stop_epoch is not null").select("prog_id", "start_epoch", "stop_epoch")


def p4_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator over spans whose times are numbers: each event of a user lasts ``value`` minutes."""
    tune(spark)
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("channel"), start.alias("a"), (start + F.floor(F.col("value") * 60)).alias("b"))
    return coverage(e, "channel", "a", "b")


P4_EVENTS_SQL = """
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS channel, epoch_us(ts) // 1000000 AS a, epoch_us(ts) // 1000000 + CAST(floor(value * 60) AS BIGINT) AS b FROM events),
  p AS (SELECT *, max(b) OVER (PARTITION BY channel ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM e WHERE b > a),
  i AS (SELECT *, sum(CASE WHEN r IS NULL OR a > r THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS n FROM p),
  s AS (SELECT channel, min(a) AS span_from, max(b) AS span_to FROM i GROUP BY channel, n)
SELECT channel, 'period' AS span_kind, span_from, span_to FROM s
UNION ALL SELECT channel, 'gap', span_to, nxt FROM (SELECT channel, span_to, lead(span_from) OVER (PARTITION BY channel ORDER BY span_from) AS nxt FROM s) WHERE nxt IS NOT NULL
"""


def queries():
    return {"p2_found": p2_found, "p4_found": p4_found, "p4_events": p4_events, "p5_found": p5_found}


def oracle_sql():
    return {"p2_found": P2_SQL, "p4_events": P4_EVENTS_SQL}
