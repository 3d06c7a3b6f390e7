"""Landed feeds: JSON scans with explicit schemas, content checks of downloads, archives, retries of hosts.

Files are fetched by whatever lands them; these operators read folders.
"""

from __future__ import annotations

import base64
import gzip
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators.schedule import failure_runs, first_wins
from airloom.operators.sequence import running

STREAMS = "stream_id string, name string, category_id string, stream_icon string, epg_channel_id string"
CATEGORIES = "category_id string, category_name string"
CANDIDATE = "struct<source:string,source_id:string,method:string,confidence:double>"
MAPPING = f"struct<name:string,cat_name:string,country:string,canonical_id:string,candidates:array<{CANDIDATE}>>"
SCRAPED = "array<struct<title:string,start:string,stop:string>>"


def read_streams(spark: SparkSession, streams: str, categories: str) -> DataFrame:
    """Lineup with its category names; a stream of an unknown category has an empty one."""
    s = spark.read.schema(STREAMS).json(streams, multiLine=True)
    c = spark.read.schema(CATEGORIES).json(categories, multiLine=True).dropDuplicates(["category_id"])
    return s.join(c, "category_id", "left").select(
        "stream_id", "name", F.coalesce("category_name", F.lit("")).alias("cat_name"), "category_id", F.col("stream_icon").alias("icon"), "epg_channel_id"
    )


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A mapping object keyed by stream as one row per stream."""
    raw = spark.read.text(path, wholetext=True)
    m = raw.select(F.explode(F.from_json("value", f"map<string,{MAPPING}>")).alias("stream_id", "m"))
    return m.select("stream_id", "m.*")


def read_scraped(spark: SparkSession, path: str) -> DataFrame:
    """channel -> list of rows, as one row each with its order."""
    raw = spark.read.text(path, wholetext=True)
    rows = raw.select(F.explode(F.from_json("value", f"map<string,{SCRAPED}>")).alias("channel", "rows"))
    return rows.select("channel", F.posexplode("rows").alias("row_ord", "r")).select("channel", "row_ord", "r.title", F.col("r.start").alias("start_at"), F.col("r.stop").alias("stop_at"))


EVENTS = "channels array<struct<sid:string,name:string,events:array<struct<st:long,d:long,t:string,sy:string>>>>"


def read_event_days(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Pages of channels with events as rows: channel, start, stop, title, descr; an event lasts ``d`` seconds from epoch ``st``.

    The first sighting of (channel, start) stays, by title.  Events without start or
    with a duration below one second are left out.
    """
    page = spark.read.schema(EVENTS).json(path)
    c = page.select(F.explode("channels").alias("c")).select(F.concat(F.lit(prefix), "c.sid").alias("channel"), F.explode("c.events").alias("e"))
    rows = c.filter("e.st is not null and e.d > 0").select("channel", F.col("e.st").alias("start"), (F.col("e.st") + F.col("e.d")).alias("stop"), F.col("e.t").alias("title"), F.col("e.sy").alias("descr"))
    return first_wins(rows, ["channel", "start"], ["title", "stop", "descr"])


def last_file_wins(rows: DataFrame, keys: list[str], file_ord: str) -> DataFrame:
    """Union of split files where a key that several files declare is taken from the last one, whole."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(file_ord, *[c for c in rest if c != file_ord])).alias("x")
    return rows.groupBy(*keys).agg(best).select(*keys, "x.*").select(*rows.columns)


def fault_of(content: bytes | None) -> str | None:
    """Why a download is no guide; None if it is one."""
    if not content:
        return "empty"
    head = content
    if content[:2] == b"\x1f\x8b":
        try:
            with gzip.open(io.BytesIO(content)) as f:
                head = f.read(1 << 16)
                while f.read(1 << 20):
                    pass
        except (OSError, EOFError):
            return "bad gzip"
    start = head[:512].lstrip().lower()
    if start.startswith((b"<!doctype html", b"<html")):
        return "html page"
    return None if b"<tv" in head or b"<channel" in head else "no guide"


def check_downloads(files: DataFrame) -> DataFrame:
    """path, length, fault of files read with the binaryFile source; contents never leave their task."""

    @F.pandas_udf(T.StringType())
    def fault(content: pd.Series) -> pd.Series:
        return content.map(fault_of).astype(object)

    return files.select("path", "length", fault("content").alias("fault"))


def read_archives(files: DataFrame, most_bytes: int = 1 << 28) -> DataFrame:
    """path, member, text of zip members; encrypted, repeated and oversized members have a fault instead."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        seen: set[str] = set()
                        for i in z.infolist():
                            fault = "encrypted" if i.flag_bits & 1 else "repeated" if i.filename in seen else "too large" if i.file_size > most_bytes else None
                            seen.add(i.filename)
                            out.append((path, i.filename, None if fault else z.read(i).decode("utf-8", "replace"), fault))
                except zipfile.BadZipFile:
                    out.append((path, None, None, "bad archive"))
            yield pd.DataFrame(out, columns=["path", "member", "text", "fault"])

    return files.select("path", "content").mapInPandas(run, "path string, member string, text string, fault string")


def decode_seed(c, most_bytes: int = 2 << 20):
    """Text of base64(gzip(text)); NULL if it is malformed or larger than the cap."""

    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        def one(v):
            try:
                with gzip.open(io.BytesIO(base64.b64decode(v, validate=True))) as f:
                    raw = f.read(most_bytes + 1)
                return raw.decode() if len(raw) <= most_bytes else None
            except (ValueError, OSError, EOFError, TypeError):
                return None

        return values.map(one).astype(object)

    return decode(c)


def breaker(attempts: DataFrame, host: str, order: list[str], ok: str, limit: int = 3) -> DataFrame:
    """Attempts with ``skipped``: true for those of a host after ``limit`` failures in a row.

    order: columns, the first one numeric; an attempt without outcome counts as failed.
    """
    at, rest = order[0], order[1:]
    runs = failure_runs(attempts, host, order, ~F.coalesce(ok, F.lit(False)))
    hit = F.when(F.col("run_length") >= limit, 1).otherwise(0)
    opened = running(runs.withColumn("__hit", hit), [host], at, rest, {"__opened": ("sum", F.col("__hit"))})
    return opened.withColumn("skipped", F.col("__opened") > F.col("__hit")).drop("run_length", "__hit", "__opened")
