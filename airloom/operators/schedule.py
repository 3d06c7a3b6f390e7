"""Row operators of a schedule: channel, start, stop (epoch seconds), title.

All functions keep extra columns unless they say otherwise; an empty schedule
gives an empty result; NULL times never pass a filter on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.text import clean_title
from airloom.operators.sequence import WEEK, neighbour, running

MAX_SPAN = 31 * 86400


def reason(now: int) -> Column:
    """Why a row is not usable, first match wins; NULL if it is."""
    return (
        F.when(F.col("start").isNull() | F.col("stop").isNull(), "malformed")
        .when(F.col("stop") <= F.col("start"), "not_positive")
        .when(F.col("stop") - F.col("start") > MAX_SPAN, "too_long")
        .when(F.col("stop") <= now, "past")
        .when(F.trim(F.coalesce("title", F.lit(""))) == "", "no_title")
    )


def usable(rows: DataFrame, now: int) -> DataFrame:
    return rows.filter(reason(now).isNull())


def drop_reasons(rows: DataFrame, now: int) -> DataFrame:
    """Rows per reason; usable ones count as ``kept``."""
    return rows.groupBy(F.coalesce(reason(now), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n_rows"))


def currency_gate(rows: DataFrame, since_day: str) -> DataFrame:
    """Rows whose stop lies on or after a day (UTC); a row without readable stop is kept for later filters."""
    day = F.date_from_unix_date(F.floor(F.col("stop") / 86400).cast("int"))
    return rows.filter(F.col("stop").isNull() | (day >= F.lit(since_day).cast("date")))


def active_at(rows: DataFrame, now: int) -> DataFrame:
    """Per channel the row that is on at ``now``; of several the one that began last, then the first title."""
    on = rows.filter((F.col("start") <= now) & (F.col("stop") > now))
    return on.groupBy("channel").agg(F.min(F.struct((-F.col("start")).alias("began"), "title", "stop")).alias("x")).select(
        "channel", (-F.col("x.began")).alias("start"), "x.stop", "x.title"
    )


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order``; chosen by aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("x")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest])


def _with_buckets(rows: DataFrame, seconds: int) -> DataFrame:
    return rows.withColumn("__b", F.floor(F.col("start") / seconds))


def _carried(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows with the greatest ``value`` of all earlier buckets of their channel.

    Windows over one row per (channel, bucket) carry a channel's state from bucket
    to bucket, so that the rows of a hot channel are sorted by many tasks.
    """
    earlier = Window.partitionBy("channel").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy("channel", "__b").agg(F.max(value).alias("__v"))
    return rows.join(per.select("channel", "__b", F.max("__v").over(earlier).alias(name)), ["channel", "__b"])


def _reach(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with ``reach``: how far the rows before them last, NULL for a channel's first."""
    w = Window.partitionBy("channel", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return _carried(rows, F.col("stop"), "__carry").withColumn("reach", F.greatest(F.max("stop").over(w), "__carry")).drop("__carry")


def overlap_islands(rows: DataFrame, bucket: int = 7 * 86400) -> DataFrame:
    """Overlapping rows of a channel as one row if they agree on the title; islands with several titles are left out.

    Adjacent rows don't overlap.  Rows need a channel, and stop after start.
    Result: channel, start, stop, title, n_rows.
    """
    order = ["start", "stop", "title"]
    base = rows.select("channel", *order).filter("channel is not null and stop > start")
    began = F.when(F.col("reach").isNull() | (F.col("start") >= F.col("reach")), F.col("start"))
    marked = _reach(_with_buckets(base, bucket), order).withColumn("__new", began)
    w = Window.partitionBy("channel", "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    island = _carried(marked, F.col("__new"), "__island").withColumn("island", F.coalesce(F.max("__new").over(w), "__island"))
    out = island.groupBy("channel", "island").agg(
        F.max("stop").alias("stop"), F.min_by("title", F.struct(*order)).alias("title"),
        F.count("*").alias("n_rows"), F.min(clean_title("title")).alias("lo"), F.max(clean_title("title")).alias("hi"),
    )
    return out.filter("lo = hi").select("channel", F.col("island").alias("start"), "stop", "title", "n_rows")


def covered_seconds(rows: DataFrame, now: int, horizon: int, bucket: int = 6 * 3600) -> DataFrame:
    """Seconds of [now, now + horizon) that a channel's rows cover, overlaps once."""
    clip = rows.select("channel", F.greatest("start", F.lit(now)).alias("start"), F.least("stop", F.lit(now + horizon)).alias("stop"))
    marked = _reach(_with_buckets(clip.filter("channel is not null and stop > start"), bucket), ["start", "stop"])
    gain = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("reach", "start")))
    return marked.withColumn("gain", gain).groupBy("channel").agg(F.sum("gain").alias("seconds"))


def lead_stop(rows: DataFrame, order: list[str], default: int = 3600) -> DataFrame:
    """Stop as the next start of the channel, else ``default`` later; only positive rows."""
    nxt = neighbour(rows, ["channel"], "start", order, F.col("start"), "__next")
    out = nxt.withColumn("stop", F.coalesce("__next", F.col("start") + default)).drop("__next")
    return out.filter("stop > start")


def rollover(rows: DataFrame, day: int = 86400) -> DataFrame:
    """A stop at or before its start belongs to the next day."""
    return rows.withColumn("stop", F.when(F.col("stop") <= F.col("start"), F.col("stop") + day).otherwise(F.col("stop")))


def half_day_clock(rows: DataFrame, key: str, order: list[str], begin: str, end: str, slack: int = 15, bucket: int = WEEK) -> DataFrame:
    """Minutes of a clock without a.m./p.m. made ascending: half a day is added while a row begins before the last one ended.

    With k half days added to a row, the next one needs max(0, k + c), where c
    depends on the two rows alone; that recursion is a running sum less its running
    minimum (0 at most).  order: columns, the first one numeric.  Rows with a NULL
    time are left out.
    """
    at, rest = order[0], order[1:]
    base = rows.filter(F.col(begin).isNotNull() & F.col(end).isNotNull())
    a, b = F.col(begin), F.col(end)
    length = b - a + 720 * F.greatest(F.lit(0), F.ceil((a - b) / 720))
    base = neighbour(base.withColumn("__len", length), [key], at, rest, a + F.col("__len"), "__ended", step=-1, bucket=bucket)
    base = base.withColumn("__c", F.coalesce(F.ceil((F.col("__ended") - slack - a) / 720), F.lit(0)))
    base = running(base, [key], at, rest, {"__sum": ("sum", F.col("__c"))}, bucket=bucket)
    base = running(base, [key], at, rest, {"__low": ("min", F.col("__sum"))}, bucket=bucket)
    shifted = a + 720 * (F.col("__sum") - F.least(F.lit(0), "__low"))
    kind = {f.name: f.dataType for f in rows.schema.fields}
    out = base.withColumn("__start", shifted)
    return out.withColumns({begin: F.col("__start").cast(kind[begin]), end: (F.col("__start") + F.col("__len")).cast(kind[end])}).select(*rows.columns)


def failure_runs(rows: DataFrame, key: str, order: list[str], failed: Column, bucket: int = WEEK) -> DataFrame:
    """Length of the current run of failures at each row (``run_length``); a success resets it.

    order: columns, the first one numeric.
    """
    at, rest = order[0], order[1:]
    out = running(rows.withColumn("__bad", failed), [key], at, rest, {"__n": ("sum", F.when(F.col("__bad"), 1).otherwise(0))}, bucket=bucket)
    out = running(out, [key], at, rest, {"__base": ("max", F.when(~F.col("__bad"), F.col("__n")))}, bucket=bucket)
    return out.withColumn("run_length", F.col("__n") - F.coalesce("__base", F.lit(0))).drop("__bad", "__n", "__base")


def carry_forward(rows: DataFrame, key: str, order: list[str], columns: list[str], bucket: int = WEEK) -> DataFrame:
    """Missing cells take the last value above them (row spans of a table); order: columns, the first one numeric."""
    out = running(rows, [key], order[0], order[1:], {c: ("last", F.col(c)) for c in columns}, bucket=bucket)
    return out.select(*rows.columns)


# Titles that are no programme in a guide's health, in lower case.
UNKNOWN_TITLES = ("to be announced", "tba", "no information", "no programme information", "no program information", "no match", "no data")


def known_title(title: Column | str) -> Column:
    """Whether a title counts for usable hours: not blank and no label of an unknown programme."""
    t = F.lower(F.trim(F.coalesce(title, F.lit(""))))
    return (t != "") & ~t.isin(*UNKNOWN_TITLES)
