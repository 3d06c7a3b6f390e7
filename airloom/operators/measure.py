"""Measures of a guide: totals, coverage, trends, source health, regression gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def guide_totals(rows: DataFrame, now: int) -> DataFrame:
    """One row: channels, programmes, channels in the next 24 h, channels on air, channels with a future."""
    ch = F.col("channel")
    soon = (F.col("stop") > now) & (F.col("start") < now + 86400)
    return rows.agg(
        F.count_distinct("channel").alias("channels"), F.count("*").alias("programmes"),
        F.count_distinct(F.when(soon, ch)).alias("next_24h"),
        F.count_distinct(F.when((F.col("start") <= now) & (F.col("stop") > now), ch)).alias("active"),
        F.count_distinct(F.when(F.col("start") > now, ch)).alias("future"),
    )


def grouped_totals(rows: DataFrame, sets: Sequence[Sequence[str]], metrics: dict[str, Column]) -> DataFrame:
    """Sums per grouping set; a metric is NULL where any of its inputs is."""
    keys = sorted({c for s in sets for c in s})
    names = list(metrics)
    wide = rows.select(*keys, *[metrics[m].alias(m) for m in names])
    aggs = [F.when(F.count(m) == F.count(F.lit(1)), F.sum(m)).alias(m) for m in names]
    return wide.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(*aggs, F.grouping_id().alias("level"))


def trend(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys only in one of two states: key, trend (new or lost)."""
    a, b = now.select(key).distinct(), before.select(key).distinct()
    return a.exceptAll(b).withColumn("trend", F.lit("new")).unionByName(b.exceptAll(a).withColumn("trend", F.lit("lost")))


def source_health(channels: DataFrame, programmes: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: channels, programmes and a status against its minimum; sources without rows count 0."""
    c = channels.groupBy("source").agg(F.count_distinct("id").alias("n_channels"))
    p = programmes.groupBy("source").agg(F.count("*").alias("n_programmes"))
    out = sources.select("source", "min_programmes").join(c, "source", "left").join(p, "source", "left").fillna(0, ["n_channels", "n_programmes"])
    status = F.when(F.col("n_programmes") == 0, "empty").when(F.col("n_programmes") < F.col("min_programmes"), "short").otherwise("ok")
    return out.select("source", "n_channels", "n_programmes", status.alias("status"))


def regression_gate(now: DataFrame, before: DataFrame, ratios: dict[str, float], least: dict[str, int]) -> DataFrame:
    """One row per metric: value, before, passed.  Both inputs are single rows of the metrics."""
    side = lambda df, p: df.select(F.lit(0).alias("one"), *[F.col(m).alias(f"{p}_{m}") for m in ratios])
    pairs = side(now, "n").join(side(before, "b"), "one")
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("metric"), F.col(f"n_{m}").cast("long").alias("value"), F.col(f"b_{m}").cast("long").alias("value_before"),
            ((F.col(f"n_{m}") >= least.get(m, 0)) & (F.col(f"n_{m}") >= r * F.col(f"b_{m}"))).alias("passed"),
        )
        for m, r in ratios.items()
    ])
    return pairs.select(F.inline(rows))


def currency_share(rows: DataFrame, key: str, now: int) -> DataFrame:
    """Share of a key's programmes whose stop lies today (UTC) or later: columns key, share.

    rows: key, stop (epoch, NULL if unreadable).  A key with programmes but no
    readable stop has share 0; keys without programmes have no row here.
    """
    today = now - now % 86400
    share = F.avg(F.when(F.col("stop") >= today, 1.0).when(F.col("stop").isNotNull(), 0.0))
    return rows.groupBy(key).agg(F.round(F.coalesce(share, F.lit(0.0)), 6).alias("share"))


def selection_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How often each combination of keys was chosen; NULL counts as ``none``."""
    named = [F.coalesce(F.col(k).cast("string"), F.lit("none")).alias(k) for k in keys]
    return rows.select(*named).groupBy(*keys).agg(F.count("*").alias("n_rows"))


def single_valued(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys with exactly one distinct value that is not NULL, and that value."""
    one = rows.groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("__hi"))
    return one.filter(F.col(value) == F.col("__hi")).drop("__hi")


def expected_status(expected: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Every expected key with its number of rows and whether it has any: columns key, n_rows, ok."""
    n = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    return expected.select(key).distinct().join(n, key, "left").select(key, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNotNull().alias("ok"))


def staleness(rows: DataFrame, key: str, at: str, now: int) -> DataFrame:
    """Newest ``at`` of a key and how many seconds ago that is (0 if it lies ahead): columns key, newest, age."""
    return rows.filter(F.col(at).isNotNull()).groupBy(key).agg(F.max(at).alias("newest")).withColumn("age", F.greatest(F.lit(0), F.lit(now) - F.col("newest")))


def retained_share(before: DataFrame, now: DataFrame, key: str, least: float = 0.95) -> DataFrame:
    """One row: n_before, n_kept, passed; keys before that still exist.  Nothing before is no pass."""
    a, b = before.select(key).distinct(), now.select(key).distinct().withColumn("__kept", F.lit(1))
    out = a.join(b, key, "left").agg(F.count("*").alias("n_before"), F.count("__kept").alias("n_kept"))
    return out.withColumn("passed", (F.col("n_before") > 0) & (F.col("n_kept") >= F.col("n_before") * least))


def country_names(rows: DataFrame) -> DataFrame:
    """Per country: rows, covered ones, and the distinct names of the others in order; columns country, n_rows, n_covered, open_names.

    rows: country, name, covered.  A country's list holds each name once.
    """
    names = rows.filter("not covered and name is not null").select("country", "name").distinct().groupBy("country").agg(F.sort_array(F.collect_list("name")).alias("open_names"))
    n = rows.groupBy("country").agg(F.count("*").alias("n_rows"), F.count(F.when(F.col("covered"), 1)).alias("n_covered"))
    empty = F.array().cast("array<string>")
    return n.join(names, "country", "left").withColumn("open_names", F.coalesce("open_names", empty))
