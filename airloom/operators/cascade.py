"""Filling channels from ranked candidates and merging them into one guide."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.text import clean_title, sequence_ratio, token_sort_ratio
from airloom.operators.schedule import first_wins, overlap_islands
from airloom.session import cut

# Whole titles, and parts of titles, that stand for no information.
FILLER_TITLES = ("to be announced", "tba")
FILLER_PARTS = ("teleshopping", "no match", "no information", "channel off air", "servicestatus", "channel no longer available", "programmes start at")
# Ways of matching whose candidates are trusted.
TRUSTED = ("epg-id", "exact", "alias", "diaspora-alias", "callsign", "affiliate", "override")


def placeholder(title: Column | str) -> Column:
    """Whether a title stands for no information: a filler title as a whole, or one that holds a filler part."""
    t = clean_title(title)
    return t.isin(*FILLER_TITLES) | F.array_contains(F.transform(F.array(*map(F.lit, FILLER_PARTS)), lambda p: F.contains(t, p)), True)


def title_conflict_pairs(rows: DataFrame, keys: list[str], *, below: float = 0.68) -> DataFrame:
    """All pairs of materially different titles per key: columns keys, a, b, ratio, sorted_ratio.

    rows: keys, title.  Every two distinct cleaned titles of a key are compared
    (a before b), fillers and empty titles left out; rows with a NULL key conflict with none.
    """
    named = rows.dropna(subset=keys).filter(~placeholder("title")).select(*keys, clean_title("title").alias("a")).filter("a <> ''")
    named = cut(named.distinct(), "titles")
    pairs = named.join(named.withColumnRenamed("a", "b"), keys).filter("a < b")
    return pairs.withColumn("ratio", sequence_ratio("a", "b")).filter(F.col("ratio") < below).withColumn("sorted_ratio", token_sort_ratio("a", "b"))


@F.pandas_udf(T.BooleanType())
def _disagree(lists: pd.Series) -> pd.Series:
    """Whether two titles of a list, in its order, are materially different."""

    def one(titles) -> bool:
        seen = list(dict.fromkeys(titles))
        return any(difflib.SequenceMatcher(None, a, b).ratio() < 0.68 for i, a in enumerate(seen) for b in seen[i + 1 :])

    return lists.map(lambda t: t is not None and one(t)).astype(bool)


def candidate_summary(rows: DataFrame, now: int) -> DataFrame:
    """What decides about a candidate: stream, rank, trusted, n_rows, active title, whether all titles are placeholders.

    rows: stream, rank, start, stop, title of usable programmes of each candidate,
    and its ``match_method`` where known; without that column all are trusted.
    """
    on = (F.col("start") <= now) & (F.col("stop") > now)
    trusted = F.col("match_method").isin(*TRUSTED) if "match_method" in rows.columns else F.lit(True)
    return rows.groupBy("stream", "rank").agg(
        F.coalesce(F.max(trusted), F.lit(False)).alias("trusted"),
        F.count("*").alias("n_rows"),
        F.min_by(F.coalesce("title", F.lit("")), F.when(on, F.struct(F.col("start"), F.col("title")))).alias("active_title"),
        F.min(placeholder("title")).alias("all_placeholder"),
    )


def pick(summary: DataFrame) -> DataFrame:
    """The chosen candidate per stream: stream, rank, step, conflict.

    The first candidate stands (step 1), unless it has nothing on air while a later
    trusted one has a real title (2), or shows a placeholder while any later one has
    a real title (3), or holds nothing but placeholders (4).  ``conflict``: trusted
    candidates show materially different real titles now; then step 4 is not
    taken, and ``merge`` takes out the row on air, whoever was chosen.  Decided by
    aggregation; the titles compared are one per candidate of a stream.
    """
    real = F.col("active_title").isNotNull() & ~placeholder("active_title")
    one = summary.groupBy("stream").agg(
        F.min(F.struct("rank", "active_title", "all_placeholder")).alias("first"),
        F.min(F.when(real, F.col("rank"))).alias("good_rank"),
        F.min(F.when(real & F.col("trusted"), F.col("rank"))).alias("sure_rank"),
        F.min(F.when(~F.col("all_placeholder"), F.col("rank"))).alias("real_rank"),
        F.array_sort(F.collect_list(F.when(real & F.col("trusted"), F.struct("rank", clean_title("active_title").alias("t"))))).alias("shown"),
    )
    titles = F.filter(F.transform("shown", lambda x: x["t"]), lambda t: t != "")
    one = one.withColumn("conflict", _disagree(titles))
    none = F.col("first.active_title").isNull()
    weak = ~none & placeholder("first.active_title")
    empty = ~F.col("conflict") & F.col("first.all_placeholder") & F.col("real_rank").isNotNull()
    step = F.when(none & F.col("sure_rank").isNotNull(), 2).when(weak & F.col("good_rank").isNotNull(), 3).when(empty, 4).otherwise(1)
    rank = F.when(step == 2, F.col("sure_rank")).when(step == 3, F.col("good_rank")).when(step == 4, F.col("real_rank")).otherwise(F.col("first.rank"))
    return one.select("stream", rank.alias("rank"), step.alias("step"), "conflict")


def merge(rows: DataFrame, picked: DataFrame, now: int) -> DataFrame:
    """Guide rows of the picked candidates: one row per start, overlaps resolved; in a conflict the row on air is left out."""
    own = rows.join(picked.select("stream", "rank", "conflict"), ["stream", "rank"])
    own = own.filter(~(F.col("conflict") & (F.col("start") <= now) & (F.col("stop") > now)))
    own = own.select(F.col("stream").alias("channel"), "start", "stop", "title")
    return overlap_islands(first_wins(own, ["channel", "start"], ["stop", "title"]))


def display_parts(rows: DataFrame, same: Column) -> DataFrame:
    """Names and icon of a channel: the stream's name first, the source's name if it is another one, the first icon there is.

    rows: name, icon (of the stream), source_name, source_icon.  same: whether the
    two names are one.  Adds ``display_names`` and ``shown_icon``; NULL and empty names are left out.
    """
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    second = F.when(~F.coalesce(same, F.lit(False)), filled("source_name"))
    names = F.filter(F.array(filled("name"), second), lambda x: x.isNotNull())
    return rows.withColumn("display_names", names).withColumn("shown_icon", F.coalesce(filled("icon"), filled("source_icon"), F.lit("")))
