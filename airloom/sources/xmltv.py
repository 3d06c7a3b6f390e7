"""Guide files: reading XMLTV into typed rows and writing it.

Gzip is recognised by suffix.  A gzip file is one task, so rows are spread
after the read where a table of wanted ids is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.text import stamp, xml_escape

_TEXT = "array<struct<_VALUE:string,_lang:string>>"
PROGRAMME = f"_start string, _stop string, _channel string, title {_TEXT}, desc {_TEXT}, category {_TEXT}"
CHANNEL = f"_id string, `display-name` {_TEXT}, icon array<struct<_src:string>>"


def read_programmes(spark: SparkSession, path: str, wanted: DataFrame | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """channel, start, stop (texts), title, descr, category; ``wanted`` (column channel) is a semi-join."""
    raw = spark.read.format("xml").option("rowTag", "programme").option("mode", mode).schema(PROGRAMME).load(path)
    first = lambda c: F.get(F.col(c), F.lit(0))["_VALUE"]
    rows = raw.select(
        F.col("_channel").alias("channel"), F.col("_start").alias("start_at"), F.col("_stop").alias("stop_at"),
        first("title").alias("title"), first("desc").alias("descr"), first("category").alias("category"),
    ).filter("channel is not null")
    return rows if wanted is None else rows.join(wanted.select("channel").distinct(), "channel", "left_semi")


def read_channels(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """id, name_ord, display_name, icon: one row per display name."""
    raw = spark.read.format("xml").option("rowTag", "channel").option("mode", mode).schema(CHANNEL).load(path)
    names = raw.select(F.col("_id").alias("id"), F.get("icon", F.lit(0))["_src"].alias("icon"), F.posexplode_outer("display-name").alias("i", "n"))
    return names.filter("id is not null").select("id", (F.col("i") + 1).alias("name_ord"), F.col("n")["_VALUE"].alias("display_name"), "icon")


def _part(tag: str, c: Column) -> Column:
    """An element with text; nothing for NULL and empty text."""
    return F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"<{tag}>"), xml_escape(c), F.lit(f"</{tag.split(' ')[0]}>"))).otherwise("")


def programme_elements(rows: DataFrame, desc_limit: int = 500) -> DataFrame:
    """channel, start and the XML text of each row; description cut to the format's limit, absent parts left out.

    rows: channel, start, stop, title and, where there, descr and category.
    """
    has = set(rows.columns)
    desc = F.substring("descr", 1, desc_limit) if "descr" in has else F.lit(None).cast("string")
    category = F.col("category") if "category" in has else F.lit(None).cast("string")
    line = F.concat(
        F.lit('<programme start="'), stamp("start"), F.lit('" stop="'), stamp("stop"), F.lit('" channel="'), xml_escape("channel"),
        F.lit('">'), _part("title", F.col("title")), _part("desc", desc), _part("category", category), F.lit("</programme>"),
    )
    return rows.select("channel", "start", line.alias("xml"))


def channel_elements(channels: DataFrame) -> DataFrame:
    """channel and its XML text.  channels: channel, display_names (list, in order), shown_icon (empty for none)."""
    names = F.array_join(F.transform("display_names", lambda n: F.concat(F.lit("<display-name>"), xml_escape(n), F.lit("</display-name>"))), "")
    icon = F.when(F.coalesce("shown_icon", F.lit("")) != "", F.concat(F.lit('<icon src="'), xml_escape("shown_icon"), F.lit('"/>'))).otherwise("")
    line = F.concat(F.lit('<channel id="'), xml_escape("channel"), F.lit('">'), names, icon, F.lit("</channel>"))
    return channels.select("channel", line.alias("xml"))


def write_guide(rows: DataFrame, path: str, compression: str = "none", channels: DataFrame | None = None) -> None:
    """Part files, channels first, in order of channel and start, each a document of its own with root ``tv``."""

    def document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"xml": ["<tv>"]})
        yield from batches
        yield pd.DataFrame({"xml": ["</tv>"]})

    lines = programme_elements(rows).select(F.lit(1).alias("kind"), "channel", "start", "xml")
    if channels is not None:
        lines = channel_elements(channels).select(F.lit(0).alias("kind"), "channel", F.lit(0).cast("long").alias("start"), "xml").unionByName(lines)
    order = ["kind", "channel", "start"]
    lines = lines.repartitionByRange(*order).sortWithinPartitions(*order).select("xml")
    lines.mapInPandas(document, "xml string").write.option("compression", compression).text(path)


def guide_faults(channels: DataFrame, programmes: DataFrame) -> DataFrame:
    """Faults of a guide that was read, with how often each occurs; none is a pass.  Columns fault, n_rows.

    channels: id.  programmes: channel, title.  A guide needs channels, each id once
    and not empty, programmes of declared channels only, and a title for each.
    """
    ids = channels.select(F.coalesce("id", F.lit("")).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    p = programmes.join(ids.select(F.col("id").alias("channel"), F.lit(True).alias("known")), "channel", "left")
    found = ids.agg(
        F.sum(F.when(F.col("id") == "", F.col("n"))).alias("empty id"), F.count(F.when((F.col("id") != "") & (F.col("n") > 1), 1)).alias("repeated id"),
        F.when(F.count("*") == 0, 1).alias("no channels"),
    )
    rows = p.agg(
        F.count(F.when(F.col("known").isNull(), 1)).alias("undeclared channel"), F.count(F.when(F.trim(F.coalesce("title", F.lit(""))) == "", 1)).alias("no title"),
        F.when(F.count("*") == 0, 1).alias("no programmes"),
    )
    flat = lambda df: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("fault"), F.col(c).cast("long").alias("n_rows")) for c in df.columns])))
    return flat(found).union(flat(rows)).filter("n_rows > 0")
