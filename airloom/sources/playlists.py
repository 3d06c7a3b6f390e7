"""Playlists, manifests, registries and tables of pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY = "schema_version int, sources array<struct<source:string,kind:string,countries:array<string>,min_programmes:int,output:string>>"


def m3u_entries(rows: DataFrame) -> DataFrame:
    """id, name, group, url -> id and the two lines of a playlist entry; quotes and line breaks can't break out of a field."""
    safe = lambda c: F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", " "), F.lit('"'), F.lit("'"))
    line = F.concat(F.lit('#EXTINF:-1 tvg-id="'), safe("id"), F.lit('" group-title="'), safe("group"), F.lit('",'), safe("name"), F.lit("\n"), F.col("url"))
    return rows.select("id", line.alias("entry"))


def read_m3u(spark: SparkSession, path: str) -> DataFrame:
    """ord, id, name, url of every entry; an entry without an https address has NULL url.

    A playlist is small and ordered, so each file is read as a whole.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n(?=#EXTINF)")).alias("ord", "e"))
    one = lines.filter("e like '#EXTINF%'")
    url = F.regexp_extract("e", r"\n(https://\S+)", 1)
    return one.select(
        "ord", F.nullif(F.regexp_extract("e", 'tvg-id="([^"]*)"', 1), F.lit("")).alias("id"),
        F.trim(F.regexp_extract("e", r",([^\n]*)", 1)).alias("name"), F.when(url != "", url).alias("url"),
    )


def m3u_channels(rows: DataFrame, server: str) -> DataFrame:
    """The richer variant: id -> two lines with name, logo and group; text is escaped and addresses are encoded.

    rows: id, stream_id, name, icon, group.  Rows without stream or name are left out.
    """
    flat = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n\x{2028}\x{2029}\x{0}-\x{1f}]", " ")
    safe = lambda c: F.replace(F.replace(flat(c), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    url = F.concat(F.lit(f"https://{server}/live/"), F.replace(F.url_encode(F.col("stream_id").cast("string")), F.lit("+"), F.lit("%20")), F.lit(".ts"))
    line = F.concat(
        F.lit('#EXTINF:-1 tvg-id="'), safe("id"), F.lit('" tvg-name="'), safe("name"), F.lit('" tvg-logo="'), safe("icon"),
        F.lit('" group-title="'), safe("group"), F.lit('",'), safe("name"), F.lit("\n"), url,
    )
    return rows.filter("stream_id is not null and coalesce(name, '') <> ''").select("id", line.alias("entry"))


def playlist_faults(entries: DataFrame, guide: DataFrame, expected: int) -> DataFrame:
    """Faults of a playlist that was read (ord, id, url), with how often each occurs: columns fault, n_rows; none is a pass.

    guide: id of the channels that must be in the playlist.  expected: number of entries.
    """
    ids = entries.groupBy("id").agg(F.count("*").alias("n"))
    own = entries.agg(
        F.count(F.when(F.col("id").isNull(), 1)).alias("no id"), F.count(F.when(F.col("url").isNull(), 1)).alias("no address"),
        F.when(F.count("*") != expected, F.abs(F.count("*") - expected)).alias("size"),
    )
    twice = ids.agg(F.count(F.when((F.col("n") > 1) & F.col("id").isNotNull(), 1)).alias("repeated id"))
    gone = guide.select("id").distinct().join(ids.select("id"), "id", "left_anti").agg(F.count("*").alias("missing id"))
    flat = lambda df: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("fault"), F.col(c).cast("long").alias("n_rows")) for c in df.columns])))
    return flat(own).union(flat(twice)).union(flat(gone)).filter("n_rows > 0")


def verify_manifest(listed: DataFrame, rows: DataFrame, key: str, content: str) -> DataFrame:
    """Each key of a manifest or of the contents with its state: same, changed, missing or unlisted."""
    now = manifest(rows, key, content).select(key, F.col("sha256").alias("__now"))
    both = listed.select(key, "sha256").join(now, key, "full_outer")
    state = F.when(F.col("sha256").isNull(), "unlisted").when(F.col("__now").isNull(), "missing").when(F.col("sha256") == F.col("__now"), "same").otherwise("changed")
    return both.select(key, state.alias("state"))


def manifest(rows: DataFrame, key: str, content: str) -> DataFrame:
    """key, bytes and sha256 of each content."""
    return rows.filter(F.col(content).isNotNull()).select(key, F.octet_length(content).cast("long").alias("n_bytes"), F.sha2(F.col(content).cast("binary"), 256).alias("sha256"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Source registry from JSON with an explicit schema; faulty entries have a reason."""
    raw = spark.read.schema(REGISTRY).json(path, multiLine=True).select(F.posexplode("sources").alias("ord", "s")).select("ord", "s.*")
    faulty = F.when(F.trim(F.coalesce("source", F.lit(""))) == "", "no name").when(F.coalesce(F.size("countries"), F.lit(0)) <= 0, "no country").when(
        ~F.coalesce(F.col("output").rlike(r"^[A-Za-z0-9_]+\.xml$"), F.lit(False)), "output"
    )
    return raw.withColumn("fault", faulty)


class _Table(HTMLParser):
    """Cells of all tables with their row spans."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, int]]] = []
        self.cell: list[str] | None = None
        self.span = 1

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.cell, self.span = [], int(dict(attrs).get("rowspan") or 1)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.rows[-1].append((" ".join("".join(self.cell).split()), self.span))
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)


def table_rows(page: str) -> list[list[str]]:
    """Rows of a page's tables with row spans carried down."""
    parser = _Table()
    parser.feed(page)
    open_cells: dict[int, tuple[str, int]] = {}
    out = []
    for cells in parser.rows:
        row, col, todo = [], 0, list(cells)
        while todo or col in open_cells:
            if col in open_cells:
                text, left = open_cells.pop(col)
                if left > 1:
                    open_cells[col] = (text, left - 1)
            else:
                text, span = todo.pop(0)
                if span > 1:
                    open_cells[col] = (text, span - 1)
            row.append(text)
            col += 1
        out.append(row)
    return out


def read_tables(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """page_id, row_ord, cells of all table rows of landed pages; NULL and empty pages have none."""
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, n, r) for i, t in zip(b["i"], b["h"]) if t for n, r in enumerate(table_rows(t))]
            yield pd.DataFrame(rows, columns=[page_id, "row_ord", "cells"])

    return pages.select(F.col(page_id).alias("i"), F.col(html).alias("h")).mapInPandas(run, f"{page_id} {kind}, row_ord long, cells array<string>")
