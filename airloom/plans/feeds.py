"""Queries of sources, sinks and the smaller operators, with their SQL.

Files are written from the test tables to the shared folder and read back, so
that the SQL side can work on the tables themselves.
"""

from __future__ import annotations

import base64
import gzip
import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions import text as tx
from airloom.operators import cascade, match, measure, schedule
from airloom.plans import reference as ref
from airloom.plans.problems import whole_number
from airloom.session import scratch_path, table, tune
from airloom.sources import landed, playlists, xmltv

NOW, SHOWS = ref.NOW, ref.SHOWS
Q: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = lambda spark, d: f(tune(spark), d)
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


_SID = "CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT)"


def _stations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "streams").filter("snapshot_no = 6").withColumn("stream_id", whole_number("stream_id"))


def _bins(df: DataFrame, value, n: int = 16) -> DataFrame:
    """One JSON document per bin of rows, as files are landed."""
    return df.groupBy(F.pmod(F.hash(*df.columns), F.lit(n)).alias("b")).agg(F.to_json(value).alias("value")).select("value")


# --- sources ------------------------------------------------------------------------------------------
@query(f"""WITH k AS (SELECT category_id, min(cat_name) AS label FROM streams WHERE trim(cat_name) <> '' GROUP BY 1)
  SELECT DISTINCT CAST({_SID} AS VARCHAR) AS stream_id, name, coalesce(label, '') AS cat_name, category_id, icon, epg_channel_id FROM streams s LEFT JOIN k USING (category_id) WHERE snapshot_no = 6""")
def lineup_json(spark, d):
    """Stream and category lists as landed JSON arrays, read and joined."""
    s = _stations(spark, d).select(F.col("stream_id").cast("string").alias("stream_id"), "name", "category_id", F.col("icon").alias("stream_icon"), "epg_channel_id").distinct()
    c = table(spark, d, "streams").filter("trim(cat_name) <> ''").groupBy("category_id").agg(F.min("cat_name").alias("category_name"))
    a, b = scratch_path(spark, "streams"), scratch_path(spark, "categories")
    _bins(s, F.collect_list(F.struct(*s.columns))).repartition(16).write.option("maxRecordsPerFile", 1).text(a)
    _bins(c, F.collect_list(F.struct(*c.columns)), 1).write.text(b)
    return landed.read_streams(spark, a, b)


@query(f"WITH {SHOWS} SELECT channel, title, CAST(start AS VARCHAR) AS start_at, CAST(stop AS VARCHAR) AS stop_at FROM shows")
def scraped_json(spark, d):
    """Lists of rows per channel in landed JSON objects."""
    rows = ref.shows(spark, d).select("channel", F.struct("title", F.col("start").cast("string").alias("start"), F.col("stop").cast("string").alias("stop")).alias("r"))
    per = rows.groupBy("channel").agg(F.collect_list("r").alias("rows"))
    path = scratch_path(spark, "scraped")
    _bins(per, F.map_from_entries(F.collect_list(F.struct("channel", "rows")))).write.option("maxRecordsPerFile", 1).text(path)
    return landed.read_scraped(spark, path).select("channel", "title", "start_at", "stop_at")


@query("""SELECT CAST(map_id AS VARCHAR) AS stream_id, country, canonical_id, coalesce(len(candidates), 0) AS n_candidates FROM mapping""")
def mapping_json(spark, d):
    m = table(spark, d, "mapping").select(F.col("map_id").cast("string").alias("k"), F.struct("name", "cat_name", "country", "canonical_id", F.transform("candidates", lambda c: F.struct(
        c["source"].alias("source"), c["source_id"].alias("source_id"), c["match_method"].alias("method"), c["confidence"].alias("confidence"))).alias("candidates")).alias("m"))
    path = scratch_path(spark, "mapping")
    _bins(m, F.map_from_entries(F.collect_list(F.struct("k", "m")))).write.option("maxRecordsPerFile", 1).text(path)
    out = landed.read_mapping(spark, path)
    return out.select("stream_id", "country", "canonical_id", F.greatest(F.lit(0), F.coalesce(F.size("candidates"), F.lit(0))).cast("long").alias("n_candidates"))


@query(f"""WITH {SHOWS}, r AS (SELECT channel, start, stop, title, row_number() OVER (PARTITION BY channel, start ORDER BY title, stop) AS n FROM shows WHERE stop > start)
  SELECT concat('no:', channel) AS channel, start, stop, title FROM r WHERE n = 1""")
def event_days(spark, d):
    """Pages with channels and events of epoch start and duration."""
    e = ref.shows(spark, d).withColumn("day", F.floor(F.col("start") / 86400))
    per = e.groupBy("day", F.col("channel").alias("sid")).agg(F.collect_list(F.struct(F.col("start").alias("st"), (F.col("stop") - F.col("start")).alias("d"), F.col("title").alias("t"))).alias("events"))
    path = scratch_path(spark, "days")
    per.groupBy("day").agg(F.to_json(F.struct(F.collect_list(F.struct("sid", "events")).alias("channels"))).alias("value")).select("value").write.text(path)
    return landed.read_event_days(spark, path, "no:").select("channel", "start", "stop", "title")


_GOOD = b'<?xml version="1.0"?><tv><channel id="a"/></tv>'
_FILES = {
    "plain": (_GOOD, None), "packed": (gzip.compress(_GOOD), None), "cut": (gzip.compress(_GOOD)[:-9], "bad gzip"), "page": (b"  <!DOCTYPE html><p>", "html page"),
    "other": (b"{}", "no guide"), "rows": (b"<tv><programme/></tv>", None), "nothing": (b"", "empty"),
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', {len(c)}, {repr(f) if f else 'NULL'})" for k, (c, f) in _FILES.items()) + ") AS t(path, length, fault)")
def download_faults(spark, d):
    files = spark.createDataFrame([(k, len(c), bytearray(c)) for k, (c, _) in _FILES.items()], "path string, length int, content binary")
    return landed.check_downloads(files)


@query("SELECT CAST(r_regionkey AS VARCHAR) AS path, n_name AS member, concat('about ', n_name) AS text, CAST(NULL AS VARCHAR) AS fault FROM nation JOIN region ON n_regionkey = r_regionkey")
def archive_members(spark, d):
    """One archive per region with a member per nation."""
    nations = table(spark, d, "nation").select("n_regionkey", "n_name")

    def pack(key, rows):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in rows["n_name"]:
                z.writestr(n, f"about {n}")
        return type(rows)({"path": [str(key[0])], "content": [out.getvalue()]})

    return landed.read_archives(nations.groupBy("n_regionkey").applyInPandas(pack, "path string, content binary"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS text FROM supplier")
def seed_decode(spark, d):
    """base64 of gzip, each fifth one damaged."""

    s = table(spark, d, "supplier").select("s_suppkey", "s_name")
    rows = s.mapInPandas(_pack_names, "s_suppkey long, seed string")
    return rows.select("s_suppkey", landed.decode_seed(F.col("seed")).alias("text"))


def _pack_names(batches):
    for b in batches:
        seeds = [base64.b64encode(gzip.compress(n.encode())).decode()[: None if k % 5 else -7] for k, n in zip(b["s_suppkey"], b["s_name"])]
        yield b.assign(seed=seeds)[["s_suppkey", "seed"]]


@query(f"""WITH {SHOWS}, m AS (SELECT *, sum(CASE WHEN title = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY channel ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS part FROM shows),
  r AS (SELECT *, sum(CASE WHEN title = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY channel, part ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS run FROM m)
  SELECT event_id, coalesce(max(run) OVER (PARTITION BY channel ORDER BY start, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 3 AS skipped FROM r""")
def host_breaker(spark, d):
    attempts = ref.shows(spark, d).withColumn("ok", F.col("title") != "error")
    return landed.breaker(attempts, "channel", ["start", "event_id"], "ok").select("event_id", "skipped")


@query("SELECT source, kind, countries[1] AS first_country, CAST(CASE WHEN coalesce(len(countries), 0) = 0 THEN 'no country' END AS VARCHAR) AS fault FROM sources")
def registry_rows(spark, d):
    path = scratch_path(spark, "registry")
    s = table(spark, d, "sources").select("source", "kind", "countries", "min_programmes", "output")
    s.groupBy(F.lit(1).alias("schema_version")).agg(F.collect_list(F.struct(*s.columns)).alias("sources")).select(F.to_json(F.struct("schema_version", "sources")).alias("value")).write.text(path)
    return playlists.read_registry(spark, path).select("source", "kind", F.get("countries", F.lit(0)).alias("first_country"), "fault")


@query("""SELECT r_regionkey AS page, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) - 1 AS row_ord, [r_name, n_name] AS cells
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
def table_cells(spark, d):
    """A page per region whose first cell spans all rows."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name")))
    per = n.groupBy("r_regionkey", "r_name").agg(rows.alias("rows"))
    head = F.concat(F.lit('<td rowspan="'), F.size("rows").cast("string"), F.lit('">'), "r_name", F.lit("</td>"))
    body = F.array_join(F.transform("rows", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, head).otherwise(""), F.lit("<td>"), x["n_name"], F.lit("</td></tr>"))), "")
    return playlists.read_tables(per.select(F.col("r_regionkey").alias("page"), F.concat(F.lit("<table>"), body, F.lit("</table>")).alias("html")), "page", "html")


@query("""WITH f AS (SELECT source, id, name_ord, any_value(display_name) AS display_name, max(file_ord) AS file_ord FROM channel GROUP BY 1, 2, 3)
  SELECT id, arg_max(source, (file_ord, source, name_ord, display_name)) AS source, arg_max(display_name, (file_ord, source, name_ord, display_name)) AS display_name, max(file_ord) AS file_ord FROM f WHERE display_name IS NOT NULL GROUP BY 1""")
def split_files_union(spark, d):
    c = table(spark, d, "channel").filter("display_name is not null").groupBy("source", "id", "name_ord").agg(F.max("display_name").alias("display_name"), F.max("file_ord").alias("file_ord"))
    return landed.last_file_wins(c.select("id", "source", "name_ord", "display_name", "file_ord"), ["id"], "file_ord").select("id", "source", "display_name", "file_ord")


# --- sinks ----------------------------------------------------------------------------------------------
def _guide_channels(spark, d) -> DataFrame:
    c = table(spark, d, "channel").filter("display_name is not null and display_name <> ''")
    return c.groupBy(F.col("id").alias("channel")).agg(F.transform(F.sort_array(F.collect_set(F.struct("name_ord", "display_name"))), lambda x: x["display_name"]).alias("display_names"), F.coalesce(F.max("icon"), F.lit("")).alias("shown_icon"))


@query("""WITH c AS (SELECT DISTINCT id, name_ord, display_name FROM channel WHERE display_name <> ''), i AS (SELECT id, nullif(max(icon), '') AS icon FROM channel WHERE display_name <> '' GROUP BY 1)
  SELECT c.id, CAST(row_number() OVER (PARTITION BY c.id ORDER BY name_ord, display_name) AS INTEGER) AS name_ord, trim(display_name) AS display_name, icon FROM c JOIN i USING (id)""")
def guide_channels(spark, d):
    """Channels of a written guide: names in order, icon."""
    path = scratch_path(spark, "guide")
    xmltv.write_guide(ref.shows(spark, d), path, "gzip", _guide_channels(spark, d))
    return xmltv.read_channels(spark, path).select("id", "name_ord", F.trim("display_name").alias("display_name"), "icon")


@query("""WITH p AS (SELECT channel, title, EXISTS (SELECT 1 FROM channel c WHERE c.id = p.channel) AS known FROM programme p WHERE channel IS NOT NULL), u AS (
  SELECT 'undeclared channel' AS fault, count(*) FILTER (WHERE NOT known) AS n_rows FROM p UNION ALL SELECT 'no title', count(*) FILTER (WHERE trim(coalesce(title, '')) = '') FROM p
  UNION ALL SELECT 'repeated id', (SELECT count(*) FROM (SELECT id FROM channel GROUP BY 1 HAVING count(*) > 1))) SELECT fault, n_rows FROM u WHERE n_rows > 0""")
def guide_check(spark, d):
    return xmltv.guide_faults(table(spark, d, "channel").select("id"), table(spark, d, "programme").filter("channel is not null").select("channel", "title"))


@query(f"""WITH {SHOWS}, w AS (SELECT channel FROM shows GROUP BY 1 HAVING count(*) % 2 = 0) SELECT channel, count(*) AS n_rows FROM shows WHERE channel IN (SELECT channel FROM w)
  AND stop // 86400 >= datediff('day', DATE '1970-01-01', DATE '{ref.DAY}') GROUP BY 1""")
def wanted_current(spark, d):
    """The scan of a guide restricted to wanted channels and current rows."""
    rows = ref.shows(spark, d)
    path = scratch_path(spark, "guide")
    xmltv.write_guide(rows, path)
    wanted = rows.groupBy("channel").agg(F.count("*").alias("n")).filter("n % 2 = 0")
    read = xmltv.read_programmes(spark, path, wanted).withColumn("stop", F.unix_seconds(F.to_timestamp(F.substring("stop_at", 1, 14), "yyyyMMddHHmmss")))
    return schedule.currency_gate(read, ref.DAY).groupBy("channel").agg(F.count("*").alias("n_rows"))


@query("SELECT source, id, concat('https://x.invalid/', md5(concat(source, '/', id))) AS url FROM (SELECT DISTINCT source, id FROM channel)")
def playlist_scan(spark, d):
    """A playlist written and read back."""
    c = table(spark, d, "channel").groupBy("source", "id").agg(F.min("display_name").alias("name"))
    c = c.withColumn("url", F.concat(F.lit("https://x.invalid/"), F.md5(F.concat_ws("/", "source", "id").cast("binary"))))
    rows = c.select(F.concat_ws("/", "source", "id").alias("id"), "name", F.col("source").alias("group"), "url")
    path = scratch_path(spark, "playlist")
    playlists.m3u_entries(rows).select("entry").write.text(path)
    read = playlists.read_m3u(spark, path)
    return read.select(F.split("id", "/", 2)[0].alias("source"), F.split("id", "/", 2)[1].alias("id"), "url")


@query("""WITH c AS (SELECT id, count(*) AS n FROM channel GROUP BY 1), p AS (SELECT DISTINCT channel AS id FROM programme WHERE channel IS NOT NULL), u AS (
  SELECT 'repeated id' AS fault, (SELECT count(*) FROM c WHERE n > 1) AS n_rows UNION ALL SELECT 'missing id', (SELECT count(*) FROM p WHERE id NOT IN (SELECT id FROM c))
  UNION ALL SELECT 'no address', (SELECT count(*) FROM channel WHERE icon IS NULL) UNION ALL SELECT 'size', abs((SELECT count(*) FROM channel) - 1000)) SELECT fault, n_rows FROM u WHERE n_rows > 0""")
def playlist_check(spark, d):
    entries = table(spark, d, "channel").select("id", F.col("icon").alias("url"))
    return playlists.playlist_faults(entries, table(spark, d, "programme").filter("channel is not null").select(F.col("channel").alias("id")), 1000)


_M3U = lambda c: f"replace(replace(regexp_replace(coalesce({c}, ''), '[\\r\\n\\x{{2028}}\\x{{2029}}\\x00-\\x1f]', ' ', 'g'), '&', '&amp;'), '\"', '&quot;')"


@query(f"""WITH s AS (SELECT DISTINCT {_SID} AS sid, name, icon, cat_name FROM streams WHERE snapshot_no = 6) SELECT concat('xtream:', sid) AS id, concat('#EXTINF:-1 tvg-id="xtream:', sid, '" tvg-name="', {_M3U("name")},
  '" tvg-logo="', {_M3U("icon")}, '" group-title="', {_M3U("cat_name")}, '",', {_M3U("name")}, chr(10), 'https://x.invalid/live/', sid, '.ts') AS entry FROM s WHERE coalesce(name, '') <> ''""")
def m3u_rich_lines(spark, d):
    s = _stations(spark, d).select(F.concat(F.lit("xtream:"), F.col("stream_id").cast("string")).alias("id"), "stream_id", "name", "icon", F.col("cat_name").alias("group")).distinct()
    return playlists.m3u_channels(s, "x.invalid")


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'unlisted' WHEN doc_id % 4 = 1 THEN 'changed' WHEN doc_id % 4 = 2 THEN 'missing' ELSE 'same' END AS state FROM documents WHERE text IS NOT NULL""")
def manifest_check(spark, d):
    """A manifest of documents against the documents, of which some are new, altered or gone."""
    docs = table(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    k = F.col("doc_id") % 4
    listed = playlists.manifest(docs.filter(k != 0), "doc_id", "text")
    now = docs.filter(k != 2).withColumn("text", F.when(k == 1, F.concat("text", F.lit("."))).otherwise(F.col("text")))
    return playlists.verify_manifest(listed, now, "doc_id", "text")


# --- predicates and scalar functions --------------------------------------------------------------------
@query(f"SELECT epg_channel_id, count(*) AS n_rows, coalesce(trim(epg) <> '' AND NOT {ref._JUNK}, false) AS is_real FROM (SELECT *, coalesce(epg_channel_id, '') AS epg FROM (SELECT epg_channel_id FROM streams UNION ALL SELECT unnest(['a.EPG', 'x.l', 'ServiceStatus 1', 'Event3Hour', 'b.epg.uk', 'c.NFL'])))  GROUP BY 1, epg")
def real_ids(spark, d):
    probes = spark.createDataFrame([(x,) for x in ("a.EPG", "x.l", "ServiceStatus 1", "Event3Hour", "b.epg.uk", "c.NFL")], "epg_channel_id string")
    return table(spark, d, "streams").select("epg_channel_id").union(probes).groupBy("epg_channel_id").agg(F.count("*").alias("n_rows")).withColumn("is_real", match.real_id("epg_channel_id"))


@query("""WITH s AS (SELECT cat_name, coalesce(nullif(upper(regexp_extract(trim(coalesce(cat_name, '')), '^([A-Za-z]{2,3})\\s*\\|', 1)), ''), '??') AS country FROM streams)
  SELECT country, CASE country WHEN 'UK' THEN 'GB' WHEN 'IRE' THEN 'IE' WHEN 'SC' THEN 'GB' WHEN 'USA' THEN 'US' ELSE country END AS code, count(*) AS n_rows FROM s GROUP BY 1, 2""")
def category_countries(spark, d):
    s = table(spark, d, "streams").select(tx.country_of("cat_name").alias("country"))
    return s.groupBy("country", tx.country_code("country").alias("code")).agg(F.count("*").alias("n_rows"))


@query("""SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE trim(coalesce(title, '')) <> '' AND lower(trim(title)) NOT IN
  ('to be announced', 'tba', 'no information', 'no programme information', 'no program information', 'no match', 'no data')) AS n_known FROM programme GROUP BY 1""")
def known_titles(spark, d):
    return table(spark, d, "programme").groupBy("source").agg(F.count("*").alias("n_rows"), F.count(F.when(schedule.known_title("title"), 1)).alias("n_known"))


@query("""WITH f AS (SELECT map_id, coalesce(country, '?') AS country, c.source AS source, c.source_id AS source_id FROM (SELECT map_id, country, unnest(candidates) AS c FROM mapping))
  SELECT map_id, country, source, source_id FROM f WHERE NOT (source = 'megafeed' AND country IN ('UK', 'DE')) OR starts_with(source_id, 'G#')""")
def territory_prefix(spark, d):
    rows = match.exploded(table(spark, d, "mapping")).select("map_id", F.coalesce("country", F.lit("?")).alias("country"), "source", "source_id")
    return match.prefixed(rows, spark.createDataFrame([("megafeed", "UK", "G#"), ("megafeed", "DE", "G#")], "source string, country string, prefix string")).select("map_id", "country", "source", "source_id")


_SIGNED = "concat('ABC: FL | Town ', s_suppkey, ' | W', chr(CAST(65 + s_suppkey % 26 AS INTEGER)), chr(CAST(65 + s_suppkey // 26 % 26 AS INTEGER)), 'T', CASE WHEN s_suppkey % 7 = 0 THEN '-DT2' ELSE '' END)"


def _signed(spark, d):
    k = F.col("s_suppkey")
    letter = lambda c: F.char((65 + c % 26).cast("int"))
    name = F.concat(F.lit("ABC: FL | Town "), k.cast("string"), F.lit(" | W"), letter(k), letter(F.floor(k / 26)), F.lit("T"), F.when(k % 7 == 0, "-DT2").otherwise(""))
    return table(spark, d, "supplier").select("s_suppkey", name.alias("name"))


@query(f"""WITH s AS (SELECT s_suppkey, {_SIGNED} AS name FROM supplier) SELECT s_suppkey, lower(list_last(regexp_extract_all(name, '\\b([KW][A-Z]{{2,3}})\\b', 1))) AS sign,
  nullif(lower(regexp_extract(name, '(?i)\\b([KW][A-Z]{{2,3}}-DT[0-9]+)\\b', 1)), '') AS sub FROM s""")
def name_signs(spark, d):
    return _signed(spark, d).select("s_suppkey", tx.last_call_sign("name").alias("sign"), tx.sub_feed("name").alias("sub"))


@query(f"""WITH s AS (SELECT s_suppkey AS stream_id, {_SIGNED} AS name FROM supplier), x AS (SELECT *, lower(list_last(regexp_extract_all(name, '\\b([KW][A-Z]{{2,3}})\\b', 1))) AS sign, contains(name, '-DT2') AS dt FROM s),
  c AS (SELECT 'us' AS source, concat(upper(sign), CASE WHEN stream_id % 3 = 0 THEN '-DT2.us' ELSE '.us' END) AS id, sign FROM x),
  u AS (SELECT sign, count(DISTINCT id) AS n, min(id) AS id, bool_or(contains(id, '-DT2')) AS dt, count(DISTINCT id) FILTER (WHERE contains(id, '-DT2')) AS n2, min(id) FILTER (WHERE contains(id, '-DT2')) AS id2 FROM c GROUP BY 1)
  SELECT stream_id, 'us' AS source, CASE WHEN x.dt THEN id2 ELSE id END AS source_id FROM x JOIN u USING (sign) WHERE CASE WHEN x.dt THEN n2 = 1 ELSE n = 1 AND NOT u.dt END""")
def call_sign_join(spark, d):
    s = _signed(spark, d).select(F.col("s_suppkey").alias("stream_id"), tx.last_call_sign("name").alias("call_sign"), tx.sub_feed("name").alias("sub_feed"))
    c = s.select(F.lit("us").alias("source"), F.concat(F.upper("call_sign"), F.when(F.col("stream_id") % 3 == 0, "-DT2.us").otherwise(".us")).alias("id"), "call_sign")
    return match.call_sign_match(s, c)


@query("""SELECT id, lower(regexp_extract(concat('HTTPS://User@Host', file_ord % 3, '.Invalid:80/', id), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host FROM channel""")
def hosts(spark, d):
    url = F.concat(F.lit("HTTPS://User@Host"), (F.col("file_ord") % 3).cast("string"), F.lit(".Invalid:80/"), "id")
    return table(spark, d, "channel").select("id", tx.host_of(url).alias("host"))


_WAITS = ["30", " 2.5 ", "-1", "1e9", "abc", "", "3600", "0", "NaN"]


@query(f"SELECT unnest({_WAITS}) AS header, CAST(unnest([30, 2.5, NULL, NULL, NULL, NULL, 3600, 0, NULL]) AS DOUBLE) AS seconds")
def retry_headers(spark, d):
    return spark.createDataFrame([(w,) for w in _WAITS], "header string").select("header", tx.retry_seconds("header").alias("seconds"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) + CAST((o_orderkey % 7 - (isodow(o_orderdate) - 1) + 7) % 7 AS INTEGER) AS day, CAST(o_orderkey % 12 * 60 + o_orderkey % 60 + CASE WHEN o_orderkey % 2 = 1 THEN 720 ELSE 0 END AS INTEGER) AS minute FROM orders""")
def clocks_and_days(spark, d):
    k = F.col("o_orderkey")
    hour = F.when(k % 12 == 0, 12).otherwise(k % 12).cast("string")
    clock = F.concat(hour, F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"), F.when(k % 2 == 1, " pm").otherwise(" A.M."))
    return table(spark, d, "orders").select("o_orderkey", tx.next_weekday(F.col("o_orderdate").cast("date"), (k % 7).cast("int")).alias("day"), tx.clock_12(clock).alias("minute"))


@query("SELECT prog_id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(concat('<p class=\"x\">', title, '</p><br/>'), '<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '\\s+', ' ', 'g'), '^ | $', '', 'g') AS t FROM programme WHERE title IS NOT NULL AND NOT contains(title, '&amp;')")
def html_texts(spark, d):
    p = table(spark, d, "programme").filter("title is not null and not contains(title, '&amp;')")
    return p.select("prog_id", tx.html_text(F.concat(F.lit('<p class="x">'), "title", F.lit("</p><br/>"))).alias("t"))


@query("""SELECT display_name, list_reduce(list_prepend('', list_filter(string_split(norm, ' '), lambda w, i: list_position(string_split(norm, ' '), w) = i)), lambda a, b: CASE WHEN a = '' THEN b ELSE concat(a, ' ', b) END) AS q
  FROM (SELECT DISTINCT display_name, {n} AS norm FROM channel WHERE display_name IS NOT NULL)""".replace("{n}", ref.N_CHANNEL))
def query_words(spark, d):
    c = table(spark, d, "channel").filter("display_name is not null").select("display_name").distinct()
    return c.select("display_name", tx.distinct_words(tx.transliterate(tx.norm_ascii("display_name"))).alias("q"))


# --- joins ------------------------------------------------------------------------------------------------
@query(f"WITH {ref._NAMES}, a AS (SELECT DISTINCT norm_name, concat(norm_name, ' 2') AS alias FROM s WHERE norm_name <> ''), k AS (SELECT source, norm_name AS alias, min(id) AS id FROM c GROUP BY 1, 2 HAVING count(DISTINCT id) = 1) SELECT DISTINCT stream_id, source, id AS source_id FROM s JOIN a USING (norm_name) JOIN k USING (alias)")
def alias_join(spark, d):
    s, c = ref._streams(spark, d).select("stream_id", "norm_name"), ref._channels(spark, d).select("source", "id", "norm_name")
    aliases = s.filter("norm_name <> ''").select("norm_name", F.concat("norm_name", F.lit(" 2")).alias("alias")).distinct()
    return match.alias_match(s, aliases, c).select("stream_id", "source", "source_id")


@query(f"WITH o AS (SELECT DISTINCT TRY_CAST(stream_id AS BIGINT) AS stream_id, c.source AS source, c.source_id AS source_id FROM (SELECT stream_id, unnest(candidates) AS c FROM mapping)) SELECT o.* FROM o JOIN (SELECT DISTINCT {_SID} AS stream_id FROM streams WHERE snapshot_no = 6) USING (stream_id)")
def override_join(spark, d):
    o = table(spark, d, "mapping").select(F.expr("try_cast(stream_id as bigint)").alias("stream_id"), F.explode("candidates").alias("c")).select("stream_id", "c.source", "c.source_id").distinct()
    return match.override_match(_stations(spark, d), o)


@query(f"""WITH {ref._SPLIT}, {ref._NAMES}, n AS (SELECT norm_name, min(id) AS id FROM c WHERE norm_name <> '' GROUP BY 1 HAVING count(DISTINCT id) = 1),
  x AS (SELECT DISTINCT {_SID} AS stream_id, trim(epg_channel_id) AS epg, {ref.N_STREAM} AS norm_name, coalesce(nullif(upper(regexp_extract(trim(coalesce(cat_name, '')), '^([A-Za-z]{{2,3}})\\s*\\|', 1)), ''), '??') AS country FROM streams WHERE snapshot_no = 6),
  y AS (SELECT x.*, coalesce(epg <> '' AND NOT {ref._JUNK}, false) AS is_real, canonical_id FROM x JOIN split USING (stream_id))
  SELECT DISTINCT stream_id, epg AS source_id, 'epg-id' AS match_method, CAST(1 AS DOUBLE) AS confidence FROM y WHERE is_real AND epg = canonical_id
  UNION SELECT stream_id, id, 'name', CAST(0.9 AS DOUBLE) FROM y JOIN n USING (norm_name) WHERE NOT is_real AND (NOT contains(id, '.') OR upper(split_part(id, '.', -1)) = CASE country WHEN 'UK' THEN 'GB' WHEN 'USA' THEN 'US' ELSE country END)""")
def provider_join(spark, d):
    s = _stations(spark, d)
    ids = match.collision_split(s.select("stream_id", "epg_channel_id"))
    s = s.select("stream_id", "epg_channel_id", tx.norm_ascii("name").alias("norm_name"), tx.country_of("cat_name").alias("country")).join(ids, "stream_id")
    return match.provider_match(s, ref._channels(spark, d).select("id", "norm_name"))


@query(f"""WITH o AS (SELECT TRY_CAST(stream_id AS BIGINT) AS stream_id, min(canonical_id) AS cid FROM mapping WHERE canonical_id IS NOT NULL GROUP BY 1),
  x AS (SELECT DISTINCT {_SID} AS stream_id FROM streams WHERE snapshot_no = 6), y AS (SELECT stream_id, coalesce(cid, concat('xtream:', stream_id)) AS canonical_id FROM x LEFT JOIN o USING (stream_id))
  SELECT stream_id, canonical_id, count(*) OVER (PARTITION BY canonical_id) = 1 AS is_unique FROM y""")
def identity_ids(spark, d):
    o = table(spark, d, "mapping").filter("canonical_id is not null").select(F.expr("try_cast(stream_id as bigint)").alias("stream_id"), "canonical_id")
    return match.identity_join(_stations(spark, d), o)


@query(f"""WITH {ref._NAMES}, a AS (SELECT DISTINCT norm_name AS name FROM s WHERE norm_name <> ''), b AS (SELECT norm_name AS service, min(id) AS ord FROM c WHERE norm_name <> '' GROUP BY 1)
  SELECT name, arg_min(service, (ord, service)) AS service FROM a JOIN b ON contains(name, service) OR contains(service, name) GROUP BY 1""")
def substring_join(spark, d):
    b = ref._channels(spark, d).groupBy(F.col("norm_name").alias("service")).agg(F.min("id").alias("ord"))
    return match.substring_match(ref._streams(spark, d).select(F.col("norm_name").alias("name")), b)


@query(f"""WITH {ref._NAMES}, {ref._DICE}, u AS (SELECT DISTINCT norm_name FROM s WHERE norm_name <> ''), i AS (SELECT source, norm_name, min(id) AS id FROM c WHERE norm_name <> '' GROUP BY 1, 2),
  e AS (SELECT norm_name, source, 'exact' AS match_method, id FROM u JOIN i USING (norm_name)),
  z AS (SELECT f.lname AS norm_name, f.source, 'fuzzy' AS match_method, i.id FROM f JOIN i ON i.source = f.source AND i.norm_name = f.rname WHERE f.rank = 1 AND NOT EXISTS (SELECT 1 FROM e WHERE e.norm_name = f.lname AND e.source = f.source)),
  h AS (SELECT x.*, CAST(row_number() OVER (PARTITION BY norm_name ORDER BY trust, source) AS INTEGER) AS hit FROM (SELECT * FROM e UNION ALL SELECT * FROM z) x JOIN sources USING (source))
  SELECT norm_name, source, match_method, id, hit FROM h WHERE hit <= 5""")
def self_report(spark, d):
    sources = table(spark, d, "sources").select("source", F.col("trust").alias("ord"))
    return match.self_report(ref._streams(spark, d), ref._channels(spark, d).select("source", "id", "norm_name"), sources)


@query(f"""WITH {ref._NAMES}, {ref._DICE.replace("HAVING count(DISTINCT id) = 1", "").replace("score >= 0.85", "score >= 0.8").replace("WHERE rank <= 2", "")}
  SELECT DISTINCT source, id, norm_name FROM c WHERE norm_name <> '' AND (norm_name IN (SELECT norm_name FROM s) OR norm_name IN (SELECT rname FROM f))""")
def lineup_reduction(spark, d):
    return match.reduce_lineup(ref._channels(spark, d).filter("norm_name <> ''"), ref._streams(spark, d))


@query("""WITH c AS (SELECT DISTINCT id, min(display_name) OVER (PARTITION BY id) AS source_name, max(icon) OVER (PARTITION BY id) AS source_icon FROM channel),
  m AS (SELECT map_id, name, c.source_id AS id FROM (SELECT map_id, name, candidates[1] AS c FROM mapping)),
  x AS (SELECT map_id, nullif(trim(name), '') AS a, CASE WHEN coalesce(lower(name) = lower(source_name), false) THEN NULL ELSE nullif(trim(source_name), '') END AS b, source_icon FROM m LEFT JOIN c USING (id))
  SELECT map_id, concat_ws('|', a, b) AS names, coalesce(nullif(trim(source_icon), ''), '') AS icon FROM x""")
def display_names(spark, d):
    c = table(spark, d, "channel").groupBy("id").agg(F.min("display_name").alias("source_name"), F.max("icon").alias("source_icon"))
    m = table(spark, d, "mapping").select("map_id", "name", F.lit(None).cast("string").alias("icon"), F.get("candidates", F.lit(0))["source_id"].alias("id"))
    out = cascade.display_parts(m.join(c, "id", "left"), F.lower("name") == F.lower("source_name"))
    return out.select("map_id", F.array_join("display_names", "|").alias("names"), F.col("shown_icon").alias("icon"))


# --- measures -----------------------------------------------------------------------------------------------
@query(f"WITH {SHOWS} SELECT channel, round(avg(CASE WHEN stop >= {NOW - NOW % 86400} THEN 1.0 ELSE 0.0 END), 6) AS share FROM shows GROUP BY 1")
def currency_shares(spark, d):
    return measure.currency_share(ref.shows(spark, d), "channel", NOW)


@query("SELECT coalesce(c.source, 'none') AS source, coalesce(c.match_method, 'none') AS match_method, count(*) AS n_rows FROM (SELECT unnest(candidates) AS c FROM mapping) GROUP BY 1, 2")
def selection_counts(spark, d):
    return measure.selection_counts(match.exploded(table(spark, d, "mapping")), ["source", "match_method"])


@query("SELECT canonical_id, min(country) AS country FROM mapping GROUP BY 1 HAVING count(DISTINCT country) = 1")
def single_values(spark, d):
    return measure.single_valued(table(spark, d, "mapping"), ["canonical_id"], "country")


@query("SELECT id AS channel, count(p.channel) AS n_rows, count(p.channel) > 0 AS ok FROM (SELECT DISTINCT id FROM channel) c LEFT JOIN programme p ON p.channel = c.id GROUP BY 1")
def expected_channels(spark, d):
    return measure.expected_status(table(spark, d, "channel").select(F.col("id").alias("channel")), table(spark, d, "programme"), "channel")


@query(f"WITH {SHOWS} SELECT channel, max(stop) AS newest, greatest(0, {NOW} - max(stop)) AS age FROM shows GROUP BY 1")
def staleness(spark, d):
    return measure.staleness(ref.shows(spark, d), "channel", "stop", NOW)


@query(f"""WITH a AS (SELECT DISTINCT {_SID} AS k FROM streams WHERE snapshot_no = 5), b AS (SELECT DISTINCT {_SID} AS k FROM streams WHERE snapshot_no = 6)
  SELECT count(*) AS n_before, count(b.k) AS n_kept, count(*) > 0 AND count(b.k) >= 0.95 * count(*) AS passed FROM a LEFT JOIN b USING (k)""")
def retained_streams(spark, d):
    s = table(spark, d, "streams").withColumn("k", whole_number("stream_id"))
    return measure.retained_share(s.filter("snapshot_no = 5"), s.filter("snapshot_no = 6"), "k")


@query("""WITH s AS (SELECT coalesce(nullif(upper(regexp_extract(trim(coalesce(cat_name, '')), '^([A-Za-z]{2,3})\\s*\\|', 1)), ''), '??') AS country, name, trim(coalesce(epg_channel_id, '')) <> '' AS covered FROM streams)
  SELECT country, count(*) AS n_rows, count(*) FILTER (WHERE covered) AS n_covered, coalesce(array_to_string(list_sort(list(DISTINCT name) FILTER (WHERE NOT covered AND name IS NOT NULL)), '|'), '') AS open_names FROM s GROUP BY 1""")
def country_names(spark, d):
    s = table(spark, d, "streams").select(tx.country_of("cat_name").alias("country"), "name", (F.trim(F.coalesce("epg_channel_id", F.lit(""))) != "").alias("covered"))
    return measure.country_names(s).withColumn("open_names", F.array_join("open_names", "|"))


def queries():
    return dict(Q)


def oracle_sql():
    return dict(SQL)
