"""Queries of the schedule operators over the test tables, with the same in SQL.

``events`` serves as a schedule whose times are exact: channel = user, start =
second of ``ts``, stop = start + floor(60 * value), title = event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions import text as tx
from airloom.operators import cascade, match, measure, schedule
from airloom.operators.timestamps import normalise_instants
from airloom.plans.problems import whole_number
from airloom.session import scratch_path, spread, table, tune
from airloom.sources import playlists, xmltv
from airloom.streaming import monitor

NOW = 1705320000  # 2024-01-15 12:00 UTC, inside the events
DAY = "2024-01-15"


def shows(spark: SparkSession, d: str) -> DataFrame:
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    e = table(spark, d, "events").select("event_id", F.col("user_id").cast("string").alias("channel"), start.alias("start"), "value", F.col("event_type").alias("title"))
    return e.select("event_id", "channel", "start", (F.col("start") + F.floor(F.col("value") * 60)).alias("stop"), "title")


SHOWS = """shows AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS channel, epoch_us(ts) // 1000000 AS start,
         epoch_us(ts) // 1000000 + CAST(floor(value * 60) AS BIGINT) AS stop, event_type AS title FROM events)"""
REASON = f"""CASE WHEN start IS NULL OR stop IS NULL THEN 'malformed' WHEN stop <= start THEN 'not_positive'
  WHEN stop - start > {schedule.MAX_SPAN} THEN 'too_long' WHEN stop <= {NOW} THEN 'past' WHEN trim(coalesce(title, '')) = '' THEN 'no_title' END"""
Q: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = lambda spark, d: f(tune(spark), d)
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- filters and windows of a schedule ---------------------------------------------------------
@query(f"WITH {SHOWS} SELECT event_id, channel, start, stop, title FROM shows WHERE ({REASON}) IS NULL")
def usable_rows(spark, d):
    return schedule.usable(shows(spark, d), NOW)


@query(f"WITH {SHOWS} SELECT coalesce({REASON}, 'kept') AS reason, count(*) AS n_rows FROM shows GROUP BY 1")
def drop_reasons(spark, d):
    return schedule.drop_reasons(shows(spark, d), NOW)


@query(f"WITH {SHOWS} SELECT event_id, channel, start, stop, title FROM shows WHERE stop IS NULL OR stop // 86400 >= datediff('day', DATE '1970-01-01', DATE '{DAY}')")
def currency_gate(spark, d):
    return schedule.currency_gate(shows(spark, d), DAY)


@query(f"""WITH {SHOWS}, r AS (SELECT channel, start, stop, title, row_number() OVER (PARTITION BY channel ORDER BY start DESC, title, stop) AS n
  FROM shows WHERE start <= {NOW} AND stop > {NOW}) SELECT channel, start, stop, title FROM r WHERE n = 1""")
def active_at(spark, d):
    return schedule.active_at(shows(spark, d), NOW)


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
  ORDER BY l_linenumber, l_suppkey, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def first_wins_dedupe(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity")
    return schedule.first_wins(rows, ["l_orderkey", "l_partkey"], ["l_linenumber", "l_suppkey", "l_quantity"]).drop("l_quantity")


@query(f"""WITH {SHOWS}, p AS (SELECT *, max(stop) OVER (PARTITION BY channel ORDER BY start, stop, title ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
    FROM shows WHERE stop > start),
  i AS (SELECT *, sum(CASE WHEN pm IS NULL OR start >= pm THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY start, stop, title ROWS UNBOUNDED PRECEDING) AS island FROM p)
  SELECT channel, min(start) AS start, max(stop) AS stop, arg_min(title, (start, stop, title)) AS title, count(*) AS n_rows FROM i GROUP BY channel, island
  HAVING count(DISTINCT lower(trim(title))) = 1""")
def overlap_islands(spark, d):
    return schedule.overlap_islands(shows(spark, d).filter("stop > start"))


@query(f"""WITH {SHOWS}, c AS (SELECT channel, greatest(start, {NOW}) AS a, least(stop, {NOW} + 86400) AS b FROM shows),
  p AS (SELECT *, max(b) OVER (PARTITION BY channel ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM c WHERE b > a)
  SELECT channel, CAST(sum(greatest(0, b - greatest(a, coalesce(pm, a)))) AS BIGINT) AS seconds FROM p GROUP BY channel""")
def usable_hours_union(spark, d):
    return schedule.covered_seconds(shows(spark, d), NOW, 86400)


@query(f"""WITH {SHOWS}, n AS (SELECT event_id, channel, start, coalesce(lead(start) OVER (PARTITION BY channel ORDER BY start, event_id), start + 3600) AS stop, title
  FROM shows) SELECT * FROM n WHERE stop > start""")
def lead_stop(spark, d):
    return schedule.lead_stop(shows(spark, d), ["event_id"]).select("event_id", "channel", "start", "stop", "title")


@query(f"WITH {SHOWS} SELECT event_id, start % 86400 AS start, CASE WHEN stop % 86400 <= start % 86400 THEN stop % 86400 + 86400 ELSE stop % 86400 END AS stop FROM shows")
def next_day_stop(spark, d):
    rows = shows(spark, d).select("event_id", (F.col("start") % 86400).alias("start"), (F.col("stop") % 86400).alias("stop"))
    return schedule.rollover(rows)


@query(f"""WITH {SHOWS}, m AS (SELECT *, sum(CASE WHEN title = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY channel ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS part FROM shows)
  SELECT event_id, channel, CAST(sum(CASE WHEN title = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY channel, part ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_length FROM m""")
def consecutive_failures(spark, d):
    rows = schedule.failure_runs(shows(spark, d), "channel", ["start", "event_id"], F.col("title") == "error")
    return rows.select("event_id", "channel", F.col("run_length").cast("long").alias("run_length"))


@query(f"""WITH {SHOWS}, f AS (SELECT *, CASE WHEN title IN ('view', 'click') THEN title END AS t FROM shows)
  SELECT event_id, channel, last_value(t IGNORE NULLS) OVER (PARTITION BY channel ORDER BY start, event_id ROWS UNBOUNDED PRECEDING) AS t FROM f""")
def carry_forward(spark, d):
    rows = shows(spark, d).withColumn("t", F.when(F.col("title").isin("view", "click"), F.col("title")))
    return schedule.carry_forward(rows, "channel", ["start", "event_id"], ["t"]).select("event_id", "channel", "t")


@query(f"""WITH RECURSIVE {SHOWS}, r AS (SELECT event_id, channel, start // 86400 AS day, (start // 60) % 720 AS a, (stop // 60) % 720 AS b,
    row_number() OVER (PARTITION BY channel, start // 86400 ORDER BY start, event_id) AS n FROM shows WHERE start IS NOT NULL AND stop IS NOT NULL),
  w AS (SELECT *, b - a + 720 * greatest(0, CAST(ceil((a - b) / 720) AS BIGINT)) AS len FROM r),
  c AS (SELECT event_id, channel, day, n, a, len, CAST(0 AS BIGINT) AS k FROM w WHERE n = 1
    UNION ALL SELECT w.event_id, w.channel, w.day, w.n, w.a, w.len, greatest(0, CAST(ceil((c.a + 720 * c.k + c.len - 15 - w.a) / 720) AS BIGINT))
    FROM c JOIN w ON w.channel = c.channel AND w.day = c.day AND w.n = c.n + 1)
  SELECT event_id, a + 720 * k AS a, a + 720 * k + len AS b FROM c""")
def half_day_clock(spark, d):
    rows = shows(spark, d).select("event_id", "channel", F.floor(F.col("start") / 86400).alias("day"), (F.floor(F.col("start") / 60) % 720).alias("a"), (F.floor(F.col("stop") / 60) % 720).alias("b"), "start")
    rows = rows.withColumn("key", F.concat_ws("/", "channel", F.col("day").cast("string")))
    return schedule.half_day_clock(rows, "key", ["start", "event_id"], "a", "b", bucket=6 * 3600).select("event_id", "a", "b")


# --- cascade ------------------------------------------------------------------------------------
_TITLES = {"signup": "Garden Hour", "click": "Into the Unknown", "view": "Live Football", "purchase": "The Garden Hour"}
_FILLERS = ("TBA", "Teleshopping Hour", " to  be announced", "No Match today")


def _ranked(spark, d):
    """Every event as a row of one of three candidates of its user; errors have filler titles."""
    title = F.create_map(*[F.lit(x) for p in _TITLES.items() for x in p])[F.col("title")]
    filler = F.element_at(F.array(*map(F.lit, _FILLERS)), (F.col("event_id") % 4 + 1).cast("int"))
    method = F.element_at(F.array(F.lit("exact"), F.lit("fuzzy"), F.lit("alias")), (F.col("event_id") % 3 + 1).cast("int"))
    return shows(spark, d).filter("stop > start").select(
        "event_id", F.col("channel").alias("stream"), (F.col("event_id") % 3 + 1).alias("rank"), method.alias("match_method"),
        "start", "stop", F.coalesce(title, filler).alias("title"),
    )


_SHOWN = " ".join(f"WHEN title = '{k}' THEN '{v}'" for k, v in _TITLES.items())
_RANKED = f"""ranked AS (SELECT event_id, channel AS stream, event_id % 3 + 1 AS rank, event_id % 3 <> 1 AS sure, start, stop,
  CASE {_SHOWN} ELSE list_extract({list(_FILLERS)}, CAST(event_id % 4 + 1 AS INTEGER)) END AS title FROM shows WHERE stop > start)"""
_CLEAN = lambda c: f"lower(trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g')))"
_EMPTY = lambda c: f"({_CLEAN(c)} IN ('tba', 'to be announced') OR {' OR '.join(f'contains({_CLEAN(c)}, {chr(39)}{p}{chr(39)})' for p in cascade.FILLER_PARTS)})"
_SUMMARY = f"""summary AS (SELECT stream, rank, bool_or(sure) AS trusted, count(*) AS n_rows, arg_min(title, (start, title)) FILTER (WHERE start <= {NOW} AND stop > {NOW}) AS active_title,
  bool_and({_EMPTY("title")}) AS all_placeholder FROM ranked GROUP BY 1, 2)"""
_PICK = f"""good AS (SELECT stream, rank, trusted, active_title, {_CLEAN("active_title")} AS t FROM summary WHERE active_title IS NOT NULL AND NOT {_EMPTY("active_title")}),
  clash AS (SELECT DISTINCT stream FROM good x JOIN good y USING (stream) WHERE x.trusted AND y.trusted AND x.t <> y.t AND NOT (ends_with(x.t, 'garden hour') AND ends_with(y.t, 'garden hour'))),
  one AS (SELECT stream, min(rank) AS r, arg_min(coalesce(active_title, '?none'), rank) AS act, arg_min(all_placeholder, rank) AS allp, min(rank) FILTER (WHERE NOT all_placeholder) AS real FROM summary GROUP BY 1),
  g AS (SELECT stream, min(rank) AS good, min(rank) FILTER (WHERE trusted) AS sure FROM good GROUP BY 1),
  step AS (SELECT one.*, good, sure, stream IN (SELECT stream FROM clash) AS conflict, CASE WHEN act = '?none' AND sure IS NOT NULL THEN 2 WHEN act <> '?none' AND {_EMPTY("act")} AND good IS NOT NULL THEN 3
    WHEN stream NOT IN (SELECT stream FROM clash) AND allp AND real IS NOT NULL THEN 4 ELSE 1 END AS step FROM one LEFT JOIN g USING (stream)),
  picked AS (SELECT stream, CASE step WHEN 2 THEN sure WHEN 3 THEN good WHEN 4 THEN real ELSE r END AS rank, step, conflict FROM step)"""


@query(f"WITH {SHOWS}, {_RANKED}, {_SUMMARY} SELECT stream, rank, trusted, n_rows, active_title, all_placeholder FROM summary")
def candidate_summary(spark, d):
    return cascade.candidate_summary(_ranked(spark, d), NOW)


@query(f"WITH {SHOWS}, {_RANKED}, {_SUMMARY}, {_PICK} SELECT stream, rank, step, conflict FROM picked")
def cascade_pick(spark, d):
    return cascade.pick(cascade.candidate_summary(_ranked(spark, d), NOW))


@query(f"""WITH {SHOWS}, {_RANKED}, {_SUMMARY}, {_PICK},
  own AS (SELECT stream AS channel, start, stop, title, row_number() OVER (PARTITION BY stream, start ORDER BY stop, title) AS n FROM ranked JOIN picked USING (stream, rank)
    WHERE NOT (conflict AND start <= {NOW} AND stop > {NOW})),
  p AS (SELECT *, max(stop) OVER (PARTITION BY channel ORDER BY start, stop, title ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM own WHERE n = 1),
  i AS (SELECT *, sum(CASE WHEN pm IS NULL OR start >= pm THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY start, stop, title ROWS UNBOUNDED PRECEDING) AS island FROM p)
  SELECT channel, min(start) AS start, max(stop) AS stop, arg_min(title, (start, stop, title)) AS title, count(*) AS n_rows FROM i GROUP BY channel, island
  HAVING count(DISTINCT {_CLEAN("title")}) = 1""")
def merged_guide(spark, d):
    rows = _ranked(spark, d)
    return cascade.merge(rows, cascade.pick(cascade.candidate_summary(rows, NOW)), NOW)


# titles that hold a filler's letters but are none, and fillers in other spellings
_PROBES = ("Live Football", "Into the Unknown", "To Be Announced: News Special", "tba", " TBA ", "Teleshopping", "No  match until six", "Unknown", "", "Programmes start at 6")


@query(f"""SELECT title, n_rows, {_EMPTY("title")} AS filler FROM (SELECT title, count(*) AS n_rows FROM (SELECT title FROM programme
  UNION ALL SELECT unnest({list(_PROBES)}) AS title) GROUP BY 1)""")
def placeholder_titles(spark, d):
    probes = spark.createDataFrame([(p,) for p in _PROBES], "title string")
    titles = table(spark, d, "programme").select("title").unionByName(probes).groupBy("title").agg(F.count("*").alias("n_rows"))
    return titles.withColumn("filler", cascade.placeholder("title"))


@query()
def schedule_guide(spark, d):
    """The guide of the programme table itself: times read, rows filtered, first row of a start, overlaps resolved."""
    p = normalise_instants(spread(table(spark, d, "programme").select("prog_id", "source", "channel", "start_at", "stop_at", "title", "file_ord")), table(spark, d, "sources"), {"start_at": "start", "stop_at": "stop"})
    rows = p.filter("channel is not null and trim(title) <> ''").select("channel", "start", "stop", "title", "file_ord", "prog_id")
    rows = rows.filter((F.col("stop") > F.col("start")) & (F.col("stop") - F.col("start") <= schedule.MAX_SPAN))
    return schedule.overlap_islands(schedule.first_wins(rows, ["channel", "start"], ["file_ord", "prog_id"]))


# --- names and joins ------------------------------------------------------------------------------
N_STREAM, N_CHANNEL = tx.norm_ascii_sql("name"), tx.norm_ascii_sql("display_name")
_NAMES = f"""s AS (SELECT DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id, {N_STREAM} AS norm_name, lower(trim(name)) AS raw FROM streams WHERE snapshot_no = 6),
  c AS (SELECT DISTINCT source, id, {N_CHANNEL} AS norm_name, lower(trim(display_name)) AS raw FROM channel)"""


def _streams(spark, d):
    return table(spark, d, "streams").filter("snapshot_no = 6").select(whole_number("stream_id").alias("stream_id"), tx.norm_ascii("name").alias("norm_name"), F.col("name").alias("raw_name"))


def _channels(spark, d):
    return table(spark, d, "channel").select("source", "id", tx.norm_ascii("display_name").alias("norm_name"), F.col("display_name").alias("raw_name"))


@query(f"SELECT DISTINCT display_name, {N_CHANNEL} AS norm_name FROM channel WHERE display_name IS NOT NULL")
def norm_tokens(spark, d):
    return table(spark, d, "channel").filter("display_name is not null").select("display_name", tx.norm_ascii("display_name").alias("norm_name")).distinct()


@query()
def norm_unicode(spark, d):
    return table(spark, d, "channel").select("display_name").distinct().withColumn("norm_name", tx.norm("display_name"))


@query(f"WITH {_NAMES} SELECT source, norm_name, array_to_string(list_sort(list(DISTINCT id)), '|') AS ids FROM c WHERE norm_name <> '' GROUP BY 1, 2")
def multimap_index(spark, d):
    index = match.name_index(table(spark, d, "channel"), tx.norm_ascii("display_name"))
    return index.select("source", "norm_name", F.array_join("ids", "|").alias("ids"))


# a stream's one id per source: of several ids the one of its literal name
_EXACT = """p AS (SELECT source, norm_name, count(DISTINCT id) AS n_ids FROM c WHERE norm_name <> '' GROUP BY 1, 2),
  e1 AS (SELECT DISTINCT s.stream_id, c.source, s.raw AS sraw, c.id, c.raw, p.n_ids FROM s JOIN c USING (norm_name) JOIN p ON p.source = c.source AND p.norm_name = s.norm_name WHERE s.norm_name <> ''),
  e2 AS (SELECT stream_id, source, sraw, any_value(n_ids) AS n_ids, CASE WHEN any_value(n_ids) = 1 THEN any_value(id) WHEN count(DISTINCT id) FILTER (WHERE raw = sraw) = 1 THEN any_value(id) FILTER (WHERE raw = sraw) END AS one
    FROM e1 GROUP BY 1, 2, 3),
  exact AS (SELECT stream_id, source, CASE WHEN count(DISTINCT one) = 1 THEN min(one) END AS source_id, max(n_ids) AS n_ids FROM e2 GROUP BY 1, 2)"""


@query(f"WITH {_NAMES}, {_EXACT} SELECT stream_id, source, source_id, n_ids FROM exact")
def exact_match(spark, d):
    return match.exact_match(_streams(spark, d), _channels(spark, d))


@query(f"""WITH {_NAMES}, p AS (SELECT source, norm_name, count(DISTINCT id) AS n FROM c WHERE norm_name <> '' GROUP BY 1, 2)
  SELECT source, count(*) AS n_names, count(*) FILTER (WHERE n > 1) AS n_ambiguous FROM p GROUP BY 1""")
def ambiguous_reject(spark, d):
    index = match.name_index(table(spark, d, "channel"), tx.norm_ascii("display_name"))
    return index.groupBy("source").agg(F.count("*").alias("n_names"), F.count(F.when(F.size("ids") > 1, 1)).alias("n_ambiguous"))


# every two names that share a token, without any filter by rarity
_DICE = """a AS (SELECT DISTINCT norm_name AS lname, list_distinct(string_split(norm_name, ' ')) AS t1 FROM s WHERE norm_name <> ''),
  b AS (SELECT source, norm_name AS rname, list_distinct(string_split(norm_name, ' ')) AS t2 FROM c WHERE norm_name <> '' GROUP BY 1, 2 HAVING count(DISTINCT id) = 1),
  x AS (SELECT lname, unnest(t1) AS t FROM a), y AS (SELECT source, rname, unnest(t2) AS t FROM b),
  m AS (SELECT lname, source, rname, count(*) AS c FROM x JOIN y USING (t) WHERE lname <> rname GROUP BY ALL HAVING count(*) >= 2),
  w AS (SELECT *, [z FOR z IN t1 IF z NOT IN ('plus', '1')] AS u1, [z FOR z IN t2 IF z NOT IN ('plus', '1')] AS u2 FROM m JOIN a USING (lname) JOIN b USING (source, rname)),
  q AS (SELECT lname, source, rname, CAST(round(2.0 * c / (len(t1) + len(t2)), 6) AS DOUBLE) AS score FROM w
    WHERE list_contains(t1, 'plus') = list_contains(t2, 'plus') AND (NOT list_contains(t1, 'plus') OR list_sort(u1) = list_sort(u2) OR len(list_intersect(u1, u2)) >= 2)),
  f AS (SELECT lname, source, rname, score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lname, source ORDER BY score DESC, rname) AS INTEGER) AS rank FROM q WHERE score >= 0.85) WHERE rank <= 2)"""


@query(f"WITH {_NAMES}, {_DICE} SELECT lname, source, rname, score, rank FROM f")
def fuzzy_dice(spark, d):
    left = _streams(spark, d).select(F.col("norm_name").alias("lname"))
    return match.fuzzy_match(left, _channels(spark, d).select("source", "id", F.col("norm_name").alias("rname")))


def mapping_rows(spark, d):
    """The mapping built from names: exact and fuzzy phases of whole tables, ranked; a source whose exact name is ambiguous takes no fuzzy one."""
    s, c = _streams(spark, d), _channels(spark, d)
    found = match.exact_match(s, c)
    exact = found.filter("source_id is not null").withColumn("confidence", F.lit(0.99))
    fuzzy = match.fuzzy_match(s.select(F.col("norm_name").alias("lname")), c.select("source", "id", F.col("norm_name").alias("rname")))
    one = c.groupBy("source", F.col("norm_name").alias("rname")).agg(F.min("id").alias("source_id"))
    near = fuzzy.join(one, ["source", "rname"]).join(s.select("stream_id", F.col("norm_name").alias("lname")).distinct(), "lname")
    near = near.join(found.filter("n_ids > 1").select("stream_id", "source"), ["stream_id", "source"], "left_anti")
    phases = {"exact": exact, "fuzzy": near.select("stream_id", "source", "source_id", F.round("score", 2).alias("confidence"))}
    return match.combine(phases, table(spark, d, "sources"))


@query(f"""WITH {_NAMES}, {_EXACT}, {_DICE}, i AS (SELECT source, norm_name, min(id) AS id FROM c GROUP BY 1, 2),
  e AS (SELECT stream_id, source, source_id, CAST(0.99 AS DOUBLE) AS confidence, 0 AS phase, 'exact' AS match_method FROM exact WHERE source_id IS NOT NULL
    UNION ALL SELECT s.stream_id, f.source, i.id, round(f.score, 2), 1, 'fuzzy' FROM f JOIN i ON i.source = f.source AND i.norm_name = f.rname JOIN (SELECT DISTINCT stream_id, norm_name FROM s) s ON s.norm_name = f.lname
    WHERE NOT EXISTS (SELECT 1 FROM exact x WHERE x.n_ids > 1 AND x.stream_id = s.stream_id AND x.source = f.source)),
  o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stream_id, source, source_id ORDER BY phase, confidence DESC) AS n FROM e) WHERE n = 1)
  SELECT stream_id, source, source_id, confidence, match_method, CAST(row_number() OVER (PARTITION BY stream_id ORDER BY trust NULLS LAST, confidence DESC, source, source_id) AS INTEGER) AS rank
  FROM o LEFT JOIN (SELECT source, trust FROM sources) USING (source)""")
def mapping_build(spark, d):
    return mapping_rows(spark, d)


@query("""WITH f AS (SELECT map_id, c.source AS source, c.source_id AS id FROM (SELECT map_id, unnest(candidates) AS c FROM mapping))
  SELECT map_id, source, id FROM f WHERE NOT EXISTS (SELECT 1 FROM channel c WHERE c.source = f.source AND c.id = f.id)""")
def missing_references(spark, d):
    rows = match.exploded(table(spark, d, "mapping")).select("map_id", "source", F.col("source_id").alias("id"))
    return match.missing_references(rows, ["source", "id"], table(spark, d, "channel")).select("map_id", "source", "id")


_CAND = "cand AS (SELECT map_id, country, unnest(candidates) AS c, generate_subscripts(candidates, 1) AS pos FROM mapping)"


@query(f"""WITH {_CAND}, f AS (SELECT map_id, c.source AS source, c.source_id AS source_id, c.confidence AS confidence, pos FROM cand),
  o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY map_id, source, source_id ORDER BY pos) AS n FROM f WHERE source IS NOT NULL AND source_id IS NOT NULL) WHERE n = 1)
  SELECT map_id, source, source_id, confidence, row_number() OVER (PARTITION BY map_id ORDER BY trust NULLS LAST, confidence DESC NULLS LAST, pos) AS rank
  FROM o LEFT JOIN (SELECT source, trust FROM sources) USING (source)""")
def candidate_rank(spark, d):
    return match.rank_candidates(match.exploded(table(spark, d, "mapping")), table(spark, d, "sources"))


@query(f"""WITH {_CAND}, f AS (SELECT map_id, country, CAST(pos AS INTEGER) AS pos, c.source AS source, c.source_id AS source_id, c.match_method AS match_method, c.confidence AS confidence FROM cand)
  SELECT f.* FROM f JOIN sources s USING (source) WHERE f.country IS NULL OR trim(f.country) = '' OR list_contains(s.countries, f.country)""")
def policy_gate(spark, d):
    return match.policy_gate(match.exploded(table(spark, d, "mapping")), table(spark, d, "sources"))


@query(f"""WITH {_CAND}, f AS (SELECT map_id, c.source AS source, c.source_id AS source_id FROM cand)
  SELECT * FROM f WHERE source IS NOT NULL AND source_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM channel ch WHERE ch.source = f.source AND ch.id = f.source_id AND ch.icon IS NULL)""")
def deny_antijoin(spark, d):
    rows = match.exploded(table(spark, d, "mapping")).filter("source is not null and source_id is not null").select("map_id", "source", "source_id")
    denied = table(spark, d, "channel").filter("icon is null").select("source", F.col("id").alias("source_id"))
    return match.deny(rows, denied).select("map_id", "source", "source_id")


_JUNK = "regexp_matches(epg, '(?i)(\\.(epg|L|UFC|BRLIVE|ESPN|MLB|NFL|NBA|NHL|PPV|EVENT)$|servicestatus|event3hour)')"
_SPLIT = f"""s6 AS (SELECT DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id, trim(epg_channel_id) AS epg FROM streams WHERE snapshot_no = 6),
  r6 AS (SELECT DISTINCT stream_id, CASE WHEN epg <> '' AND NOT {_JUNK} THEN epg END AS epg FROM s6), n6 AS (SELECT epg, count(*) AS n FROM r6 WHERE epg IS NOT NULL GROUP BY 1),
  split AS (SELECT stream_id, CASE WHEN n = 1 THEN epg ELSE concat('xtream:', stream_id) END AS canonical_id FROM r6 LEFT JOIN n6 USING (epg))"""


@query(f"WITH {_SPLIT} SELECT stream_id, canonical_id FROM split")
def collision_split(spark, d):
    s = table(spark, d, "streams").filter("snapshot_no = 6").select(whole_number("stream_id").alias("stream_id"), "epg_channel_id")
    return match.collision_split(s)


@query("""WITH s AS (SELECT DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id, category_id FROM streams WHERE snapshot_no = 6),
  k AS (SELECT category_id, min(cat_name) AS label FROM streams WHERE trim(cat_name) <> '' GROUP BY 1) SELECT stream_id, coalesce(label, '') AS label FROM s LEFT JOIN k USING (category_id)""")
def dimension_left_join(spark, d):
    s = table(spark, d, "streams")
    labels = s.filter("trim(cat_name) <> ''").groupBy("category_id").agg(F.min("cat_name").alias("label"))
    own = s.filter("snapshot_no = 6").select(whole_number("stream_id").alias("stream_id"), "category_id").distinct()
    return own.join(labels, "category_id", "left").select("stream_id", F.coalesce("label", F.lit("")).alias("label"))


@query("SELECT DISTINCT channel, prog_id FROM programme p WHERE EXISTS (SELECT 1 FROM channel c WHERE c.id = p.channel AND c.source = p.source)")
def declared_programmes(spark, d):
    declared = table(spark, d, "channel").select("source", F.col("id").alias("channel")).distinct()
    return table(spark, d, "programme").select("channel", "prog_id", "source").join(declared, ["source", "channel"], "left_semi").select("channel", "prog_id").distinct()


@query("SELECT channel, min(prog_id) AS first_prog FROM programme WHERE channel IS NOT NULL GROUP BY 1")
def first_seen(spark, d):
    return table(spark, d, "programme").filter("channel is not null").groupBy("channel").agg(F.min("prog_id").alias("first_prog"))


# --- measures ---------------------------------------------------------------------------------------
@query(f"""WITH {SHOWS} SELECT count(DISTINCT channel) AS channels, count(*) AS programmes,
  count(DISTINCT channel) FILTER (WHERE stop > {NOW} AND start < {NOW} + 86400) AS next_24h, count(DISTINCT channel) FILTER (WHERE start <= {NOW} AND stop > {NOW}) AS active,
  count(DISTINCT channel) FILTER (WHERE start > {NOW}) AS future FROM shows""")
def guide_totals(spark, d):
    return measure.guide_totals(shows(spark, d), NOW)


@query("""WITH m AS (SELECT coalesce(country, '??') AS country, CASE WHEN len(candidates) > 0 THEN 'covered' ELSE 'open' END AS class, CAST(len(candidates) AS BIGINT) AS n FROM mapping)
  SELECT country, class, CASE WHEN count(n) = count(*) THEN CAST(sum(n) AS DOUBLE) END AS n_candidates, count(*) AS n_rows, grouping(country) * 2 + grouping(class) AS level
  FROM m GROUP BY GROUPING SETS ((country), (class), (country, class), ())""")
def coverage_grouping_sets(spark, d):
    m = table(spark, d, "mapping").select(F.coalesce("country", F.lit("??")).alias("country"), "candidates")
    m = m.withColumn("class", F.when(F.size("candidates") > 0, "covered").otherwise("open"))
    size = F.when(F.col("candidates").isNotNull(), F.size("candidates")).cast("double")
    out = measure.grouped_totals(m.withColumn("n", size), [["country"], ["class"], ["country", "class"], []], {"n_candidates": F.col("n"), "n_rows": F.lit(1).cast("long")})
    # the keys are listed as class, country
    level = (F.col("level") % 2) * 2 + F.floor(F.col("level") / 2)
    return out.withColumn("level", level.cast("long"))


@query("""WITH a AS (SELECT DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id FROM streams WHERE snapshot_no = 6), b AS (SELECT DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS stream_id FROM streams WHERE snapshot_no = 5)
  SELECT stream_id, 'new' AS trend FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT stream_id, 'lost' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def trend_diff(spark, d):
    s = table(spark, d, "streams").select("snapshot_no", whole_number("stream_id").alias("stream_id"))
    return measure.trend(s.filter("snapshot_no = 6"), s.filter("snapshot_no = 5"), "stream_id")


@query("""WITH c AS (SELECT source, count(DISTINCT id) AS n FROM channel GROUP BY 1), p AS (SELECT source, count(*) AS n FROM programme GROUP BY 1)
  SELECT s.source, coalesce(c.n, 0) AS n_channels, coalesce(p.n, 0) AS n_programmes, CASE WHEN coalesce(p.n, 0) = 0 THEN 'empty' WHEN p.n < s.min_programmes THEN 'short' ELSE 'ok' END AS status
  FROM sources s LEFT JOIN c USING (source) LEFT JOIN p ON p.source = s.source""")
def source_health(spark, d):
    return measure.source_health(table(spark, d, "channel"), table(spark, d, "programme"), table(spark, d, "sources"))


@query("""WITH t AS (SELECT snapshot_no, count(DISTINCT CAST(CAST(trim(stream_id) AS DOUBLE) AS BIGINT)) AS streams, count(DISTINCT name) AS names FROM streams WHERE snapshot_no IN (5, 6) GROUP BY 1),
  n AS (SELECT * FROM t WHERE snapshot_no = 6), b AS (SELECT * FROM t WHERE snapshot_no = 5)
  SELECT 'streams' AS metric, n.streams AS value, b.streams AS value_before, n.streams >= 100 AND n.streams >= 0.95 * b.streams AS passed FROM n, b
  UNION ALL SELECT 'names', n.names, b.names, n.names >= 0.8 * b.names FROM n, b""")
def regression_gate(spark, d):
    s = table(spark, d, "streams").select("snapshot_no", whole_number("stream_id").alias("id"), "name")
    of = lambda n: s.filter(F.col("snapshot_no") == n).agg(F.count_distinct("id").alias("streams"), F.count_distinct("name").alias("names"))
    return measure.regression_gate(of(6), of(5), {"streams": 0.95, "names": 0.8}, {"streams": 100})


@query("""SELECT upper(trim(split_part(cat_name, '|', 1))) AS country, count(DISTINCT name) AS n_names, count(*) FILTER (WHERE trim(coalesce(epg_channel_id, '')) = '') AS n_open,
  count(*) FILTER (WHERE trim(coalesce(epg_channel_id, '')) <> '') AS n_covered FROM streams GROUP BY 1""")
def coverage_by_country(spark, d):
    open_ = F.trim(F.coalesce("epg_channel_id", F.lit(""))) == ""
    s = table(spark, d, "streams").withColumn("country", F.upper(F.trim(F.element_at(F.split("cat_name", r"\|", 2), 1))))
    return s.groupBy("country").agg(F.count_distinct("name").alias("n_names"), F.count(F.when(open_, 1)).alias("n_open"), F.count(F.when(~open_, 1)).alias("n_covered"))


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest, count(*) AS n_runs FROM orders GROUP BY 1")
def newest_run_guard(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("newest"), F.count("*").alias("n_runs"))


# --- text functions, sources and sinks ----------------------------------------------------------------
@query("SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL")
def manifest_digest(spark, d):
    return playlists.manifest(table(spark, d, "documents"), "doc_id", "text")


@query("""SELECT id, concat('#EXTINF:-1 tvg-id="', replace(id, '"', ''''), '" group-title="', source, '",', replace(regexp_replace(coalesce(display_name, ''), '[\\r\\n]+', ' ', 'g'), '"', ''''), chr(10), 'https://x.invalid/', file_ord) AS entry
  FROM channel""")
def m3u_lines(spark, d):
    c = table(spark, d, "channel").select("id", F.col("display_name").alias("name"), F.col("source").alias("group"), F.concat(F.lit("https://x.invalid/"), F.col("file_ord").cast("string")).alias("url"))
    return playlists.m3u_entries(c)


_ESC = lambda c: f"replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"
_STAMP = lambda c: f"strftime(make_timestamp({c} * 1000000), '%Y%m%d%H%M%S +0000')"


@query(f"""WITH {SHOWS} SELECT channel, start, concat('<programme start="', {_STAMP("start")}, '" stop="', {_STAMP("stop")}, '" channel="', {_ESC("channel")}, '">',
  CASE WHEN coalesce(title, '') <> '' THEN concat('<title>', {_ESC("title")}, '</title>') ELSE '' END, '</programme>') AS xml FROM shows""")
def xmltv_fragments(spark, d):
    return xmltv.programme_elements(shows(spark, d))


@query(f"""WITH {SHOWS} SELECT channel, {_STAMP("start")} AS start_at, {_STAMP("stop")} AS stop_at, title FROM shows""")
def xmltv_roundtrip(spark, d):
    path = scratch_path(spark, "guide")
    xmltv.write_guide(shows(spark, d), path, "gzip")
    return xmltv.read_programmes(spark, path).select("channel", "start_at", "stop_at", "title")


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k FROM events")
def json_props_explode(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


_UN = "title"
for _ in range(2):
    for _code, _ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&#39;", "''"), ("&#38;", "&"), ("&amp;", "&")):
        _UN = f"replace({_UN}, '{_code}', '{_ch}')"


@query(f"SELECT prog_id, {_UN} AS title FROM programme WHERE title IS NOT NULL")
def double_unescape(spark, d):
    return table(spark, d, "programme").filter("title is not null").select("prog_id", tx.unescape_twice(F.col("title")).alias("title"))


@query("""SELECT prog_id, lower(trim(regexp_replace(coalesce(title, ''), '[\\s\\x0b\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g'))) AS title FROM programme""")
def clean_titles(spark, d):
    return table(spark, d, "programme").select("prog_id", tx.clean_title("title").alias("title"))


_LATIN = "lower(display_name)"
for _a, _b in (tx.CYRILLIC | tx.GREEK).items():
    _LATIN = f"replace({_LATIN}, '{_a}', '{_b}')"


@query(f"SELECT DISTINCT display_name, {_LATIN} AS latin FROM channel")
def transliterated_names(spark, d):
    return table(spark, d, "channel").select("display_name").distinct().withColumn("latin", tx.transliterate("display_name"))


@query("SELECT o_orderkey, concat(y, '-', y + 1) AS season FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 7 THEN 1 ELSE 0 END AS y FROM orders)")
def season_string(spark, d):
    return table(spark, d, "orders").select("o_orderkey", tx.season("o_orderdate").alias("season"))


@query("SELECT p_partkey, trim(regexp_replace(lower(concat(p_brand, ' ', p_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM part")
def slugs(spark, d):
    return table(spark, d, "part").select("p_partkey", tx.slug(F.concat_ws(" ", "p_brand", "p_name")).alias("slug"))


@query("SELECT epg_channel_id, nullif(upper(regexp_extract(epg_channel_id, '\\.([A-Za-z]{2})$', 1)), '') AS tld, count(*) AS n_rows FROM streams GROUP BY 1, 2")
def top_domains(spark, d):
    s = table(spark, d, "streams")
    return s.groupBy("epg_channel_id", tx.top_domain("epg_channel_id").alias("tld")).agg(F.count("*").alias("n_rows"))


@query("""WITH h AS (SELECT display_name, upper(trim(split_part(display_name, '-', 1))) AS h FROM channel) SELECT DISTINCT display_name, CASE WHEN regexp_matches(h, '^[KW][A-Z0-9]{2,4}$') THEN h END AS call_sign FROM h""")
def call_signs(spark, d):
    return table(spark, d, "channel").select("display_name", tx.call_sign("display_name").alias("call_sign")).distinct()


@query()
def title_conflicts(spark, d):
    """Pairs of materially different titles that share a channel and an instant of start."""
    rows = spread(table(spark, d, "programme").select("source", "channel", "start_at", "title"))
    p = normalise_instants(rows, table(spark, d, "sources"), {"start_at": "start"})
    return cascade.title_conflict_pairs(p, ["channel", "start"])


# --- streams --------------------------------------------------------------------------------------------
@query("SELECT epoch_us(date_trunc('hour', ts)) // 1000000 AS window_start, event_type, count(*) AS n_rows FROM events GROUP BY 1, 2")
def stream_window_counts(spark, d):
    stream = monitor.read_rows(spark, f"{d}/events.parquet", "ts")
    out = monitor.run_once(monitor.window_counts(stream, "ts", "event_type"), "windows", "complete")
    return out.select(F.unix_seconds("window_start").alias("window_start"), "event_type", "n_rows")


@query(f"SELECT event_id, event_type FROM events WHERE ts >= DATE '{DAY}'")
def stream_currency(spark, d):
    stream = monitor.currency_gate(monitor.read_rows(spark, f"{d}/events.parquet", "ts"), "ts", DAY)
    return monitor.run_once(stream.select("event_id", "event_type"), "current")


def queries():
    return dict(Q)


def oracle_sql():
    return dict(SQL)
