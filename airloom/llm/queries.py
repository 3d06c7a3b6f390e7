"""Queries of the problems on texts and entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm.confusables import forms, look_alike_pairs
from airloom.llm.leakage import leaks
from airloom.llm.linkage import Parser, known_words, link, parsed
from airloom.llm.mojibake import garbled
from airloom.llm.packing import FILES, fill_report, packed_documents, packing_faults
from airloom.llm.sentences import sentences
from airloom.llm.survivor import STAND_INS, present, survivors
from airloom.plans.problems import whole_number
from airloom.session import cut, spread, table, tune


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_restored(spark, sf_dir).select("prog_id", "field_name")


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged fields with the text as it was, where nothing was lost."""
    tune(spark)
    rows = spread(table(spark, sf_dir, "programme").select("prog_id", "title", "descr"))
    return garbled(rows, "prog_id", ["title", "descr"])


def _p3_links(spark: SparkSession, sf_dir: str, idle: bool) -> tuple[DataFrame, DataFrame]:
    """(streams with their station, links of stations and channels with confidence)."""
    s = table(spark, sf_dir, "streams").filter("snapshot_no = 6").select(whole_number("stream_id").alias("stream_id"), "name", "cat_name")
    c = table(spark, sf_dir, "channel").select("source", F.col("id").alias("record"), "display_name").distinct()
    sources = table(spark, sf_dir, "sources").select("source", "countries")
    # two-letter codes, so at most 676
    code = F.upper(F.regexp_extract("cat_name", r"^\s*([A-Za-z]{2})\s*\|", 1))
    listed = sources.select(F.explode("countries").alias("c")).union(s.select(code)).distinct()
    codes = {r[0] for r in listed.filter("c rlike '^[A-Z]{2}$'").collect()}
    subjects, marks = known_words(s, "name", codes)
    parser = Parser(subjects, codes, marks)
    s = parsed(s.distinct(), "name", parser).withColumn("country", F.coalesce("name_country", F.when(code != "", code)))
    form = ["brand", "subject", "number", "country"]
    station = F.concat_ws("\x01", *[F.coalesce(x, F.lit("?")) for x in form])
    s = cut(s.withColumn("station", station).select("stream_id", "station", *form), "streams")
    r = cut(parsed(c, "display_name", parser), "parsed").join(sources, "source", "left")
    # a country written in any name of a channel holds for all of them
    own = r.groupBy("source", "record").agg(F.max("name_country").alias("country"))
    r = r.join(own, ["source", "record"]).select("source", "record", *form, "countries", "subject_score")
    r = cut(r, "records")
    # a station that only channels show, of a known country and a brand of the streams, competes for the others
    only = F.when(F.size("countries") == 1, F.element_at("countries", 1))
    shown = r.select("brand", "subject", "number", F.coalesce("country", only).alias("country")).filter("country is not null and subject <> ''")
    shown = shown.distinct().join(s.select("brand").distinct(), "brand", "left_semi")
    stations = s.select(*form).union(shown.select(*form)).distinct().withColumn("station", station)
    return s, link(stations, r, idle=idle)


def _p3_pairs(spark: SparkSession, sf_dir: str, idle: bool) -> DataFrame:
    tune(spark)
    s, links = _p3_links(spark, sf_dir, idle)
    out = s.select("stream_id", "station").distinct().join(links, "station").filter("stream_id is not null")
    return out.groupBy("stream_id", "source", F.col("record").alias("channel_id")).agg(F.max("confidence").alias("confidence"))


def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All candidate pairs with their confidence."""
    return _p3_pairs(spark, sf_dir, True)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3_pairs(spark, sf_dir, False).filter("confidence >= 0.49").select("stream_id", "source", "channel_id")


def _survivors(spark: SparkSession, sf_dir: str, at) -> DataFrame:
    tune(spark)
    m = table(spark, sf_dir, "mapping").withColumn("built_at", at)
    number = whole_number("stream_id")
    links = [F.coalesce(number.cast("string"), present("stream_id")), present("canonical_id")]
    return survivors(
        m, table(spark, sf_dir, "sources"), row_id="map_id", links=links, fields=["canonical_id", "country"],
        candidates="candidates", at="built_at",
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir, F.col("built_at"))


def p6_untimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors where five of sixteen rows (by a digest of their id) have lost their timestamp: there the learned order decides."""
    return _survivors(spark, sf_dir, F.when(F.md5(F.col("map_id").cast("string").cast("binary")) >= "5", F.col("built_at")))


_STAND_INS = ", ".join(f"'{x}'" for x in STAND_INS)
_PRESENT = lambda c: f"(CASE WHEN lower(regexp_replace({c}, '[\\s\\x{{a0}}\\x{{200b}}]+', '', 'g')) NOT IN ({_STAND_INS}) THEN lower(regexp_replace({c}, '[\\s\\x{{a0}}\\x{{200b}}]+', '', 'g')) END)"


def _latest_sql(field: str) -> str:
    """CTEs that end in latest_<field>: group_id, map_id."""
    f = field
    return f"""
  h_{f} AS (SELECT g, map_id, built, {f} AS v FROM member WHERE {f} IS NOT NULL),
  z_{f} AS (SELECT g, v, max(built) AS z FROM h_{f} WHERE built IS NOT NULL GROUP BY 1, 2),
  t_{f} AS (SELECT v AS a, lead(v) OVER (PARTITION BY g ORDER BY z, v) AS b FROM z_{f}),
  n_{f} AS (SELECT a, b, count(*) AS n FROM t_{f} WHERE b IS NOT NULL GROUP BY 1, 2),
  r_{f} AS (SELECT a, b FROM n_{f} x WHERE n > coalesce((SELECT n FROM n_{f} y WHERE y.a = x.b AND y.b = x.a), 0)),
  p_{f} AS (SELECT a, b FROM r_{f} UNION SELECT p.a, r.b FROM p_{f} p JOIN r_{f} r ON p.b = r.a),
  o_{f} AS (SELECT a, b FROM p_{f} x WHERE a <> b AND NOT EXISTS (SELECT 1 FROM p_{f} y WHERE y.a = x.b AND y.b = x.a)),
  top_{f} AS (SELECT g, arg_max(map_id, (built, map_id)) AS map_id, arg_max(v, (built, map_id)) AS v FROM h_{f} WHERE built IS NOT NULL GROUP BY 1),
  u_{f} AS (SELECT h.g, h.v, max(h.map_id) AS u FROM h_{f} h LEFT JOIN top_{f} t ON t.g = h.g WHERE h.built IS NULL AND (t.v IS NULL OR EXISTS (SELECT 1 FROM o_{f} o WHERE o.a = t.v AND o.b = h.v)) GROUP BY 1, 2),
  l_{f} AS (SELECT g, max(u) AS u FROM u_{f} x WHERE NOT EXISTS (SELECT 1 FROM u_{f} y JOIN o_{f} o ON o.a = x.v AND o.b = y.v WHERE y.g = x.g) GROUP BY 1),
  latest_{f} AS (SELECT g AS group_id, coalesce(l.u, t.map_id) AS map_id FROM top_{f} t FULL JOIN l_{f} l USING (g))"""


def _survivor_sql(at: str) -> str:
    return f"""WITH RECURSIVE m AS (SELECT map_id, {at} AS built, candidates, {_PRESENT("country")} AS country, {_PRESENT("canonical_id")} AS canonical_id,
    coalesce(CAST(TRY_CAST(TRY_CAST(trim(stream_id) AS DOUBLE) AS BIGINT) AS VARCHAR), {_PRESENT("stream_id")}) AS sid FROM mapping),
  k AS (SELECT map_id, concat('s', sid) AS k FROM m WHERE sid IS NOT NULL UNION ALL SELECT map_id, concat('c', canonical_id) FROM m WHERE canonical_id IS NOT NULL),
  e AS (SELECT DISTINCT x.map_id AS a, y.map_id AS b FROM k x JOIN k y USING (k)),
  reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
  grp AS (SELECT a AS map_id, min(b) AS g FROM reach GROUP BY 1 HAVING count(*) > 1),
  member AS (SELECT g, m.* FROM m JOIN grp USING (map_id)), {_latest_sql("canonical_id")}, {_latest_sql("country")},
  c AS (SELECT g, map_id, built, c.source AS source, c.source_id AS source_id, coalesce(c.confidence, '-inf'::DOUBLE) AS confidence FROM (SELECT g, map_id, built, unnest(candidates) AS c FROM member) WHERE {_PRESENT("c.source_id")} IS NOT NULL),
  w AS (SELECT g, map_id, built, count(DISTINCT (source, source_id)) AS n FROM c GROUP BY 1, 2, 3),
  widest AS (SELECT g, map_id FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, built DESC NULLS LAST, map_id DESC) AS x FROM w) WHERE x = 1),
  best AS (SELECT g, map_id FROM (SELECT c.*, row_number() OVER (PARTITION BY g ORDER BY coalesce(trust, 1099511627776), confidence DESC, built DESC NULLS LAST, map_id DESC) AS x FROM c LEFT JOIN sources USING (source)) WHERE x = 1)
  SELECT group_id, 'canonical_id' AS field_name, map_id FROM latest_canonical_id UNION ALL SELECT group_id, 'country', map_id FROM latest_country
  UNION ALL SELECT g, 'candidates', map_id FROM widest UNION ALL SELECT g, 'source_id', map_id FROM best"""


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    s = table(spark, sf_dir, "streams").filter("snapshot_no = 6").select(whole_number("stream_id").alias("stream_id"), "name")
    c = table(spark, sf_dir, "channel").select(F.col("id").alias("channel_id"), "display_name")
    pairs = look_alike_pairs(s, c, "name", "display_name")
    return pairs.filter("stream_id is not null and channel_id is not null").select("stream_id", "channel_id").distinct()


def p7_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name of either table with its consistent form."""
    tune(spark)
    names = table(spark, sf_dir, "streams").select("name").union(table(spark, sf_dir, "channel").select("display_name"))
    return forms(names, "name")


# cl100k_base itself is not among the vocabulary files at hand; the byte-level one for many languages stands in for it
VOCABULARIES = {**FILES, "cl100k_base": "byte_bpe_multi_50k.tiktoken"}


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed_documents(docs, table(spark, sf_dir, "pack_specs"), doc_id="doc_id", text="text", files=VOCABULARIES)


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Used space per container size."""
    return fill_report(p8_packed(spark, sf_dir), table(spark, sf_dir, "pack_specs"))


def p8_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of the packing, which all are 0."""
    tune(spark)
    return packing_faults(p8_packed(spark, sf_dir), table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_specs"), "doc_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_passages(spark, sf_dir).select("doc_id", "item_id").distinct()


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaked sentence with how much of it a document holds."""
    tune(spark)
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    items = table(spark, sf_dir, "eval_items").select("item_id", F.col("text").alias("item_text"), F.col("lang").alias("item_lang"))
    return leaks(docs, items, doc_id="doc_id", text="text", item_id="item_id", item_text="item_text", item_lang="item_lang")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return sentences(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")), "doc_id", "text", "lang")


def queries():
    return {
        "p1_found": p1_found, "p1_restored": p1_restored, "p3_found": p3_found, "p3_confidence": p3_confidence,
        "p6_found": p6_found, "p6_untimed": p6_untimed, "p7_found": p7_found, "p7_forms": p7_forms,
        "p8_packed": p8_packed, "p8_fill": p8_fill, "p8_checks": p8_checks, "p9_found": p9_found, "p9_passages": p9_passages, "p10_found": p10_found,
    }


def oracle_sql():
    return {
        "p8_checks": "SELECT spec_id, (SELECT count(*) FROM documents) AS n_docs, CAST(0 AS BIGINT) AS n_lost, CAST(0 AS BIGINT) AS n_overfull, CAST(0 AS BIGINT) AS n_broken, CAST(0 AS BIGINT) AS n_split FROM pack_specs",
        "p6_found": _survivor_sql("built_at"), "p6_untimed": _survivor_sql("CASE WHEN md5(CAST(map_id AS VARCHAR)) >= '5' THEN built_at END"),
    }
