"""Candidates of streams in sources: index, exact and fuzzy joins, gates, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.text import country_code, dice


def name_index(channels: DataFrame, name: Column) -> DataFrame:
    """source, norm_name, ids (sorted, distinct): a name may stand for several ids."""
    rows = channels.select("source", name.alias("norm_name"), "id").filter("norm_name <> ''").distinct()
    return rows.groupBy("source", "norm_name").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def exact_match(streams: DataFrame, channels: DataFrame) -> DataFrame:
    """Streams with the one id of their name per source; of several ids the one whose raw name is the stream's, else NULL.

    streams: stream_id, norm_name and, to resolve ambiguous names, raw_name.
    channels: source, id, norm_name and raw_name.  Raw names are compared without
    case and outer blanks.  n_ids tells how many ids the name has; a source with
    several is out of question for fuzzy matches, resolved or not.
    """
    c = channels.filter("norm_name <> ''")
    per = c.groupBy("source", "norm_name").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("id").alias("n_ids"))
    one = F.when(F.col("lo") == F.col("hi"), F.col("lo"))
    s = streams.filter("norm_name <> ''")
    if "raw_name" not in streams.columns or "raw_name" not in channels.columns:
        return s.select("stream_id", "norm_name").distinct().join(per, "norm_name").select("stream_id", "source", one.alias("source_id"), "n_ids")
    raw = F.lower(F.trim("raw_name")).alias("raw")
    own = c.select("source", "norm_name", "id", raw).groupBy("source", "norm_name", "raw").agg(F.min("id").alias("rlo"), F.max("id").alias("rhi"))
    own = own.filter("rlo = rhi").drop("rhi")
    hit = s.select("stream_id", "norm_name", raw).distinct().join(per, "norm_name").join(own, ["source", "norm_name", "raw"], "left")
    best = F.when(F.col("n_ids") == 1, F.col("lo")).otherwise(F.col("rlo"))
    return hit.groupBy("stream_id", "source").agg(F.min(best).alias("x"), F.max(best).alias("y"), F.max("n_ids").alias("n_ids")).select(
        "stream_id", "source", F.when(F.col("x") == F.col("y"), F.col("x")).alias("source_id"), "n_ids"
    )


def fuzzy_match(left: DataFrame, right: DataFrame, least: float = 0.85, top: int | None = 2) -> DataFrame:
    """Names that share two tokens or more with a Dice score of at least ``least``, per name and source the best ``top`` by score, then name.

    left: lname.  right: source, rname and, where names of several ids are to be
    left out, id.  Names are normalised.  A score of ``least`` needs that the
    rarest tokens of the two names meet (prefix filter), so a frequent token joins
    nothing unless a name has no rarer one; the filter loses no pair.  A name with
    ``plus`` is another service than one without, and ``plus 1`` alone is no
    likeness.  Names of one distinct token match none; equal names are left out.
    """
    a = left.select("lname").filter("lname <> ''").distinct().withColumn("t", F.array_distinct(F.split("lname", " ")))
    r = right.filter("rname <> ''")
    if "id" in right.columns:
        r = r.groupBy("source", "rname").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo = hi")
    b = r.select("source", "rname").distinct().withColumn("t", F.array_distinct(F.split("rname", " ")))
    names = b.select("rname", "t").distinct()
    often = a.select(F.explode("t").alias("w")).union(names.select(F.explode("t").alias("w"))).groupBy("w").agg(F.count("*").alias("often"))

    def prefixes(df: DataFrame, name: str) -> DataFrame:
        """The tokens of a name by rarity, and one row for each that a partner must share."""
        rows = df.select(name, F.explode("t").alias("w")).join(often, "w").groupBy(name).agg(F.sort_array(F.collect_list(F.struct("often", "w"))).alias("o"))
        rows = rows.select(name, F.transform("o", lambda x: x["w"]).alias("t")).withColumn("n", F.size("t"))
        # with n tokens, a partner has n * least / (2 - least) of them at least, and two in any case
        need = F.greatest(F.lit(2), F.ceil(F.col("n") * (least / (2 - least)) - 1e-9)).cast("int")
        return rows.filter("n > 1").select(name, "t", "n", F.explode(F.slice("t", F.lit(1), F.col("n") - need + 1)).alias("w"))

    x = prefixes(a, "lname").withColumnsRenamed({"t": "t1", "n": "n1"})
    y = prefixes(names, "rname").withColumnsRenamed({"t": "t2", "n": "n2"})
    sizes = (F.col("n1") * least <= F.col("n2") * (2 - least) + 1e-9) & (F.col("n2") * least <= F.col("n1") * (2 - least) + 1e-9)
    both = x.join(y, "w").filter(sizes & (F.col("lname") != F.col("rname"))).dropDuplicates(["lname", "rname"])
    both = both.withColumn("c", F.size(F.array_intersect("t1", "t2")))
    plus1, plus2 = F.array_contains("t1", "plus"), F.array_contains("t2", "plus")
    bare = lambda t: F.array_except(t, F.array(F.lit("plus"), F.lit("1")))
    same = (F.size(F.array_except(bare("t1"), bare("t2"))) == 0) & (F.size(F.array_except(bare("t2"), bare("t1"))) == 0)
    guard = (plus1 == plus2) & (~plus1 | same | (F.size(F.array_intersect(bare("t1"), bare("t2"))) >= 2))
    scored = both.filter((F.col("c") >= 2) & guard).withColumn("score", F.round(dice(F.col("c"), F.col("n1"), F.col("n2")), 6)).filter(F.col("score") >= least)
    out = scored.select("lname", "rname", "score").join(b.select("source", "rname"), "rname")
    rank = F.row_number().over(Window.partitionBy("lname", "source").orderBy(F.desc("score"), "rname"))
    out = out.withColumn("rank", rank).select("lname", "source", "rname", "score", "rank")
    return out if top is None else out.filter(F.col("rank") <= top)


def reduce_lineup(channels: DataFrame, lineup: DataFrame, least: float = 0.8) -> DataFrame:
    """Channels (source, id, norm_name) whose name is one of the lineup (norm_name) or close to one."""
    wanted = lineup.select("norm_name").filter("norm_name <> ''").distinct()
    near = fuzzy_match(wanted.select(F.col("norm_name").alias("lname")), channels.select("source", F.col("norm_name").alias("rname")), least, None)
    names = wanted.union(near.select("rname")).distinct()
    return channels.select("source", "id", "norm_name").distinct().join(names, "norm_name", "left_semi")


def self_report(names: DataFrame, channels: DataFrame, sources: DataFrame, most: int = 5) -> DataFrame:
    """For each name the first ``most`` sources that have it: exactly, or else closely; columns norm_name, source, match_method, id, hit.

    names: norm_name.  channels: source, id, norm_name.  sources: source, ord.  The
    smallest id stands for a name of several.
    """
    wanted = names.select("norm_name").filter("norm_name <> ''").distinct()
    ids = channels.filter("norm_name <> ''").groupBy("source", "norm_name").agg(F.min("id").alias("id"))
    exact = wanted.join(ids, "norm_name").select("norm_name", "source", F.lit("exact").alias("match_method"), "id")
    near = fuzzy_match(wanted.select(F.col("norm_name").alias("lname")), channels.select("source", F.col("norm_name").alias("rname"), "id"), top=1)
    near = near.select(F.col("lname").alias("norm_name"), "source", F.col("rname")).join(exact.select("norm_name", "source"), ["norm_name", "source"], "left_anti")
    near = near.join(ids.withColumnRenamed("norm_name", "rname"), ["source", "rname"]).select("norm_name", "source", F.lit("fuzzy").alias("match_method"), "id")
    w = Window.partitionBy("norm_name").orderBy("ord", "source")
    hits = exact.unionByName(near).join(sources.select("source", "ord"), "source").withColumn("hit", F.row_number().over(w))
    return hits.filter(F.col("hit") <= most).select("norm_name", "source", "match_method", "id", "hit")


def substring_match(names: DataFrame, services: DataFrame) -> DataFrame:
    """Each name with the first service (by ord) that equals it, holds it or is held by it: columns name, service.

    names: name; services: service, ord.  One text can only hold another if it has
    its first three characters (or all of a shorter one) somewhere, so the two are
    joined on such pieces, not all with all.  Empty texts match nothing.
    """
    grams = lambda c: F.array_distinct(F.flatten(F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - n + 1)), lambda i: F.substring(c, i, n)))))
    a = names.select("name").filter("name <> ''").distinct()
    s = services.select("service", "ord").filter("service <> ''").distinct()
    inside = a.withColumn("g", F.substring("name", 1, 3)).join(s.withColumn("g", F.explode(grams(F.col("service")))), "g").filter(F.contains("service", "name"))
    around = a.withColumn("g", F.explode(grams(F.col("name")))).join(s.withColumn("g", F.substring("service", 1, 3)), "g").filter(F.contains("name", "service"))
    return inside.drop("g").unionByName(around.drop("g")).groupBy("name").agg(F.min_by("service", F.struct("ord", "service")).alias("service"))


def exploded(mapping: DataFrame) -> DataFrame:
    """One row per candidate with its position from 1."""
    return mapping.select("map_id", "country", F.posexplode("candidates").alias("i", "c")).select(
        "map_id", "country", (F.col("i") + 1).alias("pos"), "c.source", "c.source_id", "c.match_method", "c.confidence"
    )


def rank_candidates(candidates: DataFrame, trust: DataFrame) -> DataFrame:
    """First of repeated (source, id), then ranked by trust, confidence and position."""
    one = candidates.filter("source is not null and source_id is not null").groupBy("map_id", "source", "source_id").agg(
        F.min_by(F.struct("confidence", "pos"), "pos").alias("x")
    )
    order = [F.asc_nulls_last("trust"), F.desc_nulls_last("confidence"), F.asc("pos")]
    flat = one.select("map_id", "source", "source_id", "x.confidence", "x.pos").join(trust.select("source", "trust"), "source", "left")
    rank = F.row_number().over(Window.partitionBy("map_id").orderBy(*order))
    return flat.select("map_id", "source", "source_id", "confidence", rank.cast("long").alias("rank"))


def policy_gate(candidates: DataFrame, sources: DataFrame) -> DataFrame:
    """Candidates whose source serves the country of the stream; an unknown country (NULL or blank) passes."""
    s = sources.select("source", "countries")
    return candidates.join(s, "source").filter("country is null or trim(country) = '' or array_contains(countries, country)").drop("countries")


def deny(candidates: DataFrame, denied: DataFrame) -> DataFrame:
    """Anti-join on source and id."""
    return candidates.join(denied.select("source", "source_id").distinct(), ["source", "source_id"], "left_anti")


# Provider ids that stand for no channel, by ending or content.
JUNK_ENDINGS = (".epg", ".L", ".UFC", ".BRLIVE", ".ESPN", ".MLB", ".NFL", ".NBA", ".NHL", ".PPV", ".EVENT")
JUNK_PARTS = ("servicestatus", "event3hour")


def real_id(c: Column | str) -> Column:
    """Whether a provider id is one: not empty and no junk, whatever its letter case."""
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    bad = t == ""
    for e in JUNK_ENDINGS:
        bad = bad | F.endswith(t, F.lit(e.lower()))
    for p in JUNK_PARTS:
        bad = bad | F.contains(t, F.lit(p))
    return ~bad


def collision_split(streams: DataFrame) -> DataFrame:
    """Canonical id: the provider's id, as it is written, if it is real and no other stream has it, else ``xtream:<stream>``.

    streams: stream_id, epg_channel_id.  Ids that differ in letter case are two ids.
    """
    epg = F.trim("epg_channel_id")
    real = streams.select("stream_id", F.when(real_id("epg_channel_id"), epg).alias("epg")).distinct()
    count = real.filter("epg is not null").groupBy("epg").agg(F.count("*").alias("n"))
    out = real.join(count, "epg", "left")
    own = F.when(F.col("n") == 1, F.col("epg")).otherwise(F.concat(F.lit("xtream:"), F.col("stream_id").cast("string")))
    return out.select("stream_id", own.alias("canonical_id"))


def identity_join(streams: DataFrame, overrides: DataFrame) -> DataFrame:
    """Stable ids: the override of a stream or ``xtream:<stream>``, and whether that id is the only one of its kind.

    overrides: stream_id, canonical_id; of several for one stream the smallest holds.
    """
    one = overrides.groupBy("stream_id").agg(F.min("canonical_id").alias("canonical_id"))
    out = streams.select("stream_id").distinct().join(one, "stream_id", "left")
    out = out.select("stream_id", F.coalesce("canonical_id", F.concat(F.lit("xtream:"), F.col("stream_id").cast("string"))).alias("canonical_id"))
    count = out.groupBy("canonical_id").agg(F.count("*").alias("n"))
    return out.join(count, "canonical_id").select("stream_id", "canonical_id", (F.col("n") == 1).alias("is_unique"))


def provider_match(streams: DataFrame, names: DataFrame) -> DataFrame:
    """The provider's own schedule of a stream: by its id if that is its identity, by name only if it has no real id.

    streams: stream_id, epg_channel_id, canonical_id, norm_name, country.  names:
    id, norm_name of the provider's channels.  A changed or shared id blocks the
    name; a name needs one id whose ending agrees with the country, where both are known.
    """
    id_ = F.trim("epg_channel_id")
    s = streams.withColumn("__real", real_id("epg_channel_id"))
    own = s.filter(F.col("__real") & (id_ == F.col("canonical_id"))).select("stream_id", id_.alias("source_id"), F.lit("epg-id").alias("match_method"), F.lit(1.0).alias("confidence"))
    one = names.filter("norm_name <> '' and trim(id) <> ''").groupBy("norm_name").agg(F.min("id").alias("source_id"), F.max("id").alias("hi")).filter("source_id = hi")
    ending = F.when(F.contains("source_id", F.lit(".")), F.upper(F.element_at(F.split("source_id", r"\."), -1)))
    gate = ending.isNull() | F.col("country").isNull() | (ending == country_code("country"))
    named = s.filter(~F.col("__real")).join(one, "norm_name").filter(gate)
    return own.union(named.select("stream_id", "source_id", F.lit("name"), F.lit(0.9))).distinct()


def alias_match(streams: DataFrame, aliases: DataFrame, channels: DataFrame) -> DataFrame:
    """Streams whose name an alias table renames: the unique id of the alias per source.

    aliases: norm_name, alias (both normalised).
    """
    renamed = streams.join(aliases.dropDuplicates(["norm_name"]), "norm_name").select("stream_id", F.col("alias").alias("norm_name"))
    return exact_match(renamed, channels).filter("source_id is not null")


def override_match(streams: DataFrame, overrides: DataFrame) -> DataFrame:
    """Fixed choices: overrides has stream_id, source, source_id."""
    return streams.select("stream_id").distinct().join(overrides, "stream_id").select("stream_id", "source", "source_id")


def call_sign_match(streams: DataFrame, channels: DataFrame) -> DataFrame:
    """Equality of call signs: columns stream_id, source, source_id.

    streams: stream_id, call_sign, sub_feed (NULL if none is named).  channels:
    source, id, call_sign.  A named sub-feed takes the one id of that sub-feed; a
    bare sign takes the one id of the sign, unless any of its ids is a sub-feed's.
    """
    feed = F.nullif(F.lower(F.regexp_extract("id", r"(?i)^([kw][a-z]{2,3}-dt[0-9]+)(?:\.|$)", 1)), F.lit(""))
    c = channels.filter("call_sign is not null").select("call_sign", F.struct("source", "id").alias("x"), feed.alias("feed"), F.col("id").rlike(r"(?i)-dt[0-9]+(?:\.|$)").alias("part"))
    unique = lambda *keys: c.groupBy(*keys).agg(F.min("x").alias("x"), F.max("x").alias("y"), F.max("part").alias("part"))
    bare = unique("call_sign").filter("x = y and not part")
    sub = unique("call_sign", "feed").filter("feed is not null and x = y").withColumnRenamed("feed", "sub_feed")
    s = streams.filter("call_sign is not null").select("stream_id", "call_sign", "sub_feed").distinct()
    out = s.filter("sub_feed is null").join(bare, "call_sign").select("stream_id", "x.*")
    return out.union(s.join(sub, ["call_sign", "sub_feed"]).select("stream_id", "x.*")).withColumnRenamed("id", "source_id")


def combine(phases: dict[str, DataFrame], trust: DataFrame) -> DataFrame:
    """All phases (stream_id, source, source_id, confidence), in order of precedence, as ranked candidates.

    A repeated (source, source_id) of a stream keeps its first phase; the rank is
    by trust of the source, then confidence, then id.
    """
    rows = None
    for i, (method, df) in enumerate(phases.items()):
        one = df.select("stream_id", "source", "source_id", F.col("confidence").cast("double").alias("confidence"), F.lit(i).alias("phase"), F.lit(method).alias("match_method"))
        rows = one if rows is None else rows.unionByName(one)
    best = rows.groupBy("stream_id", "source", "source_id").agg(F.min_by(F.struct("confidence", "match_method"), F.struct("phase", -F.col("confidence"))).alias("x"))
    flat = best.select("stream_id", "source", "source_id", "x.*").join(trust.select("source", "trust"), "source", "left")
    order = Window.partitionBy("stream_id").orderBy(F.asc_nulls_last("trust"), F.desc("confidence"), "source", "source_id")
    return flat.withColumn("rank", F.row_number().over(order)).drop("trust")


def prefixed(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Rows whose id begins with the prefix of their source and country; where none is set for both, all pass.

    rows: source, country, source_id.  prefixes: source, country, prefix (one per pair).
    """
    p = prefixes.groupBy("source", "country").agg(F.min("prefix").alias("__prefix"))
    return rows.join(p, ["source", "country"], "left").filter("__prefix is null or startswith(source_id, __prefix)").drop("__prefix")


def missing_references(rows: DataFrame, columns: list[str], declared: DataFrame) -> DataFrame:
    """Referential check: rows whose columns name nothing in ``declared``; none is a pass."""
    return rows.join(declared.select(*columns).distinct(), columns, "left_anti")
