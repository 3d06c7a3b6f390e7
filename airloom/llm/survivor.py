"""Best representative of each duplicate group, field by field.

Groups are the connected components of rows that share a link value.  Recency
decides by timestamp; where timestamps are missing, a learned currency order of
values does: from timestamped rows the operator counts transitions (a value last
seen before the next one of its group), keeps for each two values the direction
that prevails, and closes these precedences transitively (values on a cycle
precede each other and so don't count).  Each group then has a partial order of
its own: the precedences among its values, and its own times.  A value without
timestamp survives only if it lies topologically after the latest timestamped
value; of several such values one that no other follows is taken.  Values
without a precedence between them are never ranked against each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.components import components
from airloom.operators.sequence import WEEK, neighbour
from airloom.session import cut

# Stand-ins for an unknown value, in lower case without blanks.
STAND_INS = ("", "none", "null", "nil", "nan", "n/a", "n.a.", "unknown", "undefined", "missing", "-", "--", "?", "??", "???", "tba", "tbd")


def present(c: Column | str) -> Column:
    """The value in lower case without blanks; NULL where it is none."""
    c = F.col(c) if isinstance(c, str) else c
    v = F.lower(F.regexp_replace(c, r"[\s ​]+", ""))
    return F.when(~v.isin(*STAND_INS), v)


def duplicate_groups(rows: DataFrame, row_id: str, links: Sequence[Column]) -> DataFrame:
    """Columns row_id, group_id (smallest row id) for rows in groups of two or more.

    links: normalised link values of a row, NULL links nothing.  The graph has
    one node per link value (never a pair of rows), so a value shared by a third
    of all rows costs one edge per distinct partner value.
    """
    base = rows.select(F.col(row_id).alias("r"), *[c.alias(f"k{i}") for i, c in enumerate(links)])
    n = len(links)
    long = base.select("r", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("v")) for i in range(n)])).alias("x")).select("r", "x.*")
    long = long.filter("v is not null")
    # a link value is known by its smallest row and its position
    ids = long.groupBy("i", "v").agg(F.min("r").alias("low"), F.count("*").alias("n")).withColumn("node", F.col("low") * n + F.col("i"))
    ids = cut(ids, "links")
    keyed = base
    for i in range(n):
        own = ids.filter(F.col("i") == i).select(F.col("v").alias(f"k{i}"), F.col("node").alias(f"n{i}"))
        keyed = keyed.join(own, f"k{i}", "left")
    keyed = cut(keyed.select("r", *[f"n{i}" for i in range(n)]), "linked")
    first = F.coalesce(*[F.col(f"n{i}") for i in range(n)])
    edges = None
    for i in range(1, n):
        e = keyed.filter(F.col(f"n{i}").isNotNull()).select(first.alias("a"), F.col(f"n{i}").alias("b"))
        edges = e if edges is None else edges.union(e)
    home = keyed.filter(first.isNotNull()).select("r", first.alias("node"))
    if edges is not None:
        home = home.join(components(edges), "node", "left").select("r", F.coalesce("root", "node").alias("root"))
    else:
        home = home.withColumnRenamed("node", "root")
    home = cut(home, "homes")
    size = home.groupBy("root").agg(F.min("r").alias("group_id"), F.count("*").alias("n")).filter("n > 1")
    return home.join(size, "root").select(F.col("r").alias(row_id), "group_id")


def precedence(rows: DataFrame, group: str, value: str, at: str) -> DataFrame:
    """Learned direct precedences: columns a, b (a comes before b).

    A value is known by its last time in a group; the next value of the group is
    one transition.  Of two values the direction with more transitions prevails, a
    tie says nothing.  Groups of any size are walked in buckets of time.
    """
    seen = rows.filter(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(group, F.col(value).alias("a")).agg(F.max(at).alias("z"))
    # whole seconds make the buckets, the value itself settles ties
    seen = seen.withColumn("s", F.unix_seconds(F.col("z").cast("timestamp")) if _is_time(rows, at) else F.col("z").cast("long"))
    moves = neighbour(seen, [group], "s", ["z", "a"], F.col("a"), "b", bucket=4 * WEEK).filter("b is not null").groupBy("a", "b").agg(F.count("*").alias("n"))
    up = F.col("a") < F.col("b")
    both = moves.groupBy(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).agg(F.sum(F.when(up, F.col("n")).otherwise(-F.col("n"))).alias("n"))
    ahead = F.col("n") > 0
    return both.filter("n <> 0").select(F.when(ahead, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(ahead, F.col("y")).otherwise(F.col("x")).alias("b"))


def _is_time(rows: DataFrame, at: str) -> bool:
    return rows.schema[at].dataType.typeName().startswith(("timestamp", "date"))


def closure(rules: DataFrame, max_rounds: int = 60) -> DataFrame:
    """All pairs (a, b) with a path from a to b and none back.

    Paths double in length each round, so a chain of n values takes log2(n)
    rounds; raises if ``max_rounds`` don't suffice, which no table can reach.
    """
    paths = cut(rules.select("a", "b").distinct(), "paths")
    n = paths.count()
    for _ in range(max_rounds):
        longer = paths.join(paths.select(F.col("a").alias("b"), F.col("b").alias("c")), "b").select("a", F.col("c").alias("b"))
        paths = cut(paths.union(longer).distinct(), "paths")
        if (now := paths.count()) == n:
            break
        n = now
    else:
        raise RuntimeError("closure: no fixed point")
    back = paths.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return paths.filter("a <> b").join(back, ["a", "b"], "left_anti")


def latest_with_value(rows: DataFrame, group: str, value: str, at: str, row_id: str) -> DataFrame:
    """Per group the row whose value is the most current: columns group, row_id.

    Of timed rows the latest (then the greatest id).  A value that only rows
    without time hold replaces it if the closed precedences put it after the latest
    timed value; where no row of a group is timed, all its values are candidates.
    Of the candidates one that precedes no other is taken, then the greatest id.
    Groups without a value have no row.
    """
    timed = F.col(at).isNotNull()
    have = rows.filter(F.col(value).isNotNull())
    each = have.groupBy(group, F.col(value).alias("v")).agg(
        F.max(F.when(timed, F.struct(F.col(at).alias("at"), F.col(row_id).alias("r")))).alias("t"), F.max(F.when(~timed, F.col(row_id))).alias("u")
    )
    each = cut(each, "values")
    top = each.groupBy(group).agg(F.max(F.when(F.col("t").isNotNull(), F.struct("t.at", "t.r", "v"))).alias("top"), F.count("u").alias("n_open"))
    if each.filter("u is not null").isEmpty():
        return top.select(group, F.col("top.r").alias(row_id))
    paths = cut(closure(precedence(have, group, value, at)), "order")
    top = cut(top, "tops")
    # candidates of groups with rows without time
    open_ = each.filter("u is not null").join(top.filter("n_open > 0"), group).select(group, "v", "u", F.col("top.v").alias("tv"))
    after = open_.filter("tv is not null").join(paths.select(F.col("a").alias("tv"), F.col("b").alias("v")), ["tv", "v"]).select(group, "v", "u")
    chosen = cut(after.union(open_.filter("tv is null").select(group, "v", "u")), "candidates")
    # values that another candidate of the group follows; only pairs with a precedence are looked at
    followed = chosen.select(group, "v").join(paths.select(F.col("a").alias("v"), "b"), "v").select(group, "v", "b")
    followed = followed.join(chosen.select(group, F.col("v").alias("b")), [group, "b"], "left_semi").select(group, "v").distinct()
    last = chosen.join(followed, [group, "v"], "left_anti").groupBy(group).agg(F.max("u").alias("u"))
    return top.join(last, group, "left").select(group, F.coalesce("u", "top.r").alias(row_id))


def survivors(
    rows: DataFrame, trust: DataFrame, *, row_id: str, links: Sequence[Column], fields: Sequence[str], candidates: str, at: str
) -> DataFrame:
    """Per group and field the surviving row: columns group_id, field_name, row_id.

    fields: latest value by time or, without times, by learned precedence.  ``candidates``: the row with most distinct (source,
    source_id), then the latest; field ``source_id``: the row with the candidate of
    the most trusted source, then the highest confidence, then the latest.  trust:
    source, trust (1 is best); an unlisted source comes last.  Rows without links,
    and groups of one, have no survivor; NULL and empty candidate lists count as none.
    """
    group = duplicate_groups(rows, row_id, links)
    kept = rows.select(
        row_id, F.col(at).alias("at"), *[present(f).alias(f"v_{f}") for f in fields],
        F.filter(F.col(candidates), lambda x: present(x["source_id"]).isNotNull()).alias("c"),
    )
    base = cut(kept.join(group, row_id), "members")
    out = None
    for f in fields:
        one = latest_with_value(base.select("group_id", row_id, "at", f"v_{f}"), "group_id", f"v_{f}", "at", row_id)
        one = one.select("group_id", F.lit(f).alias("field_name"), row_id)
        out = one if out is None else out.unionByName(one)
    listed = base.filter(F.size("c") > 0)
    count = F.size(F.array_distinct(F.transform("c", lambda x: F.struct(x["source"], x["source_id"]))))
    widest = listed.groupBy("group_id").agg(F.max_by(row_id, F.struct(count, F.col("at"), F.col(row_id))).alias(row_id))
    each = listed.select("group_id", row_id, "at", F.explode("c").alias("c"))
    each = each.select("group_id", row_id, "at", F.col("c.source").alias("source"), F.col("c.confidence").alias("confidence"))
    best_of = each.join(trust.select("source", "trust"), "source", "left").groupBy("group_id").agg(
        F.max_by(row_id, F.struct(
            -F.coalesce(F.col("trust").cast("long"), F.lit(1 << 40)), F.coalesce("confidence", F.lit(float("-inf"))), F.col("at"), F.col(row_id)
        )).alias(row_id)
    )
    for name, one in (("candidates", widest), ("source_id", best_of)):
        out = out.unionByName(one.select("group_id", F.lit(name).alias("field_name"), row_id))
    return out
