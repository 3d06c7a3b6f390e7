"""Running values and neighbours in the order of a key, for keys of any size.

A plain window sorts all rows of a key in one task.  Here rows are grouped by
(key, bucket of the order column), windows run inside the groups, and what a
bucket passes on is carried over one row per (key, bucket).  A key that holds a
third of all rows is thus sorted by as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEEK = 7 * 86400
_FIRST = -(1 << 62)


def _bucketed(rows: DataFrame, at: str, bucket: int) -> DataFrame:
    """NULLs come first, as they do in a sort."""
    return rows.withColumn("__b", F.coalesce(F.floor(F.col(at) / bucket), F.lit(_FIRST)))


def _joined(rows: DataFrame, per: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows with the columns of ``per``; NULL is a key like others."""
    right = per.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.col("__b").alias("__kb"), *[c for c in per.columns if c not in (*key, "__b")])
    on = rows["__b"] == right["__kb"]
    for i, k in enumerate(key):
        on = on & rows[k].eqNullSafe(right[f"__k{i}"])
    return rows.join(right, on).drop("__kb", *[f"__k{i}" for i in range(len(key))])


def running(rows: DataFrame, key: Sequence[str], at: str, order: Sequence[str], columns: dict[str, tuple[str, Column]], *, bucket: int = WEEK) -> DataFrame:
    """Rows with running values, the current row included.

    columns: name -> (kind, value); kinds are ``sum``, ``max``, ``min`` and ``last``
    (last value that is not NULL).  Rows are ordered by ``at`` (a number), then
    ``order``, which should leave no ties; an empty table stays empty.
    """
    place = F.struct(at, *order)
    marked = _bucketed(rows, at, bucket)
    for n, (_, v) in columns.items():
        marked = marked.withColumn(f"__v_{n}", v)
    inside = Window.partitionBy(*key, "__b").orderBy(at, *order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = {"sum": F.sum, "max": F.max, "min": F.min}
    aggs, carried, local = [], [], {}
    for n, (kind, _) in columns.items():
        v = F.col(f"__v_{n}")
        if kind == "last":
            aggs.append(F.max_by(v, F.when(v.isNotNull(), place)).alias(f"__a_{n}"))
            carried.append(F.last(f"__a_{n}", ignorenulls=True).over(before).alias(f"__c_{n}"))
            local[n] = F.last(v, ignorenulls=True).over(inside)
        else:
            aggs.append(whole[kind](v).alias(f"__a_{n}"))
            carried.append(whole[kind](f"__a_{n}").over(before).alias(f"__c_{n}"))
            local[n] = whole[kind](v).over(inside)
    per = marked.groupBy(*key, "__b").agg(*aggs).select(*key, "__b", *carried)
    out = _joined(marked.select(*rows.columns, "__b", *[c.alias(f"__l_{n}") for n, c in local.items()]), per, key)
    mixed = []
    for n, (kind, _) in columns.items():
        here, there = F.col(f"__l_{n}"), F.col(f"__c_{n}")
        mix = {
            "sum": F.when(here.isNull() & there.isNull(), None).otherwise(F.coalesce(here, F.lit(0)) + F.coalesce(there, F.lit(0))),
            "max": F.greatest(here, there), "min": F.least(here, there), "last": F.coalesce(here, there),
        }[kind]
        mixed.append(mix.alias(n))
    return out.select(*[c for c in rows.columns if c not in columns], *mixed)


def neighbour(rows: DataFrame, key: Sequence[str], at: str, order: Sequence[str], value: Column, name: str, *, step: int = 1, bucket: int = WEEK) -> DataFrame:
    """Rows with ``name``: the value of the next row of the key (``step`` 1) or of the one before (-1); NULL where there is none."""
    place, boxed = F.struct(at, *order), F.struct(value.alias("v"))
    marked = _bucketed(rows, at, bucket).withColumn("__v", boxed)
    inside, over = Window.partitionBy(*key, "__b").orderBy(at, *order), Window.partitionBy(*key).orderBy("__b")
    edge, move = (F.min_by, F.lead) if step > 0 else (F.max_by, F.lag)
    per = marked.groupBy(*key, "__b").agg(edge("__v", place).alias("__e")).select(*key, "__b", move("__e").over(over).alias("__far"))
    near = marked.select(*rows.columns, "__b", move("__v").over(inside).alias("__near"))
    return _joined(near, per, key).select(*[c for c in rows.columns if c != name], F.coalesce("__near", "__far")["v"].alias(name))
