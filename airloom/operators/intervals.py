"""Continuous periods and gaps of overlapping, nested and gapped intervals.

The state of a key is a list of sorted disjoint intervals, and two states are
combined by one linear merge.  The reduction tree has three levels:

1. leaf: every task merges the rows it reads into partial lists (map-side);
2. bucket: the partial lists of one (key, time bucket) are merged as a stream
   in sorted order, so a node holds one open interval and never a whole group;
3. carry: one row per (key, bucket) says how far it reaches; a prefix maximum
   over these few rows joins what continues over bucket borders.

A key that holds a large share of all rows is spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.session import cut

LEAF_ROWS = 200_000


def union_sorted(key: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Merge rows sorted by (key, start); touching intervals join.  key: codes."""
    if not len(key):
        return key, start, stop
    reach = pd.Series(stop).groupby(key, sort=False).cummax().to_numpy()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return key[at], start[at], np.maximum.reduceat(stop, at)


def _leaf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []

    def merged() -> pd.DataFrame:
        rows = pd.concat(held, ignore_index=True)
        held.clear()
        code, names = pd.factorize(rows["k"])
        # the bucket is part of the key: lists of different buckets stay apart
        pair, _ = pd.factorize(code.astype(np.int64) * (1 << 32) + (rows["b"].to_numpy() & 0xFFFFFFFF))
        start, stop = rows["f"].to_numpy(), rows["t"].to_numpy()
        order = np.lexsort((start, pair))
        first = np.zeros(pair.max() + 1, np.int64)
        first[pair] = np.arange(len(pair))
        p, s, e = union_sorted(pair[order], start[order], stop[order])
        return pd.DataFrame({"k": names[code[first[p]]], "b": rows["b"].to_numpy()[first[p]], "f": s, "t": e})

    n = 0
    for b in batches:
        if len(b):
            held.append(b)
            n += len(b)
        if n >= LEAF_ROWS:
            yield merged()
            n = 0
    if held:
        yield merged()


def _merge_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (k, b, f) -> disjoint pieces with the end of the piece before (p, NULL for a bucket's first)."""
    open_piece: pd.DataFrame | None = None
    before: float = np.nan
    for rows in batches:
        if not len(rows):
            continue
        if open_piece is not None:
            rows = pd.concat([open_piece, rows], ignore_index=True)
        k, b = rows["k"].to_numpy(), rows["b"].to_numpy()
        change = np.ones(len(rows), np.int64)
        change[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
        code = np.cumsum(change)
        c, s, e = union_sorted(code, rows["f"].to_numpy(), rows["t"].to_numpy())
        first = np.searchsorted(code, c)
        prev = np.full(len(c), np.nan)
        prev[1:] = np.where(c[1:] == c[:-1], e[:-1].astype(float), np.nan)
        prev[0] = before
        out = pd.DataFrame({"k": k[first], "b": b[first], "f": s, "t": e, "p": pd.array(prev, dtype="Float64").astype("Int64")})
        open_piece = out.iloc[-1:][["k", "b", "f", "t"]]
        before = prev[-1]
        if len(out) > 1:
            yield out.iloc[:-1]
    if open_piece is not None:
        yield open_piece.assign(p=pd.array([before], dtype="Float64").astype("Int64"))


def coverage(
    rows: DataFrame, key: str, start: Column | str, stop: Column | str, *, bucket_seconds: int = 7 * 86400
) -> DataFrame:
    """Periods and gaps per key: columns ``key``, ``span_kind``, ``span_from``, ``span_to``.

    start, stop: whole numbers (say, epoch seconds).  Rows with NULL key, start
    or stop, or with stop not after start, cover nothing and are left out.
    Touching intervals form one period; a gap lies between two successive
    periods of a key.  Repeated rows change nothing; an empty input has no
    spans; other columns are ignored.
    """
    spark = rows.sparkSession
    col = lambda c: F.col(c) if isinstance(c, str) else c
    base = rows.select(
        F.col(key).cast("string").alias("k"), col(start).cast("long").alias("f"), col(stop).cast("long").alias("t")
    ).filter("k is not null and t > f")
    base = base.select("k", F.floor(F.col("f") / bucket_seconds).cast("long").alias("b"), "f", "t")
    schema = "k string, b long, f long, t long"
    leaf = base.mapInPandas(_leaf, schema)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = leaf.repartition(n, "k", "b").sortWithinPartitions("k", "b", "f").mapInPandas(_merge_stream, schema + ", p long")
    pieces = cut(pieces, "pieces")

    earlier = Window.partitionBy("k").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    reach = pieces.groupBy("k", "b").agg(F.max("t").alias("r")).select("k", "b", F.max("r").over(earlier).alias("carry"))
    starts = pieces.join(reach, ["k", "b"]).select("k", "b", "f", F.greatest("p", "carry").alias("before"))
    starts = starts.filter("before is null or f > before")
    in_bucket = Window.partitionBy("k", "b").orderBy("f")
    last = starts.groupBy("k", "b").agg(F.max("f").alias("s")).select("k", "b", F.max("s").over(earlier).alias("s0"))
    starts = starts.join(last, ["k", "b"]).select(
        "k", "f", "before", F.coalesce(F.lag("f").over(in_bucket), "s0").alias("since")
    )
    inner = starts.filter("before is not null").select(
        "k",
        F.explode(F.array(
            F.struct(F.lit("gap").alias("kind"), F.col("before").alias("a"), F.col("f").alias("z")),
            F.struct(F.lit("period").alias("kind"), F.col("since").alias("a"), F.col("before").alias("z")),
        )).alias("s"),
    ).select("k", "s.*")
    # The last period of a key begins at its latest start and ends where its pieces end.
    ends = pieces.groupBy("k").agg(F.max("t").alias("z"))
    final = starts.groupBy("k").agg(F.max("f").alias("a")).join(ends, "k").select("k", F.lit("period").alias("kind"), "a", "z")
    out = inner.unionByName(final)
    return out.select(
        F.col("k").alias(key), F.col("kind").alias("span_kind"), F.col("a").alias("span_from"), F.col("z").alias("span_to")
    )
