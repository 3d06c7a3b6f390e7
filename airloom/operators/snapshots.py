"""What changed between consecutive full snapshots of a table.

The operator keeps a bucketed index key -> row hash of the last snapshot in the
shared folder.  A new snapshot probes it (the index side of the join is already
bucketed, only the new rows are shuffled); old values are fetched only for the
keys whose hash differs; then the new index takes the place of the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import cut, drop_path, scratch_path


def row_hash(columns: Sequence[Column]) -> Column:
    """128 bits over all values; NULL and empty text count as equal."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.struct(F.xxhash64(*text).alias("h1"), F.xxhash64(F.lit("second"), *reversed(text)).alias("h2"))


class SnapshotIndex:
    """Index of the last snapshot; ``apply`` takes the next one and returns the changes.

    Two tables with the same buckets: the index (key, hash) is small and read whole
    at every probe, the values are read only where a key of their bucket changed.
    """

    def __init__(self, spark: SparkSession, key: str, values: Sequence[str], *, buckets: int | None = None):
        self.spark, self.key, self.values = spark, key, list(values)
        self.buckets = buckets or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.tables: dict[str, str] = {}
        self._old: dict[str, str] = {}

    def _write(self, rows: DataFrame, kind: str) -> None:
        name, path = f"airloom_{kind}_{uuid.uuid4().hex}", scratch_path(self.spark, kind)
        rows.write.format("parquet").option("path", path).bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(name)
        self.tables[name] = path

    def _named(self, tables: dict[str, str], kind: str) -> DataFrame:
        return self.spark.table(next(n for n in tables if n.startswith(f"airloom_{kind}_")))

    def apply(self, rows: DataFrame, order: Sequence[Column]) -> DataFrame | None:
        """Changes against the snapshot before; None for the first one.

        rows: ``key`` (NULL keys are left out) and the values; of several rows of
        one key the last by ``order`` counts.  Columns of the result: key,
        change_kind (added, removed, changed), old and new value structs.
        """
        key = self.key
        best = F.struct(*self.values)
        one = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(best, F.struct(*order)).alias("v"))
        self.forget_previous()
        self._old, self.tables = self.tables, {}
        self._write(one, "val")
        # the values lie in buckets already, so the index is made without a shuffle
        self._write(self._named(self.tables, "val").select(key, row_hash([F.col("v")[c] for c in self.values]).alias("h")), "idx")
        if not self._old:
            return None
        old, fresh = (self._named(t, "idx") for t in (self._old, self.tables))
        probe = old.select(key, F.col("h").alias("h0")).join(fresh.select(key, "h"), key, "full_outer")
        kind = F.when(F.col("h0").isNull(), "added").when(F.col("h").isNull(), "removed").otherwise("changed")
        hit = cut(probe.filter("h0 is null or h is null or h0 <> h").select(key, kind.alias("change_kind")), "hits")
        # the planner's size check decides whether the hits go to the buckets or the buckets to the hits
        before = self._named(self._old, "val").select(key, F.col("v").alias("old"))
        after = self._named(self.tables, "val").select(key, F.col("v").alias("new"))
        lost = hit.filter("change_kind <> 'added'").join(before, key)
        new = hit.filter("change_kind <> 'removed'").join(after, key).drop("change_kind")
        added = hit.filter("change_kind = 'added'").join(after, key)
        none = F.lit(None).cast(before.schema["old"].dataType)
        gone = lost.join(new, key, "left").select(key, "change_kind", "old", "new")
        return gone.unionByName(added.select(key, "change_kind", none.alias("old"), "new"))

    def forget_previous(self) -> None:
        """Drop the tables before the current ones, once the changes are written."""
        self._drop(self._old)
        self._old = {}

    def close(self) -> None:
        """Drop all tables."""
        self.forget_previous()
        self._drop(self.tables)
        self.tables = {}

    def _drop(self, tables: dict[str, str]) -> None:
        for name, path in tables.items():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_path(self.spark, path)


def snapshot_changes(
    rows: DataFrame, snapshot: str, key: str, values: Sequence[str], order: Sequence[Column], *, buckets: int | None = None
) -> DataFrame:
    """Changes between consecutive snapshots that lie under one another in ``rows``.

    Snapshots are taken in ascending order of ``snapshot``; a key that returns
    after an absence is ``added`` again.  An empty table or a single snapshot
    has no changes.  Rows are laid out by snapshot once, so that each step reads
    its own snapshot only.  The list of snapshot numbers is the only thing collected.
    """
    spark = rows.sparkSession
    kind = rows.schema[snapshot].dataType
    folder = scratch_path(spark, "snapshots")
    rows.select(F.col(snapshot).alias("__no"), key, *values, F.struct(*order).alias("__order")).filter("__no is not null").write.partitionBy("__no").parquet(folder)
    numbers = sorted(r[0] for r in rows.select(snapshot).distinct().collect() if r[0] is not None)
    index = SnapshotIndex(spark, key, values, buckets=buckets)
    path = scratch_path(spark, "changes")
    parts = None
    if numbers:
        parts = spark.read.parquet(folder).withColumn("__no", F.col("__no").cast(kind))
    written = False
    try:
        for n in numbers:
            changes = index.apply(parts.filter(F.col("__no") == n), [F.col("__order")])
            if changes is not None:
                changes.withColumn(snapshot, F.lit(n).cast(kind)).write.mode("append").parquet(path)
                written = True
            index.forget_previous()
    finally:
        index.close()
        drop_path(spark, folder)
    schema = f"{key} {rows.schema[key].dataType.simpleString()}, change_kind string, {snapshot} {kind.simpleString()}"
    if not written:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)
