"""Session helpers: shared working folder, lineage cuts, table reading."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def local_session(cores: str = "*", app: str = "airloom") -> SparkSession:
    """A session for tests and local work; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings of this engine.

    The JVM never compiles methods above 8000 bytes; a stage that would exceed
    this runs as separately compiled projections instead of one interpreted method.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, from ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is made, once per application,
    but only if driver and executors are one process (``local``); on a cluster that
    would be a folder of one machine, so the setting is asked for.
    """
    conf = spark.sparkContext.getConf().get(_CONF, None) or spark.conf.get(_CONF, None)
    if not conf:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{_CONF} must name a folder that all executors of {master} share")
        conf = "file://" + tempfile.mkdtemp(prefix="airloom-")
        spark.conf.set(_CONF, conf)
    return conf.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/airloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result's lineage is the written table, so it survives lost executors
    and is not computed again by later readers.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path written by this library."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def forget_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that read from them lazily must be written before."""
    drop_path(spark, f"{shared_dir(spark)}/airloom/{spark.sparkContext.applicationId}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where files give fewer tasks than there are cores.

    Only the placement of rows differs, which no operator's result depends on but
    the packing of problem 8: that is one valid packing among many for each placement.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
