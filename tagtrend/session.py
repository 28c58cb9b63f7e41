"""Session defaults and the tables written to the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "tagtrend", master: str | None = None, **options: str) -> SparkSession:
    """A session with the settings every plan assumes; `options` are Spark settings with `_` for `.`.

    On a cluster leave `master` unset and size `spark.sql.shuffle.partitions` through the cluster's own
    defaults; AQE coalesces small shuffles and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in options.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table that arrives as fewer splits than there are cores, by a unique key, before costly
    per-row text work. A table with at least as many splits as cores, as any large one has, is returned as
    it is and never shuffled here."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """This application's folder on the storage that all executors share.

    The cluster names the place in `spark.checkpoint.dir`. Only a local session, whose executors are one process, may
    leave it unset and gets a folder of its warehouse; elsewhere that could be a disk of one machine.
    """
    place = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.match(r"local(\[[^\]]*\])?$", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        place = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    return f"{place.rstrip('/')}/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: Options for `stage` and `stage_by` where rows hold arrays that are compressed already. Parquet would compress pages of
#: a hundred such rows and more once again, in buffers of their size outside the heap; here a page ends at its size.
PACKED = {"compression": "none", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}


def stage(df: DataFrame, name: str = "stage", **options: str) -> DataFrame:
    """Write a table once to the shared folder and read it back: the steps that use it do not compute it again, and a
    lost executor costs a re-read. `options` are those of the writer. `release` removes all of them."""
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Whatever is written inside gives back its shuffle files as soon as it is written. Without that they stay until
    the driver happens to collect garbage, beside the tables made of them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete what was written to a path of the shared folder, once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def read_once(df: DataFrame, name: str) -> pa.Table:
    """The rows of a small result, at the driver. They are written on the way, since only what is written gives back its
    shuffle files at once; the steps of a fit would leave theirs beside each other."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    with shuffles_freed(spark):
        df.write.options(**PACKED).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).toArrow()
    drop_stage(spark, path)
    return out


def stage_by(df: DataFrame, key: str, name: str = "stage", **options: str) -> DataFrame:
    """Like `stage`, in buckets by a key: a join on the key reads the rows where they are and does not shuffle them."""
    spark = df.sparkSession
    table, tasks = f"stage_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").options(**options).bucketBy(tasks, key).option("path", fresh_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay until `release`
    return out


def release(spark: SparkSession) -> None:
    """Delete the stages that this application has written, once no result that reads them is needed."""
    drop_stage(spark, shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise an iterative step's input, so that a lost executor costs a re-read and not a recomputation."""
    return stage(df, "lineage")


def small_side(df: DataFrame, max_rows: int = 50_000) -> DataFrame:
    """Materialise a derived table once and mark it for broadcast if it has at most `max_rows` rows.

    Without a known size the planner shuffles both sides of a join, whole texts included, before it learns
    that one of them is small. Beyond the bound the join is planned as usual. Rows must be narrow.
    """
    done = cut_lineage(df)
    return F.broadcast(done) if done.count() <= max_rows else done
