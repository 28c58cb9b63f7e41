"""Row positions without pulling the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.session import stage

_IN_TASK = (1 << 33) - 1


def with_position(df: DataFrame, by: str, name: str = "position", *, tie_break: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based position of every row in the order of `by`, then `tie_break`; nulls come last.

    An unpartitioned window sorts the whole table in one task. Here the rows are ranged over as many tasks as a shuffle
    has, sorted in each and written once with their number in the task; a position is that plus the rows of the tasks
    before. The range takes all order columns and a hash of the row, so a repeated `by`, or a third of the table
    without one, is spread as well, and the numbering is the same whatever the partitions: only rows equal in every
    column can trade places. One count per task visits the driver.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = [f.name for f in df.schema if not any(x in f.dataType.simpleString() for x in ("map<", "vector", "variant"))]
    order = [F.col(c).asc_nulls_last() for c in (by, *tie_break)] + [F.xxhash64(*plain).asc()]
    ranged = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = stage(ranged.withColumn("_id", F.monotonically_increasing_id()), "positions")
    task = F.shiftright("_id", 33)
    sizes = {r["_task"]: r["count"] for r in placed.groupBy(task.cast("int").alias("_task")).count().collect()}
    starts, total = [], 0
    for t in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(t, 0)
    first = F.get(F.lit(starts or [0]).cast("array<long>"), task.cast("int"))
    return placed.withColumn(name, F.col("_id").bitwiseAND(_IN_TASK) + first).drop("_id")
