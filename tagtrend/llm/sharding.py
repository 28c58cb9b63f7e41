"""Two-pass external shuffle into shards.

Pass one scatters the rows uniformly into buckets by seeded hashes; a bucket is a part of one shard and small enough
for a task's memory. Pass two shuffles each bucket by Fisher-Yates with a seed of its own and writes it. The shard of
a row follows from its id and the number of shards alone (jump hashing): with one shard more, rows move only into the
new one. The bucket inside the shard also depends on the text, so rows that share an id are spread as well.

The order of a shard is (bucket, place in the bucket); both are kept in the files, so a slot needs only the sizes of
the buckets, and the same rows and seed give the same order whatever the number of tasks or retries.

Defined results: rows with a null id form one id of their own; a null text has size 8; repeated rows stay repeated and
are interchangeable; an empty table writes no bucket; other columns are kept in the files, but for those with the
names of the new ones (shard, grown_shard, bucket, place, and the inner _key and _text), which give way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtrend.llm.store import stage

SHARDS = 24
SEED = 1009
BUCKET_BYTES = 8 << 20


def jump(key: Column, shards: int) -> Column:
    """The shard of a hashed key: it starts in shard 0, and as shards are added one by one it jumps to shard n with
    probability 1 / (n + 1), decided by a hash of (key, n)."""
    chosen = F.lit(0)
    for n in range(1, shards):
        chosen = F.when(F.pmod(F.xxhash64(key, F.lit(n)), F.lit(n + 1)) == 0, n).otherwise(chosen)
    return chosen


def scatter(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Pass one: the columns with `shard`, `grown_shard` (one shard more) and `bucket`."""
    total = documents.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(8)).alias("n")).first()["n"] or 0
    each = max(1, -(-total // (shards * bucket_bytes)))
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull())
    return documents.withColumn("_key", key).withColumns({
        "shard": jump(F.col("_key"), shards),
        "grown_shard": jump(F.col("_key"), shards + 1),
        "bucket": F.pmod(F.xxhash64(F.lit(seed + 1), "_key", "text"), F.lit(each)).cast("int"),
    }).drop("_key")


def write_shards(documents: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Pass two: shuffle each bucket and write it; returns the written rows with shard, bucket and `place`."""
    scattered = scatter(documents.drop("_text", "place"), shards, seed, bucket_bytes)

    def shuffle(key: tuple, rows: pa.Table) -> pa.Table:
        shard, bucket = (x.as_py() for x in key)
        # one order to start from, whatever order the rows came in
        rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("_text", "ascending")]))
        order = np.random.Generator(np.random.PCG64([seed, shard, bucket])).permutation(rows.num_rows)
        placed = rows.take(pa.array(order))
        return placed.append_column("place", pa.array(np.arange(rows.num_rows), pa.int32())).drop_columns(["_text"])

    named = scattered.withColumn("_text", F.md5("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scattered.schema) + ", place int"
    return stage(named.groupBy("shard", "bucket").applyInArrow(shuffle, schema), "shards")


def with_slots(written: DataFrame) -> DataFrame:
    """The rows of written shards with `slot`, gapless from 0 in each shard; keep the columns narrow before this."""
    sizes = written.groupBy("shard", "bucket").agg(F.count("*").alias("size"))
    order = Window.partitionBy("shard").orderBy("bucket")
    before = sizes.select("shard", "bucket", (F.sum("size").over(order) - F.col("size")).alias("before"))
    return written.join(before, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("place")).drop("before")
