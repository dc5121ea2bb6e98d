"""The attempt log as a stream: the current best attempt of each key, kept up to date as records are appended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import best_attempt
from ..sources.buckets import BucketTable

#: Buckets of the state: a batch rewrites those that its keys fall into.
BUCKETS = 64


def state(spark: SparkSession, out: str, schema: T.StructType, key: str = "doi", buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(spark, out, schema, key, buckets)


def apply(table: BucketTable, batch: DataFrame, batch_id: int, order: str) -> None:
    """Take a batch into the state; taking it in again gives the same rows. One that comes after others that the state has not seen is an error, since going on would lose them."""
    seen = table.version().tag
    if batch_id > seen + 1:
        raise ValueError(f"batch {batch_id} follows {seen} in the state at {table.folder.path}: batches between are lost")
    table.update(batch, lambda before, new: best_attempt(before.unionByName(new), order, table.key), tag=batch_id if batch_id > seen else None)


def maintain(spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str, order: str, key: str = "doi", buckets: int = BUCKETS, files: int = 1000) -> StreamingQuery:
    """Read appended JSON Lines below `source`, at most so many files a batch, and keep the best attempt of each key below `out`.

    A batch rewrites only the buckets of its keys; the version before stays for
    its readers, older ones are removed.
    """

    def batched(batch: DataFrame, batch_id: int) -> None:
        apply(state(batch.sparkSession, out, schema, key, buckets), batch, batch_id, order)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(source).where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return rows.writeStream.foreachBatch(batched).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, out: str, schema: T.StructType, key: str = "doi", buckets: int = BUCKETS) -> DataFrame:
    """The best attempt of each key after all batches so far."""
    return state(spark, out, schema, key, buckets).read()
