"""Running a stream batch by batch, and the tables batches leave for later ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keyed_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB, on disk, unless the session names another store."""
    if spark.conf.get(_PROVIDER).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_batches(stream: DataFrame, root: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start ``handle(batch, batch_id)`` on every micro-batch until the input is drained."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def earlier_batches(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """Rows of the batches before ``batch_id``; the filter prunes directories."""
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).where(F.col("batch_id") < batch_id).drop("batch_id")
