"""The registry kept up to date from a stream of events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from folioscope.operators.registry import index_status, processing_status, state


def event_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Files of events as they arrive."""
    return spark.readStream.schema(schema).parquet(folder)


def running_state(events: DataFrame) -> DataFrame:
    """The same fold as the batch ``state``, kept by the state store; for update or complete mode."""
    return state(events)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Events by window and stage, given out once no event of the window can come in time."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "stage")
    return counted.agg(F.count(F.lit(1)).alias("n"), F.count_if(processing_status(F.col("event"), F.col("stage")).isNotNull() | index_status(F.col("event"), F.col("stage")).isNotNull()).alias("n_status"))


def run_to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """All that is there now, into a table in memory; for tests and small states."""
    return stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_folder(stream: DataFrame, folder: str) -> DataFrame:
    """All that is there now, folded and written below ``folder``, which executors share: each batch writes the whole table anew, and the last one is read."""
    path = f"{folder}/registry-{uuid.uuid4().hex}"
    written: list[int] = []

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch-{batch}")
        written.append(batch)

    stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/batch-{written[-1]}") if written else stream.sparkSession.createDataFrame([], stream.schema)
