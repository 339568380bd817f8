"""Keep stock and balances current from a stream of changes.

Each micro-batch is reduced to one delta per key and written to a folder named
after the batch. A batch that runs again after a failure overwrites its own
folder, so every change counts exactly once, and no running totals are kept in
streaming state. The current value is the sum of the deltas; :func:`compact`
folds committed batches into one when their number grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.changes import stock_deltas
from ledgerline.session import file_names

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELTA_SCHEMA = "{key} BIGINT, delta BIGINT, batch_id BIGINT"


def write_deltas(
    stream: DataFrame,
    key: str,
    path: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that writes the net delta per ``key`` of every micro-batch."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        net = batch.groupBy(key).agg(F.sum("delta").alias("delta"))
        net.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def distinct_changes(
    stream: DataFrame, id_column: str = "change_id", event_time: str | None = None, late_by: str | None = None
) -> DataFrame:
    """Drop changes that were delivered before.

    By default every id is remembered, which is exact and keeps one state entry
    per change. With ``late_by`` ids are forgotten once the event time has moved
    on by that much; use it only if repeats and late rows arrive within it,
    since later rows are discarded.
    """
    if late_by is None:
        return stream.dropDuplicates([id_column])
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, late_by).dropDuplicatesWithinWatermark([id_column])


def stock_stream(changes: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply a stream of sale and delivery line changes to stock.

    The ids of delivered changes are kept on the executors' disks, not in their heaps.
    """
    changes.sparkSession.conf.set(STATE_STORE, ROCKS)
    return write_deltas(
        stock_deltas(distinct_changes(changes)), "product_id", path, checkpoint, available_now
    )


def read_deltas(spark: SparkSession, key: str, path: str) -> DataFrame:
    return spark.read.schema(DELTA_SCHEMA.format(key=key)).parquet(path)


def current_totals(spark: SparkSession, key: str, path: str, out: str) -> DataFrame:
    """The sum of all deltas per key."""
    return read_deltas(spark, key, path).groupBy(key).agg(F.sum("delta").alias(out))


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch the stream has committed, -1 before the first."""
    names = file_names(spark, f"{checkpoint}/commits")
    return max((int(name) for name in names if name.isdigit()), default=-1)


def compact(spark: SparkSession, key: str, path: str, target: str, checkpoint: str) -> int:
    """Fold all committed batches into batch -1 of ``target``; returns the last one folded.

    A batch that was written but not committed runs again when the stream goes
    on, so it is copied under its own name, which the rerun overwrites. Run
    this while the stream is stopped, then continue the stream with ``target``
    as its path and the same checkpoint.
    """
    last = last_committed(spark, checkpoint)
    deltas = read_deltas(spark, key, path)
    net = deltas.filter(F.col("batch_id") <= last).groupBy(key).agg(F.sum("delta").alias("delta"))
    net.write.mode("overwrite").parquet(f"{target}/batch_id=-1")
    later = deltas.filter(F.col("batch_id") > last)
    later.write.mode("append").partitionBy("batch_id").parquet(target)
    return last
