"""Payments applied to the oldest charges as both arrive, in any order.

A customer's charges and payments each cover consecutive stretches of their running total, in
order of date and id; where stretches overlap, the payment settles the charge. The state holds the
queues of charges and of payments that may still change. It is kept for buckets of customers, since
a call of Python for every customer costs far more than its few entries: the queues of a bucket are
arrays ordered by customer, and all its customers are settled at once. A batch puts its entries
into their places, late ones between earlier ones, and emits by how much each allocation moved, so
a late charge takes payments back from younger ones. The allocations are the sums of what was
emitted, and a batch that runs again emits the same.

With ``late_by`` the event time has a watermark: settled entries before it leave the state, Spark
discards entries that are later still, and a timer reports charges that are open for too long.
Without it nothing is discarded and the state keeps all entries, on the executors' disks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerline.streaming.stock import ROCKS, STATE_STORE

# the functions travel with the job, so executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRY = "customer_id BIGINT, side STRING, entry_id BIGINT, at TIMESTAMP, cents BIGINT"
MOVED = "customer_id BIGINT, kind STRING, transaction_id BIGINT, payment_id BIGINT, cents BIGINT"
# the two queues of a bucket as rows of (customer, time in microseconds, id, centavos), and for every
# customer (customer, where the first charge and the first payment begin in the running total, up to
# when open charges have been reported)
STATE = "charges BINARY, payments BINARY, lines BINARY"
# fixed for the life of a checkpoint; a bucket's state is read and written whole
BUCKETS = 512
DAY = 86_400_000_000

Queue = np.ndarray


def _rows(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(-1, 4)


def _merged(queue: Queue, frame: pd.DataFrame) -> Queue:
    at = frame["at"].astype("datetime64[us]").astype("int64")
    new = np.stack([frame["customer_id"].astype("int64"), at, frame["entry_id"].astype("int64"), frame["cents"].astype("int64")], 1)
    rows = np.concatenate([queue, new[new[:, 3] > 0]])
    return rows[np.lexsort([rows[:, 2], rows[:, 1], rows[:, 0]])]


def _lines_of(lines: np.ndarray, *queues: Queue) -> np.ndarray:
    """``lines`` with a row for every customer of the queues."""
    new = np.setdiff1d(np.concatenate([q[:, 0] for q in queues]), lines[:, 0])
    rows = np.concatenate([lines, np.stack([new, *[np.zeros_like(new)] * 3], 1)])
    return rows[np.argsort(rows[:, 0], kind="stable")]


def _ends(queue: Queue, lines: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The line of every entry, and where the entry ends in its customer's running total."""
    line = np.searchsorted(lines[:, 0], queue[:, 0])
    sums = np.cumsum(queue[:, 3])
    first = np.searchsorted(queue[:, 0], queue[:, 0])
    return line, lines[line, start] + sums - (sums[first] - queue[first, 3])


def _overlaps(charges: Queue, payments: Queue, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of charges and payments whose stretches overlap, and the centavos of each overlap."""
    c_line, c_end = _ends(charges, lines, 1)
    p_line, p_end = _ends(payments, lines, 2)
    # the customers' stretches one behind the other
    begin = np.minimum(lines[:, 1], lines[:, 2])
    last = np.maximum(lines[:, 1], lines[:, 2])
    np.maximum.at(last, c_line, c_end)
    np.maximum.at(last, p_line, p_end)
    shift = np.cumsum(last - begin) - last
    c_end, p_end = c_end + shift[c_line], p_end + shift[p_line]
    c_low, p_low = c_end - charges[:, 3], p_end - payments[:, 3]
    first = np.searchsorted(p_end, c_low, "right")
    n = np.maximum(np.searchsorted(p_low, c_end, "left") - first, 0)
    c = np.repeat(np.arange(len(charges)), n)
    p = np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return c, p, np.minimum(c_end[c], p_end[p]) - np.maximum(c_low[c], p_low[p])


def _allocated(charges: Queue, payments: Queue, lines: np.ndarray) -> np.ndarray:
    """Rows of (customer, charge, payment, centavos), one per charge and payment."""
    c, p, cents = _overlaps(charges, payments, lines)
    rows = np.stack([charges[c, 0], charges[c, 2], payments[p, 2], cents], 1)
    rows = rows[np.lexsort([rows[:, 2], rows[:, 1], rows[:, 0]])]
    last = np.ones(len(rows), bool)
    last[:-1] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[last]


def _moved(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """By how much each allocation changed, without those that did not."""
    gone = before.copy()
    gone[:, 3] *= -1
    rows = np.concatenate([gone, after])
    rows = rows[np.lexsort([rows[:, 2], rows[:, 1], rows[:, 0]])]
    if not len(rows):
        return rows
    first = np.flatnonzero(np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(1)])
    moved = rows[first]
    moved[:, 3] = np.add.reduceat(rows[:, 3], first)
    return moved[moved[:, 3] != 0]


def _forget(charges: Queue, payments: Queue, lines: np.ndarray, before: int) -> tuple[Queue, Queue, np.ndarray]:
    """The queues without entries that are settled for good: nothing can still come before them."""
    (c_line, c_end), (p_line, p_end) = _ends(charges, lines, 1), _ends(payments, lines, 2)
    final_c, final_p = lines[:, 1].copy(), lines[:, 2].copy()
    for final, queue, line, end in ((final_c, charges, c_line, c_end), (final_p, payments, p_line, p_end)):
        sure = queue[:, 1] < before
        np.maximum.at(final, line[sure], end[sure])
    upto = np.minimum(final_c, final_p)
    gone_c, gone_p = c_end <= upto[c_line], p_end <= upto[p_line]
    lines = lines.copy()
    np.maximum.at(lines[:, 1], c_line[gone_c], c_end[gone_c])
    np.maximum.at(lines[:, 2], p_line[gone_p], p_end[gone_p])
    return charges[~gone_c], payments[~gone_p], lines


def _bucket_of(queue: Queue) -> Queue:
    return np.concatenate([np.zeros((len(queue), 1), np.int64), queue], 1)


def allocations(charges: Queue, payments: Queue, charged: int, paid: int) -> dict[tuple[int, int], int]:
    """Centavos per (charge, payment) of one customer, whose queues have rows of (time, id, centavos)."""
    found = _allocated(_bucket_of(charges), _bucket_of(payments), np.array([(0, charged, paid, 0)], np.int64))
    return {(int(c), int(p)): int(cents) for _, c, p, cents in found}


def _settled(charges: Queue, payments: Queue, charged: int, paid: int, before: int) -> tuple[Queue, Queue, int, int]:
    """:func:`_forget` for one customer."""
    lines = np.array([(0, charged, paid, 0)], np.int64)
    charges, payments, lines = _forget(_bucket_of(charges), _bucket_of(payments), lines, before)
    return charges[:, 1:], payments[:, 1:], int(lines[0, 1]), int(lines[0, 2])


def _open(charges: Queue, payments: Queue, lines: np.ndarray) -> np.ndarray:
    """What is open of every charge."""
    c, _, cents = _overlaps(charges, payments, lines)
    rest = charges[:, 3].copy()
    np.subtract.at(rest, c, cents)
    # what a first queued charge had settled by payments that left the state
    customers, first = np.unique(charges[:, 0], return_index=True)
    line = np.searchsorted(lines[:, 0], customers)
    rest[first] -= np.maximum(lines[line, 2] - lines[line, 1], 0)
    return rest


def _frame(kind: str, rows: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "customer_id": rows[:, 0],
            "kind": kind,
            "transaction_id": rows[:, 1],
            "payment_id": pd.array(rows[:, 2] if kind == "allocated" else [None] * len(rows), "Int64"),
            "cents": rows[:, 3],
        }
    )


def _follower(open_days: int | None):
    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else (b"", b"", b"")
        charges, payments, lines = map(_rows, held)
        out = []
        if not state.hasTimedOut:
            new = pd.concat(list(frames))
            # other customers of the bucket have nothing new
            touched = new["customer_id"].unique()
            own = [q[np.isin(q[:, 0], touched)] for q in (charges, payments)]
            before = _allocated(*own, lines)
            charges = _merged(charges, new[new["side"] == "charge"])
            payments = _merged(payments, new[new["side"] == "payment"])
            lines = _lines_of(lines, charges, payments)
            own = [q[np.isin(q[:, 0], touched)] for q in (charges, payments)]
            out.append(_frame("allocated", _moved(before, _allocated(*own, lines))))
        if open_days is not None:
            mark = state.getCurrentWatermarkMs() * 1000
            rest = _open(charges, payments, lines)
            due = charges[:, 1] + open_days * DAY
            reported = lines[np.searchsorted(lines[:, 0], charges[:, 0]), 3]
            over = (rest > 0) & (reported < due) & (due <= mark)
            out.append(_frame("overdue", np.stack([charges[:, 0], charges[:, 2], charges[:, 2], rest], 1)[over]))
            waiting = due[(rest > 0) & (due > mark)]
            charges, payments, lines = _forget(charges, payments, lines, mark)
            lines[:, 3] = np.maximum(lines[:, 3], mark)
            if len(waiting):
                state.setTimeoutTimestamp(int(waiting.min()) // 1000 + 1)
        state.update((charges.tobytes(), payments.tobytes(), lines.tobytes()))
        yield from (frame for frame in out if len(frame))

    return follow


def moves(entries: DataFrame, late_by: str | None = None, open_days: int = 30) -> DataFrame:
    """The stream of moved allocations (and, with ``late_by``, of overdue charges) of a stream of entries.

    ``entries`` has customer_id, side ('charge' or 'payment'), entry_id, at and cents. Entries
    without a customer settle nothing and are left out, as are amounts that are not positive.
    """
    named = entries.filter("customer_id IS NOT NULL AND cents > 0").select(
        *[F.col(f.split()[0]).cast(f.split()[1]) for f in ENTRY.split(", ")]
    )
    named = named.withColumn("bucket", F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)))
    entries.sparkSession.conf.set(STATE_STORE, ROCKS)
    if late_by is None:
        grouped = named.groupBy("bucket")
        return grouped.applyInPandasWithState(_follower(None), MOVED, STATE, "append", GroupStateTimeout.NoTimeout)
    grouped = named.withWatermark("at", late_by).groupBy("bucket")
    follow = _follower(open_days)
    return grouped.applyInPandasWithState(follow, MOVED, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def fifo_stream(
    entries: DataFrame,
    path: str,
    checkpoint: str,
    late_by: str | None = None,
    open_days: int = 30,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query that writes what every micro-batch moved to a folder named after the batch."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = moves(entries, late_by, open_days).writeStream.foreachBatch(write_batch)
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_moves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{MOVED}, batch_id BIGINT").parquet(path)


def current_allocations(spark: SparkSession, path: str) -> DataFrame:
    """Centavos per customer, charge and payment, from all that was moved."""
    moved = read_moves(spark, path).filter("kind = 'allocated'")
    sums = moved.groupBy("customer_id", "transaction_id", "payment_id").agg(F.sum("cents").alias("cents"))
    return sums.filter("cents <> 0")


def overdue(spark: SparkSession, path: str) -> DataFrame:
    """Charges that were open when they became too old, with what was open then."""
    return read_moves(spark, path).filter("kind = 'overdue'").select("customer_id", "transaction_id", "cents")
