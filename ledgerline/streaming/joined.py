"""Totals over headers joined with lines, kept current from changes of either side.

A change takes rows away and adds rows, so it is a set of rows with weights -1 and 1. The join is
linear in each side, so a total moves by

    changed headers x (lines before + changed lines)  +  headers before x changed lines

and no other row of either side matters. What a batch changed is appended to a log per side,
reduced to one row per join key (and group) first; the rows "before" are the sums of the earlier
batches' logs. Logs are cut into buckets by join key, and a batch reads the buckets of the keys it
changes only. A sale whose lines arrive before its header, or after it, or whose header is deleted
while lines stay, needs no special case.

A batch writes folders named after it and reads earlier ones only, so running it again replaces
what it wrote, and every change counts exactly once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.session import file_names, materialize

BUCKETS = 64
WEIGHT = "weight"


@dataclass(frozen=True)
class JoinedTotal:
    """Sums of ``measures`` of lines, per ``group`` of the header that ``key`` names.

    ``keep``      SQL condition on headers; others add nothing
    ``measures``  name of each total to its SQL expression on a line, a whole number
    """

    key: str
    group: str
    measures: dict[str, str]
    keep: str = "true"
    buckets: int = field(default=BUCKETS)

    @property
    def sums(self) -> list[str]:
        return list(self.measures)


def changed_rows(before: DataFrame | None = None, after: DataFrame | None = None) -> DataFrame:
    """Rows that go (``before``) and come (``after``), with their weights.

    An insert has no row before, a delete none after, an update has both.
    """
    gone = None if before is None else before.withColumn(WEIGHT, F.lit(-1).cast("bigint"))
    come = None if after is None else after.withColumn(WEIGHT, F.lit(1).cast("bigint"))
    if gone is None or come is None:
        return come if gone is None else gone
    return gone.unionByName(come)


def _bucket(total: JoinedTotal) -> Column:
    return F.pmod(F.xxhash64(total.key), F.lit(total.buckets)).cast("int").alias("bucket")


def net_headers(total: JoinedTotal, headers: DataFrame) -> DataFrame:
    """Changed headers, one row per key and group; a header that only moved elsewhere cancels out."""
    kept = headers.filter(total.keep).filter(F.col(total.group).isNotNull() & F.col(total.key).isNotNull())
    return (
        kept.groupBy(total.key, total.group).agg(F.sum(WEIGHT).alias(WEIGHT)).filter(F.col(WEIGHT) != 0)
        .select(_bucket(total), total.key, total.group, WEIGHT)
    )


def net_lines(total: JoinedTotal, lines: DataFrame) -> DataFrame:
    """Changed lines, one row of sums per key."""
    sums = [F.sum(F.expr(f"({value}) * {WEIGHT}")).cast("bigint").alias(out) for out, value in total.measures.items()]
    moved = " OR ".join(f"{out} <> 0" for out in total.sums)
    return (
        lines.filter(F.col(total.key).isNotNull()).groupBy(total.key).agg(*sums).filter(moved)
        .select(_bucket(total), total.key, *total.sums)
    )


def _log(spark: SparkSession, path: str, schema: StructType, batch_id: int, buckets: list[int]) -> DataFrame:
    """Rows that batches before ``batch_id`` logged in some buckets."""
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != "bucket"])
    if not buckets or not file_names(spark, path):
        return spark.createDataFrame([], f"{fields}, batch_id BIGINT, bucket INT")
    # both are folders, so only those of the wanted buckets are listed and read
    rows = spark.read.schema(f"{fields}, batch_id BIGINT, bucket INT").parquet(path)
    return rows.filter(F.col("bucket").isin(buckets) & (F.col("batch_id") < batch_id))


def _buckets(net: DataFrame) -> list[int]:
    """The buckets that hold a changed key; at most as many as there are."""
    return [r["bucket"] for r in net.select("bucket").distinct().collect()]


def _write(net: DataFrame, path: str, batch_id: int) -> None:
    # one file a bucket, sorted by key
    sorted_ = net.repartition("bucket").sortWithinPartitions("bucket", net.columns[1])
    sorted_.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch_id={batch_id}")


def apply_changes(
    total: JoinedTotal, root: str, batch_id: int, headers: DataFrame | None = None, lines: DataFrame | None = None
) -> None:
    """Move the totals in ``root`` by the changes of a batch (see :func:`changed_rows`).

    Batches must run in the order of their ids, one at a time; a batch may run again.
    """
    given = headers if headers is not None else lines
    if given is None:
        return
    spark = given.sparkSession
    new_headers = None if headers is None else materialize(net_headers(total, headers), "net-headers")
    new_lines = None if lines is None else materialize(net_lines(total, lines), "net-lines")
    moves = []

    def moved(joined: DataFrame) -> DataFrame:
        weighed = [F.sum(F.col(m) * F.col(WEIGHT)).cast("bigint").alias(m) for m in total.sums]
        return joined.groupBy(F.col(total.group).alias("group_key")).agg(*weighed)

    if new_headers is not None:
        shape = new_lines.schema if new_lines is not None else _line_schema(total, new_headers)
        known = _log(spark, f"{root}/lines", shape, batch_id, _buckets(new_headers))
        known = known.select(total.key, *total.sums)
        if new_lines is not None:
            known = known.unionByName(new_lines.select(total.key, *total.sums))
        # one row per key meets the headers, so a sale with very many lines costs no more
        wanted = known.join(new_headers.select(total.key).distinct(), total.key, "left_semi")
        sums = wanted.groupBy(total.key).agg(*[F.sum(m).alias(m) for m in total.sums])
        moves.append(moved(new_headers.join(sums, total.key)))
    if new_lines is not None:
        shape = new_headers.schema if new_headers is not None else _header_schema(spark, total, root, new_lines)
        if shape is not None:
            known = _log(spark, f"{root}/headers", shape, batch_id, _buckets(new_lines))
            wanted = known.join(new_lines.select(total.key), total.key, "left_semi")
            net = wanted.groupBy(total.key, total.group).agg(F.sum(WEIGHT).alias(WEIGHT))
            moves.append(moved(net.join(new_lines, total.key)))
    # logs first: a batch that fails in between runs again and reads earlier batches only
    if new_headers is not None:
        _write(new_headers, f"{root}/headers", batch_id)
    if new_lines is not None:
        _write(new_lines, f"{root}/lines", batch_id)
    if moves:
        both = moves[0] if len(moves) == 1 else moves[0].unionByName(moves[1])
        net = both.groupBy("group_key").agg(*[F.sum(m).alias(m) for m in total.sums])
        net.write.mode("overwrite").parquet(f"{root}/totals/batch_id={batch_id}")


def _line_schema(total: JoinedTotal, headers: DataFrame) -> StructType:
    key = headers.schema[total.key].dataType.simpleString()
    return StructType.fromDDL(", ".join([f"`{total.key}` {key}", *[f"`{m}` BIGINT" for m in total.sums]]))


def _header_schema(spark: SparkSession, total: JoinedTotal, root: str, lines: DataFrame) -> StructType | None:
    """The schema of the logged headers, None before the first of them."""
    if not file_names(spark, f"{root}/headers"):
        return None
    logged = spark.read.parquet(f"{root}/headers").schema
    return StructType([logged[c] for c in (total.key, total.group, WEIGHT)])


def totals(spark: SparkSession, total: JoinedTotal, root: str) -> DataFrame:
    """The totals as they stand, one row per group that ever had a line; columns are the group and the measures."""
    moved = spark.read.parquet(f"{root}/totals")
    return moved.groupBy(F.col("group_key").alias(total.group)).agg(
        *[F.sum(m).cast("bigint").alias(m) for m in total.sums]
    )


def compact(spark: SparkSession, total: JoinedTotal, root: str, target: str, last: int) -> None:
    """Fold the batches up to ``last`` into batch -1 of ``target``.

    Rows that cancel out disappear. Run it between batches and go on with ``target``.
    """
    for side, by, sums in (
        ("headers", ["bucket", total.key, total.group], [WEIGHT]),
        ("lines", ["bucket", total.key], total.sums),
        ("totals", ["group_key"], total.sums),
    ):
        if not file_names(spark, f"{root}/{side}"):
            continue
        rows = spark.read.parquet(f"{root}/{side}")
        folded = rows.filter(F.col("batch_id") <= last).groupBy(*by).agg(*[F.sum(m).alias(m) for m in sums])
        folded = folded.filter(" OR ".join(f"{m} <> 0" for m in sums))
        later = rows.filter(F.col("batch_id") > last)
        if side == "totals":
            folded.write.mode("overwrite").parquet(f"{target}/totals/batch_id=-1")
            later.write.mode("append").partitionBy("batch_id").parquet(f"{target}/totals")
        else:
            _write(folded.select(*by, *sums), f"{target}/{side}", -1)
            later.write.mode("append").partitionBy("batch_id", "bucket").parquet(f"{target}/{side}")


def follow(
    changes: DataFrame, total: JoinedTotal, root: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Keep the totals in ``root`` current from a stream of changed rows.

    ``changes`` has a column ``side`` ('header' or 'line'), ``weight`` and the columns of both
    sides, NULL on the other side's rows. A micro-batch that runs again replaces what it wrote.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stored = materialize(batch, "changes")
        apply_changes(
            total, root, batch_id, stored.filter("side = 'header'"), stored.filter("side = 'line'")
        )

    writer = changes.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
