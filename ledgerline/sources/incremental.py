"""Loads that take only files that have come since the last one.

Every table's folder is read by a file stream, whose checkpoint is the log of files taken. A
micro-batch passes a gate: rows with malformed fields, broken rules, keys that are there already or
references to nothing are kept aside with their reasons, all others are written to a folder named
after the batch, which a rerun replaces. The batch is stored once, as it came; types and reasons
are derived whenever it is read, and only the faults that were found meet its rows again, so a
batch with few faults is not shuffled. New rows are checked against what is stored, stored rows
are not checked again. When all streams have come to their end, one appended file says which batch
of each table belongs to the new version. A load that fails on the way leaves the last version in
force, and earlier versions can be read as long as their batches are there.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.model import TABLES, Shop, Table
from ledgerline.plans.marts import recompute_stock
from ledgerline.session import file_names, materialize
from ledgerline.sources.csv import ABSENT, DIALECT, csv_header
from ledgerline.streaming.stock import last_committed

CORRUPT = "_corrupt_record"
ROW = "__row"
VERSIONS = "sequence BIGINT, table_name STRING, last_batch BIGINT"


def _levels() -> list[list[str]]:
    """Tables in the order in which they can be loaded; those of one level do not refer to each other."""
    levels: list[list[str]] = []
    done: set[str] = set()
    while len(done) < len(TABLES):
        level = [n for n, t in TABLES.items() if n not in done and {p for p, _, _ in t.references.values()} <= done]
        levels.append(level)
        done.update(level)
    return levels


def _stored(spark: SparkSession, root: str, name: str, last: int) -> DataFrame:
    """Accepted rows of a table in the batches up to ``last``."""
    path = f"{root}/tables/{name}"
    schema = TABLES[name].schema
    if last < 0 or not file_names(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, *StructType.fromDDL("batch_id BIGINT").fields])).parquet(path)
    return rows.filter(F.col("batch_id") <= last).drop("batch_id")


def _last(spark: SparkSession, root: str, name: str) -> int:
    return last_committed(spark, f"{root}/taken/{name}")


def _typed(raw: DataFrame, table: Table) -> DataFrame:
    """The table's columns, and ``__reasons``: what is wrong with a row by itself; ``raw`` has its ROW."""
    reasons = [F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed"))]
    columns: list[Column] = []
    for f in table.schema.fields:
        if f.name in raw.columns:
            value = F.col(f.name).try_cast(f.dataType)
            reasons.append(F.when(F.col(f.name).isNotNull() & value.isNull(), F.lit(f"type:{f.name}")))
        else:
            value = F.expr(table.defaults.get(f.name, "NULL")).cast(f.dataType)
        columns.append(value.alias(f.name))
    text = F.to_json(F.struct(*[c for c in raw.columns if c not in (CORRUPT, ROW)]))
    typed = raw.select(*columns, F.array_compact(F.array(*reasons)).alias("__reasons"), text.alias("__text"), ROW)
    rules = [F.when(F.col(c).isNull(), F.lit(f"required:{c}")) for c in dict.fromkeys((*table.key, *table.required))]
    rules += [F.when(~F.expr(rule), F.lit(f"check:{name}")) for name, rule in table.checks.items()]
    return typed.withColumn("__reasons", F.concat("__reasons", F.array_compact(F.array(*rules))))


def _repeats(new: DataFrame, stored: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows whose key is stored already, or was taken by an earlier row of the batch."""
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    keyed = new.filter(whole).select(ROW, *columns)
    known = stored.filter(whole).select(F.lit(None).cast("bigint").alias(ROW), *columns)
    # each key meets its like once; what is stored is no row of the batch
    met = keyed.unionByName(known).groupBy(*columns).agg(
        F.count(ROW).alias("__new"), F.count(F.lit(1)).alias("__all"), F.min(ROW).alias("__first")
    )
    suspect = met.filter((F.col("__new") > 0) & (F.col("__all") > 1)).select(
        *columns, F.when(F.col("__all") == F.col("__new"), F.col("__first")).alias("__first")
    )
    # stored, so that few of them need no shuffle of the batch
    suspect = materialize(suspect, "suspects")
    found = keyed.join(suspect, list(columns)).filter(~F.col(ROW).eqNullSafe(F.col("__first")))
    return found.select(ROW, F.lit(f"repeated:{'+'.join(columns)}").alias("reason"))


def _orphans(new: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    used = new.filter(F.col(column).isNotNull()).select(ROW, F.col(column).alias("__key"))
    # one row per value meets the parents
    missing = used.select("__key").distinct().join(parent.select(F.col(parent_key).alias("__key")), "__key", "left_anti")
    missing = materialize(missing, "missing")
    return used.join(missing, "__key", "left_semi").select(ROW, F.lit(f"reference:{column}").alias("reason"))


def _take(root: str, name: str, raw: DataFrame, batch_id: int) -> None:
    """Write the rows of a batch that pass the gate, and those that do not with their reasons."""
    spark, table = raw.sparkSession, TABLES[name]
    typed = _typed(materialize(raw.withColumn(ROW, F.monotonically_increasing_id()), f"taken-{name}"), table)
    sound = typed.filter(F.size("__reasons") == 0)
    # parents come first: what a batch refers to must have been accepted
    orphans = [
        _orphans(sound, column, _stored(spark, root, parent, _last(spark, root, parent)), key)
        for column, (parent, key, _) in table.references.items()
    ]
    if orphans:
        homeless = materialize(reduce(DataFrame.unionByName, orphans), f"orphans-{name}")
        sound = sound.join(homeless.select(ROW).distinct(), ROW, "left_anti")
    stored = _stored(spark, root, name, batch_id - 1)
    repeats = reduce(DataFrame.unionByName, [_repeats(sound, stored, c) for c in (table.key, *table.unique)])
    found = repeats.unionByName(homeless) if orphans else repeats
    faults = found.groupBy(ROW).agg(F.array_sort(F.collect_set("reason")).alias("__more"))
    faults = materialize(faults, f"faults-{name}")
    by_itself = F.size("__reasons") > 0
    passed = typed.filter(~by_itself).join(faults, ROW, "left_anti").select(*table.columns)
    failed = typed.join(faults, ROW, "left").filter(by_itself | F.col("__more").isNotNull()).select(
        F.col("__text").alias("row"),
        F.array_join(F.concat("__reasons", F.coalesce("__more", F.array().cast("array<string>"))), ", ").alias("reasons"),
    )
    failed.write.mode("overwrite").parquet(f"{root}/rejected/{name}/batch_id={batch_id}")
    passed.write.mode("overwrite").parquet(f"{root}/tables/{name}/batch_id={batch_id}")


def _follow(spark: SparkSession, csv_root: str, root: str, name: str) -> None:
    """Take the files of one table that are not in its log yet."""
    path = f"{csv_root}/{name}"
    if not any(f.endswith(".csv") for f in file_names(spark, path)):
        return
    names = csv_header(spark, path)
    unknown = set(names) - set(TABLES[name].columns)
    if unknown:
        raise ValueError(f"{path}: columns not in the table: {', '.join(sorted(unknown))}")
    schema = StructType([StructField(c, StringType()) for c in (*names, CORRUPT)])
    stream = (
        spark.readStream.schema(schema)
        .options(**DIALECT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .option("nullValue", ABSENT)
        .option("emptyValue", "")
        .csv(path)
    )
    writer = stream.writeStream.foreachBatch(partial(_take, root, name))
    writer.option("checkpointLocation", f"{root}/taken/{name}").trigger(availableNow=True).start().awaitTermination()


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(sequence, table_name, last_batch) of all versions."""
    path = f"{root}/loads"
    if not file_names(spark, path):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).parquet(path)


def load_new(spark: SparkSession, csv_root: str, root: str) -> int:
    """Take all new files below ``csv_root``, one folder per table, and return the version in force then.

    Without new files the version stays what it was. Run one load at a time.
    """
    for level in _levels():
        # the tables of a level do not depend on each other
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda name: _follow(spark, csv_root, root, name), level))
    known = versions(spark, root)
    before = known.agg(F.max("sequence")).first()[0] or 0
    # one row a table
    in_force = {r["table_name"]: r["last_batch"] for r in known.filter(F.col("sequence") == before).collect()}
    now = {name: _last(spark, root, name) for name in TABLES}
    if before and now == in_force:
        return before
    entry = spark.createDataFrame([(before + 1, name, last) for name, last in now.items()], VERSIONS)
    entry.coalesce(1).write.mode("append").parquet(f"{root}/loads")
    return before + 1


def read_version(spark: SparkSession, root: str, sequence: int | None = None) -> Shop:
    """The tables of a version, the latest by default, with stock counted from the lines."""
    known = versions(spark, root)
    if sequence is None:
        sequence = known.agg(F.max("sequence")).first()[0]
    last = {r["table_name"]: r["last_batch"] for r in known.filter(F.col("sequence") == sequence).collect()}
    if not last:
        raise FileNotFoundError(f"no version {sequence} in {root}")
    shop = Shop({name: partial(_stored, spark, root, name, last[name]) for name in TABLES})
    return shop.replace(products=recompute_stock(shop))


def rejected(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of a table that were kept aside: the row as JSON, the reasons and the batch."""
    path = f"{root}/rejected/{name}"
    schema = "row STRING, reasons STRING, batch_id BIGINT"
    if not file_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
