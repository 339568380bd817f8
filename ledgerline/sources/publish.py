"""All-or-nothing loads: stage, validate, then publish a version.

Tables are written to a new version folder and checked there. Only when no rule
is violated does the version enter the manifest, in one appended file. Readers
take the latest version of the manifest, so they see the whole old load or the
whole new one, and a failed load leaves nothing behind that they could read. A load that died while
publishing blocks nobody for long: its claim on the next number grows old, and a later load takes
over. :func:`prune` removes versions that are no longer needed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import TABLES, Shop
from ledgerline.operators.quality import rule_counts
from ledgerline.plans.marts import recompute_stock
from ledgerline.session import file_names, file_system, materialize
from ledgerline.sources.csv import read_tables

# Seconds after which an unfinished load counts as dead.
STALE_AFTER = 3600.0

MANIFEST_SCHEMA = "version STRING, sequence BIGINT, published_at TIMESTAMP"

# The column each fact table is sorted by, for min/max pruning of files and row
# groups. The key follows, so that a frequent value spreads over many files.
CLUSTER_BY = {
    "restock_items": ["product_id", "restock_item_id"],
    "transactions": ["transaction_date", "transaction_id"],
    "transaction_items": ["transaction_id", "transaction_item_id"],
    "credit_payments": ["customer_id", "payment_id"],
}


class ValidationError(ValueError):
    """A load broke at least one rule."""


class ConflictError(RuntimeError):
    """Another load was published or is being published in between."""


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    if not file_names(spark, f"{root}/manifest"):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/manifest")


def _claim(spark: SparkSession, root: str, sequence: int, stale_after: float) -> str:
    """Take a sequence number for this publisher; the file system lets only one have it.

    A claim older than ``stale_after`` seconds was left by a publisher that died. The next attempt
    at its number is a file of its own, so again only one publisher gets it.
    """
    attempt = 0
    while True:
        path = f"{root}/claims/{sequence}-{attempt}"
        files, target = file_system(spark, path)
        if files.createNewFile(target):
            return path
        age = time.time() - files.getFileStatus(target).getModificationTime() / 1000
        if age < stale_after:
            raise ConflictError(f"another load has taken number {sequence} {age:.0f} seconds ago")
        attempt += 1


def _still_held(spark: SparkSession, claim: str) -> bool:
    """Whether nobody took the claim over because this publisher was slow."""
    head, attempt = claim.rsplit("-", 1)
    files, target = file_system(spark, f"{head}-{int(attempt) + 1}")
    return not files.exists(target)


def current_version(spark: SparkSession, root: str) -> tuple[str, int] | None:
    """Name and sequence number of the latest published version."""
    manifest = _manifest(spark, root)
    row = None if manifest is None else manifest.agg(
        F.max(F.struct("sequence", "version")).alias("last")
    ).first()
    if row is None or row["last"] is None:
        return None
    return row["last"]["version"], row["last"]["sequence"]


def _read(spark: SparkSession, folder: str, names: Iterable[str] = TABLES) -> dict[str, DataFrame]:
    return {
        name: spark.read.schema(TABLES[name].schema).parquet(f"{folder}/{name}") for name in names
    }


def read_published(spark: SparkSession, root: str) -> Shop:
    """The tables of the latest published version."""
    current = current_version(spark, root)
    if current is None:
        raise FileNotFoundError(f"nothing published in {root}")
    return Shop(_read(spark, f"{root}/versions/{current[0]}"))


def _write(df: DataFrame, path: str, cluster_by: list[str] | None) -> None:
    if cluster_by is not None:
        # range bounds come from a sample of the stored rows, so no source is read twice
        df = materialize(df, "staged")
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    files, target = file_system(spark, folder)
    files.delete(target, True)


def prune(spark: SparkSession, root: str, keep: int = 2, stale_after: float = STALE_AFTER) -> list[str]:
    """Delete the folders of all versions but the last ``keep``, and of loads that never finished.

    Folders younger than ``stale_after`` seconds may belong to a load that is running, and stay.
    Readers of a version that is deleted fail, so keep as many as are being read.
    """
    manifest = _manifest(spark, root)
    # one row a load
    published = [] if manifest is None else manifest.orderBy(F.desc("sequence")).select("version").collect()
    kept = {r["version"] for r in published[:keep]}
    gone = []
    for name in file_names(spark, f"{root}/versions"):
        files, target = file_system(spark, f"{root}/versions/{name}")
        age = time.time() - files.getFileStatus(target).getModificationTime() / 1000
        if name not in kept and age >= stale_after:
            files.delete(target, True)
            gone.append(name)
    return sorted(gone)


def publish(shop: Shop, root: str, stale_after: float = STALE_AFTER) -> str:
    """Load ``shop`` as a new version and return its name.

    The stored stock count is recomputed once from the staged lines. Raises
    :class:`ValidationError`, publishing nothing, if any rule is violated, and
    :class:`ConflictError` if another load was published in the meantime.
    Loading the same data again publishes an equal version. A load that fails deletes what it
    staged; one that died leaves a folder to :func:`prune` and a claim that others may take over
    after ``stale_after`` seconds.
    """
    spark = shop.products.sparkSession
    version = uuid.uuid4().hex
    folder = f"{root}/versions/{version}"
    try:
        _stage_and_publish(shop, root, version, folder, stale_after)
    except Exception:
        _delete(spark, folder)
        raise
    return version


def _stage_and_publish(shop: Shop, root: str, version: str, folder: str, stale_after: float) -> None:
    spark = shop.products.sparkSession
    previous = current_version(spark, root)
    others = [(name, df) for name, df in shop.tables() if name != "products"]

    def stage(table: tuple[str, DataFrame]) -> None:
        name, df = table
        _write(df.select(*TABLES[name].columns), f"{folder}/{name}", CLUSTER_BY.get(name))

    # the tables do not depend on each other; small ones need not wait for large ones
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(stage, others))
    products = shop.products.select(*TABLES["products"].columns)
    staged = _read(spark, folder, [name for name, _ in others])
    loaded = Shop({**staged, "products": products})
    _write(recompute_stock(loaded), f"{folder}/products", None)

    broken = rule_counts(_read(spark, folder)).filter("n_violations > 0")
    # one row per declared rule at most
    problems = [f"{r.table_name} {r.rule}: {r.n_violations}" for r in broken.collect()]
    if problems:
        raise ValidationError("; ".join(sorted(problems)))
    sequence = 1 if previous is None else previous[1] + 1
    claim = _claim(spark, root, sequence, stale_after)
    entry = spark.range(1).select(
        F.lit(version).alias("version"),
        F.lit(sequence).cast("bigint").alias("sequence"),
        F.current_timestamp().alias("published_at"),
    )
    if not _still_held(spark, claim):
        raise ConflictError(f"another load has taken over number {sequence}")
    entry.coalesce(1).write.mode("append").parquet(f"{root}/manifest")


def load_csv(spark: SparkSession, csv_root: str, root: str) -> Shop:
    """Load a folder of CSV tables as a new version and return what was published."""
    publish(Shop(read_tables(spark, csv_root)), root)
    return read_published(spark, root)
