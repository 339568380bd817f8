"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the tests and the bench share."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # plans are built from many small expressions; their call sites are not needed
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    A cluster names a shared folder in ``spark.checkpoint.dir``; only a local
    master may fall back to a temporary folder, since its executors share the
    driver's disk.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_DIR} to a folder that every executor can reach"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
    return context.getCheckpointDir()


# Folders this process has handed out, for drop_scratch.
_HANDED_OUT: list[str] = []
# Small tables stored once and used by many plans; they go with the scratch folders.
SHARED: dict[tuple, DataFrame] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _HANDED_OUT.append(path)
    return path


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system of ``path`` and the path as its objects."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds; none if it does not exist."""
    files, target = file_system(spark, folder)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this process.

    Call it when no DataFrame built so far is needed any more.
    """
    SHARED.clear()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _HANDED_OUT:
        path = hadoop.Path(_HANDED_OUT.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Used where a plan must not be evaluated twice with different outcomes
    (slice numbers) or where several branches reuse one expensive result. The
    files survive the loss of executors, so nothing upstream is recomputed.
    """
    return materialize_measured(df, label)[0]


def materialize_measured(df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize`, plus aggregates taken while the rows are written."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if not measures:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), {}
    observation = Observation()
    df.observe(observation, *measures).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), observation.get
