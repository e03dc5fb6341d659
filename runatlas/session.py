"""Session set-up and the shared workspace folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_WORKSPACES: dict[str, str] = {}
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app_name: str = "runatlas", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew handling and UTC timestamps."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Without call sites in error messages, building a plan takes a fifth of the time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    It lies under ``spark.checkpoint.dir``. Only a local master may go without
    that setting; a cluster must name a folder every executor can reach.
    """
    app_id = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/runatlas/{app_id}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app_id not in _LOCAL_WORKSPACES:
        _LOCAL_WORKSPACES[app_id] = tempfile.mkdtemp(prefix="runatlas-")
    return _LOCAL_WORKSPACES[app_id]


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each job's shuffle files go when it ends, not when the driver happens to collect its plan.

    For jobs that write tables: what reads them later starts from the tables. A plan that runs again shuffles again.
    """
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage and gives true statistics."""
    with freed_shuffles(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an input out to all cores if it has fewer splits than there are cores.

    A large input has more splits than that and passes unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
