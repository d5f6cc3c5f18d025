"""Session set-up and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call sites in error messages cost more time than building the plans themselves
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# temporary folders of local applications that name none
_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "sessionloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates are cut in the session zone, so results only repeat with a stated zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can see, as named by the cluster.

    Only a local master may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="sessionloom-")
    return _LOCAL_DIRS[app]


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the driver remove a folder of intermediate data when it ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    store.deleteOnExit(target)


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder in the shared one, which the driver removes when it ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    delete_on_exit(spark, path)
    return path


def written_once(df: DataFrame) -> DataFrame:
    """A result several later steps need, as a table in the shared folder.

    Unlike cached blocks it outlives the executors that computed it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "written")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
