"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "tablewright", **conf: str) -> SparkSession:
    """Session with the settings the library expects; all may be overridden."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.caseSensitive": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A machine-local folder is only made for a local master, where the one
    machine is the whole cluster.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


_WRITTEN: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never used twice."""
    path = f"{scratch_root(spark)}/tablewright/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear_stages(spark: SparkSession) -> int:
    """Delete what this process has written under the shared folder; returns how many stages that were.

    For callers that have written their results elsewhere: frames that read a
    stage can't be used any more.
    """
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt evenly to as many tasks as there are cores, or more if there is much to deal.

    For rows that take long each: files that compress well, or can't be split, come in few tasks.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance")
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage so that a lost executor costs one re-read, and unlike a
    checkpointed RDD the columnar copy lets each later profile read only the
    columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
