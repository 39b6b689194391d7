"""Session helpers: building a local session for tests and bench, and
finding the shared folder used to cut lineage (checkpoints, pinned tables)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library relies on.  AQE re-plans joins at run
# time: a join side whose measured shuffle output is under the threshold is
# broadcast, anything larger stays a sort-merge join (with skew splitting).
LIBRARY_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # text rows are costly per row but shuffle small (they compress well):
    # keep coalesced partitions small enough to use every core
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(256 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "newsgraph", extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs.  On a cluster, create the
    session as usual and call :func:`configure` on it."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**LIBRARY_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime SQL settings to an existing session."""
    for k, v in LIBRARY_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static or locked settings stay as the cluster set them
            pass
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and pinned tables.

    Read from ``spark.checkpoint.dir``.  Only when it is unset and the
    session is local (tests) is a folder of our own made."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's configuration applies
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="newsgraph-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, grouped per application
    (``<dir>/newsgraph/<application id>/``) so a finished run's
    intermediate tables can be dropped as one folder."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a SparkContext view
        app = spark.conf.get("spark.app.id", "app")
    return os.path.join(shared_dir(spark), "newsgraph", app, f"{name}-{uuid.uuid4().hex[:12]}")


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables from the shared folder.
    Call it when the results are written: plans that read them end here."""
    folder = os.path.dirname(scratch_path(spark, "any"))
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss,
    unlike a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it
    back: later branches of the plan scan the files instead of recomputing
    the lineage (and the planner sees the real size)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove one table of the shared folder."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


class Rounds:
    """Tables of an iterative job in the shared folder, by name.  A name that
    is written again gets a fresh path; ``drop`` removes what later rounds no
    longer read, so a long job keeps its last round and not all of them."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job = spark, job
        self.paths: dict[str, list[str]] = {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back with its schema."""
        path = scratch_path(self.spark, f"{self.job}-{name}")
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str, last: bool = False) -> None:
        """Remove the superseded tables of ``names``, or with ``last`` all of them."""
        for name in names:
            old = self.paths.get(name, [])
            keep = [] if last else old[-1:]
            for path in old[:len(old) - len(keep)]:
                drop_path(self.spark, path)
            self.paths[name] = keep
