"""Session helpers: building a local session for tests and finding the shared
folder for checkpoints and written tables.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; without that
setting it is an error there, and a temporary folder in local mode.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stationkit", memory: str = "8g") -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", memory)
    # catalog tables of local runs carry an explicit path in the shared
    # folder; keep the default database folder out of the working directory
    b = b.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="stationkit-warehouse-"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and every executor see, as a URI or path.

    The cluster names it in ``spark.checkpoint.dir`` (or a checkpoint folder
    was set on the context).  A temporary folder of this machine is made only
    in local mode, where all tasks run here; elsewhere its absence is an error."""
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf
    current = sc.getCheckpointDir()
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster, intermediate tables need a folder "
            "shared by the driver and all executors")
    made = tempfile.mkdtemp(prefix="stationkit-ckpt-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set the context's checkpoint folder to the shared one, if it has none."""
    folder = shared_folder(spark)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


# tables written by this application: (application id, path)
_WRITTEN: list[tuple[str, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path inside the shared folder for written intermediate tables."""
    path = f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append((spark.sparkContext.applicationId, path))
    return path


def drop_written_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables that this application wrote, and return
    how many there were.  Frames that still read one of them end with it, so
    call this after the results are written."""
    app = spark.sparkContext.applicationId
    mine = [p for a, p in _WRITTEN if a == app]
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in mine:
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    _WRITTEN[:] = [(a, p) for a, p in _WRITTEN if a != app]
    return len(mine)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Queries that run inside give up their shuffle files when they end; else
    these stay until the driver happens to collect garbage, beside the table
    that was written from them."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df, name: str = "lineage"):
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Later jobs read the written data, and a lost executor does not send them
    back through the whole plan.  Unlike an RDD ``checkpoint()``, which runs
    the plan once for the action and again to write the files unless the
    frame is cached, this computes the plan once.  The table is columnar, so
    later filters and projections are pushed into its scan."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
