"""Session factory and the two helpers every long job needs: a shared work folder and a lineage cut."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIR: list[str] = []
_WRITTEN: list[str] = []


def build_session(app: str = "chronofact", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (ANSI, UTC, AQE, dynamic partition overwrite)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's checkpoint directory.

    A temporary folder of this machine is made only where the session names none (tests on one machine).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _LOCAL_DIR:
        _LOCAL_DIR.append(tempfile.mkdtemp(prefix="chronofact-"))
        atexit.register(shutil.rmtree, _LOCAL_DIR[0], ignore_errors=True)
    return f"file://{_LOCAL_DIR[0]}"


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here and lost executors cost nothing before it.

    Parquet is written rather than an RDD checkpoint since it is columnar, compressed and pruned on reading.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_clear, os.getpid())
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> int:
    """Remove the tables that `cut` has written so far, on whatever file system they are; frames read from them are dead
    afterwards. Long-lived drivers call this between jobs. Number of tables removed."""
    n = 0
    while _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def _clear(pid: int) -> None:
    """When the driver ends, remove what is left: through the session while it lives, else on mounted folders."""
    if os.getpid() != pid:
        return
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None:
            clear_work(spark)
    except Exception:  # noqa: BLE001  the JVM has gone first
        pass
    for path in _WRITTEN:
        local = path.removeprefix("file://")
        if local.startswith("/"):
            shutil.rmtree(local, ignore_errors=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per session: they need not share the driver's import path."""
    if getattr(spark.sparkContext, "_chronofact_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="chronofact-zip-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = shutil.make_archive(os.path.join(folder, "chronofact"), "zip", os.path.dirname(package), os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    spark.sparkContext._chronofact_shipped = True
