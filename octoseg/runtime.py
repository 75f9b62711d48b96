"""Session, tables and staged intermediate results shared by all operators."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STAGED: list[tuple[SparkSession, str]] = []
_SHARED: list = []


def session(name: str = "octoseg", cores: str | int | None = None, master: str | None = None, **conf: str) -> SparkSession:
    """A session on the master that is named, or the one spark-submit brings, or else a local one for tests and benchmarks."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    elif "PYSPARK_GATEWAY_PORT" not in os.environ:
        b = b.master(f"local[{cores or '*'}]").config("spark.driver.memory", os.environ.get("OCTOSEG_DRIVER_MEMORY", "8g"))
        b = b.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; a local one is set only where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        got = spark.sparkContext.getCheckpointDir()
        if not got:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="octoseg-"))
            got = spark.sparkContext.getCheckpointDir()
        base = got
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder, deleted when the process ends."""
    path = f"{shared_dir(spark)}/octoseg-{uuid.uuid4().hex}/{name}"
    _STAGED.append((spark, path))
    return path


def stage(df: DataFrame, name: str = "t", partition_by: list[str] | None = None) -> DataFrame:
    """Write df as parquet into the shared folder and read it back.

    It cuts the lineage like checkpoint(), survives the loss of executors, and later readers still get column
    pruning and pushed filters. Generated ids are stable once a table is staged.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    w = df.write.mode("errorifexists").option("compression", "zstd")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._octoseg_path = path
    return out


def discard(*staged: DataFrame | None) -> None:
    """Delete tables of stage() that nothing reads any more, so that loops keep one round on disk."""
    for df in staged:
        path = getattr(df, "_octoseg_path", None)
        if path:
            _delete(df.sparkSession, path)
            _STAGED[:] = [x for x in _STAGED if x[1] != path]


def share(spark: SparkSession, value: object):
    """A broadcast variable that drop_staged() destroys."""
    v = spark.sparkContext.broadcast(value)
    _SHARED.append(v)
    return v


def hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path on any file system Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p.getParent(), True)


def drop_staged() -> None:
    """Delete what stage() wrote and share() sent in this process; results that still read it can't be computed afterwards."""
    while _STAGED:
        try:
            _delete(*_STAGED.pop())
        except Exception:  # noqa: BLE001  the session may be gone
            pass
    while _SHARED:
        try:
            _SHARED.pop().destroy()
        except Exception:  # noqa: BLE001
            pass


atexit.register(drop_staged)


def small_enough(df: DataFrame, limit_bytes: int = 8 << 20) -> bool:
    """Whether Catalyst's size estimate proves that df may be broadcast."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit_bytes


def broadcast_if_small(df: DataFrame, limit_bytes: int = 8 << 20) -> DataFrame:
    """df with a broadcast hint only behind a check of its size; beyond it the planner picks a shuffled join."""
    return F.broadcast(df) if small_enough(df, limit_bytes) else df


def spread(df: DataFrame, per_core: int = 2) -> DataFrame:
    """df over all cores, if its scan is too small to be split for them; a large table stays as it is scanned."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    small = small_enough(df, cores * (64 << 20))
    return df.repartition(cores * per_core) if small and 0 < len(df.inputFiles()) < cores else df


Query = Callable[[SparkSession, str], DataFrame]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster, once for each Spark context."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or sc.master == "local" or getattr(sc, "_octoseg_shipped", False):
        return
    import zipfile
    from pathlib import Path

    root = Path(__file__).parent
    out = Path(tempfile.mkdtemp(prefix="octoseg-src-")) / "octoseg.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(out))
    sc._octoseg_shipped = True
