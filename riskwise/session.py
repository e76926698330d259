"""Session helpers.

The library itself only *uses* the caller's session.  ``local_session`` exists for
tests, the bench and the command line; ``shared_dir`` finds the cluster's shared
folder (``spark.checkpoint.dir``) for checkpoints, stream state and written tables.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame, SparkSession

FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskwise")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The session's SparkContext; None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except PySparkAttributeError:
        return None


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per context.

    Python functions of the library are pickled by reference, so tasks must be able to
    import it.  With the package installed on the executors this changes nothing.
    """
    sc = _context(spark)
    if sc is None or getattr(sc, "_riskwise_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # else the package itself came as an archive
        folder = tempfile.mkdtemp(prefix="riskwise-package-")  # the driver serves it while it lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, f"riskwise-{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(archive)
    sc._riskwise_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set and is used as is.  Only a local master (tests), where
    driver and executors are one process, gets a fresh folder of its own, removed at exit.
    """
    ship(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="riskwise-ckpt-", dir=os.environ.get("RISKWISE_TMP"))
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
        if sc is not None:
            sc.setCheckpointDir(path)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder (never a machine-local temp dir)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside give back the disk of their shuffles when they end, not when the driver collects garbage.

    For steps whose result is a checkpoint, a written table or a few values; a DataFrame that is run
    again should not be made inside.
    """
    before = spark.conf.get(FREES_SHUFFLES, None)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREES_SHUFFLES)
        else:
            spark.conf.set(FREES_SHUFFLES, before)


def saved(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: lineage ends there, and a lost executor costs no more than it.

    The disk of the shuffles that made it is free afterwards.
    """
    shared_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)     # the setting holds for DataFrames made under it


def written(df: DataFrame, name: str, **options: int) -> DataFrame:
    """The rows, read from a table written in a fresh sub-folder of the shared folder; disk as in ``saved``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.select("*").write.options(compression="zstd", **options).parquet(path)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table; Catalyst prunes columns and pushes filters into the scan."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
