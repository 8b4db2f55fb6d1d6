"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "canopy") -> SparkSession:
    """A local session for tests and the bench; a cluster job passes its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CANOPY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; a cluster session without it is refused, because executors
    could not see each other's files.  Only a local session (one machine)
    gets a fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="canopy-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``canopy`` importable in Python workers (pandas UDF steps).

    Zips the package the driver imported and registers it with
    ``addPyFile`` once per SparkContext -- the same as ``--py-files``; Spark
    copies it to every executor, so nothing depends on the executors'
    working directory or a shared local path.
    """
    import zipfile

    import canopy

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(canopy.__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="canopy-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path below the shared checkpoint folder (model saves, tables)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/canopy-{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` written below the shared checkpoint folder (in folders ``by`` columns) and read again: computed once, by any number of readers."""
    path = scratch_path(df.sparkSession, kind)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch path of this session (never anything outside the checkpoint folder)."""
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/"
    if not path.startswith(root):
        raise ValueError(f"not below {root}: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
