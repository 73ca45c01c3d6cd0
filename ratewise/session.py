"""Session construction and shared-storage settings."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on.  UTC pins epoch <-> timestamp conversions;
# AQE re-plans joins and coalesces shuffle partitions at runtime, and splits
# skewed join partitions when one key holds a large share of the rows.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def _local_heap() -> str:
    """Local runs only: executors live inside the driver JVM, so the heap is
    sized from physical memory (about 60%, at most 16 GB)."""
    try:
        phys = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(phys * 0.6 / 2**30)))}g"


LOCAL_CONF = {
    "spark.driver.memory": _local_heap(),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ratewise", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, the submitter's session is used
    as-is; only missing settings are filled in by ``ensure_conf``."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if master.startswith("local"):
        conf.update(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the queries depend on: epoch <-> timestamp
    conversions are defined in UTC.  Nothing else of the caller's session
    is changed."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


def checkpoint_dir(spark: SparkSession, sub: str = "") -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` from the session (the cluster's shared
    folder).  Only a local master may go without: a scratch folder is made
    and registered, as in tests.  On any other master executors would write
    to their own disks, so an unset folder is an error there."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc._jsc.sc().getCheckpointDir()
        base = base.get() if base.isDefined() else None
    if not base:
        if not is_single_machine(sc.master):
            raise RuntimeError(f"master {sc.master} needs spark.checkpoint.dir: a folder that the driver "
                               "and all executors share")
        base = tempfile.mkdtemp(prefix="ratewise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    current = sc._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        sc.setCheckpointDir(base)
    if sub:
        return base.rstrip("/") + "/" + sub
    return base


def is_single_machine(master: str) -> bool:
    """True for ``local``, ``local[n]`` and ``local[n,f]``: driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def new_subdir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder under the shared checkpoint folder."""
    return checkpoint_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Kernels are pickled by module reference, so workers must be able to
    import the package even where only the driver has it on its path."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="ratewise-py-")) / f"{root.name}.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(out))
    _SHIPPED.add(sc.applicationId)


def materialize(df, eager: bool = True):
    """Cut lineage of a derived table that several branches of one job read.

    Reliable ``checkpoint()`` into the shared checkpoint folder (survives a
    lost executor, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def has_file(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists, in whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of our own, in whatever store it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
