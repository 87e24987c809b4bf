"""Spark session helpers.

The library never creates its own cluster settings for production: it reads
what the session already has. ``local_session`` is for tests, benches and the
driver smoke check only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the operators rely on: AQE re-plans joins at runtime (broadcast only
# once the real size of a fitted table is known, split skewed partitions), and
# the session time zone is pinned so timestamp-derived values are portable.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def _default_driver_memory() -> str:
    """About 60 % of the machine's memory, between 1 and 16 GB (local mode runs
    everything in the driver JVM)."""
    try:
        with open("/proc/meminfo") as f:
            total_kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal:"))
        mb = int(total_kb / 1024 * 0.6)
    except (OSError, StopIteration, ValueError):
        mb = 4096
    return f"{max(1024, min(mb, 16384))}m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sextant") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SEXTANT_DRIVER_MEMORY", _default_driver_memory()))
    )
    for k, v in _SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder. On a cluster it must be the
    shared folder named in ``spark.checkpoint.dir`` (an error otherwise); only
    a local-mode session without one (tests) gets a scratch folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would not survive executor loss on a cluster
        raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
    path = tempfile.mkdtemp(prefix="sextant-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df, how: str = "parquet"):
    """Materialise ``df`` in the shared checkpoint folder and return the re-read
    frame: the plan of later steps starts from these files, and the files
    survive executor loss (unlike a local checkpoint or a cache).

    ``how='parquet'`` writes a columnar table under the checkpoint folder
    (faster than the row-serialising RDD checkpoint); ``'checkpoint'`` uses
    ``DataFrame.checkpoint``."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    path = root.rstrip("/") + f"/sextant-stage-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def fit_tasks(spark: SparkSession, rows: int, rows_per_task: int = 1_000_000) -> int:
    """Tasks for an iterative job over so many rows: one per core, more only if a task
    would get over ``rows_per_task``. Every pass of a fit costs the driver a result per
    task, so the partitions of whatever shuffle made the rows are too many."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def deal_rows(df, key: str, per_core: int = 4):
    """Rows in even partitions by ``key``, in its order: a join on few values leaves all
    rows in as many partitions, and an iterative job on so few cores. The fixed order
    lets draws made row by row repeat."""
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), per_core * spark.sparkContext.defaultParallelism)
    return df.repartition(parts, key).sortWithinPartitions(key)


def fits_at_once(spark: SparkSession, rows: int, most: int, rows_per_core: int = 250_000) -> int:
    """Fits to submit side by side over so many rows: ``most`` while a fit is too small to
    keep the cores busy, down to one when its rows do that. Each running fit holds its own
    binned copy of its rows, so more at once would only spill."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(most, cores * rows_per_core // max(1, rows)))


def release_caches(spark: SparkSession) -> None:
    """Drop every cached intermediate (value counts for percentiles, fold
    inputs, token tables). Operators cache what they read twice; a long-lived
    session calls this between independent jobs. Results stay correct if a
    cache is dropped early: Spark recomputes it from its lineage."""
    spark.catalog.clearCache()


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application, so that
    functions run in tasks can import it wherever the workers start."""
    sc = spark.sparkContext
    with _SHIPPING:
        if sc.applicationId in _SHIPPED:
            return spark
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(root)}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for f in names:
                    if f.endswith(".py"):
                        full = os.path.join(folder, f)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark
