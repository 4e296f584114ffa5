"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Runtime SQL settings every plan in this package is designed around.
#  * AQE re-plans joins with measured sizes (runtime broadcast only below the
#    threshold), coalesces small shuffle partitions and splits skewed ones.
#  * requireAllClusterKeysForCoPartition=false lets a join on the four frame
#    keys reuse a hash partitioning on the three player keys, so the join and
#    the per-player lag window share one exchange per side.
SESSION_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session."""
    for key, value in SESSION_SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "frametide",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session builder. On a cluster, pass ``master=None`` and let
    spark-submit decide; shuffle partitions should then be sized to the data
    (roughly input bytes / 128 MiB)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SESSION_SQL_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it) or the folder
    already set on the SparkContext. Only a local master may fall back to
    ``fallback`` or a folder under the system temp directory; a cluster
    without a named folder is an error. The SparkContext checkpoint dir is aligned with it
    so ``DataFrame.checkpoint()`` and Spark ML tree checkpointing use it too.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = fallback or os.path.join(os.environ.get("TMPDIR", "/tmp"), "frametide-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/frametide/{name}/{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``frametide`` importable in Python workers (what ``--py-files``
    does for spark-submit): zip the package once per SparkContext and add it
    with ``addPyFile``; Spark distributes it to every executor. Needed only by
    operators that run pandas functions on executors (F1)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="frametide-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
