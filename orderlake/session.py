"""Spark session helpers.

The library never creates a cluster session on its own: callers pass a
``SparkSession``.  ``local_session`` is for tests, benchmarks and the driver
smoke check; ``ensure_checkpoint_dir`` respects a cluster-provided
``spark.checkpoint.dir`` and only falls back to a scratch folder when none is
configured on a local master.
"""

from __future__ import annotations

import hashlib
import io
import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every session used with the library should carry.  They are
# semantic (time zone, ANSI casts) or planner knobs (AQE) rather than sizing.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # legacy CJK charsets (cp950 / Big5 / GBK) for the CSV reader and decode()
    "spark.sql.legacy.javaCharsets": "true",
}


_REPO_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _export_package_path() -> None:
    """Python workers must import ``orderlake`` (for mapInPandas functions).

    On a cluster the package ships with ``--py-files``; locally the workers
    inherit the driver environment, so the repo root goes on PYTHONPATH.
    """
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _REPO_ROOT not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([_REPO_ROOT] + paths)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "orderlake", extra_conf: dict | None = None) -> SparkSession:
    _export_package_path()
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ORDERLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.executorEnv.PYTHONPATH", os.environ["PYTHONPATH"])
    )
    for k, v in {**SESSION_DEFAULTS, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is used as
    is.  Only a local master with nothing configured (tests, local runs) gets a
    fresh scratch folder; on a cluster executors couldn't read one, so a missing
    setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir and not re.match(r"local(\[|$)", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="orderlake-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the (shared) checkpoint directory for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a name in any store that Spark reaches."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _package_zip() -> bytes:
    buf = io.BytesIO()
    pkg = os.path.join(_REPO_ROOT, "orderlake")
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, _REPO_ROOT))
    return buf.getvalue()


def ship_package(spark: SparkSession) -> str:
    """Make ``orderlake`` importable on executors (mapInPandas / pandas UDFs).

    The package is zipped into the shared checkpoint folder and registered with
    ``addPyFile`` — the programmatic form of ``--py-files``.  Idempotent per
    session and package version.
    """
    sc = spark.sparkContext
    data = _package_zip()
    digest = hashlib.sha1(data).hexdigest()[:12]
    if getattr(sc, "_orderlake_shipped", None) == digest:
        return digest
    target = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pyfiles/orderlake-{digest}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    sc._orderlake_shipped = digest
    return digest


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores`` cores.

    Scan splits and post-shuffle partitions target ~256 MB so a task's working
    set fits executor memory; shuffle partitions start at max(3 × cores,
    input / target) and AQE coalesces or splits from there (skewed partitions
    above 5 × median and 1 GB are split).  Broadcasts stay small (64 MB): the
    library broadcasts dimensions only behind an explicit row-count bound.
    """
    parts = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_settings(spark: SparkSession, settings: dict, only_unset: bool = True) -> None:
    """Set runtime SQL options; by default leaves explicitly configured keys alone."""
    explicit = dict(spark.sparkContext.getConf().getAll())
    for k, v in settings.items():
        if only_unset and k in explicit:
            continue
        spark.conf.set(k, v)
