"""Session settings and the shared checkpoint folder.

Library code never builds its own session; it takes the caller's.  The
helpers here are for tests, the bench and local runs, plus one accessor for
the lineage-cutting folder that the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants: adaptive execution re-plans joins from runtime
# sizes (broadcast only below the threshold, sort-merge above), splits skewed
# shuffle partitions and coalesces tiny ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidepanel") -> SparkSession:
    """Local session for tests and the bench (not used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote (Connect) session has none
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared file system);
    we only fill it in ourselves for a local-mode session with nothing set,
    as tests and the bench do.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is "
                           "required to cut lineage on a cluster")
    d = tempfile.mkdtemp(prefix="tidepanel-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
    return d


def session_key(spark: SparkSession) -> str:
    """Identifier of the running application (for per-session memos)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written tables."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage by writing a parquet table into the shared checkpoint
    folder and reading it back.

    Compared with ``DataFrame.checkpoint`` (serialized rows that keep the
    producing plan's partition count) the written table is columnar: later
    reads prune columns, push filters down and split by file size, and it
    survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidepanel`` importable in Python workers (once per session).

    Operators that run pandas code inside tasks (``mapInPandas``) pickle
    their functions by module reference; executors need the package.  The
    driver zips the package on its own disk and hands the file to
    ``addPyFile``: Spark copies it to every executor and puts it on the
    workers' path, so no shared folder is involved.
    """
    key = session_key(spark)
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="tidepanel-zip-"), "tidepanel.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.join("tidepanel", os.path.relpath(full, pkg_dir)))
    sc = _context(spark)
    if sc is not None:
        sc.addPyFile(target)
    else:
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(key)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Sizing for a cluster run (pass to ``SparkSession.builder.config``).

    Shuffle partitions: enough that each holds about ``target_partition_bytes``
    of the largest shuffle (bounded below by two waves of cores); AQE then
    coalesces small ones and splits skewed ones.  File splits use the same
    target so scan tasks and shuffle tasks are alike.
    """
    parts = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        **{k: v for k, v in BASE_CONF.items() if k != "spark.ui.showConsoleProgress"},
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
