"""Session helpers: building a local session for tests/bench and finding the shared folder.

On a cluster the session is built by the caller; this module only *reads* its settings.
The shared folder for staged files and lineage cuts is `spark.checkpoint.dir`; a private
one is set only when the session has none (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sizing defaults for the local runs. On a cluster the deployment sets these.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cpus: int | str = "*", app: str = "sparkdesk", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a private one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no context: use the configured folder
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="sparkdesk-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (the parent of Spark's per-application checkpoint folder)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "sparkdesk", *parts])


def fresh_shared_path(spark: SparkSession, prefix: str) -> str:
    return shared_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def local_fs_path(path: str) -> str:
    """Strip a file: scheme so Python code in tasks can open a path on a local or mounted filesystem."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never localCheckpoint: executors may be lost)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read again. Unlike a checkpoint, whose planned size is the one its
    plan had, the table's size is that of its files: in a loop of joins the planned size does not multiply from round to round."""
    path = fresh_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fits(df: DataFrame, max_rows: int) -> bool:
    """Size check before a broadcast or a driver-side collect: stops after max_rows + 1 rows."""
    return df.limit(max_rows + 1).count() <= max_rows


# Inputs planned larger than this have scan tasks enough of their own.
SMALL_BYTES = 256 << 20


def spread_small(df: DataFrame, key: str | None = None) -> DataFrame:
    """Before CPU-heavy per-row work: a small input (often a single scan task) is spread over all
    slots; a large input keeps its partitions,
    so this costs nothing at scale. Streaming inputs are left alone."""
    if df.isStreaming:
        return df
    if getattr(df, "_jdf", None) is None:  # a remote session: leave the plan as it is
        return df
    slots = df.sparkSession.sparkContext.defaultParallelism
    # planned size of the input in bytes; nothing runs for it
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL_BYTES:
        return df
    return df.repartition(slots, key) if key else df.repartition(slots)


def task_slots(spark: SparkSession) -> int:
    """Parallel task slots of the cluster (falls back to the shuffle partition count)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sparkdesk`` importable in the Python workers of this application: the package is
    zipped once into the shared folder and added with ``addPyFile`` (Spark copies it to every
    executor). Not needed when the package is installed on the cluster's Python."""
    import io
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # remote session: the package must be installed where the workers run
        return
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    zf.write(full, os.path.join("sparkdesk", os.path.relpath(full, root)))
    from .sources.blobs import _fs

    target = shared_path(spark, f"pkg-{uuid.uuid4().hex[:8]}", "sparkdesk.zip")
    fs, inner = _fs(target)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(inner, compression=None) as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(target)
    _SHIPPED.add(app)
