"""Spark session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job of the library assumes (see README "Session").
REQUIRED_CONF = {
    # Strict casts: an unparseable business date fails the job (contract rule).
    "spark.sql.ansi.enabled": "true",
    # Timestamps are UTC end to end (timestamptz columns of the contract).
    "spark.sql.session.timeZone": "UTC",
    # A daily load replaces only the dt partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A path value like location_id=007 must stay a string.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn a sort-merge join into a broadcast join when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partitioned writes pay a fixed cost per output file; keep small inputs
    # spread over the cores instead of coalescing them into one writer task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(master: str | None = None, app_name: str = "dailylake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system / object store); a
    machine-local folder would vanish with the executor. Only a local-mode
    session without the setting (tests, the driver's checks) gets a folder
    under the system temp directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="dailylake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for a Spark application.

    The modules go as one archive through the shared folder, so nothing need be
    installed on the executors, and jobs can start from any folder.
    """
    sc = spark.sparkContext
    if getattr(sc, "_dailylake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(here)))
    path = f"{scratch_path(spark, 'package')}/dailylake.zip"
    write_bytes(spark, path, held.getvalue())
    sc.addPyFile(path)
    sc._dailylake_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def folder_names(spark: SparkSession, path: str, files: bool = False, older_than_ms: float | None = None) -> list[str]:
    """Names of the folders (or files) in ``path``: one listing, none if the path is not there."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() != files
                  and (older_than_ms is None or s.getModificationTime() < older_than_ms))


def rename_path(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a file to a name that must not exist yet; False if another one has it."""
    jvm = spark._jvm
    fs, source = _path(spark, old)
    target = jvm.org.apache.hadoop.fs.Path(new)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), none)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file of the driver; fails if it is there."""
    fs, p = _path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _path(spark, path)
    source = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library (scratch output, an emptied partition)."""
    fs, p = _path(spark, path)
    fs.delete(p, True)
