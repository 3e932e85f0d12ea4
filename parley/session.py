"""Session helpers: shipping code to executors, durable cuts of lineage."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own = ""
#: Bytes of one Arrow batch at most: a batch counts in the JVM and in the Python worker, for each task.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Python workers then import it wherever they run, also those that replace a
    lost executor: the archive lies in the cluster's shared folder. Batches that
    go to them are bounded by their bytes, since texts can be very long.
    """
    sc = spark.sparkContext
    if sc._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH)) > BATCH_BYTES:
        spark.conf.set(BATCH, BATCH_BYTES)
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    package, made = os.path.basename(root), io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    archive = f"{shared_folder(spark)}/{package}-{sc.applicationId}.zip"
    at = sc._jvm.org.apache.hadoop.fs.Path(archive)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(made.getvalue()))
    out.close()
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only on one machine a temporary one may stand for it."""
    global _own
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own:
        _own = tempfile.mkdtemp()
        atexit.register(shutil.rmtree, _own, True)
    return _own


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared checkpoint folder and go on from there.

    The folder is the cluster's own; see ``shared_folder``.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this engine wrote to the shared one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
