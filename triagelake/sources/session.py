"""Session settings the stages rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

# Documents may repeat a key; the last one counts.  Rows sorted by group are aggregated one group after the other, without a hash map.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.replaceHashWithSortAgg": "true",
}

#: Codec of intermediate tables: texts of reports and replies take half the disk that Spark's usual codec needs.
PACKED = "zstd"

_LOCAL: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; cluster sizing stays with the caller."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """Folder for intermediate tables: ``folder``, or what the cluster names in ``spark.checkpoint.dir``.

    Where neither is given, only a session within one machine (master ``local``) gets a temporary folder; on a cluster other
    executors would not see it, so the job stops with a clear message.
    """
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="triagelake-")
    return _LOCAL[application]


def fresh_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark, folder)}/{name}-{uuid4().hex}"


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    context = spark.sparkContext
    for path in paths:
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
