"""Session settings that the operators rely on, set on whatever session is passed in."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Column names are matched exactly; timestamps have no zone; only the partitions that a write holds are replaced.
SETTINGS = {
    "spark.sql.caseSensitive": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
}
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Give this package to Python workers that do not have it, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="driftwright-core-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's own process."""
    return re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master) is not None


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share: under ``spark.checkpoint.dir``; a temporary one where that is unset and all is
    one machine. It goes when the driver ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root and not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{(root or 'file://' + tempfile.mkdtemp(prefix='driftwright-')).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, folder)
    return folder


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may be gone at exit
        return
