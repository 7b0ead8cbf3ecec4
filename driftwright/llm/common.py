"""Helpers shared by the corpus operators: table access, durable intermediates, worker caches."""

from __future__ import annotations

import atexit
import ctypes
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a slice that leaves a Python worker at once; bounds the memory of long texts.
SLICE_ROWS = 512

#: Bytes of an Arrow batch between the JVM and a Python worker, where the session leaves the default.
BATCH_BYTES = 4 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

_folders: dict[str, str] = {}
_memos: dict[str, Callable[[], None]] = {}
_shipped: set[str] = set()


def claim(name: str, give_up: Callable[[], None] = lambda: None) -> None:
    """Called where an operator begins work in a Python worker, which Spark keeps for later stages: what every other
    operator remembers there is given up, and its memory goes back to the system."""
    others = [forget for other, forget in _memos.items() if other != name]
    _memos.clear()
    _memos[name] = give_up
    if others:
        for forget in others:
            forget()
        trim()


def trim() -> None:
    """Memory that is free in this process goes back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, after which the worker, idle or kept for another stage, holds no free memory."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return work


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application; on a cluster they may not have it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    if spark.conf.get(_BATCH) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="driftwright-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one where it is unset and all is one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = "file://" + tempfile.mkdtemp(prefix="driftwright-")
    return _folders[app]


def stash(df: DataFrame, partitions: Sequence[str] = (), dictionary: bool = True) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, survives lost executors, and is computed once. The files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/driftwright-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd").option("parquet.enable.dictionary", str(dictionary).lower())
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stash(df: DataFrame) -> None:
    """Remove the files of a stashed table that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/driftwright-" in folder:
            _remove(df.sparkSession, folder)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the JVM may be gone at exit
        return


def clean(text: Column | str) -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_remainder(doc_id: Column) -> Column:
    """crc32 of the id written as text, modulo 4; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def slices(batches: Iterator, rows: int = SLICE_ROWS) -> Iterator:
    """Arrow batches cut into slices of a bounded number of rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
