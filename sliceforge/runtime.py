"""Session helpers: table paths, shared storage and shipping the package to executors."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
#: Bytes of rows that Spark hands a Python worker at once; both sides hold a batch whole.
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"
_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; any store that Spark reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (their path may not have it).

    Rows go to Python in batches of ARROW_BYTES from then on, unless the session has a size of its own; by number
    alone, a batch of long texts holds as much as a whole split.
    """
    if _ARROW not in spark.conf.getAll:
        spark.conf.set(_ARROW, str(ARROW_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp()
    archive = os.path.join(folder, "sliceforge_pkg.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)  # copied to the driver's file server, fetched by executors


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a fresh local one, in local mode only."""
    set_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not set_dir:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_dir = f"file://{tempfile.mkdtemp(prefix='sliceforge-')}"
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def drop_path(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with wildcards names, hidden ones included."""
    files, target = _located(spark, pattern)
    found = files.globStatus(target)
    return [] if found is None else [f.getPath().toString() for f in found]


def path_exists(spark: SparkSession, pattern: str) -> bool:
    return bool(matching(spark, pattern))


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder, removed at the end of the session."""
    path = f"{shared_dir(spark)}/sliceforge-{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            return


def materialize(df: DataFrame, tag: str = "t", partition_by: list[str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Drop the files of a table that materialize() wrote and nothing reads any more."""
    for f in df.inputFiles()[:1]:
        for entry in list(_written):
            name = entry[1].rsplit("/", 1)[-1]
            if f"/{name}/" in f:
                drop_path(*entry)
                _written.remove(entry)
