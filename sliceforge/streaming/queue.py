"""Incremental builds: new queue files are processed once, in micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sliceforge.schemas import QUEUE_DDL


def follow_queue(spark: SparkSession, folder: str, checkpoint: str, process: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Runs `process` on each batch of new entries (JSON lines in `folder`) and stops when all are done.

    The checkpoint remembers which files were processed, so a restart resumes; a batch that failed
    is given again with the same number.
    """
    stream = spark.readStream.schema(QUEUE_DDL).json(folder).filter("patch_id IS NOT NULL")
    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
