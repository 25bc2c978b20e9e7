"""Incremental landing of newly arrived files with Structured Streaming.

The pipeline runs once a day.  Instead of re-reading every landed file on each
run, ``land_incremental`` processes only the files that arrived since the last
run: a file-source stream with ``trigger(availableNow=True)`` picks up new files,
applies a bronze transformation, appends to the bronze table through Spark's
file sink (exactly-once, tracked in the sink's metadata log) and stops.  The
checkpoint remembers which files were taken, so a rerun after a failure neither
skips nor duplicates a file.  It belongs to the target: by default it lies inside
it, and a target that has more batches than the checkpoint knows is refused, since
the sink would take the next batches for ones it already has.  No file is too old
to be taken: Spark's age limit, by which files older than a week against the
newest are passed over, is lifted.

The transformation must be row-wise (select/filter/withColumn), e.g.
``lambda df: ingest_long(df, run_ts, entities)``.
"""

from __future__ import annotations

from collections.abc import Callable

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

NO_AGE_LIMIT = "36500d"


def _last_batch(spark: SparkSession, folder: str) -> int:
    """Highest batch number in a streaming log folder; -1 without one."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return -1
    names = [f.getPath().getName().split(".")[0] for f in fs.listStatus(path)]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def land_incremental(spark: SparkSession, source_dir: str, schema: StructType | str, target_dir: str,
                     checkpoint: str | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "csv", options: dict | None = None,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append newly landed files under ``source_dir`` to the Parquet table at
    ``target_dir``; returns the (finishing) query.  ``checkpoint`` must be on
    shared storage; by default it is the folder ``_checkpoint`` of the target."""
    if checkpoint is None:
        checkpoint = os.path.join(target_dir, "_checkpoint")
    taken, known = (_last_batch(spark, os.path.join(target_dir, "_spark_metadata")),
                    _last_batch(spark, os.path.join(checkpoint, "offsets")))
    if taken > known:
        raise ValueError(f"{target_dir} holds batch {taken}, but checkpoint {checkpoint} ends at {known}; "
                         "new files would be taken for batches that are there already")
    opts = {"maxFileAge": NO_AGE_LIMIT} | ({"header": "true"} if fmt == "csv" else {})
    opts.update(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = spark.readStream.format(fmt).schema(schema).options(**opts).load(source_dir)
    out = transform(stream) if transform else stream
    return (out.writeStream.format("parquet")
            .option("path", target_dir)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start())


def land_and_wait(*args, **kwargs) -> StreamingQuery:
    """``land_incremental`` and block until the available files are processed."""
    q = land_incremental(*args, **kwargs)
    q.awaitTermination()
    return q
