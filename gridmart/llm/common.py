"""Small helpers shared by the corpus operators.

Scratch tables: lineage is cut by writing Parquet under the shared checkpoint
folder (``spark.checkpoint.dir``), so a lost executor never loses rows that a
later step needs and every reader sees the same rows.
"""

from __future__ import annotations

import gc
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.session import checkpoint_dir

# The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = "\\x20\\x09-\\x0D"
WORD_PATTERN = f"[^{SPACE_CLASS}]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Scratch:
    """Tables of one run, in a folder of its own under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Deletes a table of this run that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
            if f"/{self.root.rsplit('/', 1)[1]}/" in f:
                path = jvm.org.apache.hadoop.fs.Path(f)
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def settle(self) -> None:
        """Spark deletes the shuffle files of steps that have ended once the driver has collected their plans, which a driver with memory
        to spare does late; a job of many steps asks for it in between."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bounds what one Arrow batch of whole texts can hold, for the Python stages that follow."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is.  Texts without a character outside
    ASCII take the cheaper ``lower``, which is the same for them."""
    return F.when(text.rlike("[^\\x00-\\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def global_rank(df: DataFrame, by: list[str], name: str, scratch: Scratch) -> DataFrame:
    """Adds ``name``: the position of each row from 0 in the order of ``by``, without one task that
    sees all rows.  ``by`` must tell the rows apart.

    Rows are range-partitioned and sorted, numbered inside their partition, and moved on by
    the number of rows in the partitions before theirs: one count per partition, which is the
    only thing that is broadcast.
    """
    local = scratch.write(
        df.repartitionByRange(*by).sortWithinPartitions(*by).select(
            "*", F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), name)
    counts = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    return (local.join(F.broadcast(running_total(counts, "_part", "_n", "_offset")), "_part")
            .withColumn(name, F.col("_at") + F.col("_offset")).drop("_part", "_at", "_offset"))


def running_total(parts: DataFrame, part: str, n: str, name: str) -> DataFrame:
    """``part`` and ``name``: the sum of ``n`` over the parts before.  One row a partition of a job, so one task orders them."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(name))
