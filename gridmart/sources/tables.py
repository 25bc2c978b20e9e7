"""Stored tables whose refresh readers survive.

A table is a folder with one sub-folder for each version and a small pointer file, ``_current``, that names what is valid:

* ``publish`` writes a whole new version beside the old one, then replaces the pointer by one atomic rename.  A
  run that fails half-way leaves a folder that nothing points to; readers go on with the old version.
* ``replace_partitions`` writes a version that holds some partitions only; the pointer then takes those from it and
  the others from where they were.  So a refresh rewrites what it touches, and is as atomic as a full one.
* ``read`` resolves the pointer.  A folder without one is read as it is.

The versions of the current pointer and of the one before it are kept, so that jobs that began before a switch end well;
older ones are deleted by the next switch.  One writer at a time is expected.

With ``table`` the catalog's table of that name follows: its location (and that of each of its partitions) is switched after the
pointer, so queries by name see whole versions, too.  ``buckets`` stores the rows in hash buckets, sorted by the same columns; the catalog
knows them, and joins and groupings of such tables on those columns need no exchange.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_current"


# Hadoop file system calls (any store that Spark can reach)

def hadoop(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path as it names it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file so that readers see the old text or the new one, nothing between."""
    fs, p = hadoop(spark, path)
    _, tmp = hadoop(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, tmp, p)


def rename(spark: SparkSession, source: JavaObject, target: JavaObject) -> None:
    """Moves a file over another one in one step."""
    sc = spark.sparkContext
    kind = sc._jvm.org.apache.hadoop.fs.Options.Rename
    options = sc._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration())
    context.rename(source, target, options)


# Pointers

@dataclass
class Segment:
    folder: str                              # of the version, below the table's folder
    values: list[str] | None = None          # the partition values it serves; None: all that no later segment does


@dataclass
class Pointer:
    fmt: str
    schema: str                              # JSON
    by: list[str]
    segments: list[Segment] = field(default_factory=list)       # oldest first
    before: list[str] = field(default_factory=list)             # folders of the pointer before this one

    def folders(self) -> list[str]:
        return [s.folder for s in self.segments]

    def text(self) -> str:
        return json.dumps({"fmt": self.fmt, "schema": self.schema, "by": self.by, "before": self.before,
                           "segments": [[s.folder, s.values] for s in self.segments]})

    @classmethod
    def parse(cls, text: str) -> Pointer:
        d = json.loads(text)
        return cls(d["fmt"], d["schema"], d["by"], [Segment(*s) for s in d["segments"]], d["before"])


def pointer(spark: SparkSession, path: str) -> Pointer | None:
    text = read_text(spark, f"{path}/{POINTER}")
    return None if text is None else Pointer.parse(text)


def _point(spark: SparkSession, path: str, new: Pointer, old: Pointer | None) -> None:
    """Switches to ``new`` and deletes versions that neither it nor the one before it needs."""
    new.before = old.folders() if old else []
    replace_text(spark, f"{path}/{POINTER}", new.text())
    fs, root = hadoop(spark, path)
    keep = {*new.folders(), *new.before}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v-") and name not in keep:
            fs.delete(status.getPath(), True)


def _segment(spark: SparkSession, path: str, p: Pointer, folder: str) -> DataFrame:
    schema = StructType.fromJson(json.loads(p.schema))
    return spark.read.format(p.fmt).schema(schema).load(f"{path}/{folder}").select(*[f"`{c}`" for c in schema.names])


def read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The current version of a table."""
    p = pointer(spark, path)
    if p is None:
        return spark.read.format(fmt).load(path)
    frames, claimed = [], []
    for s in reversed(p.segments):
        df = _segment(spark, path, p, s.folder)
        if p.by and (claimed or s.values is not None):
            value = F.col(f"`{p.by[0]}`")
            kind = df.schema[p.by[0]].dataType
            typed = [F.lit(v).cast(kind) for v in claimed]
            if s.values is not None:
                wanted = [F.lit(v).cast(kind) for v in s.values if v not in claimed]
                df = df.filter(value.isin(*wanted)) if wanted else df.limit(0)
            elif typed:
                df = df.filter(value.isNull() | ~value.isin(*typed))
            claimed += s.values or []
        frames.append(df)
    return reduce(lambda a, b: a.unionByName(b), frames)


# Writing

def _version() -> str:
    return f"v-{uuid.uuid4().hex}"


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", table: str | None = None,
            buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """A new version of the whole table."""
    spark, folder = df.sparkSession, _version()
    old = pointer(spark, path)
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        if not table:
            raise ValueError("buckets are known to the catalog only: give the table a name")
        n, columns = buckets
        staged = f"{table.replace('`', '')}__{folder[2:]}"
        writer.bucketBy(n, *columns).sortBy(*columns).option("path", f"{path}/{folder}").saveAsTable(staged)
        spark.sql(f"DROP TABLE {staged}")                       # its files stay
    else:
        writer.save(f"{path}/{folder}")
    _point(spark, path, Pointer(fmt, df.schema.json(), list(partition_by), [Segment(folder)]), old)
    if table:
        _register(spark, table, path, pointer(spark, path), buckets)


def replace_partitions(df: DataFrame, path: str, by: str, values: Sequence, table: str | None = None) -> None:
    """The partitions ``values`` of the table (partitioned by ``by``) replaced by the rows of ``df`` that have them.  Other rows of
    ``df`` are not written; a value without rows loses its partition."""
    spark = df.sparkSession
    p = pointer(spark, path)
    if p is None or p.by != [by]:
        raise ValueError(f"{path} is no published table that is partitioned by {by}")
    schema = StructType.fromJson(json.loads(p.schema))
    if any(v is None for v in values):
        raise ValueError("the partition of rows without a value cannot be replaced")
    if not values:
        return
    folder, kind = _version(), schema[by].dataType
    rows = df.filter(F.col(f"`{by}`").isin(*[F.lit(v).cast(kind) for v in values]))
    rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    rows.write.format(p.fmt).partitionBy(by).save(f"{path}/{folder}")
    texts = [str(v) for v in values]
    segments = [Segment(s.folder, None if s.values is None else [v for v in s.values if v not in texts]) for s in p.segments]
    segments = [s for s in segments if s.values is None or s.values] + [Segment(folder, texts)]
    _point(spark, path, Pointer(p.fmt, p.schema, p.by, segments), p)
    if table:
        _register(spark, table, path, pointer(spark, path), None)


def compact(spark: SparkSession, path: str, most: int = 8, table: str | None = None) -> bool:
    """Rewrites a table whose current pointer has more than ``most`` segments as one version; whether it did."""
    p = pointer(spark, path)
    if p is None or len(p.segments) <= most:
        return False
    publish(read(spark, path), path, p.by, p.fmt, table)
    return True


# Catalog

def _partition_folders(spark: SparkSession, path: str, p: Pointer) -> dict[str, str]:
    """The partitions of a table with one partition column: their values as in folder names, and where they are."""
    fs, _ = hadoop(spark, path)
    found: dict[str, str] = {}
    for s in p.segments:                                        # later ones win
        for v in s.values or []:
            found.pop(v, None)
        for status in fs.listStatus(hadoop(spark, f"{path}/{s.folder}")[1]):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(f"{p.by[0]}="):
                value = name.split("=", 1)[1]
                if s.values is None or value in s.values:
                    found[value] = status.getPath().toString()
    return found


def _register(spark: SparkSession, table: str, path: str, p: Pointer, buckets: tuple[int, Sequence[str]] | None) -> None:
    """Points the catalog's table at the current version."""
    location = hadoop(spark, f"{path}/{p.segments[0].folder}")[1].toString()
    schema = StructType.fromJson(json.loads(p.schema))
    inner = [f for f in schema if f.name not in p.by] + [schema[c] for c in p.by]
    fresh = True
    if spark.catalog.tableExists(table):
        now = spark.table(table)
        fresh = [(f.name, f.dataType.simpleString()) for f in now.schema] != [(f.name, f.dataType.simpleString()) for f in inner]
        fresh = fresh or _layout(spark, table) != (list(p.by), buckets[0] if buckets else 0)
        if fresh:
            spark.sql(f"DROP TABLE {table}")
    if fresh:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner)
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in p.by)})" if p.by else ""
        sorted_by = ""
        if buckets:
            names = ", ".join(f"`{c}`" for c in buckets[1])
            sorted_by = f"CLUSTERED BY ({names}) SORTED BY ({names}) INTO {buckets[0]} BUCKETS"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {p.fmt} {by} {sorted_by} LOCATION '{location}'")
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    if len(p.by) == 1:
        _switch_partitions(spark, table, p.by[0], _partition_folders(spark, path, p))
    elif p.by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def _switch_partitions(spark: SparkSession, table: str, by: str, folders: dict[str, str]) -> None:
    """One statement a partition; partitions are as many as the folders of the table."""
    known = {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for value, where in folders.items():
        verb = "" if value in known else "ADD "
        how = "SET LOCATION" if value in known else "LOCATION"
        spark.sql(f"ALTER TABLE {table} {verb}PARTITION (`{by}` = {_literal(value)}) {how} '{where}'")
    for value in known - set(folders):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (`{by}` = {_literal(value)})")


def _literal(value: str) -> str:
    return "NULL" if value in ("__HIVE_DEFAULT_PARTITION__", "null") else "'" + value.replace("'", "\\'") + "'"


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Partition columns and the number of buckets that the catalog has for a table."""
    columns = spark.catalog.listColumns(table)
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return [c.name for c in columns if c.isPartition], int(told.get("Num Buckets") or 0)
