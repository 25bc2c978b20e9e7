"""Readers for landed files and table sinks.

Landed files are read with Spark's own splittable readers.  CSV columns are read
as strings (no schema inference pass over the data); silver casts them.  HTTP
fetching is not part of the library: the files are expected on shared storage.
"""

from __future__ import annotations

import csv
import logging
import os
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators.bronze import concat_by_name, null_tokens
from gridmart.session import checkpoint_dir
from gridmart.sources import geojson, tables
from gridmart.sources.fallback import fallback_capacity
from gridmart.sources.geojson import BrokenGeoJson
from gridmart.sources.literal import literal_frame
from gridmart.sources.storage import readable

log = logging.getLogger(__name__)

SEED_PATH = os.path.join(os.path.dirname(__file__), "seeds", "source_categories.csv")

# GeoJSON feature as Spark reads it.  ``coordinates`` is declared as a string so
# the raw JSON text of any geometry (point, line, multi-line, polygon) is kept.
FEATURE_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
COLLECTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(FEATURE_SCHEMA)),
])
GEO_COLUMNS = "properties map<string,string>, geometry_type string, geometry_wkt string, dataset string, resource_name string, resource_id string"


def _files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files that paths, folders and glob patterns stand for, in name order."""
    jvm, out = spark.sparkContext._jvm, []
    for one in [path] if isinstance(path, str) else path:
        p = jvm.org.apache.hadoop.fs.Path(one)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.globStatus(p) or []:
            found = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            out += [f.getPath().toString() for f in found if not f.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """CSV with a header, all columns as strings, cells that mean "missing" as NULL.

    Files are matched by their headers, not by position: those with the same header are
    one read, and the reads are stacked by column name."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    reader = spark.read.option("header", True).option("inferSchema", False)
    for f in _files(spark, path):
        layouts.setdefault(tuple(reader.csv(f).columns), []).append(f)
    if not layouts:
        return reader.csv(path)            # Spark's own error for a path that is not there
    return null_tokens(concat_by_name([reader.option("enforceSchema", False).csv(fs) for fs in layouts.values()]))


def read_csv_and_rejects(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``read_csv`` of the rows that fit their file's header, and the others: ``file``, ``text`` of each row with too many or too few
    cells, or with a quote that is not closed."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    reader = spark.read.option("header", True).option("inferSchema", False)
    for f in _files(spark, path):
        layouts.setdefault(tuple(reader.csv(f).columns), []).append(f)
    if not layouts:
        return reader.csv(path), spark.createDataFrame([], "file string, text string")
    good, bad = [], []
    for columns, found in layouts.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_corrupt_record")])
        # without pruning, or cells that no query reads would not be counted
        rows = (spark.read.option("header", True).option("columnPruning", False).option("columnNameOfCorruptRecord", "_corrupt_record")
                .schema(schema).csv(found))
        names = [F.col(f"`{c}`") for c in columns]
        # Spark refuses to read the record's text alone, so a cell is looked at, too
        broken = F.col("_corrupt_record").isNotNull() & (F.length(F.concat_ws("", names[0])) >= 0)
        good.append(rows.filter(~broken).select(*names))
        bad.append(rows.filter(broken).select(F.col("_metadata.file_path").alias("file"), F.col("_corrupt_record").alias("text")))
    return null_tokens(concat_by_name(good)), concat_by_name(bad)


def read_long_csv(spark: SparkSession, path) -> DataFrame:
    """Yearly long-format statistics CSV, all columns as strings."""
    return read_csv(spark, path)


def read_wide_csv(spark: SparkSession, path) -> DataFrame:
    """Wide indicator CSV (hundreds of columns), strings."""
    return read_csv(spark, path)


# Columns a capacity file must carry, and the ``_source`` tags of
# a landed file and of the curated fallback.
CAPACITY_REQUIRED = ("country", "technology", "year", "capacity_mw")
CAPACITY_FILE_SOURCE = "irena_api"
CAPACITY_FALLBACK_SOURCE = "irena_curated_fallback"
MISSING_FILE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_capacity(spark: SparkSession, path: str | None) -> tuple[DataFrame, str]:
    """Landed capacity CSV when present and complete, else the curated fallback.

    Returns ``(frame, source_tag)``.  Headers are lower-cased with spaces turned
    into ``_``.  A file missing any required column is rejected (logged) and the
    fallback is used instead.
    """
    if path:
        try:
            df = read_csv(spark, path)
            df = df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])
        except AnalysisException as exc:
            if exc.getCondition() not in MISSING_FILE:       # storage faults and the like are not "no file"
                raise
            log.warning("no capacity file (%s); using curated fallback", exc.getCondition())
            return fallback_capacity(spark), CAPACITY_FALLBACK_SOURCE
        missing = [c for c in CAPACITY_REQUIRED if c not in df.columns]
        if not missing:
            return df, CAPACITY_FILE_SOURCE
        log.warning("capacity file lacks %s; using curated fallback", missing)
    return fallback_capacity(spark), CAPACITY_FALLBACK_SOURCE


def explode_features(fc: DataFrame) -> DataFrame:
    """FeatureCollection rows -> one row per feature (geometry JSON kept as text)."""
    feats = fc.select(F.explode_outer("features").alias("f")).filter(F.col("f").isNotNull())
    return features_to_rows(feats.select("f.*"))


def features_to_rows(feats: DataFrame) -> DataFrame:
    return feats.select(
        F.col("properties"),
        F.col("geometry.type").alias("geometry_type"),
        F.coalesce(F.col("geometry.coordinates"), F.lit("null")).alias("geometry_wkt"),
    )


def _geojson_records(spark: SparkSession, path: str, line_delimited: bool) -> DataFrame:
    """Parsed documents (or lines) with ``_broken``: not JSON of the expected kind."""
    schema = FEATURE_SCHEMA if line_delimited else COLLECTION_SCHEMA
    kind = "Feature" if line_delimited else "FeatureCollection"
    df = (spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())]))
          .option("multiLine", not line_delimited).option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    sound = F.col("_corrupt_record").isNull() & F.coalesce(F.col("type") == kind, F.lit(False))
    return df.withColumn("_broken", ~sound)


def broken_records(spark: SparkSession, path: str, line_delimited: bool = False) -> int:
    """How many documents (or lines) of a GeoJSON resource are not what they should be."""
    return _geojson_records(spark, path, line_delimited).agg(F.sum(F.col("_broken").cast("long"))).first()[0] or 0


COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def read_geojson(spark: SparkSession, path: str, line_delimited: bool = False, length: int = geojson.RANGE) -> DataFrame:
    """GeoJSON -> (properties, geometry_type, geometry_wkt) rows.

    FeatureCollections are read in ranges of ``length`` bytes by many tasks, however long one document is
    (``sources.geojson``); compressed ones, and those in stores that Arrow does not know, in one task a document.
    ``line_delimited=True`` reads one Feature per line.

    A broken document raises :class:`BrokenGeoJson`, so that a layer never vanishes
    unseen; broken lines are counted in a warning and never land as features.
    """
    if not line_delimited:
        found = _files(spark, path)
        if found and all(readable(f) and not f.lower().endswith(COMPRESSED) for f in found):
            return _read_ranges(spark, path, length)
    broken = broken_records(spark, path, line_delimited)
    records = _geojson_records(spark, path, line_delimited).filter(~F.col("_broken"))
    if line_delimited:
        if broken:
            log.warning("%d broken lines in %s were left out", broken, path)
        return features_to_rows(records)
    if broken:
        raise BrokenGeoJson(f"{broken} broken document(s) in {path}")
    return explode_features(records).repartition(spark.sparkContext.defaultParallelism)


def _read_ranges(spark: SparkSession, path: str, length: int) -> DataFrame:
    """The features' texts go to the shared checkpoint folder as lines, so they are cut out once and parsed by the
    reader that also reads landed lines: texts of numbers stay as they are."""
    lines = f"{checkpoint_dir(spark)}/features-{uuid.uuid4().hex}"
    feats = geojson.read_features(spark, path, length)
    feats.select(F.translate("feature", "\n\r", "  ")).write.text(lines)      # line ends lie outside strings only
    records = _geojson_records(spark, lines, True)
    broken = records.agg(F.count("_corrupt_record"), F.count("type")).first()[0]     # Spark refuses to read the first column alone
    if broken:
        raise BrokenGeoJson(f"{broken} broken feature(s) in {path}")
    return features_to_rows(records)


def station_rows(df: DataFrame) -> DataFrame:
    """Station rows carry no geometry: add NULL geometry columns."""
    return df.withColumns({
        "geometry_type": F.lit(None).cast("string"),
        "geometry_wkt": F.lit(None).cast("string"),
    })


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station CSV rows with NULL geometry columns."""
    return station_rows(read_csv(spark, path))


def read_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Category lookup CSV (S8).  Without a path the packaged 12-row seed is used;
    it is parsed on the driver (fixed size) so executors need no local file."""
    if path:
        return read_csv(spark, path)
    with open(SEED_PATH, newline="") as fh:
        rows = list(csv.DictReader(fh))
    cols = list(rows[0].keys())
    return literal_frame(spark, [[r[c] for c in cols] for r in rows], [(c, "string") for c in cols])


def select_resources(resources: Sequence[dict], dataset_key: str,
                     csv_datasets: Sequence[str] = ("solar_radiation",)) -> list[tuple[str, dict]]:
    """Choose how to read each landed resource (S9): ``geojson`` for GEOJSON/JSON,
    ``geojson_lines`` for one Feature per line (JSONL, GEOJSONL, NDJSON: read in parallel),
    ``csv`` only for datasets listed in ``csv_datasets``; others are skipped."""
    chosen = []
    for res in resources:
        fmt = (res.get("format") or "").upper()
        if not res.get("path"):
            continue
        if fmt in ("GEOJSON", "JSON"):
            chosen.append(("geojson", res))
        elif fmt in ("JSONL", "GEOJSONL", "NDJSON"):
            chosen.append(("geojson_lines", res))
        elif fmt == "CSV" and any(k in dataset_key for k in csv_datasets):
            chosen.append(("csv", res))
    return chosen


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", table: str | None = None,
                buckets: tuple[int, Sequence[str]] | None = None) -> None:
    """Full-refresh materialisation of an asset (S10) on shared storage: a new version, published in one step
    (see ``sources.tables``); with ``table`` it is also registered in the catalog under that name."""
    tables.publish(df, path, partition_by, fmt, table, buckets)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read an upstream asset by location (S11): its current version."""
    return tables.read(spark, path, fmt)


def write_geojson(features: DataFrame, path: str, document: bool = False, order: Sequence[str] = ()) -> None:
    """Features as GeoJSON (S12): one Feature per line, in parallel, one file per task; or, as ``document``, one valid
    FeatureCollection at ``path``, in the order of the columns ``order`` and then of the text.

    ``features`` has each Feature's JSON in a string column (``feature`` for a document).
    """
    if document:
        geojson.write_document(features, path, order)
    else:
        features.write.mode("overwrite").text(path)


def list_databases(spark: SparkSession) -> list[str]:
    """Names of catalog databases."""
    return [d.name for d in spark.catalog.listDatabases()]
