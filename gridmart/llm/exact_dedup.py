"""Exact dedup by deterministic block naming.

Each normalised text (A-Z lower-cased) is cut into blocks of a fixed number of characters.
Equal blocks get the same integer name by sorting: blocks meet in small bins by hash, and
inside a bin the distinct contents are ranked in sort order, so a name is (bin, rank) in one
integer and two contents never share one.  Then adjacent names are joined in pairs, and
the pairs are named in the same way, level by level, until each document has one name.
Documents with equally many blocks finish on the same level, so (level, name) is equal
exactly when the texts are: the identity is free of collisions, whatever the hash does.

Skew: a block that many copies share would land in one bin.  Values whose hash occurs in
more than ``rows / HOT_SHARE`` rows (so fewer than ``HOT_SHARE`` of them) are reduced to
distinct contents with map-side combining, named, and sent back by a broadcast of at most
``HOT_SHARE`` hashes' contents of one block each; all others are named where they meet.

Defined results: a null text counts as empty, and an empty text is one empty block.  Rows that
repeat a doc_id are rows of their own; of rows that repeat both doc_id and text exactly one
can stay.  A null doc_id is smaller than any other.  Very long texts only make more levels.  An
empty table gives an empty result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.llm.common import Scratch, ascii_lower, union_all

BLOCK_CHARS = 4096
HOT_SHARE = 1000
BIN_ROWS = 256           # rows that meet in a bin, on average
RANK_BITS = 40           # a name is bin * 2**RANK_BITS + rank; bins stay below 2**23
MAX_BINS = 1 << 22


def name_values(rows: DataFrame, value: list[str], name: str, n_rows: int, spread: str, scratch: Scratch) -> DataFrame:
    """Replaces the columns ``value`` (not null) by one long column ``name``: equal values get equal
    names, different values different ones.  ``spread`` is a column by which rows of a hot value,
    which are named already, are dealt over the bins."""
    keyed = rows.withColumn("_h", F.xxhash64(*value))
    bins = min(MAX_BINS, n_rows // BIN_ROWS + 1)
    hot = scratch.write(keyed.groupBy("_h").count().filter(F.col("count") > max(1, n_rows // HOT_SHARE)).select("_h"), "hot")
    own = [F.col(v) for v in value]
    if hot.isEmpty():
        keyed = keyed.withColumn("_given", F.lit(None).cast("long"))
    else:
        contents = scratch.write(keyed.join(F.broadcast(hot), "_h").select("_h", *value).distinct(), "contents")
        part = F.pmod("_h", F.lit(64))
        named = contents.withColumn(
            "_bin", F.dense_rank().over(Window.partitionBy(part).orderBy("_h")) * 64 + part + MAX_BINS)
        named = named.select("_h", *[F.col(v).alias(f"_hot{v}") for v in value], (
            F.col("_bin") * (1 << RANK_BITS)
            + F.row_number().over(Window.partitionBy("_bin").orderBy(*value))).alias("_given"))
        same = (F.col("r._h") == F.col("h._h"))
        for v in value:
            same = same & (F.col(f"r.{v}") == F.col(f"h._hot{v}"))
        keyed = keyed.alias("r").join(F.broadcast(named.alias("h")), same, "left").select("r.*", "_given")
        own = [F.when(F.col("_given").isNull(), c) for c in own]
    keyed = keyed.withColumn("_bin", F.pmod(F.when(F.col("_given").isNull(), F.col("_h"))
                                            .otherwise(F.xxhash64(spread)), F.lit(bins)))
    keyed = keyed.withColumns(dict(zip(value, own, strict=True)))
    rank = F.dense_rank().over(Window.partitionBy("_bin").orderBy(*value))
    keyed = keyed.withColumn(name, F.coalesce("_given", F.col("_bin") * (1 << RANK_BITS) + rank))
    return keyed.select(*[c for c in rows.columns if c not in value], name)


def with_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``_key`` (doc_id and digest: repeated rows share it), ``doc_id``, ``text_sha256``, ``_text``."""
    norm = docs.select(F.col(doc_id).alias("doc_id"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    norm = norm.select("doc_id", "_text", F.sha2("_text", 256).alias("text_sha256"))
    return norm.withColumn("_key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_sha256"))


def text_identity(docs: DataFrame, doc_id: str, text: str, scratch: Scratch) -> DataFrame:
    """``_key``, ``level``, ``name``: (level, name) is the same for equal normalised texts only."""
    blocks = with_key(docs, doc_id, text).select(
        "_key", F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0)).alias("_blocks"))
    blocks = blocks.select("_key", F.greatest(F.size("_blocks"), F.lit(1)).alias("_n"),
                           F.posexplode_outer("_blocks").alias("_pos", "_block")).select(
        "_key", "_n", F.coalesce("_pos", F.lit(0)).alias("_pos"), F.coalesce("_block", F.lit("")).alias("_block"))
    chars = F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1))
    size = docs.agg(F.sum(F.ceil(chars / BLOCK_CHARS)).alias("n"), F.max(chars).alias("longest")).first()
    n_rows, longest = int(size["n"] or 0), -(-(size["longest"] or 1) // BLOCK_CHARS)
    names = scratch.write(name_values(blocks, ["_block"], "_name", n_rows, "_key", scratch), "level")
    done, level = [], 0
    while True:
        done.append(names.filter("_n = 1").select("_key", F.lit(level).alias("level"), F.col("_name").alias("name")))
        if longest <= 1:
            return union_all(done).distinct()
        # the names at 2i and 2i+1; a missing right half is 0, which is no name
        pairs = names.filter("_n > 1").groupBy("_key", F.shiftright("_pos", 1).alias("_pos")).agg(
            F.expr("cast((max(_n) + 1) div 2 AS int)").alias("_n"),
            F.expr("coalesce(max(_name) FILTER (WHERE _pos % 2 = 0), 0)").alias("_left"),
            F.expr("coalesce(max(_name) FILTER (WHERE _pos % 2 = 1), 0)").alias("_right"))
        pairs = scratch.write(pairs, "pairs")
        level, longest = level + 1, -(-longest // 2)
        names = scratch.write(name_values(pairs, ["_left", "_right"], "_name", pairs.count(), "_key", scratch), "level")
        scratch.drop(pairs)


def exact_groups(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``_key``, ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    ident = text_identity(docs, doc_id, text, scratch)
    rows = with_key(docs, doc_id, text).select("_key", "doc_id", "text_sha256").join(ident, "_key")
    rows = scratch.write(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = scratch.write(rows.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", F.col("_row").alias("row"))).alias("_best"),
        F.count(F.lit(1)).alias("group_size")), "groups")
    return rows.join(groups, ["level", "name"]).select(
        "_key", "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_best.row")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = scratch.write(exact_groups(docs, scratch, doc_id, text).groupBy("_key").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).filter("kept").select("_key", "rows"), "stay")
    columns = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    keyed = docs.select(row.alias("_row"), F.concat_ws(
        ":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
        F.sha2(ascii_lower(F.coalesce(F.col(text), F.lit(""))), 256)).alias("_key")).join(groups, "_key")
    once = keyed.filter("rows = 1").select("_row")
    many = keyed.filter("rows > 1").groupBy("_key").agg(F.first("_row").alias("_row")).select("_row")
    return once.unionByName(many).select("_row.*")
