"""The registered queries of the corpus operators: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.ann import nearest
from gridmart.llm.common import Scratch, load
from gridmart.llm.exact_dedup import exact_groups
from gridmart.llm.hmm import score
from gridmart.llm.langid import identify
from gridmart.llm.line_dedup import line_groups
from gridmart.llm.mixing import mix
from gridmart.llm.near_dedup import near_groups
from gridmart.llm.packing import pack
from gridmart.llm.runs import periodic_runs
from gridmart.llm.url_rules import judge, mine
from gridmart.llm.vector_codes import books_sha256, compress
from gridmart.llm.warc import read_archives, resolved, write_archives
from gridmart.llm.wavelet import read_tokens, write_tokens

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number ends its url's path, so that document's labels are the page's;
    bad is toxic or of low quality."""
    pages, labels = load(spark, sf_dir, "pages").select("page_id", "url"), load(spark, sf_dir, "labels")
    shown = F.expr("try_cast(regexp_extract(url, '/([0-9]+)(?:[/.?#][^/]*)?$', 1) AS BIGINT)")
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    labelled = pages.withColumn("doc_id", shown).join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")
    scratch = Scratch(spark, "op1")
    judged = judge(pages, mine(labelled, scratch), scratch)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined_rule"),
                         "confidence")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(load(spark, sf_dir, "documents"), Scratch(spark, "op2"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(load(spark, sf_dir, "documents"), Scratch(spark, "op3"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "copies", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return exact_groups(docs, Scratch(spark, "op4")).drop("_key")


def op5_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(load(spark, sf_dir, "documents"), Scratch(spark, "op5"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), Scratch(spark, "op6"), every=20)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), TOKENIZER)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(load(spark, sf_dir, "documents"), Scratch(spark, "op8"), carry=["doc_id"])
    return found.select("row.doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(load(spark, sf_dir, "documents"), TOKENIZER, Scratch(spark, "op9")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_groups(load(spark, sf_dir, "documents"), Scratch(spark, "op10"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_of(load(spark, sf_dir, "documents"))


def op11_of(docs: DataFrame) -> DataFrame:
    """Every tenth text or so (by the crc32 of its id; a null id changes nothing) goes on periodically from one of its words on."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    words = F.filter(F.split("text", "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")

    def altered(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = F.pmod(g, F.greatest(n, F.lit(1)))
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda k: F.get(w, (a + k % p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " "))

    text = F.when(h % 10 == 0, F.get(F.transform(F.array(words), altered), F.lit(0))).otherwise(F.col("text"))
    found = periodic_runs(docs.select("doc_id", text.alias("text")), carry=["doc_id"])
    listed = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    return found.withColumn("_best", best).select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.s")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.p")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.p")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_of(load(spark, sf_dir, "embeddings"), Scratch(spark, "op12"))


def op12_of(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    codes, books = compress(vectors, scratch)
    code = F.lower(F.array_join(F.transform("places", lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", code.alias("code"), "error", "label_error", F.lit("" if books is None else books_sha256(books)).alias("codebooks_sha256"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_of(load(spark, sf_dir, "pages"), Scratch(spark, "op13"))


def op13_of(pages: DataFrame, scratch: Scratch) -> DataFrame:
    path = write_archives(pages, scratch.path("archives"), scratch)
    back = resolved(scratch.write(read_archives(pages.sparkSession, path, payload=False), "records"))
    return back.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"),
                       F.col("refers_to_id").cast("long").alias("refers_to"), "error")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_near_dedup": op2_near_dedup,
    "op3_mixing": op3_mixing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_hmm_score": op5_hmm_score,
    "op6_nearest": op6_nearest,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_wavelet_tokens": op9_wavelet_tokens,
    "op10_line_dedup": op10_line_dedup,
    "op11_runs": op11_runs,
    "op12_vector_codes": op12_vector_codes,
    "op13_warc": op13_warc,
    "pipeline": corpus_pipeline.run,
}
