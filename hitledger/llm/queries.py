"""One named query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import toxicity, warc
from hitledger.llm.align import Alignment
from hitledger.llm.cross_polytope import neighbours
from hitledger.llm.decontaminate import contamination
from hitledger.llm.fill_middle import fill_in_middle, restored
from hitledger.llm.language_id import fit, fold, languages
from hitledger.llm.log_templates import drop_template_lines
from hitledger.llm.mixing import copies
from hitledger.llm.near_dup import Shingles, near_duplicates
from hitledger.llm.secret_scan import secret_spans, spans_text
from hitledger.llm.stages import Stages
from hitledger.llm.token_output import token_digest, write_tokens
from hitledger.llm.url_filter import Rule, judge

TOKENIZER = "word_bpe_49k.json"
URL_RULES = (
    Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Stages(spark, "tokens").folder("ids")
    write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return token_digest(spark, path)


def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = copies(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(_table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op4_language_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    net = fit(docs.where(fold("doc_id") != 2).select("doc_id", "text", "lang"))
    found = languages(docs.select("doc_id", "text"), net)
    return found.select("doc_id", (fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def _archive(pages: DataFrame, html: Column) -> DataFrame:
    archive = F.floor(F.col("page_id") / 256).cast("long")
    return warc.laid_out(pages.select("page_id", archive.alias("archive"), warc.response_record(F.col("url"), html).alias("record")), "page_id")


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of 256 pages against a replica with changed bytes in some records and some archives cut short."""
    pages = _table(spark, sf_dir, "pages")
    rotten = F.when(F.col("page_id") % 97 == 13, F.replace(F.col("html"), F.lit("article"), F.lit("artIcle"))).otherwise(F.col("html"))
    cut = (F.floor(F.col("page_id") / 256) % 5 == 3) & (F.col("page_id") % 256 >= 250)
    return warc.audit(_archive(pages, F.col("html")), _archive(pages.where(~cut), rotten))


def op6_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op7_log_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_template_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op9_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )


def op10_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), Shingles(words=4, percent=80))


def op11_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxicity.fit(docs.where(fold("doc_id") != 2), _table(spark, sf_dir, "labels").where(fold("doc_id") != 2))
    held_out, predicted = (fold("doc_id") == 2).alias("held_out"), (F.col("score") >= 0.3).cast("int").alias("predicted")
    return toxicity.toxicity(docs, model).select("doc_id", held_out, "score", predicted, "threshold", "toxic")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        digest(F.col("output")).alias("output_sha256"), digest(restored()).alias("restored_sha256"),
    )


def op13_spill_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return Alignment(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")).texts()


QUERIES = {f.__name__: f for f in (
    op1_token_output, op2_pivotal_mix, op3_url_templates, op4_language_cnn, op5_warc_fixity,
    op6_cross_polytope, op7_log_template_lines, op8_decontaminate, op9_secret_entropy, op10_minhash_odd_sketch,
    op11_toxicity_cnn, op12_fill_in_middle, op13_spill_alignment,
)}
