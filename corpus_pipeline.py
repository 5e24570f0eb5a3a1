"""Documents to a token file: the corpus operators as one chain of stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's ``docs``. All but the last
return the columns of ``documents``; each copes with an empty table, null texts
and repeated rows as its operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hitledger.llm.decontaminate import drop_contaminated
from hitledger.llm.language_id import fit, keep_known
from hitledger.llm.mixing import mix_documents
from hitledger.llm.near_dup import Shingles, drop_near_duplicates
from hitledger.llm.stages import Stages
from hitledger.llm.token_output import token_digest, write_tokens

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without a letter or with an uncertain prediction go."""
    return keep_known(docs, fit(docs.select("doc_id", "text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their five-word shingles."""
    return drop_near_duplicates(docs, Shingles(words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten words in a row of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A token file, and what it holds of each row."""
    path = Stages(spark, "pipeline-tokens").folder("ids")
    write_tokens(docs, path, public_tokenizers.path(TOKENIZER))
    return token_digest(spark, path)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

#: Network, sketches, random mixing and tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = Stages(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name)
    return docs
