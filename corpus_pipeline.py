"""From raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next one's documents. All but the last return the columns of documents:

* quality: documents scored below the threshold go (model learned from ``labels``);
* language: documents without letters, or unlike every learned language, go;
* near_duplicates: one document of each class stays;
* mixing: each document appears as often as the mix takes it (0, 1 or 2 times);
* bpe: doc_id, n_tokens and the token ids (little-endian unsigned 32-bit) of every row, then the SHA-256 of the
  ids and of the UTF-8 text that streaming decoding gives back from them.

Columns beyond those of documents pass through the first four stages unchanged. An empty table
passes through all of them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratecell.llm import bpe_fst, langid_hd, mixing, neardup_icws, quality_ftrl
from ratecell.llm.common import scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_ftrl.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid_hd.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup_icws.drop_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_fst.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, check=True)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mix_sources),
          ("bpe", bpe)]

# SQL can't express the classifiers, the sketches or the tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
