"""Registered queries of the training-data operators: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecell.llm import (ann_mih, bpe_count, bpe_fst, filter_audit, html_lstm, iblt, langid_hd, mixing, neardup_icws,
                          quality_ftrl, spelling_trie, token_dac, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark, sf_dir):
    e = _table(spark, sf_dir, "embeddings")
    return ann_mih.search(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding")


def op2_fingerprints(spark, sf_dir):
    return iblt.compare_versions(_table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality_ftrl.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_mixing(spark, sf_dir):
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op5_language(spark, sf_dir):
    return langid_hd.identify(_table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    return token_dac.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_near_duplicates(spark, sf_dir):
    return neardup_icws.classes(_table(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return bpe_fst.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN, ids=False, check=True)


def op9_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_token_counts(spark, sf_dir):
    return bpe_count.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling(spark, sf_dir):
    return spelling_trie.group_variants(_table(spark, sf_dir, "documents"))


def op12_main_text(spark, sf_dir):
    return html_lstm.extract(_table(spark, sf_dir, "pages"))


def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_ann, op2_fingerprints, op3_quality, op4_mixing, op5_language, op6_token_files,
                                   op7_near_duplicates, op8_bpe, op9_warc, op10_token_counts, op11_spelling, op12_main_text,
                                   op13_filter_audit, pipeline)}
ORACLES = {"op4_mixing": mixing.ORACLE, "op9_warc": warc.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
