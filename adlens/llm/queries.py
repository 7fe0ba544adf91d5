"""Registered queries of the training-data operators and, where SQL can say it, their DuckDB text.

Each query applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm import forced_bpe, html_text, merkle, mixing, nbsvm, packing, plane_files, quality_rules, simhash, spelling, syncmers, tokens, toxicity, warc
from adlens.llm.common import table
from adlens.llm.oracle import OP3, OP5, OP9, OP11, OP13


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op2_simhash_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang"), table(spark, sf_dir, "labels", "doc_id", "quality"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokens.public_path(), capacity=2048, end_id=0)


def op5_warc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"), threshold=0.3)


def op7_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"), threshold=0.5)


def op8_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plane_files.round_trip(table(spark, sf_dir, "documents", "doc_id", "text"), tokens.public_path(), end_id=2)


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_char_edits(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_bloom_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents", "doc_id", "text"), shortest=5, least=3, one_in=97, ratio=2)


def op12_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forced_bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), tokens.public_path("byte_bpe_50k.json"))


def op13_merkle_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents", *merkle.FIELDS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extract, op2_simhash_pivot, op3_quality_rules, op4_best_fit_packing, op5_warc_convert,
                            op6_nbsvm_quality, op7_gru_toxicity, op8_id_planes, op9_source_mix, op10_closed_syncmers,
                            op11_bloom_spelling, op12_forced_bpe, op13_merkle_exchange)}

ORACLE: dict[str, str] = {"op3_quality_rules": OP3, "op5_warc_convert": OP5, "op9_source_mix": OP9,
                          "op11_bloom_spelling": OP11, "op13_merkle_exchange": OP13}
