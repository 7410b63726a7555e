"""The queries that apply the corpus operators to whole tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, attention, decontaminate, exactdup, htmltext, langid, minhash, mixing, oracles, quality, substrings, tokens, vectorcodes, warc
from .shared import new_folder, table, until_exit

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.WEIGHTS)
    return mixed.select("doc_id", "source", "lang", "n_chars", F.md5("text").alias("text_md5"), "copy_no")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.concat_ws(",", "failed_rules").alias("failed_rules")
    )


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    until_exit(spark, folder)
    return warc.read_archives(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    index = tokens.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    until_exit(spark, folder)
    return tokens.read_token_files(index)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_attention_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.score(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_poisson_mixing,
        op2_minhash_dedup,
        op3_quality_rules,
        op4_warc_index,
        op5_token_files,
        op6_language_id,
        op7_attention_score,
        op8_repeated_substrings,
        op9_benchmark_decontamination,
        op10_html_text,
        op11_vector_codes,
        op12_exact_dedup,
        op13_token_alignment,
    )
}

ORACLES: dict[str, str] = oracles.ORACLES
