"""The registered queries of this subpackage: thin digests of the operators' results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billframe.llm import (
    decontaminate,
    extract_main,
    language_id,
    licence_scan,
    line_dedup,
    lm_lattice,
    mixture,
    periodic_runs,
    quality_fm,
    quality_rules,
    simhash,
    token_count,
    vector_codes,
)
from billframe.llm.common import crc_mod, tune
from billframe.sources.tables import table

#: Tokens beyond which a text counts as over the limit (contract).
TOKEN_LIMIT = 512


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document: names, number of passages and best containment."""
    docs = table(tune(spark), sf_dir, "documents")
    found = licence_scan.license_matches(docs, licence_scan.template_table(spark))
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.size("matches").cast("long").alias("n_matches"),
        F.coalesce(F.array_max("matches.containment"), F.lit(0.0)).alias("containment"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled verdict of every document, by language."""
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *columns)


def op2_quality_rules_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the risk certified for the verdict instead of each cutoff."""
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), joint=True)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *columns)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-level base score and subword-lattice log10 probability of every document."""
    docs = table(tune(spark), sf_dir, "documents")
    return lm_lattice.lm_scores(docs, tokenizer_file("piece_bpe_32k.model"), crc_mod(F.col("doc_id"), 7) == 2)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labelled ones."""
    docs, labels = table(tune(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_fm.train(docs, labels, learn=crc_mod(F.col("doc_id"), 3) != 1)
    return quality_fm.scores(docs, model).select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE token counts of every document."""
    docs = table(tune(spark), sf_dir, "documents")
    return token_count.token_counts(docs, tokenizer_file("byte_bpe_50k.json")).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(tune(spark), sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that every document loses to an earlier equal or nearly equal line."""
    found = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return found.withColumn("dropped", F.array_join("dropped", ","))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all sources at an entropy of 95 % of the greatest, at most four passes."""
    return mixture.mixture(table(spark, sf_dir, "documents"))


def op8_mixture_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mixture with every source's budget filled up to its longest document."""
    return mixture.mixture(table(spark, sf_dir, "documents"), filled=True)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs, items = table(tune(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.benchmark_hits(docs, items))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_main.extract(table(tune(spark), sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of them with the contract's repeated tail."""
    docs = periodic_runs.with_planted_runs(table(tune(spark), sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(tune(spark), sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = language_id.languages(docs, language_id.train(docs, learn=~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings under codebooks of six rounds."""
    codes, codebooks = vector_codes.compress(table(tune(spark), sf_dir, "embeddings"))
    return vector_codes.digest(codes, codebooks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op2_quality_rules_joint": op2_quality_rules_joint,
    "op3_lm_score": op3_lm_score,
    "op4_quality": op4_quality,
    "op5_token_counts": op5_token_counts,
    "op6_simhash": op6_simhash,
    "op7_line_dedup": op7_line_dedup,
    "op8_mixture": op8_mixture,
    "op8_mixture_filled": op8_mixture_filled,
    "op9_decontamination": op9_decontamination,
    "op10_main_text": op10_main_text,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_language_id": op12_language_id,
    "op13_vector_codes": op13_vector_codes,
}

#: DuckDB SQL where SQL can express the operator.
ORACLE: dict[str, str] = {
    "op2_quality_rules": quality_rules.SQL,
    "op2_quality_rules_joint": quality_rules.SQL_JOINT,
    "op7_line_dedup": line_dedup.SQL.format(documents="documents"),
    "op8_mixture": mixture.SQL.format(documents="documents"),
    "op8_mixture_filled": mixture.SQL_FILLED.format(documents="documents"),
    "op9_decontamination": decontaminate.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op13_vector_codes": vector_codes.sql(),
}
