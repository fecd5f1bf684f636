"""The registered query of each operator, over its whole table, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import collocations, conversations, decontam, divergence, langid, lattice, maxent, minhash, oracles, pii, quality, spm, tokens, warc
from strata.llm.common import importable
from strata.session import scratch_path


#: Key of the registered queries; a production run passes its own secret.
PII_KEY = "registered-query-key"


def _registered(*functions):
    def ready(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return f(spark, sf_dir)

        return run

    return {f.__name__: ready(f) for f in functions}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of every page, written, committed and read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    out = scratch_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), out)
    return warc.read(spark, out, payloads=False).drop("url")


def op2_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, p_text, p_page, score, keep of every document."""
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_lattice_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector, linked within its label at cosine >= 0.98."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text."""
    return maxent.score(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, lang, posterior, text_lang, declared, host of every page."""
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op6_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document: 3-word shingles, similarity >= 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer of every document that holds a benchmark passage."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced of every document."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, found_col="n_replaced")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip of every whole text."""
    return spm.encode_documents(table(spark, sf_dir, "documents"),
                                public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op11_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of every whole text."""
    return divergence.judge(table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, after
    damage to its rows."""
    hurt = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.audit(hurt, present_col="present").drop("rows", "repaired_rows")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first 2,000 phrases of two and three words."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = _registered(op1_warc, op2_quality_cotraining, op3_lattice_near_dup, op4_maxent_lm, op5_language_id, op6_minhash_near_dup, op7_decontamination, op8_token_counts, op9_pii_pseudonyms, op10_sentencepiece,
                      op11_distribution_divergence, op12_conversation_repair, op13_collocations) | {"pipeline": corpus_pipeline.run}

# The other similarity, training, tokenizer and keyed-permutation queries are beyond SQL; tests/llm checks them
# against brute force.
ORACLES: dict[str, str] = oracles.ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
