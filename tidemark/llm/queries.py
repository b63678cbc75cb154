"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import functions as F

from tidemark.llm import (ball_tree, decontaminate, html_text, license_scan, packing, prefix_trie, quality_gam, repeats, secret_scan, simhash, token_counts,
                          toxicity, whitening)
from tidemark.llm.common import table
from tidemark.llm.oracle import ORACLE  # noqa: F401  DuckDB SQL of the same results


def op1_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_repeat_removal(spark, sf_dir):
    return repeats.repeats_report(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_quality_gam(spark, sf_dir):
    return quality_gam.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6_exact_top_k(spark, sf_dir):
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bin_slack_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_html_extraction(spark, sf_dir):
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_repeat_removal, op3_token_counts, op4_quality_gam, op5_license_scan, op6_exact_top_k, op7_decontamination,
    op8_bin_slack_packing, op9_simhash_near_dedup, op10_secret_scan, op11_prefix_trie, op12_html_extraction, op13_whitening)}
