"""Registered queries of this subpackage, with their DuckDB SQL where it exists."""

from __future__ import annotations

from shelfcast.llm import (chat, decontaminate, htmltext, language, licenses, neardup, negatives, packing, pitmanyor,
                           quality, spelling, substrings, urls)
from shelfcast.llm.common import bounded_batches, table


def op1_sum_of_squares_packing(spark, sf_dir):
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"),
                        public_tokenizers.path("byte_bpe_50k.json"))


def op2_chat_rotation(spark, sf_dir):
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op3_compression_language(spark, sf_dir):
    return language.language_query(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op4_link_graph_filter(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_template_extraction(spark, sf_dir):
    return htmltext.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op6_fm_index_dedup(spark, sf_dir):
    return substrings.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       keep=["doc_id"], with_text=False)


def op7_prefix_set_join(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def op8_bottom_k_near_dups(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   shingle=3, percent=85)


def op9_quality_ledger(spark, sf_dir):
    return quality.quality_query(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_license_sentences(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_pitman_yor_lm(spark, sf_dir):
    return pitmanyor.pitman_yor(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"), noise_every=199)


def op13_cover_tree_negatives(spark, sf_dir):
    return negatives.negatives_query(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def _bounded(fn):
    def run(spark, sf_dir):
        bounded_batches(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


QUERIES = {f.__name__: _bounded(f) for f in (
    op1_sum_of_squares_packing, op2_chat_rotation, op3_compression_language, op4_link_graph_filter,
    op5_template_extraction, op6_fm_index_dedup, op7_prefix_set_join, op8_bottom_k_near_dups, op9_quality_ledger, op10_license_sentences,
    op11_pitman_yor_lm, op12_spelling_variants, op13_cover_tree_negatives)}
ORACLES = {"op2_chat_rotation": chat.ORACLE, "op4_link_graph_filter": urls.ORACLE,
           "op5_template_extraction": htmltext.ORACLE,
           "op6_fm_index_dedup": substrings.ORACLE,
           "op7_prefix_set_join": decontaminate.ORACLE,
           "op8_bottom_k_near_dups": neardup.ORACLE,
           "op9_quality_ledger": quality.ORACLE,
           "op10_license_sentences": licenses.ORACLE,
           "op13_cover_tree_negatives": negatives.ORACLE}
