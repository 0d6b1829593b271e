"""The registered queries of this subpackage, over whole tables, and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import (
    chosen_path, decontaminate, exact, fill_middle, language, licences, line_templates, mixture, packing, ranked_search, token_store,
    toxicity, warc,
)
from newsloom.llm.common import read_table
from newsloom.session import spread


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"), "doc_id")


def op1_warc(spark, sf_dir):
    return warc.op1_warc(spread(read_table(spark, sf_dir, "pages"), "page_id"))


def op2_token_store(spark, sf_dir):
    return token_store.op2_token_store(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_line_templates(spark, sf_dir):
    return line_templates.op3_line_templates(_documents(spark, sf_dir))


def op4_near_duplicates(spark, sf_dir):
    return chosen_path.op4_near_duplicates(_documents(spark, sf_dir))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.op5_decontaminate(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark, sf_dir):
    return toxicity.op6_toxicity(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark, sf_dir):
    return exact.op7_exact_dedup(_documents(spark, sf_dir))


def op8_language_id(spark, sf_dir):
    return language.op8_language_id(_documents(spark, sf_dir))


def op9_licence_scan(spark, sf_dir):
    return licences.op9_licence_scan(_documents(spark, sf_dir))


def op10_mix_sources(spark, sf_dir):
    return mixture.op10_mix_sources(_documents(spark, sf_dir))


def op11_pack_sequences(spark, sf_dir):
    return packing.op11_pack_sequences(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op12_ranked_search(spark, sf_dir):
    return ranked_search.op12_ranked_search(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op13_fill_middle(spark, sf_dir):
    return fill_middle.op13_fill_middle(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc, op2_token_store, op3_line_templates, op4_near_duplicates, op5_decontaminate, op6_toxicity, op7_exact_dedup,
        op8_language_id, op9_licence_scan, op10_mix_sources, op11_pack_sequences, op12_ranked_search, op13_fill_middle)
}
ORACLE: dict[str, str] = {
    "op1_warc": warc.OP1_SQL,
    "op3_line_templates": line_templates.OP3_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op7_exact_dedup": exact.OP7_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_fill_middle": fill_middle.OP13_SQL,
}
