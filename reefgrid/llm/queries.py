"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from reefgrid.llm.alignment import align_tokens
from reefgrid.llm.common import ready, table
from reefgrid.llm.consensus import extract_pages
from reefgrid.llm.decontaminate import contamination
from reefgrid.llm.linespread import remove_boilerplate
from reefgrid.llm.minmax import near_duplicates
from reefgrid.llm.packing import pack_documents
from reefgrid.llm.phrases import remove_repeated_words
from reefgrid.llm.pstable import nearest
from reefgrid.llm.quality import quality_scores
from reefgrid.llm.spelling import spelling_groups
from reefgrid.llm.suffixes import remove_repeated_bytes
from reefgrid.llm.toxicity import toxicity_scores
from reefgrid.llm.vectorpack import pack_examples


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    ready(spark)
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(ready(spark), folder, "documents"))


def op3_line_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines, those removed, and the text that stays."""
    found = remove_boilerplate(table(ready(spark), folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    ready(spark)
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_consensus_extract(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(ready(spark), folder, "pages")).select("page_id", "url", "text", "n_chars")


def op6_multiprobe_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(ready(spark), folder, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    ready(spark)
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_bytes(table(ready(spark), folder, "documents"))


def op9_minmax_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(ready(spark), folder, "documents"))


def op10_phrase_automata_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_words(table(ready(spark), folder, "documents"))


def op11_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as examples all of whose tokens bear loss."""
    return pack_examples(table(ready(spark), folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_groups(table(ready(spark), folder, "documents"))


def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(ready(spark), folder, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_decontaminate, op2_best_fit_packing, op3_line_spread, op4_quality, op5_consensus_extract,
        op6_multiprobe_ann, op7_toxicity, op8_suffix_array_dedup, op9_minmax_near_dedup, op10_phrase_automata_dedup,
        op11_vector_packing, op12_spelling_variants, op13_cross_tokenizer_alignment,
    )
}
