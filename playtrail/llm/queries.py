"""The registered queries of this subpackage: one per operator, and the pipeline.

Each reads its whole table and returns the full result of its operator, called
with production parameters.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm import (
    bpe_automaton,
    collocations,
    decontaminate,
    edit_counts,
    html_template,
    licenses,
    pii,
    simhash_dedup,
    substring_dedup,
    syncmers,
    token_shards,
    toxicity,
    vector_codes,
)
from playtrail.llm.common import read
from playtrail.llm.oracle import ORACLE  # noqa: F401  (the entry point reads it here)
from playtrail.plans.guards import shared_dir


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text with surrogates, and how many were put in."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs, count="n_replaced")


def op2_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    return syncmers.fingerprints(read(spark, sf_dir, "documents"))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted; learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_license_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: paragraphs, confirmed notices, their families and the lowest probability."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(docs))
    return found.select(
        "doc_id",
        "n_paragraphs",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.family")), ",").alias("families"),
        F.array_join(F.transform("notices.paragraph", lambda x: x.cast("string")), ",").alias("paragraphs"),
        F.array_min("notices.probability").alias("least_probability"),
    )


def op5_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and benchmark items of every document."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts before and after three scripted edits a document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("edits", edit_counts.scripted_edits())
    return edit_counts.count_edits(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's ids and of the text decoded from them."""
    docs = read(spark, sf_dir, "documents")
    return bpe_automaton.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op8_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_template.extract(read(spark, sf_dir, "pages"))


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of all sequences of the documents, as written to shards in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    if "://" not in path:
        path = path.replace("file:", "", 1)
        path = f"file://{path}"
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_shards.write_shards(read(spark, sf_dir, "documents"), vocabulary, path)


def op10_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash and component of every document."""
    return simhash_dedup.components(read(spark, sf_dir, "documents"))


def op11_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector, from codebooks of six Lloyd rounds."""
    return vector_codes.codes(read(spark, sf_dir, "embeddings"))


def op12_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, and what is left without repeats of 35 words and more."""
    return substring_dedup.report(read(spark, sf_dir, "documents"))


def op13_phrase_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to four words of each language."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_surrogates,
        op2_closed_syncmers,
        op3_toxicity_grammar,
        op4_license_paragraphs,
        op5_fm_decontamination,
        op6_edit_token_counts,
        op7_bpe_automaton,
        op8_html_templates,
        op9_token_shards,
        op10_simhash_tiles,
        op11_dual_tree_codes,
        op12_seed_extend,
        op13_phrase_rollup,
    )
}
