"""A corpus pipeline of five stages over ``documents``.

toxicity -> SimHash near-duplicates -> benchmark decontamination -> PII -> BPE.
Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared checkpoint folder and reads it again as the next one's
documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.llm import bpe_automaton, decontaminate, pii, simhash_dedup, toxicity
from playtrail.llm.common import cut, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labels, doesn't reject."""
    labels = read(spark, sf_dir, "labels").filter(~toxicity.held_out())
    grammar = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text")), grammar)
    return scored.filter("score < 0.5").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: three-word shingles, two bits."""
    return simhash_dedup.keep_one(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word passage of the benchmark."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows the new text."""
    done = pii.replace(docs)
    if "n_chars" in done.columns:
        length = F.length(F.coalesce(F.col("text").cast("string"), F.lit("")))
        changed = F.when(F.col("n_chars").isNull(), F.col("n_chars")).otherwise(length.cast(done.schema["n_chars"].dataType))
        done = done.withColumn("n_chars", changed)
    return done


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids, their number, and the digest of the text decoded from them."""
    done = bpe_automaton.coded(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_surrogates", replace_personal),
    ("bpe_encoding", encode_bpe),
]

# The grammar, the surrogates and the ids can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
