"""Corpus pipeline: five stages, each one of the corpus operators.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of ``documents``; the
last adds replica and mix_rank. Filtering stages drop whole documents and
leave the others as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import decontamination, langid, mixing, pii, simhash_dedup
from skyfold.llm.common import materialise, read_table, ship_package
from skyfold.llm.queries import MIX_EPOCHS, SOURCE_WEIGHTS

#: Least posterior of the predicted language; texts below it have no clear language.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a clear language; those without a letter, or below MIN_LANGUAGE_SCORE, go.

    The model learns from the stage's own documents and their ``lang``. If no
    row has a language there is nothing to reject by, and texts with a letter stay.
    """
    model = langid.train(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    clear = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    unclear = materialise(langid.identify(model, docs).filter(~clear).select(
        F.col("doc_id").alias("_lid"), F.col("th").alias("_lth")).distinct(), "unclear_language")
    return docs.join(unclear, docs["doc_id"].eqNullSafe(F.col("_lid")) & (F.xxhash64(docs["text"]) == F.col("_lth")),
                     "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of each group of near copies."""
    return simhash_dedup.drop_near_duplicates(docs, shingle_words=3, max_distance=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data replaced by tags, n_chars updated where a text changes."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, shuffled globally."""
    return mixing.mix(docs, SOURCE_WEIGHTS, epochs=MIX_EPOCHS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("pii", redact_personal_data),
    ("source_mixing", mix_sources),
]

#: Trained models, XXH64 fingerprints and an iterated graph are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
