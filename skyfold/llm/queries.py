"""The registered queries opN_<name>: each applies its operator to a whole table."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import (brown_lm, conversation_repair, decontamination, embedding_dedup, hard_negatives, langid,
                         mixing, packing, pii, quality, simhash_dedup, toxicity, warc)
from skyfold.llm.common import fold, read_table, ship_package
from skyfold.session import work_path

#: Relative weights of the sources in op9 and the pipeline; other sources weigh 1.
SOURCE_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}
#: Share of documents the mix holds, in expectation.
MIX_EPOCHS = 1.0
#: The vocabulary file op13 tokenises with; every worker reads it.
TOKENIZER_NAME = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER_NAME) -> str:
    """Where the public vocabularies of this machine keep the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out(id_col: str, modulus: int, remainder: int):
    """Whether a row is kept from learning; a null id has no remainder and is held out."""
    return F.coalesce(fold(id_col, modulus) == remainder, F.lit(True))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op2_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "archives")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.capture_history(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured")


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), *(F.size(k).cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(pii.spans_text(False).cast("binary"), 256).alias("base_sha256"), pii.spans_text(True).alias("spans"),
        F.size("added").cast("long").alias("n_added"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.simhash_groups(read_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(~_held_out("doc_id", 5, 0))
    model = quality.train(docs, labels)
    return docs.select("doc_id", _held_out("doc_id", 5, 0).alias("held_out"),
                       quality.score(model, docs).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.3).cast("int"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~_held_out("doc_id", 4, 2)))
    return langid.identify(model, docs).select(
        "doc_id", _held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").filter(~_held_out("doc_id", 3, 1))
    scored = toxicity.train(docs, labels).score(docs, "doc_id", "text")
    return scored.select("doc_id", _held_out("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, epochs=MIX_EPOCHS)
    return mixed.select("doc_id", "source", "lang", "n_chars", "replica")


def op10_brown_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = brown_lm.train(docs.filter(~_held_out("doc_id", 5, 1)))
    return brown_lm.score(model, docs).select(
        "doc_id", _held_out("doc_id", 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    found = conversation_repair.edits(conversation_repair.damage(conversations))
    return conversation_repair.digest(found, conversations)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenise(read_table(spark, sf_dir, "documents"), tokenizer_path())
    placed = packing.place(pieces, columns=(F.crc32("ids").alias("ids_crc32"),))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                         "sequence_id", "offset")


def _shipped(query):
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_embedding_near_dedup, op2_warc_index_merge, op3_pii_bootstrap, op4_simhash_near_dedup,
    op5_quality_classifier, op6_language_id, op7_benchmark_decontamination, op8_toxicity, op9_poisson_mixing,
    op10_brown_lm_scoring, op11_conversation_repair, op12_hard_negatives, op13_best_fit_packing)}
