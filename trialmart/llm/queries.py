"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialmart.llm import bpe, chat, embeddings, jaccard, knn, language, mixing, multi_index, periods, spelling, toxicity, unigram, warc
from trialmart.llm.common import table
from trialmart.sources.storage import new_run_folder


#: Rank file of the byte-level vocabulary.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Model file whose pieces and scores serve as a unigram vocabulary.
PIECES = "piece_bpe_32k.model"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those whose id is not held out (crc32 mod 3)."""
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs, folds=3, fold=1))
    held = language.in_fold("doc_id", 3, 1).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score", "n_words", "n_other")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and what they decode to."""
    path = public_tokenizers.path(RANKS)
    return bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, with_ids=False)


def op3_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at cosine 0.9."""
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all sources takes of every document, in order of training time."""
    mixed = mixing.by_first_position(mixing.assign(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of documents at Jaccard similarity 0.85 on 4-word shingles."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, and what can be read back from the output."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    return chat.digest(chat.format_turns(turns.unionByName(more))).drop("rewritten")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels whose id is not held out (crc32 mod 4)."""
    docs = table(spark, sf_dir, "documents")
    scorer = toxicity.learn(docs, table(spark, sf_dir, "labels"), folds=4, fold=2)
    held = toxicity.in_fold("doc_id", 4, 2).alias("held_out")
    return toxicity.score(docs, scorer).select("doc_id", held, "score", "predicted")


def op8_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return knn.top_products(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under a unigram vocabulary."""
    return unigram.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    path = new_run_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, least=0)
    return warc.describe(warc.read_archives(spark, path))


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest found of every twentieth vector, by inner product."""
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least seven letters of all documents with planted slips, and the form each is a variant of."""
    words = spelling.vocabulary(table(spark, sf_dir, "documents"), least_letters=7, least_count=2, slips=31)
    return spelling.variants(words, least_letters=7, factor=10)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, with planted periods."""
    docs = periods.with_planted_periods(table(spark, sf_dir, "documents"))
    return periods.digest(periods.periodic_runs(docs))


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_language,
        op2_byte_bpe,
        op3_embedding_links,
        op4_source_mix,
        op5_ngram_jaccard,
        op6_chat_format,
        op7_toxicity,
        op8_top_products,
        op9_token_counts,
        op10_warc,
        op11_multi_index,
        op12_spelling,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in found}
