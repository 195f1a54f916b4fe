"""A corpus pipeline of five stages over the table of documents.

Each stage takes what its predecessor kept and returns the columns of documents; the last returns
the documents encoded. Columns that a stage does not read are passed on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trialmart.llm import bpe, jaccard, language, mixing, toxicity
from trialmart.llm.common import stored, table
from trialmart.llm.queries import RANKS

#: Near duplicates: five-word shingles, similarity 0.8.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the scorer learns from labels outside its held-out fold.

    Null and empty texts match nothing and stay; repeated rows share one decision.
    """
    return toxicity.keep_clean(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text is null or has no letter; a text in several languages stays with the one that
    most of it is in. That language stands in `lang` from here on, whatever stood there, and is passed on with the token
    ids. Repeated rows and null ids are decided row by row; without documents nothing is learned."""
    return language.keep_determined(docs, language.learn(docs), least=0.0, column="lang")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Null and empty texts have no shingles and stay; of rows equal in doc_id and text one stays; rows
    without doc_id stay. Columns pass unchanged, whatever their names."""
    return jaccard.representatives(docs, NEAR_WIDTH, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in order of training time.

    Null and empty texts have size 0: they are taken no time or whole rounds like the rest of their source;
    a null source is one of its own; ties in order go by doc_id."""
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with digests of ids and decoded text, and its language. A null or empty
    text has none; repeated rows and null ids are passed on."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, carry=("lang",))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language ID", keep_languages),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode),
]

#: SQL cannot express the learned stages; the tests follow run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each result is stored before the next starts.

    An empty table runs through; nulls, ties and repeated rows are each stage's own matter, see there."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
