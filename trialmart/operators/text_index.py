"""Search over trials by an inverted index of trigrams, with an exact check of what it finds."""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.sources import storage
from trialmart.sources.search import TERM_COLUMNS, search_trials

# executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block. A posting list holds the rows of one block, so it has no more entries than that
#: however common its trigram is; rows are stored by block.
BLOCK = 8192
BLOCK_COLUMN, ROW = "row_block", "row_number"
INDEXED = [*TERM_COLUMNS, "LeadSponsorName", "Phase", "Status"]
POSTINGS = f"field string, gram string, {BLOCK_COLUMN} bigint, rows array<int>"
#: Search criterion -> columns it is looked up in.
CRITERIA = {
    "search_terms": TERM_COLUMNS,
    "conditions": ["Condition"],
    "sponsors": ["LeadSponsorName"],
    "phases": ["Phase"],
    "status": ["Status"],
}


def build_index(trials: DataFrame, path: str, block: int | None = None) -> None:
    """Store trials below `path`: rows in order of their id by block, and the posting lists of each block (`_lists_of`).

    Rows move once, into that order; the number a row gets there names its block and, from 0, its place in the
    block. What is indexed is read again without the other columns.
    """
    spark, block = trials.sparkSession, block or BLOCK
    ordered = trials.repartitionByRange("NCTId").sortWithinPartitions("NCTId").withColumn(ROW, F.monotonically_increasing_id())
    # numbers of a partition start at a multiple of 2**33, so its blocks are its own
    per_part = -(-(1 << 33) // block)
    part, place = F.shiftright(ROW, 33), F.col(ROW).bitwiseAND(F.lit((1 << 33) - 1))
    numbered = ordered.withColumns({BLOCK_COLUMN: part * F.lit(per_part) + F.floor(place / block), ROW: (place % block).cast("int")})
    storage.write_table(numbered, f"{path}/rows", partition_by=(BLOCK_COLUMN,))
    storage.write_table(numbered.limit(0).coalesce(1), f"{path}/columns")
    texts = _rows(spark, path).select(BLOCK_COLUMN, ROW, *[F.lower(F.col(c)).alias(c) for c in INDEXED])
    lists = texts.groupBy(BLOCK_COLUMN).applyInArrow(_lists_of, POSTINGS)
    lists = lists.hint("rebalance", "field", "gram").sortWithinPartitions("field", "gram", BLOCK_COLUMN)
    storage.write_table(lists, f"{path}/postings", partition_by=("field",))


def _lists_of(rows: pa.Table) -> pa.Table:
    """The posting lists of one block, all sorted. Per column and trigram: the first rows of the texts that hold
    it. Per column and text of several rows, without a trigram: those rows, of which the first stands for the text.
    Work and lists grow with the different texts of a block."""
    block, found = rows.column(BLOCK_COLUMN)[0].as_py(), []
    rows = rows.sort_by(ROW)
    numbers = rows.column(ROW).to_numpy()
    for field in INDEXED:
        column = rows.column(field).combine_chunks().dictionary_encode()
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        held = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        codes, texts = column.indices.drop_null().to_numpy(), column.dictionary.to_pylist()
        order = np.argsort(codes, kind="stable")
        of_text = np.split(numbers[held[order]], np.cumsum(np.bincount(codes, minlength=len(texts)))[:-1]) if texts else []
        firsts: dict[str, list[int]] = {}
        for text, here in sorted(zip(texts, of_text, strict=True), key=lambda x: x[1][0]):
            grams = {text[i : i + 3] for i in range(len(text) - 2)}
            for gram in grams:
                firsts.setdefault(gram, []).append(here[0])
            if grams and len(here) > 1:
                found.append((field, None, here))
        found += [(field, gram, first) for gram, first in firsts.items()]
    kind = pa.schema([("field", pa.string()), ("gram", pa.string()), (BLOCK_COLUMN, pa.int64()), ("rows", pa.list_(pa.int32()))])
    fields, grams, lists = zip(*found, strict=True) if found else ((), (), ())
    return pa.table([pa.array(fields, pa.string()), pa.array(grams, pa.string()), pa.array([block] * len(found), pa.int64()), pa.array(lists, pa.list_(pa.int32()))], schema=kind)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return storage.read_table(spark, f"{path}/rows", storage.read_table(spark, f"{path}/columns").schema)


def grams_of(word: str) -> set[str]:
    """The trigrams of a lower-case word that the index holds."""
    return {g for g in (word[i : i + 3] for i in range(len(word) - 2)) if max(g) <= "￿"}


def _candidates(spark: SparkSession, path: str, columns: list[str], words: list[str]) -> DataFrame | None:
    """Per block the list of rows that hold all trigrams of some word in some column; None if a word has none."""
    wanted = {word: grams_of(word) for word in {w.lower() for w in words}}
    if not all(wanted.values()):
        return None
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("field").isin(columns))
    asked = sorted((word, gram) for word, grams in wanted.items() for gram in grams)
    words_of = F.create_map(
        *[F.lit(x) for gram in sorted({g for _, g in asked}) for x in (gram, [w for w, g in asked if g == gram])]
    )
    found = postings.where(F.col("gram").isin(sorted({g for _, g in asked})))
    found = found.select("field", BLOCK_COLUMN, "rows", F.explode(words_of[F.col("gram")]).alias("word"))
    lists = F.sort_array(F.collect_list(F.struct(F.size("rows").alias("n"), "rows"))).alias("lists")
    met = found.groupBy("word", "field", BLOCK_COLUMN).agg(lists)
    sizes = F.create_map(*[F.lit(x) for word, grams in sorted(wanted.items()) for x in (word, len(grams))])
    met = met.where(F.size("lists") == sizes[F.col("word")])  # rarest first
    rest = F.slice("lists", F.lit(2), F.size("lists"))
    both = F.aggregate(rest, F.col("lists")[0]["rows"], lambda kept, x: F.array_intersect(kept, x["rows"]))
    firsts = met.select("field", BLOCK_COLUMN, F.explode(both).alias("first")).distinct()
    repeated = postings.where("gram IS NULL").select("field", BLOCK_COLUMN, F.col("rows")[0].alias("first"), "rows")
    texts = firsts.join(repeated, ["field", BLOCK_COLUMN, "first"], "left")
    held = texts.select(BLOCK_COLUMN, F.coalesce("rows", F.array("first")).alias("rows"))
    return held.groupBy(BLOCK_COLUMN).agg(F.array_distinct(F.flatten(F.collect_list("rows"))).alias("rows"))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    met = a.join(b.withColumnRenamed("rows", "others"), BLOCK_COLUMN)
    return met.select(BLOCK_COLUMN, F.array_intersect("rows", "others").alias("rows"))


def search_index(spark: SparkSession, path: str, **criteria) -> DataFrame:
    """The rows that search_trials finds with the same criteria, read from the blocks of candidates only.

    A criterion with a word of fewer than three letters cannot use the index and is left to the check; without any
    other criterion all blocks are read. The list of blocks is a number for each BLOCK rows at most.
    """
    asked = {name: words for name, words in criteria.items() if name in CRITERIA and words}
    found = [_candidates(spark, path, CRITERIA[name], words) for name, words in asked.items()]
    found = [f for f in found if f is not None]
    rows = _rows(spark, path)
    if found:
        rowed = storage.materialize(reduce(_both, found).select(BLOCK_COLUMN, F.explode("rows").alias(ROW)), "search-candidates")
        blocks = [r[0] for r in rowed.select(BLOCK_COLUMN).distinct().collect()]
        rows = rows.where(F.col(BLOCK_COLUMN).isin(blocks)).join(rowed, [BLOCK_COLUMN, ROW], "left_semi")
    return search_trials(rows.drop(BLOCK_COLUMN, ROW), **criteria)
