"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from trialmart.sources import storage

#: Spark's switch by which the shuffle files of a query go when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: A side of a join is broadcast only after its rows were counted and are no more than this
#: (at 16 bytes a row, 16 MB); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, so later steps survive lost executors."""
    return storage.materialize(df, label)


class Scratch:
    """Tables of an operator in the shared folder that go when it says so, at the latest when it ends. While
    it runs, shuffle files go with the query that wrote them, not when the driver happens to collect its
    garbage; a setting of the session's own stays."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held, self.switched = spark, [], False

    def __enter__(self) -> Scratch:
        self.switched = self.spark.conf.get(SHUFFLES_GO, None) is None
        if self.switched:
            self.spark.conf.set(SHUFFLES_GO, "true")
        return self

    def __exit__(self, *error) -> None:
        self.drop(*[df for df, _ in self.held])
        if self.switched:
            self.spark.conf.unset(SHUFFLES_GO)

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = storage.new_run_folder(self.spark, label)
        storage.write_table(df, path)
        found = storage.read_table(self.spark, path, df.schema)
        self.held.append((found, path))
        return found

    def keep(self, df: DataFrame) -> None:
        """This table outlives the operator."""
        self.held = [x for x in self.held if x[0] is not df]

    def drop(self, *frames: DataFrame) -> None:
        """Delete these tables; nothing that reads them may run any more."""
        for df, path in [x for x in self.held if any(x[0] is f for f in frames)]:
            storage.remove_folder(self.spark, path)
            self.keep(df)


#: Rows and bytes of the Arrow batches that texts travel in, where the session names none.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def texts_of(docs: DataFrame) -> DataFrame:
    """The documents, after the session was told to send texts to Python in small batches: rows of
    texts are long, and a batch is held in the JVM and in the worker at once. Settings of the session's
    own stay."""
    conf = docs.sparkSession.conf
    for key, value in BATCH.items():
        if conf.get(key, None) is None:
            conf.set(key, value)
    return docs


def give_back() -> None:
    """Return free memory of this worker to the system, as far as its libraries can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library on Linux
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches that gives memory back at the end of its task: workers stay, and
    what an idle one holds is missing elsewhere on the executor."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


#: Rows of a batch of numbers that a worker returns at once: what the JVM takes for a larger one, it keeps.
RETURNED = 65_536


def row_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in batches of at most RETURNED rows."""
    for start in range(0, batch.num_rows, RETURNED):
        yield batch.slice(start, RETURNED)


def text_slices(batch: pa.RecordBatch, column: str, characters: int):
    """Slices of a batch whose texts add up to about so many bytes; a longer text is alone."""
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + characters, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array, lower_ascii: bool) -> tuple[pa.Array, np.ndarray]:
    """All words (runs without ASCII white space) of the texts in order, and words per text."""
    texts = pc.fill_null(texts, "")
    if lower_ascii:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    keep = pc.not_equal(flat, "")  # blanks at either end of a text leave an empty item
    counts = np.bincount(owner[keep.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return flat.filter(keep), counts


def worker_cache(owner: str) -> dict:
    """What an operator keeps in a Python worker from task to task; whatever another operator
    left there goes first, and with it the memory it held."""
    held = sys.modules.setdefault("_trialmart_worker", types.ModuleType("_trialmart_worker")).__dict__
    if held.get("owner") != owner:
        held["owner"], held["kept"] = owner, {}
        give_back()
    return held["kept"]


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, across batches; the input is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            changed |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
