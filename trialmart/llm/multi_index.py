"""Approximate nearest neighbours: an inverted multi-index over two vector halves."""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialmart.llm.common import sorted_groups, stored
from trialmart.llm.embeddings import vector_rows

#: Vectors that the centroids are fitted on, and queries that the depth of search is fitted on, at most.
FIT_ROWS, FIT_QUERIES = 20_000, 256
#: Share of the neighbours of the fitted queries that the traversal has to reach.
AIM = 0.96
#: Entries per pair of centroids, about, and centroids per half, at most.
PER_CELL, MOST_CENTROIDS = 8, 1024
#: Entries of a group, and queries compared with them at once.
ENTRIES, QUERIES = 4096, 512


class Index:
    """Centroids of both halves and the number of entries of each pair of them."""

    def __init__(self, halves: tuple[np.ndarray, np.ndarray], width: int):
        self.halves, self.width = halves, width
        self.sizes = np.zeros((len(halves[0]), len(halves[1])), np.int64)
        self.depth = 0

    def parts(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return vectors[:, : self.width // 2], vectors[:, self.width // 2 :]

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of each half."""
        return tuple(_nearest(x, c) for x, c in zip(self.parts(vectors), self.halves, strict=True))

    def traverse(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """All pairs of centroids by summed distance: how far each falls short of the half's best
        inner product. A heap holds the border of what was visited."""
        short, order = [], []
        for part, centroids in zip(self.parts(query[None]), self.halves, strict=True):
            gain = centroids @ part[0]
            order.append(np.argsort(-gain, kind="stable"))
            short.append((gain.max() - gain)[order[-1]].tolist())
        (first, second), (left, right) = short, (o.tolist() for o in order)
        heap = [(0.0, 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            yield left[i], right[j]
            if j + 1 < len(second):
                heapq.heappush(heap, (first[i] + second[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (first[i + 1] + second[0], i + 1, 0))

    def visited(self, query: np.ndarray) -> list[tuple[int, int]]:
        """Non-empty pairs in order, until they hold `depth` entries."""
        out, held = [], 0
        for i, j in self.traverse(query):
            n = int(self.sizes[i, j])
            if n:
                out.append((i, j))
                held += n
                if held >= self.depth:
                    break
        return out


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids * centroids).sum(axis=1) - 2 * x @ centroids.T, axis=1)


def fit_centroids(x: np.ndarray, count: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from distinct random rows; an empty cluster keeps its centroid."""
    distinct = np.unique(x, axis=0)
    centroids = distinct[np.random.default_rng(seed).permutation(len(distinct))[:count]]
    for _ in range(rounds):
        near = _nearest(x, centroids)
        n = np.bincount(near, minlength=len(centroids))
        total = np.zeros_like(centroids)
        np.add.at(total, near, x)
        centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centroids)
    return centroids


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows in double precision; shorter ones end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    vectors, _ = vector_rows(lists)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return out


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors, as doubles without zeros at their end, with a digest."""
    for batch in batches:
        vectors, _ = vector_rows(batch.column("embedding"))
        ids = batch.column("vec_id").to_pylist()
        rows = [(i, np.trim_zeros(v, "b")) for i, v in zip(ids, vectors, strict=True) if i is not None and v is not None and v.any()]
        keys = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() for _, v in rows]
        columns = [pa.array([i for i, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.list_(pa.float64())), pa.array(keys, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "key"])


def _with_cells(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = index.cells(_matrix(batch.column("vector"), index.width))
            columns = [*batch.columns, pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "first", "second"])

    return run


def _with_visits(index: Index):
    """A row per query and first centroid, with the second centroids that are visited beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"), index.width)
            rows, firsts, seconds = [], [], []
            for row, query in enumerate(vectors):
                beside: dict[int, list[int]] = {}
                for i, j in index.visited(query):
                    beside.setdefault(i, []).append(j)
                rows += [row] * len(beside)
                firsts += beside
                seconds += beside.values()
            taken = batch.take(pa.array(rows, pa.int32()))
            columns = [*taken.columns, pa.array(firsts, pa.int32()), pa.array(seconds, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "first", "visits"])

    return run


def _best(index: Index, k: int):
    """The k best entries of a group for each query that visits it: entries come first, queries follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["first", "block"]):
            is_query = group.column("query").to_numpy()
            entries, queries = group.filter(pa.array(~is_query)), group.filter(pa.array(is_query))
            if not (entries.num_rows and queries.num_rows):
                continue
            data, second = _matrix(entries.column("vector"), index.width), entries.column("second").to_numpy()
            reach = np.sqrt((data * data).sum(axis=1)).max()
            for begin in range(0, queries.num_rows, QUERIES):
                part = queries.slice(begin, QUERIES)
                asked = _matrix(part.column("vector"), index.width)
                seen = np.zeros((len(asked), len(index.halves[1])), bool)
                for row, visits in zip(seen, part.column("visits").to_pylist(), strict=True):
                    row[visits] = True
                gain = np.where(seen[:, second], asked @ data.T, -np.inf)
                if len(data) > k:  # as many as may be among the best but for rounding
                    least = np.partition(gain, len(data) - k, axis=1)[:, len(data) - k]
                    slack = 1e-9 * reach * np.sqrt((asked * asked).sum(axis=1))
                    a, b = np.nonzero((gain >= (least - slack)[:, None]) & (gain > -np.inf))
                else:
                    a, b = np.nonzero(gain > -np.inf)
                exact = (asked[a] * data[b]).sum(axis=1)  # summed alike for equal vectors
                columns = [part.column("key").take(pa.array(a)), entries.column("ids").take(pa.array(b)), pa.array(exact)]
                own = pc.equal(columns[0], entries.column("key").take(pa.array(b)))
                found = pa.table([*columns, own], ["query_key", "ids", "score", "own"])
                yield from found.combine_chunks().to_batches()

    return run


def build(distinct: DataFrame, seed: int = 29) -> tuple[Index, DataFrame]:
    """The index over distinct vectors (key, vector, ids), and their table with its cells.

    Centroids are fitted on the FIT_ROWS vectors with the smallest digest; every vector is indexed.
    Without vectors the index has one empty cell.
    """
    total, width = distinct.agg(F.count("*"), F.max(F.size("vector"))).first()
    width = max(2, width or 0)
    sample = _matrix(distinct.orderBy("key").limit(FIT_ROWS).select("vector").toArrow().column("vector"), width)
    sample = sample if total else np.zeros((1, width))
    count = min(MOST_CENTROIDS, max(1, round(math.sqrt(total / PER_CELL))))
    sides = sample[:, : width // 2], sample[:, width // 2 :]
    index = Index(tuple(fit_centroids(x, count, seed + n) for n, x in enumerate(sides)), width)
    kinds = "key binary, vector array<double>, ids array<long>, first int, second int"
    entries = stored(distinct.select("key", "vector", "ids").mapInArrow(_with_cells(index), kinds), "entries")
    counted = entries.groupBy("first", "second").agg(F.count("*").alias("n")).toArrow()
    first, second, n = (counted.column(c).to_numpy() for c in ("first", "second", "n"))
    index.sizes[first, second] = n
    return index, entries


def fit_depth(index: Index, entries: DataFrame, queries: DataFrame, k: int) -> int:
    """Entries that a traversal has to hold so that a share of AIM of the k nearest of a sample of queries,
    found by brute force, is among them."""
    sample = queries.orderBy("key").limit(FIT_QUERIES).select("key", "vector").toArrow()
    asked = _matrix(sample.column("vector"), index.width)
    own = sample.column("key").to_pylist()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(asked), k), -np.inf)
        cells = np.zeros((len(asked), k, 2), np.int64)
        for batch in batches:
            gain = asked @ _matrix(batch.column("vector"), index.width).T
            of_key = {key: i for i, key in enumerate(batch.column("key").to_pylist())}
            for row, key in enumerate(own):
                if key in of_key:
                    gain[row, of_key[key]] = -np.inf
            cell = np.stack([batch.column(c).to_numpy() for c in ("first", "second")], axis=1)
            cells = np.concatenate([cells, np.broadcast_to(cell, (len(asked), *cell.shape))], axis=1)
            best = np.concatenate([best, gain], axis=1)
            top = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, cells = np.take_along_axis(best, top, 1), np.take_along_axis(cells, top[:, :, None], 1)
        row = pa.array(np.repeat(np.arange(len(asked)), k))
        columns = [row, pa.array(best.ravel()), pa.array(cells[:, :, 0].ravel()), pa.array(cells[:, :, 1].ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "gain", "first", "second"])

    found = entries.mapInArrow(nearest, "row long, gain double, first long, second long").where("gain > double('-Infinity')")
    ranked = found.withColumn("place", F.row_number().over(W.partitionBy("row").orderBy(F.desc("gain"), "first", "second")))
    near: dict[int, list[tuple[int, int]]] = {}
    for row, i, j in ranked.where(F.col("place") <= k).select("row", "first", "second").collect():
        near.setdefault(row, []).append((i, j))
    needed = []
    for row, cells in near.items():
        held, at = 0, {}
        for cell in index.traverse(asked[row]):
            held += int(index.sizes[cell])
            at[cell] = held
        needed += [at[c] for c in cells]
    return int(np.quantile(needed, AIM, method="higher")) if needed else 1


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, seed: int = 29) -> DataFrame:
    """One row (query_id, rank, vec_id, score) for each of the k nearest rows found per query.

    Queries are the rows whose vec_id is divisible by `every`; candidates are all rows but the query's own; nearness is
    the inner product of the original vectors in double precision; ties go to the smaller vec_id. Null and zero vectors, those
    with a null or non-finite component, and rows without vec_id take no part; shorter vectors end in
    zeros. Each of several equal rows is a candidate, and a query, of its own. Other columns are ignored.

    Equal vectors are one entry, with its k + 1 smallest ids, which is all that answers can name. A query
    visits pairs of centroids in order until they hold a number of entries that reaches AIM of the
    neighbours of a sample; all entries of visited pairs are compared exactly. Entries meet queries by first
    centroid, in blocks of about ENTRIES rows, so a crowded cell is spread over tasks and none is cut.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = stored(rows.mapInArrow(_usable, "vec_id long, vector array<double>, key binary"), "usable")
    smallest = usable.withColumn("n", F.row_number().over(W.partitionBy("key").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    ids = F.sort_array(F.collect_list("vec_id")).alias("ids")
    distinct = stored(smallest.groupBy("key").agg(F.first("vector").alias("vector"), ids), "distinct")
    asked = stored(usable.where(F.col("vec_id") % every == 0).groupBy("key", "vec_id").agg(F.count("*").alias("times")), "asked")
    queries = stored(distinct.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vector"), "queries")

    index, entries = build(distinct, seed)
    index.depth = fit_depth(index, entries, queries, k)
    sizes = [max(1, -(-int(n) // ENTRIES)) for n in index.sizes.sum(axis=1)]
    blocks = F.get(F.array(*map(F.lit, sizes)), F.col("first"))
    stock = entries.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int")).withColumn("query", F.lit(False))
    visits = queries.mapInArrow(_with_visits(index), "key binary, vector array<double>, first int, visits array<int>")
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("query", F.lit(True))
    dealt = stock.unionByName(visits, allowMissingColumns=True).repartition("first", "block").sortWithinPartitions("first", "block", "query")
    found = dealt.mapInArrow(_best(index, k + 1), "query_key binary, ids array<long>, score double, own boolean")

    order = W.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", F.desc("own"))
    found = found.select("query_key", "score", "own", F.explode("ids").alias("vec_id")).withColumn("place", F.row_number().over(order))
    best = F.sort_array(F.collect_list(F.struct("place", "vec_id", "score", "own"))).alias("best")
    found = stored(found.where(F.col("place") <= k + 1).groupBy("query_key").agg(best), "found")
    answers = asked.select(F.col("key").alias("query_key"), F.col("vec_id").alias("query_id"), F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    answers = answers.join(found, "query_key")
    self = F.array_position(F.transform("best", lambda x: x.own & (x.vec_id == F.col("query_id"))), F.lit(True)).cast("int")
    others = F.when(self > 0, F.concat(F.slice("best", F.lit(1), self - 1), F.slice("best", self + 1, F.lit(k)))).otherwise(F.slice("best", 1, k))
    answers = answers.select("query_id", F.posexplode(others).alias("place", "hit"))
    return answers.select("query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.score")
