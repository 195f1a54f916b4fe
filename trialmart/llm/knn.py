"""Exact top-k inner products: a Voronoi kNN join."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialmart.llm.common import sorted_groups, stored
from trialmart.llm.embeddings import vector_rows

#: Cells; their pivots are this many vectors, those with the smallest hash of the id.
PIVOTS = 16
#: Data rows and queries that meet in one group, about.
DATA_BLOCK, QUERY_BLOCK = 4096, 1024

_EXACT = float(1 << 53)


def _integers(scale: int):
    """Usable vectors as whole numbers floor(scale * x), with their squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, _ = vector_rows(batch.column("embedding"))
            ids = batch.column("vec_id").to_pylist()
            rows = {"vec_id": [], "code": [], "norm2": [], "key": []}
            for i, v in zip(ids, vectors, strict=True):
                if v is not None and i is not None:
                    x = np.clip(np.floor(scale * v), -(2.0**62), 2.0**62).astype("<i8")
                    rows["vec_id"].append(i)
                    rows["code"].append(x.tobytes())
                    rows["norm2"].append(float((x.astype(float) ** 2).sum()))
                    rows["key"].append(hashlib.blake2b(x.tobytes(), digest_size=8).digest())
            kinds = [("vec_id", pa.int64()), ("code", pa.binary()), ("norm2", pa.float64()), ("key", pa.binary())]
            yield pa.RecordBatch.from_pydict(rows, pa.schema(kinds))

    return run


def _matrix(codes: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(codes), width))
    for i, x in enumerate(codes):
        v = np.frombuffer(x.as_buffer(), "<i8")
        out[i, : len(v)] = v
    return out


def _distances(x: np.ndarray, norm2: np.ndarray, pivots: np.ndarray, pivot2: np.ndarray, top2: float, query: bool) -> np.ndarray:
    """Distances to the pivots after one more coordinate gave all data vectors one length; a query's is
    zero there. Among data, nearer then means a larger inner product."""
    dots = x @ pivots.T
    if query:
        square = norm2[:, None] + top2 - 2 * dots
    else:
        extra = np.sqrt(np.maximum(top2 - norm2, 0))[:, None] * np.sqrt(np.maximum(top2 - pivot2, 0))[None, :]
        square = 2 * top2 - 2 * (dots + extra)
    return np.sqrt(np.maximum(square, 0))


def _summaries(pivots, pivot2, top2, k: int, every: int):
    """Per batch and cell: the k + 1 smallest distances of data, or the number and radius of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, norm2 = _matrix(batch.column("code"), pivots.shape[1]), batch.column("norm2").to_numpy()
            rows = {"cell": [], "query": [], "value": [], "n": []}
            for query in (False, True):
                mine = batch.column("vec_id").to_numpy() % every == 0 if query else np.ones(len(x), bool)
                d = _distances(x[mine], norm2[mine], pivots, pivot2, top2, query)
                cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
                for c in np.unique(cell):
                    own = np.sort(d[cell == c, c])
                    values, n = (own[-1:], len(own)) if query else (own[: k + 1], 0)
                    for v in values:
                        for name, value in zip(rows, (int(c), query, float(v), n), strict=True):
                            rows[name].append(value)
            kinds = [("cell", pa.int32()), ("query", pa.bool_()), ("value", pa.float64()), ("n", pa.int64())]
            yield pa.RecordBatch.from_pydict(rows, pa.schema(kinds))

    return run


def _replicas(pivots, pivot2, top2, reach, blocks, salts: int, every: int):
    """Deals each query to its cell's groups, and each data row to the cells that may need it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("vec_id").to_numpy()
            x, norm2 = _matrix(batch.column("code"), pivots.shape[1]), batch.column("norm2").to_numpy()
            spread = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            row, cell, salt, block, query = [], [], [], [], []
            near = _distances(x, norm2, pivots, pivot2, top2, False) <= reach[None, :]
            for c in np.flatnonzero(blocks):
                mine = np.flatnonzero(near[:, c])
                for b in range(blocks[c]):
                    row.append(mine)
                    salt.append(spread[mine] % salts)
                    cell.append(np.full(len(mine), c))
                    block.append(np.full(len(mine), b))
                    query.append(np.zeros(len(mine), bool))
            asked = np.flatnonzero(ids % every == 0)
            home = _distances(x[asked], norm2[asked], pivots, pivot2, top2, True).argmin(axis=1) if len(asked) else asked
            for s in range(salts):
                row.append(asked)
                salt.append(np.full(len(asked), s))
                cell.append(home)
                block.append((spread[asked] >> 8) % np.maximum(blocks[home], 1))
                query.append(np.ones(len(asked), bool))
            at = np.concatenate(row)
            for begin in range(0, len(at), 20_000):
                piece = slice(begin, begin + 20_000)
                columns = [pa.array(np.concatenate(v)[piece].astype(np.int32)) for v in (cell, block, salt)]
                columns.append(pa.array(np.concatenate(query)[piece]))
                columns += [batch.column(n).take(pa.array(at[piece])) for n in ("vec_id", "code", "key")]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "block", "salt", "query", "vec_id", "code", "key"])

    return run


def _products(asked: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit whole numbers; exact, and held to that range if they leave it."""
    bound = np.abs(asked).max(initial=0) * np.abs(data).max(initial=0) * asked.shape[1]
    if bound < _EXACT:
        return (asked @ data.T).astype(np.int64)
    exact = asked.astype(np.int64).astype(object) @ data.astype(np.int64).astype(object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _solve(k: int, width: int):
    """The k best data rows of a group for each of its queries; queries come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["cell", "block", "salt"]):
            is_query = group.column("query").to_numpy()
            asked = group.filter(pa.array(is_query))
            data = group.filter(pa.array(~is_query))
            if not asked.num_rows or not data.num_rows:
                continue
            q_ids, d_ids = asked.column("vec_id").to_numpy(), data.column("vec_id").to_numpy()
            order = np.argsort(d_ids, kind="stable")
            d_ids = d_ids[order]
            scores = _products(_matrix(asked.column("code"), width), _matrix(data.column("code"), width)[order])
            rows: list[np.ndarray] = []
            for i in range(len(q_ids)):
                allowed = np.flatnonzero(d_ids != q_ids[i])
                best = allowed[np.argsort(-scores[i, allowed], kind="stable")[:k]]
                rows.append(np.column_stack([np.full(len(best), i), best]))
            at = np.concatenate(rows)
            columns = [
                pa.array(q_ids[at[:, 0]]),
                asked.column("key").combine_chunks().take(pa.array(at[:, 0])),
                pa.array(d_ids[at[:, 1]]),
                pa.array(scores[at[:, 0], at[:, 1]]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "key", "vec_id", "score"])

    return run


def top_products(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """The k largest inner products (query_id, rank, vec_id, score) of each query with the other rows.

    Vectors become whole numbers floor(scale * x). Queries are rows whose vec_id is divisible by `every`;
    candidates are all rows with another vec_id; ties go to the smaller vec_id, and a query with
    fewer candidates gets all. Null vectors, those with a null or non-finite component and rows without vec_id take
    no part. Shorter vectors are as if filled up with zeros, so an empty one scores 0. Repeated rows
    count once. Other columns are ignored.

    Queries and data are grouped by their nearest pivot. From each cell's radius and its k + 1 smallest
    distances follows how far from a cell's pivot an answer can lie, and data rows are dealt only
    to the cells that they may serve. Cells are dealt in blocks of bounded size, solved apart and merged.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    coded = rows.mapInArrow(_integers(scale), "vec_id long, code binary, norm2 double, key binary")
    coded = stored(coded.dropDuplicates(["vec_id", "key"]), "codes")
    seeds = coded.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).select("code", "norm2").collect()
    found = "query_id long, key binary, vec_id long, score long"
    total, top2, longest = coded.agg(F.count("*"), F.max("norm2"), F.max(F.length("code"))).first()
    if not total:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, longest // 8)
    pivots, pivot2 = _matrix(pa.array([bytes(r["code"]) for r in seeds], pa.binary()), width), np.array([r["norm2"] for r in seeds])
    parts = coded.mapInArrow(_summaries(pivots, pivot2, top2, k, every), "cell int, query boolean, value double, n long")
    parts = stored(parts, "summaries")
    asked = parts.where("query").groupBy("cell").agg(F.max("value").alias("radius"), F.sum("n").alias("n")).collect()
    order = W.partitionBy("cell").orderBy("value")
    small = parts.where("NOT query").withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).select("cell", "value").collect()
    reach, blocks = np.full(len(pivots), -1.0), np.zeros(len(pivots), np.int64)
    slack = 1e-6 * (1 + np.sqrt(top2))
    for r in asked:
        lead = _distances(pivots[[r["cell"]]], pivot2[[r["cell"]]], pivots, pivot2, top2, False)[0]
        bounds = np.sort([r["radius"] + lead[c] + d for c, d in small])
        bound = bounds[k] if len(bounds) > k else np.inf
        reach[r["cell"]] = bound + r["radius"] + slack
        blocks[r["cell"]] = -(-r["n"] // QUERY_BLOCK)
    salts = -(-total // DATA_BLOCK)
    dealt = coded.mapInArrow(
        _replicas(pivots, pivot2, top2, reach, blocks, salts, every),
        "cell int, block int, salt int, query boolean, vec_id long, code binary, key binary",
    )
    dealt = dealt.repartition("cell", "block", "salt").sortWithinPartitions("cell", "block", "salt")
    best = dealt.mapInArrow(_solve(k, width), found)
    rank = F.row_number().over(W.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return best.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
