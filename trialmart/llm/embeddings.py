"""Near-duplicate vectors: Euclidean p-stable hashing, followed by exact cosines."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import sorted_groups, stored
from trialmart.llm.components import connected_components

#: Tables, projections per table and the width of a projection's cells. Unit vectors at cosine 0.9 are
#: 0.447 apart; a projection keeps them together with probability 0.867, a table with 0.18, and
#: 24 tables miss 1 % of such pairs (at cosine 0.95, 1 pair in 6,000).
TABLES, PROJECTIONS, WIDTH = 24, 12, 2.68
#: Members of a bucket that are compared as one block.
BLOCK = 2000


def vector_rows(column: pa.Array) -> tuple[list[np.ndarray | None], dict[int, list[int]]]:
    """Finite vectors of a list column in double precision (None for others), and rows by length."""
    out: list[np.ndarray | None] = []
    by_length: dict[int, list[int]] = {}
    for i, x in enumerate(column):
        values = x.values if x.is_valid else None
        if values is None or values.null_count:
            out.append(None)
            continue
        v = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
        ok = np.isfinite(v).all()
        out.append(v if ok else None)
        if ok:
            by_length.setdefault(len(v), []).append(i)
    return out, by_length


def _unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by way of their largest component so that nothing overflows."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds a digest of each usable vector; others, and rows without an id, get none."""
    for batch in batches:
        vectors, _ = vector_rows(batch.column("embedding"))
        ids = batch.column("vec_id").to_pylist()
        keys = [
            hashlib.blake2b(v.tobytes(), digest_size=16).digest() if v is not None and i is not None and v.any() else None
            for v, i in zip(vectors, ids, strict=True)
        ]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])


def bucket_codes(units: np.ndarray, seed: int, tables: int, projections: int, width: float) -> np.ndarray:
    """One bucket per table for each vector: a hash of its quantised random projections."""
    dice = np.random.default_rng([seed, units.shape[1]])
    lines = dice.standard_normal((units.shape[1], tables * projections))
    shift = dice.uniform(0, width, tables * projections)
    cells = np.floor((units @ lines + shift) / width).astype(np.int64).view(np.uint64).reshape(len(units), tables, projections)
    factors = dice.integers(1, 1 << 62, (tables, projections), dtype=np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        h = (cells * factors).sum(axis=2, dtype=np.uint64)
        return ((h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _codes(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, by_length = vector_rows(batch.column("embedding"))
            codes = np.zeros((batch.num_rows, TABLES), np.int64)
            for rows in by_length.values():
                codes[rows] = bucket_codes(_unit(np.stack([vectors[i] for i in rows])), seed, TABLES, PROJECTIONS, WIDTH)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * TABLES), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    return run


def _link_blocks(cosine: float):
    """Compares two blocks of a bucket, or one with itself, and counts each pair in the first table
    that holds it. Of the pairs only sums per vector and links to a smallest id leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["place", "code", "low", "high"]):
            if group.num_rows < 2:
                continue
            place = group.column("place")[0].as_py()
            one = group.column("low")[0].as_py() == group.column("high")[0].as_py()
            ids = group.column("id").to_numpy()
            weight = group.column("n").to_numpy()
            side = group.column("block").to_numpy() == group.column("low")[0].as_py()
            codes = np.stack([c.values.to_numpy() for c in group.column("codes")])
            vectors, by_length = vector_rows(group.column("embedding").combine_chunks())
            first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for rows in by_length.values():
                units = _unit(np.stack([vectors[i] for i in rows]))
                rows = np.array(rows)
                left = np.flatnonzero(side[rows])
                right = left if one else np.flatnonzero(~side[rows])
                a, b = np.nonzero(units[left] @ units[right].T >= cosine)
                first.append(rows[left[a]])
                second.append(rows[right[b]])
            a, b = np.concatenate(first), np.concatenate(second)
            if one:
                a, b = a[a < b], b[a < b]
            if place:
                new = np.ones(len(a), bool)
                for t in range(place):
                    new &= codes[a, t] != codes[b, t]
                a, b = a[new], b[new]
            if not len(a):
                continue
            links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
            root = ids.copy()
            while True:  # the smallest id reachable within the block
                low = np.minimum(root[a], root[b])
                before = root.copy()
                np.minimum.at(root, a, low)
                np.minimum.at(root, b, low)
                if (before == root).all():
                    break
            some = links > 0
            columns = [pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])]
            yield pa.RecordBatch.from_arrays(columns, ["id", "links", "root"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, seed: int = 17) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per vector.

    Vectors link at this cosine or more (in double precision), if some table put them in one bucket.
    n_links counts the other vectors linked directly, component_id is the smallest vec_id reachable,
    kept marks it. Null, zero and empty vectors, those with a null or non-finite component and rows
    without vec_id link with nothing; vectors of different lengths do not link. Repeated rows count one by
    one; other columns, labels among them, are ignored.

    Equal vectors are one, with a weight. A bucket with more than BLOCK members is compared in pairs of
    blocks, each a group of its own; the list of such buckets is at most the number of
    hashed rows divided by BLOCK. Pairs stay inside the group that finds them.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kind = rows.schema["embedding"].dataType.simpleString()
    keyed = stored(rows.mapInArrow(_keys, f"vec_id long, embedding {kind}, key binary"), "vectors")
    usable = keyed.where("key IS NOT NULL").groupBy("key")
    same = usable.agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    coded = stored(same.mapInArrow(_codes(seed), f"key binary, id long, n long, embedding {kind}, codes array<long>"), "codes")

    placed = coded.select("id", "n", "embedding", "codes", F.posexplode("codes").alias("place", "code"))
    sizes = coded.select(F.posexplode("codes").alias("place", "code")).groupBy("place", "code").agg(F.count("*").alias("members"))
    large = stored(sizes.where(F.col("members") > BLOCK), "large-buckets")
    blocks = F.coalesce(F.ceil(F.col("members") / BLOCK), F.lit(1)).cast("int")
    dealt = placed.join(F.broadcast(large), ["place", "code"], "left").withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least("block", k).alias("low"), F.greatest("block", k).alias("high")),
    )
    dealt = dealt.withColumn("pair", F.explode(others)).select("place", "code", "pair.low", "pair.high", "block", "id", "n", "embedding", "codes")
    dealt = dealt.repartition("place", "code", "low", "high").sortWithinPartitions("place", "code", "low", "high")
    found = stored(dealt.mapInArrow(_link_blocks(cosine), "id long, links long, root long"), "links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    reach = connected_components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = coded.select("key", "id", "n").join(links, "id", "left").join(reach, "id", "left")
    facts = stored(facts.select("key", "n", "links", F.coalesce("component_id", "id").alias("component_id")), "facts")
    out = keyed.select("vec_id", "key").join(facts, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def expected_recall(cosine: float, tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH) -> float:
    """Share of pairs at this cosine that some table puts in one bucket."""
    r = width / math.sqrt(2 - 2 * cosine)
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    one = 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))
    return 1 - (1 - one**projections) ** tables
