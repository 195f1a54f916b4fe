"""Near-duplicate texts: a grouped prefix join on word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import BROADCAST_ROWS, Scratch, row_slices, sorted_groups, stored, text_slices, texts_of, tidy, worker_cache, words_of
from trialmart.llm.components import connected_components

#: Shingles held to be frequent, at most; they only decide the order within a set.
FREQUENT_BOUND = 1 << 18
#: Rounds that link texts through the leader of each shared shingle, before the remaining
#: pairs are enumerated.
LEADER_ROUNDS = 1
#: Groups of one cluster that are compared as one block.
CLUSTER_BLOCK = 128
#: Bytes of text that a task works on at once.
SLICE = 1 << 22
#: Shingles of texts that are searched together for frequent ones, about.
TOGETHER = 4_000_000

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (multiply, shift, multiply)."""
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    return (x ^ (x >> np.uint64(29))) * _MIX[1] ^ (x >> np.uint64(7))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text, end to end, and their number per text."""
    words, counts = words_of(texts, lower_ascii=True)
    coded = words.dictionary_encode()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = hashes[coded.indices.to_numpy(zero_copy_only=False)]
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    rest = np.repeat(starts + counts, counts) - np.arange(len(h))  # words from here to the end
    rolled = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        padded = np.concatenate([h, np.zeros(width, np.uint64)])
        for k in range(width):
            part = _mixed(padded[k : k + len(h)] + np.uint64(k) * _MIX[2])
            rolled = _mixed(rolled + np.where(rest > k, part, np.uint64(0))) if k else part
        whole = (rest >= width) | (rest == np.repeat(counts, counts))  # a short text is one shingle
        rolled = _mixed(rolled + np.minimum(rest, width).astype(np.uint64) * _MIX[3])
    rolled, owner = rolled[whole], owner[whole]
    order = np.lexsort((rolled, owner))
    rolled, owner = rolled[order], owner[order]
    first = np.ones(len(rolled), bool)
    first[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    return rolled[first].view(np.int64), np.bincount(owner[first], minlength=len(counts))


def _repeated(width: int):
    """Shingles that two texts of about TOGETHER shingles share, with the number of texts."""

    def shared(parts: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(parts)
        parts.clear()
        h.sort()
        again = np.flatnonzero(h[1:] == h[:-1])  # one entry for each text but the first
        found, times = np.unique(h[again], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(times + 1)], ["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("jaccard")
        parts: list[np.ndarray] = []
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                parts.append(shingle_sets(part.column("text"), width)[0])
                if sum(map(len, parts)) >= TOGETHER:
                    yield from row_slices(shared(parts))
        if parts:
            yield from row_slices(shared(parts))

    return run


def frequent_shingles(docs: DataFrame, width: int, bound: int) -> np.ndarray:
    """The most frequent shingles, at most `bound`, the most frequent last.

    Every text is read. A task reports the shingles that several of some thousands of its texts share, so one
    that is rare everywhere is not counted; which ones are listed changes the work of the join,
    never its result.
    """
    counted = texts_of(docs).select("text").mapInArrow(tidy(_repeated(width)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    top = counted.where("n > 2").orderBy(F.desc("n"), "h").limit(bound).toArrow()
    return top.column("h").to_numpy()[::-1].copy()


def _prefixes(width: int, percent: int, frequent):
    """Per text: size, digests of the set and of its prefix, and the prefix in order of rarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("jaccard")
        ranked = frequent.value
        by_hash = np.argsort(ranked, kind="stable")
        sorted_hashes = ranked[by_hash]
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                h, sizes = shingle_sets(part.column("text"), width)
                rank = np.zeros(len(h), np.int64)  # 0: not frequent, then the order by frequency
                if len(ranked):
                    at = np.minimum(np.searchsorted(sorted_hashes, h), len(ranked) - 1)
                    hit = sorted_hashes[at] == h
                    rank[hit] = by_hash[at[hit]] + 1
                owner = np.repeat(np.arange(len(sizes)), sizes)
                ordered = h[np.lexsort((h, rank, owner))]
                ends = np.cumsum(sizes)
                taken = np.where(sizes > 0, sizes - (percent * sizes + 99) // 100 + 1, 0)
                begin = ends - sizes
                inside = np.arange(len(h)) - np.repeat(begin, sizes) < np.repeat(taken, sizes)
                sets, prefixes = [], []
                for i, (a, b) in enumerate(zip(begin.tolist(), ends.tolist(), strict=True)):
                    sets.append(hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if a < b else None)
                    top = ordered[a : a + int(taken[i])]
                    prefixes.append(hashlib.blake2b(top.tobytes(), digest_size=16).digest() if a < b else None)
                offsets = np.concatenate([[0], np.cumsum(taken)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ordered[inside]))
                columns = [
                    part.column("doc_id"),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(sets, pa.binary()),
                    pa.array(prefixes, pa.binary()),
                    lists,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_key", "prefix_key", "prefix"])

    return run


def _wanted_sets(width: int, bits):
    """(doc_id, sorted shingle hashes as bytes) of the texts whose id is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mine in _marked(bits)(batches):
            for part in text_slices(mine, "text", SLICE):
                h, sizes = shingle_sets(part.column("text"), width)
                offsets = (np.concatenate([[0], np.cumsum(sizes)]) * 8).astype(np.int32)
                blobs = pa.Array.from_buffers(
                    pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(h.tobytes())]
                )
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), blobs], ["doc_id", "shingles"])

    return run


def _marked(bits):
    """Keeps the rows whose doc_id is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            marked = np.ones(batch.num_rows, bool)
            for place in _places(batch.column("doc_id").to_numpy(zero_copy_only=False), len(marks) * 8):
                marked &= (marks[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            yield batch.filter(pa.array(marked))

    return run


#: Bits of the table of marks of wanted ids: at least, for each id, and at most. The fuller it is, the more sets
#: than needed move.
_MARK_BITS, _ID_BITS, _MOST_BITS = 1 << 23, 16, 1 << 27


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """Two places for each id."""
    with np.errstate(over="ignore"):
        mixed = _mixed(ids.astype(np.int64).view(np.uint64))
        return [(x % np.uint64(bits)).astype(np.int64) for x in (mixed, _mixed(mixed + _MIX[3]))]


def _marks(ids: DataFrame, count: int) -> bytes:
    """A bit table in which the places of all ids are set; its size goes by their number, up to a bound."""
    bits = _MARK_BITS
    while bits < min(count * _ID_BITS, _MOST_BITS):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(table, place >> 3, (1 << (place & 7)).astype(np.uint8))
        words = table.view(np.int64)
        at = np.flatnonzero(words)
        yield from row_slices(pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["at", "word"]))

    rows = ids.mapInArrow(run, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    words = np.zeros(bits >> 6, np.int64)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return words.tobytes()


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum()) if len(q) else 0
                linked.append(100 * both >= percent * (len(p) + len(q) - both) and both > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"]
            )

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row (doc_id, n_shingles, component_id) per document: the number of distinct word
    shingles, and the smallest doc_id reachable over links.

    Words are runs without ASCII white space, A-Z in lower case. A text with fewer than `width`
    words is one shingle; null, empty and blank texts have none and link with nothing. Two
    documents link when their sets' Jaccard similarity is `percent` / 100 or more. Two rows
    with one doc_id are one document if their texts are equal; otherwise each row counts and
    their links meet in that id. A row without doc_id keeps null ids. Other columns are ignored.

    Method: sets are ordered by rarity, and of each only the prefix that every link must
    share is dealt out. Documents with equal size and prefix form one group. Groups that share a
    prefix shingle are compared with the shingle's leader first, then all pairs of groups whose members are
    not yet all in one component and that share enough of their prefixes; group pairs that pass are
    expanded to their members (one for each distinct set), which are compared in full. Pairs already
    in one component need no comparison, so copies are never expanded into all pairs.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with Scratch(docs.sparkSession) as tables:
        sized, labels = _linked(docs, width, percent, tables)
    found = sized.select("doc_id", F.col("n").alias("n_shingles")).join(
        labels.withColumnRenamed("id", "doc_id"), "doc_id", "left"
    )
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _linked(docs: DataFrame, width: int, percent: int, tables: Scratch) -> tuple[DataFrame, DataFrame]:
    """Tables that stay: (doc_id, n) of every document, and the components of those with links.

    What else is stored goes as soon as the next table stands, the widest first: prefixes are dealt out once,
    after that only their shared shingles are held.
    """
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_shingles(docs, width, FREQUENT_BOUND))
    kinds = "doc_id long, n long, set_key binary, prefix_key binary, prefix array<long>"
    rows = tables.stored(docs.mapInArrow(tidy(_prefixes(width, percent, frequent)), kinds), "prefixes")
    held = rows.where("n > 0 AND doc_id IS NOT NULL")
    sized = stored(rows.select("doc_id", "n"), "sizes")

    # Equal sets: one member stands for all. Equal size and prefix: one group.
    same = tables.stored(held.groupBy("n", "prefix_key", "set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), "sets")
    copies = same.where("rows > 1").select("set_key", "rep")
    links = [tables.stored(held.join(copies, "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")), "copies")]
    groups = tables.stored(held.groupBy("n", "prefix_key").agg(F.min("doc_id").alias("g"), F.first("prefix").alias("prefix")), "groups")
    tables.drop(rows)
    shared = groups.select("g", "n", F.explode("prefix").alias("h"))
    known = tables.stored(shared.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h"), "shared")
    posts = tables.stored(shared.join(known, "h"), "posts")
    tables.drop(groups, known)
    many = tables.stored(posts.groupBy("g").agg(F.count("*").alias("hits")), "hits")
    heads = tables.stored(same.groupBy("n", "prefix_key").agg(F.min("rep").alias("g"), F.count("*").alias("sets")), "heads")
    members = tables.stored(same.join(heads.select("n", "prefix_key", "g"), ["n", "prefix_key"]).select("g", "rep"), "group-members")
    wide = heads.where("sets > 1").select("n", "prefix_key", "g")
    inside = tables.stored(
        same.join(wide, ["n", "prefix_key"]).where("rep <> g").select(F.col("rep").alias("a"), F.col("g").alias("b")),
        "members",
    )
    tables.drop(same)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs with whether they link; only the sets of their documents are built and move."""
        pairs = tables.stored(pairs.select("a", "b"), "pairs")
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
        bits = spark.sparkContext.broadcast(_marks(ids, 2 * pairs.count()))
        sets = docs.where("doc_id IS NOT NULL").mapInArrow(tidy(_wanted_sets(width, bits)), "doc_id long, shingles binary")
        sets = tables.stored(sets, "shingles")
        left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
        found = tables.stored(both.mapInArrow(tidy(_verify(percent)), "a long, b long, linked boolean"), "checked")
        tables.drop(pairs, sets)
        return found

    checked = labels = nearest = None
    for k in range(LEADER_ROUNDS):
        active = posts if labels is None else _active(posts, members, labels, tables)
        best = _best_leaders(active, many, k, percent, tables)
        nearest = best if nearest is None else nearest
        pairs = best.select(F.least("g", "leader").alias("a"), F.greatest("g", "leader").alias("b")).distinct()
        fresh = verified(pairs.unionByName(inside) if checked is None else pairs)
        links.append(fresh.where("linked").select("a", "b"))
        labels = connected_components(_union(links))
        checked = fresh if checked is None else checked.unionByName(fresh)
        if not fresh.where("linked").head(1):
            break
    links = [labels.select(F.col("id").alias("a"), F.col("component_id").alias("b"))]
    alone = heads.where("sets > 1").select("g", F.col("g").alias("g2"))
    active = _active(posts, members, labels, tables)
    tables.drop(posts, many)
    pairs = tables.stored(_open_pairs(active, nearest, percent, tables).unionByName(alone), "open")
    if pairs.head(1):
        pairs = _expanded(pairs, members, labels, tables)
        pairs = pairs.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        fresh = verified(pairs)
        if fresh.where("linked").head(1):
            links.append(fresh.where("linked").select("a", "b"))
            labels = connected_components(_union(links))
    return sized, labels


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def _component(rows: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """The rows with the component of the id in `key`: the id itself if it has no link."""
    known = labels.select(F.col("id").alias(key), F.col("component_id").alias("_found"))
    return rows.join(known, key, "left").withColumn(name, F.coalesce("_found", key)).drop("_found")


def _active(posts: DataFrame, members: DataFrame, labels: DataFrame, tables: Scratch) -> DataFrame:
    """Entries of shingles whose groups lie in several components, with the least and the largest
    component of the group's members: a member need not be linked with the group's leader."""
    spans = _component(members, labels, "rep", "c").groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    spans = tables.stored(spans, "spans")
    placed = tables.stored(posts.join(spans, "g"), "placed")
    ends = placed.groupBy("h").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
    mixed = tables.stored(ends.where("least <> most").select("h"), "mixed")
    active = tables.stored(placed.join(mixed, "h"), "active")
    tables.drop(spans, placed, mixed)
    return active


def _least_shared(n, n2, percent: int):
    """Prefix shingles that sets of these sizes share at least if they link.

    They need percent / (100 + percent) of both sizes in common. What is outside both prefixes is at most
    the rest of the set whose prefix ends first in the order of rarity: less than percent / 100 of the
    larger size. The bound is concave, so over ranges of sizes its least value is at a corner.
    """
    return F.lit(percent / (100 + percent)) * (n + n2) - F.lit(percent / 100) * F.greatest(n, n2) - 1e-6


def _best_leaders(posts: DataFrame, many: DataFrame, salt: int, percent: int, tables: Scratch) -> DataFrame:
    """For each group, the leader that it shares most shingles with, unless one component holds all members of both.

    The leader of a shingle is one of its groups, another one for each salt. Pairs are left out of which
    one side shares too few shingles with all others together.
    """
    own = ("lo", "hi") if "lo" in posts.columns else ("g", "g")
    posts = posts.select("h", "g", "n", F.col(own[0]).alias("lo"), F.col(own[1]).alias("hi"))
    pick = F.min_by(F.struct("g", "n", "lo", "hi"), F.col("g") if salt == 0 else F.xxhash64("g", F.lit(salt)))
    leaders = tables.stored(posts.groupBy("h").agg(pick.alias("l")).select("h", "l.*").toDF("h", "lg", "ln", "llo", "lhi"), "leader")
    met = posts.join(leaders, "h").where(
        (F.col("g") != F.col("lg"))
        & (F.least("lo", "llo") != F.greatest("hi", "lhi"))
        & (100 * F.least("n", "ln") >= percent * F.greatest("n", "ln"))
    )
    counted = met.groupBy("g", "lg").agg(F.count("*").alias("k"), F.first("n").alias("n"), F.first("ln").alias("ln"))
    least = _least_shared(F.col("n"), F.col("ln"), percent)
    counted = counted.join(many, "g").where(F.col("hits") >= least).drop("hits")
    counted = counted.join(many.withColumnRenamed("g", "lg"), "lg").where(F.col("hits") >= least)
    best = tables.stored(counted.groupBy("g").agg(F.max_by("lg", F.struct("k", -F.col("lg"))).alias("leader")), "leaders")
    tables.drop(leaders)
    return best


def _open_pairs(active: DataFrame, nearest: DataFrame, percent: int, tables: Scratch) -> DataFrame:
    """Pairs of groups, not all in one component, that share enough of their prefixes to link.

    Groups with one best leader form a cluster. Clusters that meet in enough shingles are paired, and the
    prefixes of a cluster pair's groups are compared in one place, in blocks of bounded size; only
    the pairs of groups that may still link leave it. Of a prefix, its active shingles are dealt out: what
    two groups share is active, unless one component holds all members of both. The active entries go.
    """
    homes = nearest.select("g", "leader")
    placed = active.select("g", "h", "n", "lo", "hi").join(homes, "g", "left").withColumn("home", F.coalesce("leader", "g")).drop("leader")
    placed = tables.stored(placed, "homes")
    tables.drop(active)
    met = placed.groupBy("h", "home").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    met = tables.stored(met, "met")
    members = tables.stored(placed.groupBy("home", "g", "lo", "hi", "n").agg(F.collect_list("h").alias("prefix")), "cluster-members")
    tables.drop(placed)
    near = (percent * F.col("low") <= 100 * F.col("high2")) & (percent * F.col("low2") <= 100 * F.col("high"))
    other = met.select("h", *[F.col(c).alias(f"{c}2") for c in ("home", "low", "high")])
    pairs = met.join(other, "h").where((F.col("home") < F.col("home2")) & near).groupBy("home", "home2").agg(F.count("*").alias("k"))
    sizes = members.groupBy("home").agg(F.count("*").alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    blocks = tables.stored(sizes.select("home", "low", "high", F.ceil(F.col("m") / CLUSTER_BLOCK).cast("int").alias("blocks"), "m"), "cluster-sizes")
    own = blocks.where("m > 1").select("home", F.col("home").alias("home2"), F.lit(None).cast("bigint").alias("k"))
    pairs = pairs.unionByName(own)
    right = blocks.select(*[F.col(c).alias(f"{c}2") for c in ("home", "low", "high", "blocks")])
    pairs = pairs.join(blocks, "home").join(right, "home2")
    corners = [_least_shared(F.col(x), F.col(y), percent) for x in ("low", "high") for y in ("low2", "high2")]
    pairs = pairs.where(near & (F.col("k").isNull() | (F.col("k") >= F.least(*corners))))
    pairs = tables.stored(pairs.select("home", "home2", "blocks", "blocks2"), "cluster-pairs")
    tables.drop(met, blocks)
    spread = F.xxhash64("g", F.lit(1))
    sides = []
    for side, key, mine, theirs in ((0, "home", "blocks", "blocks2"), (1, "home2", "blocks2", "blocks")):
        rows = members.withColumnRenamed("home", key).join(pairs, key)
        rows = rows.where("home <> home2") if side else rows
        rows = rows.withColumn("own", F.pmod(spread, F.col(mine)).cast("int"))
        rows = rows.withColumn("far", F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
        # Within one cluster, a pair of blocks is one group: the lower block is the left side.
        own_left = (F.col("own") if side == 0 else F.col("far")).alias("i")
        own_right = (F.col("far") if side == 0 else F.col("own")).alias("j")
        sides.append(rows.select("home", "home2", own_left, own_right, F.lit(side).alias("side"), "g", "lo", "hi", "n", "prefix"))
    both = sides[0].unionByName(sides[1])
    alone = F.col("home") == F.col("home2")
    both = both.select(
        "home",
        "home2",
        F.when(alone, F.least("i", "j")).otherwise(F.col("i")).alias("i"),
        F.when(alone, F.greatest("i", "j")).otherwise(F.col("j")).alias("j"),
        F.when(alone, (F.col("i") > F.col("j")).cast("int")).otherwise(F.col("side")).alias("side"),
        "g",
        "lo",
        "hi",
        "n",
        "prefix",
    )
    both = both.repartition("home", "home2", "i", "j").sortWithinPartitions("home", "home2", "i", "j")
    found = tables.stored(both.mapInArrow(tidy(_compare_clusters(percent)), "g long, g2 long").distinct(), "near-groups")
    tables.drop(members, pairs)
    return found


def _compare_clusters(percent: int):
    """Pairs of groups of two cluster blocks that can still reach the similarity, unless one component
    holds all members of both.

    Of a pair's common shingles, those outside both prefixes are at most the rest of the set
    whose prefix ends first in the order of rarity; that rest is no more than the larger one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["home", "home2", "i", "j"]):
            one = group.column("home")[0] == group.column("home2")[0] and group.column("i")[0] == group.column("j")[0]
            side = group.column("side").to_numpy()
            left = np.flatnonzero(side == 0)
            right = left if one else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            g, lo, hi, n = (group.column(k).to_numpy() for k in ("g", "lo", "hi", "n"))
            lists = group.column("prefix").combine_chunks()
            values = lists.flatten().to_numpy()
            owner = pc.list_parent_indices(lists).to_numpy()
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            seat = np.full(len(g), -1)
            seat[left] = np.arange(len(left))
            seat2 = np.full(len(g), -1)
            seat2[right] = np.arange(len(right))
            shared = np.zeros((len(left), len(right)), np.int32)
            edges = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            ends = np.append(edges[1:], len(values))
            for a, b in zip(edges[ends - edges > 1], ends[ends - edges > 1], strict=True):
                rows = owner[a:b]
                p, q = seat[rows], seat2[rows]
                shared[np.ix_(p[p >= 0], q[q >= 0])] += 1
            n1, n2 = n[left][:, None].astype(np.int64), n[right][None, :].astype(np.int64)
            low, high = np.minimum(n1, n2), np.maximum(n1, n2)
            needed = -(-percent * (n1 + n2) // (100 + percent))
            rest = -(-percent * high // 100) - 1
            ok = (shared > 0) & (shared + rest >= needed) & (100 * low >= percent * high)
            ok &= np.minimum(lo[left][:, None], lo[right]) != np.maximum(hi[left][:, None], hi[right])
            ok &= g[left][:, None] != g[right]  # members of one group are paired apart from this
            p, q = np.nonzero(ok)
            x, y = g[left[p]], g[right[q]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["g", "g2"])

    return run


def _expanded(pairs: DataFrame, members: DataFrame, labels: DataFrame, tables: Scratch) -> DataFrame:
    """Pairs of members (one per distinct set) of paired groups, unless already connected."""
    placed = tables.stored(_component(members, labels, "rep", "c"), "placed")
    left = placed.select("g", F.col("rep").alias("p"), F.col("c").alias("cp"))
    right = placed.select(F.col("g").alias("g2"), F.col("rep").alias("q"), F.col("c").alias("cq"))
    met = pairs.join(left, "g").join(right, "g2").where("cp <> cq")
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def representatives(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without the near duplicates of one with a smaller doc_id; rows and columns
    are otherwise unchanged. Of rows with one doc_id and one text one stays, the one whose other columns
    come first as JSON.

    Each text of a doc_id is a document of its own: it goes only if links lead from its own set to a
    smaller doc_id, or to a text of the same doc_id whose SHA-256 is smaller. Rows without doc_id stay.

    The ids to remove are broadcast only if they were counted and are few; beyond that the
    join shuffles.
    """
    names, key = docs.columns, F.sha2(F.col("text").cast("string").cast("binary"), 256)
    # the whole input is one column, so no name of it can meet one of ours
    row, text = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(key, F.lit("")).alias("text_key")
    docs = docs.select(row, F.col("doc_id").cast("long").alias("id"), text)
    kept_columns = [F.col(f"row.`{c}`").alias(c) for c in names]
    texts = stored(docs.where("id IS NOT NULL").groupBy("id", "text_key").agg(F.count("*").alias("rows")), "texts")
    repeated = texts.where("rows > 1").select("id", "text_key")
    several = texts.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    nodes = _numbered(texts.join(several, "id").select("id", "text_key"), texts)
    if nodes is None:
        docs = docs.withColumn("node", F.col("id"))
    else:
        found = docs.join(_few(nodes), ["id", "text_key"], "left")
        docs = found.withColumn("node", F.coalesce("node", "id"))
    numbered = docs.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text"))
    found = stored(near_duplicates(numbered, width, percent), "near-duplicates")
    found = found.select(F.col("doc_id").alias("node"), "component_id")
    if nodes is None:
        gone = found.where("node <> component_id").select("node").distinct()
    else:
        found = found.where("node IS NOT NULL").distinct().join(_few(nodes), "node", "left")
        found = stored(found.withColumn("id", F.coalesce("id", "node")), "placed-texts")
        first = found.groupBy("component_id").agg(F.min_by("node", F.struct("id", "text_key")).alias("first"))
        gone = found.join(stored(first, "first-texts"), "component_id").where("node <> first").select("node")
    kept = docs.join(_few(gone), "node", "left_anti")
    if not repeated.head(1):
        return kept.select(kept_columns)
    repeated = _few(repeated)
    alone = kept.join(repeated, ["id", "text_key"], "left_anti").select("row")
    again = kept.join(repeated, ["id", "text_key"], "left_semi").groupBy("id", "text_key")
    others = F.to_json(F.struct(*[F.col(f"row.`{c}`").alias(c) for c in names if c.lower() != "text"]))
    return alone.unionByName(again.agg(F.min_by("row", others).alias("row")).select("row")).select(kept_columns)


def _few(rows: DataFrame) -> DataFrame:
    """The rows, broadcast if they were counted and are few."""
    rows = stored(rows, "counted")
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _numbered(split: DataFrame, texts: DataFrame) -> DataFrame | None:
    """The (id, text_key) pairs with a number `node` each that is neither an id nor another pair's; None
    without pairs. Hashes are numbers: with a salt that makes two of them or one and an id meet, the next is tried.
    """
    split = stored(split, "split-texts")
    if not split.head(1):
        return None
    salt = 0
    while True:
        nodes = stored(split.withColumn("node", F.xxhash64("id", "text_key", F.lit(salt))), "numbered-texts")
        taken = nodes.select("node").unionByName(texts.select("id").distinct().toDF("node"))
        if not taken.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").head(1):
            return nodes
        salt += 1
