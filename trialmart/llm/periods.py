"""Maximal periodic runs of words, located by block convolutions over a prime field."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import text_slices, words_of

#: A prime with 2**27 as a factor of its predecessor, and a generator: transforms of up to 2**27 points.
PRIME, GENERATOR = 15 * (1 << 27) + 1, 31
#: Shortest run, in words.
LEAST = 12
#: Bytes of text that a task searches at once; numbers in one batch of transforms or comparisons.
SLICE, BATCH = 1 << 22, 1 << 18

_P = np.uint64(PRIME)
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _powers(base: int, count: int) -> np.ndarray:
    """base**0 to base**(count - 1) modulo the prime, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % _P])
    return out[:count]


class Transform:
    """The number-theoretic transform of columns of `size` numbers, a power of two. Its output is in
    bit-reversed order, which products of two transforms do not mind."""

    def __init__(self, size: int):
        self.size = size
        halves = [1 << k for k in range(size.bit_length() - 1)]
        root = {h: pow(GENERATOR, (PRIME - 1) // (2 * h), PRIME) for h in halves}
        self.forth = {h: _powers(root[h], h)[:, None] for h in halves}
        self.back = {h: _powers(pow(root[h], -1, PRIME), h)[:, None] for h in halves}
        self.share = np.uint64(pow(size, -1, PRIME))

    def forward(self, x: np.ndarray) -> np.ndarray:
        for h in reversed(self.forth):
            y = x.reshape(-1, 2, h, x.shape[1])
            total, other = y[:, 0] + y[:, 1], y[:, 0] + (_P - y[:, 1])
            y[:, 0] = np.minimum(total, total - _P)  # wraps around where nothing is to be taken off
            y[:, 1] = other * self.forth[h] % _P
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        for h in self.back:
            y = x.reshape(-1, 2, h, x.shape[1])
            turned = y[:, 1] * self.back[h] % _P
            total, other = y[:, 0] + turned, y[:, 0] + (_P - turned)
            y[:, 0] = np.minimum(total, total - _P)
            y[:, 1] = np.minimum(other, other - _P)
        return x * self.share % _P


def _zero_distances(ids: np.ndarray, squares: np.ndarray, begin: np.ndarray, size: int, low: int, count: int) -> Iterator:
    """Pairs (block, distance) where the block of `size` words from `begin` may occur again, of the
    `count` distances from `low`: the sum of squared differences is 0 modulo the prime."""
    width = 4 * size  # holds a block and its window without wrapping around
    transform = Transform(width)
    step = max(1, BATCH // width)
    last = len(ids) - 1
    for k in range(0, len(begin), step):
        part = begin[k : k + step]
        block, window = np.zeros((2, width, len(part)), np.uint64)
        block[:size] = ids[part + np.arange(size - 1, -1, -1)[:, None]]
        reach = count + size - 1
        window[:reach] = ids[np.minimum(part + low + np.arange(reach)[:, None], last)]
        product = transform.inverse(transform.forward(block) * transform.forward(window) % _P)
        product = product[size - 1 : size - 1 + count].astype(np.int64)
        own = squares[part + size] - squares[part]
        place = part + low + np.arange(count)[:, None]
        theirs = squares[np.minimum(place + size, last)] - squares[np.minimum(place, last)]
        offset, row = np.nonzero((own + theirs - 2 * product) % PRIME == 0)
        yield part[row], low + offset


def _same(ids: np.ndarray, begin: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    """Whether blocks really occur again at their distance, word by word."""
    out = np.zeros(len(begin), bool)
    step = max(1, BATCH // size)
    for k in range(0, len(begin), step):
        at = begin[k : k + step, None] + np.arange(size)
        far = np.minimum(at + distance[k : k + step, None], len(ids) - 1)
        out[k : k + step] = (ids[at] == ids[far]).all(axis=1)
    return out


def _further(ids: np.ndarray, at: np.ndarray, distance: np.ndarray, sign: int) -> np.ndarray:
    """How many words from `at` on, in one direction, equal the word at their distance."""
    got = np.zeros(len(at), np.int64)
    active, width = np.arange(len(at)), 8
    while len(active):
        left = []
        step = max(1, BATCH // width)
        for k in range(0, len(active), step):
            part = active[k : k + step]
            place = (at[part] + sign * got[part])[:, None] + sign * np.arange(width)
            far = place + distance[part, None]
            inside = (place >= 0) & (far < len(ids))
            equal = inside & (ids[np.where(inside, place, 0)] == ids[np.where(inside, far, 0)])
            n = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
            got[part] += n
            left.append(part[n == width])
        active, width = np.concatenate(left), min(2 * width, BATCH)
    return got


def _next_occurrence(ids: np.ndarray) -> np.ndarray:
    """Distance from each word to its next occurrence; very large without one."""
    order = np.argsort(ids, kind="stable")
    out = np.full(len(ids), 1 << 60, np.int64)
    again = ids[order[1:]] == ids[order[:-1]]
    out[order[:-1][again]] = (order[1:] - order[:-1])[again]
    return out


def find_runs(ids: np.ndarray, owner: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Maximal runs (start, length, period) of a sequence of words, by start and period.

    Words are numbers below 2**31; a run stays among words of one owner. A run of period q repeats
    max(least - q, q) of its words at distance q at least, so at the scale whose blocks have `size`
    words, with 2 * size - 1 <= q < 4 * size - 1 (the first scale: 1 <= q < 7), a whole aligned block
    lies among them. Blocks with a word that does not come again within reach are left out before
    the convolution. Found blocks are compared word by word, neighbours at one distance joined and
    extended; a distance that is a multiple of a run's period within it seeds nothing new.
    """
    runs = np.zeros((0, 3), np.int64)
    longest = int(np.bincount(owner).max()) if len(owner) else 0
    if longest < least:
        return runs
    total = len(ids)
    ids = np.append(ids, np.uint64(PRIME - 1)).astype(np.uint64)  # an end that equals no word
    owner = np.append(owner, -1)
    squares = np.append(0, np.cumsum((ids * ids % _P).astype(np.int64)))
    ahead = _next_occurrence(ids[:total])
    cover = np.zeros((2, total), np.int64)  # end and period of the known run that reaches furthest
    size = 2
    while size == 2 or 2 * size - 1 <= longest // 2:
        low, high = (1, 6) if size == 2 else (2 * size - 1, 4 * size - 2)
        whole = total // size
        begin = np.flatnonzero((ahead[: whole * size].reshape(whole, size) <= high).all(axis=1)) * size
        begin = begin[owner[begin] == owner[begin + size - 1]]
        seeds = [np.zeros((2, 0), np.int64)]
        for b, d in _zero_distances(ids, squares, begin, size, low, high - low + 1):
            far = np.minimum(b + d + size - 1, total)
            settled = (b + size + d <= cover[0, b]) & (d % np.maximum(cover[1, b], 1) == 0)
            keep = (owner[b] == owner[far]) & ~settled
            seeds.append(np.stack([b[keep], d[keep]]))
        b, d = np.concatenate(seeds, axis=1)
        right = _same(ids, b, d, size)
        b, d = b[right], d[right]
        order = np.lexsort((b, d))
        b, d = b[order], d[order]
        first = np.ones(len(b), bool)
        first[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1] + size)
        last = np.append(first[1:], True)[: len(b)]
        start, stop, d = b[first], b[last] + size, d[first]
        start = start - _further(ids, start - 1, d, -1)
        stop = stop + _further(ids, stop, d, 1)
        # words of two owners may be equal across their border: a run is cut there
        fits = owner[np.minimum(start, total)] == owner[np.minimum(stop + d - 1, total)]
        found = fits & (stop - start >= d) & (stop - start + d >= least)
        new = np.stack([start[found], (stop - start + d)[found], d[found]], axis=1)
        runs = np.concatenate([runs, new])
        for s, n, q in new.tolist():
            better = cover[0, s : s + n] < s + n
            cover[0, s : s + n][better] = s + n
            cover[1, s : s + n][better] = q
        size *= 2
    order = np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))
    runs = runs[order]  # the same stretch at a multiple of its period is the same run
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _search(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, runs and collapsed text of each text."""
    words, counts = words_of(texts, lower_ascii=False)
    coded = words.dictionary_encode()
    ids = np.asarray(coded.indices).astype(np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    # a word of its own after each text keeps runs apart
    edges = np.cumsum(counts)
    spaced = np.insert(ids, edges, np.uint64(len(coded.dictionary)) + np.arange(len(counts), dtype=np.uint64))
    runs = find_runs(spaced, np.insert(owner, edges, np.arange(len(counts))))
    text = np.searchsorted(edges + np.arange(len(counts)), runs[:, 0], side="left")
    begin = edges - counts
    local = runs[:, 0] - begin[text] - text
    per_text = np.bincount(text, minlength=len(counts))
    items = pa.StructArray.from_arrays([pa.array(local), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(per_text)), pa.int32()), items)
    change = np.zeros(len(ids) + 1, np.int64)
    place = runs[:, 0] - text
    np.add.at(change, place + runs[:, 2], 1)
    np.add.at(change, place + runs[:, 1], -1)
    kept = np.cumsum(change[:-1]) == 0
    left = np.bincount(owner[kept], minlength=len(counts))
    offsets = pa.array(np.append(0, np.cumsum(left)), pa.int32())
    collapsed = pc.binary_join(pa.ListArray.from_arrays(offsets, words.filter(pa.array(kept)).cast(pa.string())), " ")
    return pa.array(counts.astype(np.int64)), lists, collapsed


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            found = _search(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *found], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row (doc_id, n_words, runs, collapsed) per document, from its whole text.

    Words are runs without ASCII white space, numbered from 0. `runs` lists the maximal stretches with
    smallest period q and at least max(12, 2 * q) words, by start, then period; `collapsed` holds the words
    that no run repeats (those outside every run, or among its first q words of each that holds them), joined by one space.
    A null or empty text has no words, no runs and an empty `collapsed`. Rows are searched one by
    one: a null or repeated doc_id is passed on, other columns are ignored. Nothing is shuffled; a
    text is searched by one task in time that grows with its length times the square of its logarithm.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_rows, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, chosen by crc32 of the id, the words from one place on
    repeat the first few of them. A null doc_id or a text without words is left as it is."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("words")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.withColumn("words", F.when(h % 10 == 0, words))
    chosen = chosen.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))

    def word(w: Column, i: Column) -> Column:
        return F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))

    changed = F.array_join(F.transform("words", word), " ")
    return chosen.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period; nulls without one) and
    digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    lines = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    rows = found.withColumn("best", best)
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
