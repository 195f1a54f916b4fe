"""Byte-level BPE: encoding and decoding by recursive SQL inside every task."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import give_back, texts_of, tidy, worker_cache

#: Bytes of pieces, ids and places that a worker remembers, at most; other pieces are encoded again.
REMEMBERED = 8_000_000
#: Pieces and bytes in one recursive query, which holds the rows of all its rounds; a longer piece is alone.
PIECES, BYTES = 20_000, 60_000
#: Pieces of texts that a task works on at once, about.
SLICE = 200_000
#: A piece of more bytes is first cut where no token can span.
LONG = 1_000

# No pair of tokens merges: a rank above all ranks.
_NONE = 1 << 30
_SHIFT = 32

#: Rows of token positions. `best` is the word's smallest (rank, position); each round contracts that
#: pair: the token after it goes, and the pairs that hold the new token look up their rank.
_ENCODE = f"""
WITH RECURSIVE step AS (
    SELECT w, p, t, nx, r, min(r << {_SHIFT} | p) OVER (PARTITION BY w) AS best
    FROM (
        SELECT s.w, s.p, s.t, s.nx, coalesce(m.rank, {_NONE}) AS r
        FROM start s LEFT JOIN merges m ON m.pair = (s.t << 31 | s.nx)
    )
    UNION ALL (
    WITH cut AS MATERIALIZED (
        SELECT w, p, t, nx, r, best >> {_SHIFT} AS rank, best & {(1 << _SHIFT) - 1} AS place
        FROM step WHERE best < ({_NONE}::BIGINT << {_SHIFT})
    ), after AS (
        SELECT w, nx AS follows FROM cut WHERE p = place + 1
    ), merged AS MATERIALIZED (
        SELECT
            c.w,
            c.p - (c.p > c.place)::BIGINT AS p,
            CASE WHEN c.p = c.place THEN c.rank ELSE c.t END AS t,
            CASE WHEN c.p = c.place THEN a.follows WHEN c.p = c.place - 1 THEN c.rank ELSE c.nx END AS nx,
            c.r,
            c.p = c.place OR c.p = c.place - 1 AS fresh
        FROM cut c JOIN after a USING (w)
        WHERE c.p <> c.place + 1
    ), ranked AS MATERIALIZED (
        SELECT g.w, g.p, g.t, g.nx, CASE WHEN g.fresh THEN coalesce(m.rank, {_NONE}) ELSE g.r END AS r
        FROM merged g LEFT JOIN merges m ON m.pair = CASE WHEN g.fresh THEN g.t << 31 | g.nx END
    )
    SELECT k.w, k.p, k.t, k.nx, k.r, b.best
    FROM ranked k JOIN (SELECT w, min(r << {_SHIFT} | p) AS best FROM ranked GROUP BY w) b USING (w)
    )
)
SELECT w, t FROM step WHERE best >= ({_NONE}::BIGINT << {_SHIFT}) ORDER BY w, p
"""

#: The same for one long word, as one round of a loop: occurrences of the smallest rank are
#: contracted from the left. Pairs of that rank that overlap form a run, of which every other one counts.
_HEADS = """
SELECT p, t, nx, r FROM (
    SELECT *, p - min(p) OVER (PARTITION BY p - k) AS place
    FROM (SELECT *, row_number() OVER (ORDER BY p) AS k FROM ranked WHERE r = (SELECT min(r) FROM ranked))
) WHERE place % 2 = 0
"""
_ROUND = f"""
WITH merged AS (
    SELECT s.p, CASE WHEN h.p IS NULL THEN s.t ELSE s.r END AS t
    FROM ranked s LEFT JOIN heads h ON h.p = s.p LEFT JOIN heads b ON b.p = s.p - 1 WHERE b.p IS NULL
), placed AS (
    SELECT row_number() OVER (ORDER BY p) - 1 AS p, t, coalesce(lead(t) OVER (ORDER BY p), {(1 << 31) - 1}) AS nx FROM merged
)
SELECT d.p, d.t, d.nx, coalesce(m.rank, {_NONE}) AS r FROM placed d LEFT JOIN merges m ON m.pair = (d.t << 31 | d.nx)
"""
#: The smallest rank of the pairs that arise while occurrences are contracted one by one.
_ARISING = """
SELECT min(m.rank) AS low FROM (
    SELECT (h.r << 31 | n.nx) AS pair FROM heads h JOIN ranked n ON n.p = h.p + 1
    UNION ALL
    SELECT (t << 31 | nx) FROM after WHERE t = (SELECT min(r) FROM ranked) OR nx = (SELECT min(r) FROM ranked)
) a JOIN merges m USING (pair)
"""

#: Bytes stand as characters 256 to 511, so that any byte string is text.
_DECODE = "SELECT w, string_agg(v.bytes, '' ORDER BY p) AS bytes FROM tokens JOIN vocabulary v USING (t) GROUP BY w ORDER BY w"


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def _as_text(token: bytes) -> str:
    return "".join(chr(256 + b) for b in token)


def _as_bytes(text: str) -> np.ndarray:
    return (np.frombuffer(text.encode("utf-16-le"), np.uint16) - 256).astype(np.uint8)


class Coder:
    """A vocabulary in an in-memory database, and the tokens of the pieces seen so far."""

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs.append(left << 31 | right)
                    merged.append(rank)
        self.heads: set[bytes] | None = None
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.sql = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        merges = pa.table({"pair": pa.array(pairs, pa.int64()), "rank": pa.array(merged, pa.int64())})
        words = pa.table({"t": pa.array(self.ranks.values(), pa.int64()), "bytes": [_as_text(t) for t in self.ranks]})
        for name, rows in (("merges", merges), ("vocabulary", words)):
            self.sql.register("given", rows)
            self.sql.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.sql.unregister("given")
        self.known = Pieces.none()

    def cut(self, piece: bytes) -> list[bytes]:
        """A long piece in parts that no token reaches across, so that they merge apart."""
        if self.heads is None:
            self.heads = {token[:n] for token in self.ranks for n in range(2, len(token) + 1)}
        reach, begin, parts = 1, 0, []
        for i in range(len(piece)):
            if i >= reach:
                parts.append(piece[begin:i])
                begin = i
            n = 2
            while i + n <= len(piece) and piece[i : i + n] in self.heads:
                if piece[i : i + n] in self.ranks:
                    reach = max(reach, i + n)
                n += 1
            reach = max(reach, i + 1)
        parts.append(piece[begin:])
        return parts

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Token ids of one piece, contracting all occurrences of the smallest rank in a round; only
        the first of them where a pair that arises meanwhile ranks as low."""
        t = self.of_byte[np.frombuffer(piece, np.uint8)]
        nx = np.append(t[1:], (1 << 31) - 1)
        self.sql.register("start", pa.table({"p": np.arange(len(t)), "t": t, "nx": nx}))
        first = f"SELECT s.p, s.t, s.nx, coalesce(m.rank, {_NONE}) AS r FROM start s LEFT JOIN merges m ON m.pair = (s.t << 31 | s.nx)"
        rows = self.sql.sql(first).to_arrow_table()
        while (low := pc.min(rows.column("r")).as_py()) < _NONE:
            self.sql.register("ranked", rows)
            heads = self.sql.sql(_HEADS).to_arrow_table()
            self.sql.register("heads", heads)
            after = self.sql.sql(_ROUND).to_arrow_table()
            self.sql.register("after", after)
            arising = self.sql.sql(_ARISING).to_arrow_table().column(0)[0].as_py()
            if arising is not None and arising <= low and heads.num_rows > 1:
                self.sql.register("heads", heads.sort_by("p").slice(0, 1))
                after = self.sql.sql(_ROUND).to_arrow_table()
            rows = after
        return rows.sort_by("p").column("t").to_numpy().astype(np.uint32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of pieces that are no tokens themselves, end to end, and how many each has."""
        cuts = [self.cut(piece) if len(piece) > LONG else [piece] for piece in pieces]
        ids, counts = self.merge_parts([part for parts in cuts for part in parts])
        if len(counts) > len(pieces):
            sizes = np.array([len(parts) for parts in cuts])
            counts = np.add.reduceat(counts, np.cumsum(sizes) - sizes)
        return ids, counts

    def merge_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Parts go in order of length: a query takes as many rounds as its longest part has merges."""
        sizes = np.array([len(x) for x in parts], np.int64)
        order = np.argsort(sizes, kind="stable")
        ends = np.cumsum(sizes[order])
        short = int(np.searchsorted(sizes[order], LONG, side="right"))
        merged, begin = [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0
        while begin < short:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends[:short], before + BYTES, side="right")))
            end = min(end, begin + PIECES)
            merged.append(self.merge_query([parts[i] for i in order[begin:end]], sizes[order[begin:end]]))
            begin = end
        for i in order[short:]:
            ids = self.merge_long(parts[i])
            merged.append((ids, np.array([len(ids)])))
        ids, counts = (np.concatenate(x) for x in zip(*merged, strict=True))
        back = np.argsort(order)
        return _gather(ids, (np.cumsum(counts) - counts)[back], counts[back]), counts[back]

    def merge_query(self, parts: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(sizes)
        t = self.of_byte[np.frombuffer(b"".join(parts), np.uint8)]
        nx = np.append(t[1:], 0)
        nx[ends - 1] = (1 << 31) - 1  # no token: joins with nothing
        w = np.repeat(np.arange(len(sizes)), sizes)
        p = np.arange(len(t)) - np.repeat(ends - sizes, sizes)
        self.sql.register("start", pa.table({"w": w, "p": p, "t": t, "nx": nx}))
        found = self.sql.sql(_ENCODE).to_arrow_table()
        self.sql.unregister("start")
        counts = np.bincount(found.column("w").to_numpy(), minlength=len(sizes))
        return found.column("t").to_numpy().astype(np.uint32), counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of sequences of token ids, put together in order of position, end to end, and how many each has."""
        w = np.repeat(np.arange(len(counts)), counts)
        p = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.sql.register("tokens", pa.table({"w": w, "p": p, "t": ids.astype(np.int64)}))
        found = self.sql.sql(_DECODE).to_arrow_table()
        self.sql.unregister("tokens")
        sizes = np.zeros(len(counts), np.int64)
        sizes[found.column("w").to_numpy()] = pc.utf8_length(found.column("bytes")).to_numpy()
        return _as_bytes("".join(found.column("bytes").to_pylist())), sizes

    def pieces(self, pieces: pa.Array) -> tuple[Pieces, np.ndarray]:
        """Token ids of distinct pieces and the bytes that they decode to, and the place of each piece among them."""
        place = pc.index_in(pieces, self.known.text)
        new = pieces.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.known.text) + np.arange(len(new))
        held = [self.known]
        for begin in range(0, len(new), PIECES):
            part = new.slice(begin, PIECES)
            raw = [x.encode("utf-8", "surrogatepass") for x in part.to_pylist()]
            rank = np.array([self.ranks.get(x, -1) for x in raw], np.int64)
            merged, n_merged = self.merge([x for x, r in zip(raw, rank.tolist(), strict=True) if r < 0])
            n_ids = np.ones(len(raw), np.int64)
            n_ids[rank < 0] = n_merged
            ids = np.repeat(rank, n_ids).astype(np.uint32)
            ids[np.repeat(rank < 0, n_ids)] = merged
            held.append(Pieces(part, ids, n_ids.astype(np.int32), *self.decode(ids, n_ids)))
        found = Pieces.joined(held)
        if found.size() <= REMEMBERED:
            self.known = found
        return found, place


@dataclass(frozen=True)
class Pieces:
    """Texts with their token ids and decoded bytes, each end to end in one array."""

    text: pa.Array
    ids: np.ndarray
    n_ids: np.ndarray
    bytes: np.ndarray
    n_bytes: np.ndarray

    @staticmethod
    def none() -> Pieces:
        numbers = np.zeros(0, np.int32)
        return Pieces(pa.array([], pa.string()), np.zeros(0, np.uint32), numbers, np.zeros(0, np.uint8), numbers)

    @staticmethod
    def joined(parts: list[Pieces]) -> Pieces:
        if len(parts) == 1:
            return parts[0]
        arrays = [np.concatenate([getattr(x, name) for x in parts]) for name in ("ids", "n_ids", "bytes", "n_bytes")]
        return Pieces(pa.concat_arrays([x.text for x in parts]), *arrays)

    def size(self) -> int:
        return self.text.nbytes + self.ids.nbytes + self.n_ids.nbytes + self.bytes.nbytes + self.n_bytes.nbytes


def coder(path: str) -> Coder:
    """The worker's coder for a vocabulary file."""
    cache = worker_cache("bpe")
    if path not in cache:
        cache[path] = Coder(path)
    return cache[path]


def _gather(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The items of many runs of a pool, end to end."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


def _encoded(path: str, with_ids: bool, carry: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for batch in batches:
            lists = batch.column("pieces")
            ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
                part = batch.slice(start, stop - start)
                start = stop
                yield _digests(words, part, with_ids, carry)
                give_back()

    return run


def _digests(words: Coder, part: pa.RecordBatch, with_ids: bool, carry: tuple[str, ...]) -> pa.RecordBatch:
    lists = part.column("pieces")
    coded = lists.flatten().dictionary_encode()
    found, place = words.pieces(coded.dictionary)
    use = place[coded.indices.to_numpy(zero_copy_only=False)]
    n_ids, n_bytes = found.n_ids.astype(np.int64), found.n_bytes.astype(np.int64)
    id_pool, byte_pool = found.ids, found.bytes
    edges = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
    columns = {"doc_id": part.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
    all_ids = []
    id_starts, byte_starts = np.cumsum(n_ids) - n_ids, np.cumsum(n_bytes) - n_bytes
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        mine = use[a:b]
        ids = _gather(id_pool, id_starts[mine], n_ids[mine])
        raw = _gather(byte_pool, byte_starts[mine], n_bytes[mine])
        columns["n_tokens"].append(len(ids))
        columns["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
        columns["decoded_sha256"].append(hashlib.sha256(raw.tobytes()).hexdigest())
        if with_ids:
            all_ids.append(ids.astype(np.int32))
    if with_ids:
        columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
    columns |= {f"_carried_{i}": part.column(f"_carried_{i}") for i in range(len(carry))}
    kinds = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    arrays = [pa.array(v, kinds[k]) if k in kinds else v for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row (doc_id, n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids) per document, and the columns in `carry`.

    Each match of the pattern in the whole text is a piece; a piece that is a token stands for
    itself, any other is merged from its bytes, leftmost pair of smallest rank first. A null or
    empty text has no tokens. Rows are encoded one by one: a null or repeated doc_id is passed on and
    other columns are ignored. Digests are of the ids as little-endian unsigned 32-bit integers, and of
    the bytes that the ids decode to.

    The pieces of a text are cut in the JVM. A task encodes each distinct piece of a slice of
    its texts once, by a recursive query, and decodes its ids by an ordered aggregation;
    a worker remembers pieces up to a bounded number of bytes. A piece without a break that is very long is
    cut where no token can span, and what is still long contracts all its pairs of one rank
    in a round. Nothing is shuffled.
    """
    pieces = F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0))
    cut = texts_of(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(pieces, F.array().cast("array<string>")).alias("pieces"),
        *[F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)],
    )
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    kinds += "".join(f", _carried_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    coded = cut.mapInArrow(tidy(_encoded(path, with_ids, carry)), kinds)
    return coded.withColumnsRenamed({f"_carried_{i}": c for i, c in enumerate(carry)})


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """One row (doc_id, bytes) per row of (doc_id, ids); null ids decode to nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = coder(path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                ids = [np.array(x or [], np.uint32) for x in part.column("ids").to_pylist()]
                raw, sizes = words.decode(np.concatenate(ids), np.array([len(x) for x in ids]))
                texts = [x.tobytes() for x in np.split(raw, np.cumsum(sizes)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "bytes"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, bytes binary")
