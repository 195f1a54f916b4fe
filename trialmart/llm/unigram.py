"""Token counts under a unigram vocabulary, without building the tokens."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import worker_cache

#: Segments whose counts a worker remembers, at most; others are counted again.
REMEMBERED = 200_000
#: Segments of texts that a task works on at once, about.
SLICE = 400_000

SPACE = "▁"
#: An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0


class Counter:
    """Best segmentation of a text by summed scores, carried as score and number of pieces.

    An automaton lists the pieces that end at each character, longest first. A later candidate replaces an
    earlier one only if it scores more, so ties go to the piece that starts first. A character
    that is no piece may stand as unknown and counts its UTF-8 bytes (byte fallback), or one token if
    the vocabulary has no byte pieces.
    """

    def __init__(self, pieces: dict[str, float], byte_fallback: bool):
        self.byte_fallback = byte_fallback
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        #: Whether no piece crosses from another character to a space: then texts fall apart there.
        self.cuts = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, match in self.automaton.iter(text):
                ends[end].append(match)
        score, pieces = [0.0] * (n + 1), [0] * (n + 1)
        for e in range(n):
            best, number, single = None, 0, False
            for length, worth in ends[e]:
                start = e + 1 - length
                sum_ = score[start] + worth
                single = single or length == 1
                if best is None or sum_ > best:
                    best, number = sum_, pieces[start] + 1
            if not single:
                sum_ = score[e] + self.unknown
                if best is None or sum_ > best:
                    cost = len(text[e].encode("utf-8", "surrogatepass")) if self.byte_fallback else 1
                    best, number = sum_, pieces[e] + cost
            score[e + 1], pieces[e + 1] = best, number
        return pieces[n]

    def counts(self, segments: list[str]) -> np.ndarray:
        out = np.zeros(len(segments), np.int64)
        for i, segment in enumerate(segments):
            n = self.known.get(segment)
            if n is None:
                n = self.count(segment.replace(" ", SPACE))
                if len(self.known) < REMEMBERED:
                    self.known[segment] = n
            out[i] = n
        return out


def load(path: str) -> Counter:
    """The pieces and scores of a model file; control, unknown and byte pieces match no text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    has_bytes = any(model.is_byte(i) for i in range(model.get_piece_size()))
    return Counter({model.id_to_piece(i): model.get_score(i) for i in plain}, has_bytes)


def counter(path: str) -> Counter:
    """The worker's counter for a model file."""
    cache = worker_cache("unigram")
    if path not in cache:
        cache[path] = load(path)
    return cache[path]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) per document: tokens of the whole text under the unigram vocabulary of a model.

    Text is taken as it stands, with one space in front, and spaces as the vocabulary's space mark. A null or
    empty text has no tokens. A null or repeated doc_id is passed on; other columns are ignored.

    No piece of such a vocabulary continues over the start of a run of spaces, so the best segmentation is
    that of each run of spaces with the word after it; every distinct one in a slice is
    counted once. A vocabulary with such pieces is counted over whole texts.
    """
    whole = load(path).cuts
    pattern = " *[^ ]+| +" if whole else "(?s).+"
    text = F.concat(F.lit(" "), F.col("text").cast("string"))
    pieces = F.when(F.length("text") > 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(pieces, F.array().cast("array<string>")).alias("pieces")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(path)
        for batch in batches:
            lists = batch.column("pieces")
            edges = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
            flat = lists.flatten()
            sums = np.zeros(batch.num_rows, np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            for begin in range(0, len(flat), SLICE):
                coded = flat.slice(begin, SLICE).dictionary_encode()
                n = words.counts(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
                np.add.at(sums, owner[begin : begin + SLICE], n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sums)], ["doc_id", "n_tokens"])

    return cut.mapInArrow(run, "doc_id long, n_tokens long")
