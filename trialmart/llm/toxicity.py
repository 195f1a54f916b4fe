"""Toxicity of whole texts by a weighted grammar of finite-state patterns over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import stored, text_slices, texts_of, tidy, worker_cache
from trialmart.llm.jaccard import shingle_sets

#: Bounds of the labelled sample that the model is fitted on.
TOXIC_ROWS, CLEAN_ROWS = 1500, 4500
#: Stems that may be learned, at most; the best supported are kept.
STEM_BOUND = 500
#: Rounds of learning stems.
STEM_ROUNDS = 4
THRESHOLD = 0.3
#: Hash functions of a sampled text's signature, which tells near copies among at most TOXIC_ROWS + CLEAN_ROWS texts.
SIGNATURE = 64
#: Bytes of text that a task scores at once.
SLICE = 1 << 21

# Words that the grammar starts from, in the four languages of the corpus.
SEED_INSULTS = "idiot moron stupid loser scum worthless pathetic disgusting trottel abschaum crétin ordure imbécil basura".split()
THREATS = "kill hurt destroy punch strangle töten verprügeln vernichten tuer frapper détruire matar golpear destruir".split()
TARGETS = "you your yours yourself du dich dir euch ihr tu toi vous tú ti usted ustedes vosotros".split()
NEGATIONS = "not never no nobody don't isn't aren't nicht kein keine nie pas jamais aucun nunca jamás ningún".split()
REPORTS = "said says wrote called claims quoted alleged sagte schrieb nannte behauptet écrit affirme appelé dijo escribió llamó".split()

#: Symbols of the clause alphabet: other, insult, threat, target, negation, reported speech.
SYMBOLS = "oihtnr"
#: What a clause can match; the model has a weight for each.
KINDS = ("aimed insult", "plain insult", "aimed threat", "plain threat", "negated", "reported")
PRIOR = np.array([3.0, 2.0, 3.0, 1.0, 0.5, 0.5])
BASE = -3.0

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """Deterministic: (state, symbol) to (state, symbols written). A missing arc copies the symbol
    and keeps the state; `final` maps a state to the symbols written at the end of a clause."""

    arcs: dict
    final: dict = field(default_factory=dict)
    start: object = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))

    def run(self, symbols: Iterable[str]) -> str:
        state, out = self.start, []
        for symbol in symbols:
            state, written = self.step(state, symbol)
            out.append(written)
        out.append(self.final.get(state, ""))
        return "".join(out)


def compose(first: Transducer, second: Transducer, alphabet: str) -> Transducer:
    """The transducer that gives second(first(clause)); its states are pairs."""

    def feed(state, symbols):
        written = []
        for symbol in symbols:
            state, out = second.step(state, symbol)
            written.append(out)
        return state, "".join(written)

    start = (first.start, second.start)
    arcs, final, todo = {}, {}, [start]
    seen = {start}
    while todo:
        a, b = todo.pop()
        for symbol in alphabet:
            a2, middle = first.step(a, symbol)
            b2, written = feed(b, middle)
            arcs[(a, b), symbol] = ((a2, b2), written)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
        end, written = feed(b, first.final.get(a, ""))
        final[a, b] = written + second.final.get(end, "")
    return Transducer(arcs, final, start)


def negation(reach: int = 3) -> Transducer:
    """An insult or threat within `reach` words after a negation is written as x."""
    arcs = {(k, "n"): (reach, "n") for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, s): (k - 1, s) for s in "otr"} | {(k, s): (k - 1, "x") for s in "ih"}
    return Transducer(arcs)


def reported() -> Transducer:
    """An insult or threat after a verb of reporting in the same clause is written as y."""
    arcs = {(0, "r"): (1, "r"), (1, "i"): (1, "y"), (1, "h"): (1, "y")}
    return Transducer(arcs)


def aims() -> Transducer:
    """Writes one letter for each match of KINDS (A to F): an insult or threat is aimed if its
    clause names a target, before or after it."""
    arcs = {}
    for i in range(3):  # matches that wait for a target: none, an insult, a threat
        for symbol in "onr":
            arcs[("open", i), symbol] = (("open", i), "")
        arcs[("open", i), "x"], arcs[("open", i), "y"] = (("open", i), "E"), (("open", i), "F")
        arcs[("open", i), "t"] = ("aimed", ["", "A", "C"][i])
        arcs[("open", i), "i"] = (("open", 1), ["", "B", "D"][i])
        arcs[("open", i), "h"] = (("open", 2), ["", "B", "D"][i])
    arcs |= {("aimed", s): ("aimed", "") for s in "onrt"}
    arcs |= {("aimed", s): ("aimed", w) for s, w in zip("ihxy", "ACEF", strict=True)}
    return Transducer(arcs, {("open", 1): "B", ("open", 2): "D"}, ("open", 0))


def grammar() -> Transducer:
    return compose(compose(negation(), reported(), SYMBOLS), aims(), SYMBOLS)


class Scorer:
    """Applies the grammar with a lexicon of insult stems and learned weights."""

    def __init__(self, stems: list[str], weights: np.ndarray, base: float):
        self.stems, self.weights, self.base = stems, weights, base
        self.machine = grammar()
        self.fixed = {}
        for words, symbol in ((THREATS, "h"), (TARGETS, "t"), (NEGATIONS, "n"), (REPORTS, "r")):
            self.fixed |= dict.fromkeys(words, symbol)
        self.prefixes = frozenset(stems)
        self.lengths = sorted({len(s) for s in stems})
        leads = sorted({*stems, *THREATS})
        self.leads = r"(?:^|[^\pL])(?:" + "|".join(map(re.escape, leads)) + ")"

    def symbol(self, word: str) -> str:
        if word in self.fixed:
            return self.fixed[word]
        return "i" if any(word[:n] in self.prefixes for n in self.lengths if n <= len(word)) else "o"

    def kinds(self, text: str) -> np.ndarray:
        """How often clauses of a lower-case text match each kind."""
        found: Counter = Counter()
        clause: list[str] = []
        for token in (*_TOKEN.findall(text), "."):
            if token[0] in ".!?;:\n":
                if "i" in clause or "h" in clause:
                    found.update(self.machine.run(clause))
                clause = []
            else:
                clause.append(self.symbol(token.replace("’", "'")))
        return np.array([found[k] for k in "ABCDEF"], float)

    def features(self, texts: pa.Array) -> np.ndarray:
        """Matched kinds per text; only texts that hold a stem or threat can match any."""
        low = pc.utf8_lower(pc.fill_null(texts, ""))
        hit = pc.match_substring_regex(low, self.leads).to_numpy(zero_copy_only=False)
        out = np.zeros((len(low), len(KINDS)))
        for i in np.flatnonzero(hit):
            out[i] = self.kinds(low[i].as_py())
        return np.log1p(out)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-(self.base + features @ self.weights)))


def in_fold(column: str, folds: int, fold: int):
    """Whether crc32 of the id as text leaves the remainder `fold`; a null id does not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % folds == fold, F.lit(False))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the signature of each text: for SIGNATURE hash functions, the smallest value over its five-word shingles."""
    worker_cache("toxicity")
    dice = np.random.default_rng(23)
    factors = dice.integers(1, 1 << 63, SIGNATURE, dtype=np.uint64) | np.uint64(1)
    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            h, sizes = shingle_sets(part.column("text"), 5)
            begin = (np.cumsum(sizes) - sizes)[sizes > 0]
            out = np.zeros((len(sizes), SIGNATURE), np.uint32)
            for k, factor in enumerate(factors):
                mixed = h.view(np.uint64) * factor
                mixed = ((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
                if len(begin):
                    out[sizes > 0, k] = np.minimum.reduceat(mixed, begin)
            signs = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, signs], [*part.schema.names, "sign"])


def families(signs: np.ndarray, least: float = 0.8) -> np.ndarray:
    """A family number per signature: those that agree in this share of places, or are led to each other
    by such, are near copies and one family."""
    needed = int(np.ceil(least * signs.shape[1]))
    family = np.arange(len(signs))
    for begin in range(0, len(signs), 256):
        block = signs[begin : begin + 256]
        agree = np.zeros((len(block), len(signs)), np.int16)
        for k in range(signs.shape[1]):
            agree += block[:, k, None] == signs[None, :, k]
        a, b = np.nonzero(agree >= needed)
        a += begin
        a, b = a[a < b], b[a < b]
        while len(a):  # the smallest number of either side, until nothing changes
            low = np.minimum(family[a], family[b])
            before = family.copy()
            np.minimum.at(family, family[a], low)
            np.minimum.at(family, family[b], low)
            family = family[family]
            if (before == family).all():
                break
    while (family != family[family]).any():
        family = family[family]
    return family


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight of toxic and of clean texts that hold a word or word prefix of 4 to 6 letters."""
    for batch in batches:
        weight: dict[str, list[float]] = {}
        for part in text_slices(batch, "text", SLICE):
            rows = zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), part.column("share").to_pylist(), strict=True)
            for text, toxic, share in rows:
                words = set(re.findall(r"[^\W\d_]{4,}", (text or "").lower()))
                for term in {w[:n] for w in words for n in (4, 5, 6, len(w))}:
                    weight.setdefault(term, [0.0, 0.0])[toxic] += share
        if weight:
            clean, toxic = zip(*weight.values(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(weight), pa.string()), pa.array(toxic, pa.float64()), pa.array(clean, pa.float64())],
                ["term", "toxic", "clean"],
            )


def _unmatched(scorer: Scorer):
    """Drops the toxic texts that the grammar already matches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                clean = pc.equal(part.column("toxic"), 0).to_numpy(zero_copy_only=False)
                yield part.filter(pa.array(clean | (scorer.features(part.column("text")).sum(axis=1) == 0)))

    return run


def _open_terms(scorer: Scorer):
    """The terms of the texts that are left. Both steps share a worker: of two Arrow functions in a row each takes a
    worker of its own per task, and all of them stay and serve later stages in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _terms(_unmatched(scorer)(batches))

    return run


def choose_stems(rows: list[tuple[str, float, float]]) -> list[str]:
    """Of well supported terms, those that no longer term replaces at the same support and
    that extend no chosen term."""
    support = {term: toxic for term, toxic, _ in rows}
    replaced = set()
    for term, toxic in support.items():
        for n in range(4, len(term)):
            if term[:n] in support and toxic >= 0.95 * support[term[:n]]:
                replaced.add(term[:n])
    kept: set[str] = set()
    for term in sorted(support, key=lambda t: (len(t), t)):
        if term not in replaced and not any(term[:n] in kept for n in range(4, len(term))):
            kept.add(term)
    return sorted(kept)


def learn(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> Scorer:
    """Fit stems and weights on labelled documents outside the held-out fold.

    At most TOXIC_ROWS and CLEAN_ROWS labelled rows are used, those with the smallest hash of the
    id. Near copies (about 0.8 of their five-word shingles in common) share one vote. A stem counts as an insult when so many toxic and so few
    clean texts hold it that chance would bring up less than one such term in a hundred samples;
    further rounds look for stems in the toxic texts that are still unmatched.
    Without labels of both kinds the grammar keeps its seed words and prior weights.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~in_fold("doc_id", folds, fold))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = rows.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS)
    picked = picked.unionByName(rows.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    texts = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked), "doc_id").select("text", "toxic")
    sample = stored(sample.mapInArrow(tidy(_signatures), "text string, toxic int, sign binary"), "labelled")
    signs = sample.groupBy("sign").agg(F.count("*").alias("n")).orderBy("sign").toArrow()
    if not signs.num_rows:
        return Scorer(sorted(SEED_INSULTS), PRIOR, BASE)
    rows = np.frombuffer(b"".join(signs.column("sign").to_pylist()), np.uint32).reshape(-1, SIGNATURE)
    family, n = families(rows), signs.column("n").to_numpy()
    shares = 1.0 / np.bincount(family, n)[family]
    shares = docs.sparkSession.createDataFrame(zip(signs.column("sign").to_pylist(), shares.tolist(), strict=True), "sign binary, share double")
    sample = sample.join(F.broadcast(shares), "sign").select("text", "toxic", "share")
    total = dict(sample.groupBy("toxic").agg(F.sum("share")).collect())
    if len(total) < 2:
        return Scorer(sorted(SEED_INSULTS), PRIOR, BASE)
    stems = set(SEED_INSULTS)
    for _ in range(STEM_ROUNDS):  # later rounds look only at toxic texts that nothing matches yet
        seen = Scorer(sorted(stems), PRIOR, BASE)
        open_rows = sample.mapInArrow(_unmatched(seen), "text string, toxic int, share double")
        terms = sample.mapInArrow(tidy(_open_terms(seen)), "term string, toxic double, clean double")
        terms = terms.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        left = open_rows.where("toxic = 1").agg(F.sum("share")).first()[0]
        if not left:
            break
        needed = max(2.0, math.log(1e8) / math.log((total[0] + left) / left))
        terms = terms.where((F.col("toxic") >= needed) & (F.col("clean") <= 0.03 * F.col("toxic")))
        best = terms.orderBy(F.desc("toxic"), "term").limit(STEM_BOUND).collect()
        if not best:
            break
        stems |= set(choose_stems([tuple(r) for r in best]))
    scorer = Scorer(sorted(stems), PRIOR, BASE)

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                x = scorer.features(part.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(KINDS)).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([lists, part.column("toxic"), part.column("share")], ["x", "toxic", "share"])

    got = sample.mapInArrow(tidy(matched), "x array<double>, toxic int, share double").toArrow()
    x = np.array(got.column("x").to_pylist(), float)
    y, share = got.column("toxic").to_numpy().astype(float), got.column("share").to_numpy()
    order_rows = np.lexsort((*x.T, y, share))  # the order of arrival must not show in the sums
    weights, base = fit(x[order_rows], y[order_rows], share[order_rows])
    return Scorer(scorer.stems, weights, base)


def fit(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, with weights drawn towards PRIOR."""
    design = np.column_stack([x, np.ones(len(x))])
    prior = np.append(PRIOR, BASE)
    w = prior.copy()
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (share * (p - y)) + ridge * (w - prior)
        curve = (design * (share * p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, score, predicted) for every document, from its whole text alone.

    A null text is empty; an empty text, or one without a matched clause, gets the base score.
    Equal texts get equal scores; a null or repeated doc_id is passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                s = scorer.scores(scorer.features(part.column("text")))
                marks = pa.array((s >= THRESHOLD).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), marks], ["doc_id", "score", "predicted"])

    texts = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tidy(run), "doc_id long, score double, predicted int")


def keep_clean(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The documents that are not predicted toxic, unchanged.

    A null or empty text has the base score and stays, as does one without a matched clause; repeated rows
    share one decision; a null doc_id does not matter.
    """
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("toxicity")
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                s = scorer.scores(scorer.features(part.column("text")))
                yield part.filter(pa.array(s < THRESHOLD))

    return texts_of(docs).mapInArrow(tidy(run), schema)
