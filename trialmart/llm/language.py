"""Language of whole texts: a linear-chain conditional random field labels every word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import BROADCAST_ROWS, stored, text_slices, texts_of, tidy, worker_cache, words_of
from trialmart.llm.toxicity import in_fold

#: Bounds of the labelled sample that the field is fitted on: SAMPLE_DOCS are shared among the languages,
#: of which each has from LEAST_PER_LANGUAGE to DOCS_PER_LANGUAGE documents, or all it has.
SAMPLE_DOCS, DOCS_PER_LANGUAGE, LEAST_PER_LANGUAGE, WINDOWS_PER_DOC, WINDOW_WORDS = 12_800, 200, 20, 4, 20
#: Words in the lexicon, at most, and slots for affixes and n-grams (a power of two).
LEXICON_BOUND, SLOTS = 20_000, 1 << 17
EPOCHS, RATE, DECAY = 40, 0.5, 1e-6

#: Bytes of text that a task labels at once.
SLICE = 1 << 21

UNDETERMINED = "und"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def letters_only(words: pa.Array) -> pa.Array:
    """Words in lower case without anything but letters."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\pL]+", "")


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all affixes (1 to 3 letters) and n-grams (2 and 3 letters) of non-empty words,
    the word that each slot belongs to, and a 64-bit hash of each word."""
    code = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    first = np.flatnonzero(code == 2)
    size = np.append(first[1:], len(code)) - first  # letters and two marks
    owner = np.repeat(np.arange(len(words)), size)
    ahead = np.repeat(first + size, size) - np.arange(len(code))  # characters to the end, itself included
    behind = np.arange(len(code)) - np.repeat(first, size)
    padded = np.concatenate([code, np.zeros(4, np.uint64)])
    slots, owners = [], []

    def emit(values, kind, which):
        h = (values * _PRIME + np.uint64(kind)) * _PRIME
        slots.append((h >> np.uint64(64 - 17)).astype(np.int64))
        owners.append(owner[which])

    with np.errstate(over="ignore"):
        gram = code * _PRIME
        for n in range(2, 5):
            gram = (gram ^ padded[n - 1 : n - 1 + len(code)]) * _PRIME
            begins, ends = (behind == 0) & (ahead >= n), (ahead == n) & (behind >= 0)
            emit(gram[begins], 1, begins)  # prefixes hold the opening mark
            emit(gram[ends], 2, ends)  # suffixes the closing one
            if n < 4:
                inside = (behind > 0) & (ahead > n)
                emit(gram[inside], 3, inside)
        weights = (behind.astype(np.uint64) + np.uint64(1)) * _PRIME
        mixed = (code + weights) * (weights | np.uint64(1))
        mixed ^= mixed >> np.uint64(29)
        whole = np.add.reduceat(mixed * _PRIME, first) if len(words) else np.zeros(0, np.uint64)
    slot, owner = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return slot[order], owner[order], whole


@dataclass
class Field:
    """Labels, weights of slots and lexicon words, transitions and starts; all learned."""

    labels: list[str]
    slot_weights: np.ndarray
    lexicon: np.ndarray
    word_weights: np.ndarray
    transitions: np.ndarray
    starts: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each label for each word; words must not be empty."""
        out = np.zeros((len(words), len(self.labels)))
        if words:
            slot, owner, whole = features(words)
            per = np.bincount(owner, minlength=len(words))
            out = np.add.reduceat(self.slot_weights[slot], np.cumsum(per) - per, axis=0)
            if len(self.lexicon):
                at = np.minimum(np.searchsorted(self.lexicon, whole), len(self.lexicon) - 1)
                out += np.where((self.lexicon[at] == whole)[:, None], self.word_weights[at], 0)
        return out


def marginals(scores: np.ndarray, counts: np.ndarray, transitions: np.ndarray, starts: np.ndarray, pairs: bool = False):
    """Forward-backward over many sequences at once.

    scores: label scores of all words, sequences end to end; counts: words of each. Returns the
    label probabilities of every word and, on request, the summed probabilities of label pairs.
    Sequences run side by side, longest first, and are normalised word by word.
    """
    labels = scores.shape[1]
    order = np.argsort(-counts, kind="stable")
    counts_down, begin = counts[order], (np.cumsum(counts) - counts)[order]
    longest = int(counts_down[0]) if len(counts_down) else 0
    alive = np.searchsorted(-counts_down, -np.arange(longest), side="left")  # sequences longer than t
    at = np.concatenate([begin[:n] + t for t, n in enumerate(alive)]) if longest else np.zeros(0, np.int64)
    edges = np.concatenate([[0], np.cumsum(alive)])
    local = np.exp(scores - scores.max(axis=1, keepdims=True))[at]
    move = np.exp(transitions)
    alpha = np.empty_like(local)
    for t in range(longest):
        lo, hi = edges[t], edges[t + 1]
        step = local[lo:hi] * (np.exp(starts) if t == 0 else alpha[edges[t - 1] : edges[t - 1] + hi - lo] @ move)
        alpha[lo:hi] = step / step.sum(axis=1, keepdims=True)
    beta = np.ones_like(local)
    expected = np.zeros((labels, labels))
    for t in range(longest - 2, -1, -1):
        lo, n = edges[t], alive[t + 1]
        nxt = local[edges[t + 1] : edges[t + 2]] * beta[edges[t + 1] : edges[t + 2]]
        back = nxt @ move.T
        if pairs:
            z = (alpha[lo : lo + n] * back).sum(axis=1, keepdims=True)
            expected += move * ((alpha[lo : lo + n] / z).T @ nxt)
        beta[lo : lo + n] = back / back.sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=1, keepdims=True)
    out = np.empty_like(post)
    out[at] = post
    return out, expected


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of words spread evenly over each sampled text."""
    for batch in batches:
        for part in text_slices(batch, "text", 1 << 22):
            flat, counts = words_of(part.column("text"), lower_ascii=False)
            words = letters_only(flat).to_pylist()
            ends = np.cumsum(counts)
            rows = {"lang": [], "words": []}
            for lang, b, e in zip(part.column("lang").to_pylist(), ends - counts, ends, strict=True):
                own = [w for w in words[b:e] if w]
                gap = max(WINDOW_WORDS, len(own) // WINDOWS_PER_DOC)
                for s in range(0, len(own), gap)[:WINDOWS_PER_DOC]:
                    rows["lang"].append(lang)
                    rows["words"].append(" ".join(own[s : s + WINDOW_WORDS]))
            yield pa.RecordBatch.from_pydict(rows, pa.schema([("lang", pa.string()), ("words", pa.string())]))


def learn(docs: DataFrame, folds: int = 3, fold: int = 1) -> Field:
    """Fit the field on text and lang of documents outside the held-out fold.

    The sample holds about DOCS_PER_LANGUAGE documents (by hash of the id) of every language, fewer if
    there are so many languages that this would be more than SAMPLE_DOCS, and of each some runs of words.
    Sequences join runs of one to three languages, so that switches are learned too. Without labelled text
    there are no labels, and every prediction is UNDETERMINED. The field takes about 1 MB per language.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~in_fold("doc_id", folds, fold))
    counted = stored(usable.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    languages = counted.count()
    if not languages:
        return Field([], np.zeros((SLOTS, 0)), np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0))
    wanted = min(DOCS_PER_LANGUAGE, max(LEAST_PER_LANGUAGE, SAMPLE_DOCS / languages))
    shares = counted.select("lang", (F.lit(float(wanted)) / F.col("rows")).alias("share"))
    shares = F.broadcast(shares) if languages <= BROADCAST_ROWS else shares
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) / 1_000_000.0
    sample = usable.join(shares, "lang").where(place < F.col("share"))
    rows = sample.select("lang", "text").mapInArrow(tidy(_windows), "lang string, words string").toArrow().to_pylist()
    return fit(sorted((r["lang"], r["words"]) for r in rows))


def fit(rows: list[tuple[str, str]]) -> Field:
    """Train on (label, words of a run): AdaGrad on the likelihood of joined runs."""
    labels = sorted({lang for lang, _ in rows})
    dice = np.random.default_rng(7)
    runs = [(labels.index(lang), words.split(" ")) for lang, words in rows if words]
    dice.shuffle(runs)
    sequences, i = [], 0
    while i < len(runs):
        n = int(dice.integers(1, 4))
        sequences.append(runs[i : i + n])
        i += n
    vocabulary: dict[str, int] = {}
    flat = [(vocabulary.setdefault(w, len(vocabulary)), y) for s in sequences for y, words in s for w in words]
    words = np.array([w for w, _ in flat], np.int64)
    gold = np.array([y for _, y in flat], np.int64)
    counts = np.array([sum(len(ws) for _, ws in s) for s in sequences], np.int64)
    n_labels = len(labels)
    names = list(vocabulary)
    slot, owner, whole = features(names) if names else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    uses = np.bincount(words, minlength=len(names))
    common = np.argsort(-uses, kind="stable")[:LEXICON_BOUND]
    common = common[uses[common] >= 3]
    lexicon, keep = np.unique(whole[common], return_index=True)
    place = np.full(len(names), -1)
    place[common[keep]] = np.arange(len(lexicon))
    model = Field(labels, np.zeros((SLOTS, n_labels)), lexicon, np.zeros((len(lexicon), n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    heads = (np.cumsum(counts) - counts).astype(np.int64)
    follows = np.ones(len(gold), bool)
    follows[heads] = False
    inner = np.flatnonzero(follows)
    seen_pairs = np.zeros((n_labels, n_labels))
    np.add.at(seen_pairs, (gold[inner - 1], gold[inner]), 1)
    squares = [np.full_like(w, 1e-8) for w in (model.slot_weights, model.word_weights, model.transitions, model.starts)]
    target = np.eye(n_labels)[gold]
    per = np.bincount(owner, minlength=len(names))
    starts_of = np.cumsum(per) - per
    for _ in range(EPOCHS if len(gold) else 0):
        base = np.add.reduceat(model.slot_weights[slot], starts_of, axis=0)
        if len(lexicon):
            base += np.where((place >= 0)[:, None], model.word_weights[place], 0)
        post, pairs = marginals(base[words], counts, model.transitions, model.starts, pairs=True)
        miss = target - post
        by_word = np.stack([np.bincount(words, miss[:, k], len(names)) for k in range(n_labels)], axis=1)
        spread = by_word[owner]
        steps = [
            np.stack([np.bincount(slot, spread[:, k], SLOTS) for k in range(n_labels)], axis=1) - DECAY * model.slot_weights,
            by_word[common[keep]] - DECAY * model.word_weights,
            seen_pairs - pairs,
            miss[heads].sum(axis=0),
        ]
        for w, step, square in zip((model.slot_weights, model.word_weights, model.transitions, model.starts), steps, squares, strict=True):
            square += step * step
            w += RATE * 0.2 * step / np.sqrt(square)
    return model


def label_texts(model: Field, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: mean label probabilities over its words, words with letters, and words whose
    most likely label is not that of the text."""
    flat, counts = words_of(texts, lower_ascii=False)
    coded = flat.dictionary_encode()
    names = letters_only(coded.dictionary)
    real = pc.not_equal(names, "").to_numpy(zero_copy_only=False)
    scores = np.zeros((len(names), len(model.labels)))
    scores[real] = model.emissions(names.filter(pa.array(real)).to_pylist())
    code = coded.indices.to_numpy(zero_copy_only=False)
    keep = real[code] if len(code) else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(counts)), counts)[keep]
    counts = np.bincount(owner, minlength=len(counts))
    mean, odd = np.zeros((len(counts), len(model.labels))), np.zeros(len(counts), np.int64)
    if len(owner) and model.labels:
        post, _ = marginals(scores[code[keep]], counts, model.transitions, model.starts)
        some = counts > 0
        mean[some] = np.add.reduceat(post, (np.cumsum(counts) - counts)[some], axis=0) / counts[some, None]
        odd = np.bincount(owner, post.argmax(axis=1) != mean.argmax(axis=1)[owner], len(counts)).astype(np.int64)
    return mean, counts, odd


def _decided(model: Field, texts: pa.Array):
    mean, counts, odd = label_texts(model, texts)
    best = mean.argmax(axis=1) if model.labels else np.zeros(len(counts), np.int64)
    known = (counts > 0) & bool(model.labels)
    names = np.array([*model.labels, UNDETERMINED], object)[np.where(known, best, len(model.labels))]
    score = np.where(known, mean.max(axis=1) if model.labels else 0.0, 0.0)
    return names, np.clip(score, 0, 1), counts, odd


def predict(docs: DataFrame, model: Field) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_other) for every document, from its whole text alone.

    Every word with a letter is labelled by forward-backward over the whole text; lang_pred has the largest
    mean probability (ties: the first label), which is the score; n_other counts words labelled
    differently (code switches). A null text, or one without a letter, is UNDETERMINED with score 0.
    A null or repeated doc_id is passed on.
    """
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                names, score, counts, odd = _decided(model.value, part.column("text"))
                columns = [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(counts), pa.array(odd)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "n_words", "n_other"])

    texts = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(tidy(run), "doc_id long, lang_pred string, score double, n_words long, n_other long")


def keep_determined(docs: DataFrame, model: Field, least: float = 0.5, column: str | None = None) -> DataFrame:
    """The documents with a language that carries at least `least` of the label probability of
    their words, unchanged but for `column`, which holds that language if it is named; null texts and texts
    without a letter go. Equal texts share one decision, whatever their doc_id."""
    schema = docs.schema
    at = None if column is None else docs.columns.index(column)
    model = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                names, score, _, _ = _decided(model.value, part.column("text"))
                if at is not None:
                    part = part.set_column(at, part.schema.field(at), pa.array(names, pa.string()).cast(part.schema.field(at).type))
                yield part.filter(pa.array((names != UNDETERMINED) & (score >= least)))

    return texts_of(docs).mapInArrow(tidy(run), schema)
