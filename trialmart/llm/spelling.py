"""Spelling variants: a vocabulary acceptor composed with a one-edit transducer and itself."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import BROADCAST_ROWS, stored

#: Words of one initial state, at most (about); states with more are split by narrower windows.
GROUP = 20_000
#: Words whose acceptors share one table of states in a task, about.
CHUNK = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Acceptor:
    """Minimal acyclic acceptors over one table of states: equal right languages are one state."""

    def __init__(self):
        self.states: list[tuple[bool, tuple]] = []
        self.register: dict[tuple, int] = {}
        self.shared: dict[tuple[int, int], tuple[str, ...]] = {}

    def _state(self, final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        found = self.register.get(key)
        if found is None:
            found = self.register[key] = len(self.states)
            self.states.append(key)
        return found

    def add(self, words: list[str]) -> int:
        """Initial state of the acceptor of sorted distinct words."""
        path: list[list] = [[False, []]]
        before = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1].append((before[len(path) - 1], self._state(final, arcs)))

        for word in words:
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            close(same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0] = True
            before = word
        close(0)
        return self._state(*path[0])

    def common(self, x: int, y: int) -> tuple[str, ...]:
        """All strings that two states both accept: the acceptor composed with itself."""
        found = self.shared.get((x, y))
        if found is None:
            out, todo = [], [(x, y, "")]
            while todo:
                a, b, head = todo.pop()
                (end_a, arcs_a), (end_b, arcs_b) = self.states[a], self.states[b]
                if end_a and end_b:
                    out.append(head)
                if a == b:
                    todo += [(t, t, head + c) for c, t in arcs_a]
                else:
                    there = dict(arcs_b)
                    todo += [(t, there[c], head + c) for c, t in arcs_a if c in there]
            found = tuple(out)
            if len(found) <= 8:  # long answers are listed again rather than kept
                self.shared[x, y] = found
        return found

    def one_edit(self, start: int, places: int) -> Iterator[tuple[str, str]]:
        """Accepted pairs of the composition from one initial state: words that differ by one replaced
        letter, and words with another that has one letter more. A letter that could be inserted
        at several places counts at the last, if that is among the first `places`."""
        todo = [(start, "")]
        while todo:
            state, head = todo.pop()
            arcs = self.states[state][1]
            for i, (a, x) in enumerate(arcs):
                todo.append((x, head + a))
                for b, y in arcs[i + 1 :]:
                    for tail in self.common(x, y):
                        yield head + a + tail, head + b + tail
                if len(head) >= places:
                    continue
                for tail in self.common(state, x):
                    if tail[:1] != a:
                        yield head + tail, head + a + tail


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of words that are sorted by the key of their initial state."""
    held: list[tuple] = []
    last = None
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "m", "low", "high")), strict=True)
        for row in rows:
            if len(held) >= CHUNK and row[0] != last:
                yield from _pairs(held)
                held = []
            last = row[0]
            held.append(row)
    if held:
        yield from _pairs(held)


def _pairs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Both directions of every near pair within the groups of some rows."""
    groups: dict[tuple, dict[str, int]] = {}
    for _, word, n, m, low, high in rows:
        stop = min(high + len(word) - m, len(word))
        groups.setdefault((m, low, high, word[:low], word[stop:]), {})[word[low:stop]] = n
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    table, out = Acceptor(), []
    for (m, low, high, before, after), counts in groups.items():
        if len(counts) < 2:
            continue
        short = min(high, m) - low
        for a, b in table.one_edit(table.add(sorted(counts)), high - low):
            if len(a) > short:  # two words of the longer length meet in their own group
                continue
            one, other = before + a + after, before + b + after
            out += [(one, other, counts[b]), (other, one, counts[a])]
            if len(out) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def vocabulary(docs: DataFrame, least_letters: int = 7, least_count: int = 2, slips: int | None = None) -> DataFrame:
    """(word, n): the words of all whole texts that have at least so many letters and occurrences.

    A word is a maximal run of letters up to U+00FF, with A-Z in lower case. With `slips`, the
    words of a document of which that number divides the crc32 of `<doc_id>:<word>` lose one letter. A
    null text has no words, a null doc_id no slips; repeated rows count one by one.
    """
    low = F.translate(F.col("text").cast("string"), _UPPER, _LOWER)
    runs = F.regexp_extract_all(low, F.lit(rf"[a-z\u00C0-\u00FF]{{{least_letters},}}"), F.lit(0))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if slips:
        h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run"))
        cut = (h % F.char_length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.char_length("run")))
        word = F.when(h % slips == 0, shorter).otherwise(F.col("run"))
    words = words.select(word.alias("word")).where(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _state_key() -> Column:
    """Hash of an initial state: what all its words have before and after the window of the edit."""
    stop = F.col("high") + F.char_length("word") - F.col("m")
    before, after = F.substring("word", F.lit(1), F.col("low")), F.substring("word", stop + 1, F.char_length("word"))
    return F.xxhash64("m", "low", "high", before, after)


def near_words(words: DataFrame, least_letters: int = 1) -> DataFrame:
    """(word, near, near_n), once for each ordered pair of the distinct words (word, n) that differ by exactly
    one inserted, deleted or replaced code point.

    A pair has a class m, the length of its shorter word, and a place of its edit, 0 to m. Words are
    dealt by class and by what precedes and follows a window of places; that prefix is the initial
    state of their acceptor. A state with more than GROUP words is split into the two halves of its
    window until a window is one place wide: then its words differ in one or two letters, and an
    alphabet bounds them. So no task holds more than a bounded state, whatever words have in common.
    """
    size = F.char_length("word")
    classes = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("m")).where(F.col("m") >= least_letters)
    half = F.floor((F.col("m") + 1) / 2).cast("int")
    sides = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), (F.col("m") + 1).alias("high")))
    dealt = classes.withColumn("side", F.explode(sides)).where("side.low < side.high")
    todo = stored(dealt.select("word", "n", "m", "side.low", "side.high").withColumn("key", _state_key()), "states")
    done = []
    while True:
        sizes = todo.where("high - low > 1").groupBy("key").agg(F.count("*").alias("members"))
        large = stored(sizes.where(F.col("members") > GROUP).select("key"), "large-states")
        count = large.count()
        if not count:
            done.append(todo)
            break
        large = F.broadcast(large) if count <= BROADCAST_ROWS else large
        # a window of one place cannot be large here, but its key may be that of another state
        done.append(todo.join(large, "key", "left_anti").unionByName(todo.where("high - low = 1").join(large, "key", "left_semi")))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        sides = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
        split = todo.where("high - low > 1").join(large, "key", "left_semi").withColumn("side", F.explode(sides))
        todo = stored(split.select("word", "n", "m", "side.low", "side.high").withColumn("key", _state_key()), "states")
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    rows = rows.select("key", "word", "n", "m", "low", "high").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_near, "word string, near string, near_n long")


def variants(words: DataFrame, least_letters: int = 1, factor: int = 10) -> DataFrame:
    """One row (word, form, root, n, n_near, form_n) per word of a vocabulary (word, n).

    n_near counts its near words; `form` is the most frequent of them (ties: smallest in code-point order)
    if it occurs at least `factor` times as often, else null, and form_n its n; `root` is where
    following forms ends, the word itself without one. Counts grow along forms, so chains are short
    (at most 19 steps for a factor of 10) and are followed in doubling steps. An empty vocabulary
    gives no rows. Words must be distinct and not null.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = near_words(words, least_letters)
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    summed = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(summed, "word", "left")
    is_form = F.col("best.near_n") >= factor * F.col("n")
    found = stored(
        found.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = moved.select("word", "root")
        if not moved.where("moved").head(1):
            break
    return found.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
