"""Spelling variants, periodic runs and the multi-index, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from trialmart.llm import multi_index, periods, queries, spelling

DOCS = "doc_id long, text string, word string, n int, runs int, m int, key int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(vocabulary, factor):
    out = {}
    form = {}
    for w, n in vocabulary.items():
        others = [v for v in vocabulary if near(w, v)]
        best = min(others, key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= factor * n else None
        out[w] = (form[w], None, n, len(others), vocabulary[form[w]] if form[w] else None)
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (out[w][0], root, *out[w][2:])
    return out


@pytest.mark.parametrize(("group", "letters", "count", "longest"), [(20_000, "ab", 250, 9), (3, "ab", 250, 9), (3, "abc\u00e9", 200, 6), (2, "a", 12, 14)])
def test_near_words_equal_brute_force(spark, monkeypatch, group, letters, count, longest):
    """Also when states are split down to windows of one place."""
    monkeypatch.setattr(spelling, "GROUP", group)
    dice = random.Random(5)
    words = {"".join(dice.choice(letters) for _ in range(dice.randint(1, longest))): i for i in range(count)}
    rows = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n long, near string, m int")
    got = [tuple(r) for r in spelling.near_words(rows).collect()]
    expected = {(a, b, words[b]) for a in words for b in words if near(a, b)}
    assert len(got) == len(set(got)) and set(got) == expected


def test_small_chunks_of_words_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CHUNK", 3)
    words = ["letters", "lettesr", "letter", "latters", "better", "betters"]
    rows = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    assert {(r[0], r[1]) for r in spelling.near_words(rows).collect()} == {(a, b) for a in words for b in words if near(a, b)}


def test_forms_are_followed_to_their_root(spark):
    words = {"letters": 5000, "leters": 400, "letrs": 30, "lettrs": 2, "letterz": 499, "chain": 1, "chains": 10, "zhains": 10, "\u00e9toile": 3, "etoile": 30}
    rows = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in spelling.variants(rows).collect()}
    assert got == brute_variants(words, 10)
    assert got["letrs"][:2] == ("leters", "letters")


def test_vocabulary_of_awkward_rows(spark):
    texts = [
        (1, "Letters LETTERS letters, sixsix sevenly"),
        (2, "\u00c9toiles \u00e9toiles \u0130stanbul \u00d7\u00f7\u00d7\u00f7\u00d7\u00f7\u00d7"),
        (None, "letters letters"),
        (3, None),
        (4, ""),
        (5, "letters " * 5000),
        (5, "letters " * 5000),
    ]
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in texts], DOCS)
    for slips in (None, 3):
        expected = Counter()
        for i, t in texts:
            for run in re.findall("[A-Za-z\u00c0-\u00ff]+", t or ""):
                run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
                h = zlib.crc32(f"{i}:{run}".encode())
                if slips and i is not None and h % slips == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                expected[run] += len(run) >= 7
        found = {r["word"]: r["n"] for r in spelling.vocabulary(docs, 7, 2, slips).collect()}
        assert found == {w: n for w, n in expected.items() if n >= 2 and len(w) >= 7}
    assert spelling.variants(spelling.vocabulary(docs.limit(0)), 7).count() == 0


def brute_runs(words):
    out, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_digest(words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    hexes = ["".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in drop)]
    facts = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *facts, *(hashlib.sha256(h.encode()).hexdigest() for h in hexes))


def test_transform_inverts_and_convolves():
    dice = np.random.default_rng(4)
    for size in (2, 8, 64):
        transform = periods.Transform(size)
        a, b = dice.integers(0, periods.PRIME, (2, size, 3), dtype=np.uint64)
        product = transform.inverse(transform.forward(a.copy()) * transform.forward(b.copy()) % np.uint64(periods.PRIME))
        for column in range(3):
            expected = [sum(int(a[i, column]) * int(b[(k - i) % size, column]) for i in range(size)) % periods.PRIME for k in range(size)]
            assert product[:, column].tolist() == expected


def test_runs_equal_brute_force():
    dice = random.Random(3)
    for _ in range(400):
        ids, owner, expected = [], [], []
        for text in range(dice.randint(1, 4)):
            n, kinds = dice.randint(0, 90), dice.choice([1, 2, 3, 5, 30])
            words = [dice.randrange(kinds) for _ in range(n)]
            if n > 20 and dice.random() < 0.6:
                a = dice.randrange(n)
                p = 1 + (n - a) // dice.randint(3, 9)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            expected += [(len(ids) + s, k, q) for s, k, q in brute_runs(words)]
            ids += [*words, 1000 + text]
            owner += [text] * (n + 1)
        got = periods.find_runs(np.array(ids, np.uint64), np.array(owner, np.int64))
        assert [tuple(r) for r in got.tolist()] == expected


def test_runs_of_awkward_rows(spark):
    dice = random.Random(8)
    texts = [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "a b " * 6),
        (4, "a b " * 6),
        (None, "x " * 12),
        (10, "x " * 11 + "x"),
        (11, "one\u00a0word " * 20 + "tail"),
        (12, "w " * 30_000 + "end"),
        (13, " ".join(dice.choice("abc") for _ in range(500))),
    ]
    texts += [(i, " ".join(f"w{dice.randrange(400)}" for _ in range(dice.randint(1, 200)))) for i in range(20, 80)]
    docs = spark.createDataFrame([(i, t, "x", 1, 2, 3, 4) for i, t in texts], DOCS)
    got = Counter(tuple(r) for r in periods.digest(periods.periodic_runs(docs)).collect())
    long = next(r for r in got if r[0] == 12)
    assert long[1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert got == Counter([long, *((i, *brute_digest(WORDS.findall(t or ""))) for i, t in texts if i != 12)])
    planted = []
    for i, t in texts:
        words = WORDS.findall(t or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        if i != 12:
            planted.append((i, *brute_digest(words)))
    found = periods.digest(periods.periodic_runs(periods.with_planted_periods(docs.where("doc_id IS NULL OR doc_id <> 12"))))
    assert Counter(tuple(r) for r in found.collect()) == Counter(planted)
    assert periods.digest(periods.periodic_runs(docs.limit(0))).count() == 0


def test_runs_of_a_shared_table_equal_brute_force(spark, folder):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, folder).collect()}
    changed = periods.with_planted_periods(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    short = [(r["doc_id"], WORDS.findall(r["text"] or "")) for r in changed if len(r["text"] or "") < 6000]
    assert len(got) == len(changed) and len(short) > 150
    for i, words in short:
        assert got[i] == brute_digest(words)


VECTORS = "vec_id long, embedding array<double>, key int, first int, block int, query int"


def brute_neighbours(rows, k, every):
    good = [(i, v) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    width = max(len(v) for _, v in good)
    x = np.array([list(v) + [0.0] * (width - len(v)) for _, v in good])
    ids = np.array([i for i, _ in good])
    out = []
    for row in np.flatnonzero(ids % every == 0):
        gain = (x[row] * x).sum(axis=1)
        order = [j for j in np.lexsort((ids, -gain)) if j != row][:k]
        out += [(int(ids[row]), n + 1, int(ids[j]), float(gain[j])) for n, j in enumerate(order)]
    return out


def test_neighbours_of_awkward_vectors(spark):
    """So few that the index visits everything: equal to brute force, ties and repeated rows included."""
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0]), (40, [0.0, 0.0]), (60, None), (None, [1.0, 1.0])]
    rows += [(80, [float("nan"), 1.0]), (100, [1.0, None]), (120, [2.0, 1.0, 0.0]), (140, []), (160, [-1e30, 1e30, -5.0]), (7, [float("inf"), 1.0])]
    rows += [(200 + i, [1.0, 2.0]) for i in range(60)]
    frame = spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS)
    got = multi_index.neighbours(frame, k=5, every=20).collect()
    assert Counter(tuple(r) for r in got) == Counter(brute_neighbours(rows, 5, 20))
    assert multi_index.neighbours(frame.limit(0)).count() == 0


@pytest.mark.parametrize("spread", [0.15, None])
def test_recall_and_scores(spark, monkeypatch, spread):
    """Recall against brute force of at least 0.9, on clusters and without any; crowded cells in blocks."""
    monkeypatch.setattr(multi_index, "ENTRIES", 100)
    dice = np.random.default_rng(2)
    x = dice.normal(size=(3000, 16))
    if spread:
        x = dice.normal(size=(20, 16))[dice.integers(0, 20, 3000)] + spread * x
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = [tuple(r) for r in multi_index.neighbours(spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], VECTORS)).collect()]
    expected = brute_neighbours(rows, 20, 20)
    assert len(got) == len(expected)
    assert len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in expected}) >= 0.9 * len(expected)
    scores = {(q, v): s for q, _, v, s in got}
    assert all(s == (x[q] * x[v]).sum() for (q, v), s in scores.items())
    by_query = {}
    for q, rank, v, s in got:
        by_query.setdefault(q, []).append((rank, -s, v))
    assert all([r[1:] for r in sorted(b)] == sorted(r[1:] for r in b) and sorted(r[0] for r in b) == list(range(1, 21)) for b in by_query.values())


def test_traversal_comes_in_order_of_summed_distance():
    dice = np.random.default_rng(6)
    index = multi_index.Index((dice.normal(size=(5, 3)), dice.normal(size=(7, 3))), 6)
    query = dice.normal(size=6)
    gains = [query[:3] @ index.halves[0][i] + query[3:] @ index.halves[1][j] for i, j in index.traverse(query)]
    assert len(gains) == 35 and np.allclose(gains, sorted(gains, reverse=True))


def test_shared_vectors_reach_the_recall(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = {(q, v) for q, _, v, _ in brute_neighbours([(i, [float(x) for x in v]) for i, v in rows], 20, 20)}
    got = {(r["query_id"], r["vec_id"]) for r in queries.op11_multi_index(spark, folder).collect()}
    assert len(got & expected) >= 0.9 * len(expected)
