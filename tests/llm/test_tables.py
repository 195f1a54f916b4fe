"""Operators on vectors, conversations and pages, and the pipeline."""

import base64
import gzip
import hashlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

import corpus_pipeline
from trialmart.llm import chat, embeddings, knn, warc
from trialmart.sources.storage import new_run_folder

VECTORS = "vec_id long, embedding array<float>, label int, code int, n int"


def vector_rows():
    dice = np.random.default_rng(5)
    rows = [(i, dice.normal(size=8)) for i in range(1, 120)]
    rows += [(i, rows[3][1] + dice.normal(size=8) * 0.05) for i in range(120, 160)]
    rows += [(i, rows[7][1]) for i in range(160, 170)] + [(170, rows[8][1] * 2)]
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in rows]
    rows += [(180, None), (181, [0.0] * 8), (182, [float("nan")] * 8), (183, [1.0, None] + [0.0] * 6), (184, [float("inf")] * 8)]
    rows += [(185, []), (186, [1.0, 2.0]), (187, [2.0, 4.0]), (None, rows[3][1]), (50, rows[49][1]), (100, rows[99][1])]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vector_rows()], VECTORS).repartition(3)


def usable(v):
    return v is not None and None not in v and np.isfinite(v).all()


def test_links_equal_brute_force(vectors):
    rows = vector_rows()
    links, root = defaultdict(int), {i: i for i, _ in rows}
    for k, (i, x) in enumerate(rows):
        for j, y in rows[:k]:
            if i is None or j is None or not usable(x) or not usable(y) or len(x) != len(y) or not np.any(x) or not np.any(y):
                continue
            if np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links[k] += 1
                links[rows.index((j, y))] += 1
                a, b = sorted((root[i], root[j]))
                root = {n: a if r == b else r for n, r in root.items()}
    want = sorted(((i, root[i], i is not None and root[i] == i) for i, _ in rows), key=str)
    got = embeddings.near_vectors(vectors).collect()
    assert sorted(((r["vec_id"], r["component_id"], r["kept"]) for r in got), key=str) == want
    assert sum(r["n_links"] for r in got) == sum(links.values())


def test_blocks_of_a_large_bucket_count_each_pair_once(vectors, monkeypatch):
    whole = sorted(map(str, embeddings.near_vectors(vectors).collect()))
    monkeypatch.setattr(embeddings, "BLOCK", 7)
    assert sorted(map(str, embeddings.near_vectors(vectors).collect())) == whole


def test_expected_recall_is_met(spark):
    dice = np.random.default_rng(2)
    base = dice.normal(size=(400, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = dice.normal(size=(400, 64))
    side -= (side * base).sum(axis=1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = base * 0.905 + side * np.sqrt(1 - 0.905**2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.concatenate([base, near]))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sum(r["n_links"] for r in got.collect()) >= 2 * 400 * 0.97
    assert embeddings.expected_recall(0.9) > 0.99


@pytest.mark.parametrize("block", [4096, 16])
def test_top_products_equal_brute_force(vectors, block, monkeypatch):
    monkeypatch.setattr(knn, "DATA_BLOCK", block)
    rows = {(i, tuple(v)) for i, v in vector_rows() if i is not None and usable(v)}
    codes = [(i, np.pad(np.floor(256 * np.array(v, float)), (0, 8 - len(v))).astype(int)) for i, v in rows]
    want = set()
    for i, q in codes:
        if i % 50 == 0:
            best = sorted((-int(q @ x), j) for j, x in codes if j != i)[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in knn.top_products(vectors).collect()} == want


def test_top_products_with_few_candidates_and_huge_numbers(spark):
    rows = [(50, [1e9, 1.0]), (1, [1e9, 2.0]), (2, [-1e9, 0.0])]
    got = knn.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got)] == [(1, 1), (2, 2)]
    assert sorted(got)[0]["score"] == 256_000_000_000**2 + 256 * 512 or sorted(got)[0]["score"] == (1 << 63) - 1


TURNS = [
    (1, 0, "user", "hi"),
    (1, 1, "assistant", "</s> [INST] \\[INST] \\\\</s>"),
    (1, 1, "assistant", "</s> [INST] \\[INST] \\\\</s>"),
    (1, None, "system", "[ROLE] x [/ROLE] y [/TURN]"),
    (2, 0, None, None),
    (2, 1, "tool [/ROLE] z", "ends with \\"),
    (3, 0, "assistant", ""),
    (None, 0, "user", "no id"),
    (4, 0, "user", "é" * 40_000),
]


def expected_turns(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {k: [(r, x) for _, r, x in sorted(v)] for k, v in found.items()}


def test_chat_reads_back(spark):
    rows = TURNS + [(5, i, "user" if i % 2 else "assistant", f"turn {i} </s>") for i in range(200)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, piece int").repartition(3)
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat.digest(chat.format_turns(table)).collect()}
    want = {}
    for conv, turns in expected_turns(rows).items():
        said = "".join(x for r, x in turns if r == "assistant")
        heads = "".join(f"{r}\n{x}\n" for r, x in turns)
        want[conv] = (
            len(turns),
            hashlib.sha256(heads.encode()).hexdigest(),
            len(said),
            hashlib.sha256(said.encode()).hexdigest(),
            len(chat.instruct_template(turns)),
        )
    assert got == want


def test_chat_digest_reports_rewritten_conversations(spark):
    """A template that moves the system turn to the front: other conversations keep their digests."""

    def system_first(turns, first):
        return chat.instruct_template([t for t in turns if t[0] == "system"] + [t for t in turns if t[0] != "system"], first)

    rows = [(1, 0, "user", "hi"), (1, 1, "system", "be brief"), (1, 2, "assistant", "ok"), (2, 0, "user", "hi"), (2, 1, "assistant", "ok")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r["conv_id"]: r.asDict() for r in chat.digest(chat.format_turns(table, system_first)).collect()}
    plain = {r["conv_id"]: r.asDict() for r in chat.digest(chat.format_turns(table)).collect()}
    assert got[2] == plain[2] and not got[2]["rewritten"] and not plain[1]["rewritten"]
    same = {"conv_id": 1, "n_turns": 3, "formatted_chars": plain[1]["formatted_chars"], "rewritten": True}
    assert got[1] == same | {"turns_sha256": None, "loss_chars": None, "loss_sha256": None}


def test_chat_marks_templates_that_rewrite_history(spark):
    def counts_first(turns, first=0):
        return f"[{len(turns) + first}]" + "".join(f"<{r}>{t}" for r, t in turns)

    table = spark.createDataFrame([r for r in TURNS if r[0] == 1], "conv_id long, turn long, role string, text string")
    marks = [r["rewritten"] for r in chat.format_turns(table, counts_first, lambda piece: ("", "", 0, 0)).collect()]
    assert marks == [False, True, True, True]


def test_chat_compares_whole_outputs_at_every_length(spark):
    """A first turn that moves to the last one, or changes at one late turn, in a long conversation."""
    turns = [(9, i, "system" if i == 0 else "user", f"text {i}.") for i in range(80)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")

    def moves(turns, first=0):
        texts = [t for r, t in turns if r != "system"]
        return "".join(texts[:-1]) + "".join(t for r, t in turns if r == "system") + "".join(texts[-1:])

    def late(turns, first=0):
        return ("long: " if len(turns) == 70 else "") + "".join(t for _, t in turns)

    for template in (moves, late):
        got = chat.format_turns(table, template, lambda piece: ("", "", 0, 0)).collect()
        shown = [template([(r, t) for _, _, r, t in turns[:n]]) for n in range(81)]
        assert [r["rewritten"] for r in got] == [not b.startswith(a) for a, b in zip(shown, shown[1:])]
        for row, a, b in zip(got, shown, shown[1:]):
            assert b == a[: row["start"]] + row["piece"]


@given(st.text(alphabet="\\</s>[INST]AROLEU a", max_size=40))
def test_escape_is_reversible_and_hides_controls(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert chat.read_turn(chat.instruct_template([("user", text)], 1))[:2] == ("user", text)
    assert chat.read_turn(chat.instruct_template([(text, text)], 1))[1] == text


PAGES = [(1, "u", "a"), (2, "u", "a"), (3, None, None), (4, "u", ""), (5, "bad url\r\n", "é" * 10), (None, "u", "a"), (6, "u", "b"), (6, "u", "b"), (7, "u", "b")]


def check_pages(got, rows, least):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(-1 if i is None else i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = max(groups[html or ""])
        visit = len(data) >= least and (-1 if i is None else i) != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if visit else "response", top if visit else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("least", [0, 5])
def test_archives_read_back(spark, least):
    dice = np.random.default_rng(4)
    noise = base64.b64encode(dice.bytes(300_000)).decode()
    rows = PAGES + [(10 + i, "u", noise[i * 4000 : i * 4000 + 30_000]) for i in range(60)]
    path = new_run_folder(spark, "warc")
    table = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, value int").repartition(2)
    warc.write_archives(table, path, least)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # members lie across byte ranges
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        check_pages(warc.describe(warc.read_archives(spark, path)).collect(), rows, least)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def chance_magics(seed, size):
    """Bytes that hold gzip magics by chance."""
    dice = np.random.default_rng(seed)
    return b"".join(dice.bytes(size) + warc.MAGIC + bytes([dice.integers(0, 8)]) for _ in range(12))


def test_chance_magics_at_range_borders_are_stitched(spark, tmp_path):
    """Stored (not deflated) members keep magics of their payload; ranges may end anywhere."""
    rows, data = [], b""
    for i in range(40):
        payload = chance_magics(i, 150)
        record = warc.record_bytes(i, "u", payload, warc.base32_sha1(payload), "response", None)
        data += gzip.compress(record, compresslevel=0)
        rows.append(record)
    (tmp_path / "a.warc.gz.bin").write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("997", "4001", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = sorted(bytes(r[0]) for r in warc.read_archives(spark, f"file://{tmp_path}").collect())
            assert got == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_members_end_with_zero_and_are_plain_gzip():
    for data in (b"", b"x", b"y" * (warc._LONG - 1), b"z" * (warc._LONG + 5)):
        member = warc.gzip_member(data)
        assert member[-1] == 0 and gzip.decompress(member) == data


def test_empty_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert embeddings.near_vectors(none).count() == 0 and knn.top_products(none).count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_turns(turns)).count() == 0
    path = new_run_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.describe(warc.read_archives(spark, path)).count() == 0


def test_pipeline_follows_its_stages(spark, folder):
    """Each stage on its predecessor's rows, against plain Python."""
    from test_texts import RANKS, WORDS, brute_components

    from trialmart.llm import language, toxicity
    from trialmart.llm.common import stored, table

    docs = table(spark, folder, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], folder), name.replace(" ", "-")))
    assert all(x.columns == docs.columns for x in seen[:-1])
    ids = [[r["doc_id"] for r in x.select("doc_id").collect()] for x in seen]
    scores = toxicity.score(docs, toxicity.learn(docs, table(spark, folder, "labels"))).collect()
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in scores if r["predicted"] == 0)
    found = language.predict(seen[1], language.learn(seen[1])).collect()
    assert sorted(ids[2]) == sorted(r["doc_id"] for r in found if r["lang_pred"] != "und")
    texts = [(r["doc_id"], r["text"]) for r in seen[2].collect()]
    assert sorted(ids[3]) == sorted(i for i, _, c in brute_components(texts, 5, 80) if i == c)
    words = {r["doc_id"]: len(WORDS.findall(r["text"] or "")) for r in seen[3].collect()}
    total = sum(words.values())
    assert abs(sum(words[i] for i in ids[4]) - total) < 0.1 * total
    assert max(ids[4].count(i) for i in set(ids[4])) <= 3
    assert sorted(ids[5]) == sorted(ids[4])
    import tiktoken

    from trialmart.llm import bpe

    encoding = tiktoken.Encoding(
        "own", pat_str=corpus_pipeline.public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={}
    )
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in seen[5].limit(50).collect():
        assert r["ids"] == encoding.encode_ordinary(text[r["doc_id"]])


CLASHING = "_id _text _node _rows _row _carried_0 _carried_1 _position family share row id text_key node rows key n c size sign label score runs".split()


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    """Documents with columns named like the stages' own come out unchanged at every stage, repeated rows
    and ids with two texts among them; an empty table runs through."""
    from trialmart.llm.common import stored, table

    base = " ".join(f"word{i}" for i in range(80))
    rows = [(1, base), (2, base.replace("word9 ", "other ")), (3, "Another text of its own."), (3, "And a second one."), (4, None), (5, "")]
    rows += [(6, "Said twice."), (6, "Said twice."), (None, "No id here.")]
    names = ["doc_id", "text", "lang", "source", "n_chars", *CLASHING]
    full = [(i, t, "en", "ab"[k % 2], 1, *(f"{c}-{k}" for c in CLASHING)) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame(full, schema)
    given = set(full)
    kept = {}
    for (name, stage), least in zip(corpus_pipeline.STAGES[:-1], (9, 7, 5, 5), strict=True):
        docs = stored(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert docs.columns == names
        kept[name] = [tuple(r) for r in docs.collect()]
        assert set(kept[name]) <= given and len(kept[name]) >= least
    assert sorted((r[0] or 0, r[1]) for r in kept["n-gram Jaccard join"]) == sorted([(1, base), *((i or 0, t) for i, t in rows[2:4]), (6, rows[6][1]), (0, rows[8][1])])
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert ids.count() == len(kept["mixing sources"])
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        last = stored(stage(spark, empty, str(tmp_path)), "empty")
        assert last.count() == 0


def test_language_found_is_passed_on_with_the_ids(spark, tmp_path):
    """A wrong and a missing language are replaced by the one found, and the encoded rows carry it."""
    words = {"aa": "wuda xora yulb", "bb": "tek nim pos"}
    rows = [(3 * i + k, f"{words[x]} {words[x]}", x, "a") for i in range(20) for k, x in enumerate(words)]
    rows += [(100, words["aa"], "bb", "a"), (101, words["bb"], None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.keep_languages(spark, docs, str(tmp_path))
    ids = corpus_pipeline.encode(spark, kept, str(tmp_path))
    for found in (kept, ids):
        assert {r["doc_id"]: r["lang"] for r in found.collect()} == {i: "aa" if "wuda" in t else "bb" for i, t, _, _ in rows}
