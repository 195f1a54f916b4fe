"""SQL for DuckDB that gives the rows of the queries that SQL can express.

The learned predictions, the tokenizers and the pipeline have none: their tests follow them by
brute force.
"""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: All pairs of vectors; links in double precision.
_VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
), good AS (
    SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
    WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), unit AS (
    SELECT vec_id, list_transform(e, lambda x: x / size) AS u FROM good WHERE size > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u)
    WHERE list_dot_product(a.u, b.u) >= 0.9
), reach AS (
    SELECT vec_id AS id, vec_id AS other FROM embeddings
    UNION
    SELECT r.id, p.b FROM reach r JOIN pairs p ON p.a = r.other
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings
JOIN (SELECT id AS vec_id, min(other) AS component_id FROM reach GROUP BY id) USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a) USING (vec_id)
"""

#: Sources in order of size per weight: those before the first that fits the common rate are at their cap.
_MIX = rf"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight
    FROM docs GROUP BY source
), rates AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM totals WINDOW o AS (ORDER BY source_size / weight, source ASC NULLS LAST)
), targets AS (
    SELECT source, source_size, least(3.0::DOUBLE * source_size,
        coalesce(max(CASE WHEN rate * weight <= 3 * source_size THEN rate END) OVER (), 0) * weight) AS target FROM rates
), placed AS (
    SELECT d.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS whole,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), fitted AS (
    SELECT *, target - whole * source_size AS rest,
        target - whole * source_size > 0 AND before + size <= target - whole * source_size AS fits FROM placed
), gaps AS (
    SELECT source, max(rest) - sum(CASE WHEN fits THEN size ELSE 0 END) AS gap FROM fitted GROUP BY source
), fillers AS (
    SELECT f.source, arg_min(before, (abs(gap - size), before)) AS filler
    FROM fitted f JOIN gaps g ON f.source IS NOT DISTINCT FROM g.source
    WHERE NOT fits AND size > 0 AND abs(gap - size) < gap GROUP BY f.source
)
SELECT doc_id, size, source_size, target,
    CAST(size * (whole + (fits OR (size > 0 AND before = coalesce(filler, -1)))::BIGINT) AS BIGINT) AS taken
FROM fitted f LEFT JOIN fillers g ON f.source IS NOT DISTINCT FROM g.source
"""

#: Pairs of documents by the shingles they share.
_NEAR = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '{WORD}'),
        lambda w: translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words
), items AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
    SELECT doc_id AS id, doc_id AS other FROM documents
    UNION
    SELECT r.id, p.b FROM reach r JOIN pairs p ON p.a = r.other
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sets JOIN (SELECT id AS doc_id, min(other) AS component_id FROM reach GROUP BY id) USING (doc_id)
"""

_CONTROLS = r"(\\*)(<s>|</s>|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[/ROLE\]|\[/TURN\])"
#: Characters of the output: marks of each kind of turn, the text, and what escaping adds to it.
_CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length(regexp_replace(text, '{_CONTROLS}', '\\1\\1\\\\\\2', 'g')) AS shown,
        length(regexp_replace(role, '{_CONTROLS}', '\\1\\1\\\\\\2', 'g')) AS role_shown FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(3 + sum(CASE role WHEN 'user' THEN 7 + shown + 8 WHEN 'assistant' THEN 6 + shown + 5
        ELSE 7 + role_shown + 9 + shown + 8 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: Every query against every candidate, in whole numbers.
_TOP = """
WITH codes AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: q.c[i] * d.c[i])) AS BIGINT) AS score
    FROM codes q JOIN codes d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

#: Five hexadecimal digits of a digest are four letters of its base-32 form.
_PAGES = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), n AS (
    SELECT page_id, html, list_transform(range(0, 8), lambda k: CAST('0x' || substr(hex, CAST(5 * k + 1 AS INTEGER), 5) AS BIGINT)) AS parts,
        max(page_id) OVER (PARTITION BY html) AS keeper FROM p
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(parts, lambda x: array_to_string(list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> s) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM n
"""

#: crc32 step by step over the UTF-8 bytes of letters up to U+00FF; near words by shared deletions.
_SPELLING = r"""
WITH RECURSIVE poly AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS steps
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL
), hashed AS (
    SELECT doc_id, run, n,
        xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id || ':' || run, ''),
            lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)]::BIGINT[] END))),
            lambda c, x: xor(c >> 8, poly.steps[1 + xor(c & 255, x)])), 4294967295) AS h
    FROM counted, poly
), words AS (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY ALL
), vocabulary AS (
    SELECT word, n FROM words WHERE length(word) >= 7 AND n >= 2
), cut AS (
    SELECT word, n, unnest(range(length(word))) AS i FROM vocabulary
), dropped AS (
    SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS rest FROM cut
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM dropped a JOIN dropped b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM dropped a JOIN vocabulary b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM dropped a JOIN vocabulary b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
    SELECT v.word, CASE WHEN near_n >= 10 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN best b ON v.word = b.word
), follow AS (
    SELECT word, word AS place, 0 AS step FROM forms
    UNION ALL
    SELECT f.word, n.form, f.step + 1 FROM follow f JOIN forms n ON n.word = f.place WHERE n.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(place, step) AS root FROM follow GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""

STATEMENTS: dict[str, str] = {
    "op3_embedding_links": _VECTORS,
    "op4_source_mix": _MIX,
    "op5_ngram_jaccard": _NEAR,
    "op6_chat_format": _CHAT,
    "op8_top_products": _TOP,
    "op10_warc": _PAGES,
    "op12_spelling": _SPELLING,
}


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
