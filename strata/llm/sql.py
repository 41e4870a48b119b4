"""SQL for the queries that SQL can express, over the tables as they are."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op7_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
        FROM (SELECT doc_id, sha256({LOWER}) AS text_sha256 FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op8_ngram_join": f"""
        WITH RECURSIVE split AS (
            SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents
        ), shingled AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))))
                END AS s
            FROM split
        ), sets AS (
            SELECT row_number() OVER (ORDER BY min(doc_id)) AS id, s, min(doc_id) AS least
            FROM shingled WHERE len(s) > 0 GROUP BY s
        ), parts AS (
            SELECT id, len(s) AS n, unnest(s) AS g FROM sets
        ), links AS (
            SELECT a.id AS a, b.id AS b FROM parts a JOIN parts b
            ON a.g = b.g AND a.id <> b.id AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
            GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), reached AS (
            SELECT id, id AS other FROM sets
            UNION
            SELECT reached.id, links.b FROM reached JOIN links ON links.a = reached.other
        ), least AS (
            SELECT reached.id, min(sets.least) AS component_id
            FROM reached JOIN sets ON sets.id = reached.other GROUP BY reached.id
        )
        SELECT doc_id, len(shingled.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
        FROM shingled LEFT JOIN sets ON sets.s = shingled.s AND len(shingled.s) > 0 LEFT JOIN least USING (id)
    """,
    "op11_spelling": r"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))) AS tab
        ), runs AS (
            SELECT run, count(*) AS times, coalesce(doc_id::VARCHAR, '') || ':' || run AS named
            FROM (SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            GROUP BY doc_id, run
        ), hashed AS (
            SELECT run, times, xor(4294967295, list_reduce([4294967295] || list_transform(range(octet_length(encode(named))),
                lambda k: ('0x' || substr(hex(encode(named)), 2 * k + 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, tab[xor(c % 256, b) + 1]))) AS h
            FROM runs, crc WHERE length(run) >= 7
        ), words AS (
            SELECT word, sum(times)::BIGINT AS n FROM (
                SELECT times, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
                FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2
        ), cuts AS (
            SELECT word, p, left(word, p - 1) || substr(word, p + 1) AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS p FROM words)
        ), longer AS (
            SELECT DISTINCT cuts.word AS a, words.word AS b FROM cuts JOIN words ON cuts.rest = words.word
        ), pairs AS (
            SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
            UNION ALL SELECT a, b FROM longer UNION ALL SELECT b, a FROM longer
        ), best AS (
            SELECT a, b, o.n AS o_n, count(*) OVER (PARTITION BY a) AS n_near,
                   row_number() OVER (PARTITION BY a ORDER BY o.n DESC, encode(b)) AS turn
            FROM pairs JOIN words o ON o.word = b
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN o_n >= 10 * n THEN b END AS form, CASE WHEN o_n >= 10 * n THEN o_n END AS form_n
            FROM words LEFT JOIN best ON a = word AND turn = 1
        ), chain AS (
            SELECT word, coalesce(form, word) AS tip, 0 AS step FROM formed
            UNION ALL
            SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.tip WHERE formed.form IS NOT NULL
        )
        SELECT word, form, arg_max(tip, step) AS root, n, n_near, form_n FROM formed JOIN chain USING (word) GROUP BY ALL
    """,
    "op12_fill_in_middle": r"""
        WITH units AS (
            SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                   list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), k, 8) AS BIGINT)) AS h
            FROM documents
        ), cut AS (
            SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
                   greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                        WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM units
        ), parts AS (
            SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
                   coalesce(array_to_string(u[b + 1:], ''), '') AS suffix
            FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
               sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE t END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
    "op13_substrings": """
        WITH texts AS (
            SELECT row_number() OVER () AS id, doc_id, hex(encode(coalesce(text, ''))) AS t, octet_length(encode(coalesce(text, '')))::INT AS n
            FROM documents
        ), blocks AS (
            SELECT id, 512 * k AS base, substr(t, (1024 * k + 1)::INT, 1024 + 800) AS part, least(512, n - 399 - 512 * k) AS m
            FROM (SELECT id, t, n, unnest(range(0, (n - 400) // 512 + 1)) AS k FROM texts WHERE n >= 400)
        ), strings AS (
            SELECT id, base + q AS p, md5_number(substr(part, (2 * q + 1)::INT, 800)) AS h
            FROM (SELECT id, base, part, unnest(range(0, m)) AS q FROM blocks)
        ), starts AS (
            SELECT id, p FROM strings WHERE h IN (SELECT h FROM strings GROUP BY h HAVING count(*) > 1)
        ), led AS (
            SELECT *, p > coalesce(lag(p) OVER (PARTITION BY id ORDER BY p), -1000) + 400 AS opens FROM starts
        ), spans AS (
            SELECT id, min(p)::INT AS a, max(p)::INT + 400 AS b
            FROM (SELECT *, sum(opens::INT) OVER (PARTITION BY id ORDER BY p) AS run FROM led) GROUP BY id, run
        ), cuts AS (
            SELECT texts.id, count(a) AS n_spans, coalesce(sum(b - a), 0)::BIGINT AS n_removed,
                   list_concat([0], coalesce(list(b ORDER BY a) FILTER (a IS NOT NULL), [])) AS ends,
                   list_concat(coalesce(list(a ORDER BY a) FILTER (a IS NOT NULL), []), [any_value(n)]) AS begins
            FROM texts LEFT JOIN spans USING (id) GROUP BY texts.id
        )
        SELECT doc_id, n::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(array_to_string(
            list_transform(list_zip(ends, begins), lambda g: substr(t, 2 * g[1] + 1, 2 * (g[2] - g[1]))), ''))) AS kept_sha256
        FROM texts JOIN cuts USING (id)
    """,
}
