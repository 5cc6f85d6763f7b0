"""DuckDB statements for the queries of this package that SQL can express on whole tables."""

_GAPS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS place,
           unnest(string_split(text, chr(10))) AS line
    FROM documents
), bare AS (
    SELECT *, trim(line, {_GAPS}) AS bare FROM lines
), often AS (
    SELECT source, bare FROM (
        SELECT source, bare, count(DISTINCT doc_id) AS pages FROM bare WHERE bare <> '' GROUP BY source, bare
    ) JOIN (SELECT source, count(*) AS total FROM documents GROUP BY source) USING (source)
    WHERE pages >= 5 AND pages > 0.07 * total
), marked AS (
    SELECT b.*, o.bare IS NOT NULL AS dropped
    FROM bare b LEFT JOIN often o ON b.source = o.source AND b.bare = o.bare
), kept AS (
    SELECT doc_id, count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped) AS text
    FROM marked GROUP BY doc_id
)
SELECT doc_id, n_lines, n_dropped, sha256(coalesce(text, '')) AS kept_sha256 FROM kept
"""

_LETTERS = "[A-Za-z\u00c0-\u00ff]"

# crc32 by its table, which follows from the polynomial; letters up to U+00FF have one or two bytes
SPELLING = rf"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '{_LETTERS}{{6,}}')) AS run FROM documents
), each AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs GROUP BY ALL
), coded AS (
    SELECT run, n, list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x: unicode(x)::BIGINT) AS u
    FROM each
), hashed AS (
    SELECT run, n, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(u, lambda x:
        CASE WHEN x < 128 THEN [x] ELSE [192::BIGINT | (x >> 6), 128::BIGINT | (x & 63)] END))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS h
    FROM coded, crc
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM (
        SELECT n, CASE WHEN h % 199 = 0
            THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
        FROM hashed
    ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
    SELECT word, k, substr(word, 1, k) || substr(word, k + 2) AS rest
    FROM (SELECT word, unnest(range(length(word)))::INT AS k FROM words)
), near AS (
    SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.rest = w.word
    UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.rest = w.word
), best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS most
    FROM (SELECT near.word, other, words.n FROM near JOIN words ON words.word = other) GROUP BY word
), chosen AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN other END AS form,
           CASE WHEN most >= 5 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN best USING (word)
), walk(word, here, form) AS (
    SELECT word, word, form FROM chosen
    UNION ALL
    SELECT walk.word, c.word, c.form FROM walk JOIN chosen c ON c.word = walk.form
)
SELECT c.word, c.form, walk.here AS root, c.n, c.n_near, c.form_n
FROM chosen c JOIN walk ON walk.word = c.word WHERE walk.form IS NULL
"""

ORACLE_SQL: dict[str, str] = {"op3_line_dedup": LINE_DEDUP, "op12_spelling_variants": SPELLING}
