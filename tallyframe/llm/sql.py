"""DuckDB SQL with the same results as those queries of this subpackage that SQL can express."""

from __future__ import annotations

NGRAM_JACCARD = r"""
WITH RECURSIVE split AS (
    SELECT doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS (
    SELECT doc_id, list_distinct(
        CASE WHEN len(words) = 0 THEN []
             WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
             ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS items
    FROM split
), exploded AS (
    SELECT doc_id, unnest(items) AS item FROM shingles
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_common
    FROM exploded x JOIN exploded y ON x.item = y.item AND x.doc_id <> y.doc_id
    GROUP BY ALL
), links AS (
    SELECT a, b FROM common o JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b
    WHERE 100 * n_common >= 85 * (len(x.items) + len(y.items) - n_common)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
)
SELECT s.doc_id, CAST(len(items) AS BIGINT) AS n_shingles, c.component_id
FROM shingles s JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) c ON c.a = s.doc_id
"""

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def crc32(codes: str) -> str:
    """Unsigned crc32 of a list of byte values, bit by bit: each byte is followed by the seven steps without one."""
    step = "xor(a, x)"
    return f"""xor(list_reduce(list_prepend(4294967295, flatten(list_transform({codes}, lambda b: [b, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, x: xor({step} >> 1, CASE WHEN {step} & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""


SPELLING = rf"""
WITH runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents
), counted AS (
    SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named, count(*) AS n FROM runs GROUP BY ALL
), bytes AS (
    SELECT run, n, hex(encode(named)) AS hexes FROM counted
), hashed AS (
    SELECT run, n, {crc32("list_transform(range(1, len(hexes), 2), lambda i: CAST('0x' || substr(hexes, i, 2) AS BIGINT))")} AS h FROM bytes
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word,
           CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), gaps AS (
    -- Near words share a word with one code point less, or with one code point hidden.
    SELECT word, n, substr(word, 1, k) || substr(word, k + 2) AS shape, 'without' AS kind FROM (SELECT *, unnest(range(0, length(word))) AS k FROM words)
    UNION ALL SELECT word, n, word, 'without' FROM words
    UNION ALL SELECT word, n, substr(word, 1, k) || '_' || substr(word, k + 2), 'hidden' FROM (SELECT *, unnest(range(0, length(word))) AS k FROM words)
), near AS (
    SELECT DISTINCT x.word, x.n, y.word AS near, y.n AS near_n
    FROM gaps x JOIN gaps y ON x.shape = y.shape AND x.kind = y.kind AND x.word <> y.word
    WHERE x.kind = 'hidden' OR (abs(length(x.word) - length(y.word)) = 1 AND x.shape IN (x.word, y.word))
), best AS (
    SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM near GROUP BY word
), formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form,
           CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
), chained AS (
    WITH RECURSIVE follow AS (
        SELECT word, word AS root, form FROM formed
        UNION ALL
        SELECT f.word, g.word, g.form FROM follow f JOIN formed g ON g.word = f.form
    )
    SELECT word, root FROM follow WHERE form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chained USING (word)
"""

PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 100 AS base, {crc32("list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST(c AS VARCHAR), i, 1)) AS BIGINT))")} % 6 AS h
    FROM (SELECT DISTINCT c FROM turns)
), built AS (
    SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d
    FROM (SELECT v.c, 0 AS own, t.role, t.text, t.pos FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
          UNION ALL
          SELECT v.c, 1, t.role, t.text, t.pos FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h)
), prefixes AS (
    SELECT c, d AS depth, list({{'r': role, 't': text}}) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS key FROM built
    UNION ALL
    SELECT c, 0, CAST([] AS STRUCT(r VARCHAR, t VARCHAR)[]) FROM convs
), lengths AS (
    SELECT c, max(depth) AS length FROM prefixes GROUP BY c
), nodes AS (
    SELECT key, depth, min(c) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE length = depth), '') AS ends
    FROM prefixes JOIN lengths USING (c) GROUP BY key, depth
), children AS (
    SELECT key[1:depth - 1] AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), leveled AS (
    SELECT n.*, coalesce(k.n_children, 0) AS n_children, CAST(k.n_children IS NULL AS BIGINT) AS leaf,
           CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(key[depth].t) END AS saved
    FROM nodes n LEFT JOIN children k USING (key)
), subtrees AS (
    SELECT key[1:top] AS key, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS top FROM leveled) GROUP BY 1
)
SELECT l.conv_id, l.depth, p.conv_id AS parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens, sha256(l.ends) AS ends_sha256
FROM leveled l JOIN subtrees s USING (key) LEFT JOIN nodes p ON l.depth > 0 AND p.key = l.key[1:l.depth - 1]
"""
