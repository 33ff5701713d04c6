"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

# Fixed value: what a word is made of, beside white space.
WORDS = r"[^\x20\x09-\x0D]+"
LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH split AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents
), windows AS (
    SELECT r, unnest(range(1, len(w) - 33)) AS i,
        unnest(list_transform(range(1, len(w) - 33), lambda k: array_to_string(w[k : k + 34], ' '))) AS x
    FROM split WHERE len(w) >= 35
), hits AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY x) > 1
), placed AS (
    SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM split
), judged AS (
    SELECT placed.r, j, word, coalesce(j - max(i) OVER (PARTITION BY placed.r ORDER BY j) <= 34, false) AS gone
    FROM placed LEFT JOIN hits ON hits.r = placed.r AND hits.i = placed.j
), counted AS (
    SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept FROM judged GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN counted USING (r)
""",
    "op5_minhash_near_dedup": f"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all({LOWERED.format("text")}, '{WORDS}') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k : k + 2], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
    FROM split
), shingles AS (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (
    SELECT a, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least ON a = doc_id
""",
    "op7_exact_dedup": """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)
""",
    "op8_embedding_near_dedup": """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors AS a JOIN vectors AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (
    SELECT a, min(b) AS component_id FROM reached GROUP BY a
), counted AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN least ON least.a = vec_id LEFT JOIN counted ON counted.a = vec_id
""",
    # the crc32 of a document's run: bytes of UTF-8 (a run has none above U+00FF), folded with a table that follows from the polynomial
    "op11_spelling_variants": r"""
WITH RECURSIVE remainders AS (
    SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM range(256) AS bytes(b)
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
    FROM runs WHERE length(run) >= 7 GROUP BY ALL
), spelled AS (
    SELECT run, n, flatten(list_transform(string_split(doc_id || ':' || run, ''),
        lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END)) AS bytes
    FROM lowered
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_transform(bytes, lambda x: CAST(x AS BIGINT)),
        lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295)) AS h
    FROM spelled CROSS JOIN remainders
), damaged AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS (
    SELECT word, k, substr(word, 1, k) || substr(word, k + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS k FROM words)
), near AS (
    SELECT a.word AS a, b.word AS b FROM shorter AS a JOIN shorter AS b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
    UNION SELECT shorter.word, words.word FROM shorter JOIN words ON words.word = rest
    UNION SELECT words.word, shorter.word FROM shorter JOIN words ON words.word = rest
), forms AS (
    SELECT a, count(*) AS n_near, first(b ORDER BY words.n DESC, b) AS b, max(words.n) AS form_n FROM near JOIN words ON words.word = b GROUP BY a
), named AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN b END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
    FROM words LEFT JOIN forms ON a = word
), chain AS (
    SELECT word, word AS root FROM named UNION ALL SELECT chain.word, form FROM chain JOIN named ON named.word = chain.root WHERE form IS NOT NULL
), last AS (
    SELECT chain.word, root FROM chain JOIN named ON named.word = root WHERE form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM named JOIN last USING (word)
""",
}
