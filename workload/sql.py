"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

import re

from askquarry.functions import prompts
from askquarry.functions.text import ENTITIES, TIDY_PATTERNS, html_patterns
from askquarry.operators.plugins import ANSWER_TOKENS, PLAIN_ANSWER_TOKENS
from workload.queries import BUDGET, HISTORY_WORDS, MIN_DOCS, NAMESPACE, QUESTION, TOPIC

SPACE = r"[ \t\r\n\f]+"


def text(value: str) -> str:
    """A string literal; E-strings only where escapes are needed."""
    body = value.replace("'", "''")
    if "\n" not in value:
        return f"'{body}'"
    return "E'" + body.replace("\\", "\\\\").replace("\n", "\\n") + "'"


def words(expr: str) -> str:
    return f"list_filter(string_split_regex({expr}, '{SPACE}'), lambda w: w <> '')"


def sentences(expr: str) -> str:
    marked = rf"regexp_replace({expr}, '([.!?]+)[ \t\r\f]+', E'\\1\n', 'g')"
    return f"list_filter(string_split_regex({marked}, '[\\r\\n\\f]+'), lambda s: len({words('s')}) > 0)"


def html_text(expr: str) -> str:
    for pattern, replacement in html_patterns():
        expr = f"regexp_replace({expr}, {text(pattern)}, {text(replacement)}, 'g')"
    for entity, char in ENTITIES:
        expr = f"replace({expr}, {text(entity)}, {text(char)})"
    for pattern, replacement in TIDY_PATTERNS:
        expr = f"regexp_replace({expr}, {text(pattern)}, {text(replacement)}, 'g')"
    return expr


def render(template: str, **values: str) -> str:
    parts = re.split(r"\{(\w+)\}", template)
    pieces = [text(p) if i % 2 == 0 else f"coalesce({values[p]}, '')" for i, p in enumerate(parts) if p]
    return " || ".join(pieces)


# --- shared table expressions -------------------------------------------------------

DOCS = "docs AS (SELECT source || '/' || doc_id AS url, text AS content FROM documents)"
PAGES = f"web AS (SELECT url, {html_text('html')} AS content FROM pages)"


def chunks(source: str = "docs", name: str = "chunks") -> str:
    return f"""{name}_words AS (SELECT url, {words('content')} AS w FROM {source} WHERE content IS NOT NULL),
{name} AS (
  SELECT md5(url || '#' || chunk_no) AS id, url, chunk_no,
         array_to_string(w[490 * chunk_no + 1 : 490 * chunk_no + 500], ' ') AS content
  FROM (SELECT url, w, unnest(range(greatest(1, CAST(ceil((len(w) - 10) / 490.0) AS BIGINT)))) AS chunk_no
        FROM {name}_words WHERE len(w) > 0))"""


def embedded(source: str, key: str, content: str, name: str) -> str:
    """Hashed embeddings in long form, with the length of the stored (float) vector."""
    return f"""{name}_bag AS (
  SELECT {key} AS k, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS bucket, count(*) AS c
  FROM (SELECT {key}, unnest({words(content)}) AS w FROM {source}) GROUP BY ALL),
{name} AS (
  SELECT k, bucket, CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY k)) AS FLOAT) AS DOUBLE) AS v FROM {name}_bag),
{name}_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM {name} GROUP BY k)"""


def matches(queries: str, corpus: str, k: int, name: str = "matches") -> str:
    """Exact cosine top-k over two long-form vector tables."""
    return f"""{name}_dots AS (
  SELECT q.k AS qk, c.k AS ck, sum(q.v * c.v) AS dot FROM {queries} q JOIN {corpus} c USING (bucket) GROUP BY ALL),
{name}_scored AS (
  SELECT q.k AS qid, c.k AS id, round(coalesce(d.dot, 0) / (q.n * c.n), 9) AS score
  FROM {queries}_norm q CROSS JOIN {corpus}_norm c LEFT JOIN {name}_dots d ON d.qk = q.k AND d.ck = c.k),
{name} AS (
  SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank, id, score
  FROM {name}_scored QUALIFY rank <= {k})"""


REQUESTS = """requests AS (
  SELECT u.conv_id || '-' || u.turn AS request_id,
         list({'role': h.role, 'content': h.text} ORDER BY h.turn) AS messages
  FROM conversations u JOIN conversations h ON h.conv_id = u.conv_id AND h.turn <= u.turn
  WHERE u.role = 'user' GROUP BY 1),
asked AS (
  SELECT request_id, messages[-1].content AS question, messages[1 : len(messages) - 1] AS history FROM requests)"""

# Requests with the latest messages that have so many words together, and the last one.
RECENT = f"""sized AS (
  SELECT conv_id, turn, role, text, sum(w) OVER (PARTITION BY conv_id ORDER BY turn) AS ends, ends - w AS starts
  FROM (SELECT *, greatest(1, len({words('text')})) AS w FROM conversations)),
asked AS (
  SELECT u.conv_id || '-' || u.turn AS request_id, any_value(u.text) AS question,
         coalesce(list({{'role': h.role, 'content': h.text}} ORDER BY h.turn) FILTER (h.turn IS NOT NULL), []) AS history
  FROM sized u LEFT JOIN sized h
    ON h.conv_id = u.conv_id AND h.turn < u.turn AND (h.ends = u.starts OR h.starts >= u.starts - {HISTORY_WORDS})
  WHERE u.role = 'user' GROUP BY 1)"""

CORPUS = ",\n".join([DOCS, chunks(), embedded("chunks", "id", "content", "cv")])
RETRIEVED = f"""{REQUESTS},
{CORPUS},
{embedded('asked', 'request_id', 'question', 'qv')},
{matches('qv', 'cv', 4)},
found AS (
  SELECT qid AS request_id, rank, id, url, content, score FROM matches JOIN chunks USING (id))"""
BENCHMARK = f"{CORPUS},\n{embedded('benchmark', 'item_id', 'text', 'qv')}"

JUDGED = f"""graded AS (SELECT doc_id, text, quality FROM documents JOIN labels USING (doc_id)),
{embedded('graded', 'doc_id', 'text', 'gv')},
class_size AS (SELECT quality, count(*) AS n FROM graded GROUP BY quality),
mean AS (
  SELECT quality AS k, bucket, sum(v) / any_value(n) AS v
  FROM gv JOIN graded ON gv.k = doc_id JOIN class_size USING (quality) GROUP BY ALL),
mean_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM mean GROUP BY k),
told AS (
  SELECT request_id, array_to_string(list_append(list_transform(history, lambda m: m.content), question), ' ') AS told FROM asked),
{embedded('told', 'request_id', 'told', 'jv')},
{matches('jv', 'mean', 1, 'nearest')},
judged AS (
  SELECT a.*, CASE n.id WHEN 1 THEN 'Yes.' WHEN 0 THEN 'No.' END AS verdict
  FROM asked a LEFT JOIN nearest n ON n.qid = a.request_id)"""

ROUTED = "routed AS (SELECT *, CASE WHEN lower(verdict) LIKE '%yes%' THEN 'answer' ELSE 'refuse' END AS route FROM judged)"
REFUSAL = text(prompts.REFUSAL.replace("{topic}", TOPIC))
LAST_MESSAGE = "question || CASE WHEN len(history) > 0 THEN ' ' || history[-1].content ELSE '' END"

VECTOR_ENTRIES = """
values_long AS (
  SELECT vec_id, label, unnest(range(64)) AS bucket, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
cv AS (SELECT vec_id AS k, bucket, v FROM values_long),
cv_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM cv GROUP BY k),
qv AS (SELECT CAST(label AS BIGINT) AS k, bucket, avg(v) AS v FROM values_long GROUP BY ALL),
qv_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM qv GROUP BY k)"""


def vector_matches(score: str, order: str) -> str:
    return f"""WITH {VECTOR_ENTRIES},
scored AS (
  SELECT q.k AS qid, c.k AS id, round({score}, 9) AS score FROM qv q JOIN cv c USING (bucket) GROUP BY ALL)
SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score {order}, id) AS rank, id, score
FROM scored QUALIFY rank <= 5"""


COSINE = f"WITH {VECTOR_ENTRIES},\n{matches('qv', 'cv', 5)}\nSELECT * FROM matches"
ENTRIES = "round(v, 6) AS weight"
EXTRACTED = "read AS (SELECT url, CASE WHEN content NOT LIKE '%###%' THEN content END AS content FROM docs)"
# The sentence of the context with most different words of the question.
READ = f"""sents AS (
  SELECT request_id, question, generate_subscripts(s, 1) AS pos, unnest(s) AS s
  FROM (SELECT request_id, question, {sentences('context')} AS s FROM asked JOIN g USING (request_id))),
best AS (
  SELECT request_id, first(s ORDER BY shared DESC, pos) AS s FROM (
    SELECT request_id, pos, s,
           len(list_filter(list_distinct({words('s')}), lambda w: list_contains({words('question')}, w))) AS shared FROM sents)
  GROUP BY request_id),
answers AS (SELECT request_id, array_to_string(({words('s')})[1 : {ANSWER_TOKENS}], ' ') AS answer FROM best)"""
UNKNOWN = "'I do not know.'"
GATHERED = r"""SELECT request_id, string_agg(content, E'\n\n' ORDER BY rank) AS context,
  string_agg(url, E'\n' ORDER BY rank) AS sources, first(content ORDER BY rank) AS top_content"""

ORACLE: dict[str, str] = {
    "drain_once": f"""WITH {DOCS}, {PAGES}
SELECT url, md5(content) AS content_md5 FROM docs UNION ALL SELECT url, md5(content) FROM web""",
    "ingest_stream": f"""WITH {DOCS}, {PAGES},
both_docs AS (SELECT * FROM docs UNION ALL SELECT * FROM web), {chunks('both_docs')}
SELECT '{NAMESPACE}' AS namespace, id,
       md5(CAST(to_json({{'content': content, 'url': url, 'id': id}}) AS VARCHAR)) AS metadata_md5
FROM chunks""",
    "merged_corpus": f"""WITH {DOCS}, {PAGES}
SELECT url, md5(content) AS content_md5 FROM docs UNION ALL SELECT url, md5(content) FROM web""",
    "chunk_ids": f"WITH {DOCS}, {chunks()} SELECT id, url, chunk_no FROM chunks",
    "vector_upsert": """
SELECT 'label-' || label AS namespace, CAST(vec_id AS VARCHAR) AS id,
       CAST(CASE WHEN label = 3 THEN embedding[-1] ELSE embedding[1] END AS DOUBLE) AS first_value,
       CASE WHEN label = 3 THEN 'revised ' ELSE '' END || 'vector ' || vec_id AS content
FROM embeddings WHERE label <> 7
UNION ALL
SELECT 'label-5', 'copy-' || vec_id, CAST(embedding[1] AS DOUBLE), 'vector ' || vec_id FROM embeddings
WHERE label = 5 AND vec_id % 10 <> 9""",
    "chunk_changes": f"""WITH
old_docs AS (SELECT source || '/' || doc_id AS url, text AS content FROM documents SEMI JOIN labels USING (doc_id)),
new_docs AS (
  SELECT source || '/' || doc_id AS url, regexp_replace(text, '[#*%]+', '', 'g') AS content
  FROM documents ANTI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)),
{chunks('old_docs', 'old_chunks')}, {chunks('new_docs', 'new_chunks')}
SELECT id, CASE WHEN o.url IS NULL THEN 'insert' WHEN n.url IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old_chunks o FULL JOIN new_chunks n USING (id) WHERE o.content IS DISTINCT FROM n.content""",
    "corpus_project": f"WITH {DOCS} SELECT url, length(content) AS n_chars FROM docs",
    "url_like": "SELECT page_id AS id, url FROM pages WHERE url LIKE '%/en/%' ORDER BY page_id LIMIT 10",
    "record_count": f"WITH {DOCS}, {chunks()} SELECT count(*) AS n_records FROM chunks",
    "vector_records": f"""WITH {CORPUS},
firsts AS (SELECT k, max(v) FILTER (bucket = 0) AS v FROM cv GROUP BY k)
SELECT id, '{NAMESPACE}' AS namespace, CAST(to_json({{'content': content, 'url': url, 'id': id}}) AS VARCHAR) AS metadata,
       64::BIGINT AS n_values, coalesce(v, 0) AS first_value, true AS no_sparse_values
FROM chunks JOIN firsts ON k = id""",
    "payload_json": f"""WITH {DOCS}, {chunks()}
SELECT id, CAST(to_json({{'content': content, 'url': url, 'id': id}}) AS VARCHAR) AS metadata FROM chunks""",
    "payload_lookup": f"WITH {DOCS}, {chunks()} SELECT id, url, content FROM chunks",
    "original_doc_json": f"""WITH {DOCS}
SELECT url, CAST(to_json({{'original_doc': content}}) AS VARCHAR) AS metadata FROM docs""",
    "embedding_dim": "SELECT CAST(len(embedding) AS BIGINT) AS dim, count(*) AS n_vectors FROM embeddings GROUP BY 1",
    "latest_version": """
SELECT conv_id, greatest(1, coalesce(max(turn) FILTER (role = 'assistant'), 1)) AS latest_version,
       max_by(text, turn) FILTER (role = 'assistant') AS text
FROM conversations GROUP BY conv_id""",
    "html_text": f"WITH {PAGES} SELECT url, content FROM web",
    "extract_documents": f"""WITH {DOCS}, {EXTRACTED}
SELECT url, md5(content) AS text_md5, CASE WHEN content IS NULL THEN 'ValueError: junk mark' END AS error FROM read""",
    "chunk_drop_failed": f"""WITH {DOCS}, {EXTRACTED}, {chunks('read')}
SELECT url, count(*) AS n_chunks FROM chunks GROUP BY url""",
    "chunk_window": f"WITH {DOCS}, {chunks()} SELECT url, chunk_no, content FROM chunks",
    "chunk_sentences": f"""WITH RECURSIVE {DOCS},
sents AS (
  SELECT url, generate_subscripts(s, 1) AS pos, unnest(s) AS s
  FROM (SELECT url, {sentences('content')} AS s FROM docs)),
cuts AS (
  SELECT url, pos, cut, w[500 * cut + 1 : 500 * cut + 500] AS w
  FROM (SELECT url, pos, w, unnest(range(CAST(ceil(len(w) / 500.0) AS BIGINT))) AS cut
        FROM (SELECT url, pos, {words('s')} AS w FROM sents))),
counted AS (
  SELECT url, row_number() OVER (PARTITION BY url ORDER BY pos, cut) - 1 AS i, len(w) AS n, array_to_string(w, ' ') AS s
  FROM cuts),
piece AS MATERIALIZED (
  SELECT *, sum(n) OVER (PARTITION BY url ORDER BY i) AS upto, upto - n AS before FROM counted),
lead AS MATERIALIZED (
  SELECT p.url, p.i, count(b.i) AS lead
  FROM piece p LEFT JOIN piece b
    ON b.url = p.url AND b.i < p.i AND b.i >= p.i - 10 AND p.before - b.before <= least(10, 500 - p.n)
  GROUP BY ALL),
fold AS (
  SELECT url, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS start, CAST(NULL AS BIGINT) AS closed FROM piece WHERE i = 0
  UNION ALL
  SELECT f.url, p.i, CASE WHEN p.upto - s.before > 500 THEN greatest(f.start, p.i - l.lead) ELSE f.start END,
         CASE WHEN p.upto - s.before > 500 THEN f.start END
  FROM fold f JOIN piece p ON p.url = f.url AND p.i = f.i + 1
  JOIN lead l ON l.url = p.url AND l.i = p.i JOIN piece s ON s.url = f.url AND s.i = f.start),
bounds AS (
  SELECT url, closed AS first, i - 1 AS last FROM fold WHERE closed IS NOT NULL
  UNION ALL SELECT url, max_by(start, i), max(i) FROM fold GROUP BY url)
SELECT b.url, row_number() OVER (PARTITION BY b.url ORDER BY b.first, b.last) - 1 AS chunk_no, b.content FROM (
  SELECT b.url, b.first, b.last, string_agg(p.s, ' ' ORDER BY p.i) AS content
  FROM bounds b JOIN piece p ON p.url = b.url AND p.i BETWEEN b.first AND b.last GROUP BY ALL) b""",
    "chunk_splitter": f"""WITH {DOCS},
lines AS (
  SELECT url, list_filter(string_split(content, E'\\n'), lambda x: regexp_matches(x, '[^ \\t\\r\\f]')) AS l FROM docs)
SELECT url, unnest(range(len(l))) AS chunk_no, unnest(l) AS content FROM lines""",
    "boilerplate_lines": f"""WITH {DOCS},
lines AS (SELECT DISTINCT url, trim(unnest(string_split_regex(content, '\\r?\\n'))) AS line FROM docs)
SELECT line, count(*) AS n_docs FROM lines WHERE line <> '' GROUP BY line HAVING count(*) >= {MIN_DOCS}""",
    "boilerplate_removed": f"""WITH {DOCS},
lines AS (
  SELECT url, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT url, string_split_regex(content, '\\r?\\n') AS l FROM docs)),
common AS (
  SELECT trim(line) AS line FROM lines WHERE trim(line) <> '' GROUP BY trim(line) HAVING count(DISTINCT url) >= {MIN_DOCS}),
cleaned AS (
  SELECT url, string_agg(line, E'\\n' ORDER BY pos) AS content
  FROM lines WHERE trim(line) NOT IN (SELECT line FROM common) GROUP BY url),
touched AS (SELECT DISTINCT url FROM lines WHERE trim(line) IN (SELECT line FROM common))
SELECT d.url, md5(CASE WHEN t.url IS NULL THEN d.content ELSE coalesce(c.content, '') END) AS content_md5
FROM docs d LEFT JOIN touched t USING (url) LEFT JOIN cleaned c USING (url)""",
    "context_budget": f"""WITH {RETRIEVED},
sized AS (SELECT request_id, rank, len({words('content')}) AS n_tokens FROM found)
SELECT request_id, rank, n_tokens,
       CAST(sum(n_tokens) OVER (PARTITION BY request_id ORDER BY rank) AS BIGINT) AS used_tokens
FROM sized QUALIFY used_tokens <= {BUDGET}""",
    "hash_embed": f"WITH {CORPUS} SELECT k AS id, bucket, {ENTRIES} FROM cv",
    "embed_batches": f"WITH {CORPUS} SELECT k AS id, bucket, {ENTRIES} FROM cv",
    "embed_query": f"""WITH {embedded('benchmark', 'item_id', 'text', 'qv')}
SELECT k AS item_id, bucket, {ENTRIES} FROM qv""",
    "topk_single": f"""WITH {CORPUS}, one AS (SELECT 1 AS k, {text(QUESTION)} AS question),
{embedded('one', 'k', 'question', 'qv')},
{matches('qv', 'cv', 5)}
SELECT id, url, score FROM matches JOIN chunks USING (id)""",
    "topk_batch": COSINE,
    "topk_blocks": COSINE,
    "topk_ivf": COSINE,
    "ivf_recall": """
SELECT 5 * count(DISTINCT label) AS n_matches, true AS recall_reached,
       10 * count(DISTINCT label) <= count(*) / 4.0 AS a_quarter_read_at_most FROM embeddings""",
    "topk_dot": vector_matches("sum(q.v * c.v)", "DESC"),
    "topk_l2": vector_matches("sqrt(sum((q.v - c.v) * (q.v - c.v)))", "ASC"),
    "topk_namespace": f"""WITH {VECTOR_ENTRIES},
nv AS (SELECT vec_id AS k, bucket, v FROM values_long WHERE label = 3),
nv_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM nv GROUP BY k),
{matches('qv', 'nv', 5)}
SELECT * FROM matches""",
    "topk_with_payload": f"""WITH {BENCHMARK}, {matches('qv', 'cv', 5)}
SELECT qid, rank, url, content, score, 64::BIGINT AS n_values FROM matches JOIN chunks USING (id)""",
    "text_search": f"""WITH {BENCHMARK}, {matches('qv', 'cv', 3)}
SELECT qid, rank, url, score FROM matches JOIN chunks USING (id)""",
    "topk_two_namespaces": f"""WITH values_long AS (
  SELECT vec_id, label, unnest(range(64)) AS bucket, unnest(CAST(embedding AS DOUBLE[])) AS v FROM embeddings),
cv AS (
  SELECT vec_id || chr(1) || 'plain' AS k, bucket, v FROM values_long
  UNION ALL SELECT vec_id || chr(1) || 'turned', 63 - bucket, v FROM values_long),
cv_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM cv GROUP BY k),
qv AS (SELECT CAST(label AS BIGINT) AS k, bucket, avg(v) AS v FROM values_long GROUP BY ALL),
qv_norm AS (SELECT k, sqrt(sum(v * v)) AS n FROM qv GROUP BY k),
{matches('qv', 'cv', 5)}
SELECT qid, rank, string_split(id, chr(1))[2] AS namespace, string_split(id, chr(1))[1] AS id,
       CASE WHEN id LIKE '%turned' THEN 'turned ' ELSE '' END || 'vector ' || string_split(id, chr(1))[1] AS content, score
FROM matches""",
    "retrieve": f"WITH {RETRIEVED} SELECT request_id, rank, url, score FROM found",
    "assemble_messages": """
SELECT conv_id, CAST(to_json(list({'role': role, 'content': text} ORDER BY turn)) AS VARCHAR) AS messages
FROM conversations GROUP BY conv_id""",
    "late_turns": """
SELECT conv_id, turn, 'history_too_long' AS reason FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 5""",
    "extract_question": f"WITH {REQUESTS} SELECT request_id, question FROM asked",
    "extract_history": f"""WITH {REQUESTS}
SELECT request_id, len(history) AS n_messages, CAST(to_json(history) AS VARCHAR) AS history FROM asked""",
    "validate_requests": f"""WITH {RECENT}
SELECT request_id, CASE WHEN len(history) = 0 THEN 'empty_messages' ELSE 'ok' END AS outcome, len(history) AS n_messages FROM asked""",
    "render_prompt": "WITH "
    + REQUESTS
    + ", s AS (SELECT request_id, question, CAST(to_json(history) AS VARCHAR) AS chat_history FROM asked) "
    + "SELECT request_id, "
    + ", ".join(
        render(t, question="question", chat_history="chat_history", topic=text(TOPIC), context="question") + f" AS {n}"
        for n, t in [
            ("plain", prompts.PLAIN),
            ("with_history", prompts.WITH_HISTORY),
            ("relevance", prompts.RELEVANCE),
            ("search_query", prompts.SEARCH_QUERY),
            ("with_context", prompts.WITH_CONTEXT),
        ]
    )
    + " FROM s",
    "generate_answers": f"""WITH {REQUESTS},
p AS (SELECT request_id, {render(prompts.PLAIN, question='question')} AS prompt FROM asked)
SELECT request_id, array_to_string(({words("string_split(prompt, chr(10))[-1]")})[1 : {PLAIN_ANSWER_TOKENS}], ' ') AS answer
FROM p""",
    "relevance_check": f"WITH {RECENT}, {JUDGED} SELECT request_id, verdict FROM judged",
    "centroid_classify": f"""WITH {VECTOR_ENTRIES}, {matches('cv', 'qv', 1)}
SELECT vec_id AS id, label, CAST(m.id AS INTEGER) AS predicted FROM embeddings LEFT JOIN matches m ON m.qid = vec_id""",
    "route_requests": f"""WITH {RECENT}, {JUDGED}, {ROUTED}
SELECT request_id, CASE WHEN route = 'refuse' THEN {REFUSAL} END AS result,
       CASE WHEN route = 'refuse' THEN 0::BIGINT END AS n_sources FROM routed""",
    "rewrite_query": f"WITH {REQUESTS} SELECT request_id, {LAST_MESSAGE} AS query FROM asked",
    "format_context": f"""WITH {RETRIEVED}, g AS ({GATHERED} FROM found GROUP BY request_id)
SELECT request_id, md5(context) AS context_md5, length(context) AS n_chars FROM g""",
    "source_urls": f"""WITH {RETRIEVED}, g AS ({GATHERED} FROM found GROUP BY request_id)
SELECT request_id, sources FROM g""",
    "answer_relevant": f"""WITH {RECENT}, {CORPUS},
rewritten AS (SELECT request_id, {LAST_MESSAGE} AS query FROM asked),
{embedded('rewritten', 'request_id', 'query', 'qv')},
{matches('qv', 'cv', 4)},
found AS (SELECT qid AS request_id, rank, url, content FROM matches JOIN chunks USING (id)),
g AS ({GATHERED} FROM found GROUP BY request_id), {READ}
SELECT request_id, coalesce(answer, {UNKNOWN}) AS result, coalesce(sources, '') AS sources
FROM asked LEFT JOIN g USING (request_id) LEFT JOIN answers USING (request_id)""",
    "rag_answers": f"""WITH {RECENT}, {JUDGED}, {ROUTED}, {DOCS}, {PAGES},
both_docs AS (SELECT * FROM docs UNION ALL SELECT * FROM web),
{chunks('both_docs')}, {embedded('chunks', 'id', 'content', 'cv')},
rewritten AS (SELECT request_id, {LAST_MESSAGE} AS query FROM routed WHERE route = 'answer'),
{embedded('rewritten', 'request_id', 'query', 'qv')},
{matches('qv', 'cv', 4)},
found AS (SELECT qid AS request_id, rank, url, content FROM matches JOIN chunks USING (id)),
g AS ({GATHERED} FROM found GROUP BY request_id), {READ}
SELECT request_id, CASE WHEN route = 'answer' THEN coalesce(answer, {UNKNOWN}) ELSE {REFUSAL} END AS result,
       CASE WHEN route = 'answer' THEN coalesce(sources, '') ELSE '' END AS sources, CAST(NULL AS VARCHAR) AS reason
FROM routed LEFT JOIN g USING (request_id) LEFT JOIN answers USING (request_id)""",
}
