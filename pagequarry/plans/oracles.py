"""SQL that gives the same rows as each query, for DuckDB on the same tables."""

from __future__ import annotations

from pagequarry.functions.html import (
    ASSISTANT_OPEN,
    MESSAGE_CLOSE,
    SOURCES_CLOSE,
    SOURCES_OPEN,
    USER_OPEN,
)
from pagequarry.functions.text import EMPTY_QUESTION
from pagequarry.operators.answer import DETAILS_PREFIX, NAMES_PREFIX, PAGES_PREFIX

# Fixed values, written out again so that the SQL checks those of the operators.
NOT_TEXT = "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<!doctype[^>]*>"
BLOCK_TAG = (
    "(?i)<(/?)(html|head|title|body|nav|header|footer|article|section|aside|main|div"
    "|ul|ol|li|table|tr|td|th|blockquote|pre|p|h1|h2|h3|h4|h5|h6)\\b[^>]*>"
)
INLINE_BREAK = "(?i)<br\\b[^>]*>"
ANY_TAG = "<[^>]*>"
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]

# The folder the queries are checked on; SQL can list files by path only.
FOLDER = "/root/testdata/sf0.01"


def lit(value: str) -> str:
    """SQL string literal; control characters are spelled with chr()."""
    for code in (1, 2, 9, 10, 13):
        value = value.replace(chr(code), f"' || chr({code}) || '")
    return f"('{value}')"


def escaped(value: str) -> str:
    return lit(value.replace("'", "''"))


WS = "[ ' || chr(9) || chr(13) || chr(10) || ']"
NOT_WS = "[^ ' || chr(9) || chr(13) || chr(10) || ']"
BLANKS = "' ' || chr(9) || chr(13) || chr(10)"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda w: w <> '')"


def clean(text: str, newline: str = "") -> str:
    return f"regexp_replace(replace({text}, chr(10), '{newline}'), ' ?\\.', '.', 'g')"


def hash_id(*key: str) -> str:
    joined = ", ".join(f"{k}::VARCHAR" for k in key)
    return f"('0x' || substr(md5(concat_ws('|', {joined})), 1, 15))::BIGINT"


def basename(url: str) -> str:
    return f"split_part({url}, '/', -1)"


# -- shared tables -----------------------------------------------------------------


def _element_text() -> str:
    text = "split_part(part, chr(2), -1)"
    text = f"regexp_replace({text}, {escaped(INLINE_BREAK)}, chr(10), 'g')"
    text = f"regexp_replace({text}, {escaped(ANY_TAG)}, '', 'g')"
    for name, char in ENTITIES:
        text = f"replace({text}, {escaped(name)}, {escaped(char)})"
    return f"trim({text}, {BLANKS})"


ELEMENTS = rf"""
raw AS (
  SELECT page_id, url, string_split(regexp_replace(
      regexp_replace(html, {escaped(NOT_TEXT)}, '', 'g'),
      {escaped(BLOCK_TAG)}, chr(1) || '\1\2' || chr(2), 'g'), chr(1)) AS parts
  FROM pages),
marked AS (
  SELECT page_id, url, unnest(parts) AS part, generate_subscripts(parts, 1) AS ix FROM raw),
typed AS (
  SELECT page_id, url, ix, {_element_text()} AS text,
    lower(regexp_extract(part, '^([^/' || chr(2) || ']+)' || chr(2), 1)) AS tag
  FROM marked),
elements AS (
  SELECT page_id, url, (row_number() OVER (PARTITION BY page_id ORDER BY ix) - 1)::INTEGER AS pos,
    CASE WHEN regexp_matches(tag, '^(title|h[1-6])$') THEN 'Title'
         WHEN tag = 'li' THEN 'ListItem' WHEN tag = 'p' THEN 'NarrativeText'
         ELSE 'Text' END AS type,
    text, 1 AS page_number, tag
  FROM typed WHERE text <> '')"""

PAGE_TEXTS = f"""{ELEMENTS},
texts AS (
  SELECT p.page_id, any_value(p.url) AS url,
    coalesce(string_agg({clean('e.text')}, chr(10) ORDER BY e.pos), '') AS text
  FROM pages p LEFT JOIN elements e ON e.page_id = p.page_id GROUP BY p.page_id)"""


def stride(source: str, *keys: str, size: int = 100, overlap: int = 10) -> str:
    named = ", ".join(keys)
    return f"""
worded AS (SELECT {named}, {words('text')} AS w FROM {source}),
starts AS (
  SELECT {named}, w, unnest(range(0, greatest(len(w) - {overlap} - 1, 0) + 1, {size - overlap})) AS s
  FROM worded WHERE len(w) > 0),
chunks AS (
  SELECT {named}, (s // {size - overlap})::INTEGER AS chunk_ix,
    array_to_string(list_slice(w, s + 1, s + {size}), ' ') AS content,
    least(len(w) - s, {size})::INTEGER AS n_units
  FROM starts)"""


DOCUMENT_CHUNKS = f"WITH {stride('documents', 'doc_id')}"
PAGE_CHUNKS = f"WITH {PAGE_TEXTS}, {stride('texts', 'page_id', 'url')}"


def hashed(source: str, text: str, *keys: str, prefix: str) -> str:
    """Hashed word counts of a text, scaled to length 1, as (keys, bucket, weight)."""
    named = ", ".join(keys)
    return f"""
{prefix}_tokens AS (SELECT {named}, unnest({words(text)}) AS token FROM {source}),
{prefix}_counts AS (
  SELECT {named}, ('0x' || substr(md5(token), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n
  FROM {prefix}_tokens GROUP BY ALL),
{prefix}_weights AS (
  SELECT {named}, bucket,
    (n / sqrt(sum(n * n) OVER (PARTITION BY {named})::DOUBLE))::FLOAT AS weight
  FROM {prefix}_counts)"""


def hits(distance: str, id: str) -> str:
    return f"""{PAGE_CHUNKS},
chunk_rows AS (
  SELECT {id} AS id, url, content, page_id AS page FROM chunks),
questions AS (SELECT item_id AS qid, text AS question FROM benchmark),
{hashed('chunk_rows', 'content', 'id', prefix='c')},
{hashed('questions', 'question', 'qid', prefix='q')},
dots AS (
  SELECT qid, id, sum(q.weight::DOUBLE * c.weight::DOUBLE) AS dot
  FROM q_weights q JOIN c_weights c ON q.bucket = c.bucket GROUP BY qid, id),
q_norms AS (SELECT qid, sum(weight::DOUBLE * weight::DOUBLE) AS n FROM q_weights GROUP BY qid),
c_norms AS (SELECT id, sum(weight::DOUBLE * weight::DOUBLE) AS n FROM c_weights GROUP BY id),
distances AS (
  SELECT q.qid, c.id, round({distance}, 9) AS dist
  FROM q_norms q CROSS JOIN c_norms c LEFT JOIN dots d ON d.qid = q.qid AND d.id = c.id),
ranked AS (
  SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rank FROM distances),
hits AS (
  SELECT qid, rank, id, url, content, page
  FROM ranked JOIN chunk_rows USING (id) WHERE rank <= 4)"""


HITS = hits("q.n + c.n - 2 * coalesce(d.dot, 0)", hash_id("page_id", "chunk_ix"))
COSINE_HITS = hits(
    "1 - coalesce(d.dot, 0) / (sqrt(q.n) * sqrt(c.n))", f"{hash_id('url', 'chunk_ix')}::VARCHAR"
)

SOURCES = """
first_source AS (SELECT qid, url, min(rank) AS rank FROM hits GROUP BY qid, url),
sources AS (
  SELECT qid, string_agg(url, ',' ORDER BY rank) AS sources,
    string_agg('<li><a href="' || url || '">' || url || '</a></li>', chr(10) ORDER BY rank) AS links,
    list(url ORDER BY rank) AS listed
  FROM first_source GROUP BY qid)"""

ANSWERS = rf"""{HITS}, {SOURCES},
first_sentence AS (
  SELECT qid, regexp_extract(content, '(?s)^(.*?[.!?])(?:{WS}|$)', 1) AS s, content
  FROM hits WHERE rank = 1),
answers AS (
  SELECT q.qid, q.question, sources, links, listed,
    array_to_string(list_slice({words("CASE WHEN s = '' THEN content ELSE s END")}, 1, 256), ' ') AS result
  FROM questions q JOIN first_sentence USING (qid) JOIN sources USING (qid))"""


def topk(k: int, distance: str) -> str:
    return f"""
WITH corpus AS (
  SELECT vec_id AS id,
    list_transform(embedding, lambda x: (x::DOUBLE * (1 + label / 10))::FLOAT)::DOUBLE[] AS x
  FROM embeddings),
asked AS (SELECT vec_id AS qid, embedding::DOUBLE[] AS q FROM embeddings),
distances AS (SELECT qid, id, round({distance}, 9) AS dist FROM asked CROSS JOIN corpus),
ranked AS (
  SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY dist, id)::INTEGER AS rank, id, dist
  FROM distances)
SELECT qid, rank, id, round(dist, 6) + 0.0 AS dist FROM ranked WHERE rank <= {k}"""


L2 = "list_sum(list_transform(list_zip(q, x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
IP = "1 - list_dot_product(q, x)"
COSINE = "1 - list_dot_product(q, x) / (sqrt(list_dot_product(q, q)) * sqrt(list_dot_product(x, x)))"


def packed(pieces: str, size: int, overlap: int) -> str:
    """Pieces (doc_id, run, o, piece, n), in the order of ``o``, packed into chunks.

    From each first piece follows the last one that fits, and from that the first
    piece of the next chunk; the recursion follows these two steps.
    """
    return f"""
WITH RECURSIVE {pieces},
numbered AS (
  SELECT doc_id, run, piece, n, row_number() OVER w AS i, sum(n) OVER w AS upto,
    lead(n) OVER (PARTITION BY doc_id, run ORDER BY o) AS n_next
  FROM pieces WINDOW w AS (PARTITION BY doc_id, run ORDER BY o
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
reach AS (
  SELECT *, upto * 1000000 + i AS last_key, (upto - n) * 1000000 + i AS first_key,
    (upto - n + {size}) * 1000000 + 999999 AS end_key,
    greatest(upto - {overlap}, upto + n_next - {size}) * 1000000 AS next_key
  FROM numbered),
ends AS MATERIALIZED (
  SELECT a.doc_id, a.run, a.i AS s, b.i AS e
  FROM reach a ASOF JOIN reach b
    ON b.doc_id = a.doc_id AND b.run = a.run AND a.end_key >= b.last_key),
follows AS MATERIALIZED (
  SELECT z.doc_id, z.run, z.i AS e, a.i AS s
  FROM (FROM reach WHERE n_next IS NOT NULL) z ASOF JOIN reach a
    ON a.doc_id = z.doc_id AND a.run = z.run AND z.next_key <= a.first_key),
spans AS (
  SELECT doc_id, run, s, e FROM ends WHERE s = 1
  UNION ALL
  SELECT p.doc_id, p.run, f.s, x.e
  FROM spans p
  JOIN follows f ON f.doc_id = p.doc_id AND f.run = p.run AND f.e = p.e
  JOIN ends x ON x.doc_id = p.doc_id AND x.run = p.run AND x.s = f.s),
joined AS (
  SELECT p.doc_id, p.run, p.s, trim(string_agg(piece, '' ORDER BY i), {BLANKS}) AS content,
    sum(n)::INTEGER AS n_units
  FROM spans p JOIN numbered b
    ON b.doc_id = p.doc_id AND b.run = p.run AND b.i BETWEEN p.s AND p.e
  GROUP BY ALL)
SELECT doc_id, content, n_units,
  (row_number() OVER (PARTITION BY doc_id ORDER BY run, s) - 1)::INTEGER AS chunk_ix
FROM joined WHERE content <> ''"""


def cut(source: str, pattern: str) -> str:
    """Longer pieces cut up by a pattern; ``o`` is the list of positions at each level."""
    return f"""
  SELECT doc_id, list_append(o, ix) AS o, piece, len({words('piece')}) AS n
  FROM (SELECT doc_id, o, unnest(regexp_extract_all(piece, {pattern})) AS piece,
          generate_subscripts(regexp_extract_all(piece, {pattern}), 1) AS ix
        FROM {source} WHERE n > 500)"""


# Whole texts, then sentences, phrases and words. No text has a paragraph break.
SENTENCE_PIECES = f"""
whole AS (
  SELECT doc_id, [0::BIGINT] AS o, text AS piece, len({words('text')}) AS n
  FROM documents WHERE text <> ''),
sentences AS ({cut('whole', f"'(?s).+?(?:[.!?]{WS}+|$)'")}),
phrases AS ({cut('sentences', f"'(?s).+?(?:[,;:]{WS}+|$)'")}),
single AS ({cut('phrases', f"'{NOT_WS}*{WS}+|{NOT_WS}+'")}),
pieces AS (
  SELECT doc_id, 0 AS run, o, piece, n FROM (
    FROM whole UNION ALL FROM sentences UNION ALL FROM phrases UNION ALL FROM single)
  WHERE n <= 500)"""

# Lines, then words; a text without line breaks is cut at spaces at once. No text has
# a blank line, and no word 1000 characters.
def character_pieces(source: str) -> str:
    return f"""
split AS (
  SELECT doc_id, sep, string_split(text, sep) AS parts FROM (
    SELECT doc_id, text, CASE WHEN contains(text, chr(10)) THEN chr(10) ELSE ' ' END AS sep
    FROM {source})),
outer_pieces AS (
  SELECT doc_id, ix, CASE WHEN ix > 1 THEN sep || part ELSE part END AS piece,
    sep = chr(10) AND length(part) + (ix > 1)::INTEGER >= 1000 AS long
  FROM (SELECT doc_id, sep, unnest(parts) AS part, generate_subscripts(parts, 1) AS ix FROM split)),
placed AS (
  SELECT *, 2 * coalesce(sum(long::INTEGER) OVER (
      PARTITION BY doc_id ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + long::INTEGER AS run
  FROM outer_pieces WHERE piece <> ''),
inner_pieces AS (
  SELECT doc_id, run, unnest(string_split(piece, ' ')) AS part,
    generate_subscripts(string_split(piece, ' '), 1) AS ix
  FROM placed WHERE long),
pieces AS (
  SELECT doc_id, run, ix AS o, piece, length(piece) AS n FROM placed WHERE NOT long
  UNION ALL
  SELECT doc_id, run, o, piece, length(piece) FROM (
    SELECT doc_id, run, ix AS o, CASE WHEN ix > 1 THEN ' ' || part ELSE part END AS piece
    FROM inner_pieces)
  WHERE piece <> '')"""

OLD_AND_NEW = f"""
old AS (SELECT doc_id, text FROM documents WHERE lang <> 'de'),
new AS (
  SELECT doc_id, CASE WHEN lang = 'fr' THEN {clean('text')} ELSE text END AS text
  FROM documents WHERE lang <> 'es'),
changed AS (
  SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
    CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
         ELSE 'update' END AS change,
    n.text
  FROM old o FULL JOIN new n ON o.doc_id = n.doc_id
  WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text IS DISTINCT FROM n.text)"""


def prompt_sql() -> str:
    return f"""{HITS}
SELECT q.qid,
  coalesce(string_agg(content, chr(10) || chr(10) ORDER BY rank), '') || chr(10) || chr(10)
    || 'Question: ' || any_value(question) || chr(10) || 'Answer:' AS prompt
FROM questions q LEFT JOIN hits USING (qid) GROUP BY q.qid"""


def summed(prefix: str, value: str, sep: str) -> str:
    return (
        f"{escaped(prefix)} || array_to_string("
        f"list_sort(list(DISTINCT {value}::VARCHAR)), {escaped(sep)})"
    )


def cosine(a: str, b: str) -> str:
    return f"list_dot_product({a}, {b}) / sqrt(list_dot_product({a}, {a}) * list_dot_product({b}, {b}))"


def marginal(k: int, fetch_k: int, balance: float) -> str:
    """The nearest rows, then one after the other the best of those not taken yet."""
    nearest = topk(fetch_k, L2).replace("WITH corpus", "WITH RECURSIVE corpus", 1)
    return f"""{nearest.rpartition('SELECT qid, rank')[0].rstrip()},
candidates AS (
  SELECT r.qid, r.rank, r.id, r.dist, c.x, round({cosine('a.q', 'c.x')}, 9) AS likeness
  FROM ranked r JOIN corpus c ON c.id = r.id JOIN asked a ON a.qid = r.qid WHERE r.rank <= {fetch_k}),
pairs AS (
  SELECT a.qid, a.id AS one, b.id AS other, round({cosine('a.x', 'b.x')}, 9) AS likeness
  FROM candidates a JOIN candidates b ON a.qid = b.qid AND a.id <> b.id),
taken AS (
  SELECT qid, 1 AS step, [id] AS ids FROM (
    SELECT qid, id, row_number() OVER (PARTITION BY qid ORDER BY likeness DESC, rank) AS n FROM candidates)
  WHERE n = 1
  UNION ALL
  SELECT qid, step + 1, list_append(ids, id) FROM (
    SELECT qid, step, ids, id, row_number() OVER (PARTITION BY qid ORDER BY gain DESC, rank) AS n
    FROM (
      SELECT t.qid, t.step, t.ids, c.id, c.rank,
        round({balance} * c.likeness - (1 - {balance}) * max(p.likeness), 9) AS gain
      FROM taken t JOIN candidates c ON c.qid = t.qid AND NOT list_contains(t.ids, c.id)
        JOIN pairs p ON p.qid = t.qid AND p.one = c.id AND list_contains(t.ids, p.other)
      WHERE t.step < {k} GROUP BY t.qid, t.step, t.ids, c.id, c.rank, c.likeness))
  WHERE n = 1)
SELECT t.qid, t.step::INTEGER AS rank, t.ids[t.step] AS id, round(c.dist, 6) + 0.0 AS dist
FROM taken t JOIN candidates c ON c.qid = t.qid AND c.id = t.ids[t.step]"""


PAGE_WORDS = f"WITH {PAGE_TEXTS}, worded AS (SELECT page_id, {words('text')} AS w FROM texts)"


def some(first: int, last: int) -> str:
    """Words of a sheet, joined; the first word is number 1."""
    return f"array_to_string(list_slice(w, s + {first}, s + {last}), ' ')"


def cell(nth: int, spans: str = "") -> str:
    shown = some(nth, nth)
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        shown = f"replace({shown}, '{old}', '{new}')"
    return f"'<td{spans}>' || {shown} || '</td>'"


def row(*cells: str) -> str:
    return " || ".join(["'<tr>'", *cells, "'</tr>'"])


# A sheet has 5 words of title, two columns of 120, and 6 cells.
SHEETS = f"""{PAGE_WORDS},
sheets AS (SELECT page_id, w, unnest(range(0, len(w), 251)) AS s FROM worded),
parts AS (
  SELECT page_id, s, 1 AS part, {some(1, 5)} AS text, NULL AS shown FROM sheets
  UNION ALL SELECT page_id, s, 2, {some(6, 125)}, NULL FROM sheets
  UNION ALL SELECT page_id, s, 3, {some(126, 245)}, NULL FROM sheets
  UNION ALL SELECT page_id, s, 4, {some(246, 251)}, '<table>'
    || {row(cell(246, ' colspan="3"'))}
    || {row(cell(247, ' rowspan="2"'), cell(248), cell(249))}
    || {row(cell(250), cell(251))} || '</table>' FROM sheets)
SELECT page_id, (s // 251 + 1)::INTEGER AS page_number,
  (row_number() OVER (PARTITION BY page_id ORDER BY s, part) - 1)::INTEGER AS pos,
  text, shown AS "table"
FROM parts WHERE text <> ''"""

ORACLES: dict[str, str] = {
    "list_documents": f"""
SELECT {basename('filename')} AS name, size AS length FROM read_blob('{FOLDER}/*.parquet')""",
    "scan_documents_glob": f"""
SELECT {basename('filename')} AS name, size AS length, md5(content) AS digest
FROM read_blob('{FOLDER}/*s.parquet')""",
    "stream_ingest_files": f"""
SELECT {basename('filename')} AS name, size AS length, md5(content) AS digest
FROM read_blob('{FOLDER}/*.parquet')""",
    "stream_chunk_embed": f"""{PAGE_CHUNKS}
SELECT {hash_id('url', 'chunk_ix')} AS id, url, content, 64 AS dim FROM chunks""",
    "table_preview": "SELECT * FROM documents",
    "page_image_map": """
SELECT regexp_extract(url, '/(\\d+)(/|\\.html)?([?#].*)?$', 1)::INTEGER AS pdf_page, url AS page_image_loc
FROM pages WHERE regexp_matches(url, '/\\d+(/|\\.html)?([?#].*)?$')""",
    "chunk_ids_hash": f"""{DOCUMENT_CHUNKS}
SELECT {hash_id('doc_id', 'chunk_ix')} AS id, doc_id, chunk_ix FROM chunks""",
    "chunk_ids_dense": f"""{DOCUMENT_CHUNKS}
SELECT doc_id, chunk_ix, row_number() OVER (ORDER BY doc_id, chunk_ix) AS id FROM chunks""",
    "snapshot_changes": f"WITH {OLD_AND_NEW} SELECT doc_id, change, text FROM changed",
    "apply_changes": f"""
WITH {OLD_AND_NEW},
versions AS (
  SELECT doc_id, change, text, 1 AS version FROM changed
  UNION ALL
  SELECT doc_id, CASE WHEN toxic = 1 THEN 'delete' ELSE 'update' END,
    'quality ' || quality::VARCHAR, 2 FROM labels),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) AS r FROM versions)
SELECT doc_id, text FROM old WHERE doc_id NOT IN (SELECT doc_id FROM latest)
UNION ALL
SELECT doc_id, text FROM latest WHERE r = 1 AND change <> 'delete'""",
    "index_build": f"""{PAGE_CHUNKS}
SELECT {hash_id('url', 'chunk_ix')}::VARCHAR AS id, url AS uri, content AS document, 64 AS dim
FROM chunks""",
    "sync_collection": """
SELECT doc_id::VARCHAR AS id, source AS uri,
  CASE lang WHEN 'fr' THEN 'again ' || text ELSE text END AS document
FROM documents WHERE lang <> 'de'""",
    "collection_search": f"""{COSINE_HITS}
SELECT qid, rank::INTEGER AS rank, url, content FROM hits WHERE rank <= 2""",
    "stream_answers": f"""{ANSWERS}
SELECT qid::VARCHAR AS request_id, question, result AS answer, sources FROM answers""",
    "inference_log": f"""{ANSWERS}
SELECT qid::VARCHAR AS request_id, question, result AS answer, sources FROM answers""",
    "log_to_json": f"""{ANSWERS}
SELECT qid::VARCHAR AS request_id, question,
  to_json(struct_pack(messages := [struct_pack(role := 'user', content := question)]))::VARCHAR AS request,
  to_json(struct_pack(result := result, sources := listed))::VARCHAR AS response
FROM answers""",
    "chunk_projection": f"{PAGE_CHUNKS} SELECT url, content FROM chunks",
    "exclude_by_name": f"""
SELECT page_id, {basename('url')} AS name FROM pages WHERE NOT contains({basename('url')}, 'ref=')""",
    "url_basename": f"SELECT page_id, {basename('url')} AS name FROM pages",
    "question_guard": f"""
WITH asked AS (
  SELECT item_id, unnest([0, 1, 2])::INTEGER AS variant,
    unnest([text, regexp_replace(text, '{NOT_WS}', '', 'g'), '  ']) AS question
  FROM benchmark)
SELECT item_id, variant,
  CASE WHEN regexp_full_match(question, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]*')
       THEN {escaped(EMPTY_QUESTION)} ELSE question END AS reply
FROM asked""",
    "json_field": """
WITH events AS (
  SELECT event_id, CASE event_id % 3
    WHEN 0 THEN replace(props, '}', ', "ready": "yes"}')
    WHEN 1 THEN replace(props, '}', ', "error_code": 7}') ELSE props END AS props
  FROM events)
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k,
  json_extract_string(props, '$.ready') AS ready, json_exists(props, '$.error_code') AS has_error
FROM events""",
    "limit_questions": """
(SELECT 50 AS n, text AS question FROM benchmark ORDER BY item_id LIMIT 50)
UNION ALL (SELECT 7 AS n, text AS question FROM benchmark ORDER BY item_id LIMIT 7)""",
    "parse_elements": f"WITH {ELEMENTS} SELECT * EXCLUDE url FROM elements",
    "element_slice": f"""
WITH {ELEMENTS} SELECT * EXCLUDE url FROM elements WHERE pos >= 7 AND pos < 12""",
    "element_at": f"WITH {ELEMENTS} SELECT * EXCLUDE url FROM elements WHERE pos = 8",
    "element_type_counts": f"WITH {ELEMENTS} SELECT type, count(*) AS n FROM elements GROUP BY type",
    "split_examples": """
WITH replies AS (
  SELECT conv_id, turn,
    string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)) AS items
  FROM conversations)
SELECT conv_id, turn, (generate_subscripts(items, 1) - 1)::INTEGER AS pos, unnest(items) AS item
FROM replies""",
    "clean_section": f"""
SELECT doc_id, {clean('text')} AS cleaned, {clean("replace(text, '.', ' .')", ' ')} AS spaced
FROM documents""",
    "extract_doc_text": f"WITH {PAGE_TEXTS} SELECT page_id, text FROM texts",
    "page_texts": f"WITH {PAGE_TEXTS} SELECT page_id, 1 AS page_number, text FROM texts",
    "load_and_split": f"""
SELECT doc_id AS page_id, 1 AS page_number, chunk_ix, content, n_units FROM ({
        packed(
            f"{PAGE_TEXTS}, page_source AS (SELECT page_id AS doc_id, text FROM texts), "
            + character_pieces("page_source"),
            1000,
            200,
        )
    })""",
    "chunk_sentences": packed(SENTENCE_PIECES, 500, 50),
    "chunk_recursive": packed(character_pieces("documents"), 1000, 200),
    "chunk_stride": f"{DOCUMENT_CHUNKS} SELECT doc_id, chunk_ix, content, n_units FROM chunks",
    "explode_chunks": f"{PAGE_CHUNKS} SELECT page_id, chunk_ix, content FROM chunks",
    "token_count": f"SELECT doc_id, len({words('text')})::INTEGER AS n_tokens FROM documents",
    "embed_chunks": f"""{DOCUMENT_CHUNKS}, {hashed('chunks', 'content', 'doc_id', 'chunk_ix', prefix='c')}
SELECT doc_id, chunk_ix, bucket::INTEGER AS bucket, round(weight::DOUBLE, 6) AS weight FROM c_weights""",
    "embed_hash_tf": f"""
WITH {hashed('documents', 'text', 'doc_id', prefix='d')}
SELECT doc_id, bucket::INTEGER AS bucket, round(weight::DOUBLE, 6) AS weight FROM d_weights""",
    "batch_assign": """
SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 150 AS batch FROM documents""",
    "topk_l2": topk(4, L2),
    "topk_k2": topk(2, L2),
    "topk_k3": topk(3, L2),
    "topk_cosine": topk(4, COSINE),
    "topk_ip": topk(4, IP),
    "topk_blocks": topk(4, L2),
    "topk_mmr": marginal(4, 12, 0.5),
    "topk_pq": topk(4, L2),
    "topk_ivf": topk(4, L2),
    "topk_stored": topk(4, L2),
    "sync_index": topk(4, L2).replace(
        "* (1 + label / 10))::FLOAT)",
        "* (1 + label / 10))::FLOAT * CASE WHEN label = 1 THEN -1 ELSE 1 END)",
    ).replace("FROM embeddings),\nasked", "FROM embeddings WHERE label <> 0),\nasked"),
    "topk_lsh": topk(4, L2),
    "retrieve_documents": f"{HITS} SELECT qid, rank::INTEGER AS rank, id, url, content FROM hits",
    "answer_sources": f"{HITS}, {SOURCES} SELECT qid, sources FROM sources",
    "source_summary": f"""{HITS}
SELECT qid, {summed(PAGES_PREFIX, 'page', ',')} AS doc_pages,
  {summed(NAMES_PREFIX, 'url', ',')} AS doc_names,
  {summed(DETAILS_PREFIX, 'content', '.' + chr(10))} AS doc_content
FROM hits GROUP BY qid""",
    "build_prompt": prompt_sql(),
    "answer_questions": f"{ANSWERS} SELECT qid, result FROM answers",
    "qa_batch": f"{ANSWERS} SELECT qid, question, result, sources FROM answers",
    "qa_index": f"{ANSWERS} SELECT qid, question, result, sources FROM answers",
    "format_answer": f"""{ANSWERS}
SELECT qid, replace(result, ' ', '<br/>')
    || {escaped(SOURCES_OPEN)} || links || {escaped(SOURCES_CLOSE)} AS html,
  replace(result, ' ', '<br/>') AS html_without_sources
FROM answers""",
    "render_conversation": f"""
SELECT conv_id, string_agg(
  CASE WHEN role = 'user' THEN {escaped(USER_OPEN)} ELSE {escaped(ASSISTANT_OPEN)} END
    || text || {escaped(MESSAGE_CLOSE)}, '' ORDER BY turn) AS html
FROM conversations GROUP BY conv_id""",
    "count_chunks": f"{DOCUMENT_CHUNKS} SELECT count(*) AS n_chunks FROM chunks",
    "table_complete": """
SELECT (SELECT count(*) FROM documents) AS n_rows, (SELECT count(*) FROM benchmark) AS n_expected,
  (SELECT count(*) FROM documents) >= (SELECT count(*) FROM benchmark) AS complete,
  false AS missing_complete""",
    "parse_pdf": f"""{PAGE_WORDS},
sheets AS (SELECT page_id, w, unnest(range(0, len(w), 320)) AS s FROM worded)
SELECT page_id, (s // 320 + 1)::INTEGER AS page_number, {some(1, 320)} AS text FROM sheets""",
    "parse_mixed": f"""{PAGE_WORDS}
SELECT page_id, page_id % 3 <> 0 AS pdf, array_to_string(w, ' ') AS text FROM worded""",
    "reading_order": SHEETS,
}
ORACLES["stored_changes"] = ORACLES["snapshot_changes"]

# The image line of a message of the assistant.
IMAGE = (
    '<img style="float: left; width:40px; margin: -10px 5px 0px -10px" '
    'src="https://example.net/robot.png"/>\n        '
)
ORACLES["chat_page"] = f"""{ANSWERS},
history AS (
  SELECT conv_id, string_agg(
    CASE WHEN role = 'user' THEN {escaped(USER_OPEN)}
         ELSE {escaped(ASSISTANT_OPEN)} || {escaped(IMAGE)} END
      || text || {escaped(MESSAGE_CLOSE)}, '' ORDER BY turn) AS shown
  FROM conversations GROUP BY conv_id),
replies AS (
  SELECT qid AS conv_id, {escaped(ASSISTANT_OPEN)} || {escaped(IMAGE)}
    || replace(result, chr(10), '<br/>') || {escaped(SOURCES_OPEN)} || links
    || {escaped(SOURCES_CLOSE)} || {escaped(MESSAGE_CLOSE)} AS reply
  FROM answers)
SELECT conv_id, coalesce(shown, '') || coalesce(reply, '') AS html
FROM history FULL JOIN replies USING (conv_id)"""
