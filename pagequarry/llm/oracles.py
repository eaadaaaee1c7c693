"""DuckDB SQL for the training-data operators that SQL can express."""

from __future__ import annotations

# The letters that are lower-cased, and the words of benchmark windows.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


CONTAMINATION = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({lowered('text')}, '{WORD}') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k,
         array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS w
  FROM item, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS t(i) WHERE len(ws) > 0
), doc AS (
  SELECT doc_id, regexp_extract_all({lowered('text')}, '{WORD}') AS ws FROM documents
), place AS (
  SELECT doc_id, i, k, array_to_string(ws[i : i + k - 1], ' ') AS w
  FROM doc, (SELECT DISTINCT k FROM win), unnest(range(1, greatest(len(ws) - k, -1) + 2)) AS t(i)
), hit AS (
  SELECT doc_id, i, place.k, item_id FROM place JOIN win ON place.w = win.w AND place.k = win.k
),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM hit, unnest(range(0, k)) AS t(j) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hit GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
       coalesce(found.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ARCHIVE = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n,
         sha256(coalesce(html, '')) AS digest FROM pages
), first AS (SELECT digest, min(page_id) AS first_id FROM page WHERE n >= 100 GROUP BY digest)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM page LEFT JOIN first USING (digest)
"""

FILL_IN_MIDDLE = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hash
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         ('0x' || hash[1:8])::BIGINT % (len(units) + 1) AS one,
         ('0x' || hash[9:16])::BIGINT % (len(units) + 1) AS two,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>')
                OR ('0x' || hash[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || hash[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM doc
), cut AS (
  SELECT doc_id, text, n, form,
         array_to_string(units[1 : least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1 : greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1 :], '') AS suffix
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END
       ) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""

ORACLES = {
    "op2_decontaminate": CONTAMINATION,
    "op6_warc": ARCHIVE,
    "op12_middle": FILL_IN_MIDDLE,
}
