"""SQL for an independent engine, for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from twinsieve.llm.licenses import PHRASES, TEMPLATES, LicenseParams
from twinsieve.llm.rules import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TOP_K = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding,
           lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)
           AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored)
WHERE rank <= 10"""


def quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
tok AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM split),
win AS (
  SELECT doc_id, i, t, lead(t, 1) OVER p AS t2, lead(t, 2) OVER p AS t3
  FROM tok WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t, t2, t3) AS n
  FROM win WHERE t3 IS NOT NULL),
covered AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM twice WHERE n > 1) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(len(list_filter(w, lambda x: trim(lower(x), '.,;:!?"''()') IN ({stop}))) AS BIGINT)
           AS n_stop_words,
         coalesce(c.n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered c USING (doc_id)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * word_chars BETWEEN 200 * n_words AND 1200 * n_words AS word_length_ok,
         100 * n_symbols <= 10 * n_words AS symbols_ok,
         100 * n_stop_words >= 5 * n_words AS stop_words_ok,
         100 * n_dup_lines <= 40 * n_lines AS repeated_lines_ok
  FROM counted)
SELECT *, NOT base_failed AND word_length_ok AND symbols_ok AND stop_words_ok
          AND repeated_lines_ok AS kept
FROM judged"""


NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_WORD}') AS w
  FROM documents),
tok AS (SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM split WHERE len(w) >= 5),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, t || ' ' || lead(t, 1) OVER p || ' ' || lead(t, 2) OVER p || ' '
                     || lead(t, 3) OVER p || ' ' || lead(t, 4) OVER p AS g
    FROM tok WINDOW p AS (PARTITION BY doc_id ORDER BY i)
    UNION ALL
    SELECT doc_id, list_aggregate(w, 'string_agg', ' ') FROM split WHERE len(w) BETWEEN 1 AND 4)
  WHERE g IS NOT NULL),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM shared s JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * s.n >= 85 * (a.n + b.n - s.n)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(id, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.id, b.y FROM reach r JOIN both_ways b ON r.node = b.x),
lowest AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id,
       d.doc_id = l.component_id AS kept
FROM documents d JOIN lowest l ON l.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

def _run_at(words: list[str]) -> str:
    """The condition that a run of words starts here."""
    parts = [f"lead(w, {i}) OVER p = '{word}'" for i, word in enumerate(words)]
    return f"({' AND '.join(parts)})"


def license_scan() -> str:
    params = LicenseParams()
    texts = ", ".join(
        "('{}', '{}', '{}')".format(name, label, text.replace("'", "''"))
        for name, (label, text) in TEMPLATES.items()
    )
    k = params.gram
    gram = " || ' ' || ".join(f"lead(w, {i}) OVER p" for i in range(k))
    phrase = " OR ".join(_run_at(text.split()) for text, _ in PHRASES)
    label = " ".join(f"WHEN w = '{text.split()[0]}' THEN '{name}'" for text, name in PHRASES)
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), "
        f"'{_UPPER}', '{_LOWER}'), '{_LETTERS}')"
    )
    tokens = "unnest(words) AS w, generate_subscripts(words, 1) - 1 AS pos"
    return f"""
WITH templates AS (
  SELECT template, label, {words} AS words FROM (VALUES {texts}) AS v(template, label, text)),
windows AS (
  SELECT template, label, n, pos AS place, {gram} AS gram
  FROM (SELECT template, label, len(words) AS n, {tokens} FROM templates)
  WINDOW p AS (PARTITION BY template ORDER BY pos)),
texts AS (SELECT doc_id, {words} AS words FROM documents),
tokens AS (
  SELECT doc_id, w, pos, {gram} AS gram, coalesce({phrase}, false) AS is_phrase
  FROM (SELECT doc_id, {tokens} FROM texts) WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
         list_sort(list(DISTINCT CASE {label} END)) AS names
  FROM tokens WHERE is_phrase GROUP BY doc_id),
hits AS (
  SELECT doc_id, template, label, n, place, pos, pos - place AS diagonal
  FROM tokens JOIN windows USING (gram)),
parted AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal, pos)
            > {params.slack} AS apart
  FROM hits),
merged AS (
  SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id, template ORDER BY diagonal, pos) AS island
  FROM parted),
gains AS (
  SELECT *, least(coalesce(lead(place) OVER (PARTITION BY doc_id, template, island ORDER BY place)
                           - place, {k}), {k}) AS gain
  FROM merged),
found AS (
  SELECT doc_id, template, label, min(pos) AS first_word, max(pos) + {k - 1} AS last_word,
         sum(gain) / any_value(n) AS share, sum(gain) AS covered
  FROM gains GROUP BY doc_id, template, label, island),
enough AS (
  SELECT * FROM found WHERE share >= {params.least_share}
    AND least(covered / (last_word - first_word + 1), 1) >= {params.least_density}),
reached AS (
  SELECT *, max(last_word) OVER (PARTITION BY doc_id ORDER BY first_word, last_word, template
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM enough),
placed AS (
  SELECT *, sum(CASE WHEN first_word > reach - {k} THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id ORDER BY first_word, last_word, template) AS place
  FROM reached),
best AS (
  SELECT *, max({{'share': share, 'label': label}}) OVER (PARTITION BY doc_id, place) AS best
  FROM placed),
spans AS (
  SELECT doc_id, list(DISTINCT label) AS names, max(share) AS share, count(*) AS n_spans
  FROM best WHERE share = best.share OR label = best.label GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word,
       last_word, coalesce(array_to_string(b.names, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(
         list_concat(coalesce(b.names, []), coalesce(s.names, [])))), ','), '') AS labels,
       least(greatest(coalesce(share, 0),
             CASE WHEN n_base > 0 THEN {params.phrase_score} ELSE 0 END), 1.0)::DOUBLE AS score,
       coalesce(n_spans, 0) AS n_spans
FROM texts LEFT JOIN (SELECT * FROM base) b USING (doc_id) LEFT JOIN spans s USING (doc_id)"""


def statements() -> dict[str, str]:
    return {
        "op1_top_k": TOP_K,
        "op3_quality_rules": quality_rules(),
        "op9_near_duplicates": NEAR_DUPLICATES,
        "op12_license_scan": license_scan(),
    }
