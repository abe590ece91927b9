"""SQL for an independent engine, one statement for each registered query that has one."""

from __future__ import annotations

import numpy as np

# Fixed values of the signatures: permutations, bands and rows, and the seed of the draws.
NUM_PERM, BANDS, ROWS = 256, 25, 10
SEED = 42
LOW32 = (1 << 32) - 1
PRIME = (1 << 61) - 1

# Shingles and their hashes. Tokens are numbered and joined by window functions.
TOKENS = """
token_lists AS (
  SELECT doc_id, string_split_regex(text, '[^A-Za-z_0-9]') AS w FROM documents),
tok AS (
  SELECT doc_id, unnest(w) AS t, generate_subscripts(w, 1) AS i
  FROM token_lists WHERE len(w) >= 5),
gram AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, t || ' ' || lead(t, 1) OVER p || ' ' || lead(t, 2) OVER p || ' '
                     || lead(t, 3) OVER p || ' ' || lead(t, 4) OVER p AS g
    FROM tok WINDOW p AS (PARTITION BY doc_id ORDER BY i))
  WHERE g IS NOT NULL),
hashed AS (
  SELECT DISTINCT doc_id,
         CAST('0x' || s[7:8] || s[5:6] || s[3:4] || s[1:2] AS UBIGINT) AS h
  FROM (SELECT doc_id, sha1(g) AS s FROM gram))"""


def _minimum(a: int, b: int) -> str:
    """min(((h*a + b) mod 2^64) mod p, low 32 bits), without leaving 64 bits."""
    product = f"(h*{a & LOW32})"
    low = f"(({product}&{LOW32})+{b & LOW32})"
    high = f"(({product}>>32)+((h*{a >> 32})&{LOW32})+{b >> 32}+({low}>>32))"
    return f"min((((({high}&{LOW32})<<32)|({low}&{LOW32}))%{PRIME})&{LOW32})"


def _signatures() -> str:
    draws = np.random.RandomState(SEED)
    pairs = [
        [int(draws.randint(low, PRIME, dtype=np.uint64)) for low in (1, 0)]
        for _ in range(BANDS * ROWS)
    ]
    columns = ", ".join(f"{_minimum(a, b)} AS v{k}" for k, (a, b) in enumerate(pairs))
    return f"{TOKENS},\nsig AS MATERIALIZED (SELECT doc_id, {columns} FROM hashed GROUP BY doc_id)"


def _bands() -> str:
    keys = []
    for band in range(BANDS):
        values = ", ".join(f"v{k}" for k in range(band * ROWS, (band + 1) * ROWS))
        keys.append(f"format('{'{:08X}' * ROWS}', {values})")
    return (
        f"{_signatures()},\nband AS (SELECT doc_id, unnest(range({BANDS})) AS band, "
        f"unnest([{', '.join(keys)}]) AS band_key FROM sig)"
    )


def _edges() -> str:
    return f"""{_bands()},
edge AS MATERIALIZED (
  SELECT DISTINCT doc_id AS src, low AS dst FROM (
    SELECT doc_id, min(doc_id) OVER (PARTITION BY band, band_key) AS low FROM band)
  WHERE doc_id > low)"""


def _components() -> str:
    return f"""{_edges()},
both_ways AS MATERIALIZED (SELECT src, dst FROM edge UNION SELECT dst, src FROM edge),
reach(id, node) AS (
  SELECT DISTINCT src, src FROM both_ways
  UNION SELECT r.id, b.dst FROM reach r JOIN both_ways b ON r.node = b.src),
component AS MATERIALIZED (
  SELECT id, min(node) AS component FROM reach GROUP BY id HAVING min(node) < id)"""


# Parts linked to the smallest part of the same order.
PART_EDGES = """
edge AS (
  SELECT DISTINCT l_partkey AS src, low AS dst FROM (
    SELECT l_partkey, min(l_partkey) OVER (PARTITION BY l_orderkey) AS low FROM lineitem)
  WHERE l_partkey > low)"""
LARGE_STAR = f"""{PART_EDGES},
both_ways AS (SELECT src, dst FROM edge UNION ALL SELECT dst, src FROM edge),
lowest AS (SELECT src, min(dst) AS low FROM both_ways GROUP BY src),
large AS (
  SELECT DISTINCT b.dst AS src, least(b.src, low) AS dst
  FROM both_ways b JOIN lowest l ON b.src = l.src WHERE b.dst > b.src)"""


CONTRACTED_COMPONENTS = """
WITH RECURSIVE line AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity >= 48),
edge AS (
  SELECT DISTINCT l_partkey AS src, low AS dst FROM (
    SELECT l_partkey, min(l_partkey) OVER (PARTITION BY l_orderkey) AS low FROM line)
  WHERE l_partkey > low),
both_ways AS MATERIALIZED (SELECT src, dst FROM edge UNION SELECT dst, src FROM edge),
reach(id, node) AS (
  SELECT DISTINCT src, src FROM both_ways
  UNION SELECT r.id, b.dst FROM reach r JOIN both_ways b ON r.node = b.src)
SELECT id, min(node) AS component FROM reach GROUP BY id HAVING min(node) < id"""


def _small_star(source: str) -> str:
    return f"""
small_low AS (SELECT src, min(dst) AS low FROM {source} GROUP BY src),
small AS (
  SELECT src, low AS dst FROM small_low
  UNION
  SELECT e.dst, low FROM {source} e JOIN small_low s ON e.src = s.src WHERE e.dst > low)"""


LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS l_returnflag, l_quantity,
         l_extendedprice FROM lineitem)"""
LINES_SCHEMA = (
    '{"fields":['
    '{"metadata":{},"name":"l_orderkey","nullable":true,"type":"long"},'
    '{"metadata":{},"name":"l_linenumber","nullable":true,"type":"integer"},'
    '{"metadata":{},"name":"l_returnflag","nullable":true,"type":"string"},'
    '{"metadata":{},"name":"l_quantity","nullable":true,"type":"double"},'
    '{"metadata":{},"name":"l_extendedprice","nullable":true,"type":"double"}'
    '],"type":"struct"}'
)
LINE_UNIQUENESS = """
  SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n)
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

_VERDICTS = """
SELECT '{check}' AS "check", 'Error' AS check_level,
       CASE WHEN bool_and(coalesce(passed, false)) OVER () THEN 'Success' ELSE 'Error' END
         AS check_status,
       label AS "constraint",
       CASE WHEN coalesce(passed, false) THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN passed THEN '' WHEN value IS NULL THEN 'Missing column: no_such_column'
            ELSE 'Value: ' || value || ' does not meet the constraint' END AS constraint_message
FROM ({rules})"""
_DOCUMENT_RULES = """
  SELECT 'Completeness(doc_id) >= 1.0' AS label, v = 1 AS passed, v AS value
  FROM (SELECT count(doc_id) / count(*) AS v FROM documents)
  UNION ALL SELECT 'Completeness(lang) >= 0.95', v >= 0.95, v
  FROM (SELECT count(nullif(lang, 'de')) / count(*) AS v FROM documents)
  UNION ALL SELECT 'Completeness(no_such_column) >= 1.0', false, NULL
  UNION ALL SELECT 'Uniqueness(doc_id) = 1.0', v = 1, v FROM (
    SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n) AS v
    FROM (SELECT count(*) AS n FROM documents GROUP BY doc_id))
  UNION ALL SELECT 'n_chars is non-negative', v = 1, v
  FROM (SELECT count(*) FILTER (coalesce(n_chars, 0) >= 0) / count(*) AS v FROM documents)"""
DOCUMENT_CHECKS = _VERDICTS.format(check="documents", rules=_DOCUMENT_RULES)
SUPPLIER_CHECKS = _VERDICTS.format(
    check="suppliers",
    rules="""
  SELECT 'Completeness(s_name) >= 0.99' AS label, v >= 0.99 AS passed, v AS value
  FROM (SELECT count(s_name) / count(*) AS v FROM supplier)
  UNION ALL SELECT 's_acctbal <= 5000.0', v = 1, v
  FROM (SELECT count(*) FILTER (s_acctbal <= 5000) / count(*) AS v FROM supplier)
  UNION ALL SELECT 's_acctbal >= -1000.0', v = 1, v
  FROM (SELECT count(*) FILTER (s_acctbal >= -1000) / count(*) AS v FROM supplier)""",
)

ORPHANED = """
orphaned AS (
  SELECT * REPLACE (CASE WHEN o_custkey % 10 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey)
  FROM orders)"""

DIM_LANGUAGES = """
languages AS (
  SELECT row_number() OVER (ORDER BY min(doc_id)) AS language_id,
         coalesce(nullif(lang, 'de'), 'N/A') AS language_name
  FROM documents GROUP BY coalesce(nullif(lang, 'de'), 'N/A'))"""


def statements() -> dict[str, str]:
    components = f"WITH RECURSIVE {_components()}\n"
    found = {
        "table_scan": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "row_id_attach": """
            SELECT count(*) AS n_rows, count(*) AS n_ids, 0::BIGINT AS n_null FROM lineitem""",
        # The tables are one file each, in the order of the key.
        "row_id_scan": """
            SELECT doc_id, n_chars,
                   (1::BIGINT << 33) + row_number() OVER (ORDER BY doc_id) - 1 AS row_id
            FROM documents""",
        "staged_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "staged_versions": """
            SELECT v.version, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars
            FROM documents, (SELECT unnest([1, 2, 3])::BIGINT AS version) v
            WHERE (v.version = 1 AND lang = 'en') OR v.version = 2
               OR (v.version = 3 AND n_chars > 1000)
            GROUP BY v.version, lang""",
        "range_bucket": """
            SELECT CASE WHEN n_chars < 0 THEN 0 WHEN n_chars >= 10000 THEN 11
                        ELSE n_chars // 1000 + 1 END AS bucket,
                   count(*) AS n, min(n_chars) AS low, max(n_chars) AS high
            FROM documents GROUP BY 1""",
        "clustered_layout": """
            SELECT count(*) AS n, 0::BIGINT AS overlaps, min(o_custkey) AS lowest,
                   max(o_custkey) AS highest FROM orders""",
        "token_counts": f"WITH {TOKENS} SELECT doc_id, len(w) AS n_tokens FROM token_lists",
        "ngrams": f"WITH {TOKENS} SELECT doc_id, g AS ngram FROM gram",
        "shingle_hashes": f"WITH {TOKENS} SELECT doc_id, CAST(h AS BIGINT) AS hash FROM hashed",
        "minhash_signatures": f"""WITH {_signatures()}
            SELECT doc_id, unnest(range({BANDS * ROWS})) AS k,
                   unnest([{', '.join(f'CAST(v{k} AS BIGINT)' for k in range(BANDS * ROWS))}]) AS v
            FROM sig""",
        "lsh_bands": f"WITH {_bands()} SELECT doc_id, band, band_key FROM band",
        "lsh_buckets": f"""WITH {_bands()}
            SELECT band, band_key, min(doc_id) AS min_id, count(*) AS n
            FROM band GROUP BY band, band_key HAVING count(*) > 1""",
        "lsh_edges": f"WITH {_edges()} SELECT src, dst FROM edge",
        "lsh_edges_hot": f"WITH {_edges()} SELECT src, dst FROM edge",
        "large_star_step": f"WITH {LARGE_STAR} SELECT src, dst FROM large",
        "small_star_step": f"WITH {PART_EDGES}, {_small_star('edge')} SELECT src, dst FROM small",
        "edge_symmetric_diff": f"""WITH {LARGE_STAR}, {_small_star('large')}
            (SELECT * FROM large EXCEPT SELECT * FROM small)
            UNION (SELECT * FROM small EXCEPT SELECT * FROM large)""",
        "connected_components": f"{components} SELECT id, component FROM component",
        "connected_components_large": f"{components} SELECT id, component FROM component",
        "contracted_components": CONTRACTED_COMPONENTS,
        "incremental_signatures": f"WITH {_edges()} SELECT src, dst FROM edge",
        "components_sorted": f"{components} SELECT component, id FROM component ORDER BY 1, 2",
        "components_top": f"""{components}
            SELECT component, id FROM component ORDER BY 1, 2 LIMIT 100""",
        "near_dedup_keep": f"""{components} SELECT doc_id, text, lang, source, n_chars
            FROM documents WHERE doc_id NOT IN (SELECT id FROM component)""",
        "near_dedup_removed": f"""{components} SELECT doc_id, text, lang, source, n_chars
            FROM documents WHERE doc_id IN (SELECT id FROM component)""",
        "near_dedup_job": f"""{components} SELECT doc_id, text, lang, source, n_chars
            FROM documents WHERE doc_id NOT IN (SELECT id FROM component)""",
        "near_dedup_by_place": f"""{components} SELECT doc_id, text, lang, source, n_chars
            FROM documents WHERE doc_id NOT IN (SELECT id FROM component)""",
        "near_dedup_published": f"""{components} SELECT doc_id, text, lang, source, n_chars
            FROM documents WHERE doc_id NOT IN (SELECT id FROM component)""",
        "row_count_gate": f"""{components}
            SELECT n AS rows_before, n - gone AS rows_after, gone / n * 100 AS pct_removed,
                   gone / n * 100 > 0 AND gone / n * 100 < 30 AS passed
            FROM (SELECT (SELECT count(*) FROM documents) AS n,
                         (SELECT count(*) FROM component) AS gone)""",
        "schema_gate": """
            SELECT 'doc_id' AS "column", 'long' AS type_before, 'long' AS type_after,
                   'same' AS change, true AS passed, count(doc_id) AS n_before,
                   count(doc_id) AS n_after FROM documents
            UNION ALL SELECT 'text', 'string', 'string', 'same', true, count(text), count(text)
            FROM documents
            UNION ALL SELECT 'lang', 'string', NULL, 'dropped', false, count(lang), NULL
            FROM documents
            UNION ALL SELECT 'source', 'string', 'string', 'same', true, count(source),
                   count(nullif(source, 'src3')) FROM documents
            UNION ALL SELECT 'n_chars', 'long', 'double', 'retyped', false, count(n_chars),
                   count(n_chars) FROM documents
            UNION ALL SELECT 'is_long', NULL, 'boolean', 'added', false, NULL,
                   count(CASE WHEN n_chars > 1000 THEN 1 END) FROM documents""",
        "dq_metrics": f"""WITH {LINES}
            SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name,
                   count(*)::DOUBLE AS number, NULL::VARCHAR AS text FROM lines
            UNION ALL SELECT 'Column', 'l_orderkey', 'Completeness',
                   count(l_orderkey) / count(*), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_returnflag', 'Completeness',
                   round(count(l_returnflag) / count(*), 6), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_quantity', 'Mean',
                   round(avg(l_quantity), 6), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_quantity', 'Maximum', max(l_quantity), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_quantity', 'Minimum', min(l_quantity), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_extendedprice', 'Mean',
                   round(avg(l_extendedprice), 6), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_extendedprice', 'Maximum',
                   max(l_extendedprice), NULL FROM lines
            UNION ALL SELECT 'Column', 'l_extendedprice', 'Minimum',
                   min(l_extendedprice), NULL FROM lines
            UNION ALL SELECT 'Multicolumn', 'l_orderkey,l_linenumber', 'Uniqueness',
                   round(({LINE_UNIQUENESS}), 6), NULL
            UNION ALL SELECT 'Dataset', '*', 'schema', NULL, '{LINES_SCHEMA}'""",
        "dq_uniqueness": f"""
            SELECT 'lineitem' AS tbl, round(({LINE_UNIQUENESS}), 9) AS uniqueness
            UNION ALL SELECT 'conversations', (
              SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / sum(n)
              FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id, turn))""",
        "dq_checks": DOCUMENT_CHECKS,
        "failed_checks": f"SELECT * FROM ({DOCUMENT_CHECKS}) WHERE check_status <> 'Success'",
        "dq_range_check": SUPPLIER_CHECKS,
        "metric_lookup": "SELECT count(*) || '.0' AS value FROM lineitem",
        "schema_snapshot": f"""
            SELECT f.name AS name, f.type AS type, (SELECT count(*) FROM lineitem) AS n_rows
            FROM (SELECT unnest(from_json('{LINES_SCHEMA}',
              '{{"fields": [{{"name": "VARCHAR", "type": "VARCHAR"}}]}}').fields) AS f)""",
        "schema_gate_nested": """
            SELECT v.*, n AS rows_before, n AS rows_after
            FROM (VALUES ('doc_id', 'bigint', 'string', 'retyped'),
                         ('about', 'struct', 'struct', 'same'),
                         ('about.lang', 'string', 'string', 'same'),
                         ('about.source', 'string', NULL, 'dropped'),
                         ('about.sizes', 'array', 'array', 'same'),
                         ('about.sizes[]', 'struct', 'struct', 'same'),
                         ('about.sizes[].n', 'bigint', 'bigint', 'same'),
                         ('about.sizes[].points', NULL, 'int', 'added'),
                         ('about.license', NULL, 'string', 'added'))
                 AS v(path, type_before, type_after, change),
                 (SELECT count(*) AS n FROM documents)""",
        "pk_audit": """
            SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "fk_audit": f"""WITH {ORPHANED}
            SELECT o_custkey, count(*) AS n FROM orphaned
            WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey""",
        "dedup_key_check": f"""WITH {LINES}
            SELECT sum(n)::BIGINT AS n_rows, count(*) FILTER (NOT gone) AS n_keys,
                   count(*) FILTER (n > 1 AND NOT gone) AS repeated_keys,
                   coalesce(sum(n) FILTER (n > 1 AND NOT gone), 0)::BIGINT AS repeated_rows,
                   coalesce(sum(n) FILTER (gone), 0)::BIGINT AS null_rows
            FROM (SELECT count(*) AS n, l_returnflag IS NULL AS gone FROM lines
                  GROUP BY l_orderkey, l_linenumber, l_returnflag)""",
        "dim_languages": f"WITH {DIM_LANGUAGES} SELECT language_id, language_name FROM languages",
        "dim_repositories": f"""WITH {DIM_LANGUAGES}
            SELECT d.source, l.language_id, d.doc_id, d.n_chars
            FROM (SELECT *, coalesce(nullif(lang, 'de'), 'N/A') AS language_name,
                         row_number() OVER (PARTITION BY source ORDER BY doc_id) AS place
                  FROM documents) d
            JOIN languages l ON d.language_name = l.language_name WHERE place = 1""",
        "fact_files": """
            SELECT row_number() OVER (ORDER BY doc_id DESC) AS file_id, source, doc_id, text,
                   '{"' || lang || '":' || n_chars || '}' AS languages_distribution
            FROM documents""",
        "snowflake_view": f"""WITH {ORPHANED}
            SELECT o.o_orderpriority AS path, c.c_mktsegment AS owner,
                   CAST(c.c_custkey AS DOUBLE) AS repo_id,
                   CAST(c.c_acctbal < 5000 AS VARCHAR) AS is_fork,
                   o.o_orderstatus AS languages_distribution,
                   CAST(o.o_orderkey AS VARCHAR) AS content, c.c_acctbal AS issues,
                   n.n_name AS main_language, CAST(c.c_nationkey AS DOUBLE) AS forks,
                   CAST(c.c_custkey % 7 AS DOUBLE) AS stars,
                   o.o_orderstatus AS commit_sha, o.o_orderkey AS size, c.c_name AS name,
                   c.c_mktsegment AS license
            FROM orphaned o
            LEFT JOIN customer c ON o.o_custkey = c.c_custkey
            LEFT JOIN nation n ON nullif(c.c_nationkey, 3) = n.n_nationkey""",
        "snowflake_roundtrip": """
            SELECT source || '/' || doc_id AS path, 'owner' || repo % 7 AS owner,
                   repo AS repo_id, CAST(repo % 3 = 0 AS VARCHAR) AS is_fork,
                   CASE WHEN doc_id % 5 > 0 THEN '{"' || lang || '":' || n_chars || '}'
                        ELSE 'null' END AS languages_distribution,
                   text AS content, CAST(repo AS DOUBLE) AS issues,
                   CASE WHEN repo % 4 > 0 THEN 'L' || repo % 4 ELSE 'N/A' END AS main_language,
                   repo * 3 AS forks, repo * 9000 AS stars, lang AS commit_sha,
                   n_chars * 100 AS size, source AS name, nullif(source, 'src1') AS license
            FROM (SELECT *, CAST(substr(source, 4) AS BIGINT) AS repo FROM documents)""",
    }
    # A profile from kept states is the profile of the table.
    # Bucketed tables give the same view.
    return found | {
        "profile_merge": found["dq_metrics"],
        "bucketed_view": found["snowflake_roundtrip"],
    }
