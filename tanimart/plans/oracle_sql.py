"""DuckDB SQL of the registered queries.

The SQL takes other ways than the Spark plans where it can: intersections come
from a join on bit positions, the tie flag from counts at the cutoff score,
the neighbour chain from self-joins, grouping sets from separate GROUP BYs,
and the name match from a union of its three outcomes.
"""

from __future__ import annotations

_BITS = r"""
molecules AS (
    SELECT 'D' || CAST(doc_id AS VARCHAR) AS mol_id, text FROM documents
    UNION ALL
    SELECT 'B' || CAST(item_id AS VARCHAR) AS mol_id, text FROM benchmark
),
feats AS (
    SELECT mol_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS feature
    FROM molecules
),
bits AS (
    SELECT DISTINCT mol_id,
           CAST(CAST('0x' || substr(md5(feature), 1, 8) AS BIGINT) % 2048 AS INTEGER) AS bit
    FROM feats
),
pop AS (SELECT mol_id, count(*) AS n_bits FROM bits GROUP BY mol_id)
"""

_ITEMS = "SELECT 'B' || CAST(item_id AS VARCHAR) AS mol_id FROM benchmark"
# Suppliers name the benchmark item of their number, nations the document.
_MATCHED = """
    SELECT 'B' || CAST(item_id AS VARCHAR) AS mol_id FROM benchmark WHERE item_id IN (SELECT s_suppkey FROM supplier)
    UNION
    SELECT 'D' || CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id IN (SELECT n_nationkey FROM nation)"""


def _pairs(sources: str) -> str:
    return _BITS + f""",
wanted AS ({sources}),
src AS (SELECT mol_id, n_bits FROM pop WHERE mol_id IN (SELECT mol_id FROM wanted)),
inter AS (
    SELECT s.mol_id AS source_id, t.mol_id AS target_id, count(*) AS n_common
    FROM bits s JOIN bits t ON s.bit = t.bit
    WHERE s.mol_id IN (SELECT mol_id FROM src) AND s.mol_id <> t.mol_id
    GROUP BY s.mol_id, t.mol_id
),
pairs AS (
    SELECT s.mol_id AS source_id, c.mol_id AS target_id,
           coalesce(i.n_common, 0)::DOUBLE / (s.n_bits + c.n_bits - coalesce(i.n_common, 0))::DOUBLE AS score
    FROM src s JOIN pop c ON s.mol_id <> c.mol_id
    LEFT JOIN inter i ON i.source_id = s.mol_id AND i.target_id = c.mol_id
)
"""


def _fact(sources: str) -> str:
    """Candidates of one score are ordered by kind, then by number."""
    return _pairs(sources) + """,
ranked AS (
    SELECT source_id, target_id, score,
           row_number() OVER (PARTITION BY source_id
                              ORDER BY score DESC, left(target_id, 1), CAST(substr(target_id, 2) AS BIGINT)) AS rn
    FROM pairs
),
ends AS (SELECT source_id, min(score) AS cut FROM ranked WHERE rn <= 10 GROUP BY source_id),
left_out AS (
    SELECT r.source_id FROM ranked r JOIN ends e USING (source_id)
    WHERE r.rn > 10 AND r.score = e.cut GROUP BY r.source_id
),
fact AS (
    SELECT r.source_id, r.target_id, r.score, CAST(r.rn AS INTEGER) AS rank,
           r.score = e.cut AND r.source_id IN (SELECT source_id FROM left_out) AS tied_at_cutoff
    FROM ranked r JOIN ends e USING (source_id)
    WHERE r.rn <= 10
)
"""


_FACT = _fact(_MATCHED)

_DIM = _FACT + r""",
entries AS (
    SELECT 'D' || CAST(doc_id AS VARCHAR) AS mol_id, 'document' AS kind, lang, n_chars, text FROM documents
    UNION ALL
    SELECT 'B' || CAST(item_id AS VARCHAR), 'benchmark', CAST(NULL AS VARCHAR), CAST(length(text) AS BIGINT), text FROM benchmark
),
dim AS (
    SELECT d.mol_id, d.kind, d.lang, d.n_chars,
           CAST(len(regexp_extract_all(lower(d.text), '[\p{L}\p{N}]+')) AS INTEGER) AS n_words,
           CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS n_lines,
           l.quality, l.toxic,
           CAST(NULL AS VARCHAR) AS molecular_species, CAST(NULL AS DECIMAL(9,2)) AS cx_logp,
           CAST(NULL AS DECIMAL(9,2)) AS full_mwt, CAST(NULL AS INTEGER) AS aromatic_rings, CAST(NULL AS INTEGER) AS heavy_atoms
    FROM entries d LEFT JOIN labels l ON d.mol_id = 'D' || CAST(l.doc_id AS VARCHAR)
    WHERE d.mol_id IN (SELECT source_id FROM fact) OR d.mol_id IN (SELECT target_id FROM fact)
)
"""

_SLOTS = """,
slots AS (
    SELECT CAST(row_number() OVER (ORDER BY md5(source_id), source_id) AS INTEGER) AS slot, source_id
    FROM (SELECT DISTINCT source_id FROM fact)
    ORDER BY md5(source_id), source_id
    LIMIT 10
)
"""

ORACLE: dict[str, str] = {
    "flagship_topk": "WITH " + _fact(_ITEMS) + "SELECT * FROM fact",
    "indexed_topk": "WITH " + _fact(_ITEMS) + "SELECT * FROM fact",
    "maintained_topk": "WITH " + _fact(_ITEMS) + "SELECT * FROM fact",
    "matched_topk": "WITH " + _FACT + "SELECT * FROM fact",
    "built_fact": "WITH " + _FACT + "SELECT * FROM fact",
    "scoped_dimension": "WITH " + _DIM + "SELECT * FROM dim",
    "avg_per_source": "WITH " + _FACT + """
        SELECT source_id, round(sum(score) / count(*), 4) AS avg_score FROM fact GROUP BY 1""",
    # sources of which every neighbour's quality (or their own) is unknown stay, with NULL
    "property_deviation": "WITH " + _DIM + """,
        own AS (SELECT mol_id, quality FROM dim),
        gaps AS (
            SELECT source_id, (SELECT quality FROM own WHERE mol_id = source_id) AS mine,
                   (SELECT quality FROM own WHERE mol_id = target_id) AS theirs
            FROM fact
        )
        SELECT source_id, any_value(mine) AS source_quality,
               round(sum(greatest(mine, theirs) - least(mine, theirs)) FILTER (WHERE theirs IS NOT NULL AND mine IS NOT NULL)
                     / nullif(count(*) FILTER (WHERE theirs IS NOT NULL AND mine IS NOT NULL), 0)::DOUBLE, 4) AS avg_quality_deviation
        FROM gaps GROUP BY source_id""",
    "sample_sources": "WITH " + _FACT + _SLOTS + "SELECT slot, source_id FROM slots",
    "pivot_sources": "WITH " + _FACT + _SLOTS + """
        SELECT f.target_id,
               """ + ",\n               ".join(
        f"max(CASE WHEN s.slot = {i} THEN f.score END) AS source_{i:02d}" for i in range(1, 11)) + """
        FROM fact f JOIN slots s USING (source_id)
        GROUP BY f.target_id""",
    "neighbor_chain": "WITH " + _FACT + """
        SELECT here.source_id, here.target_id, here.score,
               after.target_id AS next_target_id, two.target_id AS second_target_id
        FROM fact here
        LEFT JOIN fact after ON after.source_id = here.source_id AND after.rank = here.rank + 1
        LEFT JOIN fact two ON two.source_id = here.source_id AND two.rank = 2""",
    "grouped_average": "WITH " + _DIM + """,
        scored AS (
            SELECT f.source_id, f.score, CAST(d.quality AS VARCHAR) AS quality, CAST(d.toxic AS VARCHAR) AS toxic
            FROM fact f JOIN dim d ON d.mol_id = f.source_id
        )
        SELECT source_id, 'TOTAL' AS quality, 'TOTAL' AS toxic, round(avg(score), 4) AS avg_score FROM scored GROUP BY source_id
        UNION ALL
        SELECT 'TOTAL', quality, toxic, round(avg(score), 4) FROM scored GROUP BY quality, toxic
        UNION ALL
        SELECT 'TOTAL', 'TOTAL', toxic, round(avg(score), 4) FROM scored GROUP BY toxic
        UNION ALL
        SELECT 'TOTAL', 'TOTAL', 'TOTAL', round(avg(score), 4) FROM scored""",
}

_RAW = """
raw AS (
    SELECT ' ' || CAST(o_orderkey AS VARCHAR) AS compound_id,
           upper('  customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' ') AS compound_name,
           CAST(o_totalprice AS VARCHAR) AS molecular_weight,
           CAST(NULL AS VARCHAR) AS logp,
           CAST(NULL AS VARCHAR) AS ic50_nm,
           strftime(o_orderdate, '%Y-%m-%d') AS assay_date,
           o_orderpriority AS lab_id,
           'batch_01_orders.csv' AS _source_file
    FROM orders
    UNION ALL
    SELECT 'E' || CAST(event_id AS VARCHAR),
           CASE event_type WHEN 'error' THEN ' Paracetamol' WHEN 'signup' THEN '  '
                WHEN 'click' THEN 'unknown ' || CAST(user_id AS VARCHAR)
                ELSE 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END,
           CAST(NULL AS VARCHAR),
           CAST(value AS VARCHAR),
           regexp_extract(props, '([0-9]+)', 1) || CASE WHEN event_type = 'click' THEN 'f' ELSE '' END,
           CASE event_type WHEN 'view' THEN strftime(ts, '%m/%d/%Y') WHEN 'error' THEN strftime(ts, '%Y%m%d')
                WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%-m-%-d') END,
           event_type,
           'batch_02_events.csv'
    FROM events
),
numbers AS (
    SELECT *, TRY_CAST(CASE WHEN regexp_matches(molecular_weight, '[a-zA-DF-Z]|^$') THEN NULL ELSE molecular_weight END AS DOUBLE) AS mw,
           TRY_CAST(CASE WHEN regexp_matches(ic50_nm, '[a-zA-DF-Z]|^$') THEN NULL ELSE ic50_nm END AS DOUBLE) AS ic
    FROM raw WHERE trim(compound_name) <> ''
),
typed AS (
    SELECT trim(compound_id) AS compound_id, trim(compound_name) AS compound_name,
           nullif(greatest(mw, 0), 0) AS molecular_weight, TRY_CAST(logp AS DOUBLE) AS logp, nullif(greatest(ic, 0), 0) AS ic50_nm,
           CAST(coalesce(TRY_STRPTIME(assay_date, '%Y-%m-%d'), TRY_STRPTIME(assay_date, '%Y-%m-%d %H:%M:%S'),
                         TRY_STRPTIME(assay_date, '%m/%d/%Y'), TRY_STRPTIME(assay_date, '%Y%m%d')) AS DATE) AS assay_date,
           trim(lab_id) AS lab_id, _source_file
    FROM numbers
),
names AS (
    SELECT lower(c_name) AS name, CAST(c_custkey AS BIGINT) AS id FROM customer
    UNION ALL SELECT 'acetaminophen', -1 UNION ALL SELECT 'acetaminophen', -2
),
matched AS (
    SELECT t.*, n.id AS matched_id FROM typed t JOIN names n ON n.name = 'acetaminophen'
    WHERE lower(t.compound_name) = 'paracetamol'
    UNION ALL
    SELECT t.*, n.id FROM typed t JOIN names n ON n.name = lower(t.compound_name)
    WHERE lower(t.compound_name) <> 'paracetamol'
    UNION ALL
    SELECT t.*, CAST(NULL AS BIGINT) FROM typed t
    WHERE lower(t.compound_name) <> 'paracetamol' AND lower(t.compound_name) NOT IN (SELECT name FROM names)
)
"""

_PAYLOADS = r"""
payloads AS (
    SELECT d.doc_id, l.quality, l.toxic, d.text, regexp_extract(d.text, '[^\p{L} \n]+') AS payload
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)
"""

_REQUESTED = _ITEMS + " UNION SELECT 'D' || CAST(c_custkey + c_custkey AS VARCHAR) FROM customer"


def _newest(keys: str, order: str) -> str:
    return f"""
        SELECT table_name, version, loaded_at, row_count FROM (
            SELECT event_type AS table_name, CAST(user_id AS VARCHAR) AS version, ts AS loaded_at, event_id AS row_count,
                   row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn
            FROM events) WHERE rn = 1"""


ORACLE.update({
    "scan_project": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "blank_to_null": r"""
        SELECT doc_id, NULLIF(text, '') AS text, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source, n_chars,
               NULLIF(regexp_extract(text, '[0-9]+'), '') AS first_number,
               NULLIF(coalesce(string_split(text, chr(10))[2], ''), '') AS second_line
        FROM documents""",
    "schema_align": "WITH " + _RAW + "SELECT * FROM raw",
    "ingested_batches": "WITH " + _RAW + "SELECT * FROM raw",
    "streamed_batches": "WITH " + _RAW + "SELECT * FROM raw",
    "typed_clean": "WITH " + _RAW + "SELECT * FROM typed",
    "name_match": "WITH " + _RAW + "SELECT * FROM matched",
    "match_audit": "WITH " + _RAW + """
        SELECT (SELECT count(*) FROM raw) AS total_rows, (SELECT count(*) FROM typed) AS kept_rows,
               (SELECT count(*) FROM raw) - (SELECT count(*) FROM typed) AS dropped_rows,
               count(*) AS output_rows, count(*) - count(matched_id) AS unmatched_rows,
               count(*) - (SELECT count(*) FROM typed) AS fanout_rows
        FROM matched""",
    "validate_split": "WITH " + _PAYLOADS + r"""
        SELECT doc_id, quality, toxic, CAST(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS INTEGER) AS n_words
        FROM payloads WHERE trim(text) <> '' AND regexp_matches(text, '[\p{L}\p{N}]')""",
    "validate_payload": "WITH " + _PAYLOADS + r"""
        SELECT doc_id, payload FROM payloads WHERE trim(payload) <> '' AND NOT regexp_matches(payload, '[\p{L}\p{N}]')""",
    "validation_counts": "WITH " + _PAYLOADS + r"""
        SELECT count(*) FILTER (WHERE regexp_matches(payload, '[\p{L}\p{N}]')) AS valid_rows,
               count(*) FILTER (WHERE trim(payload) <> '' AND NOT regexp_matches(payload, '[\p{L}\p{N}]')) AS rejected_rows
        FROM payloads""",
    "keyset_page": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
        FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 500""",
    "clustered_page": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice
        FROM orders WHERE o_orderkey > 700 ORDER BY o_orderkey LIMIT 500""",
    "fingerprint_bits": "WITH " + _BITS + "SELECT mol_id, bit FROM bits",
    "fingerprint_roundtrip": "WITH " + _BITS + "SELECT mol_id, bit FROM bits",
    "featuriser_bits": "WITH " + _BITS + "SELECT mol_id, bit FROM bits",
    "fingerprint_counts": "WITH " + _PAYLOADS + r"""
        SELECT count(*) FILTER (WHERE regexp_matches(payload, '[\p{L}\p{N}]')) AS succeeded_rows,
               count(*) FILTER (WHERE payload IS NULL OR NOT regexp_matches(payload, '[\p{L}\p{N}]')) AS failed_rows
        FROM payloads""",
    # entries with a row among the features, and the others
    "catalogue_fingerprint_counts": "WITH " + _BITS + """
        SELECT (SELECT count(*) FROM pop) AS succeeded_rows,
               (SELECT count(*) FROM molecules WHERE mol_id NOT IN (SELECT mol_id FROM pop)) AS failed_rows""",
    "catalogue_validation_counts": "WITH " + _BITS + """
        SELECT (SELECT count(*) FROM pop) AS valid_rows,
               (SELECT count(*) FROM molecules WHERE trim(text) <> '' AND mol_id NOT IN (SELECT mol_id FROM pop)) AS rejected_rows""",
    # a word of 64 bits is the sum of its bits' weights; 32 words of 16 hex digits are the 256 bytes
    "fingerprint_base64": "WITH " + _BITS + """,
        words AS (
            SELECT p.mol_id, p.n_bits, g.w, coalesce(sum(CASE WHEN b.bit IS NOT NULL THEN CAST(power(2, 63 - b.bit % 64) AS HUGEINT) END), 0) AS word
            FROM pop p CROSS JOIN (SELECT unnest(range(32)) AS w) g
            LEFT JOIN bits b ON b.mol_id = p.mol_id AND b.bit // 64 = g.w
            GROUP BY p.mol_id, p.n_bits, g.w
        )
        SELECT mol_id, base64(unhex(string_agg(lpad(to_hex(CAST(word AS UBIGINT)), 16, '0'), '' ORDER BY w))) AS b64, CAST(n_bits AS INTEGER) AS n_bits
        FROM words GROUP BY mol_id, n_bits""",
    "key_pattern": """
        SELECT page_id, regexp_full_match(url, '.*/en/[0-9]+\\.html') AS matches,
               TRY_CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT) AS number
        FROM pages""",
    "source_lookup": "WITH " + _BITS + f"""
        SELECT mol_id, CAST(n_bits AS INTEGER) AS n_bits FROM pop
        WHERE mol_id IN ({_REQUESTED})""",
    "source_missing": "WITH " + _BITS + f"""
        SELECT mol_id FROM ({_REQUESTED}) r
        EXCEPT SELECT mol_id FROM pop""",
    "similarity_all_pairs": "WITH " + _pairs(_ITEMS) + "SELECT * FROM pairs",
    "similarity_above": "WITH " + _pairs(_ITEMS) + "SELECT source_id, target_id, CAST(score AS FLOAT) AS score FROM pairs WHERE score >= 0.2",
    "load_log_current": _newest("event_type, user_id", "ts DESC, event_id DESC"),
    "load_log_latest": _newest("event_type", "ts DESC, CAST(user_id AS VARCHAR) DESC, event_id DESC"),
})
