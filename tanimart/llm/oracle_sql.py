"""DuckDB SQL of the queries that SQL can express on whole tables.

The others (1, 2, 3, 5, 6, 8, 9, 11, 13, pipeline) need base32, CRC-32, approximate
search, edit distances, eigenvectors, a tokenizer or a trained model, or are too slow as SQL; tests
compare them with brute force, a round trip or held-out accuracy.
"""

from __future__ import annotations

from .chat import ASSISTANT_HEAD, END, USER_HEAD
from .queries import URL_RULES


def _text(value: str) -> str:
    return "'" + value.replace("\n", "' || chr(10) || '") + "'"


_CHAT = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS seq
    FROM conversations
),
people AS (SELECT DISTINCT conv_id, name AS participant FROM t),
r AS (
    SELECT t.conv_id, participant, turn, seq, name, words, name = participant AS own,
           CASE WHEN name = participant THEN {_text(ASSISTANT_HEAD)} ELSE {_text(USER_HEAD[0])} || name || {_text(USER_HEAD[1])} END AS head
    FROM t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
),
o AS (
    SELECT *, head || words || {_text(END)} AS rendered,
           CAST(coalesce(sum(length(head || words || {_text(END)})) OVER (
               PARTITION BY conv_id, participant ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS char_start
    FROM r
)
SELECT conv_id, participant, turn, seq, CASE WHEN own THEN 'assistant' ELSE 'user' END AS speaker_as, name, rendered,
       char_start, char_start + length(rendered) AS char_end,
       CASE WHEN own THEN char_start + length(head) END AS mask_start,
       CASE WHEN own THEN char_start + length(head) + length(words) END AS mask_end
FROM o"""


def _host(url: str) -> str:
    return f"translate(regexp_extract({url}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _path(url: str) -> str:
    return f"regexp_extract({url}, '://[^/?#]*([^?#]*)', 1)"


def _key(url: str) -> str:
    query = f"""list_sort(list_filter(string_split(regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1), '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)')))"""
    return f"""CASE WHEN {_host(url)} <> '' THEN regexp_replace({_host(url)}, '^www\\.', '') || regexp_replace({_path(url)}, '/+$', '')
        || CASE WHEN len({query}) > 0 THEN '?' || array_to_string({query}, '&') ELSE '' END END"""


_RULES = ", ".join(f"('{h}', '{p}', '{h + p}', '{v}')" for h, p, v in URL_RULES)

_URLS = f"""
WITH RECURSIVE rules(h, p, rule, verdict) AS (VALUES {_RULES}),
pages_at AS (
    SELECT page_id, coalesce({_host('url')}, '') AS host, coalesce({_path('url')}, '') AS path, {_key('url')} AS node, html,
           row_number() OVER () AS nth
    FROM pages
),
fits AS (
    SELECT nth, first(rule ORDER BY length(rule) DESC) AS rule, first(verdict ORDER BY length(rule) DESC) AS own
    FROM pages_at JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
    GROUP BY nth
),
targets AS (
    SELECT node AS a, unnest([
        regexp_extract(html, '<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical["'']?[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is'),
        regexp_extract(html, '<link\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)["'']?[^>]*\\brel\\s*=\\s*["'']?canonical\\b', 1, 'is'),
        regexp_extract(html, '<meta\\b[^>]*http-equiv\\s*=\\s*["'']?refresh["'']?[^>]*\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is')]) AS target
    FROM pages_at WHERE regexp_matches(html, 'canonical|refresh', 'i')
),
links AS (SELECT a, {_key('target')} AS b FROM targets WHERE target <> ''),
both_ways AS (SELECT a, b FROM links WHERE a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM links WHERE a IS NOT NULL AND b IS NOT NULL),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
classes AS (SELECT a AS node, least(a, min(b)) AS component FROM reach GROUP BY a),
judged AS (
    SELECT p.page_id, p.host, p.path, f.rule, f.own, coalesce(c.component, p.node) AS component
    FROM pages_at p LEFT JOIN fits f USING (nth) LEFT JOIN classes c ON c.node = p.node
),
votes AS (SELECT component, min(own) AS shared FROM judged WHERE component IS NOT NULL AND own IS NOT NULL GROUP BY component)
SELECT page_id, host, path, rule, coalesce(own, shared, 'allow') AS verdict, j.component AS alias_class
FROM judged j LEFT JOIN votes v ON v.component = j.component"""

_MIX = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rated AS (
    SELECT source, sqrt(n) / sum(sqrt(n)) OVER () * sum(n) OVER () / n AS rate FROM counts
),
pieces AS (SELECT source, greatest(1, CAST(ceil(rate / 500) AS INTEGER)) AS parts, rate / greatest(1, ceil(rate / 500)) AS mean FROM rated),
terms AS (
    SELECT source, mean, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 20) AS BIGINT) + 1)) AS k FROM pieces
),
cdf AS (
    SELECT source, k, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
),
drawn AS (
    SELECT d.*, nth, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS own, unnest(range(1, p.parts + 1)) AS piece
    FROM (SELECT *, row_number() OVER () AS nth FROM documents) d JOIN pieces p ON p.source IS NOT DISTINCT FROM d.source
),
uniform AS (
    SELECT *, (CAST('0x' || substr(md5('17:' || piece || ':' || own), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496 AS u
    FROM drawn
),
counted AS (
    SELECT u.nth, any_value(u.own) AS own, any_value(u.doc_id) AS doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source,
           any_value(u.n_chars) AS n_chars, count(*) AS copies
    FROM uniform u JOIN cdf ON cdf.source IS NOT DISTINCT FROM u.source AND cdf.c < u.u
    GROUP BY u.nth
),
copied AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, CAST(copies AS INTEGER) AS mix_copies, CAST(copy AS INTEGER) AS mix_copy,
       CAST('0x' || substr(md5('17/' || own || '/' || copy), 1, 13) AS BIGINT) AS mix_key
FROM copied"""

_GAP = "[\\x20\\x09-\\x0D]"
_WORD = "[^\\x20\\x09-\\x0D]"
_DRAW = "CAST('0x' || substr(digest, {}, 8) AS BIGINT)"

_FIM = f"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
           regexp_extract_all(coalesce(text, ''), '{_GAP}*{_WORD}+|{_GAP}+') AS tokens
    FROM documents
),
drawn AS (
    SELECT doc_id, text, tokens, CAST(len(tokens) AS BIGINT) AS n,
           {_DRAW.format(1)} % (len(tokens) + 1) AS a, {_DRAW.format(9)} % (len(tokens) + 1) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR {_DRAW.format(17)} % 100 >= 50 THEN 'plain'
                WHEN {_DRAW.format(25)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM t
),
parts AS (
    SELECT doc_id, text, n, form, array_to_string(tokens[:least(a, b)], '') AS prefix,
           array_to_string(tokens[least(a, b) + 1:greatest(a, b)], '') AS middle, array_to_string(tokens[greatest(a, b) + 1:], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts"""

ORACLE: dict[str, str] = {
    "op4_mix_poisson": _MIX,
    "op7_chat_perspectives": _CHAT,
    "op10_url_equivalence": _URLS,
    "op12_fim_wavelet": _FIM,
}
