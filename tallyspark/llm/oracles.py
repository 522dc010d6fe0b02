"""DuckDB SQL with the results of the registered queries that SQL can express."""

from __future__ import annotations

from .chat import CHAT
from .lines import MIN_CHARS, MIN_DOCS
from .quality import RATES, RULES
from .queries import BLOCKED_HOSTS, URL_RULES

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in URL_RULES)
_HOSTS = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
_URLS = f"""
WITH p AS (
    SELECT row_number() OVER () AS rid, page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_LOWER}) AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(rhost, rpath, rverdict) AS (VALUES {_RULES}), b(bhost) AS (VALUES {_HOSTS}),
best AS (
    SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
           arg_max(rverdict, length(rhost || rpath)) AS rverdict
    FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid),
spam AS (SELECT DISTINCT rid FROM p JOIN b ON host = bhost OR ends_with(host, '.' || bhost))
SELECT page_id, host, path, rule,
       coalesce(rverdict, CASE WHEN spam.rid IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (rid) LEFT JOIN spam USING (rid)"""

_ESCAPES = r"len(regexp_extract_all({x}, '<\\*\|'))"
_ROLE = r"replace(replace(role, '\', '\\'), chr(10), '\n')"
_STEPS = " ".join(f"WHEN '{state}:{role}' THEN '{to}'" for state, rules in CHAT.order.items() for role, to in rules.items())
_STATE = (f"list_reduce(list_prepend('{CHAT.start}', roles), "
          f"lambda state, role: CASE state || ':' || role {_STEPS} ELSE 'error' END)")
_CHAT = f"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, n, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) x(n, role)),
c AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
           coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
           list(role ORDER BY turn NULLS FIRST, role, text) AS roles,
           sum(12 + length({_ROLE}) + {_ESCAPES.format(x=_ROLE)} + 1
               + length(text) + {_ESCAPES.format(x='text')} + 11) AS formatted_chars
    FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars, {_STATE} AS final_state,
       {_STATE} IN ({", ".join(f"'{a}'" for a in CHAT.accept)}) AS valid FROM c"""

_LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), {_LOWER}) AS key FROM l),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT rid) >= {MIN_DOCS}),
m AS (SELECT rid, doc_id, line, pos, often.key IS NOT NULL AND k.doc_id IS DISTINCT FROM keeper AS gone
      FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id"""

_SEARCH = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
      FROM e q JOIN e d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

_LEAST = " ".join(f"WHEN '{r}' THEN {RULES.least[r]}" for r in RATES)


def _limits(name: str, keys: str) -> str:
    """Fences of every (keys, rate) group of ``hist`` rows."""
    by = f"{keys}, rate" if keys else "rate"
    return f"""
{name}_c AS (SELECT {by}, bucket, sum(n) AS n FROM hist GROUP BY {by}, bucket),
{name}_r AS (SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto,
             sum(n) OVER (PARTITION BY {by}) AS total FROM {name}_c),
{name}_q AS (SELECT {by}, max(total) AS total, min(bucket) FILTER (4 * upto >= total) AS q1,
             min(bucket) FILTER (4 * upto >= 3 * total) AS q3 FROM {name}_r GROUP BY {by}),
{name} AS (SELECT {by}, total, q1 - {RULES.reach} * greatest(q3 - q1, CASE rate {_LEAST} END) AS low,
           q3 + {RULES.reach} * greatest(q3 - q1, CASE rate {_LEAST} END) AS high FROM {name}_q)"""


_QUALITY = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, i, w[i] || chr(32) || w[i + 1] || chr(32) || w[i + 2] AS gram
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY rid),
full_lines AS (SELECT rid, count(*) AS n, count(DISTINCT line) AS u
               FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
               WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
c AS (SELECT rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(f.n - f.u, 0) AS BIGINT) AS n_dup_lines, coalesce(f.n, 0) AS n_full,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN covered USING (rid) LEFT JOIN full_lines f USING (rid)),
j AS (SELECT *, n_words < {RULES.min_words} OR 100 * n_repeat_words > {RULES.max_repeat_percent} * n_words AS base_failed
      FROM c),
rated AS (SELECT rid, lang, source, base_failed, unnest([{', '.join(f"'{r}'" for r in RATES)}]) AS rate,
                 unnest([1000 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1),
                         1000 * n_dup_lines // greatest(n_full, 1), 1000 * n_repeat_words // greatest(n_words, 1)]) AS v
          FROM j WHERE NOT base_failed),
bits AS (SELECT *, greatest(length(bin(v)) - 7, 0) AS shift FROM rated),
hist AS (SELECT lang, source, rate, (v >> shift) << shift AS bucket, count(*) AS n FROM bits GROUP BY ALL),
{_limits('own', 'lang, source')},{_limits('by_lang', 'lang')},{_limits('overall', '')},
bad AS (SELECT DISTINCT rid FROM rated
        JOIN own ON rated.lang IS NOT DISTINCT FROM own.lang AND rated.source IS NOT DISTINCT FROM own.source
                 AND rated.rate = own.rate
        JOIN by_lang ON rated.lang IS NOT DISTINCT FROM by_lang.lang AND rated.rate = by_lang.rate
        JOIN overall ON rated.rate = overall.rate
        WHERE v > CASE WHEN own.total >= {RULES.min_group} THEN least(own.high, by_lang.high)
                       WHEN by_lang.total >= {RULES.min_group} THEN by_lang.high ELSE overall.high END
           OR (rated.rate = 'word_length' AND v < CASE WHEN own.total >= {RULES.min_group} THEN greatest(own.low, by_lang.low)
                       WHEN by_lang.total >= {RULES.min_group} THEN by_lang.low ELSE overall.low END))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND bad.rid IS NULL AS kept FROM j LEFT JOIN bad USING (rid)"""

_TRIE = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, role, text) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), hashed AS (
  -- CRC-32 bit by bit: each byte of the decimal id, then eight shifts (-1)
  SELECT conv_id, own, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END)) % 6 AS h
  FROM turns
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS path
  FROM hashed c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, d AS depth, len(path) AS size, path[1:d] AS node, path[1:d - 1] AS above
  FROM (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         CASE WHEN depth > 0 THEN (count(*) - 1) * length(node[depth].text) ELSE 0 END AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT node[1:a] AS node, a AS depth, sum(saved) AS saved_tokens, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM (SELECT n.node, n.depth, n.saved, c.n_children, unnest(range(n.depth + 1)) AS a
        FROM nodes n LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.depth = n.depth AND b.node = n.node
LEFT JOIN children c ON c.depth = n.depth AND c.node = n.node
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]"""

ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": _URLS,
    "op3_quality_rules": _QUALITY,
    "op5_chat_formatting": _CHAT,
    "op8_line_dedup": _LINES,
    "op9_exact_top_k": _SEARCH,
    "op13_conversation_prefix_trie": _TRIE,
}
