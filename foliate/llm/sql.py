"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

import string

from foliate.llm import centroids, chat, decontaminate, line_dedup, prefix_trie, url_filters

_LOWER = f"translate(coalesce(CAST(text AS VARCHAR), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_MATCH_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: Runs of lines as lists: of all line runs, the shortest with enough words from each start and to each end; those that occur twice mark their later places.
LINE_DEDUP = rf"""
WITH docs AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS d
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), pieces AS (
  SELECT d, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS spot
  FROM docs WHERE text IS NOT NULL
), counted AS (
  SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM pieces
), lines AS (
  SELECT d, spot, line, words, row_number() OVER w AS s, sum(words) OVER w AS total
  FROM counted WHERE words > 0 WINDOW w AS (PARTITION BY d ORDER BY spot)
), around AS (
  SELECT d, s, total, total - words AS before,
    list(line) OVER ahead AS next_lines, list(total) OVER ahead AS next_totals,
    list(line) OVER back AS last_lines, list(total - words) OVER back AS last_befores
  FROM lines
  WINDOW ahead AS (PARTITION BY d ORDER BY s ROWS BETWEEN CURRENT ROW AND {line_dedup.LineRules.min_words - 1} FOLLOWING),
    back AS (PARTITION BY d ORDER BY s ROWS BETWEEN {line_dedup.LineRules.min_words - 1} PRECEDING AND CURRENT ROW)
), sized AS (
  SELECT *, 1 + len([x FOR x IN next_totals IF x - before < {line_dedup.LineRules.min_words}]) AS forward,
    1 + len([x FOR x IN last_befores IF total - x < {line_dedup.LineRules.min_words}]) AS backward
  FROM around
), runs AS (
  SELECT d, s, forward AS q, list_slice(next_lines, 1, forward) AS run FROM sized WHERE forward <= len(next_lines)
  UNION
  SELECT d, s - backward + 1, backward, list_slice(last_lines, len(last_lines) - backward + 1, len(last_lines)) FROM sized WHERE backward <= len(last_lines)
), firsts AS (
  SELECT run, min((d, s)) AS place FROM runs GROUP BY run HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT d, unnest(range(s, s + q)) AS s FROM runs JOIN firsts USING (run) WHERE (d, s) <> place
), kept AS (
  SELECT c.d, coalesce(string_agg(c.line, chr(10) ORDER BY c.spot) FILTER (g.s IS NULL), '') AS text, count(l.s) AS n_lines, count(g.s) AS n_removed
  FROM counted c LEFT JOIN lines l ON l.d = c.d AND l.spot = c.spot LEFT JOIN gone g ON g.d = l.d AND g.s = l.s
  GROUP BY c.d
)
SELECT o.doc_id, k.text, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents o JOIN docs ON o.doc_id IS NOT DISTINCT FROM docs.doc_id AND o.text IS NOT DISTINCT FROM docs.text LEFT JOIN kept k ON k.d = docs.d
"""

_CONTROL = r"'<(\\*)\|', '<\1\\|', 'g'"

CHAT_FORMATTING = rf"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.END}{chat.START}assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '{chat.END}{chat.START}assistant ok'
), numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), text NULLS FIRST) AS n
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = '{chat.TRAINED_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = '{chat.TRAINED_ROLE}'), '')) AS loss_sha256,
  CAST(sum(length('{chat.START}{chat.END}') + 2 + length(regexp_replace(text, {_CONTROL}))
    + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), {_CONTROL}))) AS BIGINT) AS formatted_chars
FROM numbered GROUP BY conv_id
"""

#: Windows as lists of words, matched by a join; places on one diagonal that follow each other make a longer match.
DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_MATCH_WORDS} AS w FROM documents
), items AS (
  SELECT row_number() OVER () AS i, coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_MATCH_WORDS} AS w FROM benchmark
), item_words AS (
  SELECT i, item_id, least(len(w), {decontaminate.WINDOW}) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM items
), item_ahead AS (
  SELECT i, item_id, n, j, list(word) OVER (PARTITION BY i ORDER BY j ROWS BETWEEN CURRENT ROW AND {decontaminate.WINDOW - 1} FOLLOWING) AS ahead FROM item_words
), windows AS (
  SELECT i, item_id, n, j, ahead AS win FROM item_ahead WHERE len(ahead) = n
), doc_words AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs
), doc_ahead AS (
  SELECT r, p, list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {decontaminate.WINDOW - 1} FOLLOWING) AS ahead FROM doc_words
), doc_windows AS (
  SELECT r, p, list_slice(ahead, 1, n) AS win FROM doc_ahead, (SELECT DISTINCT n FROM windows) WHERE len(ahead) >= n
), found AS (
  SELECT r, p, i, item_id, j, n FROM doc_windows JOIN windows USING (win)
), hit AS (
  SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS spot FROM found) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256 FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r
), islands AS (
  SELECT *, p - row_number() OVER (PARTITION BY r, i, p - j ORDER BY p) AS island FROM found
), stretches AS (
  SELECT r, i, item_id, min(p) AS p, min(j) AS j, min(n) + count(*) - 1 AS longest FROM islands GROUP BY r, i, item_id, p - j, island
), best AS (
  SELECT * FROM stretches QUALIFY row_number() OVER (PARTITION BY r ORDER BY longest DESC, p, item_id, j) = 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(longest, 0) AS longest_match, coalesce(p, 0) - 1 AS match_at, item_id AS match_item, coalesce(j, 0) - 1 AS match_item_at
FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN best USING (r)
"""


def _centroid_sql() -> str:
    """Rounds as materialized steps: nearest centroid by squared distance, then the floor of each mean."""
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v, embedding
  FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {centroids.DIMENSIONS}
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, embedding) - 1 AS INTEGER) AS k, v AS c
  FROM kept QUALIFY k < {centroids.CLUSTERS}
)""",
    ]
    for i in range(centroids.ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT r, k, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)]) AS BIGINT) AS d FROM kept, c{i}) GROUP BY r
)""")
        if i < centroids.ROUNDS:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
    SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m
    FROM (SELECT k, j, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM kept JOIN a{i} USING (r)) GROUP BY k, j)
    GROUP BY k) USING (k)
)""")
    last = centroids.ROUNDS
    return "WITH " + ", ".join(ctes) + f"""
SELECT vec_id, k AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN c{last} USING (k)
"""


CENTROIDS = _centroid_sql()

#: CRC-32 bit by bit over the digits of an id; the polynomial is a fixed value.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda a, x: list_reduce(list_prepend(xor(a, x), [CAST(i AS BIGINT) FOR i IN range(8)]), lambda b, i: xor(b >> 1, (b & 1) * 3988292384))), 4294967295)"""

#: Nodes as lists of turns; a subtree is what the members of a node pass through below it.
PREFIX_TRIE = f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n,
    struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - ((conv_id % {prefix_trie.FAMILY}) + {prefix_trie.FAMILY}) % {prefix_trie.FAMILY} AS first, {_CRC} % {prefix_trie.HEADS} AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
  SELECT c.conv_id, 0 AS part, n, turn FROM convs c JOIN turns t ON t.conv_id = c.first AND n <= h
  UNION ALL SELECT c.conv_id, 1, n, turn FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND n > h
), whole AS (
  SELECT conv_id, coalesce(turns, []) AS turns FROM convs LEFT JOIN (SELECT conv_id, list(turn ORDER BY part, n) AS turns FROM rebuilt GROUP BY conv_id) USING (conv_id)
), passed AS (
  SELECT conv_id, depth, list_slice(turns, 1, depth) AS prefix, depth = len(turns) AS ended FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM whole)
), nodes AS (
  SELECT row_number() OVER () AS id, prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(octet_length(encode(prefix[depth].t)), 0) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
  FROM passed GROUP BY prefix, depth
), places AS (
  SELECT p.conv_id, n.id, n.depth FROM passed p JOIN nodes n USING (prefix, depth)
), edges AS (
  SELECT DISTINCT above.id AS parent, below.id AS child FROM places above JOIN places below ON above.conv_id = below.conv_id AND below.depth = above.depth + 1
), children AS (
  SELECT parent AS id, count(*) AS n_children FROM edges GROUP BY parent
), facts AS (
  SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN children USING (id)
), subtrees AS (
  SELECT top, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens
  FROM (SELECT DISTINCT above.id AS top, below.id AS id FROM places above JOIN places below ON above.conv_id = below.conv_id AND below.depth >= above.depth) JOIN facts USING (id)
  GROUP BY top
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.kids AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM facts f JOIN subtrees s ON s.top = f.id LEFT JOIN edges e ON e.child = f.id LEFT JOIN nodes p ON p.id = e.parent
"""


def _pattern_sql(rule: url_filters.Rule) -> str:
    """A pattern for RE2, which needs no promise to stay linear."""
    source = rule.regex.pattern.replace("(?>", "(?:").replace(r"\Z", r"\z").replace(r"\x80-\U0010FFFF", r"\x{80}-\x{10FFFF}")
    return "regexp_matches(lowered, '^(?s:" + source.replace("'", "''") + ")')"


def _host_sql(rule: url_filters.Rule) -> str:
    host, slash, rest = rule.text.partition("/")
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + rest}')"


def _url_sql() -> str:
    ordered = sorted(url_filters.RULES, key=url_filters.Rule.strength)
    tests = "\n".join(f"    WHEN {_host_sql(r) if r.host_path else _pattern_sql(r)} THEN {i}" for i, r in enumerate(ordered, 1))
    listed = ", ".join(f"({i}, '{r.text}', '{r.action}', {r.host_path})" for i, r in enumerate(ordered, 1))
    lower = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS address FROM pages
), parts AS (
  SELECT page_id, address, regexp_extract(address, '^[^/?#]*') AS raw FROM cut
), split AS (
  SELECT page_id, translate(raw, {lower}) AS host, regexp_extract(substr(address, length(raw) + 1), '^[^?#]*') AS path, translate(address, {lower}) AS lowered FROM parts
), judged AS (
  SELECT page_id, host, path, CASE WHEN lowered = '' THEN 0
{tests}
    ELSE 0 END AS no
  FROM split
), rules(no, text, action, host_path) AS (VALUES {listed})
SELECT page_id, host, path, CASE WHEN host_path THEN text END AS rule, coalesce(action, '{url_filters.ALLOW}') AS verdict, CASE WHEN NOT host_path THEN text END AS pattern
FROM judged LEFT JOIN rules USING (no)
"""


URL_FILTERS = _url_sql()
