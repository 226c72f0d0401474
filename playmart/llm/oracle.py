"""Comparison SQL (DuckDB) of the numbered queries that SQL can express.

The patterns, class limits and control strings are fixed values, written out here as well, so that a
changed constant shows.
"""

WORDS = r"""list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
b AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (
    SELECT DISTINCT item_id, w[k:k + 9] AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k
          FROM b WHERE len(w) > 0) x),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
met AS (
    SELECT doc_id, k, n, item_id
    FROM (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes) y) z
    JOIN (SELECT item_id, array_to_string(g, ' ') AS g FROM win) v USING (g)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM met) x GROUP BY doc_id),
item AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met) x GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)"""


def _escaped(column: str) -> str:
    return (rf"regexp_replace({column}, '([<\[])(\\*)(\||/?s>|/?INST\])', "
            r"'\1\\\2\3', 'g')")


CHAT = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
c AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')
            AS learned,
        CAST(sum(24 + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT)
            AS formatted_chars
    FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars,
    sha256(learned) AS loss_sha256, formatted_chars
FROM c"""


def _base32(hexadecimal: str) -> str:
    """40 hexadecimal digits as four numbers of 40 bits, five bits a letter."""
    letters = []
    for group in range(4):
        number = f"CAST('0x' || substr({hexadecimal}, {10 * group + 1}, 10) AS BIGINT)"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
                    f"CAST(({number} >> {35 - 5 * k}) & 31 AS INT) + 1, 1)" for k in range(8)]
    return " || ".join(letters)


WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
o AS (SELECT html, max(page_id) AS original FROM p GROUP BY html),
x AS (SELECT page_id, html, original, sha1(html) AS h FROM p JOIN o USING (html))
SELECT page_id, strlen(html) AS payload_bytes, {_base32('h')} AS payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM x"""

# kind, pattern, group whose length counts, least length
BASE = (
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?"
               r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
CLASSES = (("entropy_hex", r"[0-9A-Fa-f]+", 3.0), ("entropy_base64", r"[A-Za-z0-9+/_=-]+", 3.93))
ALLOWED = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)^sha(1|256|384|512)[-_=]", r"(?i)(example|sample|placeholder|changeme|your_|dummy|xxxxx)",
    r"(?i)(abcdefghij|0123456789|1234567890|qwertyuiop)", r"^[0-9+/_=-]+$",
    r"^/", r"^[A-Za-z_-]+/[A-Za-z0-9_-]+/[A-Za-z0-9_/-]+$",
)


def _found(number: int, pattern: str, group: int, least: int) -> str:
    """Matches with their places: the lengths of what lies before them, and of those before."""
    return f"""
SELECT doc_id, {number} AS kind, s, start, start + length(s) AS stop, length(c) >= {least} AS ok
FROM (SELECT doc_id, unnest(m) AS s, unnest(c) AS c, CAST(unnest(list_transform(m, lambda x, i:
        list_sum(list_transform(g[1:i], lambda y: length(y)))
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0))) AS BIGINT) AS start
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS m,
                regexp_extract_all(t, '{pattern}', {group}) AS c,
                string_split_regex(t, '{pattern}') AS g FROM d) x) y"""


_ALL = " UNION ALL ".join(_found(k, p, g, n) for k, (_, p, g, n) in enumerate(BASE))
_RUNS = " UNION ALL ".join(
    _found(len(BASE) + k, p, 0, 20) for k, (_, p, _) in enumerate(CLASSES))
_NAMES = ", ".join(f"'{x[0]}'" for x in (*BASE, *CLASSES))
_LEAST = " ".join(f"WHEN {len(BASE) + k} THEN {x[2]}" for k, x in enumerate(CLASSES))
_NOT_ALLOWED = " AND ".join(f"NOT regexp_matches(s, '{x}')" for x in ALLOWED)

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, kind, start, stop FROM ({_ALL}) a WHERE ok),
run AS (SELECT doc_id, kind, s, start FROM ({_RUNS}) a WHERE ok AND {_NOT_ALLOWED}),
win AS (
    SELECT doc_id, kind, start + k - 1 AS start
    FROM (SELECT doc_id, kind, s, start, unnest(range(1, length(s) - 18)) AS k FROM run) x
    WHERE list_aggregate(string_split(s[k:k + 19], ''), 'entropy') >= CASE kind {_LEAST} END
        AND regexp_matches(s[k:k + 19], '[0-9]') AND regexp_matches(s[k:k + 19], '[A-Za-z]')),
island AS (
    SELECT *, sum(new) OVER (PARTITION BY doc_id, kind ORDER BY start) AS n
    FROM (SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id, kind ORDER BY start)
              <= 20 THEN 0 ELSE 1 END AS new FROM win) x),
span AS (
    SELECT doc_id, kind, start, stop FROM base
    UNION ALL
    SELECT doc_id, kind, min(start), max(start) + 20 FROM island GROUP BY doc_id, kind, n),
told AS (
    SELECT *, list_extract([{_NAMES}], kind + 1) || ':' || start || ':' || stop AS word FROM span),
per AS (
    SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
        count(*) FILTER (kind = 2) AS n_hex,
        string_agg(word, ',' ORDER BY start, kind) FILTER (kind < {len(BASE)}) AS base,
        string_agg(word, ',' ORDER BY start, kind) AS spans
    FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""

TRIE = """
WITH said AS (
    SELECT conv_id AS c, coalesce(text, '') AS x,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS t,
        turn
    FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
    SELECT c, list(t ORDER BY turn NULLS FIRST, t) AS ts, list(x ORDER BY turn NULLS FIRST, t) AS xs
    FROM said GROUP BY c),
crc AS (
    SELECT c, ts, xs, xor(list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''),
                                                 lambda s: CAST(ascii(s) AS BIGINT))),
        lambda a, b: list_reduce(
            [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) % 6 AS h
    FROM conv),
built AS (
    SELECT a.c, list_concat(coalesce(p.ts, [])[1:h], a.ts[h + 1:]) AS s,
        list_concat(coalesce(p.xs, [])[1:h], a.xs[h + 1:]) AS x
    FROM crc a LEFT JOIN conv p ON p.c = a.c - a.c % 100),
steps AS (SELECT c, s, x, unnest(range(0, len(s) + 1)) AS d FROM built),
nodes AS (
    SELECT s[1:d] AS node, d, min(c) AS least, count(*) AS n, max(coalesce(length(x[d]), 0)) AS chars,
        coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
    FROM steps GROUP BY ALL),
kids AS (SELECT node[1:d - 1] AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
own AS (
    SELECT n.*, coalesce(k, 0) AS k, (n - 1) * chars AS saves
    FROM nodes n LEFT JOIN kids USING (node)),
sums AS (
    SELECT node[1:u] AS node, sum(saves) AS saved, count(*) FILTER (k = 0) AS leaves
    FROM (SELECT node, saves, k, unnest(range(0, d + 1)) AS u FROM own) z GROUP BY 1)
SELECT o.least AS conv_id, o.d AS depth, p.least AS parent_conv_id, o.n AS n_convs,
    o.k AS n_children, s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
    sha256(o.ends) AS ends_sha256
FROM own o JOIN sums s USING (node)
LEFT JOIN nodes p ON o.d > 0 AND p.node = o.node[1:o.d - 1]"""

_USABLE = """embedding IS NOT NULL AND
    len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0"""

TOP_K = f"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings WHERE {_USABLE}),
scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

ORACLE_SQL = {
    "op2_decontaminate": DECONTAMINATE.strip(), "op3_chat": CHAT.strip(),
    "op5_secrets": SECRETS.strip(), "op9_warc": WARC.strip(),
    "op11_prefix_trie": TRIE,
    "op13_top_k": TOP_K,
}
