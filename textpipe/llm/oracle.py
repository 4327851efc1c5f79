"""DuckDB SQL for the queries that SQL can express.

Without SQL are what a classifier has learned (1, 4), what is hashed, embedded or permuted by
functions that DuckDB lacks (2, 6, 9, 10), and what tokenizers and a genetic algorithm make (8, 12).
Tests hold these against brute force.
"""

from __future__ import annotations

from textpipe.llm.line_dedup import Rule
from textpipe.llm.merkle import FIELDS
from textpipe.llm.phrases import Mining
from textpipe.llm.queries import URL_RULES
from textpipe.llm.url_filter import Tree
from textpipe.llm.warc import LEAST_BYTES

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WARC = f"""
WITH pages_read AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (
    SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
        max(page_id) OVER (PARTITION BY sha1(payload)) AS original
    FROM pages_read
), resolved AS (
    SELECT *, payload_bytes >= {LEAST_BYTES} AND page_id IS DISTINCT FROM original
        AND original IS NOT NULL AS repeats
    FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN repeats THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN repeats THEN original END AS refers_to
FROM resolved
"""


def line_dedup_sql(rule: Rule = Rule()) -> str:
    """All pairs of different lines whose lengths are near, by edit distance.

    DuckDB's distance counts bytes, so the letters beyond ASCII are first replaced by control
    characters.
    """
    return f"""
WITH split AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
    FROM documents
), lines AS (
    SELECT doc_id, line, pos::INTEGER AS pos FROM split WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), odd AS (
    SELECT DISTINCT unnest(regexp_extract_all(line, '[^\\x00-\\x7F]')) AS letter FROM lines
), numbered AS (
    SELECT letter, row_number() OVER (ORDER BY letter)::INTEGER AS k FROM odd
), letters AS (
    SELECT coalesce(string_agg(letter, '' ORDER BY letter), '') AS old,
        coalesce(string_agg(chr(CASE WHEN k <= 8 THEN k ELSE k + 5 END), '' ORDER BY letter), '') AS new
    FROM numbered
), classes AS (
    SELECT line, length(line) AS size, translate(line, any_value(old), any_value(new)) AS plain,
        min({{'doc': doc_id, 'pos': pos}}) AS first
    FROM lines, letters GROUP BY line
), near AS (
    SELECT *, unnest(range(size - {rule.max_edits}, size + {rule.max_edits + 1})) AS other_size FROM classes
), links AS (
    SELECT a.line, count(*) AS n_links, min(b.first) AS earliest
    FROM near a JOIN classes b ON b.size = a.other_size
    WHERE a.line <> b.line
        AND levenshtein(a.plain, b.plain) <= least({rule.max_edits}, least(a.size, b.size) // {rule.per_edit})
    GROUP BY a.line
)
SELECT doc_id, pos AS line, c.first.doc AS first_doc, c.first.pos AS first_line,
    coalesce(n_links, 0) AS n_links,
    c.first = {{'doc': doc_id, 'pos': pos}} AND (earliest IS NULL OR earliest > c.first) AS kept
FROM lines l JOIN classes c ON c.line = l.line LEFT JOIN links k ON k.line = l.line
"""


def url_filter_sql(rules: list[tuple[str, str, str]], how: Tree = Tree(), levels: int = 4) -> str:
    """The tree of templates, one group of tables for each level; ``levels`` must be as many as the
    paths have."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    said, found = ["CASE"], ["CASE"]
    for host, path, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        found.append(f"WHEN {fits} THEN '{host}{path}'")
        said.append(f"WHEN {fits} THEN '{verdict}'")
    s = how.smoothing
    parts = [
        f"""
parts AS (
    SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
            '{upper}', '{upper.lower()}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, {" ".join(found)} END AS rule, {" ".join(said)} END AS said FROM parts
), urls AS (
    SELECT *, said = 'block' AS blocked, list_filter(string_split(path, '/'), lambda x: x <> '') AS segments
    FROM ruled
), prior AS (
    SELECT CASE WHEN count(blocked) > 0 THEN count(*) FILTER (blocked) / count(blocked) ELSE 0 END AS p FROM urls
), nodes0 AS (
    SELECT host AS node, (count(*) FILTER (blocked) + {s} * any_value(p)) / (count(blocked) + {s}) AS purity
    FROM urls, prior GROUP BY host
), at0 AS (
    SELECT urls.*, host AS node, purity FROM urls JOIN nodes0 ON node = host
)"""
    ]
    for k in range(levels):
        parts.append(
            f"""
totals{k} AS (
    SELECT node, count(*) AS urls, count(blocked) AS n, count(*) FILTER (blocked) AS block, any_value(purity) AS purity
    FROM at{k} WHERE len(segments) > {k} GROUP BY node HAVING count(*) >= {how.support}
), counts{k} AS (
    SELECT a.node, segments[{k + 1}] AS segment, count(*) AS urls, count(blocked) AS n,
        count(*) FILTER (blocked) AS block
    FROM at{k} a JOIN totals{k} t ON t.node = a.node WHERE len(segments) > {k} GROUP BY a.node, segments[{k + 1}], t.urls
    HAVING count(*) >= {how.support} AND count(*) >= {how.share} * t.urls
), rated{k} AS (
    SELECT *, CASE WHEN n > 0 THEN block / n END AS rate FROM counts{k}
), lagged{k} AS (
    SELECT *, lag(rate) OVER w AS last_rate, lag(n) OVER w AS last_n
    FROM rated{k} WINDOW w AS (PARTITION BY node, n > 0 ORDER BY rate, segment)
), pooled{k} AS (
    SELECT *, (rate * n + last_rate * last_n) / (n + last_n) AS pool FROM lagged{k}
), apart{k} AS (
    SELECT *, CASE WHEN rate - last_rate > {how.similar} * sqrt(pool * (1 - pool) * (1 / n + 1 / last_n))
        THEN 1 ELSE 0 END AS apart
    FROM pooled{k}
), numbered{k} AS (
    SELECT *, CASE WHEN n > 0
        THEN (sum(apart) OVER (PARTITION BY node, n > 0 ORDER BY rate, segment))::VARCHAR
        ELSE '/' || segment END AS number
    FROM apart{k}
), sets{k} AS (
    SELECT node, sum(urls) AS urls, sum(n) AS n, sum(block) AS block, list(segment) AS members,
        string_agg(regexp_replace(segment, '([*{{|}}\\\\])', '\\\\\\1', 'g'), '|'
            ORDER BY regexp_replace(segment, '([*{{|}}\\\\])', '\\\\\\1', 'g')) AS name
    FROM numbered{k} GROUP BY node, number
), taken{k} AS (
    SELECT node, sum(urls) AS urls, sum(n) AS n, sum(block) AS block FROM sets{k} GROUP BY node
), branches{k} AS (
    SELECT node, n, block, members, CASE WHEN len(members) > 1 THEN '{{' || name || '}}' ELSE name END AS name
    FROM sets{k}
    UNION ALL
    SELECT t.node, t.n - coalesce(s.n, 0), t.block - coalesce(s.block, 0), NULL, '*'
    FROM totals{k} t LEFT JOIN taken{k} s ON s.node = t.node WHERE t.urls > coalesce(s.urls, 0)
), judged{k} AS (
    SELECT b.node, members, b.node || '/' || name AS child,
        (b.block + {s} * t.purity) / (b.n + {s}) AS child_purity
    FROM branches{k} b JOIN totals{k} t ON t.node = b.node
), literal{k} AS (
    SELECT node, unnest(members) AS segment, child, child_purity FROM judged{k} WHERE members IS NOT NULL
), wild{k} AS (
    SELECT node, child, child_purity FROM judged{k} WHERE members IS NULL
), at{k + 1} AS (
    SELECT a.* EXCLUDE (node, purity),
        CASE WHEN len(segments) <= {k} THEN a.node ELSE coalesce(l.child, w.child, a.node) END AS node,
        CASE WHEN len(segments) <= {k} THEN a.purity ELSE coalesce(l.child_purity, w.child_purity, a.purity) END
            AS purity
    FROM (SELECT * FROM at{k} WHERE len(segments) > {k}) a
    LEFT JOIN literal{k} l ON l.node = a.node AND l.segment = a.segments[{k + 1}]
    LEFT JOIN wild{k} w ON w.node = a.node
    UNION ALL
    SELECT * EXCLUDE (node, purity), node, purity FROM at{k} WHERE len(segments) <= {k}
)"""
        )
    return (
        "WITH "
        + ",".join(parts)
        + f"""
SELECT page_id, host, path, rule,
    coalesce(said, CASE WHEN purity >= {how.reject} THEN 'block' ELSE 'allow' END) AS verdict,
    node AS template, round(purity, 6) AS purity
FROM at{levels}
"""
    )


MERKLE = """
WITH RECURSIVE rows_of AS (
    SELECT doc_id, coalesce('+' || lang, '') AS tree,
        sha256(concat(
            {leaf})) AS leaf,
        sha256(concat(
            {shown})) AS shown
    FROM (SELECT *, CASE WHEN crc % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS shown_chars
          FROM (SELECT *, {crc} AS crc FROM documents))
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_of
), lower_nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS n FROM numbered
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 2
), subroots AS (
    SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
    FROM lower_nodes WHERE n = 1
), upper_nodes AS (
    SELECT 0 AS level, pos, subroot AS d, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2
), steps AS (
    SELECT doc_id, tree, leaf, shown, x.pos AS start, l.level, x.pos >> l.level AS pos, o.d AS sibling
    FROM numbered x JOIN (SELECT DISTINCT tree, level FROM lower_nodes WHERE n > 1) l USING (tree)
    LEFT JOIN lower_nodes o ON o.tree = x.tree AND o.level = l.level AND o.pos = xor(x.pos >> l.level, 1)
), upper_steps AS (
    SELECT tree, l.level, s.pos >> l.level AS pos, o.d AS sibling
    FROM subroots s, (SELECT DISTINCT level FROM upper_nodes WHERE n > 1) l
    LEFT JOIN upper_nodes o ON o.level = l.level AND o.pos = xor(s.pos >> l.level, 1)
), every AS (
    SELECT tree, start, level, pos, sibling FROM steps
    UNION ALL
    SELECT u.tree, x.pos, 1000 + u.level, u.pos, u.sibling FROM upper_steps u JOIN numbered x USING (tree)
), ways AS (
    SELECT tree, start, list({{'pos': pos, 'sibling': sibling}} ORDER BY level) AS way,
        sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256
    FROM every GROUP BY tree, start
), folds AS (
    SELECT tree, pos AS start, 1 AS k, shown AS d FROM numbered
    UNION ALL
    SELECT f.tree, f.start, k + 1, sha256(CASE WHEN way[k].sibling IS NULL THEN d
        WHEN way[k].pos % 2 = 1 THEN way[k].sibling || d ELSE d || way[k].sibling END)
    FROM folds f JOIN ways w ON w.tree = f.tree AND w.start = f.start WHERE k <= len(way)
), last_folds AS (
    SELECT tree, start, arg_max(d, k) AS folded_root FROM folds GROUP BY tree, start
)
SELECT doc_id, leaf, subroot, r.d AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
    folded_root = r.d AS verified
FROM numbered x JOIN subroots s USING (tree) JOIN last_folds l ON l.tree = x.tree AND l.start = x.pos
LEFT JOIN ways w ON w.tree = x.tree AND w.start = x.pos,
    (SELECT d FROM upper_nodes WHERE n = 1) r
"""


def merkle_sql(fields: tuple[str, ...] = FIELDS) -> str:
    """The trees level by level. DuckDB has no CRC-32, so it is worked out bit by bit."""

    def leaf(names: tuple[str, ...]) -> str:
        parts = [f"coalesce(strlen({n}::VARCHAR)::VARCHAR || ':' || {n}::VARCHAR, '-')" for n in names]
        return ",\n            ".join(parts)

    bit = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    octet = f"list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, y: {bit})"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda p, q: {octet.replace('[x,', '[xor(p, q),')}), 4294967295)"
    shown = tuple("shown_chars" if f == "n_chars" else f for f in fields)
    return MERKLE.format(leaf=leaf(fields), shown=leaf(shown), crc=crc)


PHRASES = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut
), grams AS (
    SELECT lang, w[i : i + k - 1] AS words, k FROM places, range(1, {Mining().longest + 1}) AS lengths(k)
    WHERE i + k - 1 <= len(w)
), f AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, any_value(words) AS words, k, count(*) AS f
    FROM grams GROUP BY lang, array_to_string(words, ' '), k HAVING count(*) >= {Mining().least}
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang
), cuts AS (
    SELECT c.lang, c.phrase, c.words, c.k, c.f AS a, h.f AS l, t.f AS r, n, x.j,
        (1000::HUGEINT * c.f * n) // (h.f::HUGEINT * t.f) AS score
    FROM f c JOIN range(1, {Mining().longest}) AS x(j) ON x.j < c.k
    JOIN f h ON h.lang = c.lang AND h.phrase = array_to_string(c.words[1 : x.j], ' ')
    JOIN f t ON t.lang = c.lang AND t.phrase = array_to_string(c.words[x.j + 1 : c.k], ' ')
    JOIN totals o ON o.lang = c.lang
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
    SELECT * FROM lowest c WHERE NOT EXISTS (
        SELECT 1 FROM f b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.f >= 100 * c.a
            AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
    )
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {Mining().top}
"""


ORACLE: dict[str, str] = {
    "op3_url_filter": url_filter_sql(URL_RULES),
    "op5_line_dedup": line_dedup_sql(),
    "op7_warc": WARC,
    "op11_merkle": merkle_sql(),
    "op13_phrases": PHRASES,
}
