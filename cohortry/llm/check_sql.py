"""SQL for the operators that it can express, for DuckDB over the same tables."""

#: Checksum of a short ASCII text as a bigint expression: one step a bit, a character entering at every eighth.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(range(1, length({0}) + 1), lambda i: [ascii(substr({0}, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * 3988292384)))"""


def crc32(text: str) -> str:
    return _CRC32.format(text)


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


_PARTS = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]


def _tree(name: str, base: str) -> str:
    """Nodes of the trees over ``base`` (tree, idx, digest, n), and each node's siblings to the left and right."""
    return f"""
{name}_up(tree, lev, idx, digest, n) AS (
    SELECT tree, 0, idx, digest, n FROM {base}
    UNION ALL
    SELECT tree, lev + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM {name}_up WHERE n > 1 GROUP BY tree, lev, idx // 3, n
),
{name}_side AS MATERIALIZED (
    SELECT tree, lev, idx,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
        coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
    FROM {name}_up WHERE n > 1 WINDOW run AS (PARTITION BY tree, lev, idx // 3 ORDER BY idx)
),
{name}_top AS MATERIALIZED (SELECT tree, lev AS height, digest AS top FROM {name}_up WHERE n = 1)"""


def _walk(name: str, tree: str, start: str) -> str:
    """Way up from ``start`` (id, tree, idx, sibs, own) to the top of its tree."""
    return f"""
{name}(id, tree, lev, idx, sibs, own) AS (
    SELECT id, tree, 0, idx, sibs, own FROM {start}
    UNION ALL
    SELECT w.id, w.tree, w.lev + 1, w.idx // 3, w.sibs || s.lefts || s.rights, sha256(s.lefts || w.own || s.rights)
    FROM {name} w JOIN {tree}_side s ON w.tree = s.tree AND w.lev = s.lev AND w.idx = s.idx
)"""


OP13_MERKLE = f"""
WITH RECURSIVE made AS MATERIALIZED (
    SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        sha256({" || ".join(_PARTS)} || {_field("text")}) AS leaf,
        CASE WHEN doc_id IS NOT NULL AND {crc32("doc_id::varchar")} % 2 = 0
             THEN sha256({" || ".join(_PARTS)} || {_field("replace(text, chr(10), '')")}) END AS tampered
    FROM documents
),
leaves AS MATERIALIZED (
    SELECT row_number() OVER () AS id, doc_id, tree, leaf AS digest, coalesce(tampered, leaf) AS own, '' AS sibs,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n
    FROM made
),
{_tree("doc", "leaves")},
sources AS MATERIALIZED (SELECT 0 AS tree, tree AS idx, top AS digest, (SELECT count(*) FROM doc_top) AS n FROM doc_top),
{_tree("src", "sources")},
{_walk("way", "doc", "leaves")},
inside AS MATERIALIZED (SELECT w.id, 0 AS tree, w.tree AS idx, w.sibs, w.own FROM way w JOIN doc_top t ON w.tree = t.tree AND w.lev = t.height),
{_walk("above", "src", "inside")}
SELECT l.doc_id, l.digest AS leaf, d.top AS subroot, s.top AS root, sha256(a.sibs) AS proof_sha256, a.own AS folded_root, a.own = s.top AS verified, l.idx AS leaf_rank
FROM above a JOIN src_top s ON a.lev = s.height JOIN leaves l ON a.id = l.id JOIN doc_top d ON l.tree = d.tree
"""

_SPACE = r"[^\x20\x09-\x0D]"

OP12_CONVERSATIONS = rf"""
WITH RECURSIVE plain AS MATERIALIZED (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') AS key
    FROM conversations
),
coded AS MATERIALIZED (SELECT *, {crc32("key")} % 20 AS code FROM plain),
hurt AS (
    SELECT c, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM coded WHERE code <> 0
),
numbered AS MATERIALIZED (
    SELECT c, turn, role, text, substr(role, 1, 1) AS initial,
        row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
        lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS before,
        regexp_extract(text, '({_SPACE})[ 	-
]*$', 1) AS final_char
    FROM hurt
),
judged AS MATERIALIZED (
    SELECT *, CASE WHEN final_char = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN final_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM numbered
),
inserts(f, t, k) AS (VALUES (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
edits(f, t, edit, initial, price) AS (
    VALUES (0, 0, 'D', '', 2), (1, 1, 'D', '', 2), (2, 2, 'D', '', 2), (3, 3, 'D', '', 2),
        (0, 1, 'K', 's', 0), (0, 2, 'K', 'u', 0), (1, 2, 'K', 'u', 0), (2, 3, 'K', 'a', 0), (3, 2, 'K', 'u', 0),
        (0, 2, 'R', '', 1), (1, 2, 'R', '', 1), (2, 3, 'R', '', 1), (3, 2, 'R', '', 1)
),
moves AS MATERIALIZED (SELECT i.f, e.t, e.edit, e.initial, 5 * i.k + e.price AS price, repeat('I', i.k) || e.edit AS done FROM inserts i JOIN edits e ON i.t = e.f),
best(c, pos, state, cost, audit) AS (
    SELECT DISTINCT c, 0::bigint, 0, 0::bigint, '' FROM plain
    UNION ALL
    SELECT c, pos, state, least_way.cost, least_way.audit FROM (
        SELECT b.c, j.pos, m.t AS state,
            min({{'cost': b.cost + m.price + CASE WHEN j.fault = 'truncated' AND m.edit <> 'D' THEN 5 ELSE 0 END, 'audit': b.audit || m.done}}) AS least_way
        FROM best b JOIN judged j ON j.c = b.c AND j.pos = b.pos + 1
            JOIN moves m ON m.f = b.state AND (m.edit = 'D' OR (j.fault NOT IN ('blank', 'duplicate') AND (m.edit = 'R' OR m.initial = j.initial)))
        GROUP BY b.c, j.pos, m.t
    )
),
sized AS (SELECT p.c, any_value(p.conv_id) AS conv_id, coalesce(any_value(j.n), 0) AS n FROM plain p LEFT JOIN (SELECT c, count(*) AS n FROM judged GROUP BY c) j ON p.c = j.c GROUP BY p.c),
ended AS MATERIALIZED (
    SELECT s.c, s.conv_id, min({{'cost': b.cost + 5 * i.k, 'audit': b.audit || repeat('I', i.k)}}) AS way
    FROM sized s JOIN best b ON b.c = s.c AND b.pos = s.n JOIN inserts i ON i.f = b.state AND i.t IN (0, 3) GROUP BY s.c, s.conv_id
),
letters AS (SELECT c, unnest(string_split(way.audit, '')) AS edit, generate_subscripts(string_split(way.audit, ''), 1) AS nth FROM ended WHERE way.audit <> ''),
placed AS (
    SELECT c, edit, nth, sum((edit <> 'I')::int) OVER (PARTITION BY c ORDER BY nth) AS pos, sum((edit <> 'D')::int) OVER (PARTITION BY c ORDER BY nth) AS place FROM letters
),
put AS (SELECT p.c, p.place, p.edit, j.role, j.initial, j.text FROM placed p LEFT JOIN judged j ON p.c = j.c AND p.pos = j.pos AND p.edit <> 'I' WHERE p.edit <> 'D'),
shifted AS (SELECT *, max((place = 1 AND edit = 'K' AND initial = 's')::int) OVER (PARTITION BY c) AS led FROM put),
written AS (
    SELECT c, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY place)) AS digest
    FROM shifted GROUP BY c
),
counted AS (
    SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
        count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
        count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY c
)
SELECT e.conv_id, coalesce(k.gaps, 0) AS gaps, coalesce(k.blank, 0) AS blank, coalesce(k.duplicate, 0) AS duplicate, coalesce(k.truncated, 0) AS truncated,
    coalesce(k.illegal, 0) AS illegal, e.way.cost AS cost, e.way.audit AS audit, coalesce(w.digest, sha256('')) AS repaired_sha256
FROM ended e LEFT JOIN counted k ON e.c = k.c LEFT JOIN written w ON e.c = w.c
"""

SQL = {"op12_conversations": OP12_CONVERSATIONS, "op13_merkle": OP13_MERKLE}
