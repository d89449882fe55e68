"""DuckDB SQL with the results of the queries that SQL can express."""

#: Words between ASCII white space.
WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
p AS (
    SELECT doc_id, w[i] AS w3,
        CASE WHEN i >= 2 THEN w[i - 1] END AS w2,
        CASE WHEN i >= 3 THEN w[i - 2] END AS w1
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
),
u AS (SELECT w3 AS a, count(*) AS n FROM p GROUP BY ALL),
b AS (SELECT w2 AS a, w3 AS b, count(*) AS n FROM p WHERE w2 IS NOT NULL GROUP BY ALL),
t AS (SELECT w1 AS a, w2 AS b, w3 AS c, count(*) AS n FROM p WHERE w1 IS NOT NULL GROUP BY ALL),
ou AS (SELECT doc_id, w3 AS a, count(*) AS n FROM p GROUP BY ALL),
ob AS (SELECT doc_id, w2 AS a, w3 AS b, count(*) AS n FROM p WHERE w2 IS NOT NULL GROUP BY ALL),
ot AS (SELECT doc_id, w1 AS a, w2 AS b, w3 AS c, count(*) AS n FROM p WHERE w1 IS NOT NULL GROUP BY ALL),
total AS (SELECT sum(len(w)) AS n FROM d),
x AS (
    SELECT p.doc_id,
        (p.w1 IS NOT NULL)::INT + (p.w2 IS NOT NULL)::INT AS steps,
        coalesce(t.n - ot.n, 0) AS c3,
        coalesce(b3.n - ob3.n, 0) AS c2, coalesce(b2.n - ob2.n, 0) AS c12,
        u3.n - ou3.n AS c1, coalesce(u2.n - ou2.n, 0) AS c02
    FROM p
    LEFT JOIN t ON (t.a, t.b, t.c) = (p.w1, p.w2, p.w3)
    LEFT JOIN ot ON ot.doc_id = p.doc_id AND (ot.a, ot.b, ot.c) = (p.w1, p.w2, p.w3)
    LEFT JOIN b b3 ON (b3.a, b3.b) = (p.w2, p.w3)
    LEFT JOIN ob ob3 ON ob3.doc_id = p.doc_id AND (ob3.a, ob3.b) = (p.w2, p.w3)
    LEFT JOIN b b2 ON (b2.a, b2.b) = (p.w1, p.w2)
    LEFT JOIN ob ob2 ON ob2.doc_id = p.doc_id AND (ob2.a, ob2.b) = (p.w1, p.w2)
    JOIN u u3 ON u3.a = p.w3
    JOIN ou ou3 ON ou3.doc_id = p.doc_id AND ou3.a = p.w3
    LEFT JOIN u u2 ON u2.a = p.w2
    LEFT JOIN ou ou2 ON ou2.doc_id = p.doc_id AND ou2.a = p.w2
),
s AS (
    SELECT doc_id,
        count(*) FILTER (WHERE c3 > 0) AS n3,
        count(*) FILTER (WHERE c3 <= 0 AND c2 > 0) AS n2,
        count(*) FILTER (WHERE c3 <= 0 AND c2 <= 0 AND c1 > 0) AS n1,
        count(*) FILTER (WHERE c3 <= 0 AND c2 <= 0 AND c1 <= 0) AS n0,
        sum(CASE WHEN c3 > 0 THEN ln(c3 / c12)
            WHEN c2 > 0 THEN ln(c2 / c02) + (steps - 1) * ln(0.4::DOUBLE)
            ELSE ln(greatest(c1, 1) / greatest(total.n - len(w), 1)) + steps * ln(0.4::DOUBLE) END) AS score
    FROM x JOIN d USING (doc_id), total GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n3, 0) AS n_trigrams, coalesce(n2, 0) AS n_bigrams,
    coalesce(n1, 0) AS n_unigrams, coalesce(n0, 0) AS n_unseen,
    CASE WHEN len(w) > 0 THEN round(score / len(w), 4) END AS mean_log_score
FROM d LEFT JOIN s USING (doc_id)
"""

BLANK = r"[\x20\x09-\x0D]"

OP2 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
raw AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM d),
l AS (
    SELECT doc_id, n, line, regexp_replace(line, '^{BLANK}+|{BLANK}+$', '', 'g') AS solid
    FROM raw
),
s AS (
    SELECT doc_id, n, solid, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k,
        len(regexp_extract_all(solid, '[^\x20\x09-\x0D]+')) AS words
    FROM l WHERE solid <> ''
),
equal AS (
    SELECT b.doc_id, b.k, b.words, a.doc_id AS other, b.k - a.k AS shift
    FROM s a JOIN s b ON a.solid = b.solid AND (a.doc_id < b.doc_id OR a.doc_id = b.doc_id AND a.k < b.k)
),
islands AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY k) AS island FROM equal),
run AS (SELECT doc_id, min(k) AS first, max(k) AS last FROM islands GROUP BY doc_id, other, shift, island HAVING sum(words) >= 50),
gone AS (SELECT DISTINCT s.doc_id, s.k, s.n FROM s JOIN run r ON r.doc_id = s.doc_id AND s.k BETWEEN r.first AND r.last),
runs AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < k - 1) AS n_runs
    FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id
),
kept AS (
    SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.n) AS kept
    FROM l ANTI JOIN gone ON gone.doc_id = l.doc_id AND gone.n = l.n GROUP BY l.doc_id
),
counts AS (SELECT doc_id, count(*) AS n_lines FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
    coalesce(n_runs, 0) AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP5 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
i AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
),
win AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS body
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM win),
spot AS (
    SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS body
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size)
),
hit AS (SELECT DISTINCT doc_id, k, spot.size, item_id FROM spot JOIN win ON win.body = spot.body AND win.size = spot.size),
words AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS spot FROM hit) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = rf"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '{BLANK}', '', 'g') AS plain
    FROM documents
),
r AS (
    SELECT doc_id, plain, count(*) OVER (PARTITION BY plain) AS group_size,
        first_value(doc_id) OVER (PARTITION BY plain ORDER BY points DESC, doc_id) AS keep_id
    FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM r
"""

#: A value as its length in bytes, a colon and its text; null as a dash.
FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
LEAF = " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}"))


def _tree(name: str, leaves: str) -> str:
    """The levels of the trees of all groups: l, g, pos, n, h."""
    return f"""{name} AS (
    SELECT 0 AS l, g, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n, h FROM {leaves}
    UNION ALL
    SELECT l + 1, g, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY l, g, pos // 3, n
)"""


def _steps(tree: str) -> str:
    """Siblings to the left and right of each leaf's node, level by level."""
    return f"""SELECT x.g, x.pos, s.l, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (WHERE s.pos < x.pos // (3 ** s.l)::BIGINT), '') AS a,
        coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (WHERE s.pos > x.pos // (3 ** s.l)::BIGINT), '') AS z
    FROM {tree} x JOIN {tree} s ON x.l = 0 AND s.g = x.g AND s.n > 1 AND s.pos // 3 = x.pos // (3 ** (s.l + 1))::BIGINT
    GROUP BY x.g, x.pos, s.l"""


OP11 = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, '+' || source AS s, sha256({LEAF.format("text")}) AS leaf, sha256({LEAF.format("replace(text, chr(10), '')")}) AS cut
    FROM documents
),
leaves AS (SELECT coalesce(s, '') AS g, doc_id AS k, leaf AS h FROM d),
{_tree("lower_t", "leaves")},
sources AS (SELECT '' AS g, g AS k, h FROM lower_t WHERE n = 1),
{_tree("upper_t", "sources")},
x AS (SELECT d.*, coalesce(s, '') AS g, row_number() OVER (PARTITION BY s ORDER BY doc_id) - 1 AS pos FROM d),
place AS (SELECT k AS g, row_number() OVER (ORDER BY k) - 1 AS top FROM sources),
steps AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY part, l) AS i, a, z FROM (
        SELECT doc_id, 0 AS part, l, a, z FROM x JOIN ({_steps("lower_t")}) q USING (g, pos)
        UNION ALL
        SELECT doc_id, 1 AS part, l, a, z FROM x JOIN place USING (g) JOIN ({_steps("upper_t")}) q ON q.pos = place.top
    )
),
crc AS (
    SELECT doc_id, 0 AS i, doc_id::VARCHAR AS t, 4294967295::BIGINT AS c FROM d WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT doc_id, i + 1, t, {{round}} FROM crc WHERE i < strlen(t)
),
odd AS (SELECT doc_id, xor(c, 4294967295) % 2 = 1 AS odd FROM crc WHERE i = strlen(t)),
fold AS (
    SELECT doc_id, 0 AS i, CASE WHEN odd.odd THEN leaf ELSE cut END AS h FROM d LEFT JOIN odd USING (doc_id)
    UNION ALL
    SELECT doc_id, s.i, sha256(s.a || h || s.z) FROM fold JOIN steps s USING (doc_id) WHERE s.i = fold.i + 1
),
folded AS (SELECT doc_id, arg_max(h, i) AS folded_root FROM fold GROUP BY doc_id),
proof AS (SELECT doc_id, string_agg(a || z, '' ORDER BY i) AS siblings FROM steps GROUP BY doc_id)
SELECT x.doc_id, leaf, t.h AS subroot, r.h AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root, folded_root = r.h AS verified
FROM x JOIN lower_t t ON t.g = x.g AND t.n = 1 JOIN upper_t r ON r.n = 1 JOIN folded USING (doc_id) LEFT JOIN proof USING (doc_id)
"""

#: One byte of CRC-32, bit by bit: the polynomial is a fixed value.
_byte = "xor(c, ascii(t[i + 1]))"
for _ in range(8):
    _byte = f"(SELECT CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END FROM (SELECT {_byte} AS b))"
OP11 = OP11.replace("{round}", _byte)

OP12 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
    SELECT *, min(page_id) OVER (PARTITION BY html) AS head,
        array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], '') AS digest
    FROM p
)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
    CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> head THEN head END AS refers_to
FROM b
"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product codes, a few common table expressions per round."""
    sql = [f"""WITH v AS MATERIALIZED (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS MATERIALIZED (
    SELECT vec_id, i // w AS part, i % w AS pos, q[i + 1] AS v FROM (SELECT vec_id, q, len(q) // {parts} AS w, unnest(range(len(q))) AS i FROM v)
),
c0 AS MATERIALIZED (
    SELECT part, entry, pos, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v) USING (vec_id)
    WHERE entry < {entries}
)"""]
    for r in range(rounds + 1):
        sql.append(f"""a{r} AS MATERIALIZED (
    SELECT vec_id, part, min(d * {entries} + entry) AS k FROM (
        SELECT vec_id, part, entry, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{r} c USING (part, pos) GROUP BY ALL
    ) GROUP BY ALL
)""")
        if r < rounds:
            sql.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT c.part, c.entry, c.pos, CASE WHEN n IS NULL THEN c.v ELSE (s - ((s % n) + n) % n) // n END AS v FROM c{r} c LEFT JOIN (
        SELECT part, k % {entries} AS entry, pos, sum(v) AS s, count(*) AS n FROM a{r} JOIN x USING (vec_id, part) GROUP BY ALL
    ) USING (part, entry, pos)
)""")
    return ",\n".join(sql) + f""",
coded AS (
    SELECT vec_id, string_agg(printf('%02x', (k % {entries})::INT), '' ORDER BY part) AS code, sum(k // {entries})::BIGINT AS error
    FROM a{rounds} GROUP BY vec_id
),
books AS (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN v USING (vec_id), books
"""


OP13 = _codes_sql()

ORACLE_SQL = {
    "op1_lm_scoring": OP1,
    "op2_line_dedup": OP2,
    "op5_decontamination": OP5,
    "op7_exact_dedup": OP7,
    "op11_merkle_manifest": OP11,
    "op12_warc": OP12,
    "op13_vector_codes": OP13,
}
