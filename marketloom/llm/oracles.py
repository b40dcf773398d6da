"""SQL of the registered queries that SQL can express, for an engine with list functions."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
ALPHANUMERIC = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(pattern: str, lower: bool = True) -> str:
    text = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')" if lower else "coalesce(text, '')"
    return f"regexp_extract_all({text}, '{pattern}')"


SUBSTRING_DEDUP = f"""
WITH w AS (SELECT doc_id, {words(SPACED, False)} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS win FROM w, generate_series(1, len(w) - 34) AS t(i)),
repeated AS (SELECT md5(win) AS m FROM windows GROUP BY md5(win) HAVING count(*) > 1),
covered AS (
    SELECT DISTINCT doc_id, p FROM windows JOIN repeated ON md5(win) = m, generate_series(i, i + 34) AS t(p)
),
cut AS (SELECT doc_id, list(p) AS gone FROM covered GROUP BY doc_id),
kept AS (
    SELECT w.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
           CASE WHEN gone IS NULL THEN w ELSE list_select(w, list_sort(list_filter(range(1, len(w) + 1), lambda x: NOT list_contains(gone, x)))) END AS k
    FROM w LEFT JOIN cut USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256
FROM kept
"""

NEAR_DEDUP = f"""
WITH RECURSIVE w AS (SELECT doc_id, {words(SPACED)} AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
    FROM w, generate_series(1, greatest(len(w) - 2, 1)) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT x, y FROM common JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
    WHERE 100 * c >= 85 * (p.n + q.n - c)
),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, both_ways.y FROM reach JOIN both_ways ON reach.b = both_ways.x
),
named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id JOIN named ON named.a = d.doc_id
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {words(ALPHANUMERIC)} AS w FROM documents),
b AS (SELECT item_id, {words(ALPHANUMERIC)} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + 12], ' ') AS win
    FROM b, generate_series(1, greatest(len(w) - 12, 1)) AS t(i) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT k FROM windows),
spans AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS win FROM d, lengths, generate_series(1, len(w) - k + 1) AS t(i)
),
found AS (SELECT doc_id, item_id, i, spans.k AS k FROM spans JOIN windows USING (win, k)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, generate_series(i, i + k - 1) AS t(p) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def licenses() -> str:
    """Every window of the scan's grid, compared with every template of its length."""
    from marketloom.llm import licenses as L

    rows = []
    for name, text in L.TEMPLATES.items():
        w = L.template_words(text)
        window, stride = L.geometry(len(w))
        shingles = ", ".join(f"'{s}'" for s in L._shingles(w))
        rows.append(f"('{name}', {window}, {stride}, [{shingles}])")
    return f"""
    WITH t(license, win, stride, wanted) AS (VALUES {", ".join(rows)}),
    d AS (SELECT doc_id, {words(r"[a-z0-9\x{80}-\x{10FFFF}]+")} AS w FROM documents),
    grid AS (
        SELECT doc_id, license, i, wanted, w[i + 1:i + win] AS x
        FROM d, t, generate_series(0, greatest(len(w) - win + stride - 1, 0), stride) AS g(i) WHERE len(w) >= 2
    ),
    found AS (
        SELECT doc_id, license, i, len(list_filter(wanted, lambda s: list_contains(
            list_transform(range(1, len(x)), lambda j: x[j] || ' ' || x[j + 1]), s))) / len(wanted) AS containment
        FROM grid
    )
    SELECT doc_id, license, count(*) AS n_windows, max(containment) AS containment, min(i) AS first_word
    FROM found WHERE containment >= 0.8 GROUP BY ALL
    """


LICENSES = licenses()


def mixing(fills: int = 3) -> str:
    """Water filling by sorted limits; budgets filled in the order of the hash, again and again with what is left."""
    passes = []
    for i in range(fills + 1):
        rows = "sizes JOIN aims USING (k)" if not i else f"left_{i - 1}"
        need = "need" if not i else "rest"
        passes.append(f"""
        run_{i} AS (
            SELECT row_id, k, hash, size, {need} AS need, sum(size) OVER (PARTITION BY k ORDER BY hash) AS upto
            FROM {rows} WHERE size > 0 AND size <= {need}
        ),
        got_{i} AS (SELECT row_id FROM run_{i} WHERE upto <= need),
        left_{i} AS (
            SELECT row_id, k, hash, size, need - coalesce(max(CASE WHEN upto <= need THEN upto END) OVER (PARTITION BY k), 0) AS rest
            FROM run_{i} QUALIFY row_id NOT IN (SELECT row_id FROM got_{i})
        )""")
    return f"""
    WITH sizes AS (
        SELECT row_number() OVER () AS row_id, doc_id, len({words(SPACED, False)}) AS size,
               CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
               CAST('0x' || substr(md5(concat_ws(chr(31), doc_id, text)), 1, 15) AS BIGINT) AS hash
        FROM documents
    ),
    totals AS (SELECT k, sum(size) AS source_size FROM sizes GROUP BY k),
    weighed AS (
        SELECT k, source_size, 3.0::DOUBLE * source_size AS lim,
               [5.0::DOUBLE, 2.0, 1.0][CAST((row_number() OVER (ORDER BY k = 'n', k) - 1) % 3 + 1 AS INT)] AS weight
        FROM totals
    ),
    rates AS (
        SELECT lim / weight AS ratio, weight, lim, k,
               ((SELECT sum(source_size) FROM totals) - coalesce(sum(lim) OVER (ORDER BY lim / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (ORDER BY lim / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
        FROM weighed
    ),
    rate AS (SELECT rate FROM rates WHERE rate * weight <= lim ORDER BY ratio, k LIMIT 1),
    aimed AS (SELECT k, source_size, least(lim, weight * (SELECT rate FROM rate)) AS target FROM weighed),
    aims AS (
        SELECT *, greatest(target - epochs * source_size, 0) AS need
        FROM (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 3) ELSE 0 END AS epochs FROM aimed)
    ),
    {",".join(passes)},
    more AS ({" UNION ALL ".join(f"SELECT row_id FROM got_{i}" for i in range(fills + 1))})
    SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
           CAST(least(epochs + (CASE WHEN more.row_id IS NULL THEN 0 ELSE 1 END), 3) * size AS BIGINT) AS taken
    FROM sizes JOIN aims USING (k) LEFT JOIN more ON more.row_id = sizes.row_id
    """


MIXING = mixing()

_GROUP = "CAST('0x' || substr(sha1(payload), {at}, 10) AS BIGINT)"
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (({_GROUP.format(at=1 + 10 * g)} >> {35 - 5 * j}) & 31) AS INT), 1)"
    for g in range(4)
    for j in range(8)
)

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p
"""

CHAT = """
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
           + len(regexp_extract_all(role, '<\\\\*\\|')) + len(regexp_extract_all(text, '<\\\\*\\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


RUNS = f"""
WITH keyed AS (
    SELECT doc_id, {words(SPACED, False)} AS w,
           xor(4294967295, list_reduce(
               flatten(list_prepend([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END
           )) AS h
    FROM documents
),
placed AS (SELECT *, len(w) AS n, (h // 10) AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a FROM keyed),
repeated AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
        list_transform(range(0, n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END]) ELSE w END AS w
    FROM placed
),
words AS MATERIALIZED (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(w) AS word FROM repeated),
same AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i AS i
    FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
stretches AS (
    SELECT doc_id, q, min(i) AS s, count(*) + q AS l
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same) GROUP BY doc_id, q, island
),
runs AS MATERIALIZED (
    SELECT doc_id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY doc_id, s, l
),
digests AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
           min(struct_pack(l := -l, s := s, q := q)) AS top
    FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(top.s AS BIGINT) AS start, CAST(-top.l AS BIGINT) AS length,
       CAST(top.q AS BIGINT) AS period, CAST(1000 * -top.l // top.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM repeated LEFT JOIN digests USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

GRAM_JOIN = NEAR_DEDUP.replace("w[i:i + 2]", "w[i:i + 4]").replace("len(w) - 2, 1", "len(w) - 4, 1").replace(
    "100 * c >= 85", "100 * c >= 80"
).replace(", d.doc_id = component_id AS kept", "")


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds of exact nearest entries and floored means, as one query each."""
    nearest = """
a{r} AS MATERIALIZED (
    SELECT id, part, min(struct_pack(gap := list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry := entry)) AS near
    FROM v JOIN b{r} b USING (part) GROUP BY id, part
)"""
    move = """
b{n} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY j) AS x FROM (
            SELECT part, near.entry AS entry, j, (sum(c) - ((sum(c) % count(*)) + count(*)) % count(*)) // count(*) AS mean
            FROM (SELECT id, part, unnest(x) AS c, generate_subscripts(x, 1) AS j FROM v) JOIN a{r} USING (id, part)
            GROUP BY part, near.entry, j
        ) GROUP BY part, entry
    ) m USING (part, entry)
)"""
    steps = [nearest.format(r=0)]
    for r in range(rounds):
        steps += [move.format(r=r, n=r + 1), nearest.format(r=r + 1)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
v AS MATERIALIZED (
    SELECT id, part, x[part * len(x) // {parts} + 1 : (part + 1) * len(x) // {parts}] AS x FROM kept, range({parts}) AS t(part)
),
b0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x FROM v WHERE id <= {entries}),
{",".join(steps)},
books AS (
    SELECT sha256(string_agg(list_aggregate(x, 'string_agg', ','), ',' ORDER BY part, entry)) AS digest FROM b{rounds}
),
coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', near.entry), '' ORDER BY part) AS code, CAST(sum(near.gap) AS BIGINT) AS error
    FROM a{rounds} JOIN kept USING (id) GROUP BY id, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded, books
"""


VECTOR_CODES = vector_codes()
