"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from itertools import permutations

_WORD = r"'[^\x20\x09-\x0D]+'"
_BLANK = r"'[\x20\x09-\x0D]+'"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _near(percent: int) -> str:
    """Components of documents whose sets of shingles are as similar as that."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh FROM i),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
r(d, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.d = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.d = d.doc_id GROUP BY ALL"""


def _manifest() -> str:
    """op13_merkle_manifest: trees of runs of 16 over the sources and over their tops, climbed level by level; CRC-32 by its table."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({c} AS VARCHAR))), ':', {c}) END"
    leaf = lambda t: "sha256(concat(" + ", ".join(map(field, ("doc_id", "source", "lang", "n_chars", t))) + "))"

    def tree(n: int, nodes: str) -> str:
        return f"""
lv{n}(level, key, pos, size, h) AS (SELECT 0, key, pos, size, h FROM {nodes} UNION ALL
SELECT level + 1, key, pos // 16, (size + 15) // 16, sha256(string_agg(h, '' ORDER BY pos)) FROM lv{n} WHERE size > 1 GROUP BY level, key, pos // 16, size),
runs{n} AS (SELECT level, key, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM lv{n} WHERE size > 1 GROUP BY ALL)"""

    def walk(n: int, start: str) -> str:
        others = "list_concat(hs[:pos % 16], {}hs[pos % 16 + 2:])"
        return f"""
walk{n}(uid, level, key, pos, h, proof) AS ({start} UNION ALL
SELECT uid, w.level + 1, w.key, pos // 16, sha256(array_to_string({others.format('[h], ')}, '')), concat(proof, array_to_string({others.format('')}, ''))
FROM walk{n} w JOIN runs{n} r ON r.level = w.level AND r.key = w.key AND r.run = w.pos // 16)"""

    return f"""
WITH RECURSIVE crcs AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS uid, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS crc FROM documents, crcs),
l AS (SELECT uid, doc_id, CASE WHEN source IS NULL THEN '' ELSE concat('=', source) END AS key, {leaf("text")} AS h, CASE WHEN crc % 5 = 0 THEN {leaf(_LOWER.format("text"))} END AS other FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY key) AS size FROM l),{tree(1, "n")},
s AS (SELECT 0 AS key, key AS own, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS size, h FROM lv1 WHERE size = 1),{tree(2, "s")},{walk(1, "SELECT uid, 0, key, pos, coalesce(other, h), '' FROM n")},
e AS (SELECT uid, key, arg_max(h, level) AS h, arg_max(proof, level) AS proof FROM walk1 GROUP BY ALL),{walk(2, "SELECT uid, 0, s.key, pos, e.h, proof FROM e JOIN s ON s.own = e.key")},
z AS (SELECT uid, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM walk2 GROUP BY uid),
root AS (SELECT h AS root FROM lv2 WHERE size = 1)
SELECT n.doc_id, n.h AS leaf, s.h AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified FROM n JOIN z USING (uid) JOIN s ON s.own = n.key CROSS JOIN root"""


def _filters() -> str:
    """op12_filter_audit: masks of failed filters, counted by part, against all orders."""
    steps = []
    for order in permutations(range(5)):
        steps += [f"('{''.join('ABCDE'[i] for i in order)}', {k + 1}, {1 << f}, {sum(1 << i for i in order[:k])})" for k, f in enumerate(order)]
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS ws FROM documents),
f AS (SELECT doc_id, part, (len(ws) < 50)::INT + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::INT + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text))::INT
+ 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY text))::INT AS mask FROM t),
m AS (SELECT part, mask, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND quality = 1) AS good, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND toxic = 1) AS bad FROM f),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM m GROUP BY ALL),
s(filter_order, step, own, before) AS (VALUES {", ".join(steps)}),
r AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (mask & (before | own) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS removed,
coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS good_lost, coalesce(sum(bad) FILTER (mask & before = 0 AND mask & own <> 0), 0) AS toxic_lost FROM c CROSS JOIN s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""


ORACLES = {
    "op12_filter_audit": _filters(),
    "op13_merkle_manifest": _manifest(),
    "op1_ngram_jaccard_join": _near(75),
    "op11_minhash_near_dedup": f"SELECT *, doc_id = component_id AS kept FROM ({_near(85)})",
    "op3_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
q AS (SELECT *, sha256(html) AS sha, min(page_id) OVER (PARTITION BY sha256(html)) AS first_id FROM p)
SELECT page_id, url, '2024-01-31T00:00:00Z' AS date, n AS payload_bytes, sha AS payload_digest,
CASE WHEN n >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND first_id <> page_id THEN first_id END AS refers_to FROM q""",
    "op4_line_dedup": f"""
WITH r AS (SELECT doc_id, unnest(range(len(p))) AS pos, unnest(p) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)),
o AS (SELECT doc_id, pos, list_filter(regexp_split_to_array(lower(line), {_BLANK}), lambda w: w <> '') AS ws FROM r),
l AS (SELECT *, array_to_string(ws, ' ') AS k FROM o WHERE len(ws) > 0),
f AS (SELECT k, any_value(ws) AS ws, min((doc_id, pos)) AS place FROM l GROUP BY k),
t AS (SELECT *, md5(k) AS whole FROM f WHERE len(ws) >= 7),
v AS (SELECT k, place, i, len(ws) AS n, md5(array_to_string(list_concat(ws[1:i - 1], ws[i + 1:]), ' ')) AS short FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM t WHERE len(ws) >= 8)),
near AS (SELECT k FROM (SELECT k, place, min(place) OVER (PARTITION BY short, i, n) AS m FROM v) WHERE m < place
UNION SELECT v.k FROM v JOIN t ON v.short = t.whole AND t.place < v.place UNION SELECT t.k FROM v JOIN t ON v.short = t.whole AND v.place < t.place),
j AS (SELECT l.doc_id, l.pos, (l.doc_id, l.pos) = f.place AS is_first, near.k IS NOT NULL AS is_near FROM l JOIN f USING (k) LEFT JOIN near USING (k)),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT is_first) AS n_equal, count(*) FILTER (is_first AND is_near) AS n_near,
string_agg(pos, ',' ORDER BY pos) FILTER (is_first AND NOT is_near) AS kept_lines FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near, coalesce(kept_lines, '') AS kept_lines FROM documents d LEFT JOIN a USING (doc_id)""",
    "op6_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS low FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(low) AS text_sha256 FROM t WINDOW w AS (PARTITION BY low)""",
    "op8_quality_rules": f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, {_WORD}) AS ws FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, source, text, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT *, len(regexp_extract_all(line, {_WORD})) AS n, lower(trim(regexp_replace(regexp_replace(line, '[0-9]+', '0', 'g'), {_BLANK}, ' ', 'g'))) AS plain FROM l WHERE regexp_matches(line, {_WORD})),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM k GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT text) AS texts FROM d GROUP BY source),
common AS (SELECT k.source, plain FROM k JOIN hosts h ON h.source IS NOT DISTINCT FROM k.source GROUP BY k.source, plain, texts HAVING count(DISTINCT text) > 10 AND count(DISTINCT text) > 0.01 * texts),
gone AS (SELECT doc_id, sum(n) AS n, string_agg(pos, ',' ORDER BY pos) AS places FROM k WHERE EXISTS (SELECT 1 FROM common c WHERE c.source IS NOT DISTINCT FROM k.source AND c.plain = k.plain) GROUP BY doc_id),
b AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_words, coalesce(gone.places, '') AS removed_lines
FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id)),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b)
SELECT *, NOT base_failed AND n_words - removed_words >= 20 AND n_words - removed_words >= 0.3 * n_words AS kept FROM v""",
    "op10_mixing": f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS size, CAST(concat('0x', substr(md5(concat('mix|', doc_id)), 1, 15)) AS BIGINT) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(r - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM s),
c AS (SELECT *, w * ((total - coalesce(sum(cap) OVER before, 0)) / sum(w) OVER rest) >= cap AS capped FROM w
WINDOW before AS (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), rest AS (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE w * ((total - coalesce((SELECT sum(cap) FROM c WHERE capped), 0)) / (SELECT sum(w) FROM c WHERE NOT capped)) END AS target FROM c),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) % source_size ELSE 0 END AS over FROM t),
o AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target, CAST(size * whole + greatest(0, least(size, over - before)) AS BIGINT) AS taken FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source""",
}
