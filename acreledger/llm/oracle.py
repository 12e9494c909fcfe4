"""SQL with the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

from .quality import LEVELS
from .shards import FACTOR, INCREMENT, MASK

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def _mix(text: str = "text") -> str:
    return f"('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5({text}), '')), 1, 12))::BIGINT"


def mixing(weights=(1, 2, 3), epochs: int = 3) -> str:
    turns = " UNION ALL ".join(
        f"SELECT *, {e} AS epoch, CASE WHEN target > 0 THEN CAST(source_size * {e} + upto AS DOUBLE) / target ELSE 0.0 END AS t FROM queued" for e in range(epochs)
    )
    listed = ", ".join(map(str, weights))
    return f"""
WITH base AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size, CAST(source IS NULL AS INT) AS n, coalesce(source, '') AS s, {_mix()} AS mix FROM documents),
numbered AS (SELECT *, row_number() OVER (ORDER BY n, s, mix, doc_id) AS id FROM base),
sizes AS (SELECT n, s, CAST(sum(size) AS BIGINT) AS source_size FROM base GROUP BY n, s),
weighed AS (SELECT *, [{listed}][CAST((row_number() OVER (ORDER BY n, s COLLATE "C") - 1) % {len(weights)} + 1 AS INT)] AS w, source_size * {epochs} AS most, sum(source_size) OVER () AS total FROM sizes),
leveled AS (SELECT *, CAST(total - coalesce(sum(most) OVER (ORDER BY CAST(most AS DOUBLE) / w, n, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
  / sum(w) OVER (ORDER BY CAST(most AS DOUBLE) / w, n, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, row_number() OVER (ORDER BY CAST(most AS DOUBLE) / w, n, s) AS k FROM weighed),
first AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM leveled WHERE CAST(most AS DOUBLE) >= level * w),
targets AS (SELECT l.n, l.s, l.source_size, CASE WHEN f.k IS NULL OR l.k < f.k THEN CAST(l.most AS DOUBLE) ELSE f.level * l.w END AS target, l.total FROM leveled l CROSS JOIN first f),
queued AS (SELECT b.*, t.source_size, t.target, t.total, sum(size) OVER (PARTITION BY b.n, b.s ORDER BY mix, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM numbered b JOIN targets t ON t.n = b.n AND t.s = b.s),
turns AS ({turns}),
served AS (SELECT id, size, sum(size) OVER (ORDER BY t, n, s, epoch, mix, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= total AS taken FROM turns),
copies AS (SELECT id, count(*) FILTER (WHERE taken) AS copies FROM served GROUP BY id)
SELECT q.doc_id, q.size, q.source_size, q.target, CAST(c.copies * q.size AS BIGINT) AS taken FROM queued q JOIN copies c ON c.id = q.id"""


def sharding(shards: int = 24) -> str:
    """CRC and jump chain are folds over bytes and rounds; the CRC table comes from its rule."""
    table = "SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM (SELECT unnest(range(256)) AS i))"
    steps, last = [], "seeded"
    for k in range(shards + 1):
        steps.append(f"""j{k} AS (SELECT id, CASE WHEN j > {shards} THEN x ELSE (((((x >> 24) * {FACTOR}) & 16777215) << 24) + (x & 16777215) * {FACTOR} + {INCREMENT}) & {MASK} END AS x,
  CASE WHEN j < {shards} THEN j ELSE shard END AS shard, CASE WHEN j <= {shards} THEN j ELSE grown END AS grown, j FROM {last}),
k{k} AS (SELECT id, x, shard, grown, CASE WHEN j > {shards} THEN j ELSE CAST(floor((j + 1) * 2147483648.0::DOUBLE / ((x >> 17) + 1)) AS BIGINT) END AS j FROM j{k})""")
        last = f"k{k}"
    return f"""
WITH crc AS ({table}),
rows_ AS (SELECT row_number() OVER () AS id, doc_id, text, {_mix()} AS mix FROM documents),
bytes_ AS (SELECT id, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')] AS b FROM rows_),
sums AS (SELECT id, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) + 1 AS INT)]), 4294967295), 4294967295) AS crc, len(b) + 8 AS size FROM bytes_, crc),
seeded AS (SELECT id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT AS x, CAST(0 AS BIGINT) AS j, CAST(-1 AS BIGINT) AS shard, CAST(-1 AS BIGINT) AS grown FROM rows_),
{", ".join(steps)}
SELECT r.doc_id, CAST(s.size AS BIGINT) AS size, CAST(s.crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(k.shard AS INT) AS shard,
  CAST(row_number() OVER (PARTITION BY k.shard ORDER BY r.mix, r.doc_id NULLS FIRST, s.crc) - 1 AS BIGINT) AS slot, CAST(k.grown AS INT) AS grown_shard
FROM rows_ r JOIN sums s ON s.id = r.id JOIN {last} k ON k.id = r.id"""


def quality(risk: float = 0.01, delta: float = 0.05) -> str:
    def strict() -> str:
        whens = " ".join(
            f"WHEN n_symbols / greatest(word_chars, 1) > {a} OR n_dup_lines / greatest(n_lines, 1) > {b} OR n_repeat_words / greatest(n_words, 1) > {c} THEN {k}"
            for k, (a, b, c) in enumerate(LEVELS, 1)
        )
        return f"CASE {whens} ELSE {len(LEVELS) + 1} END"

    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce('=' || lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT id, regexp_extract_all(text, '{WORD}') AS w FROM d),
windows AS (SELECT id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, g) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT id, sum(least(8, i - coalesce(before, -8))) AS r FROM (SELECT id, i, lag(i) OVER (PARTITION BY id ORDER BY i) AS before FROM twice) GROUP BY id),
lines AS (SELECT id, len(l) AS n, len(l) - len(list_distinct(l)) AS dup FROM (SELECT id, list_filter(string_split(text, chr(10)), lambda x: translate(x, {blank}, '') <> '') AS l FROM d)),
m AS (SELECT d.id, d.doc_id, d.stratum, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(translate(text, {blank}, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(l.dup AS BIGINT) AS n_dup_lines, l.n AS n_lines, CAST(coalesce(r.r, 0) AS BIGINT) AS n_repeat_words
  FROM d JOIN w ON w.id = d.id JOIN lines l ON l.id = d.id LEFT JOIN repeats r ON r.id = d.id),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, {strict()} AS strict FROM m),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1),
hold AS (SELECT stratum, strict, count(*) AS c FROM f WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good) GROUP BY stratum, strict),
each AS (SELECT stratum, level, sum(c) AS n, coalesce(sum(c) FILTER (WHERE strict <= level), 0) AS k FROM hold, (SELECT unnest(range(1, {len(LEVELS) + 1})) AS level) GROUP BY stratum, level),
tails AS (SELECT stratum, level, CASE WHEN k >= n * {risk} THEN 1.0 ELSE list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({risk}) + (n - j) * ln(1 - {risk})) FOR j IN range(0, CAST(k AS BIGINT) + 1)]) END AS tail FROM each),
levels AS (SELECT stratum, coalesce(min(level) FILTER (WHERE tail > {delta} / (SELECT count(DISTINCT stratum) FROM hold)), {len(LEVELS) + 1}) - 1 AS level FROM tails GROUP BY stratum)
SELECT f.doc_id, f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words, f.base_failed,
  NOT f.base_failed AND f.strict > coalesce(l.level, 0) AS kept, CAST(coalesce(l.level, 0) AS INT) AS level
FROM f LEFT JOIN levels l ON l.stratum = f.stratum"""


def repeats(length: int = 50) -> str:
    """Passages as 64-bit hashes of hexadecimal substrings; removed bytes are those near a passage with a smaller owner."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(doc_id, 9223372036854775807) AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT id, k, p, len(h) // 2 - {length - 1} AS n, substr(h, CAST(1000 * p + 1 AS INT), {1000 + 2 * length}) AS h FROM (SELECT id, k, h, unnest(range(0, (len(h) // 2 - {length}) // 500 + 1)) AS p FROM d WHERE len(h) >= {2 * length})),
w AS (SELECT id, k, 500 * p + j AS i, hash(substr(h, CAST(2 * j + 1 AS INT), {2 * length})) AS g FROM (SELECT id, k, p, h, unnest(range(0, least(500, n - 500 * p))) AS j FROM parts)),
low AS (SELECT g, min(k) AS m FROM w GROUP BY g HAVING min(k) < max(k)),
hit AS (SELECT w.id, w.i FROM w JOIN low ON low.g = w.g WHERE low.m < w.k),
steps AS (SELECT id, i, coalesce(i > max(i) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {length}, true) AS fresh FROM hit),
runs AS (SELECT id, min(i) AS a, max(i) + {length} AS b FROM (SELECT id, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS r FROM steps) GROUP BY id, r),
cuts AS (SELECT id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY id),
pieces AS (SELECT r.id, r.a AS place, substr(d.h, CAST(2 * coalesce(lag(r.b) OVER (PARTITION BY r.id ORDER BY r.a), 0) + 1 AS INT), CAST(2 * (r.a - coalesce(lag(r.b) OVER (PARTITION BY r.id ORDER BY r.a), 0)) AS INT)) AS p FROM runs r JOIN d ON d.id = r.id
  UNION ALL SELECT d.id, len(d.h), substr(d.h, CAST(2 * max(r.b) + 1 AS INT)) FROM d JOIN runs r ON r.id = d.id GROUP BY d.id, d.h),
kept AS (SELECT id, string_agg(p, '' ORDER BY place) AS h FROM pieces GROUP BY id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(c.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM d LEFT JOIN cuts c ON c.id = d.id LEFT JOIN kept k ON k.id = d.id"""


def decontamination(window: int = 13) -> str:
    """Windows as strings; a word is hit if it lies in an equal window of the document."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all({lower}, '{word}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lower}, '{word}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), {window}) AS n, array_to_string(w[i:i + {window - 1}], ' ') AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT dw.id, dw.i, dw.n, bw.item FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
hit AS (SELECT id, count(DISTINCT k) AS n_hit FROM (SELECT id, unnest(range(i, i + n)) AS k FROM found) GROUP BY id),
items AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.l, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hit h ON h.id = d.id LEFT JOIN items i ON i.id = d.id"""


def warc(min_bytes: int = 0) -> str:
    """What the archives must give back; base32 from 40-bit groups of the digest."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = " || ".join(
        f"array_to_string([substr('{letters}', CAST(((('0x' || substr(h, {1 + 10 * g}, 10))::BIGINT >> (35 - 5 * j)) & 31) + 1 AS INT), 1) FOR j IN range(0, 8)], '')" for g in range(4)
    )
    return f"""
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top, count(*) AS n FROM p WHERE payload_bytes >= {min_bytes} GROUP BY h),
j AS (SELECT p.*, CASE WHEN g.n > 1 AND g.top IS NOT NULL AND p.page_id IS DISTINCT FROM g.top THEN g.top END AS refers_to FROM p LEFT JOIN g ON g.h = p.h)
SELECT page_id, payload_bytes, {groups} AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j"""


USABLE = "embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)"


def _whole(factor: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({factor} * CAST(x AS DOUBLE)) AS BIGINT))"


def _product(a: str, b: str) -> str:
    """Inner product of whole numbers, through doubles: exact below 2**53."""
    return f"CAST(list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])) AS BIGINT)"


def top_k(k: int = 5) -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, vec_id, {_whole(256)} AS c FROM embeddings WHERE {USABLE}),
s AS (SELECT q.id, q.vec_id AS query_id, v.vec_id, {_product("q.c", "v.c")} AS score FROM v q JOIN v ON v.id <> q.id AND len(v.c) = len(q.c) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= {k}"""


def negatives(positives: int = 5, most: int = 10) -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole(256)} AS c FROM embeddings WHERE label IS NOT NULL AND {USABLE}),
s AS (SELECT a.id, a.vec_id AS anchor_id, v.id AS other, v.vec_id, a.label = v.label AS same, {_product("a.c", "v.c")} AS score FROM v a JOIN v ON v.id <> a.id AND len(v.c) = len(a.c) WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same),
n AS (SELECT p.id, p.place, p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.id, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
  FROM p JOIN s ON s.id = p.id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score WHERE p.place <= {positives})
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {most}"""


def centroids(clusters: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """One common table per round; a mean's floor is taken on whole numbers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT id, arg_min(k, [d, k]) AS k, min(d) AS d FROM (SELECT v.id, m.k, CAST(list_sum(list_transform(list_zip(v.c, m.c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, m{r} m) GROUP BY id)""")
        if r < rounds:
            steps.append(f"""m{r + 1} AS MATERIALIZED (SELECT m.k, coalesce(n.c, m.c) AS c FROM m{r} m LEFT JOIN (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
  SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT a.k, unnest(v.c) AS x, unnest(range({dim})) AS i FROM a{r} a JOIN v ON v.id = a.id) GROUP BY k, i) GROUP BY k) n ON n.k = m.k)""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, {_whole(1024)} AS c FROM embeddings WHERE len(embedding) = {dim} AND {USABLE}),
m0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, c) - 1 AS k, c FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, c FROM v WHERE vec_id IS NOT NULL ORDER BY h, c LIMIT {clusters})),
{", ".join(steps)},
t AS (SELECT k, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY k)
SELECT v.vec_id, CAST(a.k AS INT) AS cluster, a.d AS distance, t.cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, sha256(array_to_string(m.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v ON v.id = a.id JOIN t ON t.k = a.k JOIN m{rounds} m ON m.k = a.k"""


def oracles() -> dict[str, str]:
    return {
        "op2_mixing": mixing(),
        "op3_warc": warc(),
        "op4_repeats": repeats(),
        "op6_quality": quality(),
        "op7_shards": sharding(),
        "op9_decontamination": decontamination(),
        "op11_topk": top_k(),
        "op12_negatives": negatives(),
        "op13_centroids": centroids(),
    }
