"""DuckDB statements for the queries that SQL can express.

Each is written apart from the operator it checks: windows are compared as text instead
of through suffix arrays, n-grams as text instead of hashes, Poisson terms through the
gamma function, template levels as lists instead of hashes.
"""

from __future__ import annotations

from tidemark.llm import secret_scan as S

#: Blocks of 1,000 starts keep ``substr`` on short strings; windows are 50 bytes of hex text.
OP1 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM docs),
blocks AS (SELECT doc_id, b, n, substr(h, 2 * b + 1, 2 * 1049) AS part
  FROM (SELECT doc_id, h, n, unnest(range(0, greatest(n - 49, 0), 1000)) AS b FROM sized)),
windows AS (SELECT doc_id, b + i AS p, substr(part, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, b, part, unnest(range(0, least(1000, n - 49 - b))) AS i FROM blocks)),
lowest AS (SELECT w, min(doc_id) AS lo FROM windows GROUP BY w HAVING max(doc_id) > min(doc_id)),
hit AS (SELECT DISTINCT doc_id, p FROM windows JOIN lowest USING (w) WHERE doc_id > lo),
stepped AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER d + 50 THEN 0 ELSE 1 END AS opens
  FROM hit WINDOW d AS (PARTITION BY doc_id ORDER BY p)),
numbered AS (SELECT doc_id, p, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM stepped),
runs AS (SELECT doc_id, run, min(p) AS s, max(p) + 50 AS e FROM numbered GROUP BY doc_id, run),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before
  FROM runs),
cut AS (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans, max(e) AS last,
    string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
  FROM gaps JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM sized LEFT JOIN cut USING (doc_id)
"""

OP2 = """
WITH mass AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS mass
  FROM documents GROUP BY source),
total AS (SELECT sum(sqrt(mass)) AS w, sum(mass) AS m FROM mass),
rates AS (SELECT source, CASE WHEN mass > 0 THEN sqrt(mass) * (m / w) / mass ELSE 0 END AS rate
  FROM mass, total),
terms AS (SELECT source, k, CASE WHEN rate = 0 THEN 1.0
    ELSE exp(k * ln(rate) - rate - lgamma(k + 1)) END AS p
  FROM (SELECT source, rate, unnest(range(0, CASE WHEN rate = 0 THEN 1
    ELSE CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1 END)) AS k FROM rates)),
summed AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM terms),
tables AS (SELECT source, list(cdf) AS cdfs FROM summed GROUP BY source),
drawn AS (SELECT *, CAST('0x' || substr(md5('mix:n:' || coalesce(CAST(doc_id AS VARCHAR), '')
    || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT d.*, len(list_filter(t.cdfs, lambda c: c <= d.u)) AS n
  FROM drawn d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT *, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy,
  CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
    || md5(coalesce(text, '')) || ':' || copy), 1, 15)
    AS BIGINT) AS shuffle_key
FROM copies
"""

OP3 = r"""
WITH split AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')),
    '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w1 FROM split),
grams AS (SELECT doc_id, i, w1, lag(w1) OVER d || ' ' || w1 AS w2,
    lag(w1, 2) OVER d || ' ' || lag(w1) OVER d || ' ' || w1 AS w3
  FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
rest AS (SELECT doc_id, i, w2, w3,
    count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS n,
    count(*) OVER (PARTITION BY w1) - count(*) OVER (PARTITION BY doc_id, w1) AS r1,
    CASE WHEN w2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w2)
      - count(*) OVER (PARTITION BY doc_id, w2) END AS r2,
    CASE WHEN w3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY w3)
      - count(*) OVER (PARTITION BY doc_id, w3) END AS r3
  FROM grams),
context AS (SELECT *, lag(r1) OVER d AS c1, lag(r2) OVER d AS c2
  FROM rest WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
one AS (SELECT *, CASE WHEN r1 > 0 THEN r1 / greatest(n, 1) ELSE 0.4::DOUBLE / (n + 1) END AS s1
  FROM context),
two AS (SELECT *, CASE WHEN w2 IS NULL THEN s1 WHEN r2 > 0 THEN r2 / greatest(c1, 1)
    ELSE 0.4::DOUBLE * s1 END AS s2 FROM one),
three AS (SELECT *, CASE WHEN w3 IS NULL THEN s2 WHEN r3 > 0 THEN r3 / greatest(c2, 1)
    ELSE 0.4::DOUBLE * s2 END AS s3 FROM two),
scored AS (SELECT doc_id, count(*) AS n_tokens, sum(ln(s3)) AS total FROM three GROUP BY doc_id)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, round(coalesce(total, 0), 4) AS log_score,
  round(total / n_tokens, 6) AS mean_log_score
FROM documents LEFT JOIN scored USING (doc_id)
"""

OP4 = """
WITH rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (SELECT host, path, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY host, path ORDER BY length(rhost) + length(rpath) DESC) AS rn
  FROM (SELECT DISTINCT host, path FROM urls) u JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
paths AS (SELECT host, path, f.rule, f.verdict AS said,
    CAST(coalesce(f.verdict = 'block', false) AS INT) AS bad,
    CAST(coalesce(f.verdict = 'allow', false) AS INT) AS good,
    list_filter(string_split(path, '/'), lambda s: s <> '') AS parts
  FROM (SELECT DISTINCT host, path FROM urls) LEFT JOIN (FROM fits WHERE rn = 1) f USING (host, path)),
levels AS (SELECT host, path, l, parts[l] AS seg, list_transform(parts[1:l - 1],
    lambda s: regexp_replace(s, '[0-9]+', '#', 'g')) AS above
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS l FROM paths)),
kinds AS (SELECT host, l, above, count(DISTINCT seg) AS kinds, count(*) AS paths
  FROM levels GROUP BY host, l, above),
renamed AS (SELECT host, path, list(CASE WHEN kinds >= 3 AND kinds >= 0.5 * paths THEN '*'
    ELSE seg END ORDER BY l) AS segs FROM levels JOIN kinds USING (host, l, above) GROUP BY host, path),
named AS (SELECT p.*, coalesce(r.segs, []) AS segs FROM paths p LEFT JOIN renamed r USING (host, path)),
tree AS (SELECT host, segs, count(*) AS n, sum(bad) AS bad, sum(good) AS good
  FROM named GROUP BY host, segs),
branch AS (SELECT *, segs[l] AS seg, segs[1:l - 1] AS above, segs[l + 1:] AS below
  FROM (SELECT *, unnest(range(1, len(segs) + 1)) AS l FROM tree)),
total AS (SELECT host, l, above, seg, sum(n) AS all_n FROM branch WHERE seg <> '*'
  GROUP BY host, l, above, seg),
profile AS (SELECT host, l, above, seg, below, sum(n) AS m, sum(n) / any_value(all_n) AS share
  FROM branch JOIN total USING (host, l, above, seg) GROUP BY host, l, above, seg, below),
kin AS (SELECT host, l, above, count(*) AS kin, sum(all_n) AS kin_n FROM total GROUP BY host, l, above),
pooled AS (SELECT host, l, above, below, sum(m) / any_value(kin_n) AS pool, any_value(kin) AS kin
  FROM profile JOIN kin USING (host, l, above) GROUP BY host, l, above, below),
joint AS (SELECT host, l, above, seg, '*' AS joint FROM profile JOIN pooled USING (host, l, above, below)
  GROUP BY host, l, above, seg, kin HAVING kin > 1 AND round(sum(least(share, pool)), 9) >= 0.7),
merged AS (SELECT host, segs, list(coalesce(joint, seg) ORDER BY l) AS final
  FROM branch LEFT JOIN joint USING (host, l, above, seg) GROUP BY host, segs),
finals AS (SELECT t.*, coalesce(m.final, t.segs) AS final FROM tree t LEFT JOIN merged m USING (host, segs)),
everywhere AS (SELECT segs, (sum(bad) + 2 * 0.1::DOUBLE) / (sum(bad) + sum(good) + 2) AS towards
  FROM tree GROUP BY segs),
own AS (SELECT host, final, sum(bad) AS bad, sum(good) AS good FROM finals GROUP BY host, final),
shares AS (SELECT host, segs, final, (own.bad + 2 * towards) / (own.bad + own.good + 2) AS blocked_share
  FROM finals JOIN own USING (host, final) JOIN everywhere USING (segs))
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN blocked_share >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  '/' || array_to_string(final, '/') AS template, blocked_share
FROM urls JOIN named USING (host, path) JOIN shares USING (host, segs)
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: int, pattern: str) -> str:
    """Places of the matches of one pattern, from the pieces between them."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, {kind} AS kind, m,
    sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s
  FROM (SELECT doc_id, unnest(range(len(regexp_extract_all(t, {p})))) AS i,
      unnest(regexp_extract_all(t, {p})) AS m,
      unnest(string_split_regex(t, {p})[:len(regexp_extract_all(t, {p}))]) AS gap
    FROM docs WHERE regexp_matches(t, {p}))"""


OP8 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_spans(k, p) for k, p in enumerate((S.ASSIGN, S.ACCESS, S.HEX, S.TOKEN)))}),
placed AS (SELECT doc_id, kind, m, CAST(s AS BIGINT) AS s, CAST(s AS BIGINT) + length(m) AS e,
    CASE WHEN kind = 0 THEN regexp_extract(m, {_quoted(S.ASSIGN)}, 2) ELSE m END AS v FROM found),
base AS (FROM placed WHERE (kind = 0 AND length(v) >= 6) OR (kind = 1 AND length(m) >= 20) OR kind = 2),
token AS (SELECT t.*, row_number() OVER () AS id FROM placed t WHERE kind = 3 AND NOT EXISTS (
  FROM base b WHERE b.doc_id = t.doc_id AND b.s < t.e AND t.s < b.e)),
cuts AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM (
    SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY s, kind, e) AS run FROM (
      SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY doc_id ORDER BY s, kind, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM base))
  GROUP BY doc_id, run),
gaps AS (SELECT doc_id, substr(t, lo + 1, s - lo) AS gap FROM docs JOIN (SELECT *,
    coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS lo FROM cuts) USING (doc_id)
  UNION ALL SELECT doc_id, substr(t, coalesce(e, 0) + 1) FROM docs LEFT JOIN (
    SELECT doc_id, max(e) AS e FROM cuts GROUP BY doc_id) USING (doc_id)),
words AS (SELECT v, count(*) AS n FROM (
    SELECT unnest(string_split_regex(gap, '{S.NOT_TOKEN}')) AS v FROM gaps)
  WHERE regexp_matches(v, '{S.WORD}') GROUP BY v),
learned AS (SELECT 1 AS y, v, 1 AS n FROM base UNION ALL SELECT 0, v, n FROM words),
alphabet AS (SELECT unnest(range(1, {len(S.ALPHABET) + 1})) AS c),
step AS (SELECT y, n, strpos('{S.ALPHABET}', substr(v, i, 1)) AS a,
    strpos('{S.ALPHABET}', substr(v, i + 1, 1)) AS b
  FROM (SELECT y, v, n, unnest(range(1, length(v))) AS i FROM learned)),
counts AS (SELECT a, b, sum(n) FILTER (y = 1) AS n1, sum(n) FILTER (y = 0) AS n0
  FROM step WHERE a > 0 AND b > 0 GROUP BY a, b),
cells AS (SELECT x.c AS a, z.c AS b, coalesce(n1, 0)::DOUBLE AS n1, coalesce(n0, 0)::DOUBLE AS n0
  FROM alphabet x CROSS JOIN alphabet z LEFT JOIN counts ON a = x.c AND b = z.c),
seconds AS (SELECT b, sum(n0) + 0.5 AS m FROM cells GROUP BY b),
shares AS (SELECT a, b, (n1 + 0.5) / (sum(n1) OVER r + {0.5 * len(S.ALPHABET)}) AS p,
    (n0 + {0.5 * len(S.ALPHABET)} * m / (SELECT sum(m) FROM seconds))
      / (sum(n0) OVER r + {0.5 * len(S.ALPHABET)}) AS q
  FROM cells JOIN seconds USING (b) WINDOW r AS (PARTITION BY a)),
model AS (SELECT a, b, round(ln(p / f), 3) AS ratio, round(-ln(f), 3) AS surprise
  FROM (SELECT *, {1 - S.FLOOR} * q + {S.FLOOR / len(S.ALPHABET)} AS f FROM shares)),
random AS (SELECT id FROM (SELECT id, m, strpos('{S.ALPHABET}', substr(m, i, 1)) AS a,
      strpos('{S.ALPHABET}', substr(m, i + 1, 1)) AS b
    FROM (SELECT id, m, unnest(range(1, length(m))) AS i FROM token)) JOIN model USING (a, b)
  GROUP BY id, m HAVING round(greatest(sum(ratio), sum(surprise) - (length(m) - 1) * ln(
      CASE WHEN regexp_matches(m, '[a-z]') THEN 26 ELSE 0 END
      + CASE WHEN regexp_matches(m, '[A-Z]') THEN 26 ELSE 0 END
      + CASE WHEN regexp_matches(m, '[0-9]') THEN 10 ELSE 0 END
      + CASE WHEN regexp_matches(m, '[+/_=-]') THEN 5 ELSE 0 END)), 6)
    >= greatest(1.0, (length(m) - 1) / {S.SHORTEST - 1.0}) * {S.MIN_RATIO}),
spans AS (SELECT doc_id, kind, s, e FROM base
  UNION ALL SELECT doc_id, kind, s, e FROM token JOIN random USING (id)),
listed AS (SELECT *, {list(S.KINDS)!r}[kind + 1] || ':' || s || ':' || e AS x FROM spans),
per_doc AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex, string_agg(x, ',' ORDER BY s, kind, e) AS spans,
    string_agg(x, ',' ORDER BY s, kind, e) FILTER (kind < 3) AS base
  FROM listed GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (doc_id)
"""

#: Rows of five words at equal distances instead of an automaton; the echo as the contract edits it.
OP11 = r"""
WITH crc AS (SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
docs AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS w,
    xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
      string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
      lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))) AS h FROM documents, crc),
keyed AS (SELECT *, len(w) AS n, h // 10 AS g,
    CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM docs),
cut AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM keyed),
texts AS (SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
    lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w FROM cut),
words AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) - 1 AS i FROM texts),
rows5 AS (SELECT doc_id, i, concat_ws(' ', w, lead(w) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o,
    lead(w, 4) OVER o) AS r, lead(i, 4) OVER o AS whole
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS p FROM rows5 x JOIN rows5 y
    ON x.doc_id = y.doc_id AND x.r = y.r AND x.i < y.i
  WHERE x.whole IS NOT NULL AND y.whole IS NOT NULL),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM pairs),
held AS (SELECT doc_id, p, min(i) AS s, count(*) + 4 + p AS l FROM islands
  GROUP BY doc_id, p, island HAVING count(*) + 4 + p >= greatest(6, 4 * p)),
runs AS (SELECT doc_id, s, l, min(p) AS p FROM held GROUP BY doc_id, s, l),
listed AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || l || ',' || p || chr(10), ''
    ORDER BY s, p) AS t FROM runs GROUP BY doc_id),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id
    ORDER BY CAST(l AS DOUBLE) / p DESC, s, p) = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + p, s + l)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone
    USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(l.n, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start,
  CAST(b.l AS BIGINT) AS length, CAST(b.p AS BIGINT) AS period,
  CAST(1000 * b.l // b.p AS BIGINT) AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256,
  sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM docs d LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id)
  LEFT JOIN kept k USING (doc_id)
"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain Lloyd rounds in one statement: distances from the numbers themselves."""
    steps = [f"""
kept AS (SELECT vec_id, label, list_transform(embedding,
    lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: coalesce(NOT isfinite(x), true))) = 0),
cut AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // {parts} + 1
    :(part + 1) * len(v) // {parts}] AS s
  FROM (SELECT *, unnest(range({parts})) AS part FROM kept)),
book0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, s AS c
  FROM cut QUALIFY entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (SELECT vec_id, label, part, s, min(struct_pack(d := CAST(list_sum(
    list_transform(list_zip(s, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT),
    e := entry)) AS best
  FROM cut JOIN book{r} USING (part) GROUP BY vec_id, label, part, s),
book{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m, c) AS c FROM book{r}
  LEFT JOIN (SELECT part, entry, list(CAST((t - ((t % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m
    FROM (SELECT part, best.e AS entry, i, count(*) AS n, sum(s[i]) AS t
      FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM near{r}) GROUP BY ALL)
    GROUP BY part, entry) USING (part, entry))""")
    steps.append(f"""
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code,
    CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS h
  FROM book{rounds})""")
    return ("WITH" + ",".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  h AS codebooks_sha256 FROM coded, books""")


ORACLE: dict[str, str] = {
    "op1_suffix_dedup": OP1,
    "op2_mixing": OP2,
    "op3_lm_scores": OP3,
    "op4_urls": OP4,
    "op8_secrets": OP8,
    "op11_word_runs": OP11,
    "op13_vector_codes": _op13(),
}
