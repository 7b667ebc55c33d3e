"""DuckDB SQL of the registered corpus queries, one string per query name."""

#: words of a text column, as a list
WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

op7_quality_rules = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)
),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id
),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
dup AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
m AS (
  SELECT doc_id, text, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    greatest(len(w), 1) AS k
  FROM t LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR n_symbols > 0.1 * k
    OR word_chars < 2 * k OR word_chars > 15 * k
    OR n_dup_lines > 0.3 * (length(text) - length(replace(text, chr(10), '')) + 1)
    OR length(text) - length(replace(text, '!', '')) > 0.5 * k
    OR length(regexp_replace(text, '[\p{{L}}\x20\x09-\x0D]', '', 'g')) > 0.4 * word_chars
    OR length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) > 0.6 * word_chars) AS kept
FROM b
"""


def _license_sql() -> str:
    from .license_scan import EQUIVALENT, KNOWN, shipped_digests

    form = r"'  ' || regexp_replace(regexp_replace(lower(coalesce({t}, '')), '(?m)^[^\p{{L}}\p{{N}}\n]*(copyright|\(c\)|©|all rights reserved)[^\n]*$', '', 'g'), '[^\p{{L}}\p{{N}}]+', '  ', 'g') || '  '"
    for a, b in EQUIVALENT:
        a, b = a.replace(" ", "  "), b.replace(" ", "  ")
        form = f"replace({form}, ' {a} ', ' {b} ')"
    form = f"trim(regexp_replace({form}, ' +', ' ', 'g'))"
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(a)}, {quote(b)})" for a, b in KNOWN)
    shipped = ", ".join(f"({quote(digest)}, {quote(name)})" for name, digest, _ in shipped_digests())
    return f"""
WITH k AS (
  SELECT digest, min(license) AS license
  FROM (SELECT sha256({form.format(t="body")}) AS digest, license FROM (VALUES {known}) AS v(license, body)
        UNION ALL SELECT * FROM (VALUES {shipped}) AS s(digest, license)) GROUP BY 1
),
f AS (SELECT doc_id, {form.format(t="text")} AS form FROM documents),
l AS (
  SELECT doc_id, license, count(*) AS n
  FROM (SELECT doc_id, sha256({form.format(t="line")}) AS digest
        FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents))
  JOIN k USING (digest) GROUP BY 1, 2
),
d AS (SELECT doc_id, sum(n)::BIGINT AS n, string_agg(license, ', ' ORDER BY license) AS line_licenses FROM l GROUP BY 1)
SELECT f.doc_id, sha256(form) AS canonical_sha256, length(form) AS canonical_length,
  CASE WHEN form <> '' THEN k.license END AS license, coalesce(d.n, 0) AS n_license_lines, line_licenses
FROM f LEFT JOIN k ON sha256(form) = k.digest LEFT JOIN d ON f.doc_id = d.doc_id
"""


op2_license_scan = _license_sql()

# The shares by weight with caps, in closed form: sources in the order of (2 * size / weight)
# are capped as long as the share per weight of the others exceeds that ratio.
op5_source_mix = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('11:' || doc_id) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(k % 3 + 1)::INT] AS w FROM s),
c AS (
  SELECT *, 1.5 * sum(n) OVER () - coalesce(sum(2 * n) OVER o, 0) AS remaining, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS left_w
  FROM w WINDOW o AS (ORDER BY 2.0 * n / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT remaining / left_w AS v FROM c WHERE remaining / left_w * w <= 2 * n ORDER BY 2.0 * n / w, k LIMIT 1),
t AS (SELECT source, n, least(2.0 * n, w * v) AS target FROM c, level),
q AS (SELECT source, n, target, floor(target + 0.5)::BIGINT AS quota FROM t),
r AS (
  SELECT doc_id, d.source, size, n, target, quota, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, n AS source_size, target,
  CASE WHEN n = 0 THEN 0 ELSE (quota // n) * size + greatest(0, least(size, quota % n - before)) END::BIGINT AS taken, source
FROM r
"""

op3_recompression = rf"""
WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)
),
first AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (g) WHERE d < doc_id)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

op4_bwt_dedup = """
WITH t AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
win AS (SELECT doc_id, i, x[2 * i - 1 : 2 * i + 98] AS g FROM (SELECT doc_id, x, unnest(range(1, len(x) // 2 - 48)) AS i FROM t WHERE len(x) >= 100)),
first AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win JOIN first USING (g) WHERE d < doc_id),
run AS (SELECT *, i > 50 + coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -100) AS fresh FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 49 AS z FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM run) GROUP BY doc_id, k),
keep AS (
  SELECT doc_id, z + 1 AS a, coalesce(lead(a) OVER (PARTITION BY doc_id ORDER BY a) - 1, 1000000000) AS z, 1 AS n FROM span
  UNION ALL SELECT doc_id, 1, min(a) - 1, 0 FROM span GROUP BY doc_id
),
kept AS (SELECT doc_id, string_agg(x[2 * a - 1 : 2 * z], '' ORDER BY a) AS x, sum(n) AS n FROM keep JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, len(t.x) // 2 AS n_bytes, (len(t.x) - len(coalesce(k.x, t.x))) // 2 AS n_removed, coalesce(k.n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(k.x, t.x))) AS kept_sha256
FROM t LEFT JOIN kept k USING (doc_id)
"""

# CRC-32 of each distinct feature, a byte at a time from a table made by the rule of its polynomial
op13_importance_resampling = r"""
WITH steps AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
),
txt AS (
  SELECT 's' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark
),
w AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM txt
),
f AS (
  SELECT side, id, unnest(w) AS f FROM w
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM w
),
h AS (SELECT f, lower(hex(encode(f))) AS x FROM (SELECT DISTINCT f FROM f)),
c AS (
  SELECT f, xor(list_reduce(
      list_concat([4294967295], list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
      lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM h, steps
),
b AS (SELECT side, id, bucket, count(*) AS n FROM f JOIN c USING (f) GROUP BY ALL),
s AS (SELECT bucket, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t FROM b GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM s) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s
),
d AS (SELECT id AS doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * g)::DOUBLE / sum(n))::BIGINT AS weight FROM b JOIN gain USING (bucket) WHERE side = 's' GROUP BY id),
r AS (
  SELECT w.id AS doc_id, len(w.w) >= 20 AS long, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || w.id)[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN d ON w.id = d.doc_id WHERE w.side = 's'
),
k AS (SELECT *, row_number() OVER (PARTITION BY long ORDER BY score DESC, doc_id) AS k, 25 * count(*) FILTER (long) OVER () // 100 AS n FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN long AND k <= n THEN k END AS rank FROM k
"""
