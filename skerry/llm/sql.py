"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

#: Fixed values of skerry.llm.quality, written out for SQL.
ORACLE["op7_quality"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, lang, source, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), windows AS (
  SELECT r, i, concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)
), repeated AS (
  SELECT r, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1)
  GROUP BY r
), counted AS (
  SELECT s.*, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, word_chars::DOUBLE / greatest(n_words, 1) AS wlen,
         ln((n_symbols + 1)::DOUBLE / (n_words + 1)) AS symbols, ln((n_dup_lines + 1)::DOUBLE / (len(lines) + 1)) AS dup_lines,
         ln((n_repeat_words + 1)::DOUBLE / (n_words + 1)) AS repeats
  FROM counted
), long AS (
  SELECT lang, source, unnest(['s', 'l', 'p', 'c']) AS metric, unnest([symbols, dup_lines, repeats, ln(greatest(wlen, 1e-9))]) AS v FROM judged WHERE NOT base_failed
), grouped AS (
  SELECT metric, lang, source, GROUPING(metric, lang, source) AS level, count(*)::DOUBLE AS size, list_sort(list(v)) AS v FROM long
  GROUP BY GROUPING SETS ((metric, lang, source), (metric, lang), (metric))
), quartiles AS (
  SELECT metric, lang, source, level, size, v[ceil(0.25::DOUBLE * size)::INT] AS lo, v[ceil(0.75::DOUBLE * size)::INT] AS hi FROM grouped
), fixed(metric, reach, smallest) AS (
  VALUES ('s', 2.0::DOUBLE, ln(3.0::DOUBLE)), ('l', 3.0::DOUBLE, ln(3.0::DOUBLE)), ('p', 3.0::DOUBLE, ln(3.0::DOUBLE)), ('c', 6.0::DOUBLE, 0.04::DOUBLE)
), languages AS (
  SELECT x.metric, x.lang, (x.lo * x.size + a.lo * 20) / (x.size + 20) AS lo, (x.hi * x.size + a.hi * 20) / (x.size + 20) AS hi
  FROM quartiles x JOIN quartiles a ON x.metric = a.metric AND x.level = 1 AND a.level = 3
), groups AS (
  SELECT x.metric, x.lang, x.source, (x.lo * x.size + a.lo * 20) / (x.size + 20) AS lo, (x.hi * x.size + a.hi * 20) / (x.size + 20) AS hi, a.lo AS lang_lo, a.hi AS lang_hi
  FROM quartiles x JOIN languages a ON x.metric = a.metric AND x.lang IS NOT DISTINCT FROM a.lang AND x.level = 0
), bounds AS (
  SELECT lang, source, max(most) FILTER (metric = 's') AS s, max(most) FILTER (metric = 'l') AS l, max(most) FILTER (metric = 'p') AS p,
         max(most) FILTER (metric = 'c') AS c, max(least) FILTER (metric = 'c') AS d
  FROM (
    SELECT *, exp(least(hi + reach * greatest(hi - lo, smallest), lang_hi + (reach + 1) * greatest(lang_hi - lang_lo, smallest))) AS most,
           exp(lo - reach * greatest(hi - lo, smallest)) AS least
    FROM groups JOIN fixed USING (metric)
  ) GROUP BY lang, source
), joined AS (
  SELECT j.*, b.s, b.l, b.p, b.c, b.d FROM judged j LEFT JOIN bounds b ON j.lang IS NOT DISTINCT FROM b.lang AND j.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce((n_symbols - 2 * sqrt(n_symbols)) / greatest(n_words, 1) > s OR (n_dup_lines - 2 * sqrt(n_dup_lines)) / greatest(len(lines), 1) > l
         OR (n_repeat_words - 2 * sqrt(n_repeat_words)) / greatest(n_words, 1) > p OR wlen > c OR wlen < d, FALSE) AS kept
FROM joined
"""

ORACLE["op3_lines"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT r, doc_id, generate_subscripts(l, 1) AS line_no, unnest(l) AS line FROM (SELECT r, doc_id, string_split(text, chr(10)) AS l FROM docs)
), parsed AS (
  SELECT r, doc_id, line_no, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS t FROM lines
), fit AS (
  SELECT r, doc_id, line_no, len(t) AS n,
         CASE WHEN len(t) < 5 AND len(list_filter(t, lambda w: NOT regexp_matches(w, '[0-9]'))) = 0 THEN t
              ELSE list_transform(t, lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END) END AS t
  FROM parsed WHERE len(t) >= 1
), keyed AS (
  SELECT r, doc_id, line_no, n, t[1:3] AS lead, f,
         list_transform(range(0, 5), lambda k: CASE WHEN k = f THEN NULL ELSE array_to_string(t[3 + greatest(n - 3, 0) * k // 5 + 1:3 + greatest(n - 3, 0) * (k + 1) // 5], ' ') END) AS template
  FROM (SELECT *, unnest(CASE WHEN n >= 5 THEN range(0, 5) ELSE [-1] END) AS f FROM fit)
), homes AS (
  SELECT r, line_no, doc_id, min(doc_id) OVER (PARTITION BY n, lead, f, template) AS home FROM keyed
), lost AS (
  SELECT r, line_no FROM homes GROUP BY r, line_no, doc_id HAVING doc_id > min(home)
), marked AS (
  SELECT l.r, l.line_no, l.line, x.r IS NOT NULL AS gone FROM lines l LEFT JOIN lost x ON l.r = x.r AND l.line_no = x.line_no
), rebuilt AS (
  SELECT r, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS kept
  FROM marked GROUP BY r
)
SELECT doc_id, n_lines, n_dropped, length(kept)::BIGINT AS kept_chars, sha256(kept) AS kept_sha256 FROM rebuilt JOIN docs USING (r)
"""


def _sharding(limit: int) -> str:
    return f"""
WITH keyed AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), small AS (SELECT * FROM keyed WHERE n_bytes <= {limit}),
levels AS (
  SELECT d, h >> (60 - d) AS prefix, count(*) AS docs, sum(n_bytes)::BIGINT AS bytes, min(h) < max(h) AND sum(n_bytes) > {limit} AS splits
  FROM small, range(0, 41) AS t(d) GROUP BY 1, 2
), found AS (
  SELECT doc_id, n_bytes, h, min(d) AS d FROM small JOIN levels ON prefix = h >> (60 - d) WHERE NOT splits GROUP BY ALL
)
SELECT doc_id, n_bytes, CASE WHEN f.d = 0 THEN '' ELSE right(lpad(bin(prefix), 60, '0'), f.d::INT) END AS shard, f.d::BIGINT AS depth,
       docs::BIGINT AS shard_docs, bytes AS shard_bytes, bytes <= {limit} AS fits
FROM found f JOIN levels l ON l.d = f.d AND prefix = h >> (60 - f.d)
UNION ALL
SELECT doc_id, n_bytes, 'large-' || h, 0, 1, n_bytes, FALSE FROM keyed WHERE n_bytes > {limit}
"""


ORACLE["op6_sharding"] = _sharding(64 << 20)
ORACLE["sharding_64k"] = _sharding(64 << 10)

#: Without the masks: what counts has 80 % of a window's words in place, so a run of this many words agrees (pigeonhole over the gaps).
ORACLE["op10_decontamination"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents
), items AS (
  SELECT *, win - ((80 * win + 99) // 100) AS gaps FROM (
    SELECT row_number() OVER () AS k, item_id, w, least(len(w), 20) AS win FROM (
      SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark
    ) WHERE len(w) >= 1
  )
), runs AS (SELECT k, w, ((win) // (gaps + 1))::BIGINT AS g FROM items),
test AS (
  SELECT k, g, p, array_to_string(w[p + 1:p + g], ' ') AS run FROM (SELECT k, w, g, unnest(range(0, len(w) - g + 1)) AS p FROM runs)
), train AS (
  SELECT r, g, p, array_to_string(w[p + 1:p + g], ' ') AS run
  FROM (SELECT r, w, g, unnest(range(0, len(w) - g + 1)) AS p FROM docs, (SELECT DISTINCT g FROM runs) WHERE len(w) >= g)
), hits AS (
  SELECT DISTINCT r, k, train.p - test.p AS o FROM train JOIN test USING (g, run)
), same AS (
  SELECT doc_id, i.item_id, win, list_transform(range(1, len(i.w) + 1), lambda p: CASE WHEN p + o >= 1 AND d.w[p + o] = i.w[p] THEN 1 ELSE 0 END) AS s
  FROM hits h JOIN docs d USING (r) JOIN items i USING (k)
), scored AS (
  SELECT doc_id, item_id, win, list_sum(s) AS agreeing, list_max(list_transform(range(0, len(s) - win + 1), lambda k: list_sum(s[k + 1:k + win]))) AS best FROM same
)
SELECT doc_id, item_id, max(agreeing)::BIGINT AS agreeing, max(best)::BIGINT AS best, max(win)::BIGINT AS "window"
FROM scored WHERE 100 * best >= 80 * win GROUP BY doc_id, item_id
"""

ORACLE["op9_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), turns AS (
  SELECT *, length('<|im_start|><|im_sep|><|im_end|>') + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLE["op12_infill"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hx FROM documents
), drawn AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || hx[1:8])::BIGINT AS h1, ('0x' || hx[9:16])::BIGINT AS h2, ('0x' || hx[17:24])::BIGINT AS h3, ('0x' || hx[25:32])::BIGINT AS h4 FROM docs
), ranks AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM ranks
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLE["op11_resampling"] = r"""
WITH RECURSIVE texts AS (
  SELECT row_number() OVER () AS r, FALSE AS wanted, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT row_number() OVER (), TRUE, NULL, coalesce(text, '') FROM benchmark
), words AS (
  SELECT r, wanted, doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM texts
), grams AS (
  SELECT r, wanted, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT r, wanted, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k)
), counted AS (SELECT r, wanted, gram, count(*) AS n FROM grams GROUP BY ALL),
start(b, v, k) AS MATERIALIZED (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM start WHERE k < 8
), entries AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM start WHERE k = 8),
hexed AS MATERIALIZED (SELECT gram, hex(encode(gram)) AS hx FROM (SELECT DISTINCT gram FROM counted)),
steps(gram, hx, i, crc) AS (
  SELECT gram, hx, 0, 4294967295 FROM hexed
  UNION ALL
  SELECT gram, hx, i + 1, xor(t[1 + (xor(crc, ('0x' || hx[2 * i + 1:2 * i + 2])::BIGINT) & 255)], crc >> 8) FROM steps, entries WHERE 2 * i < length(hx)
), hashed AS MATERIALIZED (SELECT gram, xor(crc, 4294967295) % 10000 AS bucket FROM steps WHERE 2 * i = length(hx)),
per AS MATERIALIZED (SELECT r, wanted, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (gram) GROUP BY ALL),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (NOT wanted), 0) AS s, coalesce(sum(n) FILTER (wanted), 0) AS t FROM per GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM sums) + 10000)::DOUBLE) / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM sums) + 10000)::DOUBLE)))::BIGINT AS gain FROM sums
), weighed AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM per JOIN gains USING (bucket) WHERE NOT wanted GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words d LEFT JOIN weighed USING (r) WHERE NOT d.wanted
), ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS k, 5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND k <= drawn THEN k END AS rank FROM ranked
"""
