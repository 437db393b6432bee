"""Text documents, tokens, gates, clean-up, ids, the query box, URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.functions import fulltext, text
from skerry.operators import aggregates
from skerry.queries.base import query
from skerry.sources.shared import new_path


@query("""
    SELECT conv_id AS video_id, coalesce(role, '') AS entity_id, string_agg(text, chr(10) ORDER BY turn, text) FILTER (coalesce(text, '') <> '') AS text,
           (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT CASE WHEN c.turn % 2 = 0 THEN 'asr' ELSE 'ocr' END AS x FROM conversations c WHERE c.conv_id = o.conv_id AND c.role IS NOT DISTINCT FROM o.role)) AS source_types,
           CASE count(DISTINCT nullif(['en', '', 'de'][turn % 3 + 1], '')) WHEN 0 THEN 'und' WHEN 1 THEN min(nullif(['en', '', 'de'][turn % 3 + 1], '')) ELSE 'mul' END AS language
    FROM conversations o GROUP BY conv_id, role""".replace("string_agg(text, chr(10) ORDER BY turn, text) FILTER (coalesce(text, '') <> '')", "coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (coalesce(text, '') <> ''), '')"))
def text_documents(t):
    d = t("conversations").select(
        F.col("conv_id").alias("video_id"), F.lit("turn").alias("entity_type"), F.col("role").alias("entity_id"), F.col("turn").alias("pos"), "text",
        F.when(F.col("turn") % 2 == 0, "asr").otherwise("ocr").alias("source_type"), F.get(F.array(F.lit("en"), F.lit(""), F.lit("de")), (F.col("turn") % 3).cast("int")).alias("language"),
    )
    return aggregates.text_documents(d).drop("entity_type").withColumn("entity_id", F.coalesce("entity_id", F.lit("")))


_TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


@query(rf"SELECT token, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest({_TOKENS_SQL}) AS token FROM documents) GROUP BY token")
def token_index(t):
    # tokens are distinct per document, so counting rows counts documents
    return text.inverted(t("documents"), "doc_id", F.col("text")).groupBy("token").agg(F.count(F.lit(1)).alias("docs"))


@query(rf"SELECT DISTINCT doc_id FROM documents WHERE list_contains({_TOKENS_SQL}, 'license') AND list_contains({_TOKENS_SQL}, 'apache')")
def token_match(t):
    lower, words = F.lower("text"), text.tokens(F.col("text"))
    d = t("documents").filter(lower.contains("license") & lower.contains("apache"))
    return d.filter(F.array_contains(words, "license") & F.array_contains(words, "apache")).select("doc_id").distinct()


@query(rf"SELECT DISTINCT doc_id FROM documents WHERE list_contains({_TOKENS_SQL}, 'license') AND list_contains({_TOKENS_SQL}, 'apache')")
def token_search(t):
    """The same by an index that is stored first; the search reads the folders of its two tokens."""
    path = new_path(t.spark, "token-index")
    text.write_inverted(t("documents"), "doc_id", F.col("text"), path)
    return text.search_inverted(t.spark.read.parquet(path), ["License", "apache"], "doc_id")


#: Probes of one stored index: phrases that must all be there.
_PROBES = {"accents": ["CIÓN"], "phrase": ["Apache  License"], "both": ["de-la", "QUE"], "repeated": ["the the"], "none": ["license apache gnu"]}
_TERMS_SQL = r"list_filter(regexp_split_to_array(strip_accents(lower(coalesce(text, ''))), '[^\p{L}\p{N}]+'), lambda w: w <> '')"


def _hits_sql(phrase: str) -> str:
    words = phrase.split()
    same = " AND ".join(f"coalesce(w[i + {k}] = '{x}', FALSE)" for k, x in enumerate(words))
    return f"len(list_filter(range(1, len(w) + 1), lambda i: {same}))"


@query(f"""
    WITH d AS (SELECT doc_id, {_TERMS_SQL} AS w FROM documents),
    h AS (SELECT 'accents' AS probe, doc_id, {_hits_sql("cion")} AS hits FROM d UNION ALL SELECT 'phrase', doc_id, {_hits_sql("apache license")} FROM d UNION ALL SELECT 'repeated', doc_id, {_hits_sql("the the")} FROM d
          UNION ALL SELECT 'both', doc_id, CASE WHEN a > 0 AND b > 0 THEN a + b ELSE 0 END FROM (SELECT doc_id, {_hits_sql("de la")} AS a, {_hits_sql("que")} AS b FROM d)
          UNION ALL SELECT 'prefix', doc_id, len(list_filter(w, lambda x: starts_with(x, 'licen'))) FROM d)
    SELECT probe, doc_id, hits::BIGINT AS hits FROM h WHERE hits > 0""")
def fulltext_probes(t):
    """Words, phrases and a prefix, looked up in one stored table of positions."""
    path = new_path(t.spark, "fulltext")
    fulltext.write_index(t("documents"), "doc_id", F.col("text"), path)
    index = t.spark.read.parquet(path)
    found = [fulltext.matching(index, "doc_id", phrases).select(F.lit(name).alias("probe"), "doc_id", "hits") for name, phrases in _PROBES.items()]
    found.append(fulltext.prefixed(index, "doc_id", "Licén").select(F.lit("prefix").alias("probe"), "doc_id", "hits"))
    return reduce(DataFrame.unionAll, found)


@query(r"SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda w: length(w) >= 4)[1] AS token, length(array_to_string(w, '')) <= 40 OR len(w) <= 12 AS low FROM (SELECT *, list_filter(regexp_split_to_array(replace(lower(nfc_normalize(coalesce(text, ''))), 'ß', 'ss'), '[^\p{L}\p{N}_]+'), lambda w: w <> '') AS w FROM documents)")
def token_sample(t):
    return t("documents").select("doc_id", text.sample_token(F.col("text"), 4).alias("token"), text.low_information(F.col("text"), 40, 12).alias("low"))


@query(r"""
    WITH c AS (SELECT vec_id, concat_ws('', repeat('a', (vec_id % 5)::INT), repeat('B', (vec_id % 3)::INT), repeat('b', (vec_id % 4)::INT), 'xyz') AS s FROM embeddings),
    k AS (SELECT vec_id, s, unnest(range(1, length(s) + 1)) AS i FROM c), l AS (SELECT *, lower(s[i]) AS x FROM k),
    g AS (SELECT *, i - row_number() OVER (PARTITION BY vec_id, x ORDER BY i) AS island FROM l), r AS (SELECT vec_id, s, count(*) AS n FROM g GROUP BY vec_id, s, x, island)
    SELECT vec_id, round(max(n) / length(s)::DOUBLE, 6) AS ratio FROM r GROUP BY vec_id, s""")
def char_run_ratio(t):
    n = F.col("vec_id")
    s = F.concat(F.repeat(F.lit("a"), (n % 5).cast("int")), F.repeat(F.lit("B"), (n % 3).cast("int")), F.repeat(F.lit("b"), (n % 4).cast("int")), F.lit("xyz"))
    return t("embeddings").select("vec_id", F.round(text.longest_run_ratio(s), 6).alias("ratio"))


@query(r"""
    WITH x AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'a' WHEN 2 THEN 'aaaaaaaaaa' WHEN 3 THEN repeat('word ', 40) ELSE 'plain words here' END AS s, (event_id % 9)::DOUBLE AS sec,
                      CASE WHEN event_id % 17 = 0 THEN NULL ELSE (event_id % 100) / 100.0::DOUBLE END AS blank, (event_id % 50) / 100.0::DOUBLE AS post, (event_id % 101) / 100.0::DOUBLE AS ent FROM events),
    y AS (SELECT *, regexp_replace(s, '[^\p{L}\p{N}]', '', 'g') AS lex FROM x),
    z AS (SELECT *, length(lex) AS n, CASE WHEN sec > 0 THEN length(lex) / sec END AS rate FROM y)
    SELECT event_id, concat_ws(',', CASE WHEN trim(s) = '' THEN 'empty_text' END, CASE WHEN n < 2 THEN 'insufficient_lexical_content' END, CASE WHEN rate < 0.15 THEN 'character_rate_too_low' END, CASE WHEN rate > 35 THEN 'character_rate_too_high' END,
           CASE WHEN blank IS NULL THEN 'missing_acoustic_metrics' END, CASE WHEN blank > 0.985 THEN 'blank_ratio_too_high' END, CASE WHEN post < 0.02 THEN 'nonblank_posterior_too_low' END, CASE WHEN ent > 0.98 THEN 'entropy_too_high' END,
           CASE WHEN lex = 'aaaaaaaaaa' THEN 'character_repetition' END) AS reasons FROM z""")
def transcript_gate(t):
    n = F.col("event_id")
    s = F.when(n % 6 == 0, "").when(n % 6 == 1, "a").when(n % 6 == 2, "aaaaaaaaaa").when(n % 6 == 3, "word " * 40).otherwise("plain words here")
    d = t("events").select("event_id", text.transcript_reasons(s, (n % 9).cast("double"), F.when(n % 17 != 0, (n % 100) / 100), (n % 50) / 100, (n % 101) / 100).alias("reasons"))
    return d.withColumn("reasons", F.array_join("reasons", ","))


@query(r"""
    WITH x AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), y AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS n FROM x),
    b AS (SELECT doc_id, n, trim(regexp_replace(line, '^\s*(?:[-*•]+|\d+[.)])\s*', '')) AS line FROM y), c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY n) AS k FROM b WHERE line <> '' AND upper(line) <> '<NONE>')
    SELECT doc_id, count(n) AS lines, coalesce(md5(string_agg(line, chr(10) ORDER BY n)), md5('')) AS digest FROM (SELECT DISTINCT doc_id FROM documents) LEFT JOIN (SELECT * FROM c WHERE k = 1) USING (doc_id) GROUP BY doc_id""")
def line_list(t):
    return t("documents").select("doc_id", text.line_list(F.col("text")).alias("l")).select("doc_id", F.size("l").alias("lines"), F.md5(F.array_join("l", "\n")).alias("digest"))


@query(r"""
    WITH x AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda w: w <> '') AS w FROM documents),
    y AS (SELECT doc_id, unnest(w[1:200]) AS word, generate_subscripts(w[1:200], 1) AS n FROM x), z AS (SELECT *, sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING) - 1 AS used FROM y)
    SELECT x.doc_id, coalesce(string_agg(word, ' ' ORDER BY n), '') AS text FROM x LEFT JOIN (SELECT * FROM z WHERE used <= 120) z ON z.doc_id = x.doc_id GROUP BY x.doc_id""")
def bounded_words(t):
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")
    return t("documents").select("doc_id", F.array_join(text.bounded_words(words, 120), " ").alias("text"))


@query("SELECT doc_id, CASE WHEN length(text) > 100 THEN rtrim(left(text, 88)) || ' [TRUNCATED]' ELSE text END AS text FROM documents")
def bounded_text(t):
    return t("documents").select("doc_id", text.bounded(F.col("text"), 100).alias("text"))


@query("""
    SELECT c_custkey, 'name' AS source_type, c_name AS text FROM customer WHERE trim(c_name) <> '' UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer WHERE trim(c_mktsegment) <> ''
    UNION ALL SELECT c_custkey, 'nation', CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey::VARCHAR END FROM customer WHERE c_nationkey % 2 = 0""")
def text_unpivot(t):
    c = t("customer").withColumn("n", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")))
    return text.unpivoted(c, ["c_custkey"], {"c_name": "name", "c_mktsegment": "segment", "n": "nation"})


@query("SELECT doc_id, md5(strip_accents(text)) AS bare FROM documents WHERE lang IN ('en', 'fr', 'de', 'es')")
def without_marks(t):
    """Combining marks taken off; the oracle's function agrees on Latin letters, which is what these languages have."""
    return t("documents").filter(F.col("lang").isin("en", "fr", "de", "es")).select("doc_id", F.md5(text.without_marks(F.col("text"))).alias("bare"))


@query()
def comparable_text(t):
    return t("documents").select("doc_id", F.md5(text.comparable(F.col("text"))).alias("comparable"))


@query("""
    SELECT doc_id, left(sha256(concat_ws('|', doc_id::VARCHAR, lang, '', coalesce(text, ''))), 12) AS source_id, 'doc:' || left(sha256(concat_ws('|', source, doc_id::VARCHAR, coalesce(text, ''))), 16) AS document_id,
           concat_ws(' ', nullif(trim(lang), ''), nullif(trim(source), '')) AS metadata FROM documents""")
def text_ids(t):
    return t("documents").select(
        "doc_id", text.digest(F.col("doc_id"), F.col("lang"), F.lit(None), F.col("text")).alias("source_id"), text.document_id(F.col("source"), F.col("doc_id"), F.col("text")).alias("document_id"),
        text.joined(F.col("lang"), F.lit("  "), F.col("source")).alias("metadata"),
    )


_BOX_SQL = """(SELECT vector_id, collection_id AS c, collection_id || '_' || video_id AS v, keyframe_no % 999 AS k, vector_id % 7 AS form FROM {keyframes}) x"""


@query(f"""
    SELECT vector_id, CASE WHEN form = 5 THEN NULL WHEN form IN (0, 6) THEN 'red car ' || k ELSE '' END AS text, CASE WHEN form = 0 THEN c ELSE '' END AS collections,
           CASE form WHEN 1 THEN v || CASE WHEN v LIKE '%_V003' THEN '' ELSE ',' || c || '_V003' END WHEN 2 THEN v WHEN 3 THEN v WHEN 4 THEN v WHEN 5 THEN '' ELSE '' END AS videos,
           CASE WHEN form IN (2, 3) THEN v || '_' || k WHEN form = 4 THEN v || '_' || k || ',' || v || '_' || (k + 1) ELSE '' END AS keyframes,
           CASE form WHEN 5 THEN 'keyframe ids cannot be combined with other terms' END AS error
    FROM {_BOX_SQL}""")
def parse_queries(t):
    """A query string for every keyframe, in seven forms: words with a collection, videos, a keyframe, a video with a number, two keyframes, a faulty mixture, words."""
    collection, k = F.col("collection_id"), F.col("keyframe_no") % 999  # a keyframe's number has three digits at most
    number = k.cast("string")
    video = F.concat_ws("_", "collection_id", "video_id")
    frame = F.concat(video, F.lit("_"), F.lpad(number, 3, "0"))
    forms = [
        F.concat(F.lit("red car "), number, F.lit(" , "), collection), F.concat(video, F.lit(", "), video, F.lit(","), collection, F.lit("_V003")), frame, F.concat(video, F.lit(", "), number),
        F.concat(frame, F.lit(","), video, F.lit("_"), (k + 1).cast("string")), F.concat(frame, F.lit(", dog")), F.concat(F.lit(" , red,car "), number, F.lit(",")),
    ]
    d = t("keyframes").select("vector_id", text.parsed_queries(F.get(F.array(*forms), (F.col("vector_id") % 7).cast("int"))).alias("q"))
    return d.select("vector_id", "q.text", *[F.array_join(f"q.{c}", ",").alias(c) for c in ("collections", "videos", "keyframes")], "q.error")


@query("SELECT page_id, CASE WHEN page_id % 6 < 4 THEN lpad(page_id::VARCHAR, 11, '-') END AS video FROM pages")
def url_ids(t):
    """A link to a video for every page, in four shapes that have an id and two that don't: another host, an id too short."""
    video, number = F.lpad(F.col("page_id").cast("string"), 11, "-"), F.col("page_id").cast("string")
    shapes = [
        F.concat(F.lit("https://www.youtube.com/watch?t=5&v="), video), F.concat(F.lit(" https://youtu.be/"), video, F.lit("?x=1")), F.concat(F.lit("http://m.youtube.com/shorts/"), video),
        F.concat(F.lit("https://youtube.com/embed/"), video, F.lit("/")), F.col("url"), F.concat(F.lit("https://youtube.com/watch?v=x"), F.substring(number, 1, 9)),
    ]
    return t("pages").select("page_id", text.video_id_of(F.get(F.array(*shapes), (F.col("page_id") % 6).cast("int"))).alias("video"))


@query("SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END || 't=' || floor(page_id * 1.7)::BIGINT::VARCHAR || 's' AS link FROM pages")
def watch_links(t):
    return t("pages").select("page_id", text.watch_at(F.col("url"), F.col("page_id") * 1.7).alias("link"))


@query("""
    WITH x AS (SELECT page_id, replace(replace(replace(replace(replace(coalesce(html, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS h FROM pages)
    SELECT page_id, '| page | ' || page_id::VARCHAR || ' |' || chr(10) || '| html | ' || h || ' |' AS rows FROM x""")
def detail_rows(t):
    return t("pages").select("page_id", text.detail_table({"page": F.col("page_id"), "html": F.col("html")}).alias("rows"))


@query("SELECT page_id, regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '_', 'g') AS stem FROM pages")
def file_stems(t):
    return t("pages").select("page_id", text.file_stem(F.col("url")).alias("stem"))


@query("""
    SELECT conv_id, string_agg(trim(text), ' ' ORDER BY turn, trim(text)) AS text FROM conversations WHERE text IS NOT NULL GROUP BY conv_id""")
def ordered_transcript(t):
    return text.transcript(t("conversations").filter("text IS NOT NULL"), "conv_id", ["turn"], "text")


@query(r"""
    SELECT page_id, CASE WHEN upper(s) = '<NONE>' THEN '' ELSE s END AS summary FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '<none>' ELSE trim(regexp_replace(html, '\s+', ' ', 'g')) END AS s FROM pages)""")
def optional_texts(t):
    return t("pages").select("page_id", text.optional_text(F.when(F.col("page_id") % 5 == 0, " <none>\n").otherwise(F.col("html"))).alias("summary"))


@query("SELECT event_id, concat_ws(',', CASE WHEN event_id % 2 = 0 THEN 'even' END, CASE WHEN event_id % 3 = 0 THEN 'three' END, event_type) AS keywords FROM events")
def keyword_lists(t):
    raw = F.array(F.when(F.col("event_id") % 2 == 0, " even ").otherwise(" "), F.when(F.col("event_id") % 3 == 0, "three").otherwise(""), F.col("event_type"))
    return t("events").select("event_id", F.array_join(text.string_list(raw), ",").alias("keywords"))
