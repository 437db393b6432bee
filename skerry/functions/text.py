"""Text functions: ids, normalisation, tokens, gates, list and line clean-up, the query box, URLs."""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def joined(*parts: Column, by: str = " ") -> Column:
    """The non-blank parts, trimmed, joined."""
    return F.concat_ws(by, *[blank_to_null(p.cast("string")) for p in parts])


def digest(*parts: Column, size: int = 12) -> Column:
    """The first hex digits of the sha256 of the parts joined by |; null counts as empty."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, size)


def document_id(source_type: Column, entity_id: Column, text: Column) -> Column:
    return F.concat(F.lit("doc:"), digest(source_type, entity_id, text, size=16))


def _series(f):
    """A string function as an Arrow-batched UDF, made when a session exists; null stays null."""

    def column(c: Column) -> Column:
        @F.pandas_udf(T.StringType())
        def run(values: pd.Series) -> pd.Series:
            return values.map(lambda x: None if x is None else f(x))

        return run(c)

    return column


def _bare(text: str) -> str:
    return text if text.isascii() else "".join(x for x in unicodedata.normalize("NFD", text) if unicodedata.category(x) != "Mn")


def _comparable(text: str) -> str:
    return " ".join(re.findall(r"\w+", unicodedata.normalize("NFKC", text).casefold()))


#: Text without combining marks after NFD; letters with a stroke stay, case stays.
without_marks = _series(_bare)
#: NFKC, case folded, words joined by a space: for comparisons.
comparable = _series(_comparable)


def folded(c: Column) -> Column:
    """Text for comparisons without case, as full case folding has it: ß equals ss, all three sigmas are one letter."""
    # without a step between them Catalyst takes lower(upper(x)) for lower(x)
    return F.lower(F.translate(F.upper(c), "Σ", "σ"))


def tokens(c: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def inverted(docs: DataFrame, id_column: str, text: Column) -> DataFrame:
    """token, id: the distinct tokens of each document, for look-ups by token."""
    return docs.select(F.explode(F.array_distinct(tokens(text))).alias("token"), F.col(id_column))


def write_inverted(docs: DataFrame, id_column: str, text: Column, path: str, parts: int = 256) -> None:
    """Stores the inverted table, one folder for each hash class of tokens, so that a search reads those of its tokens only."""
    index = inverted(docs, id_column, text).withColumn("part", F.pmod(F.xxhash64("token"), F.lit(parts)).cast("int"))
    index.repartition("part").sortWithinPartitions("token").write.partitionBy("part").parquet(path)


def search_inverted(index: DataFrame, words: list[str], id_column: str, parts: int = 256) -> DataFrame:
    """Ids of the documents that have all words; index as read from where write_inverted has put it."""
    wanted = F.array_distinct(tokens(F.lit(" ".join(words))))
    found = sorted(set(index.sparkSession.range(1).select(F.explode(wanted).alias("t"), F.pmod(F.xxhash64("t"), F.lit(parts)).cast("int")).collect()))
    rows = index.filter(F.col("part").isin([r[1] for r in found]) & F.col("token").isin([r[0] for r in found]))
    return rows.groupBy(id_column).agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(found)).select(id_column)


def sample_token(c: Column, least: int = 2) -> Column:
    """The first word by white space of at least so many characters."""
    return F.get(F.filter(F.split(c, r"\s+"), lambda w: F.char_length(w) >= least), F.lit(0))


def low_information(c: Column, chars: int, words: int) -> Column:
    """At most so many characters or words after ``comparable``: NFKC, case folded, runs of word characters."""
    t = comparable(F.coalesce(c, F.lit("")))
    bare = F.char_length(F.replace(t, F.lit(" "), F.lit("")))
    return (bare <= chars) | (F.when(t == "", 0).otherwise(F.size(F.split(t, " "))) <= words)


def longest_run_ratio(c: Column) -> Column:
    """Length of the longest run of one character over the length; null for an empty text."""
    longest = F.array_max(F.transform(F.regexp_extract_all(F.lower(c), F.lit(r"((.)\2*)"), F.lit(1)), lambda r: F.char_length(r)))
    return F.when(F.char_length(c) > 0, longest / F.char_length(c))


class Gate(NamedTuple):
    """Limits of the transcript gate."""

    min_lexical_chars: int = 2
    min_characters_per_second: float = 0.15
    max_characters_per_second: float = 35.0
    max_blank_argmax_ratio: float = 0.985
    min_mean_nonblank_posterior: float = 0.02
    max_normalized_entropy: float = 0.98
    repeat_check_min_chars: int = 6
    max_same_character_run_ratio: float = 0.75
    require_acoustic_metrics: bool = True


def transcript_reasons(text: Column, seconds: Column, blank: Column, posterior: Column, entropy: Column, gate: Gate = Gate()) -> Column:
    """Reason codes against a transcript, empty if it is accepted."""
    text = F.coalesce(text, F.lit(""))
    lexical = F.regexp_replace(text, r"[^\p{L}\p{N}]", "")
    n = F.char_length(lexical)
    rate = F.when(seconds > 0, n / seconds)
    rules = [
        (F.trim(text) == "", "empty_text"),
        (n < gate.min_lexical_chars, "insufficient_lexical_content"),
        (rate < gate.min_characters_per_second, "character_rate_too_low"),
        (rate > gate.max_characters_per_second, "character_rate_too_high"),
        (F.lit(gate.require_acoustic_metrics) & (blank.isNull() | posterior.isNull() | entropy.isNull()), "missing_acoustic_metrics"),
        (blank > gate.max_blank_argmax_ratio, "blank_ratio_too_high"),
        (posterior < gate.min_mean_nonblank_posterior, "nonblank_posterior_too_low"),
        (entropy > gate.max_normalized_entropy, "entropy_too_high"),
        ((n >= gate.repeat_check_min_chars) & (longest_run_ratio(lexical) > gate.max_same_character_run_ratio), "character_repetition"),
    ]
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for rule, name in rules]))


def string_list(values: Column) -> Column:
    """Trimmed non-blank strings of an array."""
    return F.filter(F.transform(values, lambda x: F.trim(x)), lambda x: x != "")


def keep_first(values: Column, key=lambda x: x) -> Column:
    """Array without later elements of equal key."""
    rows = F.array_sort(F.transform(values, lambda x, i: F.struct(key(x).alias("key"), i.alias("place"), x.alias("value"))))
    # the one-element array gives the sorted rows a name, so they are sorted once and not for each element
    first = F.transform(F.array(rows), lambda r: F.filter(r, lambda x, i: (i == 0) | ~F.get(r, i - 1)["key"].eqNullSafe(x["key"])))
    return F.transform(F.array_sort(F.transform(F.get(first, F.lit(0)), lambda x: F.struct(x["place"].alias("place"), x["value"].alias("value")))), lambda x: x["value"])


def line_list(raw: Column) -> Column:
    """Lines without bullets and numbering, blanks and <NONE> dropped, the first of equal ones (without case) kept."""
    bare = F.transform(F.split(F.coalesce(raw, F.lit("")), "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s*(?:[-*•]+|\d+[.)])\s*", "")))
    return keep_first(F.filter(bare, lambda x: (x != "") & (F.upper(x) != "<NONE>")), lambda x: F.lower(x))


def optional_text(raw: Column) -> Column:
    """Lines collapsed to one; empty for <NONE>."""
    t = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), r"\s+", " "))
    return F.when(F.upper(t) == "<NONE>", "").otherwise(t)


def required_text(raw: Column, what: str) -> Column:
    t = optional_text(raw)
    return F.when(t != "", t).otherwise(F.raise_error(F.lit(f"{what} is empty")))


def bounded(c: Column, most: int, marker: str = " [TRUNCATED]") -> Column:
    """Text cut to most characters, marker included and the cut end trimmed."""
    return F.when(F.char_length(c) > most, F.concat(F.rtrim(F.substring(c, 1, most - len(marker))), F.lit(marker))).otherwise(c)


def bounded_words(words: Column, most: int) -> Column:
    """The longest prefix of whole words that fits most characters with single spaces."""
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("kept"), F.lit(True).alias("open"))

    def step(a: Column, w: Column) -> Column:
        used = a["used"] + F.char_length(w) + F.when(a["kept"] > 0, 1).otherwise(0)
        fits = a["open"] & (used <= most)
        return F.struct(F.when(fits, used).otherwise(a["used"]).alias("used"), F.when(fits, a["kept"] + 1).otherwise(a["kept"]).alias("kept"), fits.alias("open"))

    return F.slice(words, F.lit(1), F.aggregate(words, start, step, lambda a: a["kept"]))


def transcript(rows: DataFrame, group: str, order: list[str], word: str) -> DataFrame:
    """The words of each group in order, joined by spaces."""
    return rows.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.trim(word).alias("w")))), lambda x: x["w"]), " ").alias("text"))


def unpivoted(d: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """One row per non-blank text column: keys, source_type, text."""
    rows = F.array(*[F.struct(F.lit(kind).alias("source_type"), F.col(c).cast("string").alias("text")) for c, kind in columns.items()])
    return d.select(*keys, F.inline(rows)).filter(F.trim(F.coalesce("text", F.lit(""))) != "")


def recognised_text(full: Column, blocks: Column) -> Column:
    """The full text of a recogniser, else its blocks' texts (array of strings), joined by spaces."""
    return F.coalesce(blank_to_null(full), F.array_join(string_list(F.coalesce(blocks, F.array().cast("array<string>"))), " "))


def without_prefix(words: Column, removed: Column) -> Column:
    """Words (array) without the leading ones that make up a removed text, compared without case and marks; null if none of its beginnings do."""
    bare = lambda c: F.array_join(tokens(c), " ")
    wanted = bare(removed)
    counts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))), lambda k: bare(F.array_join(F.slice(words, F.lit(1), k), " ")) == wanted)
    return F.when(wanted == "", words).when(F.size(counts) > 0, F.slice(words, F.get(counts, F.lit(0)) + 1, F.greatest(F.size(words), F.lit(1))))


def query_plan(query: Column, language: Column, detected: Column, translate: Column) -> Column:
    """struct(text, language, detected, translate): whether a query has to be translated before it is encoded.

    translate: an explicit choice, or null. An explicit yes needs no detection; without a choice English queries, declared
    or detected, stay. A blank query or an unknown language is an error.
    """
    asked = F.lower(F.trim(F.coalesce(language, F.lit("auto"))))
    known = F.when(asked.isin("auto", "english", "vietnamese"), asked).otherwise(F.raise_error(F.concat(F.lit("unsupported query language "), asked)))
    wanted = F.coalesce(translate, known != "english")
    seen = F.when(~wanted, "not_checked").when(translate.isNotNull(), "vietnamese").when(known == "auto", detected).otherwise(known)
    return F.struct(required_text(query, "query").alias("text"), known.alias("language"), seen.alias("detected"), (wanted & (seen != "english")).alias("translate"))


def labelled_lines(title: str, values: dict[str, Column]) -> Column:
    """A title and 'NAME: value' lines: YES or NO for booleans, three digits for fractions, <NONE> for what is missing or empty. values: already cast to their types."""
    return F.concat_ws("\n", F.lit(title), *[F.concat(F.lit(f"{k.upper()}: "), F.coalesce(F.nullif(v, F.lit("")), F.lit("<NONE>"))) for k, v in values.items()])


def yes_no(c: Column) -> Column:
    return F.when(c, "YES").otherwise("NO")


def file_stem(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"[^A-Za-z0-9._-]+", "_")


# ---- the query box


class Query(NamedTuple):
    text: str
    collections: tuple[str, ...] = ()
    videos: tuple[str, ...] = ()
    keyframes: tuple[tuple[str, int], ...] = ()


#: Fixed patterns of ids in the query box, case-sensitive; digits are those of any script.
COLLECTION, VIDEO, KEYFRAME, NUMBER = r"L\d+", r"L\d+_V\d+", r"(L\d+_V\d+)_(\d{1,3})", r"\d{1,4}"


def parse_query(raw: str | None) -> Query:
    """Comma-separated terms: exact keyframes stand alone, a number needs one video and nothing else, the rest is text within a scope."""
    terms = [t.strip() for t in (raw or "").split(",") if t.strip()]
    kinds: dict[str, list[str]] = {"keyframe": [], "video": [], "collection": [], "number": [], "text": []}
    for t in terms:
        kind = next((k for k, p in (("keyframe", KEYFRAME), ("video", VIDEO), ("collection", COLLECTION), ("number", NUMBER)) if re.fullmatch(p, t)), "text")
        kinds[kind].append(t)
    if kinds["keyframe"] and len(kinds["keyframe"]) < len(terms):
        raise ValueError("keyframe ids cannot be combined with other terms")
    if kinds["number"] and not (len(terms) == 2 and len(kinds["number"]) == len(kinds["video"]) == 1):
        raise ValueError("a keyframe number goes with exactly one video id")
    if kinds["number"]:
        pairs = [(kinds["video"][0], int(kinds["number"][0]))]
    else:
        pairs = [(m[1], int(m[2])) for m in (re.fullmatch(KEYFRAME, t) for t in kinds["keyframe"])]
    if pairs:
        return Query("", videos=tuple(dict.fromkeys(v for v, _ in pairs)), keyframes=tuple(dict.fromkeys(pairs)))
    return Query(" ".join(kinds["text"]), tuple(dict.fromkeys(kinds["collection"])), tuple(dict.fromkeys(kinds["video"])))


def parsed_queries(c: Column) -> Column:
    """The same for a column: struct(text, collections, videos, keyframes, error)."""
    terms = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")
    is_ = lambda p: lambda t: t.rlike(f"(?U)^{p}$")
    key, video, coll, number = (F.filter(terms, is_(p)) for p in (KEYFRAME, VIDEO, COLLECTION, NUMBER))
    text = F.filter(terms, lambda t: ~(is_(KEYFRAME)(t) | is_(VIDEO)(t) | is_(COLLECTION)(t) | is_(NUMBER)(t)))
    mixed = (F.size(key) > 0) & (F.size(key) < F.size(terms))
    loose = (F.size(number) > 0) & ~((F.size(terms) == 2) & (F.size(number) == 1) & (F.size(video) == 1))
    pairs = F.when(F.size(number) > 0, F.array(F.concat(video[0], F.lit("_"), number[0].cast("int").cast("string")))).otherwise(
        F.transform(key, lambda t: F.concat(F.regexp_extract(t, f"(?U)^{KEYFRAME}$", 1), F.lit("_"), F.regexp_extract(t, f"(?U)^{KEYFRAME}$", 2).cast("int").cast("string")))
    )
    error = F.when(mixed, "keyframe ids cannot be combined with other terms").when(loose, "a keyframe number goes with exactly one video id")
    fine = error.isNull()
    none = F.array().cast("array<string>")
    videos = F.when(F.size(key) > 0, F.array_distinct(F.transform(key, lambda t: F.regexp_extract(t, f"(?U)^{KEYFRAME}$", 1)))).otherwise(F.array_distinct(video))
    return F.struct(
        F.when(fine, F.array_join(text, " ")).alias("text"), F.when(fine, F.array_distinct(coll)).otherwise(none).alias("collections"),
        F.when(fine, videos).otherwise(none).alias("videos"), F.when(fine, F.array_distinct(pairs)).otherwise(none).alias("keyframes"), error.alias("error"),
    )


# ---- URLs


def video_id_of(url: Column) -> Column:
    """The 11-character id of four URL shapes of the allowed hosts, else null."""
    u = F.trim(url)
    parts = lambda k: F.regexp_extract(u, r"^(https?)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", k)
    host = F.regexp_replace(F.lower(parts(2)), r"^www\.", "")
    path, query = parts(3), parts(4)
    watch = F.regexp_extract(F.concat(F.lit("&"), query), r"&v=([\w-]{11})(?:&|$)", 1)
    short = F.regexp_extract(path, r"^/([\w-]{11})(?:/.*)?$", 1)
    embed = F.regexp_extract(path, r"^/(?:embed|shorts)/([\w-]{11})(?:/.*)?$", 1)
    found = F.when(host == "youtu.be", short).when(host.isin("youtube.com", "m.youtube.com", "music.youtube.com"), F.when(path == "/watch", watch).otherwise(embed))
    return F.nullif(found, F.lit(""))


def watch_at(url: Column, seconds: Column) -> Column:
    return F.concat(url, F.when(F.instr(url, "?") > 0, "&").otherwise("?"), F.lit("t="), F.floor(seconds).cast("string"), F.lit("s"))


def escaped(c: Column) -> Column:
    """Text for HTML."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def detail_table(fields: dict[str, Column]) -> Column:
    """Rows 'name | value' with escaped values, one per line."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"| {k} | "), escaped(F.coalesce(v.cast("string"), F.lit(""))), F.lit(" |")) for k, v in fields.items()])
