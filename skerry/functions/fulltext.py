"""Full-text search: the tokens of a Unicode tokenizer with folded case and accents, and an inverted table with positions.

A token is a run of letters, numbers and private-use characters; an accent within it belongs to it and is dropped. Case and
accents are folded by a map made from Unicode's decompositions: a letter of ASCII with one accent is that letter, one with
two accents stays. Characters that are newer than a reader's Unicode tables may differ.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The accents that the tokenizer drops.
ACCENTS = "".join(map(chr, (*range(0x300, 0x305), *range(0x306, 0x30D), 0x30F, 0x311, 0x31B, *range(0x323, 0x329), 0x32D, 0x32E, 0x330, 0x331)))
SEPARATORS = r"[^\p{L}\p{N}\p{Co}]+"
#: Hash classes of tokens.
PARTS = 64
#: Documents whose words are looked at together.
ROWS = 256


@functools.cache
def folding() -> tuple[str, str]:
    """Characters and what each becomes, position by position; the accents, at the end, become nothing."""
    old, new = [], []
    for code in range(0x80, 0x10000):
        low = chr(code).lower()
        if len(low) > 1 or low != chr(code):  # lower() has been here before
            continue
        plain = low.casefold() if len(low.casefold()) == 1 else low
        apart = unicodedata.normalize("NFD", plain)
        if len(apart) == 2 and apart[0].isascii() and unicodedata.combining(apart[1]):
            plain = apart[0]
        if plain != low:
            old.append(low)
            new.append(plain)
    return "".join(old) + ACCENTS, "".join(new)


def folded(text: Column) -> Column:
    """Text as the index has it; texts of ASCII alone need no map."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.octet_length(low) == F.char_length(low), low).otherwise(F.translate(low, *folding()))


def terms(text: Column) -> Column:
    """The tokens of a text in their order."""
    return F.filter(F.split(folded(text), SEPARATORS), lambda w: w != "")


def part_of(token: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(parts)).cast("int")


def postings(docs: DataFrame, id_column: str, text: Column) -> DataFrame:
    """token, id, gaps: a token's places in a document, each as its distance from the one before, the first from 0.

    A document's places meet in its own row: words are neither exploded nor shuffled, only postings are.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                ids, words = batch.slice(k, ROWS).columns
                coded = words.flatten().dictionary_encode()
                if not len(coded):
                    continue
                sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), sizes)
                place = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype("int32")
                key = row * len(coded.dictionary) + coded.indices.to_numpy()
                order = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.diff(key[order], prepend=-1))
                first, place = order[starts], place[order]
                gaps = np.diff(place, prepend=np.int32(0))
                gaps[starts] = place[starts]
                listed = pa.ListArray.from_arrays(pa.array(np.append(starts, len(gaps)), pa.int32()), pa.array(gaps))
                yield pa.record_batch([coded.dictionary.take(coded.indices.take(pa.array(first))), ids.take(pa.array(row[first])), listed], names=["token", id_column, "gaps"])

    return docs.select(F.col(id_column), terms(text).alias("words")).mapInArrow(posted, f"token string, `{id_column}` {kind}, gaps array<int>")


def places(gaps: Column) -> Column:
    """The places of a posting."""
    start = F.slice(gaps, 1, 0)
    return F.aggregate(gaps, start, lambda got, gap: F.concat(got, F.array(gap + F.coalesce(F.try_element_at(got, F.lit(-1)), F.lit(0)))))


def write_index(docs: DataFrame, id_column: str, text: Column, path: str, parts: int = PARTS) -> None:
    """Stores the postings, one folder for each hash class of tokens. Spark splits a class that is large, as a token may be in every document."""
    d = postings(docs, id_column, text).withColumn("part", part_of(F.col("token"), parts))
    d.hint("rebalance", "part").sortWithinPartitions("part", "token").write.partitionBy("part").parquet(path)


def _analysed(index: DataFrame, phrase: str, parts: int) -> list[tuple[int, str, int]]:
    """(offset, token, class) of the words of a phrase."""
    one = index.sparkSession.range(1).select(F.posexplode(terms(F.lit(phrase))).alias("at", "token"))
    return sorted(tuple(r) for r in one.select("at", "token", part_of(F.col("token"), parts)).collect())


def phrase_places(index: DataFrame, id_column: str, phrase: str, parts: int = PARTS) -> DataFrame:
    """id, place: where the words of a phrase stand one after the other; reads the folders of its tokens only. A phrase without words stands nowhere."""
    found = _analysed(index, phrase, parts)
    rows = index.filter(F.col("part").isin([p for *_, p in found]) & F.col("token").isin([t for _, t, _ in found]))
    offsets: dict[str, list[int]] = {}
    for at, token, _ in found:
        offsets.setdefault(token, []).append(at)
    of = F.coalesce(*[F.when(F.col("token") == t, F.array(*map(F.lit, k))) for t, k in offsets.items()], F.array().cast("array<int>"))
    each = rows.select(id_column, F.explode(places(F.col("gaps"))).alias("pos"), of.alias("of"))
    starts = each.select(id_column, F.explode(F.transform("of", lambda k: F.col("pos") - k)).alias("place"))
    return starts.groupBy(id_column, "place").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(found)).drop("n")


def matching(index: DataFrame, id_column: str, phrases: list[str], parts: int = PARTS) -> DataFrame:
    """id, hits: documents that hold every phrase (a word is one too), and how many places of them."""
    hits = [phrase_places(index, id_column, p, parts).groupBy(id_column).agg(F.count(F.lit(1)).alias("hits")) for p in phrases]
    every = functools.reduce(DataFrame.unionAll, hits)
    return every.groupBy(id_column).agg(F.count(F.lit(1)).alias("n"), F.sum("hits").alias("hits")).filter(F.col("n") == len(phrases)).drop("n")


def prefixed(index: DataFrame, id_column: str, prefix: str) -> DataFrame:
    """id, hits: documents with a token that begins like the prefix; tokens are sorted in their files, so statistics skip the others."""
    found = [t for _, t, _ in _analysed(index, prefix, PARTS)]
    if len(found) != 1:
        raise ValueError("a prefix is one word")
    rows = index.filter(F.col("token").startswith(found[0]))
    return rows.groupBy(id_column).agg(F.sum(F.size("gaps").cast("bigint")).alias("hits"))
