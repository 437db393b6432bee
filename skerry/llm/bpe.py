"""BPE encoding and decoding by dynamic programming over prefixes.

For a word of atoms a1..an let e(i) be the last token of the encoding of a1..ai. That token is unique, and the
encoding of a prefix is the encoding of a shorter prefix plus one token: t is e(i) exactly if t is a suffix of
a1..ai, t is the encoding of its own string, and (e(i - |t|), t) is a compatible pair, i.e. a pair that merging
leaves as it is. So one pass over the word, which asks an automaton for the tokens that end at i (suffixes of the
prefix), fills e(1..n), and the ids follow from the back-pointers. The automaton is the Aho-Corasick one of the
vocabulary: its suffix links list the same matches as a suffix automaton walked along the word, in a few MB instead of
one node for each substring of the vocabulary. The tokenizer file gives vocabulary and merges; nothing is trained.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a task keeps until it ends: ids of words and of chunks between white space, two generations of so many (64 bytes long at most), and tested pairs.
KEPT, KEPT_PAIRS = 120_000, 150_000
#: Texts encoded at a time, so that a worker holds the ids of few.
ROWS = 256


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 as it is, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


def _ranges(found: list[int]) -> str:
    """Sorted code points as ranges for a pattern."""
    starts = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -2]) if c + 1 != after]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


@functools.cache
def classes() -> dict[str, str]:
    """The letters, numbers and white space of the tokenizers library as ranges for a pattern, asked of its own splitter.

    Its Unicode tables aren't Python's, so Python's categories would part words elsewhere. ``newer`` has the code points
    that Python doesn't know yet, and the marks that the library's normaliser orders otherwise: texts with them are
    normalised by the library too.
    """
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    whole = "".join(map(chr, points))
    out = {}
    for name, pattern in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s")):
        runs = Split(Regex(pattern + "+"), behavior="removed", invert=True).pre_tokenize_str(whole)
        out[name] = _ranges([points[k] for _, (a, b) in runs for k in range(a, b)])
    return out | {"newer": _ranges(sorted({c for c in points if unicodedata.category(chr(c)) == "Cn"} | set(_other_marks(points))))}


#: Old marks of classes 1, 202, 220, 230 and 240.
ANCHORS = "\u0334\u0327\u0323\u0301\u0345"


def _other_marks(points: list[int]) -> list[int]:
    """Marks that the library's normaliser, whose tables are older, orders otherwise among others than Python's: each is tried on both sides of a mark of every class."""
    from tokenizers.normalizers import NFC

    nfc = NFC()

    def agrees(m: str, others: str) -> bool:
        tried = " ".join(f"a{m}{x} a{x}{m} {m}{x} {x}{m}" for x in others)
        return nfc.normalize_str(tried) == unicodedata.normalize("NFC", tried)

    marks = [chr(c) for c in points if unicodedata.category(chr(c))[0] == "M"]
    of_class: dict[int, str] = {}
    for m in marks:
        if unicodedata.combining(m) not in of_class and agrees(m, ANCHORS):
            of_class[unicodedata.combining(m)] = m
    return [ord(m) for m in marks if not agrees(m, "".join(of_class.values()) + ANCHORS)]


class Kept:
    """A bounded memory: when the young entries are too many they become the old ones; what is used again stays."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def find(self, key: str):
        """What was put, from either generation."""
        known = self.young.get(key)
        if known is None and (known := self.old.get(key)) is not None:
            self.put(key, known)
        return known

    def clear(self) -> None:
        self.young.clear()
        self.old.clear()

    def put(self, key: str, value) -> None:
        if len(self.young) >= self.size:
            self.old = dict(self.young)
            self.young.clear()  # the same object, which callers may hold
        self.young[key] = value


class PrefixBpe:
    """Encoder and decoder for a vocabulary whose words end in a suffix mark.

    A word is a string of atoms: chr(b) for byte b, chr(256 + b) for byte b at the word's end.
    """

    def __init__(self, source: str | bytes, known: dict[str, str] | None = None):
        """known: the result of classes(), where it is at hand."""
        spec = json.loads(source)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        atom = {c: chr(b) for b, c in enumerate(alphabet)}
        vocab: dict[str, int] = model["vocab"]

        def spelled(piece: str) -> str:
            if piece.endswith(end):
                body = piece[: -len(end)]
                return "".join(atom[c] for c in body[:-1]) + chr(256 + ord(atom[body[-1]]))
            return "".join(atom[c] for c in piece)

        self.pieces: dict[int, str] = {i: p for p, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {spelled(p): i for p, i in vocab.items()}
        self.rank: dict[tuple[str, str], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank.setdefault((spelled(a), spelled(b)), r)
        self.longest = max(map(len, self.ids))
        self.split_at: dict[str, tuple[str, str] | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.wholes: dict[str, bool] = {}
        self.known = Kept(KEPT)
        self._automaton()
        letter, number, space, newer = ((known or classes())[k] for k in ("letter", "number", "space", "newer"))
        self._regex = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{space}{letter}{number}]+")
        self._space = re.compile(f"[{space}]+")
        self._newer = np.zeros(0x110000, dtype=bool)
        for first, last in re.findall(r"\\U(\w{8})-\\U(\w{8})", newer):
            self._newer[int(first, 16) : int(last, 16) + 1] = True
        self._source = source
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def _automaton(self) -> None:
        """Automaton of the vocabulary: after each atom it gives every token that is a suffix of what was read."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for s in self.ids:
            self.automaton.add_word(s, s)
        self.automaton.make_automaton()

    def last_merge(self, token: str) -> tuple[str, str] | None:
        """The two tokens whose merge ends the encoding of token's own string; None for atoms and for strings that merging leaves in several tokens."""
        if token not in self.split_at:
            parts = list(token)
            last = None
            while len(parts) > 1:
                r, i = min(((self.rank.get((parts[i], parts[i + 1]), 1 << 60)), i) for i in range(len(parts) - 1))
                if r == 1 << 60:
                    break
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.split_at[token] = last if len(parts) == 1 else None
        return self.split_at[token]

    def whole(self, token: str) -> bool:
        return len(token) == 1 or self.last_merge(token) is not None

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging leaves left and right side by side as they are.

        The border breaks if, at some moment, the piece at left's end and the piece at right's start form a pair
        that comes before the merges that made the two pieces part of something larger. Undo those merges from the
        latest to the first; between two undoings the pair at the border stays.
        """
        key = (left, right)
        known = self.pairs.get(key)
        if known is not None:
            return known
        a, b = left, right
        #: The merges that swallow a and b as they stand now; the first of them bounds how long this pair meets.
        a_until = b_until = 1 << 60
        good = True
        while True:
            r = self.rank.get((a, b))
            # at equal rank the left one of two overlapping merges goes first: b's own merge lies to the right
            if r is not None and r < a_until and r <= b_until:
                good = False
                break
            a_made = self.rank[self.last_merge(a)] if len(a) > 1 else -1
            b_made = self.rank[self.last_merge(b)] if len(b) > 1 else -1
            if a_made < 0 and b_made < 0:
                break
            if a_made > b_made or (a_made == b_made and a_made >= 0):
                a_until = a_made
                a = self.last_merge(a)[1]
            else:
                b_until = b_made
                b = self.last_merge(b)[0]
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        self.pairs[key] = good
        return good

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word of atoms."""
        n = len(word)
        last: list[str | None] = [None] * (n + 1)
        wholes, pairs = self.wholes, self.pairs
        for end, token in self.automaton.iter(word):  # by end, the longest token first
            if last[end + 1] is not None:
                continue
            whole = wholes.get(token)
            if whole is None:
                whole = wholes[token] = self.whole(token)
            if not whole:
                continue
            before = end + 1 - len(token)
            if before:
                left = last[before]
                if left is None:
                    continue
                good = pairs.get((left, token))
                if not (self.compatible(left, token) if good is None else good):
                    continue
            last[end + 1] = token
        out, i = [], n
        while i:
            out.append(self.ids[last[i]])
            i -= len(last[i])
        return out[::-1]

    def forget(self) -> None:
        """Frees what encoding has kept; the vocabulary stays."""
        self.known.clear()
        self.pairs.clear()

    def _word_ids(self, word: str) -> bytes:
        raw = word.encode("utf-8")
        return array("I", self.encode_word(raw[:-1].decode("latin-1") + chr(256 + raw[-1]))).tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a normalised text without white space; words never reach over white space, so chunks stand alone."""
        ids = self.known.find(chunk)
        if ids is not None:
            return ids
        parts = []
        for word in self._regex.findall(chunk):
            ids = self.known.find(word)
            if ids is None:
                ids = self._word_ids(word)
                if len(word) <= 64:
                    self.known.put(word, ids)
            parts.append(ids)
        if len(parts) == 1:
            return parts[0]
        ids = b"".join(parts)
        if len(chunk) <= 64:
            self.known.put(chunk, ids)
        return ids

    @functools.cached_property
    def _library(self):
        from tokenizers import Tokenizer

        source = self._source
        return Tokenizer.from_str(source if isinstance(source, str) else source.decode()).normalizer

    def normal(self, text: str) -> str:
        """NFC, white space runs to a space, lower case character by character."""
        if not text.isascii():
            if self._newer[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")].any():
                return self._library.normalize_str(text)
            text = unicodedata.normalize("NFC", text)
        return self._space.sub(" ", text).replace("Σ", "σ").lower()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers; strings of special tokens in it become their ids."""
        out: list[bytes] = []
        chunks, chunk_ids = self.known.young, self.chunk_ids
        for part in self._special.split(text) if self._special and "<|" in text else (text,):
            if part in self.special:
                out.append(np.asarray([self.special[part]], dtype="<u4").tobytes())
            elif part:
                for chunk in self.normal(part).split(" "):
                    known = chunks.get(chunk)
                    out.append(known if known is not None else chunk_ids(chunk))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The pieces of the ids, joined by a space (the file names no decoder); special tokens are kept."""
        return " ".join(map(self.pieces.__getitem__, ids.tolist()))


@functools.lru_cache(maxsize=2)
def _made(source: bytes, letter: str, number: str, space: str, newer: str) -> PrefixBpe:
    return PrefixBpe(source, {"letter": letter, "number": number, "space": space, "newer": newer})


@contextlib.contextmanager
def _loaded(sent) -> Iterator[PrefixBpe]:
    """The worker's encoder for a sent tokenizer; what a task made it keep goes with the task."""
    source, known = sent.value
    bpe = _made(source, *(known[k] for k in ("letter", "number", "space", "newer")))
    try:
        yield bpe
    finally:
        bpe.forget()


def _source(spark: SparkSession, path: str):
    """The tokenizer file (a few MB, of fixed size) and the character classes as a broadcast value; only the driver reads the path."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast((file.read(), classes()))


def encode(spark: SparkSession, text: Column, path: str) -> Column:
    """Token ids of a text column as array<int>; null and empty texts give an empty array."""
    source = _source(spark, path)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _loaded(source) as bpe:
            for texts in batches:
                yield pd.Series([bpe.encode(x or "").astype(np.int32) for x in texts])

    return ids(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """Text of an array<int> column of token ids, special tokens kept; null gives an empty text."""
    source = _source(spark, path)

    @F.pandas_udf(T.StringType())
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with _loaded(source) as bpe:
            for lists in batches:
                yield pd.Series([bpe.decode(np.asarray([] if x is None else x, dtype=np.int64)) for x in lists])

    return texts(ids)


def round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Encodes and decodes every whole text in one pass over the rows, without a shuffle.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, ids. Null and empty texts have no
    tokens and decode to the empty text; a null doc_id stays null; repeated rows give repeated results; other columns
    are ignored, whatever their names; an empty table gives no rows.
    """
    source = _source(docs.sparkSession, path)
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def digested(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _loaded(source) as bpe:
            for frame in frames:
                for at in range(0, frame.num_rows, ROWS):
                    part = frame.slice(at, ROWS)
                    found = [bpe.encode(x or "") for x in part.column(1).to_pylist()]
                    columns = {
                        "doc_id": part.column(0), "n_tokens": pa.array([len(x) for x in found], pa.int64()), "ids_sha256": pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in found]),
                        "decoded_sha256": pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in found]),
                    }
                    if keep_ids:
                        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int32)))
                    yield pa.record_batch(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(digested, f"doc_id {kind}, {fields}")
