"""Fill-in-middle transformation: a text is cut at two of its unit boundaries and its middle goes to the end.

The matcher streams over a text twice and keeps no unit: the first pass counts the units, the second advances a lazy
match iterator to the smaller rank and on to the larger one, and reads off the two offsets. Memory is that of the text.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Units, markers, the percentage of plain texts left as they are, and that of spm among the others.
UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUT_BELOW = 90
SPM_BELOW = 20
SEED = 1
#: Texts that are held as Python strings at a time.
ROWS = 64

FIELDS = "n long, form string, prefix_chars long, middle_chars long, output string"


def count_units(text: str) -> int:
    """Number of units; matches are made one at a time and let go."""
    last = deque(enumerate(UNIT.finditer(text), 1), maxlen=1)
    return last[0][0] if last else 0


def ends_of(text: str, first: int, second: int) -> tuple[int, int]:
    """Offsets behind the first and the second number of units, first <= second; 0 units end at 0."""
    units = UNIT.finditer(text)

    def behind(skip: int, start: int) -> int:
        return next(islice(units, skip - 1, None)).end() if skip else start

    a = behind(first, 0)
    return a, behind(second - first, a)


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """The first four 32-bit numbers of sha256("seed:doc_id"); a null id is empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def transformed(doc_id: object, text: str, seed: int = SEED) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    n = count_units(text)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= CUT_BELOW:
        return n, "plain", None, None, text
    a, b = ends_of(text, *sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def transform(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output for every row of docs(doc_id, text), in one pass without a shuffle.

    Null and empty texts are plain and give an empty output; texts that hold a marker are plain. A null doc_id counts as
    an empty one in the draw and stays null; repeated rows give repeated results; other columns are ignored, whatever
    their names; an empty table gives no rows.
    """

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [transformed(k, x or "", seed) for k, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                n, form, before, middle, output = map(list, zip(*rows))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
                yield pa.record_batch(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(formed, f"doc_id {kind}, {FIELDS}")


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form. Texts that were cut hold no marker, so each marker stands once."""

    def part(marker: str, until: str | None = None) -> Column:
        rest = F.split_part(output, F.lit(marker), F.lit(2))
        return F.split_part(rest, F.lit(until), F.lit(1)) if until else rest

    psm = F.concat(part(PREFIX, SUFFIX), part(MIDDLE), part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), part(MIDDLE), part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """transform's columns with the sha256 of output and of the restored text instead of output."""
    d = transform(docs, seed)
    hashed = [F.sha2(x.cast("binary"), 256).alias(f"{k}_sha256") for k, x in (("output", F.col("output")), ("restored", restored(F.col("output"), F.col("form"))))]
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashed)
