"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes log-count ratios.

Counts of every n-gram bucket in both classes come from all labelled rows, summed in each task before the shuffle; their
log ratios scale the indicators. On a bounded sample of labelled rows a linear hinge-loss model is fitted by dual
coordinate descent, in one task, and its margins are turned into shares by a logistic curve over folds that the model did
not see. Every whole text is then scored in one pass, the weights (2 MB, whatever the input) sent as a broadcast value.
"""

from __future__ import annotations

import dataclasses
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.llm.common import Scratch, checked_broadcast

#: Buckets of n-grams; a power of two.
BUCKETS = 1 << 18
#: Labelled rows of each class that the model is fitted on at most, and n-grams in them at most.
FIT_ROWS = 3_000
FIT_FEATURES = 20_000_000
#: Added to each bucket's count in a class.
PRIOR = 1.0
#: Price of a margin that is missed, shared out so that both classes cost the same.
COST = 1.0
EPOCHS = 20
FOLDS = 3
#: Rows whose crc32 leaves this remainder are never learned from.
HELD_OUT, PARTS = 1, 3
#: Tokens that a worker remembers at most before it starts anew, and texts held as Python strings at a time.
REMEMBERED = 200_000
ROWS = 256

_TOKEN = re.compile(r"[A-Za-z\x80-\U0010FFFF]+|[0-9]+|[^A-Za-z0-9\x80-\U0010FFFF\s]+")
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _number(kind: str, token: str) -> int:
    return zlib.crc32(f"{kind}{token}".encode("utf-8", "surrogatepass")) * 0x9E3779B1 + 1


def shape_of(token: str) -> str:
    """Letters by their case, digits as one, marks as they are."""
    if token[0].isdigit():
        return "0"
    if not (token[0].isalpha() or ord(token[0]) >= 128):
        return token
    return "x" if token.islower() else "X" if token.isupper() and len(token) > 1 else "Xx" if token[:1].isupper() else "o"


class Tokens(dict):
    """Two numbers for a token: of its lower-cased word and of its shape. Bounded: it is emptied when full."""

    def __missing__(self, token: str) -> tuple[int, int]:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = found = (_number("w", token.lower()), _number("s", shape_of(token)))
        return found


_AGAIN = np.uint64(_number("s", "=again"))


def _grams(stream: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of all runs of 1 to most numbers."""
    out, rolled = [], np.zeros(len(stream), dtype=np.uint64)
    for n in range(min(most, len(stream))):
        rolled = rolled[: len(stream) - n] * _MIX[0] + stream[n:] * _MIX[1]
        mixed = (rolled ^ (rolled >> np.uint64(29))) * _MIX[2] + np.uint64(n)
        out.append(mixed >> np.uint64(40))
    return out


def features(text: str, tokens: Tokens) -> np.ndarray:
    """Sorted distinct buckets of a text: words and pairs of words; shapes and runs of up to three shapes.

    A token that repeats the one before it has a shape of its own.
    """
    found = _TOKEN.findall(text)
    if not found:
        return np.zeros(0, dtype=np.int32)
    numbers = np.array([tokens[t] for t in found], dtype=np.uint64)
    words, shapes = numbers[:, 0], numbers[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] = _AGAIN
    return np.unique(np.concatenate(_grams(words, 2) + _grams(shapes, 3)) & np.uint64(BUCKETS - 1)).astype(np.int32)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Parts of the batches with the features of their last column, few texts at a time."""
    tokens = Tokens()
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, [features(x or "", tokens) for x in part.column(part.num_columns - 1).to_pylist()]


@dataclasses.dataclass(frozen=True)
class Model:
    """weights per bucket (ratios included), bias, and the logistic curve from margin to share."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """Share of label 1; a text without n-grams has the bias as its margin."""
        margins = np.array([self.weights[x].sum() / np.sqrt(max(1, len(x))) for x in found]) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """counts[2, BUCKETS] of label 0 and label 1 -> log of each bucket's share in label 1 over that in label 0."""
    shares = np.log((counts + PRIOR) / (counts + PRIOR).sum(axis=1, keepdims=True))
    return shares[1] - shares[0]


def dual_descent(rows: list[np.ndarray], ratios: np.ndarray, signs: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hinge-loss weights over the scaled indicators, the bias last; one dual variable is solved at a time, in random order.

    A row's indicators are divided by the root of their number, so long texts don't outweigh short ones.
    """
    w = np.zeros(len(ratios) + 1)
    values = [ratios[x] / np.sqrt(max(1, len(x))) for x in rows]
    squares = np.array([v @ v + 1 for v in values])
    share = {s: max(1, int((signs == s).sum())) for s in (-1, 1)}
    most = np.array([COST * len(signs) / (2 * share[int(s)]) for s in signs])
    dual, rng = np.zeros(len(rows)), np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            x, v, y = rows[i], values[i], signs[i]
            gradient = y * (w[x] @ v + w[-1]) - 1
            new = min(max(dual[i] - gradient / squares[i], 0.0), most[i])
            step = new - dual[i]
            if step:
                dual[i] = new
                w[x] += step * y * v
                w[-1] += step * y
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def logistic(margins: np.ndarray, signs: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and shift of the logistic curve through the margins, by Newton's steps on softened labels."""
    up, down = int((signs > 0).sum()), int((signs < 0).sum())
    goal = np.where(signs > 0, (up + 1) / (up + 2), 1 / (down + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones_like(margins)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -500, 500)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2), x @ (p - goal))
        at = at - step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(at[0])), float(at[1])


def fitted(rows: list[np.ndarray], labels: np.ndarray, counts: np.ndarray) -> Model:
    """The model of labelled rows. With one class only, or none, every text gets the share of label 1 among them."""
    signs = np.where(labels == 1, 1, -1)
    up, down = int((signs > 0).sum()), int((signs < 0).sum())
    if min(up, down) < FOLDS:
        return Model(np.zeros(BUCKETS), 0.0, 0.0, float(np.log((up + 1) / (down + 1))))
    ratios = log_ratios(counts)
    fold = np.zeros(len(rows), dtype=int)
    for s in (-1, 1):
        fold[signs == s] = np.arange((signs == s).sum()) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        # the rows of the fold are taken out of the counts too
        own = np.stack([np.bincount(np.concatenate([rows[i] for i in np.flatnonzero((fold == k) & (signs == s))]), minlength=BUCKETS) for s in (-1, 1)])
        r = log_ratios(np.maximum(counts - own, 0))
        rest = np.flatnonzero(fold != k)
        w = dual_descent([rows[i] for i in rest], r, signs[rest], k)
        w_r = w[:-1] * r
        for i in np.flatnonzero(fold == k):
            margins[i] = w_r[rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) + w[-1]
    w = dual_descent(rows, ratios, signs)
    return Model(w[:-1] * ratios, float(w[-1]), *logistic(margins, signs))


def class_counts(labelled: DataFrame) -> np.ndarray:
    """labelled(label, text) -> counts[2, BUCKETS] of rows that hold each bucket, over all rows; a table of fixed size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((2, BUCKETS), dtype=np.int64)
        for part, found in _featured(batches):
            for label, x in zip(part.column(0).to_pylist(), found):
                own[label][x] += 1
        for label in (0, 1):
            some = np.flatnonzero(own[label])
            yield pa.record_batch([pa.array(np.full(len(some), label, dtype=np.int32)), pa.array(some), pa.array(own[label][some])], ["label", "bucket", "n"])

    summed = labelled.select("label", "text").mapInArrow(counted, "label int, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()  # two rows a bucket at most
    counts = np.zeros((2, BUCKETS))
    counts[rows["label"].to_numpy(dtype=int), rows["bucket"].to_numpy(dtype=int)] = rows["n"].to_numpy(dtype=float)
    return counts


def _sample(labelled: DataFrame, scratch: Scratch) -> DataFrame:
    """label, place, features of at most FIT_ROWS rows of each class, the smallest by hash."""
    place = F.xxhash64("key", "text_hash", F.lit(17))
    rows = labelled.select("label", place.alias("place"))
    ids = [rows.filter(F.col("label") == k).orderBy("place").limit(FIT_ROWS) for k in (0, 1)]
    ids = F.broadcast(scratch.put(ids[0].unionAll(ids[1]).distinct()))
    texts = labelled.withColumn("place", place).join(ids, ["label", "place"], "left_semi").select("label", "place", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _featured(batches):
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.record_batch([part.column(0), part.column(1), lists], ["label", "place", "features"])

    return scratch.put(texts.mapInArrow(featured, "label int, place long, features array<int>").dropDuplicates(["label", "place"]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model of the rows of docs(doc_id, text) that labels(doc_id, label) marks 0 or 1 and that are not held out.

    Rows without a doc_id or label are not learned from; of several labels of an id the smallest counts.
    """
    scratch = Scratch(docs.sparkSession, "classifier")
    marked = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("key")).agg(F.min(label).cast("int").alias("label"))
    marked = checked_broadcast(marked)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    labelled = docs.filter(~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("key"), text.alias("text"), F.xxhash64(text).alias("text_hash")).join(marked, "key")
    counts = docs.sparkSession.sparkContext.broadcast(class_counts(labelled))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame({"label": [], "place": [], "features": []})]).sort_values(["place", "label"])
        within = np.cumsum([len(x) for x in rows["features"]]) <= FIT_FEATURES if len(rows) else np.zeros(0, dtype=bool)
        rows = rows[within]
        m = fitted([np.asarray(x, dtype=np.int32) for x in rows["features"]], rows["label"].to_numpy(dtype=int), counts.value)
        yield pd.DataFrame({"weights": [m.weights.tobytes()], "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    sample = _sample(labelled, scratch)
    m = sample.repartition(1).mapInPandas(fit, "weights binary, bias double, slope double, shift double").first()
    if m is None:
        return fitted([], np.zeros(0), np.zeros((2, BUCKETS)))
    return Model(np.frombuffer(m.weights), m.bias, m.slope, m.shift)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning, by the crc32 of its id as text; a null id counts as an empty one."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % PARTS == HELD_OUT


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 from 0.5 on) for every row of docs(doc_id, text).

    Only the text is an input of the score. Null and empty texts have no n-grams and the score of the bias; repeated rows
    give repeated results; a null doc_id stays null; other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _featured(batches):
            yield pa.record_batch([part.column(0), pa.array(sent.value.scores(found))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    d = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(scored, f"doc_id {kind}, score double")
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """score's rows, by a model trained on docs and labels."""
    return score(docs, train(docs, labels, label))
