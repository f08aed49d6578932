"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Words are runs of letters and digits, or of other marks; a word also has a shape (its case, or that it repeats
the word before it), and n-grams of shapes count too. A document's features are hashed into a fixed number of places, counted, damped by a square
root and scaled to unit length; its score is the logistic of their sparse dot product with the weights.

A bounded sample of the labelled rows is dealt to a fixed number of learners by a hash of the id; each passes over its rows
and the learners' weights are averaged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import BROADCAST_ROWS, small_batches

#: Places for features, and the n-grams' length.
PLACES, NGRAM = 1 << 18, 2
#: Labelled rows that are learnt from at most, the learners that share them, and passes over them.
TRAIN_ROWS, LEARNERS, PASSES = 12_000, 4, 3
#: Of the updates: step, its offset, and the weights of the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.01, 0.01
#: Code points of text read at once, words remembered by a worker, and the longest of them.
BLOCK, REMEMBERED, LONGEST = 1 << 20, 50_000, 64

SPACE = re.compile(r"\s")
WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hash of each word: that of its lower-case form; in the low bits, its case, or that it is of marks."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        case = 3 if not word[:1].isalnum() else 2 if word.isupper() and len(word) > 1 else 1 if word[:1].isupper() else 0
        h = xxhash.xxh64_intdigest(word.lower(), seed=7) & ~3 | case
        if len(word) <= LONGEST:
            self[word] = h
        return h


@lru_cache(maxsize=1)
def words() -> Words:
    return Words()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the features of the whole text; a text without words has one: its start next to its end."""
    known, parts, at = words(), [np.array([4], np.uint64)], 0
    while at < len(text):
        # Blocks end at white space, so no word is cut, however long.
        space = SPACE.search(text, at + BLOCK)
        end = space.start() if space else len(text)
        found = WORD.findall(text, at, end)
        parts.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
        at = end
    h = np.concatenate((*parts, np.array([8], np.uint64)))
    case, h = h & np.uint64(3), h >> np.uint64(2)
    shape = np.where(h[1:] == h[:-1], np.uint64(5), case[1:])  # a word that repeats the one before it has a shape of its own
    grams = [h[1:-1], shape[:-1] * np.uint64(31) + shape[1:] + np.uint64(1000)]
    for n in range(2, NGRAM + 1):
        g = h[: len(h) - n + 1]
        for k in range(1, n):
            g = (g * _MIX) ^ h[k : len(h) - n + 1 + k]
        grams.append(g)
    all_grams = np.concatenate(grams) * _MIX
    places, counts = np.unique((all_grams >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int32), return_counts=True)
    values = np.sqrt(counts)
    return places, (values / np.linalg.norm(values)).astype(np.float32)


class Ftrl:
    """Follow-the-proximally-regularised-leader for one weight a place, and a bias at the end."""

    def __init__(self):
        self.z, self.n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, root = self.z[at], np.sqrt(self.n[at])
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + root) / ALPHA + L2))

    def learn(self, places: np.ndarray, values: np.ndarray, label: float) -> None:
        at, x = np.append(places, PLACES), np.append(values, 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """PLACES weights and a bias, learnt from the rows of docs that labels(id, label 0 or 1) has.

    At most train_rows labelled rows are used: those with the smallest hash of their id, so the sample does not depend on
    the tables' layout. Null labels, ids and texts teach nothing, nor do ids with both labels; of an id with several texts the
    first in order teaches, once. Texts are read whole. Without rows of both classes the weights are zero.
    """
    label = F.col(label_col).cast("double")
    usable = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(F.min(label).alias("label"), F.max(label).alias("other")).where("label = other").drop("other")
    chosen = usable.orderBy(F.xxhash64(id_col), id_col).limit(train_rows)
    chosen = F.broadcast(chosen) if train_rows <= BROADCAST_ROWS else chosen
    rows = docs.select(id_col, text_col).where(F.col(text_col).isNotNull()).join(chosen, id_col)
    rows = rows.groupBy(id_col, "label").agg(F.min(text_col).alias("text")).select(F.xxhash64(id_col).alias("h"), "label", "text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["h", "label", "places", "vals"])

    def learn(rows: pa.Table) -> pa.Table:
        model = Ftrl()
        rows = rows.combine_chunks().sort_by([("h", "ascending"), ("label", "ascending")])
        places, values, labels = rows.column("places"), rows.column("vals"), rows.column("label").to_numpy()
        for _ in range(PASSES):
            for p, v, label in zip(places, values, labels):
                model.learn(p.values.to_numpy(), v.values.to_numpy(), label)
        used = np.flatnonzero(model.n)
        w = model.weights(used)
        return pa.table({"place": used[w != 0].astype(np.int32), "w": w[w != 0]})

    found = small_batches(rows).mapInArrow(featured, "h bigint, label double, places array<int>, vals array<float>")
    learnt = found.groupBy(F.pmod("h", F.lit(LEARNERS)).alias("learner")).applyInArrow(learn, "place int, w double")
    # PLACES + 1 rows at most, whatever the input.
    out = np.zeros(PLACES + 1)
    mean = learnt.groupBy("place").agg((F.sum(F.col("w").cast("decimal(30,12)")) / LEARNERS).cast("double").alias("w")).toArrow()
    out[mean.column("place").to_numpy()] = mean.column("w").to_numpy()
    return out


def scores_of(texts: Iterator[str], w: np.ndarray) -> np.ndarray:
    """The logistic of each text's sparse dot product with the weights."""
    sums = np.array([w[places] @ values + w[PLACES] for places, values in map(features, texts)], np.float64)
    return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row, from 0 to 1; a null text scores as an empty one, texts are read whole, and repeated rows score
    alike. Other columns are not read."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores_of((t.as_py() or "" for t in b.column(1)), sent.value))], names=[id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return small_batches(docs.select(id_col, text_col)).mapInArrow(run, f"`{id_col}` {kind}, score double")


def keep_good(docs: DataFrame, weights: np.ndarray, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that score min_score or more, with all their columns, whatever their ids; rows stay in their task."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores_of((t.as_py() or "" for t in b.column(at)), sent.value) >= min_score))

    return small_batches(docs).mapInArrow(run, docs.schema)
