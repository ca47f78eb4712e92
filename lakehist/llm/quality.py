"""Quality of documents: a Bradley-Terry ranking learnt from preference pairs, cut at a quantile of the scores.

Document ``i`` is preferred to ``j`` with probability ``sigmoid(w . f(i) - w . f(j))``; a pair is a document labelled 1
and one labelled 0. ``w`` minimises the logistic loss of feature differences over drawn pairs (Adam, in numpy).
The margin ``w . f`` ranks all documents; a monotone logistic curve, fitted to the labelled margins and to the share of each
label among *all* labels, turns it into a score between 0 and 1.

Features are of the whole text: some shares (of capitals, digits, symbols, line ends, repeated words, distinct words, ...),
the frequencies of byte pairs and of words, each in :data:`BUCKETS` buckets. As frequencies are sums over positions,
a margin is a sum of table look-ups, computed in one pass over the text without a shuffle.

* The training sample is bounded: for each label ``CELLS`` rows at most, those with the smallest hash in each of so many hash
  cells (32 MB of features with both labels, held by the driver). Everything else covers all rows and whole texts.
* A document with several labels has 1 if their mean is 0.5 or more; null labels and labels of unknown documents teach nothing.
  Of several rows with one identifier one is learnt from.
* Null text counts as empty. Empty texts have features (zeros) and a score like any other.
* Without labels of both kinds all margins are 0 and every score is the share of label 1 (0.5 without any label).
* :func:`cut_at` is a quantile of the scores of all documents (Spark's bounded sketch); equal scores stay or go together. Of an empty
  table it is null, and nothing is kept or dropped.
* Repeated rows get equal scores; columns of the documents stay, the result comes in one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from lakehist.llm.common import fresh, place_of, quoted, slices, stored
from lakehist.llm.words import SPACED, mixed, words

#: The training sample: rows of each label.
CELLS = 1024
#: Buckets of byte pairs, and of words.
BUCKETS = 2048
STEPS, PAIRS, RATE, DECAY = 400, 256, 0.02, 1e-2
#: Buckets are scaled by their spread in the sample, but not by less than this frequency.
LEAST_SPREAD = 0.03

_RESULT = StructType().add("margin", DoubleType()).add("score", DoubleType())

_BYTES = np.arange(256)
#: Shares of bytes: capitals, digits, sentence marks, other ASCII signs, line ends, beyond ASCII.
_CLASSES = np.array([
    (_BYTES >= 65) & (_BYTES <= 90),
    (_BYTES >= 48) & (_BYTES <= 57),
    np.isin(_BYTES, [ord(c) for c in ".,;:!?'\"()-"]),
    np.isin(_BYTES, [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]),
    np.isin(_BYTES, [10, 13]),
    _BYTES >= 128,
])
#: Besides: number and length of words, words like the one before, distinct words, short words.
DENSE = len(_CLASSES) + 5
_PAIR_BUCKET = (mixed(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


class Texts:
    """A column of texts as bytes and hashed words, with sums over each text."""

    def __init__(self, texts: pa.Array) -> None:
        column = texts.cast(pa.large_string()).fill_null("")
        self.n = len(column)
        self.split = words(column, SPACED)
        whole = pa.concat_arrays([column, pa.array([""], pa.large_string())])
        offsets = np.frombuffer(whole.buffers()[1], np.int64, self.n + 1, whole.offset * 8)
        size = int(offsets[-1] - offsets[0])
        self.raw = np.frombuffer(whole.buffers()[2], np.uint8, size, int(offsets[0])) if size else np.zeros(0, np.uint8)
        self.at = offsets - offsets[0]
        self.bytes = np.diff(self.at)

    def _sums(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        filled = np.flatnonzero(np.diff(bounds))
        if len(filled):
            out[filled] = np.add.reduceat(values, bounds[filled], dtype=np.float64)
        return out

    def per_byte(self, values: np.ndarray) -> np.ndarray:
        return self._sums(values, self.at)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        return self._sums(values, self.split.bounds)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The byte pair that begins at every byte, and whether it lies within its text."""
        pair = self.raw.astype(np.uint16) << 8
        pair[:-1] |= self.raw[1:]
        inside = np.ones(len(pair), bool)
        inside[self.at[1:][self.bytes > 0] - 1] = False
        return pair, inside

    def dense(self) -> np.ndarray:
        n, size = self.split.counts, np.maximum(self.bytes, 1)
        hashes, many = self.split.hashes, np.maximum(n, 1)
        owner = self.split.text_of_word()
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((hashes, owner))  # within each text equal words stand side by side
        first = np.ones(len(order), bool)
        first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[1:] != owner[:-1])
        distinct = self.per_word(first)
        length = self.split.ends - self.split.starts
        return np.stack([
            *(self.per_byte(c[self.raw]) / size for c in _CLASSES),
            np.log1p(n), self.per_word(length) / many / 10, self.per_word(again) / many,
            np.log1p(distinct) / np.maximum(np.log1p(n), 1), self.per_word(length <= 2) / many,
        ], axis=1)

    def features(self) -> np.ndarray:
        """All features, a row for each text."""
        out = np.zeros((self.n, DENSE + 2 * BUCKETS), np.float32)
        out[:, :DENSE] = self.dense()
        pair, inside = self.pairs()
        for i in range(self.n):
            a, b = self.at[i], self.at[i + 1]
            kinds = np.bincount(pair[a:b][inside[a:b]], minlength=1 << 16)
            out[i, DENSE:DENSE + BUCKETS] = np.bincount(_PAIR_BUCKET, kinds, BUCKETS) / max(b - a, 1)
            own = self.split.hashes[self.split.bounds[i]:self.split.bounds[i + 1]]
            out[i, DENSE + BUCKETS:] = np.bincount((own % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS) / max(len(own), 1)
        return out

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """``features() @ weights``, without the features."""
        pair, inside = self.pairs()
        of_pair = np.where(inside, weights[DENSE:DENSE + BUCKETS][_PAIR_BUCKET][pair], 0)
        of_word = weights[DENSE + BUCKETS:][(self.split.hashes % np.uint64(BUCKETS)).astype(np.int64)]
        return (
            self.dense() @ weights[:DENSE]
            + self.per_byte(of_pair) / np.maximum(self.bytes, 1)
            + self.per_word(of_word) / np.maximum(self.split.counts, 1)
        )


@dataclass
class Model:
    """Weights of the features, and the curve from margins to scores."""

    weights: np.ndarray
    slope: float
    offset: float
    preferred: float  # the share of label 1 among all labels

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -500, 500)))


def bradley_terry(better: np.ndarray, worse: np.ndarray, seed: int = 13) -> np.ndarray:
    """Weights that rank the rows of ``better`` above those of ``worse``."""
    rows = np.concatenate([better, worse])
    spread = rows.std(axis=0)
    spread[:DENSE] = np.maximum(spread[:DENSE], 1e-6)
    spread[DENSE:] = np.maximum(spread[DENSE:], LEAST_SPREAD)
    rng = np.random.default_rng(seed)
    w, mean, square = (np.zeros(rows.shape[1]) for _ in range(3))
    for step in range(1, STEPS + 1):
        i, j = rng.integers(len(better), size=PAIRS), rng.integers(len(worse), size=PAIRS)
        difference = (better[i] - worse[j]) / spread
        wrong = 1 / (1 + np.exp(np.clip(difference @ w, -500, 500)))
        gradient = -(wrong @ difference) / PAIRS + DECAY * w
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient**2 - square)
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w / spread


def _curve(margins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """The logistic curve of the label over the margin, with smoothed targets, by Newton's method."""
    ones, zeros = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    centre, scale = margins.mean(), margins.std() + 1e-12
    x = np.stack([(margins - centre) / scale, np.ones(len(margins))], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -500, 500)))
        gradient = x.T @ (weight * (p - target)) + 1e-6 * b
        curvature = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        b -= step * min(1, 2 / (np.abs(step).max() + 1e-12))
    return float(b[0] / scale), float(b[1] - b[0] * centre / scale)


def train(features: np.ndarray, label: np.ndarray, preferred: float) -> Model:
    better, worse = features[label == 1], features[label == 0]
    share = min(max(preferred, 1e-6), 1 - 1e-6)
    if not len(better) or not len(worse):
        return Model(np.zeros(DENSE + 2 * BUCKETS), 0.0, float(np.log(share / (1 - share))), preferred)
    weights = bradley_terry(better, worse)
    weight = np.where(label == 1, share / len(better), (1 - share) / len(worse)) * len(label)
    slope, offset = _curve(features @ weights, label, weight)
    return Model(weights, max(slope, 0.0), offset, preferred)


def fit(
    docs: DataFrame, labels: DataFrame, label_column: str = "quality", text_column: str = "text", id_column: str = "doc_id", cells: int = CELLS
) -> Model:
    """Learn from ``docs`` and the labels (0 or 1) that ``labels`` has for their identifiers."""
    known = (
        labels.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(label_column)).cast("double").alias("label"))
        .where("id IS NOT NULL AND label IS NOT NULL")
        .groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .join(docs.select(F.col(quoted(id_column)).alias("id")).distinct(), "id", "left_semi")
    )
    chosen = (
        known.withColumn("h", F.xxhash64("id")).groupBy("label", F.pmod("h", F.lit(cells)).alias("cell"))
        .agg(F.min_by("id", F.struct("h", "id")).alias("id"), F.count("*").alias("n"))
    )
    chosen = stored(chosen, "quality-sample")
    # Two labels times the cells: the sample is what may be broadcast and collected.
    texts = docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(text_column)).cast("string").alias("text"))
    picked = texts.join(F.broadcast(chosen.select("id", "label")), "id").select("id", "label", "text")
    kind = dict(picked.dtypes)["id"]

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 8 << 20):
                for few in range(0, part.num_rows, 256):
                    own = part.slice(few, 256)
                    rows = [r.tobytes() for r in Texts(own.column(2)).features()]
                    yield pa.record_batch([own.column(0), own.column(1), pa.array(rows, pa.binary())], names=["id", "label", "features"])

    rows = picked.mapInArrow(featured, f"id {kind}, label int, features binary").groupBy("id", "label").agg(F.min("features").alias("features"))
    rows = sorted(((r["label"], bytes(r["features"])) for r in rows.collect()))
    totals = {r["label"]: r["n"] for r in chosen.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    features = np.stack([np.frombuffer(f, np.float32) for _, f in rows]) if rows else np.zeros((0, DENSE + 2 * BUCKETS), np.float32)
    everyone = sum(totals.values())
    return train(features.astype(np.float64), np.array([l for l, _ in rows], int), totals.get(1, 0) / everyone if everyone else 0.5)


def ranked(docs: DataFrame, model: Model, text_column: str = "text", name: str = "quality", slice_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with one more column ``name`` (underscores in front if taken): a struct of ``margin`` and ``score``."""
    column = fresh(docs, name)
    at = place_of(docs, text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields]).add(column, _RESULT)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at, slice_bytes):
                margins = Texts(part.column(at).cast(pa.string())).margins(held.value.weights)
                found = pa.StructArray.from_arrays([pa.array(margins), pa.array(held.value.scores(margins))], names=["margin", "score"])
                yield pa.record_batch([*part.columns, found], names=[*part.schema.names, column])

    return docs.mapInArrow(score, schema)


def cut_at(scores: DataFrame, quantile: float, score_column: str = "score") -> float | None:
    """The score below which about ``quantile`` of the rows lie."""
    return scores.agg(F.percentile_approx(F.col(score_column), F.lit(float(quantile)), F.lit(10_000))).first()[0]


def thresholded(scores: DataFrame, quantile: float, name: str = "kept") -> DataFrame:
    """``scores`` with whether each ``score`` reaches the quantile; they are written once and read twice."""
    scores = stored(scores, "quality-scores")
    cut = cut_at(scores, quantile)
    return scores.withColumn(name, (F.col("score") >= F.lit(cut).cast(DoubleType())).cast(BooleanType()))


def in_training(id_column: str = "doc_id") -> Column:
    """Rows whose labels are learnt: ``crc32`` of the identifier as text (null: empty), modulo 5, is not 0."""
    return ~held_out(id_column)


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit(""))) % 5 == 0
