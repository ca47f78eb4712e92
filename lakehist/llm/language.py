"""Language identification: a bidirectional gated recurrent network over bytes, written and trained in numpy.

The network reads windows of a lower-cased text forwards and backwards, across white space, and gives every byte a probability
for each language. Windows overlap: each labels ``STRIDE`` bytes of its own and reads ``CONTEXT`` more on either side, so that a
label knows the words around it. All cuts lie between characters, and every byte of a text is labelled once, however long the
text is. A document's probability for a language is the mean over all its letter bytes; the highest one is the prediction.

Training is backpropagation through time with Adam on a bounded sample: for each language ``CELLS`` rows at most, the
ones with the smallest hash in each of so many hash cells, and ``SAMPLE_BYTES`` of each. Every label is learned, however
rare. The sample grows with the languages (384 kB each, held by the driver) but not with the corpus; prediction
covers all of it, in one pass without a shuffle.

* ``und`` with score 0 where the text is null or has no letter.
* Without labelled rows nothing is learned and all are ``und``. With one language every text with a letter has it.
* Ties between languages go to the first in code point order. Repeated rows get equal predictions.
* Only the text is an input of a prediction; columns of the documents are kept, results come in one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from lakehist.llm.common import fresh, place_of, quoted, slices
from lakehist.llm.words import LOWER

#: The training sample: rows of each language, bytes of each row.
CELLS, SAMPLE_BYTES = 256, 1500
#: How far above chance, of what there is above it, the score of an accepted document lies: 0.3 among four languages.
ABOVE_CHANCE = 1 / 15
#: Bytes that a window labels, and that it reads besides on either side.
STRIDE, CONTEXT = 224, 24
#: Units in each direction, at least; windows in training: their number, the bytes that they label and read besides.
UNITS = 8
STEPS, BATCH, RATE, TRAINED = 600, 96, 0.02, (64, 16)
#: Windows that are computed at a time; fewer of them with more languages than ``MANY``, so that memory stays the same.
AT_ONCE, MANY = 1024, 16
UNKNOWN = "und"

_RESULT = StructType().add("lang_pred", StringType()).add("score", DoubleType())
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])


def _fewer(n: int, languages: int) -> int:
    return max(1, n * MANY // max(MANY, languages))


def _units(languages: int) -> int:
    """Four for each doubling of the languages."""
    return max(UNITS, 4 * max(languages - 1, 0).bit_length())


class Direction:
    """One gated recurrent layer; ``z`` says how much of the state stays, ``r`` how much of it the candidate sees.

    Gates are linear between 0 and 1. Rows are windows, the longest first, so those that are as long as any position are the first ones.
    """

    def __init__(self, rng: np.random.Generator | None, units: int) -> None:
        if rng is not None:
            self.bytes = rng.normal(0, 0.3, (256, 3 * units)).astype(np.float32)
            self.state = rng.normal(0, 1 / np.sqrt(units), (units, 3 * units)).astype(np.float32)
            self.bias = np.zeros(3 * units, np.float32)
        self.units = units

    def run(self, x: np.ndarray, live: np.ndarray, steps: range, states: np.ndarray, keep: bool = False) -> list:
        """Fills ``states`` (position, window, unit) in the order of ``steps``; ``live`` is the number of windows at each."""
        u, kind = self.units, states.dtype
        given = (self.bytes + self.bias).astype(kind)
        gate_of, candidate_of = given[:, : 2 * u] / 4 + kind.type(0.5), np.ascontiguousarray(given[:, 2 * u :])
        of_gates, of_candidate = (self.state[:, : 2 * u] / 4).astype(kind), np.ascontiguousarray(self.state[:, 2 * u :].astype(kind))
        most, tape = x.shape[1], []
        state, seen, wide = (np.zeros((most, u), kind), np.empty((most, u), kind), np.empty((most, 2 * u), kind))
        all_gates, all_candidates = np.empty((most, 2 * u), kind), np.empty((most, u), kind)
        for t in steps:
            n = live[t]
            at, h, gates, candidate = x[t, :n], state[:n], all_gates[:n], all_candidates[:n]
            np.take(gate_of, at, axis=0, out=gates, mode="clip")
            gates += np.matmul(h, of_gates, out=wide[:n])
            if keep:
                tape.append([h.copy(), (gates > 0) & (gates < 1)])
            np.maximum(gates, 0, out=gates)
            np.minimum(gates, 1, out=gates)
            np.take(candidate_of, at, axis=0, out=candidate, mode="clip")
            np.multiply(gates[:, u:], h, out=seen[:n])
            candidate += seen[:n] @ of_candidate
            np.tanh(candidate, out=candidate)
            if keep:
                tape[-1] += [gates.copy(), candidate.copy()]
            h -= candidate
            h *= gates[:, :u]
            h += candidate
            states[t, :n] = h
        return tape

    def back(self, x: np.ndarray, live: np.ndarray, steps: range, tape: list, upstream: np.ndarray) -> list[np.ndarray]:
        """Gradients of ``bytes``, ``state`` and ``bias``, given those of the states."""
        u = self.units
        d_bytes, d_state, d_bias = np.zeros_like(self.bytes), np.zeros_like(self.state), np.zeros_like(self.bias)
        d_h = np.zeros((x.shape[1], u), upstream.dtype)
        for t, (h, linear, gates, candidate) in zip(reversed(steps), reversed(tape)):
            n = live[t]
            z, r = gates[:, :u], gates[:, u:]
            d_after = d_h[:n] + upstream[t, :n]
            d_candidate = d_after * (1 - z) * (1 - candidate**2)
            d_seen = d_candidate @ self.state[:, 2 * u :].T
            d_gates = np.concatenate([d_after * (h - candidate), d_seen * h], axis=1) * linear / 4
            d_all = np.concatenate([d_gates, d_candidate], axis=1)
            d_state[:, : 2 * u] += h.T @ d_gates
            d_state[:, 2 * u :] += (r * h).T @ d_candidate
            d_bias += d_all.sum(0)
            np.add.at(d_bytes, x[t, :n], d_all)
            d_h[:n] = d_after * z + d_seen * r + d_gates @ self.state[:, : 2 * u].T
        return [d_bytes, d_state, d_bias]


@dataclass
class Model:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [p for d in (self.forward, self.backward) for p in (d.bytes, d.state, d.bias)] + [self.out, self.bias]

    def label(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of each language at each byte of each window; what lies behind a window is not meant."""
        order = np.argsort(-lengths, kind="stable")
        p = np.empty((*x.shape, len(self.languages)), np.result_type(self.out, np.float32))
        p[order] = self._forward(x[order], lengths[order])[0].transpose(2, 1, 0)
        return p

    def _forward(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False) -> tuple:
        """Of windows from long to short: probabilities by language, position and window."""
        u, longest = self.forward.units, x.shape[1]
        turned = np.ascontiguousarray(x.T).astype(np.intp)
        live = np.searchsorted(-lengths, -np.arange(longest), side="left")  # windows longer than each position
        states = np.zeros((2, longest, len(x), u), np.result_type(self.out, np.float32))
        steps = range(longest), range(longest - 1, -1, -1)
        tapes = [d.run(turned, live, s, states[k], keep) for k, (d, s) in enumerate(zip((self.forward, self.backward), steps))]
        p = sum(o.T @ h.reshape(-1, u).T for o, h in zip((self.out[:u], self.out[u:]), states))
        p += self.bias[:, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p.reshape(-1, longest, len(x)), states, turned, live, steps, tapes

    def gradients(self, x: np.ndarray, lengths: np.ndarray, language: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy per byte."""
        order = np.argsort(-lengths, kind="stable")
        x, lengths, language = x[order], lengths[order], language[order]
        d, states, turned, live, steps, tapes = self._forward(x, lengths, True)
        d = np.ascontiguousarray(d.transpose(1, 2, 0))
        d[:, np.arange(len(x)), language] -= 1
        d *= (np.arange(x.shape[1])[:, None] < lengths)[:, :, None] / d.dtype.type(lengths.sum())
        u = self.forward.units
        d_states = d @ self.out.T
        flat = d.reshape(-1, d.shape[2])
        return [
            *self.forward.back(turned, live, steps[0], tapes[0], d_states[:, :, :u]),
            *self.backward.back(turned, live, steps[1], tapes[1], d_states[:, :, u:]),
            np.concatenate([h.reshape(-1, u).T @ flat for h in states]),
            flat.sum(0),
        ]


class Bytes:
    """A column of texts as lower-cased bytes, cut into windows."""

    def __init__(self, texts: pa.Array) -> None:
        column = pa.concat_arrays([texts.cast(pa.large_string()).fill_null(""), pa.array([""], pa.large_string())])
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column), column.offset * 8)
        self.raw = np.zeros(int(offsets[-1] - offsets[0]) + 1, np.uint8)
        if len(self.raw) > 1:
            np.take(LOWER, np.frombuffer(column.buffers()[2], np.uint8, len(self.raw) - 1, int(offsets[0])), out=self.raw[:-1])
        self.bounds = offsets - offsets[0]

    def _between(self, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The next place between two characters, from ``at`` to ``last``."""
        for _ in range(3):
            at = np.where((at < last) & (self.raw[np.minimum(at, len(self.raw) - 1)] & 0xC0 == 0x80), at + 1, at)
        return np.minimum(at, last)

    def windows(self, stride: int = STRIDE, context: int = CONTEXT) -> tuple[np.ndarray, ...]:
        """Of each window its text, where it begins and ends, and where what it labels begins and ends."""
        begin, size = self.bounds[:-1], np.diff(self.bounds)
        n = -(-size // stride)
        text = np.repeat(np.arange(len(size)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        first, last = begin[text], self.bounds[1:][text]
        own = self._between(first + nth * stride, last)
        stop = self._between(np.minimum(first + (nth + 1) * stride, last), last)
        return text, self._between(np.maximum(own - context, first), own), self._between(np.minimum(stop + context, last), last), own, stop

    def rows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The bytes of windows in rows, zeros behind the short ones."""
        length = end - start
        longest = int(length.max()) if len(length) else 0
        if longest == 0:
            return np.zeros((len(start), 0), np.uint8)
        runs = np.lib.stride_tricks.sliding_window_view(np.append(self.raw, np.zeros(longest, np.uint8)), longest)[start]
        return np.where(np.arange(longest) < length[:, None], runs, 0)


def train(texts: list[str], labels: list[str], seed: int = 10) -> Model | None:
    """Fit a model to labelled texts; each language weighs the same, however many texts it has."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    units = _units(len(languages))
    model = Model(
        languages,
        Direction(rng, units),
        Direction(rng, units),
        rng.normal(0, 0.2, (2 * units, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    split = Bytes(pa.array(texts, pa.string()))
    text, start, end, _, _ = split.windows(*TRAINED)
    label = np.array([languages.index(l) for l in labels])[text]
    letters = np.concatenate([[0], np.cumsum(_LETTER[split.raw])])
    lettered = letters[end] > letters[start]
    pools = [np.flatnonzero(lettered & (label == l)) for l in range(len(languages))]
    pools = [p for p in pools if len(p)]
    if len(languages) == 1 or not pools:
        return model
    means = [np.zeros_like(p) for p in model.parameters()]
    squares = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, STEPS + 1):
        rows = np.concatenate([rng.choice(p, max(1, BATCH // len(pools))) for p in pools])
        rate = RATE * min(1, 2 * (1 - step / (STEPS + 1)))
        gradients = model.gradients(split.rows(start[rows], end[rows]), end[rows] - start[rows], label[rows])
        norm = np.sqrt(sum(float((g**2).sum()) for g in gradients))
        for p, g, m, s in zip(model.parameters(), gradients, means, squares):
            g = g / max(norm, 1)
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


class Labeller:
    """Sums of the probabilities of texts over their letter bytes."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def sums(self, split: Bytes) -> np.ndarray:
        """A row for each text; the last column counts the letter bytes."""
        text, start, end, own, stop = split.windows()
        out = np.zeros((len(split.bounds) - 1, len(self.model.languages) + 1))
        order = np.argsort(start - end, kind="stable")  # long ones first
        at_once = _fewer(AT_ONCE, len(self.model.languages))
        for i in range(0, len(order), at_once):
            some = order[i:i + at_once]
            x = split.rows(start[some], end[some])
            p, _, turned, *_ = self.model._forward(x, end[some] - start[some])
            at = np.arange(x.shape[1], dtype=np.int32)[:, None]
            first, behind = ((a[some] - start[some]).astype(np.int32) for a in (own, stop))
            counted = (_LETTER[turned] & (at >= first) & (at < behind)).astype(p.dtype)
            p *= counted
            np.add.at(out, text[some], np.concatenate([p.sum(1), counted.sum(0)[None]]).T)
        return out


def _predicted(texts: pa.Array, labeller: Labeller | None) -> pa.Array:
    n = len(texts)
    names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
    if labeller is not None and n:
        split = Bytes(texts)
        total = labeller.sums(split)
        letters = total[:, -1]
        mean = total[:, :-1] / np.maximum(letters, 1)[:, None]
        best = mean.argmax(axis=1)
        known = letters > 0
        # Bytes beyond ASCII count as letters above; texts without a letter of ASCII are looked at by character.
        plain = np.concatenate([[0], np.cumsum((split.raw > 96) & (split.raw < 123))])
        for i in np.flatnonzero(known & (plain[split.bounds[1:]] == plain[split.bounds[:-1]])):
            known[i] = any(c.isalpha() for c in texts[int(i)].as_py())
        names[known] = np.array(labeller.model.languages, object)[best[known]]
        scores[known] = np.clip(mean[np.arange(n), best][known], 0, 1)
    return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], names=["lang_pred", "score"])


def sample(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", id_column: str = "doc_id") -> DataFrame:
    """The training sample, of columns ``lang`` and ``text``: ``CELLS`` rows of ``SAMPLE_BYTES`` at most for each language.

    First the smallest hash of each cell of each language, then the rows that have it: only the few texts asked
    for are moved.
    """
    named = docs.select(
        F.col(quoted(lang_column)).cast("string").alias("lang"),
        F.col(quoted(text_column)).cast("string").alias("text"),
        F.xxhash64(F.col(quoted(id_column)), F.octet_length(F.col(quoted(text_column)).cast("string"))).alias("h"),
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    chosen = named.groupBy("lang", F.pmod("h", F.lit(CELLS)).alias("cell")).agg(F.min("h").alias("h")).select("lang", "h")
    picked = named.join(F.broadcast(chosen), ["lang", "h"])
    cut = F.substring(F.encode("text", "UTF-8"), 1, SAMPLE_BYTES)
    return picked.groupBy("lang", "h").agg(F.min(F.hex(cut)).alias("text")).select("lang", F.unhex("text").alias("text"))


def fit(docs: DataFrame, **columns: str) -> Model | None:
    """Train on the sample of ``docs``; the languages bound it, so training is a matter of the driver."""
    rows = sorted((r["lang"], bytes(r["text"]).decode("utf-8", "ignore")) for r in sample(docs, **columns).collect())
    return train([t for _, t in rows], [l for l, _ in rows])


def identified(docs: DataFrame, model: Model | None, text_column: str = "text", name: str = "language", slice_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with one more column ``name`` (underscores in front if taken): a struct of ``lang_pred``, ``score``."""
    column, at = fresh(docs, name), place_of(docs, text_column)
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*docs.schema.fields]).add(column, _RESULT)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = None if held.value is None else Labeller(held.value)
        most = slice_bytes if labeller is None else _fewer(slice_bytes, len(held.value.languages))
        for batch in batches:
            for part in slices(batch, at, most):
                found = _predicted(part.column(at), labeller)
                yield pa.record_batch([*part.columns, found], names=[*part.schema.names, column])

    return docs.mapInArrow(label, schema)


def least_of(languages: int) -> float:
    """The least score of an accepted document. No highest score is below ``1 / languages``, so it follows their number."""
    chance = 1 / max(languages, 1)
    return 0.0 if languages < 2 else chance + ABOVE_CHANCE * (1 - chance)


def accepted(docs: DataFrame, model: Model | None, least_score: float | None = None, **settings) -> DataFrame:
    """The documents in a learned language, in the columns of ``docs``; ``und`` and scores below ``least_score`` go
    (none: that of :func:`least_of`)."""
    if least_score is None:
        least_score = least_of(0 if model is None else len(model.languages))
    found = identified(docs, model, **settings)
    column = quoted(found.columns[-1])
    return found.where((F.col(f"{column}.lang_pred") != UNKNOWN) & (F.col(f"{column}.score") >= least_score)).drop(found.columns[-1])


def in_training(id_column: str = "doc_id") -> Column:
    """Rows to learn from: ``crc32`` of the identifier as text (null: empty), modulo 3, is not 1."""
    return ~held_out(id_column)


def held_out(id_column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit(""))) % 3 == 1
