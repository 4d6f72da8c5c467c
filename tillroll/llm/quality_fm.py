"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise term is computed in linear time as
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.learning import Adam, Sample, sample, sigmoid, telling
from tillroll.llm.words import NOT_SPACE, U64, byte_class, chunks, column, mix, segment_starts, words_of

# Labelled documents of each label that a fit looks at, at most.
SAMPLE_PER_LABEL = 1500
BITS = 18
RANK = 8
# Each statistic is cut at the quantiles of the sample into this many bins, one indicator each.
BINS = 16

# Kinds of bytes; what no class names is 0.
_KIND = np.zeros(256, np.uint8)
for _i, _pattern in enumerate(["A-Z", "0-9", "#*$%&|<>@_={}[]\\^~+", ".,;:!?", "\n", "\x80-\xff"], 1):
    _KIND[byte_class(_pattern)] = _i
_BREAK, _MARK = byte_class("\n"), byte_class(".,;:!?")

STATISTICS = [
    "log words", "word length", "upper case", "digits", "symbols", "marks", "line breaks", "beyond ASCII",
    "distinct words", "repeated lines", "words ending in a mark", "bytes of the longest word", "bytes per word as stored",
]


def _distinct(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The distinct (text, upper 40 bits of the hash) in one number, sorted."""
    codes = np.sort(text << 40 | (hashes >> U64(24)).astype(np.int64))
    return codes[segment_starts(codes)]


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row per text of ``STATISTICS``; then the distinct words of all texts, as text and upper 40 bits of the hash."""
    words = words_of(texts, NOT_SPACE)
    raw = texts.cast(pa.large_string()).fill_null("")
    n_texts, end = words.n_texts, int(words.offsets[-1])
    low = int(np.frombuffer(raw.buffers()[1], np.int64)[raw.offset]) if n_texts else 0
    data = np.frombuffer(raw.buffers()[2], np.uint8)[low : low + end] if end else np.zeros(0, np.uint8)
    bytes_ = np.diff(words.offsets)
    kinds = np.bincount(np.repeat(np.arange(n_texts) * 8, bytes_) + _KIND[data], minlength=8 * n_texts).reshape(n_texts, 8)[:, 1:7] / np.maximum(bytes_, 1)[:, None]
    n = words.counts()
    some, lengths = np.maximum(n, 1), words.end - words.start
    longest = np.zeros(n_texts)
    begin = segment_starts(words.text)
    longest[words.text[begin]] = np.maximum.reduceat(lengths, begin) if len(begin) else 0
    hashes = words.hashes()
    codes = _distinct(words.text, hashes)
    marked = np.bincount(words.text, _MARK[data[words.end - 1]], n_texts)
    line = np.concatenate([[0], np.cumsum(_BREAK[data])])[words.start]
    begin = segment_starts(words.text, line)
    place = np.arange(len(hashes)) - np.repeat(begin, np.diff(np.append(begin, len(hashes))))
    lines = np.add.reduceat(mix(hashes + place.astype(U64)), begin) if len(begin) else hashes
    in_text = words.text[begin]
    different = np.bincount(_distinct(in_text, lines) >> 40, minlength=n_texts)
    repeated = 1 - different / np.maximum(np.bincount(in_text, minlength=n_texts), 1)
    table = np.stack([
        np.log1p(n), np.bincount(words.text, lengths, n_texts) / some, *kinds.T, np.bincount(codes >> 40, minlength=n_texts) / some,
        np.where(n > 0, repeated, 0), marked / some, np.log1p(longest), bytes_ / some,
    ], 1)
    return table, codes >> 40, codes & ((1 << 40) - 1)


@dataclass
class Features:
    """Rows of a sparse matrix: text, feature number and value of each entry."""

    text: np.ndarray
    feature: np.ndarray
    value: np.ndarray
    n_texts: int


@dataclass
class QualityModel:
    edges: np.ndarray  # per statistic, the bounds of its bins
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    bits: int = BITS

    def __post_init__(self) -> None:
        self.active = (self.linear != 0) | self.factors.any(1)

    def features(self, texts: pa.Array) -> Features:
        return features(texts, self.edges, self.bits)

    def scores(self, x: Features) -> np.ndarray:
        used = self.active[x.feature]
        x = Features(x.text[used], x.feature[used], x.value[used], x.n_texts)
        return sigmoid(_margin(x, self.bias, self.linear[x.feature], self.factors[x.feature])[0])


def features(texts: pa.Array, edges: np.ndarray, bits: int) -> Features:
    """Indicators of statistic bins first, then hashed words that share the weight of their text."""
    table, text, hashes = statistics(texts)
    n, kinds = table.shape
    bins = np.stack([np.searchsorted(edges[k], table[:, k], "right") + k * BINS for k in range(kinds)], 1)
    code = text << bits | hashes >> (40 - bits)
    code = code[segment_starts(code)]
    word_text = code >> bits
    value = 1 / np.sqrt(np.maximum(np.bincount(word_text, minlength=n), 1))
    return Features(
        np.concatenate([np.repeat(np.arange(n), kinds), word_text]), np.concatenate([bins.ravel(), kinds * BINS + (code & ((1 << bits) - 1))]),
        np.concatenate([np.full(n * kinds, 1 / np.sqrt(kinds)), value[word_text]]), n,
    )


def _margin(x: Features, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The machine's value per text, and the sums of factors that its gradient needs too; ``w`` and ``v`` by entry."""
    weighted = v * x.value[:, None]
    sums = np.stack([np.bincount(x.text, weighted[:, f], x.n_texts) for f in range(v.shape[1])], 1)
    squares = np.bincount(x.text, (weighted**2).sum(1), x.n_texts)
    return bias + np.bincount(x.text, w * x.value, x.n_texts) + 0.5 * ((sums**2).sum(1) - squares), sums


def fit(drawn: Sample, epochs: int = 80, rate: float = 0.1, penalty: float = 2e-4, bits: int = BITS, rank: int = RANK, seed: int = 7) -> QualityModel:
    """Penalised logistic likelihood, each label weighted to its share of all rows.

    Words get parameters only where they are ``telling``. Without rows of both labels every text scores the share
    of label 1; without any rows, one half. Tasks form the features of whole texts; the driver holds no more than
    their statistics and telling words.
    """
    labels, counts = drawn.labels, drawn.counts
    kinds, total = len(STATISTICS), counts[0] + counts[1]
    linear, factors = np.zeros(kinds * BINS + (1 << bits)), np.zeros((kinds * BINS + (1 << bits), rank))
    if drawn.one_sided():
        p = (counts[1] + 0.5) / (total + 1)
        return QualityModel(np.zeros((kinds, BINS - 1)), float(np.log(p / (1 - p))), linear, factors, bits)

    def measured(batch: pa.RecordBatch) -> list[pa.Array]:
        return [column(batch, "place"), *[pa.array(c) for c in statistics(column(batch, "text"))[0].T]]

    table = drawn.formed(measured, ", ".join(["place bigint", *[f"s{k} double" for k in range(kinds)]]))
    edges = np.quantile(np.stack([table[f"s{k}"].to_numpy() for k in range(kinds)], 1), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T

    def codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = features(texts, edges, bits)
        return x.text, x.feature

    frequency, positive = drawn.frequencies(codes, len(linear))
    keep = telling(positive, frequency, labels)
    keep[: kinds * BINS] = True

    def kept(batch: pa.RecordBatch) -> list[pa.Array]:
        x = features(column(batch, "text"), edges, bits)
        used = keep[x.feature]
        return [pa.array(column(batch, "place").to_numpy()[x.text[used]]), pa.array(x.feature[used].astype(np.int32)), pa.array(x.value[used])]

    entries = drawn.formed(kept, "place bigint, feature int, value double")
    x = Features(entries["place"].to_numpy(), entries["feature"].to_numpy(), entries["value"].to_numpy(), len(labels))
    vocabulary, local = np.unique(x.feature, return_inverse=True)
    drawn_of = np.array([max(1, (labels == y).sum()) for y in (0, 1)])
    importance = (np.array([counts[0], counts[1]]) / total / drawn_of)[labels.astype(int)]
    w, v, b = np.zeros(len(vocabulary)), np.random.default_rng(seed).normal(0, 0.05, (len(vocabulary), rank)), np.zeros(1)
    b[0] = np.log(counts[1] / counts[0])
    adam = Adam([w, v, b], rate)
    for _ in range(epochs):
        margin, sums = _margin(x, b[0], w[local], v[local])
        slope = importance * (sigmoid(margin) - labels)
        push = slope[x.text] * x.value
        pull = push[:, None] * (sums[x.text] - v[local] * x.value[:, None])
        adam.step([
            np.bincount(local, push, len(w)) + penalty * w,
            np.stack([np.bincount(local, pull[:, f], len(w)) for f in range(rank)], 1) + penalty * v, np.array([slope.sum()]),
        ])
    linear[vocabulary], factors[vocabulary] = w, v
    return QualityModel(edges, float(b[0]), linear, factors.astype(np.float32), bits)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", eligible: Column | None = None, per_label: int = SAMPLE_PER_LABEL, **names: str) -> QualityModel:
    """Fit on a bounded sample of labelled documents (see ``learning.sample``); ``eligible`` is a condition on ``id``."""
    return fit(sample(docs, labels, label, eligible, per_label=per_label, **names))


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and score, the probability of label 1 for the whole text.

    The metadata that goes in is the stored size of a text; columns other than the id and the text are not read.
    A null text is scored like an empty one. Equal texts score alike; repeated rows stay.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in chunks(batches, "text"):
            scores = shared.value.scores(shared.value.features(column(batch, "text")))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, score double")
