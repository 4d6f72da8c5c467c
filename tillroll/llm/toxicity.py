"""Toxicity by multiple-instance learning: sentences are scored, a document is toxic if any of its sentences is.

Only documents carry labels. A sentence's probability is a logistic function of the hashed words in it, a
document's is the noisy-or 1 - prod(1 - p) over its sentences, and the gradient of the document's likelihood flows
back to the sentences that explain it. The same sentence scores then tell where the offending sentences are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.learning import Adam, Sample, bucket, sample, sigmoid, telling
from tillroll.llm.words import ALPHANUMERIC, Words, byte_class, chunks, column, segment_starts, words_of

# Labelled documents of each label that a fit looks at, at most.
SAMPLE_PER_LABEL = 2500
BITS = 18
STOPS = byte_class(".!?\n")
# A sentence at or above this score is reported as offending.
OFFENDING = 0.3


@dataclass
class Sentences:
    """Sentences with a word: their text, their byte span in it, and the distinct hashed words of each."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    sentence: np.ndarray  # per feature, the sentence
    feature: np.ndarray
    n_texts: int


def sentences_of(texts: pa.Array, bits: int = BITS) -> Sentences:
    """Sentences end with any of ``.!?``, a line break or the text."""
    words: Words = words_of(texts, ALPHANUMERIC)
    ended = np.concatenate([[0], np.cumsum(STOPS[words.data])])
    group = ended[words.start] if len(words.start) else np.zeros(0, np.int64)
    first = segment_starts(words.text, group)
    number = np.zeros(len(words.start), np.int64)
    number[first] = 1
    number = np.cumsum(number) - 1
    last = np.append(first[1:], len(words.start)) - 1 if len(first) else first
    code = np.unique(number << bits | bucket(words.hashes(), bits))
    base = words.offsets[words.text[first]]
    return Sentences(words.text[first], words.start[first] - base, words.end[last] - base, code >> bits, code & ((1 << bits) - 1), words.n_texts)


def _only(s: Sentences, used: np.ndarray) -> Sentences:
    keep = used[s.feature]
    return Sentences(s.text, s.start, s.end, s.sentence[keep], s.feature[keep], s.n_texts)


@dataclass
class Bags:
    """Groups of sentences that have the same words in one text: the text, how many they are, and their features."""

    text: np.ndarray
    n: np.ndarray
    group: np.ndarray  # per feature, the group
    feature: np.ndarray


def _bags(drawn: Sample, used: np.ndarray, bits: int) -> Bags:
    """Sentences of the whole sampled texts by the ``used`` words in them; those without any are one group of their text."""

    def form(batch: pa.RecordBatch) -> list[pa.Array]:
        s = _only(sentences_of(column(batch, "text"), bits), used)
        bounds = np.searchsorted(s.sentence, np.arange(len(s.text) + 1))
        bare = np.bincount(s.text[np.diff(bounds) == 0], minlength=s.n_texts)
        groups: dict[tuple[int, bytes], int] = {(int(t), b""): int(bare[t]) for t in np.flatnonzero(bare)}
        feature = s.feature.astype(np.int32)
        for i in np.flatnonzero(np.diff(bounds)):
            key = int(s.text[i]), feature[bounds[i] : bounds[i + 1]].tobytes()
            groups[key] = groups.get(key, 0) + 1
        place = column(batch, "place").to_numpy()[np.array([t for t, _ in groups], np.int64)]
        sets = [np.frombuffer(f, np.int32) for _, f in groups]
        return [pa.array(place), pa.array(list(groups.values()), pa.int64()), pa.array(sets, pa.list_(pa.int32()))]

    rows = drawn.formed(form, "place bigint, n bigint, features array<int>")
    features = rows["features"].combine_chunks()
    sizes = features.value_lengths().to_numpy()
    return Bags(rows["place"].to_numpy(), rows["n"].to_numpy(), np.repeat(np.arange(len(sizes)), sizes), features.flatten().to_numpy())


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    leak: float
    bits: int = BITS

    def sentence_scores(self, s: Sentences) -> np.ndarray:
        return sigmoid(self.bias + np.bincount(s.sentence, self.weights[s.feature], len(s.text)))

    def document_scores(self, s: Sentences, scores: np.ndarray, leak: bool = True) -> np.ndarray:
        return 1 - (1 - self.leak * leak) * np.exp(np.bincount(s.text, np.log1p(-np.minimum(scores, 1 - 1e-12)), s.n_texts))


def fit(drawn: Sample, epochs: int = 200, rate: float = 0.1, penalty: float = 1e-4, bits: int = BITS) -> ToxicityModel:
    """Likelihood of document labels under the noisy-or, each label weighted to its share of all rows.

    The leak, a cause of its own that every document shares, takes up labels that no sentence explains, and the
    penalty keeps weights small. Only words that are ``telling`` get a weight. Without rows of both labels every text scores the share of label 1.
    Tasks form the features of whole texts; the driver holds no more than the telling words, equal sentences of a text once.
    """
    labels, counts = drawn.labels, drawn.counts
    total, weights = counts[0] + counts[1], np.zeros(1 << bits)
    if drawn.one_sided():
        return ToxicityModel(weights, -30.0, counts[1] / total if total else 0.0, bits)

    def codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        s = sentences_of(texts, bits)
        pairs = np.unique(s.text[s.sentence] << bits | s.feature)
        return pairs >> bits, pairs & ((1 << bits) - 1)

    frequency, positive = drawn.frequencies(codes, 1 << bits)
    used = telling(positive, frequency, labels, towards_one=True)
    s = _bags(drawn, used, bits)
    vocabulary, local = np.unique(s.feature, return_inverse=True)
    drawn_of = np.array([max(1, (labels == y).sum()) for y in (0, 1)])
    importance = (np.array([counts[0], counts[1]]) / total / drawn_of)[labels.astype(int)]
    w, b, leak = np.zeros(len(vocabulary)), np.full(1, -6.0), np.full(1, -3.0)
    adam = Adam([w, b, leak], rate)
    for _ in range(epochs):
        p = np.minimum(sigmoid(b[0] + np.bincount(s.group, w[local], len(s.text))), 1 - 1e-9)
        stay = 1 - sigmoid(leak[0])
        none = stay * np.exp(np.bincount(s.text, s.n * np.log1p(-p), len(labels)))
        slope = importance * np.where(labels == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        g = s.n * slope[s.text] * p
        adam.step([np.bincount(local, g[s.group], len(w)) + penalty * w, np.array([max(g.sum(), 0.0)]), np.array([slope.sum() * (1 - stay)])])
    weights[vocabulary] = w
    return ToxicityModel(weights, float(b[0]), float(sigmoid(leak[0])), bits)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", eligible: Column | None = None, per_label: int = SAMPLE_PER_LABEL, **names: str) -> ToxicityModel:
    """Fit on a bounded sample of labelled documents (see ``learning.sample``); ``eligible`` is a condition on ``id``."""
    return fit(sample(docs, labels, label, eligible, per_label=per_label, **names))


def score(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", offending: float = OFFENDING) -> DataFrame:
    """Per row of ``docs``: doc_id, score double, sentences array<struct<start, end, score>>.

    ``score`` is the noisy-or over the sentences of the whole text; a null or wordless text has no sentence and
    scores the leak. ``sentences`` are those that score at least ``offending``, in order, by byte positions in the UTF-8
    text. Equal texts score alike; repeated rows stay; other columns are not read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spot = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        model = shared.value
        for batch in chunks(batches, "text"):
            s = sentences_of(column(batch, "text"), model.bits)
            scores = model.sentence_scores(s)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for i in np.flatnonzero(scores >= offending):
                found[s.text[i]].append({"start": int(s.start[i]), "end": int(s.end[i]), "score": float(scores[i])})
            columns = [column(batch, "doc_id"), pa.array(model.document_scores(s, scores)), pa.array(found, spot)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "sentences"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, score double, sentences array<struct<start: bigint, end: bigint, score: double>>")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = OFFENDING, text: str = "text") -> DataFrame:
    """Rows of ``docs``, unchanged and with the same columns, whose sentences score below ``threshold`` together.

    The leak, which no sentence explains, rejects nothing; null and wordless texts stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in chunks(batches, text):
            s = sentences_of(column(batch, text), shared.value.bits)
            yield batch.filter(pa.array(shared.value.document_scores(s, shared.value.sentence_scores(s), leak=False) < threshold))

    return docs.mapInArrow(run, docs.schema)
