"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point, so no two letters share one. An n-gram's vector
is the product (binding) of its letters' vectors, each rotated (permuted) by its place; a text's vector is the sum (bundle)
of its n-grams' vectors, and a language's prototype the bundle of its texts. A document gets the language whose prototype
has the largest cosine.

Vectors are held as bits, 1 for -1, so that binding is exclusive or; they are unpacked only where they are summed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import U64, chunks, column, mix, segment_starts, stream

DIMENSIONS = 4096
NGRAM = 3
UNKNOWN = "und"
# Distinct n-grams, and texts, that are bundled at once.
SLICE = 512
TEXTS = 128

# A code point has 21 bits; three fill a 64-bit number.
_POINT_BITS = 21
_POINT = U64((1 << _POINT_BITS) - 1)


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)])


class Hypervectors:
    """Vectors of letters, and of n-grams of at most three letters; ``dimensions`` is a multiple of 64."""

    def __init__(self, dimensions: int = DIMENSIONS, ngram: int = NGRAM):
        if dimensions < 64 or dimensions % 64 or not 1 <= ngram <= 3:
            raise ValueError("dimensions must be a multiple of 64, and n-grams have one to three letters")
        self.dimensions, self.ngram = dimensions, ngram
        self.seeds = stream(5, dimensions // 64)

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of a text with their counts; none without a letter. Gaps between words count once."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")
        codes = np.where(_letters()[points], points, 0).astype(U64)
        if not codes.any():
            return np.zeros(0, U64), np.zeros(0)
        codes = np.concatenate([[U64(0)], codes, [U64(0)]])
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
        n = len(codes) - self.ngram + 1
        gram = np.zeros(n, U64)
        for place in range(self.ngram):
            gram = gram << U64(_POINT_BITS) | codes[place : n + place]
        gram.sort()
        first = segment_starts(gram)
        return gram[first], np.diff(np.append(first, len(gram))).astype(np.float64)

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Vectors of code points, 64 bits a number; 0 is the gap between words."""
        return mix(mix(points.astype(U64) + U64(1))[:, None] ^ self.seeds[None, :])

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams; a letter's is rotated by 64 dimensions a place."""
        out = np.zeros((len(grams), len(self.seeds)), U64)
        for place in range(self.ngram):
            points, at = np.unique(grams >> U64(_POINT_BITS * (self.ngram - 1 - place)) & _POINT, return_inverse=True)
            out ^= np.roll(self.letters(points), place, axis=1)[at]
        return out

    def bundles(self, found: list[tuple[np.ndarray, np.ndarray]], group: np.ndarray, n_groups: int) -> np.ndarray:
        """Per group, the sum of the n-gram vectors of its texts; a slice of distinct n-grams of some groups at a time."""
        out = np.zeros((n_groups, self.dimensions))
        order = np.argsort(group, kind="stable")
        bounds = np.searchsorted(group[order], np.arange(0, n_groups + TEXTS, TEXTS))
        for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            texts = order[low:high]
            if len(texts):
                self._bundle([found[t] for t in texts], group[texts] - i * TEXTS, out[i * TEXTS : (i + 1) * TEXTS])
        return out

    def _bundle(self, found: list[tuple[np.ndarray, np.ndarray]], group: np.ndarray, out: np.ndarray) -> None:
        counts = np.concatenate([c for _, c in found])
        owner = np.repeat(group, [len(g) for g, _ in found])
        distinct, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
        order = np.argsort(place, kind="stable")
        counts, owner, place = counts[order], owner[order], place[order]
        for i in range(0, len(distinct), SLICE):
            low, high = np.searchsorted(place, [i, i + SLICE])
            size = min(SLICE, len(distinct) - i)
            table = np.bincount(owner[low:high] * size + place[low:high] - i, counts[low:high], len(out) * size).reshape(len(out), size)
            negative = np.unpackbits(self.bind(distinct[i : i + size]).view(np.uint8), axis=1)
            out += table.sum(1, keepdims=True) - 2 * (table.astype(np.float32) @ negative.astype(np.float32)).astype(np.float64)


@cache
def hypervectors(dimensions: int, ngram: int) -> Hypervectors:
    """Built once per Python worker."""
    return Hypervectors(dimensions, ngram)


@dataclass
class LanguageModel:
    languages: list[str]
    prototypes: np.ndarray  # unit vectors, one per language
    dimensions: int
    ngram: int


def train(docs: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, ngram: int = NGRAM, most_languages: int = 10_000) -> LanguageModel:
    """Prototypes from every text with a language and a letter.

    Each task adds up the n-gram counts of its texts by language and emits one vector for each; these are summed
    by language, so what is shuffled and collected is bounded by languages, of which there may be
    ``most_languages``; the driver gets four bytes for each of their dimensions. A null text, one without a letter, or a
    null language teaches nothing.
    """
    picked = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = hypervectors(dimensions, ngram), {}
        for batch in chunks(batches, "text"):
            languages, group = np.unique(np.array(column(batch, "lang").to_pylist(), object), return_inverse=True)
            found = [space.grams(value) for value in column(batch, "text").to_pylist()]
            for language, vector in zip(languages, space.bundles(found, group, len(languages)), strict=True):
                sums[language] = sums.get(language, 0.0) + vector.astype(np.float64)
        for language, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([language]), pa.array([vector.tolist()])], ["lang", "vector"])

    parts = picked.mapInArrow(bundles, "lang string, vector array<double>")
    sums = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    ordered = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("vector"))
    wide = ordered.select("lang", F.transform("vector", lambda x: x["value"].cast("float")).alias("vector"))
    rows = wide.orderBy("lang").limit(most_languages + 1).toArrow()
    if rows.num_rows > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    sums_of = rows["vector"].combine_chunks().flatten().to_numpy().reshape(-1, dimensions).astype(np.float64)
    vectors = {k: v / np.linalg.norm(v) for k, v in zip(rows["lang"].to_pylist(), sums_of, strict=True) if v.any()}
    prototypes = np.stack(list(vectors.values())) if vectors else np.zeros((0, dimensions))
    return LanguageModel(list(vectors), prototypes.astype(np.float32), dimensions, ngram)


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred and score, the cosine with the prototype (0 where it is negative).

    The whole text counts. A null text or one without a letter is ``und`` with score 0, and so is every text when
    no language was learned. Of equal cosines the first language by code point wins; repeated rows stay.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        space = hypervectors(model.dimensions, model.ngram)
        for batch in chunks(batches, "text"):
            texts = column(batch, "text").to_pylist()
            bundles = space.bundles([space.grams(value) for value in texts], np.arange(len(texts)), len(texts))
            norms = np.linalg.norm(bundles, axis=1)
            if model.languages:
                cosines = bundles @ model.prototypes.T / np.maximum(norms, 1e-9)[:, None]
                best = cosines.argmax(1)
                known = norms > 0
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                scores = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0, 1), 0.0)
            else:
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            columns = [column(batch, "doc_id"), pa.array(names, pa.string()), pa.array(scores.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return picked.mapInArrow(run, f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


