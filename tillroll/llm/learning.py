"""What the classifiers share: a bounded sample of labelled texts, features of words formed in tasks, a driver-side fit."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import U64, chunks, column
from tillroll.operators.staging import Staging

# Labelled documents that a fit looks at, at most: those whose id has the smallest hashes, of each label.
SAMPLE_PER_LABEL = 4000


@dataclass
class Sample:
    """A written table of sampled whole texts (place, label, text), the label of each place, and the number of ids of each label."""

    texts: DataFrame
    labels: np.ndarray
    counts: dict[int, int]

    def one_sided(self) -> bool:
        return not self.counts[0] or not self.counts[1]

    def formed(self, form: Callable[[pa.RecordBatch], list[pa.Array]], schema: str) -> pa.Table:
        """What ``form`` makes of the texts in tasks, in order of ``place``, which must be its first column."""
        names = [c.split()[0] for c in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in chunks(batches, "text"):
                yield pa.RecordBatch.from_arrays(form(batch), names)

        rows = self.texts.mapInArrow(run, schema).toArrow()
        # Rows of a place come from one task in order, and the sort is stable.
        return rows.take(np.argsort(rows["place"].to_numpy(), kind="stable")).combine_chunks()

    def frequencies(self, codes: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
        """Per feature below ``size`` the number of texts that have it and of those with label 1; ``codes`` gives distinct (text, feature)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, positive = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for batch in chunks(batches, "text"):
                text, feature = codes(column(batch, "text"))
                n += np.bincount(feature, minlength=size)
                positive += np.bincount(feature[column(batch, "label").to_numpy(zero_copy_only=False)[text] == 1], minlength=size)
            found = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found]), pa.array(positive[found])], ["feature", "n", "positive"])

        sums = self.texts.mapInArrow(run, "feature bigint, n bigint, positive bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
        rows, frequency, positive = sums.toArrow(), np.zeros(size), np.zeros(size)
        feature = rows["feature"].to_numpy()
        frequency[feature], positive[feature] = rows["n"].to_numpy(), rows["positive"].to_numpy()
        return frequency, positive


def sample(
    docs: DataFrame, labels: DataFrame, label: str, eligible: Column | None = None, doc_id: str = "doc_id", text: str = "text",
    per_label: int = SAMPLE_PER_LABEL,
) -> Sample:
    """Whole texts and labels (0/1) of documents with at most ``per_label`` ids of each label, and the number of ids of each.

    Ids are picked from ``labels`` by the order of their hashes, among those that meet ``eligible``, so a rerun picks
    the same; only they are broadcast to fetch texts, in one scan. Other labels than 0 and 1, null ids and
    labels without a document are left out. Texts are written to the shared folder and stay with the tasks;
    equal texts of a label, told by digest, count once.
    """
    ids = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1) and id is not null")
    ids = ids if eligible is None else ids.where(eligible)
    ids = ids.groupBy("id").agg(F.max("label").alias("label")).withColumn("place", F.xxhash64(F.col("id").cast("string")))
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    picked = [ids.where(F.col("label") == y).orderBy("place", "id").limit(per_label).select("id", "label") for y in (0, 1)]
    texts = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked[0].union(picked[1])), "id")
    key = ["hash", "digest", "label"]
    rows = texts.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("digest"), "label", "text")
    table = Staging(docs.sparkSession).write(rows, "sample")
    # Ids may repeat among the documents; the bound holds for rows too.
    firsts = table.groupBy(*key).agg(F.min("row").alias("row")).orderBy(*key).limit(2 * per_label).toArrow()
    places = docs.sparkSession.createDataFrame(pa.table({"row": firsts["row"], "place": pa.array(np.arange(len(firsts)))}))
    chosen = table.join(F.broadcast(places), "row").select("place", "label", "text")
    return Sample(chosen, firsts["label"].to_numpy().astype(np.float64), {y: counts.get(y, 0) for y in (0, 1)})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Steps of bounded size for arrays that are updated in place."""

    def __init__(self, parameters: list[np.ndarray], rate: float):
        self.parameters, self.rate, self.t = parameters, rate, 0
        self.first = [np.zeros_like(p) for p in parameters]
        self.second = [np.zeros_like(p) for p in parameters]

    def step(self, gradients: list[np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for p, g, m, v in zip(self.parameters, gradients, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= scale * m / (np.sqrt(v) + 1e-8)


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


def telling(positive: np.ndarray, frequency: np.ndarray, labels: np.ndarray, towards_one: bool = False) -> np.ndarray:
    """Features whose documents' share of label 1 differs by more than chance allows among so many features.

    By the likelihood ratio; ``towards_one`` keeps those only that speak for label 1.
    """
    n, n1 = len(labels), labels.sum()
    share, rest = positive / np.maximum(frequency, 1), (n1 - positive) / np.maximum(n - frequency, 1)

    def fitted(hits, of, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return hits * np.log(p) + (of - hits) * np.log(1 - p)

    ratio = fitted(positive, frequency, share) + fitted(n1 - positive, n - frequency, rest) - fitted(n1, n, n1 / n)
    found = 2 * ratio > 2 * np.log(max(2, np.count_nonzero(frequency))) + 4
    return found & (share > n1 / n) if towards_one else found & (frequency > 0)
