"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed through it while the
longest run that ends at the current word and occurs in an item is tracked; runs of at least ``window`` words,
and whole items that are shorter, are contaminated spans.

The items are cut into shards of at most ``SHARD_WORDS`` words, one automaton each; every document meets every
shard, so any number of items works and only one bounded automaton at a time is in a task's memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import ALPHANUMERIC, chunks, column, fresh, words_of

WINDOW = 10
SHARD_WORDS = 200_000
# A document of which more than this share is hit is dropped instead of cut.
MOST_COVERED = 0.5


class SuffixAutomaton:
    """All runs of words of some items; states know which items hold their runs."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[tuple[int, str]] = []  # states at which a prefix of an item ends
        self.short: dict[int, list[tuple[int, str]]] = {}  # per state, items below the window that are its run

    def add(self, words: list[int], item: str) -> None:
        state = 0
        for word in words:
            state = self._extend(state, word)
            self.ends.append((state, item))

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        """A copy of ``target`` for its runs that are no longer than what leads to it from ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.next[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(-1)
        self.length.append(length)
        return len(self.next) - 1

    def finish(self, short_items: Iterable[tuple[list[int], str]]) -> SuffixAutomaton:
        """Carry items from the states where they end to those of their suffixes, and place the short items."""
        self.items: list[set[str]] = [set() for _ in self.next]
        for state, item in self.ends:
            while state > 0 and self.length[state] >= self.window and item not in self.items[state]:
                self.items[state].add(item)
                state = self.link[state]
        self.ends = []
        for words, item in short_items:
            state = 0
            for word in words:
                state = self.next[state][word]
            self.short.setdefault(state, []).append((len(words), item))
        # The nearest state on the way of links, itself included, that is a short item.
        self.nearest_short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.nearest_short[state] = state if state in self.short else self.nearest_short[self.link[state]]
        return self

    def spans(self, words: Iterable[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, word after the last, items) of each contaminated run; they may overlap."""
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            target = self.next[state].get(word)
            if target is None:
                matched = 0
                continue
            state, matched = target, matched + 1
            short = self.nearest_short[state]
            while short > 0:
                for n, item in self.short[short]:
                    if n <= matched:
                        yield i + 1 - n, i + 1, {item}
                short = self.nearest_short[self.link[short]]
            if matched >= self.window:
                # Items that hold the last ``window`` words: those of the state that covers this length.
                holder = state
                while self.length[self.link[holder]] >= self.window:
                    holder = self.link[holder]
                yield i + 1 - matched, i + 1, self.items[holder]


@dataclass
class Shard:
    """One automaton, with what tells quickly where no run can be."""

    vocabulary: np.ndarray
    pairs: np.ndarray
    least: int
    automaton: SuffixAutomaton = field(repr=False)

    @classmethod
    def of(cls, items: list[tuple[str, np.ndarray]], window: int) -> Shard:
        vocabulary = np.unique(np.concatenate([h for _, h in items]))
        automaton, short, pairs, least = SuffixAutomaton(window), [], [], window
        for item, hashes in items:
            ids = np.searchsorted(vocabulary, hashes)
            pairs.append(_pair(ids[:-1], ids[1:], len(vocabulary)))
            automaton.add(ids.tolist(), item)
            if len(ids) < window:
                short.append((ids.tolist(), item))
                least = min(least, len(ids))
        return cls(vocabulary, np.unique(np.concatenate(pairs)), least, automaton.finish(short))

    def runs(self, hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, and begin and end of the runs of words whose neighbours are neighbours in an item too.

        A run shorter than the shortest thing to find is left out; nothing that the automaton would match is.
        """
        ids = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[ids] == hashes
        joined = np.zeros(len(ids) + 1, bool)  # word i and word i - 1 belong together
        if len(ids) > 1 and len(self.pairs):
            pair = _pair(ids[:-1], ids[1:], len(self.vocabulary))
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[1:-1] = (self.pairs[at] == pair) & known[:-1] & known[1:] & (text[:-1] == text[1:])
        begin = np.flatnonzero(known & ~joined[:-1])
        end = np.flatnonzero(known & ~joined[1:]) + 1
        long = end - begin >= self.least
        return ids, begin[long], end[long]


def _pair(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    return a.astype(np.int64) * n + b


def benchmark_shards(benchmark: DataFrame, item_id: str, text: str, window: int, shard_words: int) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items with their word hashes, in lots of about ``shard_words`` words; fetched partition by partition."""
    lot, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    for row in rows.where(F.col("text").isNotNull()).toLocalIterator():
        hashes = words_of(pa.array([row.text]), ALPHANUMERIC).hashes()
        if len(hashes) == 0:
            continue
        if lot and size + len(hashes) > shard_words:
            yield lot
            lot, size = [], 0
        lot.append((row["item"], hashes))
        size += len(hashes)
    if lot:
        yield lot


_built: dict[bytes, Shard] = {}


def _shard(items: list[tuple[str, np.ndarray]], window: int) -> Shard:
    """Built once per Python worker, which keeps one shard at a time."""
    digest = hashlib.sha256(repr(window).encode())
    for item, hashes in items:
        digest.update(item.encode() + b"\0" + hashes.tobytes() + b"\0")
    key = digest.digest()
    if key not in _built:
        _built.clear()
        _built[key] = Shard.of(items, window)
    return _built[key]


def _find(shard: Shard, hashes: np.ndarray, text: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """Per text with a hit: merged word spans, counted over the whole array, and items."""
    found: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    ids, begins, ends = shard.runs(hashes, text)
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        for first, after, items in shard.automaton.spans(ids[begin:end].tolist()):
            spans, held = found.setdefault(int(text[begin]), ([], set()))
            held |= items
            first, after = first + begin, after + begin
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append((first, after))
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """Per row of ``docs``: its id, n_words, spans of hit words and the items found.

    Columns: ``doc_id`` as given, n_words long, spans array<struct<first, after>> in word numbers (disjoint, in
    order), items array<string> (distinct, sorted). Words are runs of ASCII letters and digits and of anything
    beyond ASCII, with A-Z lower-cased. A null or wordless text has no words and no hits, and so has every text
    when there are no items; an item that is null or wordless is never found; a null item id counts as empty text.
    Repeated rows each get their own result; other columns are not read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.lit(None).cast("bigint").alias("n_words"), _none("spans", _SPANS), _none("items", _ITEMS))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text string, n_words bigint, spans {_SPANS}, items {_ITEMS}"
    # One scan: shard after shard adds to what the ones before have found.
    lots = list(benchmark_shards(benchmark, item_id, item_text, window, shard_words)) or [[]]
    for i, lot in enumerate(lots):
        last = i == len(lots) - 1
        picked = picked.mapInArrow(_scan(lot, window, last), schema.replace("text string, ", "") if last else schema)
    return picked


_SPANS, _ITEMS = "array<struct<first: bigint, after: bigint>>", "array<string>"
_ARROW_SPANS, _ARROW_ITEMS = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())])), pa.list_(pa.string())


def _none(name: str, kind: str) -> Column:
    return F.array().cast(kind).alias(name)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """In order, with those that meet joined."""
    out: list[tuple[int, int]] = []
    for first, after in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], after))
        else:
            out.append((first, after))
    return out


def _spans_with(lot, window, batch, words, name) -> tuple[list[list[tuple[int, int]]], dict[int, set[str]]]:
    """Per row, the spans in column ``name`` together with those of a lot, in word numbers of the row; and the lot's items."""
    spans = [[(x["first"], x["after"]) for x in row or ()] for row in column(batch, name).to_pylist()]
    found = _find(_shard(lot, window), words.hashes(), words.text) if lot else {}
    firsts, items = words.firsts(), {}
    for row, (hit, held) in found.items():
        spans[row] = _merged(spans[row] + [(int(a - firsts[row]), int(b - firsts[row])) for a, b in hit])
        items[row] = held
    return spans, items


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"first": a, "after": b} for a, b in row] for row in spans], _ARROW_SPANS)


def _scan(lot, window, last):
    def run(batches):
        for batch in chunks(batches, "text"):
            words = words_of(column(batch, "text"), ALPHANUMERIC)
            spans, held = _spans_with(lot, window, batch, words, "spans")
            items = [sorted({*before, *held.get(row, ())}) for row, before in enumerate(column(batch, "items").to_pylist())]
            columns = [pa.array(words.counts(), pa.int64()), _span_array(spans), pa.array(items, _ARROW_ITEMS)]
            names = ["doc_id"] if last else ["doc_id", "text"]
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in names], *columns], [*names, "n_words", "spans", "items"])

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, most_covered: float = MOST_COVERED, n_chars: str | None = None, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without contaminated spans: the same columns, clean rows untouched.

    A hit run of words is cut out of the text, with the bytes between its words; a space stays in its place. A
    document of which more than ``most_covered`` of the words are hit is dropped. ``n_chars`` names a column that
    holds the length of the text and follows it. Null and wordless texts stay. What all shards of items find is put
    together before anything is cut or dropped, so the result does not depend on ``shard_words``.
    """
    columns, spans, schema = docs.columns, fresh(docs, "found_spans"), docs.schema
    lots = list(benchmark_shards(benchmark, item_id, item_text, window, shard_words))
    if not lots:
        return docs
    docs = docs.withColumn(spans, _none(spans, _SPANS))
    for lot in lots[:-1]:
        docs = docs.mapInArrow(_mark(lot, window, text, spans), docs.schema)
    return docs.mapInArrow(_cut(lots[-1], window, text, spans, most_covered, n_chars), schema).select(*columns)


def _mark(lot, window, text, name):
    def run(batches):
        for batch in chunks(batches, text):
            spans, _ = _spans_with(lot, window, batch, words_of(column(batch, text), ALPHANUMERIC), name)
            yield batch.set_column(batch.schema.get_field_index(name), name, _span_array(spans))

    return run


def _cut(lot, window, text, name, most_covered, n_chars):
    def run(batches):
        for batch in chunks(batches, text):
            texts = column(batch, text)
            words = words_of(texts, ALPHANUMERIC)
            firsts = words.firsts()
            found, _ = _spans_with(lot, window, batch, words, name)
            batch = batch.drop_columns(name)
            keep, cut = np.ones(batch.num_rows, bool), {}
            for row, spans in enumerate(found):
                if not spans:
                    continue
                if sum(b - a for a, b in spans) > most_covered * (firsts[row + 1] - firsts[row]):
                    keep[row] = False
                    continue
                raw, at, kept = texts[row].as_py().encode(), 0, []
                for a, b in spans:
                    kept.append(raw[at : words.start[firsts[row] + a] - words.offsets[row]])
                    at = words.end[firsts[row] + b - 1] - words.offsets[row]
                cut[row] = b" ".join([*kept, raw[at:]]).decode()
            if cut:
                values = [cut.get(i, v) for i, v in enumerate(texts.to_pylist())]
                batch = batch.set_column(batch.schema.get_field_index(text), batch.schema.field(text), pa.array(values, texts.type))
                if n_chars:
                    i = batch.schema.get_field_index(n_chars)
                    lengths = [len(cut[k]) if k in cut else v for k, v in enumerate(batch.column(i).to_pylist())]
                    batch = batch.set_column(i, batch.schema.field(i), pa.array(lengths, batch.schema.field(i).type))
            yield batch if keep.all() else batch.filter(pa.array(keep))

    return run
