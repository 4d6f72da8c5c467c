"""Language-model scoring with a hierarchical Pitman-Yor model.

Every word is a context with a restaurant of its own for the words behind it (a text begins behind an end); all of them share
one parent restaurant, whose dishes come from a base distribution over known words and one unknown word. A context's tables for
a word are customers of the parent. The number of tables of each dish is resampled by Gibbs sweeps: from its exact conditional
(generalised Stirling numbers) up to ``EXACT`` customers; customers beyond are seated in turn. Predictive
probabilities are averaged over the samples after burn-in.

Pairs of a word and the word before are dealt into buckets by the hash of the word; those of words with a large share of all
tokens by the word before. A sweep resamples all dishes against the totals of the sweep before. Those of a context come from
all buckets: each sends what it has of a context to the bucket of that word, and is told the sum. A pair seen once has one
table whatever is drawn, so only pairs seen more often take part. Random numbers follow from word, context and sweep, so the
dealing changes nothing.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.words import U64, chunks, column, mix, segment_starts, words_of
from tillroll.operators.staging import Staging

# Contexts without customers are alike, so one stands for all of them.
CONTEXTS = 1
SWEEPS, BURN_IN = 3, 1
EXACT = 100
CONCENTRATION = 1.0
# Share of the base distribution that the unknown word has.
UNKNOWN_SHARE = 0.9
# Pairs of words with at least this share of all tokens are dealt by the word before; there are at most a thousand such words.
HOT_SHARE = 0.001
BLOCK_TOKENS, BLOCK_TEXTS = 1_200_000, 60_000
# There are at least as many buckets as this makes of all tokens.
BUCKET_TOKENS = 5_000_000

_END = mix(np.array([0xE0D], U64))[0]
_KEPT = range(BURN_IN, SWEEPS)
# In place of a bucket: the hot words.
_HOT_ROW = -1
# Rows of a bucket: its pairs, their seats, the contexts that are its words, and what buckets added to the tables of those.
_PAIRS, _SEATS, _CONTEXTS, _ADDED, _REPLY = range(5)


@dataclass
class Tokens:
    """Tokens of some texts in order, the end of each included: word hash, context and text."""

    word: np.ndarray
    context: np.ndarray
    text: np.ndarray


def context_of(word: np.ndarray) -> np.ndarray:
    """A word as context: 48 bits of its hash, in the order of the hashes."""
    return word >> U64(16)


def tokens_of(texts: pa.Array) -> Tokens:
    words = words_of(texts)
    n, total = words.counts(), len(words.start)
    place = np.arange(total) + words.text  # each text so far has one end
    word, text = np.full(total + len(n), _END, U64), np.repeat(np.arange(len(n)), n + 1)
    word[place] = words.hashes()
    # Every text but the first stands behind the end of another.
    return Tokens(word, context_of(np.concatenate([np.full(1, _END, U64), word])[: len(word)]), text)


def pairs_of(token: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (word, word before) of tokens, sorted: both, the pair of each token, and how often each occurs.

    ``token`` numbers words; a text begins behind the end of another.
    """
    size = int(token.max()) + 1
    key, of, times = np.unique(token * size + np.concatenate([[end], token[:-1]]), return_inverse=True, return_counts=True)
    return key // size, key % size, of, times


def stirling(discount: float, n: int = EXACT) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: [customers, tables]."""
    out = np.full((n + 1, n + 1), -np.inf)
    out[0, 0] = 0
    for m in range(n):
        t = np.arange(1, m + 2)
        with np.errstate(divide="ignore"):
            out[m + 1, 1 : m + 2] = np.logaddexp(out[m, : m + 1], out[m, 1 : m + 2] + np.log(np.maximum(m - discount * t, 0)))
    return out


class Draws:
    """Random numbers of dishes that depend on nothing but each dish's key."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.own = mix(keys), {}

    def random(self, n: int) -> np.ndarray:
        return (self.keys >> U64(11)).astype(np.float64) * 2.0**-53

    def binomial_of(self, rows: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        for r in rows:
            if r not in self.own:
                self.own[r] = np.random.default_rng(int(self.keys[r]))
        return np.array([self.own[r].binomial(a, b) for r, a, b in zip(rows, n, p, strict=True)], np.int64)


def seat(customers: np.ndarray, rate: np.ndarray, start: np.ndarray, discount: float, table: np.ndarray, rng: np.random.Generator | Draws) -> np.ndarray:
    """Tables per dish, sampled given its customers, the parent's probability ``rate`` and ``start``, the concentration
    plus discount times all other tables of the restaurant."""
    tables = np.minimum(customers, 1).astype(np.int64)
    first, uniform = np.minimum(customers, EXACT), rng.random(len(customers))
    order = np.argsort(first, kind="stable")
    bounds = np.searchsorted(first[order], np.arange(2, EXACT + 2))
    for n, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), 2):
        for piece in range(low, high, 20_000):
            rows = order[piece : min(piece + 20_000, high)]
            t = np.arange(1, n + 1)
            grow = np.cumsum(np.log(start[rows][:, None] + discount * (t - 1)), axis=1)
            weight = table[n, 1 : n + 1] + grow + t * np.log(rate[rows])[:, None]
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), axis=1)
            tables[rows] = 1 + (weight < uniform[rows][:, None] * weight[:, -1:]).sum(1)
    seated, many = np.full(len(customers), EXACT), np.flatnonzero(customers > EXACT)
    while len(many):
        step = np.minimum(customers[many] - seated[many], np.maximum(seated[many] // 4, 1))
        fresh = (start[many] + discount * tables[many]) * rate[many]
        chance = np.clip(fresh / (fresh + seated[many] - discount * tables[many]), 0, 1)
        tables[many] += rng.binomial_of(many, step, chance) if isinstance(rng, Draws) else rng.binomial(step, chance)
        seated[many] += step
        many = many[seated[many] < customers[many]]
    return tables


@dataclass
class Totals:
    """What a sweep leaves behind: customers and tables of the parent, and its customers and tables for each hot word."""

    parent_customers: int
    parent_tables: int
    hot_guests: np.ndarray
    hot_tables: np.ndarray


@dataclass
class Model:
    """Everything but the words: counts over all training tokens, discounts, the totals after each sweep, and of hot words
    the tokens and, for each kept sweep, the parent's customers and then its tables."""

    n_tokens: int
    n_words: int
    discount: float
    parent_discount: float
    totals: list[Totals]
    seed: int = 17
    hot: dict[str, np.ndarray] = field(default_factory=dict)

    def unknown(self) -> float:
        return UNKNOWN_SHARE if self.n_words else 1.0

    def known(self) -> float:
        """Each known word's share of the base distribution."""
        return (1 - self.unknown()) / max(1, self.n_words)

    def new_table(self, totals: Totals) -> float:
        """The probability that the parent's next customer gets a new table."""
        return (CONCENTRATION + self.parent_discount * totals.parent_tables) / (CONCENTRATION + totals.parent_customers)

    def parent(self, sweep: int, guests: np.ndarray, tables: np.ndarray, is_known: np.ndarray) -> np.ndarray:
        """The parent's probability of words after a sweep."""
        totals = self.totals[sweep + 1]
        base = np.where(is_known, self.known(), self.unknown())
        return np.maximum(guests - self.parent_discount * tables, 0) / (CONCENTRATION + totals.parent_customers) + self.new_table(totals) * base

    def seat_parent(self, sweep: int, guests: np.ndarray, tables: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """The parent's tables of words with ``guests`` customers, who had ``tables`` before."""
        start = CONCENTRATION + self.parent_discount * np.maximum(self.totals[sweep].parent_tables - tables, 0)
        draws = Draws(salt.astype(U64) ^ mix(np.array([self.seed * 1000 + sweep], U64)))
        return seat(guests, np.full(len(guests), self.known()), start, self.parent_discount, stirling(self.parent_discount), draws)


def salt_of(word: np.ndarray) -> np.ndarray:
    """What random numbers of a word follow from."""
    return word.astype(np.uint32)


@dataclass
class Seats:
    """Of one bucket: per word its salt, its place among the hot words (else -1) and its pairs seen once; the pairs seen more
    often, by word, with tokens; and per sweep the tables of these and the parent's tables of the words (0 for hot words).

    ``base`` has the tables at the start of each distinct context of these pairs, as all buckets have it."""

    salt: np.ndarray
    hot_at: np.ndarray
    singles: np.ndarray
    of: np.ndarray
    context: np.ndarray
    n: np.ndarray
    base: np.ndarray
    tables: list[np.ndarray]
    parents: list[np.ndarray]

    def guests(self, tables: np.ndarray) -> np.ndarray:
        """The parent's customers of each word that come from this bucket."""
        return self.singles + np.bincount(self.of, tables, len(self.singles)).astype(np.int64)

    def contexts(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct contexts, sorted, and which of them each pair has."""
        return np.unique(self.context, return_inverse=True)

    def added(self, tables: np.ndarray) -> np.ndarray:
        """Tables beyond the first of a pair, by distinct context."""
        contexts, at = self.contexts()
        return np.bincount(at, tables - 1, len(contexts)).astype(np.int64)

    def sweep(self, model: Model, k: int, told: np.ndarray) -> None:
        """Resample all tables; ``told`` has what all buckets have of the contexts: before the first sweep the tables, later
        the tables added to these."""
        if k == 0:
            self.base, told = told, np.zeros(len(told), np.int64)
        before, home, hot = model.totals[k], self.hot_at < 0, np.maximum(self.hot_at, 0)
        tables = self.tables[-1] if k else np.ones(len(self.n), np.int64)
        parent = self.parents[-1] if k else np.ones(len(self.salt), np.int64)
        guests = self.guests(tables)
        if len(before.hot_guests):
            guests, parent = np.where(home, guests, before.hot_guests[hot]), np.where(home, parent, before.hot_tables[hot])
        others = guests[self.of] - tables
        held = np.minimum(parent[self.of], others)
        rate = np.maximum(others - model.parent_discount * held, 0) / (CONCENTRATION + before.parent_customers) + model.new_table(before) * model.known()
        of_context = (self.base + told)[self.contexts()[1]]
        start = CONCENTRATION + model.discount * np.maximum(of_context - tables, 0)
        draws = Draws(self.salt[self.of].astype(U64) ^ mix(self.context + U64((model.seed * 1000 + k) << 48)))
        tables = seat(self.n, rate, start, model.discount, stirling(model.discount), draws)
        seated = np.zeros(len(self.salt), np.int64)
        seated[home] = model.seat_parent(k, self.guests(tables)[home], parent[home], self.salt[home])
        self.tables.append(tables)
        self.parents.append(seated)

    def packed(self) -> bytes:
        numbers = [x for pair in zip(self.tables, self.parents, strict=True) for x in pair]
        of = np.bincount(self.of, minlength=len(self.salt))
        return _pack(self.salt, _small(self.hot_at + 1), *map(_small, [self.singles, of]), *_split(self.context), *map(_small, [self.n, self.base, *numbers]))


@dataclass
class Dishes:
    """The words and pairs of one bucket with what was drawn: word, context and tokens of each pair, sorted."""

    word: np.ndarray
    context: np.ndarray
    n: np.ndarray
    seats: Seats

    def __post_init__(self) -> None:
        begin = segment_starts(self.word)
        self.of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(self.word))))

    def tables(self, k: int) -> np.ndarray:
        """Tables of each pair after a sweep."""
        tables = np.ones(len(self.n), np.int64)
        tables[self.n > 1] = self.seats.tables[k]
        return tables

    def sweeps(self, model: Model, bucket: int, upto: int) -> Iterator[tuple[Totals, np.ndarray, np.ndarray]]:
        """Per sweep, the totals, the tables of each pair, and the parent's probability of each word."""
        hot, seats = self.seats.hot_at >= 0, self.seats
        for k in range(upto):
            totals, guests, parent = model.totals[k + 1], seats.guests(seats.tables[k]), seats.parents[k].copy()
            guests[hot], parent[hot] = totals.hot_guests[seats.hot_at[hot]], totals.hot_tables[seats.hot_at[hot]]
            yield totals, self.tables(k), model.parent(k, guests, parent, np.ones(len(guests), bool))

    def predictive(self, model: Model, bucket: int) -> np.ndarray:
        """Averaged probability of each word of the bucket in a context without customers: [word, context]; hot words have a
        row of their own instead of a bucket."""
        if bucket == _HOT_ROW:
            known, numbers = model.hot["n"] > 0, model.hot["p"].T
            parts = [model.parent(k, numbers[i], numbers[len(_KEPT) + i], known)[known] for i, k in enumerate(_KEPT)]
        else:
            parts = [p[self.seats.hot_at < 0] for k, (_, _, p) in enumerate(self.sweeps(model, bucket, SWEEPS)) if k in _KEPT]
        return np.mean(parts, axis=0)[:, None]


def unknown_probability(model: Model) -> np.ndarray:
    """Averaged probability of the unknown word in a context without customers."""
    none = np.zeros(1)
    return np.mean([model.parent(k, none, none, none > 0) for k in _KEPT], axis=0)


# --- counting ---


def _bucket(word: np.ndarray, buckets: int) -> np.ndarray:
    return ((word >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<4sq", a.dtype.str.encode().ljust(4), a.nbytes) for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(a.tobytes() for a in arrays))


def _unpack(data: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(data)
    at, out = 1 + 12 * data[0], []
    for i in range(data[0]):
        kind, size = struct.unpack_from("<4sq", data, 1 + 12 * i)
        out.append(np.frombuffer(data, kind.decode().strip(), size // np.dtype(kind.decode().strip()).itemsize, at))
        at += size
    return out


def _split(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (context >> U64(16)).astype(np.uint32), context.astype(np.uint16)


def _join(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(U64) << U64(16) | low.astype(U64)


def _small(n: np.ndarray) -> np.ndarray:
    """The smallest unsigned type that holds the numbers."""
    return n.astype(np.min_scalar_type(int(n.max()) if len(n) else 0))


def _whole(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([x.astype(np.int64) for x in parts]) if parts else np.zeros(0, np.int64)


def _places(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, -1 where it isn't there."""
    if not len(among):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return np.where(among[at] == values, at, -1)


def _deal(word: np.ndarray, before: np.ndarray, home: np.ndarray, hot_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each pair, and their order by bucket, in which those of hot words come behind the others of a bucket.

    ``home``: bucket of each word; ``hot_at``: its place among the hot words, else -1.
    """
    is_hot = hot_at[word] >= 0
    bucket = np.where(is_hot, home[before], home[word])
    return bucket, np.argsort(bucket * 2 + is_hot, kind="stable")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[pa.RecordBatch, Tokens]]]:
    """Tokens of the texts, in blocks of bounded size; a longer text is a block of its own."""
    held, n_texts, n_tokens = [], 0, 0
    for batch in chunks(batches, "text"):
        for part in range(0, batch.num_rows, BLOCK_TEXTS):
            piece = batch.slice(part, BLOCK_TEXTS)
            tokens = tokens_of(column(piece, "text"))
            if held and (n_tokens + len(tokens.word) > BLOCK_TOKENS or n_texts + piece.num_rows > BLOCK_TEXTS):
                yield held
                held, n_texts, n_tokens = [], 0, 0
            held.append((piece, tokens))
            n_texts, n_tokens = n_texts + piece.num_rows, n_tokens + len(tokens.word)
    if held:
        yield held


def _words(block: list[tuple[pa.RecordBatch, Tokens]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of a block, sorted, and the number of each token's word."""
    return np.unique(np.concatenate([t.word for _, t in block]), return_inverse=True)


def _frequent(docs: DataFrame, text: str, share: float) -> tuple[np.ndarray, int]:
    """Words with at least ``share`` of all tokens, as far as they have half of that in a block, and the number of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, token = _words(block)
            n = np.bincount(token)
            often = n >= len(token) * share / 2
            yield pa.RecordBatch.from_arrays([pa.array([None, *words[often].view(np.int64).tolist()], pa.int64()), pa.array([len(token), *n[often].tolist()], pa.int64())], ["word", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"]: r["n"] for r in counted.orderBy(F.desc("n")).limit(2000).collect()}
    total = found.pop(None, 0)
    return np.sort(np.array([w for w, n in found.items() if n >= max(1, total * share)], np.int64).view(U64)), total


def _count(batches: Iterator[pa.RecordBatch], hot: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, counts): of each bucket the words, how many words came before each, and those with the number of times."""
    for block in _blocks(batches):
        words, token = _words(block)
        word, before, _, times = pairs_of(token, int(np.searchsorted(words, _END)))
        bucket, order = _deal(word, before, _bucket(words, buckets), _places(words, hot))
        word, before, times, bucket = word[order], before[order], times[order], bucket[order]
        bounds = np.searchsorted(bucket, np.arange(buckets + 1))
        found = [(b, _packed_pairs(words[word[i:j]], context_of(words[before[i:j]]), times[i:j])) for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if j > i]
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], ["bucket", "counts"])


def _packed_pairs(word: np.ndarray, context: np.ndarray, n: np.ndarray) -> bytes:
    begin = segment_starts(word)
    return _pack(word[begin], _small(np.diff(np.append(begin, len(word)))), *_split(context), _small(n))


def _read_pairs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, context and tokens of each pair."""
    words, contexts, counts = [np.zeros(0, U64)], [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for part in parts:
        word, k, high, low, n = _unpack(part)
        words.append(np.repeat(word, k))
        contexts.append(_join(high, low))
        counts.append(n.astype(np.int64))
    return np.concatenate(words), np.concatenate(contexts), np.concatenate(counts)


def _merge(hot: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """The pairs of one bucket from those of all blocks, with what the totals need."""

    def run(table: pa.Table) -> pa.Table:
        word, context, n = _read_pairs([x.as_py() for x in table["counts"]])
        order = np.lexsort((context, word))
        word, context, n = word[order], context[order], n[order]
        begin = segment_starts(word, context)
        word, context, n = word[begin], context[begin], np.add.reduceat(n, begin)
        begin = segment_starts(word)
        tokens, pairs = np.add.reduceat(n, begin), np.diff(np.append(begin, len(word)))
        hot_at = _places(word[begin], hot)
        home = hot_at < 0
        sums = [n.sum(), len(n), home.sum(), *[(x == k).sum() for x in (n, tokens[home]) for k in (1, 2)]]
        of_hot = [np.bincount(hot_at[~home], x[~home], len(hot)).astype(np.int64) for x in (tokens, pairs)]
        return pa.table({
            "bucket": table["bucket"].slice(0, 1), "counts": pa.array([_packed_pairs(word, context, n)], pa.binary()),
            "sums": pa.array([[int(x) for x in np.concatenate([sums, *of_hot])]], pa.list_(pa.int64())),
        })

    return run


def _sums(parts: DataFrame, n: int) -> np.ndarray:
    """Element-wise sums over buckets, formed by Spark."""
    rows = parts.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(n, np.int64)
    for r in rows:
        out[r["i"]] = r["x"]
    return out


def _discount(once: int, twice: int) -> float:
    return float(np.clip(once / (once + 2 * twice), 0.1, 0.95)) if once else 0.5


# --- sweeps ---


def _first_seats(hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word, context, n = _read_pairs([row["counts"]])
                begin = segment_starts(word)
                of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(word))))
                more = n > 1
                words = word[begin]
                seats = Seats(salt_of(words), _places(words, hot), np.bincount(of[~more], minlength=len(words)), of[more], context[more], n[more], np.zeros(0, np.int64), [], [])
                yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]], pa.int32()), pa.array([seats.packed()], pa.binary())], ["bucket", "counts"])

    return run


def _read_seats(parts: list[bytes]) -> Seats:
    """The seats of one bucket; of no part, or an empty one, none."""
    if not any(parts):
        none = np.zeros(0, np.int64)
        return Seats(none.astype(np.uint32), none, none, none, none.astype(U64), none, none, [none] * SWEEPS, [none] * SWEEPS)
    salt, hot_at, singles, k, high, low, n, base, *numbers = _unpack(parts[0])
    of = np.repeat(np.arange(len(salt)), k)
    hot_at, singles, n, base, *numbers = (x.astype(np.int64) for x in (hot_at, singles, n, base, *numbers))
    return Seats(salt, hot_at - 1, singles, of, _join(high, low), n, base, numbers[0::2], numbers[1::2])


def _read_counts(parts: list[bytes]) -> Dishes:
    """The dishes of one bucket, of its pairs and seats packed as one."""
    pairs, seats = ([x.tobytes()] for x in _unpack(parts[0])) if any(parts) else ([], [])
    return Dishes(*_read_pairs(pairs), _read_seats(seats))


def _pairs_and_seats(rows: pa.Table) -> pa.Table:
    by_kind = dict(zip(rows["kind"].to_pylist(), rows["data"].to_pylist(), strict=True))
    packed = _pack(*[np.frombuffer(by_kind[kind], np.uint8) for kind in (_PAIRS, _SEATS)])
    return pa.table({"bucket": rows["bucket"].slice(0, 1), "counts": pa.array([packed], pa.binary())})


def _sent(source: int, context: np.ndarray, numbers: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """Numbers of distinct contexts (sorted) to the buckets of those words."""
    bounds = np.searchsorted(_bucket(context << U64(16), buckets), np.arange(buckets + 1))
    rows = [(b, _pack(*_split(context[i:j]), *[_small(x[i:j]) for x in numbers])) for b, (i, j) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if j > i]
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([source] * len(rows), pa.int32()), pa.array([r for _, r in rows], pa.binary())], ["bucket", "part", "data"])


def _ask_tables(buckets: int):
    """Per distinct context of a bucket its pairs, which is its tables at the start, and whether the sum is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, context, n = _read_pairs([row["counts"]])
                order = np.argsort(context)
                context, n = context[order], n[order]
                begin = segment_starts(context)
                yield _sent(row["bucket"], context[begin], [np.diff(np.append(begin, len(n))), np.maximum.reduceat(n, begin) > 1], buckets)

    return run


def _ask_added(buckets: int, sweeps: range, answer: bool):
    """Per distinct context of a bucket the tables added in some sweeps, and, for an ``answer``, that the sum is wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                seats = _read_seats([row["counts"]])
                context = seats.contexts()[0]
                yield _sent(row["bucket"], context, [*[seats.added(seats.tables[k]) for k in sweeps], *[np.ones(len(context), np.int64)] * answer], buckets)

    return run


def _tell(table: pa.Table) -> pa.Table:
    """Sums per context over all buckets, and to each bucket the sums it wants, in the order of its contexts."""
    parts = [_unpack(x.as_py()) for x in table["data"]]
    contexts, of = np.unique(np.concatenate([_join(p[0], p[1]) for p in parts]), return_inverse=True)
    sums = np.bincount(of, _whole([p[2] for p in parts])).astype(np.int64)
    bounds = np.cumsum([0] + [len(p[0]) for p in parts])
    told = [_pack(_small(sums[of[i:j]][p[3] > 0])) for p, i, j in zip(parts, bounds[:-1], bounds[1:], strict=True)]
    here, n = table["bucket"][0].as_py(), len(parts) + 1
    return pa.table({
        "bucket": pa.array([here, *table["part"].to_pylist()], pa.int32()), "part": pa.array([here] * n, pa.int32()),
        "kind": pa.array([_CONTEXTS] + [_REPLY] * (n - 1), pa.int32()), "data": pa.array([_pack(*_split(contexts), _small(sums)), *told], pa.binary()),
    })


def _sweep(model: Model, k: int):
    def run(seats: pa.Table, told: pa.Table) -> pa.Table:
        found = _read_seats([seats["counts"][0].as_py()])
        told = told.sort_by("part")
        found.sweep(model, k, _whole([_unpack(x.as_py())[0] for x in told["data"]]))
        guests, hot = found.guests(found.tables[-1]), found.hot_at >= 0
        of_hot = np.bincount(found.hot_at[hot], guests[hot], len(model.hot["word"]))
        sums = [int(x) for x in (guests.sum(), found.parents[-1].sum(), *of_hot)]
        return pa.table({"bucket": seats["bucket"].slice(0, 1), "counts": pa.array([found.packed()], pa.binary()), "sums": pa.array([sums], pa.list_(pa.int64()))})

    return run


@dataclass
class Learned:
    """The model, and all that scoring needs of a bucket (bucket, kind, data)."""

    model: Model
    known: DataFrame


def learn(docs: DataFrame, staging: Staging, hot: np.ndarray, buckets: int, text: str = "text") -> Learned:
    """Learn from every text of ``docs``; a null text is empty, that is, one end.

    Discounts follow from the numbers of dishes seen once and twice. Counting shuffles packed pairs of blocks of texts by
    bucket. A sweep shuffles what is drawn, pairs seen more than once, and their contexts.
    """
    blocks = docs.select(F.col(text).alias("text")).mapInArrow(lambda b: _count(b, hot, buckets), "bucket int, counts binary")
    pairs = staging.write(blocks.groupBy("bucket").applyInArrow(_merge(hot), "bucket int, counts binary, sums array<bigint>"), "pairs")
    sums = _sums(pairs, 7 + 2 * len(hot))
    n_tokens, n_pairs, n_words, *few = (int(x) for x in sums[:7])
    hot_tokens, hot_guests = sums[7 : 7 + len(hot)], sums[7 + len(hot) :]
    few[2:] = [few[2] + int((hot_tokens == 1).sum()), few[3] + int((hot_tokens == 2).sum())]
    n_words += int((hot_tokens > 0).sum())
    model = Model(n_tokens, n_words, _discount(few[0], few[1]), _discount(few[2], few[3]), [Totals(n_pairs, n_words, hot_guests, np.minimum(hot_guests, 1))])
    model.hot = {"word": hot, "n": hot_tokens, "p": np.zeros((len(hot), 0))}
    message, sent = "bucket int, part int, kind int, data binary", "bucket int, part int, data binary"
    contexts = staging.write(pairs.select("bucket", "counts").mapInArrow(_ask_tables(buckets), sent).groupBy("bucket").applyInArrow(_tell, message), "contexts")
    told = contexts.where(F.col("kind") == _REPLY)
    seats = pairs.select("bucket", "counts").mapInArrow(_first_seats(hot), "bucket int, counts binary")
    for k in range(SWEEPS):
        drawn = seats.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_sweep(model, k), "bucket int, counts binary, sums array<bigint>")
        written = staging.write(drawn, f"seats-{k}")
        customers, tables, *hot_guests = _sums(written, 2 + len(hot))
        hot_guests = np.array(hot_guests, np.int64)
        hot_tables = model.seat_parent(k, hot_guests, model.totals[-1].hot_tables, salt_of(hot))
        model.totals.append(Totals(int(customers), int(tables + hot_tables.sum()), hot_guests, hot_tables))
        seats = written.select("bucket", "counts")
        if k + 1 < SWEEPS:
            asked = seats.mapInArrow(_ask_added(buckets, range(k, k + 1), True), sent)
            told = asked.groupBy("bucket").applyInArrow(_tell, message).where(F.col("kind") == _REPLY)
    kept = [model.totals[k + 1] for k in _KEPT]
    model.hot["p"] = np.stack([*[t.hot_guests for t in kept], *[t.hot_tables for t in kept]], axis=1)

    def rows(table: DataFrame, kind: int, data: str) -> DataFrame:
        return table.select("bucket", F.lit(kind).alias("kind"), F.col(data).alias("data"))

    added = seats.mapInArrow(_ask_added(buckets, _KEPT, False), sent)
    known = [rows(pairs, _PAIRS, "counts"), rows(seats, _SEATS, "counts"), rows(contexts.where(F.col("kind") == _CONTEXTS), _CONTEXTS, "data"), rows(added, _ADDED, "data")]
    return Learned(model, reduce(DataFrame.unionByName, known))


def train(docs: DataFrame, staging: Staging, buckets: int, text: str = "text") -> tuple[Model, DataFrame]:
    """The model and (bucket, counts), the dishes of each bucket, from every text of ``docs``; hot words have a row of their own."""
    hot, _ = _frequent(docs, text, HOT_SHARE)
    learned = learn(docs, staging, hot, buckets, text)
    counts = learned.known.where(F.col("kind").isin(_PAIRS, _SEATS)).groupBy("bucket").applyInArrow(_pairs_and_seats, "bucket int, counts binary")
    hot_row = docs.sparkSession.createDataFrame([(_HOT_ROW, b"")], "bucket int, counts binary")
    return learned.model, counts.unionByName(hot_row) if len(hot) else counts


# --- scoring ---


def _ask(batches: Iterator[pa.RecordBatch], model: Model, buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: a head with ids and tokens, and per bucket the words and pairs that are asked for."""
    context_of_task = TaskContext.get()
    task, hot = context_of_task.partitionId() if context_of_task else 0, model.hot["word"]
    for n_block, held in enumerate(_blocks(batches)):
        # Named by the task's place and a running number: a task that runs again gives the same names.
        block = hashlib.blake2b(f"{task}:{n_block}".encode(), digest_size=16).digest()
        size = np.concatenate([np.bincount(t.text, minlength=b.num_rows) for b, t in held])
        words, token = _words(held)
        end, hot_at, home = int(np.searchsorted(words, _END)), _places(words, hot), _bucket(words, buckets)
        word, before, _, _ = pairs_of(token, end)
        bucket, order = _deal(word, before, home, hot_at)
        word, before, bucket = word[order], before[order], bucket[order]
        of_words, of_pairs = (np.searchsorted(x, np.arange(buckets + 1)) for x in (home, bucket))
        rows = []
        for b, (i, j, p, q) in enumerate(zip(of_words[:-1], of_words[1:], of_pairs[:-1], of_pairs[1:], strict=True)):
            if j > i or q > p:
                at = hot_at[word[p:q]]
                times = np.bincount(word[p:q][at < 0] - i, minlength=j - i)
                rows.append((b, _pack(words[i:j], _small(times), _small(at[at >= 0]), *_split(context_of(words[before[p:q]])))))
        hot_words = np.flatnonzero(hot_at >= 0)
        ids = pa.concat_arrays([column(b, "doc_id") for b, _ in held])
        held_out = np.concatenate([column(b, "held_out").to_numpy(zero_copy_only=False) for b, _ in held]).astype(np.uint8)
        head = _pack(held_out, size, _small(token), np.array([end]), hot_words, hot_at[hot_words])
        n = len(rows) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block] * n, pa.binary()), pa.array([int.from_bytes(block[:4], "little") % buckets] + [b for b, _ in rows], pa.int32()),
                pa.array([None] + [r for _, r in rows], pa.binary()), pa.array([head] + [None] * (n - 1), pa.binary()),
                pa.ListArray.from_arrays(pa.array([0] + [len(ids)] * n, pa.int32()), ids),
            ],
            ["block", "bucket", "words", "head", "ids"],
        )


def _pair_id(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix(word ^ mix(context))


class _Bucket:
    """What is known of the words and pairs of one bucket, looked up by hash."""

    def __init__(self, known: pa.Table):
        rows: dict[int, list[bytes]] = {}
        for kind, data in zip(known["kind"].to_pylist(), known["data"].to_pylist(), strict=True):
            rows.setdefault(kind, []).append(data)
        word, context, n = _read_pairs(rows.get(_PAIRS, []))
        begin = segment_starts(word)
        seats = _read_seats(rows.get(_SEATS, []))
        dishes = Dishes(word, context, n, seats)
        self.words, self.tokens = word[begin], np.add.reduceat(n, begin) if len(begin) else n
        self.of_word = [self.tokens, *[seats.guests(seats.tables[k]) for k in _KEPT], *[seats.parents[k] for k in _KEPT]]
        of_pair = [n, *[dishes.tables(k) for k in _KEPT]]
        ids = _pair_id(word, context)
        order = np.argsort(ids)
        self.pairs, self.of_pair = ids[order], [x[order] for x in of_pair]
        contexts = [_unpack(x) for x in rows.get(_CONTEXTS, [])]
        self.contexts = np.concatenate([np.zeros(0, U64), *[_join(c[0], c[1]) for c in contexts]])
        self.of_context = [_whole([c[2] for c in contexts]) for _ in _KEPT]
        for high, low, *numbers in map(_unpack, rows.get(_ADDED, [])):
            at = np.searchsorted(self.contexts, _join(high, low))
            for tables, more in zip(self.of_context, numbers, strict=True):
                tables[at] += more

    @staticmethod
    def _found(at: np.ndarray, numbers: list[np.ndarray]) -> list[np.ndarray]:
        return [np.where(at >= 0, x[np.maximum(at, 0)], 0) if len(x) else np.zeros(len(at), np.int64) for x in numbers]

    def answer(self, words: np.ndarray, pair_word: np.ndarray, pair_context: np.ndarray) -> list[np.ndarray]:
        """Tokens, the parent's customers and tables of words, their tables as contexts, and tokens and tables of pairs."""
        of_word = self._found(_places(words, self.words), self.of_word)
        of_context = self._found(_places(context_of(words), self.contexts), self.of_context)
        return [*of_word, *of_context, *self._found(_places(_pair_id(pair_word, pair_context), self.pairs), self.of_pair)]


def _answer(model: Model):
    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        heads = asked.filter(pc.is_valid(asked["head"])).select(["block", "head", "ids"])
        blocks = asked.filter(pc.is_valid(asked["words"]))
        out_block, out_part, out = [], [], []
        if blocks.num_rows:
            bucket = _Bucket(known)
            for block, part, packed in zip(blocks["block"], blocks["bucket"], blocks["words"], strict=True):
                words, times, hot, high, low = _unpack(packed.as_py())
                pair_word = np.concatenate([np.repeat(words, times), model.hot["word"][hot]])
                out_block.append(block.as_py())
                out_part.append(part.as_py())
                out.append(_pack(*map(_small, bucket.answer(words, pair_word, _join(high, low)))))
        n = len(out)
        return pa.table({
            "block": pa.array(heads["block"].to_pylist() + out_block, pa.binary()), "part": pa.array([None] * heads.num_rows + out_part, pa.int32()),
            "head": pa.array(heads["head"].to_pylist() + [None] * n, pa.binary()),
            "ids": pa.concat_arrays([*heads["ids"].chunks, pa.nulls(n, asked.schema.field("ids").type)]), "answer": pa.array([None] * heads.num_rows + out, pa.binary()),
        })

    return run


def _collect(model: Model):
    def run(table: pa.Table) -> pa.Table:
        heads = table.filter(pc.is_valid(table["head"]))
        answers = table.filter(pc.is_valid(table["answer"])).sort_by("part")
        held_out, size, token, (end,), hot_words, hot_index = _unpack(heads["head"][0].as_py())
        token, kept = token.astype(np.int64), len(_KEPT)
        parts = [_unpack(x.as_py()) for x in answers["answer"]]
        n, *numbers = (_whole([p[i] for p in parts]) for i in range(1 + 3 * kept))
        of_pair = [_whole([p[i] for p in parts]) for i in range(1 + 3 * kept, 2 + 4 * kept)]
        home = np.repeat(answers["part"].to_numpy(), [len(p[0]) for p in parts])
        hot_at = np.full(len(n), -1)
        hot_at[hot_words] = hot_index
        # Hot words are dealt over many buckets, so their own doesn't know them as words.
        n[hot_words] = model.hot["n"][hot_index]
        for i in range(2 * kept):
            numbers[i][hot_words] = model.hot["p"][hot_index, i]
        word, before, of, _ = pairs_of(token, int(end))
        order = _deal(word, before, home, hot_at)[1]
        probability = np.zeros(len(word))
        for i, k in enumerate(_KEPT):
            parent = model.parent(k, numbers[i], numbers[kept + i], n > 0)
            seen = np.zeros(len(word))
            seen[order] = np.maximum(of_pair[0] - model.discount * of_pair[1 + i], 0)
            open_to_parent = CONCENTRATION + model.discount * numbers[2 * kept + i][before]
            probability += (seen + open_to_parent * parent[word]) / (CONCENTRATION + n[before]) / kept
        text = np.repeat(np.arange(len(size)), size)

        def total(x: np.ndarray) -> np.ndarray:
            return np.bincount(text, x, len(size))

        base = np.log10((n + 1) / (model.n_tokens + model.n_words + 1))
        return pa.table({
            "doc_id": pa.concat_arrays([x.values.slice(x.offsets[0].as_py(), len(size)) for x in heads["ids"].chunks if len(x)]), "held_out": pa.array(held_out.astype(bool)), "n_tokens": pa.array(size, pa.int64()),
            "n_known": pa.array(total(n[token] > 0).astype(np.int64)), "train_tokens": pa.array(np.full(len(size), model.n_tokens)),
            "base_score": pa.array(total(base[token])), "score": pa.array(total(np.log10(probability)[of])),
        })

    return run


def score(docs: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Trains on the rows that are not held out, and scores all whole texts: ``score`` is the model's log10 probability of the
    words and the end, ``base_score`` that of add-one smoothed counts. A null text is empty and has the end only. Without
    training rows every token is unknown and has probability 1. Equal texts score alike; repeated rows stay, and
    count in training as often as they are there. ``buckets`` (default: the session's shuffle partitions, more where those
    had too many tokens) changes no result. Rows must come in the same order when a task runs again, as they do from a table.
    """
    spark = docs.sparkSession
    staging = Staging(spark)
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    hot, n_tokens = _frequent(picked, "text", HOT_SHARE)
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // BUCKET_TOKENS))
    learned = learn(picked.where(~F.col("held_out")), staging, hot, buckets)
    model, kind = learned.model, picked.schema["doc_id"].dataType.simpleString()
    asked = picked.mapInArrow(lambda b: _ask(b, model, buckets), f"block binary, bucket int, words binary, head binary, ids array<{kind}>")
    answered = learned.known.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answer(model), f"block binary, part int, head binary, ids array<{kind}>, answer binary")
    schema = f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return answered.groupBy("block").applyInArrow(_collect(model), schema)
