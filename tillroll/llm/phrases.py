"""Collocations: frequent phrases that stick together, found by Rabin-Karp fingerprints of all n-grams.

A word's hash and an n-gram's fingerprint are differences of prefix polynomials, over bytes and over word hashes, modulo
2**64, so numpy hashes every n-gram of a batch at once. Per n-gram only a fingerprint, a count, a pointer to one occurrence and
a check are shuffled. An n-gram is counted only if its parts of one word less may be frequent, by a bitmap of bounded size that
lets no frequent one slip.

The texts of the frequent fingerprints are then read at their pointers, in one more scan. Fingerprints under which two checks
were seen are collisions: all their occurrences are counted again by text. From there on everything goes by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.words import U64, byte_class, chunks, column, mix, segment_starts, stream, words_of
from tillroll.operators.staging import Staging

# What ends a piece, what stands between words, and the name of no language.
PIECE_END = ".,;:!?\n-\r"
WORD_GAP = " \t"
NO_LANGUAGE = "und"

# n-grams that a task gathers before it adds equal ones up.
LOT = 1 << 20
# Bits of a filter per entry, and at most; a filter that is full only lets more through.
FILTER_BITS = 16
MOST_BITS = 1 << 28
# Rows that a step of the ranking sorts together.
RANK_ROWS = 50_000
# Values that a polynomial is summed over at once.
_SPAN = 1 << 20

_ENDS = byte_class(PIECE_END)
_WORD = ~(_ENDS | byte_class(WORD_GAP))
# Odd bases of the polynomials, for fingerprints and for checks, with the values that stand for bytes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BYTES = (stream(11, 256), stream(12, 256))
_PROBES = tuple(U64(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
# A pointer: upper bits of the text's hash, and the number of the first word in it; a text has fewer words than that.
_WORD_BITS = U64(30)

_LOTS = "fp bigint, seen bigint, pointer bigint, low smallint, high smallint"


class _Polynomial:
    """Sums of value times power of a base over spans, whatever stands before the span."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, U64)

    def over(self, values: np.ndarray, first: np.ndarray, last: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """Per span [first, last) of ``values``, or of what ``table`` has for them; spans come in order of both ends."""
        out, at = np.empty(len(first), U64), 0
        while at < len(out):
            low = int(first[at])
            to = max(at + 1, int(np.searchsorted(last, low + _SPAN, "right")))
            high = int(last[to - 1])
            if len(self.up) < high - low + 1:
                size = max(high - low + 1, _SPAN + 1)
                self.up, self.down = (
                    np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, b, U64)]), dtype=U64) for b in (self.base, self.inverse))
            sums = np.zeros(high - low + 1, U64)
            own = values[low:high] if table is None else table[values[low:high]]
            np.cumsum(own * self.up[: high - low], out=sums[1:])
            s, e = first[at:to] - low, last[at:to] - low
            out[at:to] = (sums[e] - sums[s]) * self.down[s]
            at = to
        return out


_POLYNOMIALS = tuple(map(_Polynomial, _BASES))


@dataclass
class Filter:
    """A Bloom filter: may say yes to what was not put in, never no to what was."""

    bits: np.ndarray | None

    def has(self, keys: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.zeros(len(keys), bool)
        yes, mask = np.ones(len(keys), bool), U64(len(self.bits) * 8 - 1)
        for probe in _PROBES:
            at = mix(keys ^ probe) & mask
            yes &= (self.bits[at >> U64(3)] >> (at & U64(7)).astype(np.uint8)) & 1 == 1
        return yes


def _filter_of(keys: DataFrame, name: str, n: int) -> Filter:
    """From a column of 64-bit keys. Tasks set the bits; the driver gets the bits alone, at most MOST_BITS of them."""
    if n == 0:
        return Filter(None)
    size = min(MOST_BITS, 1 << max(16, (FILTER_BITS * n - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = column(batch, "key").to_numpy(zero_copy_only=False).astype(np.int64).view(U64)
            for probe in _PROBES:
                at = mix(own ^ probe) & U64(size - 1)
                yield pa.record_batch([pa.array(at.astype(np.int64) + 1)], ["place"])

    placed = keys.select(F.col(name).alias("key")).mapInArrow(places, "place bigint")
    pieces = placed.groupBy(F.expr("bitmap_bucket_number(place)").alias("piece")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    table = pieces.toArrow()
    bits = np.zeros(size // 8, np.uint8)
    for piece, own in zip(table.column("piece").to_pylist(), table.column("bits").to_pylist()):
        part = np.frombuffer(own, np.uint8)[: size // 8]
        bits[(piece - 1) * 4096 : (piece - 1) * 4096 + len(part)] = part
    return Filter(bits)


@dataclass
class Grams:
    """Words of a batch of texts, and fingerprints of the n-grams at each of them."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    # Whether a word goes on with the piece of the word before.
    joined: np.ndarray
    hashes: tuple[np.ndarray, np.ndarray]
    language: np.ndarray
    # Pointers of n-grams that begin with the word.
    pointer: np.ndarray
    width: int

    def at(self, size: int) -> np.ndarray:
        """First words of all n-grams of this size."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        whole = np.ones(n, bool)
        for k in range(1, size):
            whole &= self.joined[k : k + n]
        return np.flatnonzero(whole)

    def fingerprints(self, size: int, first: np.ndarray) -> np.ndarray:
        own = mix(_POLYNOMIALS[0].over(self.hashes[0], first, first + size) + U64(size)) ^ self.language[self.text[first]]
        return mix(own) >> U64(64 - self.width)

    def checks(self, size: int, first: np.ndarray) -> np.ndarray:
        return (mix(_POLYNOMIALS[1].over(self.hashes[1], first, first + size)) >> U64(48)).astype(np.uint16).view(np.int16)

    def phrase(self, size: int, first: int) -> str:
        words = [self.data[self.start[i] : self.end[i]].tobytes() for i in range(first, first + size)]
        return b" ".join(words).decode("utf-8", "replace")


def grams_of(batch: pa.RecordBatch, width: int) -> Grams:
    words = words_of(column(batch, "text"), _WORD)
    n_ends = np.concatenate([[0], np.cumsum(_ENDS[words.data], dtype=np.int64)])
    joined = np.zeros(len(words.start), bool)
    joined[1:] = (words.text[1:] == words.text[:-1]) & (n_ends[words.start[1:]] == n_ends[words.end[:-1]])
    hashes = tuple(
        mix(p.over(words.data, words.start, words.end, table) + (words.end - words.start).astype(U64)) for p, table in zip(_POLYNOMIALS, _BYTES))
    longs = {c: column(batch, c).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for c in ("document", "language")}
    place = (np.arange(len(words.start)) - words.firsts()[words.text]).astype(U64)
    pointer = ((longs["document"] >> _WORD_BITS) << _WORD_BITS)[words.text] | place
    return Grams(words.data, words.start, words.end, words.text, joined, hashes, longs["language"], pointer, width)


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, Grams]]:
    for batch in chunks(batches, "text"):
        yield batch, grams_of(batch, width)


def _add_up(lots: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row per fingerprint: how often, the least pointer, least and greatest check."""
    fp, pointer, check = (np.concatenate(x) for x in zip(*lots))
    order = np.argsort(fp)
    fp, pointer, check = fp[order], pointer[order].view(np.int64), check[order]
    starts = segment_starts(fp)
    if not len(starts):
        return pa.RecordBatch.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16())], _names(_LOTS))
    seen = np.diff(np.append(starts, len(fp)))
    return pa.record_batch(
        [fp[starts].view(np.int64), seen, np.minimum.reduceat(pointer, starts), np.minimum.reduceat(check, starts), np.maximum.reduceat(check, starts)],
        _names(_LOTS))


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def count_grams(texts: DataFrame, size: int, parts: Filter | None, width: int) -> DataFrame:
    """(fp, f, pointer, low, high) of n-grams of one size, all whose parts of one word less pass ``parts``."""

    def lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for _, grams in _batches(batches, width):
            first = grams.at(size)
            if parts is not None and len(first):
                shorter = grams.at(size - 1)
                known = np.zeros(len(grams.start) + 1, bool)
                known[shorter[parts.has(grams.fingerprints(size - 1, shorter))]] = True
                first = first[known[first] & known[first + 1]]
            held.append((grams.fingerprints(size, first), grams.pointer[first], grams.checks(size, first)))
            n += len(first)
            if n >= LOT:
                yield _add_up(held)
                held, n = [], 0
        if held:
            yield _add_up(held)

    # Equal fingerprints have met within a task already; Spark adds up behind the shuffle only.
    dealt = texts.mapInArrow(lots, _LOTS).repartition("fp")
    return dealt.groupBy("fp").agg(F.sum("seen").alias("f"), F.min("pointer").alias("pointer"), F.min("low").alias("low"), F.max("high").alias("high"))


def _spot(fp: np.ndarray, pointer: np.ndarray) -> np.ndarray:
    return mix(fp ^ mix(pointer))


def read_phrases(texts: DataFrame, longest: int, spots: Filter, collided: Filter, width: int) -> DataFrame:
    """(lang, size, fp, pointer, phrase, seen): texts at the pointers that ``spots`` has; every occurrence of a fingerprint in
    ``collided``, without a pointer; and with size 0 the words of each language."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch, grams in _batches(batches, width):
            lang, rows = column(batch, "lang").to_pylist(), []
            for text, n in enumerate(np.bincount(grams.text, minlength=len(lang)).tolist()):
                if n:
                    totals[lang[text]] = totals.get(lang[text], 0) + n
            for size in range(1, longest + 1):
                first = grams.at(size)
                fp = grams.fingerprints(size, first)
                again = collided.has(fp)
                at = np.flatnonzero(spots.has(_spot(fp, grams.pointer[first])) & ~again)
                # Copies of a text have equal pointers; one of them in a batch is enough.
                _, one = np.unique(_spot(fp[at], grams.pointer[first[at]]), return_index=True)
                fps, pointers = fp.view(np.int64), grams.pointer.view(np.int64)
                for i in at[one].tolist():
                    rows.append((lang[grams.text[first[i]]], size, int(fps[i]), int(pointers[first[i]]), grams.phrase(size, first[i]), 1))
                for i in np.flatnonzero(again).tolist():
                    rows.append((lang[grams.text[first[i]]], size, int(fps[i]), None, grams.phrase(size, first[i]), 1))
            if rows:
                yield _phrase_batch(rows)
        if totals:
            yield _phrase_batch([(lang, 0, 0, None, "", n) for lang, n in totals.items()])

    return texts.mapInArrow(read, "lang string, size int, fp bigint, pointer bigint, phrase string, seen bigint")


def _phrase_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["lang", "size", "fp", "pointer", "phrase", "seen"])


def _spot_keys(chosen: DataFrame) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, pointer = (column(batch, c).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) for c in ("fp", "pointer"))
            yield pa.record_batch([_spot(fp, pointer).view(np.int64)], ["key"])

    return chosen.select("fp", "pointer").mapInArrow(keys, "key bigint")


def frequent_phrases(docs: DataFrame, longest: int, least: int, staging: Staging, width: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of all phrases of up to ``longest`` words that occur ``least`` times in texts of their language,
    and (lang, n), the words of each language; both written. ``width`` is the number of bits of a fingerprint."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    texts = docs.select("text", lang.alias("lang"), F.xxhash64("text").alias("document"), F.xxhash64(lang).alias("language"))
    parts, found = None, []
    for size in range(1, longest + 1):
        frequent = staging.write(count_grams(texts.drop("lang"), size, parts, width).where(F.col("f") >= least), f"grams-{size}")
        found.append(frequent.withColumn("size", F.lit(size)))
        n = frequent.count()
        if n == 0:
            break
        if size < longest:
            parts = _filter_of(frequent, "fp", n)
    found = reduce(DataFrame.unionByName, found)
    alone = found.where("low = high")
    twice = found.where("low <> high")
    collided = _filter_of(twice, "fp", twice.count())
    spots = _filter_of(_spot_keys(alone), "key", alone.count())
    read = staging.write(read_phrases(texts, longest, spots, collided, width), "read")
    names = read.select("fp", "pointer", "lang", "size", "phrase").distinct().join(
        alone.select("fp", "pointer", "size", "f"), ["fp", "pointer", "size"])
    again = read.where("pointer IS NULL AND size > 0").groupBy("lang", "size", "phrase").agg(F.sum("seen").alias("f")).where(F.col("f") >= least)
    columns = ["lang", "size", "phrase", "f"]
    # A fingerprint that only looks collided, by the filter, is counted again as well; it then has no row from its pointer.
    phrases = staging.write(names.select(*columns).unionByName(again.select(*columns)), "phrases")
    totals = staging.write(read.where("size = 0").groupBy("lang").agg(F.sum("seen").alias("n")), "totals")
    return phrases, totals


def _joined_words(words: Column, first: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, first, n), " ")


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, size, phrase, a, l, r, score) of phrases of two words and more, by their lowest-scoring cut."""
    many = phrases.where("size >= 2").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words"))
    cuts = many.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "size", "phrase", "a", "k", _joined_words(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _joined_words(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, f in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(f)), ["lang", side])
    score = F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    lowest = cuts.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def without_parts(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates, but those whose words stand in a longer one with at least ``percent`` of their occurrences."""
    words, size = F.split("phrase", " ", -1), F.col("size")
    longer = candidates.where("size >= 3").select("lang", F.col("a").alias("longer"), words.alias("words"), "size")
    starts = longer.select("*", F.explode(F.sequence(F.lit(2), size - 1)).alias("n")).select(
        "*", F.explode(F.sequence(F.lit(1), size - F.col("n") + 1)).alias("at"))
    inside = starts.select("lang", "longer", _joined_words(F.col("words"), F.col("at"), F.col("n")).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left")
    return kept.where(~F.coalesce(100 * F.col("longer").cast("decimal(20,0)") >= percent * F.col("a").cast("decimal(20,0)"), F.lit(False))).drop("longer")


def first_rows(rows: DataFrame, group: str, order: list[Column], limit: int, total: int, spread: Column) -> DataFrame:
    """The first rows of each group, with their ``rank``. Buckets of a group hand on their own first rows, round by round, so
    that no task sorts more than a bounded number of rows."""
    buckets = -(-total // RANK_ROWS)
    while buckets > 1:
        window = Window.partitionBy(group, F.pmod(spread, F.lit(buckets))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= limit).drop("rank")
        buckets = -(-buckets * limit // RANK_ROWS) if limit < RANK_ROWS else 1
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= limit)


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, limit: int = 2000, staging: Staging | None = None, width: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) from documents (text, lang), for each language its best phrases.

    Words are lower-cased in A-Z, stand between spaces and tabs, and phrases do not pass ends of pieces. A phrase of 2 to
    ``longest`` words with ``a`` >= ``least`` occurrences is cut where 1000000 * a * a / (l * r), rounded down, is least (the
    first such place); ``l`` and ``r`` are the occurrences of the two sides, ``n`` the words of the language. Phrases within a
    longer one that has ``percent`` of their occurrences go. Ranks go by score, ``a``, and the phrase's bytes.

    A null text has no words, a null language is ``und``; repeated rows count as often as they come; other columns are ignored. A
    table without frequent phrases gives no rows. Counts are exact: a fingerprint under which two of 65,536 checks were seen is
    counted by text. A row is never cut; arrays beside a text take some thirty times its bytes.
    """
    staging = staging or Staging(docs.sparkSession)
    phrases, totals = frequent_phrases(docs, longest, least, staging, width)
    candidates = staging.write(scored(phrases), "scored")
    kept = staging.write(without_parts(candidates, percent), "kept")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = first_rows(kept, "lang", order, limit, kept.count(), F.xxhash64("phrase"))
    counts = totals.select("lang", "n")
    return best.join(counts, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
