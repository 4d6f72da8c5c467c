"""Quality rules: counts over words and lines, and divergence from what a language usually looks like.

Two histograms of a document are compared with those of all documents of its language by Jensen-Shannon distance: one
over character classes, one over the language's commonest words and all others. A text below the minimum length
of a test, or without a language, isn't put to it. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.words import fresh
from tillroll.operators.staging import Staging

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
# Everything but the characters of a class; the last class is what none of them names.
CLASSES = {"upper": r"[^A-Z]+", "digits": r"[^0-9]+", "symbols": SYMBOLS, "marks": r"[^.,;:!?'\"()-]+", "beyond_ascii": r"[\x00-\x7F]+"}


@dataclass(frozen=True)
class Rules:
    """Limits; the lengths are in words."""

    least_words: int = 50
    most_repeated: float = 0.5
    class_words: int = 50
    word_words: int = 100
    most_class_distance: float = 0.35
    most_word_distance: float = 0.28
    common_words: int = 12
    # Languages with at least this share of all documents, so at most a thousand, are never dealt out by language.
    hot_share: float = 0.001
    # References up to this size in all are broadcast.
    broadcast_bytes: int = 8 << 20


RULES = Rules()


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used inside lambdas."""
    return F.element_at(F.transform(F.array(value), then), 1)


def characters(text: Column, others: str) -> Column:
    """How many characters are left once ``others`` are removed."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the text, the first time included."""

    def covered(hashes: Column) -> Column:
        return let(F.sort_array(hashes), lambda s: let(F.array_distinct(F.filter(s, lambda h, i: h == F.get(s, i + 1))), lambda twice: count(hashes, twice)))

    def count(hashes: Column, twice: Column) -> Column:
        few = lambda: F.filter(F.transform(hashes, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())
        many = lambda: places(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        return F.when(F.size(twice) == 0, 0).when(F.size(twice) <= 32, union(few())).otherwise(union(many()))

    def places(pairs: Column) -> Column:
        """Sorted (hash, place) pairs to the places of hashes that a neighbour shares, in order."""
        shared = lambda s: F.filter(s, lambda p, i: (p["h"] == F.get(s, i - 1)["h"]) | (p["h"] == F.get(s, i + 1)["h"]))
        return let(pairs, lambda s: F.sort_array(F.transform(shared(s), lambda p: p["i"])))

    def union(starts: Column) -> Column:
        gap = lambda s: F.transform(s, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - x, F.lit(3))))
        return let(starts, lambda s: F.aggregate(gap(s), F.lit(0), lambda a, x: a + x))

    windows = let(words, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    return F.when(F.size(words) < 3, 0).otherwise(let(windows, covered)).cast("long")


def measures(docs: DataFrame, text: str, lang: str, m: str, rules: Rules) -> DataFrame:
    """``docs`` with a struct column ``m`` of the counts of its texts; a null text counts as empty."""
    body, w, lines = F.coalesce(F.col(text), F.lit("")), f"{m}_w", f"{m}_l"
    classes = [characters(body, others) for others in CLASSES.values()]
    split = docs.withColumns({
        w: F.array_remove(F.split(body, SPACE), ""), lines: F.filter(F.split(body, "\n", -1), lambda x: x.rlike(NOT_SPACE)),
        m: F.struct(F.length(body).cast("long").alias("n_chars"), characters(body, SPACE).alias("word_chars"), *[c.alias(k) for k, c in zip(CLASSES, classes, strict=True)]),
    })
    counted = split.withColumn(m, F.struct(
        f"{m}.*", F.size(w).cast("long").alias("n_words"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col(w)).alias("n_repeat_words"), F.transform(F.col(w), lambda x: F.lower(x)).alias("words"),
    ))
    return counted.drop(w, lines)


def class_counts(m: str) -> Column:
    named = [F.col(f"{m}.{k}") for k in CLASSES]
    spaces = F.col(f"{m}.n_chars") - F.col(f"{m}.word_chars")
    return F.array(*named, spaces, F.col(f"{m}.n_chars") - spaces - sum(named[1:], named[0]))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", rules: Rules = RULES) -> DataFrame:
    """Per language: lang, hot, class_share, words (the commonest), word_share (theirs, then of all others).

    Computed over all documents that have a language, for every language with a word; ``hot`` languages have at least
    ``Rules.hot_share`` of all documents.
    """
    staging = Staging(docs.sparkSession)
    slim = docs.select(F.col(lang).cast("string").alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    sizes = staging.write(slim.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(F.length("body").cast("long")).alias("n_chars")), "sizes")
    all_docs = sizes.agg(F.coalesce(F.sum("n_docs"), F.lit(0))).first()[0]
    # Words as they are written, counted: classes are then looked at once per distinct word instead of in every text.
    words = slim.where(F.col("lang").isNotNull()).select("lang", F.explode(F.split("body", SPACE)).alias("word")).where(F.col("word") != "")
    table = staging.write(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    times = lambda each, name: F.sum(F.col("n") * each).alias(name)
    sums = table.groupBy("lang").agg(
        F.sum("n").alias("all_words"), times(F.length("word"), "word_chars"), *[times(characters(F.col("word"), others), k) for k, others in CLASSES.items()])
    totals = sizes.join(sums, "lang").withColumn("m", F.struct("n_chars", "word_chars", *CLASSES))
    wholes = totals.select(
        "lang", (F.col("n_docs") >= rules.hot_share * all_docs).alias("hot"), "all_words", F.transform(class_counts("m"), lambda c: c / F.col("n_chars")).alias("class_share"))
    # The limit on places runs before the shuffle too: a task sends few words of each language.
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    lowered = table.groupBy("lang", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    top = lowered.where(F.lower("word") != F.upper("word"))  # words with a letter
    top = top.withColumn("place", place).where(F.col("place") <= rules.common_words)
    ranked = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    # A language without a lettered word still has its classes.
    ranked = wholes.join(ranked, "lang", "left").withColumn("top", F.coalesce("top", F.array().cast(ranked.schema["top"].dataType)))
    shares = F.transform("top", lambda x: x["n"] / F.col("all_words"))
    rest = F.aggregate(shares, F.lit(1.0), lambda a, x: a - x)
    return staging.write(ranked.select("lang", "hot", "class_share", F.transform("top", lambda x: x["word"]).alias("words"), F.concat(shares, F.array(rest)).alias("word_share")), "references")


def with_references(docs: DataFrame, reference: DataFrame, lang: str, ref: str, prepare: Callable[[DataFrame], DataFrame], rules: Rules) -> DataFrame:
    """What ``prepare`` makes of ``docs``, with the reference of its language as a struct ``ref``, or null.

    References of a measured size are broadcast. Of more, the hot ones are, and documents of hot or no language stay
    where they are; the others, less than ``Rules.hot_share`` of all documents in each language, meet theirs by language.
    """
    known = reference.select(F.struct(*reference.columns).alias(ref))
    key = lambda d: d[lang].cast("string")
    meet = lambda d, r, how: (p := prepare(d)).join(r, key(p) == r[ref]["lang"], how)
    size = reference.agg(F.coalesce(F.sum(F.octet_length(F.array_join("words", "")) + 400), F.lit(0))).first()[0]
    if size <= rules.broadcast_bytes:
        return meet(docs, F.broadcast(known), "left")
    flag = fresh(docs, "hot")
    hot = reference.where("hot").select(F.col("lang").alias(f"{flag}_lang"), F.lit(True).alias(flag))
    told = docs.join(F.broadcast(hot), key(docs) == F.col(f"{flag}_lang"), "left")
    stay = F.col(flag).isNotNull() | F.col(lang).isNull()
    near, far = told.where(stay).select(*docs.columns), told.where(~stay).select(*docs.columns)
    return meet(near, F.broadcast(known.where(F.col(ref)["hot"])), "left").unionByName(meet(far, known.where(~F.col(ref)["hot"]).hint("shuffle_merge"), "left"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, in bits and rooted: 0 for equal distributions, 1 for such that share nothing."""

    def part(x: Column, y: Column) -> Column:
        middle = (x + y) / 2
        term = lambda z: F.when(z > 0, z * F.log2(z / middle)).otherwise(0.0)
        return (term(x) + term(y)) / 2

    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(p, q, part), F.lit(0.0), lambda a, x: a + x)))


def judge(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang", out: str = "judged", rules: Rules = RULES) -> DataFrame:
    """``docs`` with a struct ``out``: the counts, class_distance, word_distance (null where not tested), base_failed, kept.

    Words are what stands between white space; a null text has none and fails. Rows of equal text and language are
    judged alike. ``reference`` comes from ``references``. Other
    columns stay as they are; ``out`` must not be among them.
    """
    m, ref = fresh(docs, "measured"), fresh(docs, "reference")
    joined = with_references(docs, reference, lang, ref, lambda d: measures(d, text, lang, m, rules), rules)
    n_words, chars = F.col(f"{m}.n_words"), F.col(f"{m}.n_chars")
    classes = F.transform(class_counts(m), lambda x: x / chars)
    known = F.filter(F.col(f"{m}.words"), lambda x: F.array_contains(F.col(f"{ref}.words"), x))
    hits = let(known, lambda k: F.transform(F.col(f"{ref}.words"), lambda word: F.size(F.filter(k, lambda x: x == word)) / n_words))
    words = let(hits, lambda h: F.concat(h, F.array(F.aggregate(h, F.lit(1.0), lambda a, x: a - x))))
    class_distance = F.when(n_words >= rules.class_words, distance(classes, F.col(f"{ref}.class_share")))
    word_distance = F.when(n_words >= rules.word_words, distance(words, F.col(f"{ref}.word_share")))
    base = (n_words < rules.least_words) | (F.col(f"{m}.n_repeat_words") > rules.most_repeated * n_words)
    judged = F.struct(
        n_words.alias("n_words"), F.col(f"{m}.word_chars").alias("word_chars"), F.col(f"{m}.symbols").alias("n_symbols"), F.col(f"{m}.n_dup_lines").alias("n_dup_lines"),
        F.col(f"{m}.n_repeat_words").alias("n_repeat_words"), class_distance.alias("class_distance"), word_distance.alias("word_distance"), base.alias("base_failed"),
    )
    found = joined.withColumn(out, judged)
    far = (F.coalesce(F.col(f"{out}.class_distance"), F.lit(0.0)) > rules.most_class_distance) | (F.coalesce(F.col(f"{out}.word_distance"), F.lit(0.0)) > rules.most_word_distance)
    return found.withColumn(out, F.struct(f"{out}.*", (~F.col(f"{out}.base_failed") & ~far).alias("kept"))).select(*docs.columns, out)


def keep_good(docs: DataFrame, reference: DataFrame, text: str = "text", lang: str = "lang", rules: Rules = RULES) -> DataFrame:
    """Rows of ``docs`` that are kept, unchanged."""
    out = fresh(docs, "judged")
    return judge(docs, reference, text, lang, out, rules).where(F.col(out)["kept"]).select(*docs.columns)
