"""URL allow and block rules by a sort-merge range join.

A host is written with its labels reversed and a dot behind each (``com.example.``), so a rule's host and all its
subdomains are the interval from that key to the same key with ``/``, the character after the dot, at its end. Within
one rule path these intervals nest or are apart. Rule borders and urls are sorted together and swept: the running count
of begun and ended rules is the depth of the stack, and the rule begun last at a depth is what the stack holds there.
The deepest rule is the one with the longest host.

The sweep runs in range partitions, each of which starts with the rules that are open at its first event, so urls of
one host may be spread over many of them. Only DataFrame operations are used.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.staging import Staging

ALLOW, BLOCK = "allow", "block"
# Kinds of events, in the order in which they happen at one key.
OPEN, END, BEGIN, URL = -1, 0, 1, 2
_EVENT = ["rule_path", "key", "kind", "spread"]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, ascii_uppercase, ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def reversed_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def domains(key: Column) -> Column:
    """The key of a host or of an interval's end, and those of all domains above it: ``com.example.``, ``com.``."""
    labels = F.split(F.substring(key, F.lit(1), F.length(key) - 1), r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row per (host, path), the host lower-cased; null parts count as empty, and what is allowed and blocked is blocked."""
    parts = rules.select(
        lower_ascii(F.coalesce("host", F.lit(""))).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"),
        F.when(F.col("verdict") == ALLOW, ALLOW).otherwise(BLOCK).alias("verdict"),
    )
    once = parts.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("size"), F.length("rule_host").alias("host_size"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    return once.select("rule_path", reversed_key(F.col("rule_host")).alias("rule_key"), rule.alias("rule"))


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule (host and path of the rule that decides, or null), verdict.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains where the url's
    path begins with the rule's; of those that fit, the longest (host and path together) decides, of equally
    long ones that with the longer host. Without a fitting rule the verdict is ``otherwise``. A null url, or one
    without ``://``, has an empty host and path. Repeated rows and ids each get a row; other columns are not read.
    """
    staging = Staging(pages.sparkSession)
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    rows = staging.write(rows, "urls")  # so that row numbers are given once
    rules = staging.write(clean_rules(rules), "rules")
    # All that the plan asks of the rules: the lengths of their paths, and how deep they nest.
    sizes = [r[0] for r in rules.select(F.length("rule_path")).distinct().collect()]
    above = rules.select("rule_path", F.col("rule_key").alias("inner"), F.explode(domains(F.col("rule_key"))).alias("rule_key"))
    depths = above.join(rules.select("rule_path", "rule_key"), ["rule_path", "rule_key"]).groupBy("rule_path", "inner").count()
    deepest = depths.agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]

    nothing = F.lit(None).cast(rules.schema["rule"].dataType)
    key = reversed_key(F.col("host"))
    starts = [F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sizes]
    urls = rows.select("*", F.explode(F.array_compact(F.array(*starts))).alias("rule_path")) if sizes else None
    if urls is None:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    events = reduce(DataFrame.union, [
        urls.select("rule_path", key.alias("key"), F.lit(URL).alias("kind"), F.xxhash64("row").alias("spread"), "row", nothing.alias("rule")),
        rules.select("rule_path", F.col("rule_key").alias("key"), F.lit(BEGIN), F.lit(0).cast("long"), F.lit(None).cast("long"), "rule"),
        rules.select("rule_path", F.concat(F.expr("left(rule_key, length(rule_key) - 1)"), F.lit("/")), F.lit(END), F.lit(0).cast("long"), F.lit(None).cast("long"), nothing),
    ])
    # Written, since the number of a range partition is fixed only then.
    ranged = staging.write(events.repartitionByRange(*_EVENT).withColumn("part", F.spark_partition_id()), "events")
    firsts = ranged.groupBy("part").agg(F.min(F.struct(*_EVENT)).alias("first")).select("part", "first.*")
    opened = firsts.select("part", "rule_path", "key", "kind", F.explode(domains(F.col("key"))).alias("rule_key"))
    # At its own begin a rule isn't open yet; at its end it still is.
    opened = opened.where((F.col("kind") != BEGIN) | (F.col("rule_key") != F.col("key"))).join(rules, ["rule_path", "rule_key"])
    opened = opened.select("rule_path", F.col("rule_key").alias("key"), F.lit(OPEN).alias("kind"), F.lit(0).cast("long").alias("spread"), F.lit(None).cast("long").alias("row"), "rule", "part")
    sweep = Window.partitionBy("part").orderBy(F.col("kind") != OPEN, *_EVENT).rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("kind") == END, -1).when(F.col("kind") == URL, 0).otherwise(1)
    swept = ranged.unionByName(opened).withColumn("depth", F.sum(step).over(sweep))
    begun = F.col("kind").isin(OPEN, BEGIN)
    for level in range(1, deepest + 1):
        swept = swept.withColumn(f"level{level}", F.last(F.when(begun & (F.col("depth") == level), F.col("rule")), ignorenulls=True).over(sweep))
    stack = F.array(*[F.col(f"level{level}") for level in range(1, deepest + 1)])
    found = swept.where((F.col("kind") == URL) & (F.col("depth") > 0)).select("row", F.element_at(stack, F.col("depth").cast("int")).alias("rule"))
    best = found.groupBy("row").agg(F.max("rule").alias("best"))
    return rows.join(best, "row", "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
