"""Chat formatting with Spark expressions only: sorted turns, merged runs of one role, one text and one loss mask.

A run of turns of one role is rendered as

    <|im_start|>role\\n text <|im_sep|> text ... <|im_end|>\\n

Inside texts and roles, every ``<``, any number of backslashes, ``|`` gets one backslash more, so no control string of the
template can come from the data, and taking one backslash away gives the data back. A line break in a role is written as
the control string ``<|im_nl|>``. The mask lists, per assistant text, where it begins and how long it is, in bytes of the
UTF-8 form: neither markers nor what separates texts are learned from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.staging import Staging

# The control strings of the template.
START, SEPARATOR, END, ROLE_BREAK = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|im_nl|>"
# The role whose texts are learned.
LEARNED = "assistant"

_SPLIT_RUNS, _SPLIT_TEXTS = r"<\|im_start\|>", r"<\|im_sep\|>"

# Turns in one row at most: a longer conversation comes in several parts.
PART_TURNS = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(ROLE_BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n")))


def _sorted_turns() -> Column:
    return F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")


def _runs(turns: Column) -> Column:
    """Adjacent turns of one role become one run with all their texts."""

    def put(runs: Column, turn: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        grown = F.struct(turn["role"].alias("role"), F.concat(last["texts"], F.array(turn["text"])).alias("texts"))
        new = F.struct(turn["role"].alias("role"), F.array(turn["text"]).alias("texts"))
        return F.when(last["role"] == turn["role"], F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(grown))).otherwise(
            F.concat(runs, F.array(new))
        )

    return F.aggregate(turns, F.array().cast("array<struct<role:string,texts:array<string>>>"), put)


def _segments(runs: Column, joins: Column, goes_on: Column) -> Column:
    """(text, loss) in order: markers and escaped texts. ``joins``: the first run continues the part before, without a head of
    its own; ``goes_on``: the last run ends in a part behind."""

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_run(run: Column, i: Column) -> Column:
        head = F.when(joins & (i == 0), F.lit(SEPARATOR)).otherwise(F.concat(F.lit(START), escape_role(run["role"]), F.lit("\n")))
        texts = F.flatten(F.transform(run["texts"], lambda t, j: F.array(
            segment(F.when(j == 0, head).otherwise(F.lit(SEPARATOR)), F.lit(False)), segment(escape(t), run["role"] == LEARNED))))
        end = F.when(goes_on & (i == F.size(runs) - 1), F.lit("")).otherwise(F.lit(END + "\n"))
        return F.concat(texts, F.array(segment(end, F.lit(False))))

    return F.flatten(F.transform(runs, of_run))


def _rendered(parts: DataFrame) -> DataFrame:
    """From (conv_id, part, runs, open_role, goes_on): the text of each part and its mask."""
    cut = _segments(F.col("runs"), F.col("open_role").isNotNull(), F.col("goes_on"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<first:bigint,n_bytes:bigint>>").alias("spans"))

    def step(done: Column, s: Column) -> Column:
        size = F.octet_length(s["text"]).cast("bigint")
        spans = F.concat(done["spans"], F.array(F.struct(done["at"].alias("first"), size.alias("n_bytes"))))
        return F.struct((done["at"] + size).alias("at"), F.when(s["loss"], spans).otherwise(done["spans"]).alias("spans"))

    return parts.select("conv_id", "part", "open_role", cut.alias("segments")).select(
        "conv_id", "part", "open_role", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.aggregate("segments", start, step)["spans"].alias("loss"),
    )


def format_conversations(turns: DataFrame, part_turns: int = PART_TURNS, staging: Staging | None = None) -> DataFrame:
    """(conv_id, part, open_role, formatted, loss) from rows (conv_id, turn, role, text); further columns are ignored.

    Turns of a conversation are ordered by turn (null first), then role, then text; repeated rows are turns of their own. A
    null text or role is empty; rows with a null conv_id are one conversation. An empty table gives no rows.

    A conversation is one row, part 0. One of more than ``part_turns`` turns comes as parts 1 and up (not dense), which joined
    in order are its text, wherever it is cut: ``open_role`` is the role of the run that a part begins inside of, else null.
    Such turns are dealt by range of (conv_id, turn, role, text), so no task gets a conversation whole, and the parts learn
    from two roles each whether a run goes on. ``staging`` holds them meanwhile.
    """
    rows = turns.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    staging = staging or Staging(turns.sparkSession)
    # Few rows or many: Spark knows the size of a written table when it picks the join.
    long = staging.write(rows.groupBy(F.col("conv_id").alias("long_id")).agg(F.count("*").alias("n")).where(F.col("n") > part_turns), "long")
    if long.isEmpty():
        return _rendered(_short_ones(rows))
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    parts = _parts(rows.join(long, is_long, "left_semi"), part_turns, staging)
    return _rendered(_short_ones(rows.join(long, is_long, "left_anti")).unionByName(parts))


def _short_ones(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id").agg(_sorted_turns()).select(
        "conv_id", F.lit(0).cast("bigint").alias("part"), _runs(F.col("turns")).alias("runs"),
        F.lit(None).cast("string").alias("open_role"), F.lit(False).alias("goes_on"),
    )


def _parts(rows: DataFrame, part_turns: int, staging: Staging) -> DataFrame:
    order = ["conv_id", "turn", "role", "text"]
    # Rows that tie in all four are equal, so a task that runs again deals the same parts.
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("part", F.floor(F.monotonically_increasing_id() / part_turns) + 1)
    runs = dealt.groupBy("conv_id", "part").agg(_sorted_turns()).select("conv_id", "part", _runs(F.col("turns")).alias("runs"))
    runs = staging.write(runs, "runs")
    in_order = Window.partitionBy("edge_id").orderBy("edge_part")
    first, last = F.element_at("runs", 1)["role"], F.element_at("runs", -1)["role"]
    edges = runs.select(F.col("conv_id").alias("edge_id"), F.col("part").alias("edge_part"), first.alias("first"), last.alias("last"))
    edges = edges.select(
        "edge_id", "edge_part", F.when(F.lag("last").over(in_order) == F.col("first"), F.col("first")).alias("open_role"),
        F.coalesce(F.lead("first").over(in_order) == F.col("last"), F.lit(False)).alias("goes_on"),
    )
    meets = F.col("conv_id").eqNullSafe(F.col("edge_id")) & (F.col("part") == F.col("edge_part"))
    return runs.join(edges, meets).select("conv_id", "part", "runs", "open_role", "goes_on")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, part, turns, loss_text, n_chars) from formatted parts and their masks alone.

    ``turns`` are (role, text) as they were, and ``loss_text`` is the unescaped text under the mask, without a gap.
    """

    def of_texts(role: Column, texts: Column) -> Column:
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    def of_block(block: Column) -> Column:
        at = F.instr(block, "\n")
        return of_texts(unescape_role(F.substr(block, F.lit(1), at - 1)), F.split(F.substr(block, at + 1), _SPLIT_TEXTS, -1))

    # Control strings come from the template only, so the ends can go before the text is split at the heads.
    blocks = F.split(F.replace(F.col("formatted"), F.lit(END + "\n"), F.lit("")), _SPLIT_RUNS, -1)
    read = formatted.select("*", blocks.alias("blocks"))
    # What stands before the first head goes on with the run of the part before.
    open_texts = F.split(F.element_at("blocks", 1), _SPLIT_TEXTS, -1)
    opening = of_texts(F.col("open_role"), F.slice(open_texts, F.lit(2), F.size(open_texts)))
    turns = F.concat(opening, F.flatten(F.transform(F.slice("blocks", F.lit(2), F.size("blocks")), of_block)))
    utf8 = F.encode("formatted", "UTF-8")
    masked = F.transform("loss", lambda s: unescape(F.decode(F.substr(utf8, (s["first"] + 1).cast("int"), s["n_bytes"].cast("int")), "UTF-8")))
    return read.select(
        "conv_id", "part", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), F.char_length("formatted").cast("bigint").alias("n_chars"),
    )
