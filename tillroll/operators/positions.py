"""Places of rows as numbers: every row's place in the whole input by arithmetic, and sets of places as bitmaps.

A scan tells for each row its file, its block and a running number. The block directory, one row per block, turns these into
one number, so rows can be cut into chunks without sampling and without bounds in any plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.lookup import BROADCAST_BYTES, measured_bytes
from tillroll.operators.ordering import freeze_in_order, number_rows
from tillroll.operators.staging import Staging

# Place of a row in the order of the input: 0 and up, unique, with gaps only where rows were taken out.
POSITION = "position"
# Positions of a chunk, which one bitmap of Spark's covers.
CHUNK_BITS = 15
CHUNK = "position_chunk"
# Positions of a slice of a bitmap, as rows meet it: a row copies and counts no more than its slice.
SLICE_BITS = 10
SLICE = "position_slice"
# Bits of a hash that a filter of hashes looks at.
FILTER_BITS = 28
# Chunks that one window may see; more are totalled in groups first.
_GROUP_BITS = 12


def block_place() -> Column:
    """Where a scanned row stands: file, block and a running number, by which its rows are in order within the block."""
    path = F.col("_metadata.file_path")
    # A local path begins with one slash or three, as the reader has it; this is cheaper than a pattern, which every row would pay.
    local = F.concat(F.lit("file:/"), F.ltrim(F.substr(path, F.lit(len("file:/") + 1)), F.lit("/")))
    return F.struct(
        F.when(path.startswith("file:/"), local).otherwise(path).alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def is_block_place(place: T.DataType) -> bool:
    return isinstance(place, T.StructType) and place.names == ["path", "block", "row"]


def bounded_broadcast(table: DataFrame) -> DataFrame:
    """Marked for broadcast if its measured size is within the bound, else as it is."""
    return F.broadcast(table) if is_small(table) else table


def is_small(table: DataFrame) -> bool:
    """Whether the measured size is within the bound of a broadcast."""
    texts = sum(isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in table.schema)
    return measured_bytes(table) + 16 * texts <= BROADCAST_BYTES


def block_directory(rows: DataFrame, place: str) -> DataFrame:
    """(path, block, first, offset, opens) per block: its least running number, how many positions come before it, and
    whether it is its file's first. As many rows as there are blocks; files come in the order of their paths."""
    blocks = rows.groupBy(f"{place}.path", f"{place}.block").agg(
        F.min(f"{place}.row").alias("first"), (F.max(f"{place}.row") - F.min(f"{place}.row") + 1).alias("n"))
    in_order = Window.orderBy("path", "block")
    return blocks.select(
        "path", "block", "first", (F.sum("n").over(in_order) - F.col("n")).alias("offset"),
        F.coalesce(F.lag("path").over(in_order) != F.col("path"), F.lit(True)).alias("opens"),
    )


def with_positions(rows: DataFrame, place: str, staging: Staging, name: str = "positions") -> DataFrame:
    """``rows`` with POSITION, in the order of ``place``; ``rows`` must be a written table.

    Places by block need one pass over the column and a join with the directory; rows aren't moved. Any other orderable,
    unique place is sorted by range and written in order once.
    """
    if not is_block_place(rows.schema[place].dataType):
        numbered = number_rows(freeze_in_order(rows, [place], staging, name), POSITION)
        return numbered.withColumn(POSITION, F.col(POSITION) - 1)
    directory = staging.write(block_directory(rows, place), name).drop("opens")
    found = rows.join(bounded_broadcast(directory), (F.col(f"{place}.path") == F.col("path")) & (F.col(f"{place}.block") == F.col("block")))
    return found.withColumn(POSITION, F.col("offset") + F.col(f"{place}.row") - F.col("first")).select(*rows.columns, POSITION)


def chunk_of_position() -> Column:
    return F.shiftright(F.col(POSITION), CHUNK_BITS)


def before_chunks(chunks: DataFrame, value: str, how: Callable[[Column], Column], before: str) -> DataFrame:
    """``chunks`` (one row per CHUNK) with the sum or maximum of ``value`` over all chunks before, null for the first.

    Groups of chunks are totalled first, so the window that sees all has a row per some hundred million positions.
    """
    group, ahead = F.shiftright(CHUNK, _GROUP_BITS), (Window.unboundedPreceding, -1)
    groups = chunks.groupBy(group.alias("_group")).agg(how(value).alias("_of_group"))
    groups = groups.select("_group", how("_of_group").over(Window.orderBy("_group").rowsBetween(*ahead)).alias("_before_group"))
    inside = how(value).over(Window.partitionBy("_group").orderBy(CHUNK).rowsBetween(*ahead)).alias("_inside")
    placed = chunks.withColumn("_group", group).select("*", inside).join(F.broadcast(groups), "_group")
    both = F.greatest("_before_group", "_inside") if how is F.max else F.coalesce("_before_group", F.lit(0)) + F.coalesce("_inside", F.lit(0))
    return placed.select(*chunks.columns, both.alias(before))


def running(rows: DataFrame, value: Column, how: Callable[[Column], Column], name: str, staging: Staging, itself: bool = True) -> DataFrame:
    """``rows`` (written, with POSITION and CHUNK) with the running sum or maximum ``name`` of a value in order of position, the
    row ``itself`` included or not; null values count for nothing."""
    totals = rows.groupBy(CHUNK).agg(how(value).alias("_total"))
    totals = staging.write(before_chunks(totals, "_total", how, "_before").select(CHUNK, "_before"), f"{name}-totals")
    inside = how(value).over(Window.partitionBy(CHUNK).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0 if itself else -1))
    both = F.greatest("_before", inside) if how is F.max else F.coalesce("_before", F.lit(0)) + F.coalesce(inside, F.lit(0))
    joined = rows.join(bounded_broadcast(totals), CHUNK)
    return staging.write(joined.select(*rows.columns, both.alias(name)), name)


def position_sets(positions: DataFrame, staging: Staging, name: str) -> DataFrame:
    """(CHUNK, bits, n, before) from a column POSITION: the set of positions of each chunk, and how many come before the chunk."""
    place = F.col(POSITION).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    sets = positions.groupBy(chunk_of_position().alias(CHUNK)).agg(F.call_function("bitmap_construct_agg", place).alias("bits"))
    sets = staging.write(sets.withColumn("n", F.call_function("bitmap_count", F.col("bits"))), name)
    counts = before_chunks(sets.select(CHUNK, "n"), "n", F.sum, "before").select(CHUNK, "before")
    return staging.write(sets.join(counts, CHUNK), f"{name}-placed")


def in_set(bits: Column) -> Column:
    """Whether a bitmap holds the row's position."""
    place = F.col(POSITION).bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).cast("int")
    byte = F.ascii(F.decode(F.substr(bits, F.shiftright(place, 3) + 1, F.lit(1)), "ISO-8859-1"))
    return F.call_function("getbit", byte, place.bitwiseAND(F.lit(7))) == 1


def keep_numbered(rows: DataFrame, sets: DataFrame, number: str) -> DataFrame:
    """The rows whose POSITION is in the sets, with ``number`` = 1, 2, 3, ... in order of position.

    The one shuffle that the rows need, and only those that stay where the sets can be broadcast; chunks are of one size
    whatever the data.
    """
    sets = bounded_broadcast(sets.select(CHUNK, "bits", "before"))
    kept = rows.withColumn(CHUNK, chunk_of_position()).join(sets, CHUNK).where(in_set(F.col("bits"))).drop("bits")
    place = F.row_number().over(Window.partitionBy(CHUNK).orderBy(POSITION))
    return kept.withColumn(number, F.col("before") + place).select(*rows.columns, number)


def slice_bits() -> int:
    return min(SLICE_BITS, CHUNK_BITS)


def slices_of(sets: DataFrame) -> DataFrame:
    """(SLICE, bits, before): the parts of bitmaps per CHUNK that hold anything, and how many positions come before each."""
    n, width = 1 << (CHUNK_BITS - slice_bits()), 1 << (slice_bits() - 3)
    ahead = F.call_function("bitmap_count", F.substr("bits", F.lit(1), F.col("part") * width))
    parts = sets.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part")).select(
        (F.col(CHUNK) * n + F.col("part")).alias(SLICE), F.substr("bits", F.col("part") * width + 1, F.lit(width)).alias("bits"),
        (F.col("before") + ahead).alias("before"),
    )
    return parts.where(F.call_function("bitmap_count", F.col("bits")) > 0)


def _bit_of(place: Column) -> tuple[Column, Column, Column]:
    """Of a place in a slice: the bytes before, the byte, and the place in it."""
    whole = F.shiftright(place, 3)
    return whole, F.ascii(F.decode(F.substr("bits", whole + 1, F.lit(1)), "ISO-8859-1")), place.bitwiseAND(F.lit(7))


def _in_slice(numbers: Column) -> Column:
    return numbers.bitwiseAND(F.lit((1 << slice_bits()) - 1)).cast("int")


def number_kept(rows: DataFrame, sets: DataFrame, number: str) -> DataFrame:
    """The same rows as those of ``keep_numbered``, without a shuffle where the sets can be broadcast.

    A row's number is how many positions come before its slice and how many bits of the slice up to its own.
    """
    slices = slices_of(sets)
    if not is_small(slices):
        return keep_numbered(rows, sets, number)
    met = rows.withColumn(SLICE, F.shiftright(POSITION, slice_bits())).join(F.broadcast(slices), SLICE)
    whole, byte, rest = _bit_of(_in_slice(F.col(POSITION)))
    ahead = F.call_function("bitmap_count", F.substr("bits", F.lit(1), whole))
    inside = F.bit_count(byte.bitwiseAND(F.call_function("shiftleft", F.lit(2), rest) - 1))
    kept = met.where(F.call_function("getbit", byte, rest) == 1)
    return kept.withColumn(number, F.col("before") + ahead + inside).select(*rows.columns, number)


def hash_filter(hashes: DataFrame, of: str) -> DataFrame:
    """(SLICE, bits): a bitmap of the lowest FILTER_BITS bits of the hashes, of at most 32 MB however many there are."""
    low = F.col(of).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    sets = hashes.groupBy(F.shiftright(low, CHUNK_BITS).alias(CHUNK)).agg(
        F.call_function("bitmap_construct_agg", low.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))).alias("bits"))
    return slices_of(sets.withColumn("before", F.lit(0).cast("long"))).drop("before")


def maybe_in(rows: DataFrame, slices: DataFrame, of: str) -> DataFrame:
    """The rows whose hash is in the filter, and a few that share its lowest bits; moves none."""
    low = F.col(of).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    met = rows.join(F.broadcast(slices), F.shiftright(low, slice_bits()) == F.col(SLICE))
    _, byte, rest = _bit_of(_in_slice(low))
    return met.where(F.call_function("getbit", byte, rest) == 1).select(*rows.columns)
