"""N-gram Jaccard join: documents that share at least 80 % of their distinct word shingles are linked.

1. Documents with equal shingle sets are one *class*; only classes are compared.
2. Classes that can be similar meet: 56 signatures of four min-hashes each; a pair at the threshold misses all of
   them with probability (1 - 0.8^4)^56 < 2e-13. What signatures connect is a *block*; all links are inside blocks.
3. A block's classes are dealt into bands by set size, and large bands into slices. Only tiles of slices whose sizes
   can meet the threshold are formed, each with a bounded number of classes.
4. In a tile, pairs that share a signature are bounded from above by the bit counts of hashed bitmaps; pairs that pass are
   intersected exactly, as sorted arrays. Pairs that earlier links connect already are left out.
5. Links connect classes to components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.components import components
from tillroll.llm.words import U64, Words, chunks, column, fresh, mix, segment_starts, stream, words_of
from tillroll.operators.staging import Staging

SHINGLE = 5
THRESHOLD = 80  # per cent
TABLES, ROWS = 56, 4
# Sizes in one band differ by less than the threshold allows, so only neighbouring bands can hold a link.
BAND = math.log(100 / THRESHOLD)
# Shingles, by number of classes and by total size, that one side of a tile holds, about.
SLICE_CLASSES, SLICE_SHINGLES = 1000, 1 << 20

# Bits of the filter that keeps most texts out of the shuffle: one megabyte.
FILTER_BITS = 1 << 23

_PLACES = stream(11, SHINGLE) | U64(1)
_SEEDS = stream(12, TABLES * ROWS) | U64(1)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it: (text, hash). A text of fewer words is one shingle."""
    hashes, counts = words.hashes(), words.counts()
    placed = [mix(hashes * _PLACES[k]) for k in range(n)]
    first = words.firsts()[:-1]
    if len(hashes) >= n:
        whole = sum((placed[k][k : len(hashes) - n + 1 + k] for k in range(1, n)), placed[0][: len(hashes) - n + 1].copy())
        inside = words.text[n - 1 :] == words.text[: len(hashes) - n + 1]
        text, values = words.text[: len(hashes) - n + 1][inside], whole[inside]
    else:
        text, values = np.zeros(0, np.int64), np.zeros(0, U64)
    few = np.flatnonzero((counts > 0) & (counts < n))  # as arrays of one, whose overflow is meant
    if len(few):
        short = [sum((placed[k][first[t] + k : first[t] + k + 1] for k in range(1, counts[t])), placed[0][first[t] : first[t] + 1]) + counts[t : t + 1].astype(U64) * _PLACES[n - 1 :] for t in few]
        text, values = np.concatenate([text, few]), np.concatenate([values, *short])
    values = mix(values)
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    keep = segment_starts(text, values)
    return text[keep], values[keep]


def _signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One row of signatures per set; ``begin`` is where each set starts in ``values``."""
    low = (values & U64(0xFFFFFFFF)).astype(np.uint32)
    high = (values >> U64(32)).astype(np.uint32)
    out = np.zeros((len(begin), TABLES), U64)
    for i in range(TABLES * ROWS):
        seed = int(_SEEDS[i])
        least = np.minimum.reduceat((low * np.uint32(seed & 0xFFFFFFFF | 1)) ^ (high * np.uint32(seed >> 32 | 1)), begin)
        out[:, i // ROWS] = mix(out[:, i // ROWS] + least.astype(U64) + U64(i + 1))
    return out


def _describe(batches: Iterator[pa.RecordBatch], ids: str) -> Iterator[pa.RecordBatch]:
    """(id, n_shingles, fingerprint, signatures) of each row; nulls instead of the last two for an empty set."""
    for batch in chunks(batches, "text", 1 << 19):
        text, values = shingles(words_of(column(batch, "text")))
        sizes = np.bincount(text, minlength=batch.num_rows)
        begin = segment_starts(text)
        prints, rows = [None] * batch.num_rows, [None] * batch.num_rows
        if len(begin):
            one, two = np.add.reduceat(mix(values + U64(1)), begin), np.add.reduceat(mix(values ^ U64(0x5555555555555555)), begin)
            signatures = _signatures(values, begin).view(np.int64)
            for i, t in enumerate(text[begin]):
                prints[t] = one[i].tobytes() + two[i].tobytes()
                rows[t] = signatures[i]
        columns = [column(batch, ids), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(rows, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, [ids, "n_shingles", "class", "signatures"])


def bitmap_words(size: int) -> int:
    """Bitmaps have about four bits per shingle of the larger set."""
    return max(4, 1 << max(0, (4 * size // 64 - 1).bit_length()))


def _links(table: list[dict], threshold: int) -> Iterator[tuple[bytes, bytes]]:
    """Links of one tile that connect it: enough of them that linked classes are connected, and none that isn't true."""
    table.sort(key=lambda r: (r["n_shingles"], r["class"]))
    n = len(table)
    sets = [np.frombuffer(r["shingles"], U64) for r in table]
    sizes = np.array([r["n_shingles"] for r in table])
    side = np.array([r["side"] for r in table])
    width = bitmap_words(int(sizes.max()))
    bits = np.zeros((n, width), U64)
    for i, values in enumerate(sets):
        at = (values % U64(64 * width)).astype(np.int64)
        np.bitwise_or.at(bits[i], at >> 6, U64(1) << (at & 63).astype(U64))
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    signatures = np.array([r["signatures"] for r in table]).reshape(n, -1)
    for k in range(signatures.shape[1]):
        order = np.argsort(signatures[:, k], kind="stable")
        starts = segment_starts(signatures[order, k])
        for low, high in zip(starts, np.append(starts[1:], n), strict=True):
            if high - low < 2:
                continue
            group = order[low:high]  # by size, as the rows are
            for j in range(1, len(group)):
                b = group[j]
                # Smaller sets that are large enough, on the other side if the tile has two, and not connected yet.
                a = group[np.searchsorted(sizes[group[:j]] * 100, threshold * sizes[b], "left") : j]
                a = a[(side[a] != side[b]) | (side[b] == 0)]
                if not len(a):
                    continue
                own = root(b)
                a = a[[root(x) != own for x in a]]
                if not len(a):
                    continue
                # Common elements are at most those of a, less the bits of a that b lacks.
                most = sizes[a] - np.bitwise_count(bits[a] & ~bits[b]).sum(1)
                for x in a[100 * most >= threshold * (sizes[a] + sizes[b] - most)]:
                    if root(x) == root(b):
                        continue
                    common = _common(sets[x], sets[b])
                    if 100 * common >= threshold * (len(sets[x]) + len(sets[b]) - common):
                        parent[root(x)] = root(b)
                        yield table[x]["class"], table[b]["class"]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct numbers."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def classes_of(docs: DataFrame, staging: Staging, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, class) per row, and (class, n_shingles, signatures, first_id) per class of equal sets."""
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    described = staging.write(picked.mapInArrow(lambda b: _describe(b, "doc_id"), f"doc_id {kind}, n_shingles bigint, class binary, signatures array<bigint>"), "described")
    # Any row of a class stands for its signatures; the smallest id, for its text.
    one = described.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("signatures").alias("signatures"))
    return described.select("doc_id", "n_shingles", "class"), staging.write(one, "classes")


def blocks_of(classes: DataFrame, staging: Staging) -> DataFrame:
    """(class, block): classes that a chain of equal signatures connects; those that meet no other are left out.

    Classes meet as 64-bit hashes of their fingerprints, half as wide as these; two that share one are in one block.
    """
    known = classes.select("class", F.xxhash64("class").alias("node"), "signatures")
    rows = known.select("node", F.posexplode("signatures").alias("k", "s")).select("node", F.xxhash64("k", "s").alias("cell"))
    met = rows.groupBy("cell").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("cell", "least")
    edges = rows.join(met, "cell").where(F.col("node") != F.col("least")).select(F.col("node").alias("u"), F.col("least").alias("v"))
    return known.select("class", "node").join(components(edges, staging, "blocks"), "node").select("class", F.col("root").alias("block"))


def tiles_of(members: DataFrame, staging: Staging) -> DataFrame:
    """(class, tile, side) from (class, block, n_shingles): which tiles a class takes part in.

    A block that fits is one tile. Others are dealt into bands of sizes, and bands into slices by hash; tiles are pairs
    of slices of one band or of neighbouring bands. ``side`` is 0 where all pairs count, else only pairs of sides 1 and 2 do.
    """
    whole = members.groupBy("block").agg(F.count("*").alias("classes"), F.sum("n_shingles").alias("shingles"))
    banded = members.withColumn("band", F.floor(F.log(F.col("n_shingles").cast("double")) / BAND + 1e-9).cast("int"))
    need = lambda: F.ceil(F.greatest(F.count("*") / SLICE_CLASSES, F.sum("n_shingles") / SLICE_SHINGLES)).cast("int")
    bands = banded.groupBy("block", "band").agg(need().alias("slices"))
    small = (F.col("classes") <= SLICE_CLASSES) & (F.col("shingles") <= SLICE_SHINGLES)
    shape = staging.write(bands.join(whole.select("block", small.alias("small")), "block"), "bands")
    # Bands have few and bounded numbers per block; what is joined back is one row per block and band.
    beside = shape.where("not small").select("block", (F.col("band") - 1).alias("band"), F.col("slices").alias("above"))
    below = shape.where("not small").select("block", (F.col("band") + 1).alias("band"), F.col("slices").alias("below"))
    known = shape.join(beside, ["block", "band"], "left").join(below, ["block", "band"], "left").na.fill(0, ["above", "below"])
    dealt = banded.join(known, ["block", "band"]).withColumn("slice", F.pmod(F.xxhash64("class"), F.col("slices")).cast("int"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    spot = lambda band, low, high, kind, side: F.struct(*[x.cast("int").alias(n) for n, x in zip(("band", "low", "high", "kind", "side"), (band, low, high, kind, side), strict=True)])
    band, mine, zero, one, two = F.col("band"), F.col("slice"), F.lit(0), F.lit(1), F.lit(2)
    own = F.transform(upto("slices"), lambda s: spot(band, F.least(s, mine), F.greatest(s, mine), zero, F.when(s == mine, 0).when(mine < s, 1).otherwise(2)))
    up = F.transform(upto("above"), lambda s: spot(band, mine, s, one, one))
    down = F.transform(upto("below"), lambda s: spot(band - 1, s, mine, one, two))
    all_in_one = F.array(spot(zero, zero, zero, zero, zero))
    dealt = dealt.select("class", "block", F.explode(F.when(F.col("small"), all_in_one).otherwise(F.concat(own, up, down))).alias("t"))
    return dealt.select("class", F.struct("block", "t.band", "t.low", "t.high", "t.kind").alias("tile"), F.col("t.side").alias("side"))


def maybe_among(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose key isn't among ``ids``: a bitmap of hashed ids, of fixed size, is broadcast.

    None that is among them is left out; with very many ids the bitmap is full and lets all rows pass.
    """
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    words = ids.select((place / 64).cast("int").alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    set_bits = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[set_bits["word"].to_numpy()] = set_bits["bits"].to_numpy()
    shared, name = rows.sparkSession.sparkContext.broadcast(bitmap), fresh(rows, "filter_place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value.view(U64)
        for batch in batches:
            at = column(batch, name).fill_null(0).to_numpy()
            hit = (bits[at >> 6] >> (at & 63).astype(U64) & U64(1)).astype(bool)
            yield batch.filter(pa.array(hit)).drop_columns(name)

    return rows.withColumn(name, place.cast("long")).mapInArrow(run, rows.schema)


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class (of equal shingle sets, binary), component_id.

    Words are what stands between white space, with A-Z lower-cased; a document's set is its distinct 5-word shingles, or
    the whole sequence if that is shorter. ``component_id`` is the smallest id that links reach, the row's own
    included, whatever rows with null ids lie between. A null or wordless text has an empty set, class null, and is linked with nothing. Repeated rows are of one
    class; a null id is never the smallest. An empty table gives no rows; other columns are not read.
    """
    staging = Staging(docs.sparkSession)
    rows, classes = classes_of(docs, staging, doc_id, text)
    blocks = staging.write(blocks_of(classes, staging), "in-blocks")
    members = staging.write(classes.join(blocks, "class").select("class", "block", "n_shingles", "first_id", "signatures"), "members")
    tiles = tiles_of(members.select("class", "block", "n_shingles"), staging)

    # The sets themselves are needed for members only, and are made from their texts again.
    picked = docs.select(F.col(doc_id).alias("first_id"), F.col(text).alias("text"))
    ids = members.select("first_id").where("first_id is not null").distinct()
    texts = maybe_among(picked, ids, "first_id").join(ids, "first_id")
    if not members.where("first_id is null").isEmpty():  # classes that have null ids only are found among all such rows
        texts = texts.unionByName(picked.where("first_id is null"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            of, values = shingles(words_of(column(batch, "text")))
            begin = segment_starts(of)
            end = np.append(begin[1:], len(values))
            prints = np.stack([np.add.reduceat(mix(values + U64(1)), begin), np.add.reduceat(mix(values ^ U64(0x5555555555555555)), begin)], 1) if len(begin) else np.zeros((0, 2), U64)
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in prints], pa.binary()), pa.array([values[a:b].tobytes() for a, b in zip(begin, end, strict=True)], pa.binary())], ["class", "shingles"])

    whole = texts.mapInArrow(sets, "class binary, shingles binary").groupBy("class").agg(F.first("shingles").alias("shingles"))
    rows_of_tiles = tiles.join(members.select("class", "n_shingles", "signatures"), "class").join(whole, "class")

    def tile_links(table: pa.Table) -> pa.Table:
        found = list(_links(table.drop_columns("tile").to_pylist(), threshold)) if table.num_rows > 1 else []
        return pa.table({"u": pa.array([a for a, _ in found], pa.binary()), "v": pa.array([b for _, b in found], pa.binary())})

    links = rows_of_tiles.groupBy("tile").applyInArrow(tile_links, "u binary, v binary")
    joined = staging.write(components(links, staging, "links"), "components")
    return named(rows, classes, joined, staging)


def named(rows: DataFrame, classes: DataFrame, joined: DataFrame, staging: Staging) -> DataFrame:
    """Give rows the smallest id of their component; rows of classes without a link, that of their class."""
    of = classes.select("class", "first_id").join(joined.withColumnRenamed("node", "class"), "class", "left")
    of = of.select("class", "first_id", F.coalesce("root", "class").alias("root"))
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # One row per class; a class of very many copies is a key that this join may split.
    known = staging.write(of.join(least, "root").select("class", "component_id"), "named")
    # Rows without a class match nothing and are spread.
    key = F.coalesce("class", F.concat(F.lit("no words: "), F.xxhash64("doc_id").cast("string")).cast("binary"))
    out = rows.withColumn("key", key).join(known.withColumnsRenamed({"class": "key"}), "key", "left")
    return out.select("doc_id", "n_shingles", "class", F.coalesce("component_id", F.when(F.col("class").isNull(), F.col("doc_id"))).alias("component_id"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents: that with the smallest id, same columns.

    Rows without words are in no group and all stay. Rows that repeat the smallest id of a group are told apart by their
    place in the table, so one of them stays. Rows whose group has no id at all count as one group too.
    """
    staging = Staging(docs.sparkSession)
    place = fresh(docs, "place")
    ordered = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.monotonically_increasing_id().alias("n"))
    named_ids = docs.select(ordered.alias("id"), F.col(text).alias("text"))
    found = similar(named_ids, "id", "text")
    keep = staging.write(found.where(F.col("class").isNull() | (F.col("doc_id") == F.col("component_id"))).select(F.col("doc_id.n").alias(place)), "kept")
    return docs.withColumn(place, F.monotonically_increasing_id()).join(keep, place, "left_semi").select(*docs.columns)
