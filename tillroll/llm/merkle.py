"""Merkle manifest of a dataset: a tree per language over the documents in id order, and a tree over the languages.

Leaves are numbered within their tree and dealt into superblocks of 2**bits. A first pass reduces every superblock to one
node. What lies above - one node per superblock, again in superblocks, until a tree has one node - is thousands of times
smaller and gives every superblock its outer path. Leaves and outer paths are then cogrouped by superblock: one call
reduces the block, joins inner and outer proof and folds every leaf up to the root.

A node's siblings are texts: ``L`` or ``R`` and the digest, by the side the sibling stands on, or nothing where a node is
alone in its run and is hashed alone.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.lookup import lookup
from tillroll.operators.ordering import freeze_in_order, number_rows
from tillroll.operators.staging import Staging

# Leaves of a superblock, as a power of two.
BITS = 12

LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def leaf_digest(values: list[Column]) -> Column:
    """Hex SHA-256 over the values as text: ``-`` for null, else the bytes' number, a colon and the value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)).cast("binary"), 256)


def _h(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def reduce_levels(digests: list[str], n_levels: int) -> list[list[str]]:
    """The nodes of each level, from ``digests`` up; a node alone in its pair is hashed alone."""
    levels = [digests]
    for _ in range(n_levels):
        below = levels[-1]
        levels.append([_h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path_of(levels: list[list[str]], place: int) -> list[str]:
    """Siblings of the node at ``place``, one per level below the last."""
    path = []
    for level in levels[:-1]:
        other = place ^ 1
        path.append((("L" if place & 1 else "R") + level[other]) if other < len(level) else "")
        place >>= 1
    return path


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for step in path:
        digest = _h(digest) if not step else _h(step[1:], digest) if step[0] == "L" else _h(digest, step[1:])
    return digest


def proof_digest(path: list[str]) -> str:
    return _h(*[step[1:] for step in path])


def _levels_here(n: int, bits: int) -> int:
    """Levels that a superblock reduces of a tree with ``n`` nodes: all that are left, or as many as it has bits."""
    return min(bits, (int(n) - 1).bit_length())


def _block(bits: int) -> Column:
    return F.shiftright("position", bits).alias("block")


def _tops(nodes: DataFrame, bits: int) -> DataFrame:
    """(tree, n, position, digest) of the one node that each superblock of (tree, n, position, digest) comes to."""

    def top(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        n, digests = block["n"].iloc[0], block.sort_values("position")["digest"].tolist()
        node = reduce_levels(digests, _levels_here(n, bits))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "n": [-(-int(n) >> bits)], "position": [key[1]], "digest": [node]})

    return nodes.groupBy("tree", _block(bits)).applyInPandas(top, "tree bigint, n bigint, position bigint, digest string")


def _climb(nodes: DataFrame, bits: int, staging: Staging, name: str) -> tuple[DataFrame, DataFrame]:
    """From written nodes (tree, n, position, digest): each node's siblings up to the top of its tree as (tree, position, path),
    and (tree, digest) of the tops. As many rounds as superblocks are nested."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    if most <= 1:
        return nodes.select("tree", "position", F.array().cast("array<string>").alias("path")), nodes.select("tree", "digest")

    def siblings(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        levels = reduce_levels(block["digest"].tolist(), _levels_here(block["n"].iloc[0], bits))
        paths = [path_of(levels, i) for i in range(len(block))]
        return pd.DataFrame({"tree": key[0], "block": key[1], "position": block["position"], "path": paths})

    inner = nodes.groupBy("tree", _block(bits)).applyInPandas(siblings, "tree bigint, block bigint, position bigint, path array<string>")
    inner = staging.write(inner, f"{name}-paths")
    tops = staging.write(_tops(nodes, bits), f"{name}-tops")
    above, roots = _climb(tops, bits, staging, f"{name}-up")
    above = above.select("tree", F.col("position").alias("block"), F.col("path").alias("above"))
    return inner.join(above, ["tree", "block"]).select("tree", "position", F.concat("path", "above").alias("path")), roots


def manifest(
    docs: DataFrame,
    columns: list[str] | None = None,
    tree: str = "lang",
    order: str = "doc_id",
    presented: dict[str, Column] | None = None,
    bits: int = BITS,
    with_proof: bool = False,
    staging: Staging | None = None,
) -> DataFrame:
    """(``order``, leaf, subroot, root, proof_sha256, folded_root, verified), and ``proof`` on demand, one row per document.

    A leaf is the digest of ``columns``. Leaves of one value of ``tree`` are a tree, in the order of ``order``; null comes first,
    as a value of its own, among documents and among trees. Rows with one ``order`` value go by their leaf; equal rows have
    equal leaves and stand side by side. Other columns are ignored; an empty table gives no rows, and a null or empty text is
    a leaf like any other. ``presented`` replaces columns by what a reader of the dataset got: its leaf is folded with the
    siblings of the true manifest, and ``verified`` tells whether that leads to the true root.

    Only digests and keys are shuffled. A superblock has at most 2**``bits`` leaves, whatever the size of a tree.
    """
    staging = staging or Staging(docs.sparkSession)
    columns, presented = columns or LEAF_COLUMNS, presented or {}
    differs = F.lit(False)
    for c, value in presented.items():
        differs = differs | ~value.cast("string").eqNullSafe(F.col(c).cast("string"))
    shown = F.when(differs, leaf_digest([presented.get(c, F.col(c)) for c in columns]))
    # The texts are read once; ids of rows make places unique, so that no run of equal rows is one range.
    leaves = staging.write(docs.select(
        F.col(tree).alias("tree_value"), F.col(order).alias("order_value"), leaf_digest([F.col(c) for c in columns]).alias("digest"),
        shown.alias("shown"), F.monotonically_increasing_id().alias("row"),
    ), "leaves")
    frozen = freeze_in_order(leaves, ["tree_value", "order_value", "digest", "row"], staging, "frozen")
    numbered = number_rows(frozen, "number").withColumn("tree_key", F.coalesce(F.concat(F.lit("="), "tree_value"), F.lit("-")))
    trees = numbered.groupBy("tree_key", "tree_value").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    trees = number_rows(freeze_in_order(staging.write(trees, "counts"), ["tree_value"], staging, "ordered"), "tree")
    trees = staging.write(trees.select("tree_key", "tree", "first", "n", F.col("n").alias("weight")), "trees")
    placed = lookup(numbered, trees, "tree_key", how="inner", weight="weight")
    placed = staging.write(placed.select("tree", "n", (F.col("number") - F.col("first")).alias("position"), "order_value", "digest", "shown"), "placed")

    blocks = staging.write(_tops(placed.select("tree", "n", "position", "digest"), bits), "blocks")
    paths, subroots = _climb(blocks, bits, staging, "up")
    subroots = staging.write(subroots, "subroots")
    n_trees = subroots.count()
    forest = subroots.select(
        F.lit(0).cast("bigint").alias("tree"), F.lit(n_trees).cast("bigint").alias("n"), (F.col("tree") - 1).alias("position"), "digest")
    tree_paths, root = _climb(staging.write(forest, "forest"), bits, staging, "forest-up")
    tree_paths = tree_paths.select((F.col("position") + 1).alias("tree"), F.col("path").alias("tree_path"))
    top = root.first()  # one row, or none for an empty table
    outer = paths.withColumnRenamed("position", "block").join(tree_paths, "tree").join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    outer = outer.select("tree", "block", F.concat("path", "tree_path").alias("path"), "subroot", F.lit(top and top["digest"]).cast("string").alias("root"))
    outer = staging.write(outer, "outer")

    def finish(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, above = left.sort_values("position"), right.iloc[0]
        levels = reduce_levels(left["digest"].tolist(), _levels_here(left["n"].iloc[0], bits))
        outside, rows = list(above["path"]), []
        for i, (value, leaf, other) in enumerate(zip(left["order_value"], levels[0], left["shown"])):
            path = path_of(levels, i) + outside
            folded = fold(other if isinstance(other, str) else leaf, path)
            rows.append((value if isinstance(value, str) else None, leaf, above["subroot"], above["root"], proof_digest(path), folded, folded == above["root"], path if with_proof else None))
        return pd.DataFrame(rows, columns=["order_value", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"])

    # The order goes through pandas as text, where a null keeps integers whole.
    sides = placed.withColumn("order_value", F.col("order_value").cast("string")).withColumn("block", _block(bits))
    done = sides.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(
        finish,
        "order_value string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof array<string>",
    )
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", *(["proof"] if with_proof else [])]
    return done.select(F.col("order_value").cast(docs.schema[order].dataType).alias(order), *names)
