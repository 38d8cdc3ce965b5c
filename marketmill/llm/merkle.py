"""Merkle manifest of a dataset, its nodes stored in van Emde Boas order.

A leaf is the SHA-256 of a row's columns, each written as its length in bytes,
a colon and its value. The leaves of a source, in the order of their ids, are
the bottom of a tree in which FANOUT neighbours make one node; the roots of
the sources are the leaves of a tree of the same kind, whose root stands for
the dataset.

A tree is stored as blocks: aligned subtrees of BLOCK_LEVELS levels above
their leaves, one row each. The nodes of a block lie in van Emde Boas order:
the upper half of its levels, then each subtree of the lower half, each
ordered so in turn. `addresses` computes where the nodes of a level lie; both
construction and the retrieval of siblings go by it, and no pointers are
stored. The roots of the blocks are the leaves of the next tier, until a tree
has one block left.

1. Leaf digests are computed where the rows are read; only digests and ids
   are shuffled. They are sorted by ranges of source and id, numbered within
   their partition, and made numbers of the whole source by the counts of the
   partitions before it. A source of any size is spread over many tasks.
2. Each block is built from its own leaves, at most FANOUT ** BLOCK_LEVELS.
   Then tier after tier, then the tree of the sources by the same functions.
3. From the top down, each block gets the path of its root (what lies left
   and right of it, level by level) and gives each of its leaves its own.

Every step reads what the one before wrote to the shared folder.

Defined cases: a null column is written `-`, an empty text `0:`. Null sources
are one tree, which comes first; a null id comes first in its source. Rows
with the same id in a source are ordered by their leaf; equal rows are leaves
of their own with equal digests. A source with one row is its leaf. No rows
give no rows, and no root. Columns that are not named have no part in it.
"""

from __future__ import annotations

import hashlib
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from marketmill.llm.shared import prepare, stored

FANOUT = 16
#: Levels of a block above its leaves.
BLOCK_LEVELS = 3
BLOCK_LEAVES = FANOUT ** BLOCK_LEVELS
DIGEST = 32

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_PATH = "array<struct<left:string,right:string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


# -- a block ---------------------------------------------------------------

def nodes_of(levels: int) -> int:
    """Nodes of a full subtree with so many levels, leaves included."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes with these indices, `depth` levels below the root, lie in a subtree of `levels` levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    upper = levels // 2
    if depth < upper:
        return addresses(upper, depth, index)
    below = FANOUT ** (depth - upper)
    return nodes_of(upper) + index // below * nodes_of(levels - upper) + addresses(levels - upper, depth - upper, index % below)


def height_of(leaves: int) -> int:
    """Levels above so many leaves until one node remains."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // FANOUT), height + 1
    return height


def combined(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def build_block(leaves: list[str], height: int) -> bytes:
    """The nodes of a block in van Emde Boas order, up to the last that there is."""
    level, kept, ends = leaves, [], 0
    for step in range(height + 1):
        at = addresses(height + 1, height - step, np.arange(len(level)))
        kept.append((at, np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, DIGEST)))
        ends = max(ends, int(at.max()) + 1)
        level = [combined(level[k:k + FANOUT]) for k in range(0, len(level), FANOUT)]
    out = np.zeros((ends, DIGEST), np.uint8)
    for at, digests in kept:
        out[at] = digests
    return out.tobytes()


class Block:
    """The nodes of a block, read by address."""

    def __init__(self, nodes: bytes, leaves: int, height: int):
        self.nodes, self.leaves, self.height = nodes, leaves, height

    def read(self, step: int, first: int, last: int) -> list[str]:
        """Digests first..last - 1 of the level that is `step` above the leaves."""
        at = addresses(self.height + 1, self.height - step, np.arange(first, last)).tolist()
        return [self.nodes[a * DIGEST:(a + 1) * DIGEST].hex() for a in at]

    def run(self, step: int, index: int) -> list[str]:
        """The nodes that this one is combined with, itself included."""
        count = -(-self.leaves // FANOUT ** step)
        first = index // FANOUT * FANOUT
        return self.read(step, first, min(first + FANOUT, count))

    def paths(self):
        """For each leaf in turn its digest and its sides: the digests left and right of it, level by level."""
        above = [()]
        for step in reversed(range(self.height)):
            here = []
            for index in range(-(-self.leaves // FANOUT ** step)):
                if index % FANOUT == 0:
                    run = self.run(step, index)
                k = index % FANOUT
                here.append((("".join(run[:k]), "".join(run[k + 1:])), *above[index // FANOUT]))
            above = here
        return zip(self.read(0, 0, self.leaves), above)


def folded(digest: str, sides) -> str:
    """The root that a digest leads to."""
    for left, right in sides:
        digest = hashlib.sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


# -- trees -----------------------------------------------------------------

class Tree(NamedTuple):
    """Blocks by tier, the lowest first: tree, block, total (leaves of the tree in this tier), n, height, nodes, root; in the lowest also items and claims."""
    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """tree, root."""
        done = [t.where(F.col("total") <= BLOCK_LEAVES).select("tree", "root") for t in self.tiers]
        out = done[0]
        for more in done[1:]:
            out = out.unionAll(more)
        return out


class Manifest(NamedTuple):
    """The trees of the sources, the tree over them, and the root of the dataset (None without rows)."""
    sources: Tree
    top: Tree
    root: str | None


def numbered(leaves: DataFrame, name: str) -> DataFrame:
    """tree, item, digest, claim with rank (from 0, by item and digest) and total of each tree.

    Sorted ranges are numbered on their own; the counts of a tree's ranges, a
    row for each range, say where each begins.
    """
    kind = dict(leaves.dtypes)["item"]

    def run(batches):
        part, last, n = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for tree, group in groupby(batch.column(0).to_pylist()):
                size = sum(1 for _ in group)
                n = n if tree == last else 0
                places.append(np.arange(n, n + size))
                last, n = tree, n + size
            if places:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.concatenate(places))], ["tree", "item", "digest", "claim", "part", "place"])

    ordered = leaves.select("tree", "item", "digest", "claim").repartitionByRange("tree", "item", "digest").sortWithinPartitions("tree", "item", "digest")
    placed = stored(ordered.mapInArrow(run, f"tree string, item {kind}, digest binary, claim binary, part int, place long"), f"merkle-{name}")
    by_tree = Window.partitionBy("tree").orderBy("part")
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("n"))
    counts = counts.select(F.col("tree").alias("_tree"), F.col("part").alias("_part"), (F.sum("n").over(by_tree) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy("tree")).alias("total"))
    joined = placed.join(counts, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("part") == F.col("_part")))
    return joined.select("tree", "item", "digest", "claim", (F.col("before") + F.col("place")).alias("rank"), "total")


def _block_builder(extra: list[str]):
    """A group's leaves to its block; the columns named in `extra` become lists."""
    def build(table):
        table = table.sort_by("rank").combine_chunks()
        total, leaves = table["total"][0].as_py(), [d.hex() for d in table["digest"].to_pylist()]
        height = BLOCK_LEVELS if total > BLOCK_LEAVES else height_of(total)
        nodes = build_block(leaves, height)
        columns = {
            "tree": table["tree"].slice(0, 1), "block": pa.array([table["rank"][0].as_py() // BLOCK_LEAVES]), "total": table["total"].slice(0, 1), "n": pa.array([len(leaves)], pa.int32()),
            "height": pa.array([height], pa.int32()), "nodes": pa.array([nodes]), "root": pa.array([nodes[:DIGEST]]),  # a block's root has address 0
        }
        for c in extra:
            values = table[c].combine_chunks()
            columns[f"{c}s"] = pa.ListArray.from_arrays(pa.array([0, len(leaves)], pa.int32()), values)
        return pa.table(columns)

    return build


def build_tree(ranked: DataFrame, name: str) -> Tree:
    """The blocks of all trees, tier by tier. ranked: tree, item, digest, claim, rank, total."""
    tiers = []
    rows = ranked
    while True:
        kind = dict(rows.dtypes).get("item")
        extra = [] if kind is None else ["item", "claim"]
        schema = "tree string, block long, total long, n int, height int, nodes binary, root binary" + (f", items array<{kind}>, claims array<binary>" if extra else "")

        keyed = rows.withColumn("block", F.floor(F.col("rank") / F.lit(BLOCK_LEAVES)))
        blocks = stored(keyed.groupBy("tree", "block").applyInArrow(_block_builder(extra), schema), f"merkle-{name}")
        tiers.append(blocks)
        more = blocks.where(F.col("total") > BLOCK_LEAVES)
        if more.isEmpty():
            return Tree(tiers)
        rows = more.select("tree", F.col("block").alias("rank"), F.ceil(F.col("total") / F.lit(BLOCK_LEAVES)).alias("total"), F.col("root").alias("digest"))


def written(name: str, value: Column | None = None) -> Column:
    """A column as it is hashed: its length in bytes, a colon and its value, or a dash."""
    text = (F.col(name) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns=COLUMNS, **instead: Column) -> Column:
    """The leaf of a row; `instead` has other values for some columns."""
    return F.sha2(F.concat(*[written(c, instead.get(c)) for c in columns]), 256)


def build_manifest(docs: DataFrame, columns=COLUMNS, id_col: str = "doc_id", group_col: str = "source", claimed: Column | None = None) -> Manifest:
    """The manifest of a table. claimed: for each row the leaf that is later held against it (null: its own)."""
    prepare(docs.sparkSession)
    claim = F.lit(None).cast("binary") if claimed is None else F.unhex(claimed)
    leaves = docs.select(F.col(group_col).cast("string").alias("tree"), F.col(id_col).alias("item"), F.unhex(leaf_digest(columns)).alias("digest"), claim.alias("claim"))
    sources = build_tree(numbered(stored(leaves, "merkle-leaves"), "numbered"), "blocks")
    names = sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("item"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("claim"))
    top = build_tree(numbered(names, "sources"), "top")
    root = top.roots().first()
    return Manifest(sources, top, root and root.root.hex())


# -- paths -----------------------------------------------------------------

def _with_paths(tree: Tree, above: DataFrame) -> DataFrame:
    """The lowest blocks of a tree with `path`, the sides of their root up to the root of the dataset. above: tree, path."""
    above = above.select(F.col("tree").alias("_tree"), "path")
    came = None
    for tier in reversed(tree.tiers):
        joined = tier.where(F.col("total") <= BLOCK_LEAVES).join(above, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        if came is not None:
            inner = tier.where(F.col("total") > BLOCK_LEAVES).join(came, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block"))).drop("_tree", "_block")
            joined = joined.unionByName(inner)
        if tier is tree.tiers[0]:
            return joined

        def run(batches):
            for batch in batches:
                for tree_, block, n, height, nodes, path in zip(*(c.to_pylist() for c in batch.columns)):
                    rest = tuple((p["left"], p["right"]) for p in path)
                    sides = [own + rest for _, own in Block(nodes, n, height).paths()]
                    yield pa.RecordBatch.from_arrays([pa.array([tree_] * n, pa.string()), pa.array(np.arange(n) + block * BLOCK_LEAVES), pa.array([[{"left": l, "right": r} for l, r in s] for s in sides], _SIDES)], ["_tree", "_block", "path"])

        came = joined.select("tree", "block", "n", "height", "nodes", "path").mapInArrow(run, f"_tree string, _block long, path {_PATH}")


def source_paths(manifest: Manifest) -> DataFrame:
    """source, subroot, path: the sides of each source's root up to the root of the dataset."""
    top = manifest.top.tiers[-1].where(F.col("total") <= BLOCK_LEAVES).select("tree", F.array().cast(_PATH).alias("path"))
    lowest = _with_paths(manifest.top, top)

    def run(batches):
        for batch in batches:
            for items, n, height, nodes, path in zip(*(c.to_pylist() for c in batch.columns)):
                rest = tuple((p["left"], p["right"]) for p in path)
                found = list(Block(nodes, n, height).paths())
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array([d for d, _ in found]), pa.array([[{"left": l, "right": r} for l, r in own + rest] for _, own in found], _SIDES)], ["source", "subroot", "path"])

    return lowest.select("items", "n", "height", "nodes", "path").mapInArrow(run, f"source string, subroot string, path {_PATH}")


def proofs(manifest: Manifest) -> DataFrame:
    """For each leaf: id, source, leaf, subroot, root, proof_sha256 (its siblings, level by level), folded_root (of its claim, else of itself), verified."""
    kind = manifest.sources.tiers[0].schema["items"].dataType.elementType
    schema = f"id {kind.simpleString()}, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if manifest.root is None:
        return manifest.sources.tiers[0].sparkSession.createDataFrame([], schema)
    above = stored(source_paths(manifest), "merkle-paths")
    lowest = _with_paths(manifest.sources, above.select(F.col("source").alias("tree"), "path"))
    subroots = above.select(F.col("source").alias("_source"), "subroot")
    lowest = lowest.join(subroots, F.col("tree").eqNullSafe(F.col("_source")))
    root = manifest.root

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                tree, n, height, nodes, path, subroot, claims = (batch.column(c)[k].as_py() for c in range(7))
                rest = [(p["left"], p["right"]) for p in path]
                shared = "".join(left + right for left, right in rest)
                ends: dict[str, str] = {}
                leaves, hashes, reached = [], [], []
                for (leaf, own), claim in zip(Block(nodes, n, height).paths(), claims):
                    top = folded(leaf if claim is None else claim.hex(), own)
                    if top not in ends:
                        ends[top] = folded(top, rest)
                    leaves.append(leaf)
                    hashes.append(hashlib.sha256(("".join(left + right for left, right in own) + shared).encode()).hexdigest())
                    reached.append(ends[top])
                same = lambda value: pa.array([value] * n, pa.string())
                yield pa.RecordBatch.from_arrays([
                    batch.column(7)[k].values, same(tree), pa.array(leaves), same(subroot), same(root), pa.array(hashes), pa.array(reached), pa.array([r == root for r in reached]),
                ], ["id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return lowest.select("tree", "n", "height", "nodes", "path", "subroot", "claims", "items").mapInArrow(run, T._parse_datatype_string(schema))


#: Every so manieth document, by the checksum of its id, is tampered with to see whether its proof fails.
TAMPERED = 5


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proof of every document, and whether it holds for the document or, where it is tampered with, for its lower-cased text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    found = proofs(build_manifest(docs, claimed=F.when(chosen, leaf_digest(text=F.translate("text", *_LETTERS)))))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _part(name: str, value: str | None = None) -> str:
    value = value or name
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_LEAF = " || ".join(_part(c) for c in COLUMNS)
_LOWERED = " || ".join(_part(c, f"translate(text, '{_LETTERS[0]}', '{_LETTERS[1]}')" if c == "text" else None) for c in COLUMNS)
OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i)
), d AS (
  SELECT doc_id, source, sha256({_LEAF}) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % {TAMPERED} = 0 THEN sha256({_LOWERED}) END AS claim
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d
), nodes AS (
  SELECT source, 0 AS level, i, n, leaf AS h FROM ranked
  UNION ALL
  SELECT source, level + 1, i // {FANOUT}, max(n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY source, level, i // {FANOUT}
), subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), top AS (
  SELECT 0 AS level, i, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, i // {FANOUT}, max(n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // {FANOUT}
), runs AS (
  SELECT source, level, i // {FANOUT} AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, i // {FANOUT} AS run, list(h ORDER BY i) AS hs FROM top WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT r.source, r.i AS leaf_i, level, hs, (r.i // CAST(pow({FANOUT}, level) AS BIGINT)) % {FANOUT} AS k
  FROM ranked r JOIN runs ON r.source IS NOT DISTINCT FROM runs.source AND run = r.i // CAST(pow({FANOUT}, level + 1) AS BIGINT)
), top_steps AS (
  SELECT source, level, hs, (s.i // CAST(pow({FANOUT}, level) AS BIGINT)) % {FANOUT} AS k
  FROM subroots s JOIN top_runs ON run = s.i // CAST(pow({FANOUT}, level + 1) AS BIGINT)
), path AS (
  SELECT source, leaf_i, list(array_to_string(hs[:k], '') || '|' || array_to_string(hs[k + 2:], '') ORDER BY level) AS sides FROM steps GROUP BY ALL
), top_path AS (
  SELECT source, list(array_to_string(hs[:k], '') || '|' || array_to_string(hs[k + 2:], '') ORDER BY level) AS sides FROM top_steps GROUP BY ALL
), whole AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(r.claim, r.leaf) AS claim, list_concat(coalesce(p.sides, []), coalesce(t.sides, [])) AS sides
  FROM ranked r JOIN subroots s ON r.source IS NOT DISTINCT FROM s.source
  LEFT JOIN path p ON r.source IS NOT DISTINCT FROM p.source AND r.i = p.leaf_i LEFT JOIN top_path t ON r.source IS NOT DISTINCT FROM t.source
), done AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(sides, ''), '|', '')) AS proof_sha256,
    list_reduce(list_concat([claim], sides), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root FROM whole
)
SELECT *, folded_root = root AS verified FROM done
"""
