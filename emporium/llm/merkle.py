"""Merkle manifest of a dataset, with checkpointed levels and recomputed proofs.

Tree.  A row is a leaf, the SHA-256 of its fields; the rows of one group (a
language) form a tree of arity 8 in id order, and the trees' roots, in the order
of the group names, form one more.

Checkpoint and recompute.  Of the levels of a tree only every third is stored:
one group of ``SPAN`` = 512 adjacent nodes is an aligned subtree, and its top is
the next stored node.  A proof needs the siblings on all levels.  They are made
again per aligned subtree: the one task that holds its 512 stored descendants
hashes the two levels in between, writes the siblings of each descendant and
forgets them.  Above an aligned subtree all its rows share one path, which was
made in the same way one stored level higher.  So a manifest of n rows holds
n + n / 512 + ... nodes, and no task ever holds more than 512 of them.

Positions.  Rows are dealt by range of (group, id, leaf), numbered within their
partition, and the partitions' counts, a few numbers each, are added up.  So a
group with most of the rows is dealt over all tasks.

Defined results: a null field is ``-``, any other its length in UTF-8 bytes, a
colon and its text, so no two rows look alike; null groups are one group, the
first; null ids come first within a group, equal ids in the order of their
leaves, so repeated rows have equal leaves at adjacent places and a proof each.
Long and empty texts are hashed whole.  A tree of one row is its own root; an
empty table has no trees and gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.llm.common import stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
STRIDE = 3  # levels between stored ones
SPAN = ARITY**STRIDE


def leaf_of(*fields: str | Column) -> Column:
    """Hex SHA-256 of the fields of a row."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def ranked(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``pos``, a row's place (from 0) within its group, and
    ``width``, the rows of the group; nulls are one group and come first."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    placed = stored(placed, name)
    part = F.shiftright("__at", 33)
    runs = placed.groupBy(F.col(group).alias("__group"), part.alias("__part")).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    of_group = Window.partitionBy("__group")
    before = F.sum("__rows").over(of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("__group", "__part", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__rows").over(of_group).alias("width"))
    both = placed.join(runs, F.col(group).eqNullSafe(F.col("__group")) & (part == F.col("__part")))
    return both.select(*df.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("pos"), "width")


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def regrown(nodes: list[str], alone: bool) -> list[list[str]]:
    """The levels over the nodes of an aligned subtree, up to the next stored
    one; a tree that fits into it ends at its root."""
    levels = [nodes]
    while len(levels) <= STRIDE and not (alone and len(levels[-1]) == 1):
        last = levels[-1]
        levels.append([_hash(last[i : i + ARITY]) for i in range(0, len(last), ARITY)])
    return levels


def siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands left and right of the path of node ``i``, level by level."""
    left, right = [], []
    for level in levels[:-1]:
        first = i // ARITY * ARITY
        left.append("".join(level[first:i]))
        right.append("".join(level[i + 1 : first + ARITY]))
        i //= ARITY
    return left, right


def _subtrees(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Aligned subtrees of a stored level: (tree, sub, width, nodes in order)."""
    row = F.struct("pos", F.unhex("digest").alias("digest"), *carried)
    groups = nodes.groupBy("tree", F.expr(f"pos div {SPAN}").alias("sub"), "width")
    return groups.agg(F.sort_array(F.collect_list(row)).alias("nodes"))


def _climbed(nodes: DataFrame) -> DataFrame:
    """The next stored level: one node per aligned subtree."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for nodes, width in zip(batch.column("nodes"), batch.column("width").to_pylist(), strict=True):
                held = [x.hex() for x in nodes.values.field("digest").to_pylist()]
                digests.append(regrown(held, width <= SPAN)[-1][0])
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("sub"), pa.array(digests, pa.string()), batch.column("width")], names=["tree", "pos", "digest", "width"])

    above = _subtrees(nodes).mapInArrow(tops, "tree long, pos long, digest string, width long")
    return above.withColumn("width", F.expr(f"(width + {SPAN - 1}) div {SPAN}"))


def _levels(bottom: DataFrame, widest: int, name: str) -> list[DataFrame]:
    """The stored levels over ``bottom`` (tree, pos, digest, width).  A tree
    leaves off at its root, the node of width 1."""
    levels = [bottom]
    while widest > 1:
        levels.append(stored(_climbed(levels[-1].where("width > 1")), f"{name}-level"))
        widest = -(-widest // SPAN)
    return levels


def _paths(nodes: DataFrame, above: DataFrame | None, roofs: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Per node of a stored level its path: (tree, pos, digest, subroot, lefts,
    rights and ``carried``).  ``above`` has the paths of the next stored level,
    ``roofs`` (tree, subroot, lefts, rights) those of the trees' roots."""
    fixed = [f for f in nodes.schema.fields if f.name in carried]
    columns = ["tree long", "pos long", "digest string", "subroot string", "lefts array<string>", "rights array<string>"]
    columns += [f"{f.name} {f.dataType.simpleString()}" for f in fixed]
    alone = nodes.where("width = 1").join(roofs, "tree").select("tree", "pos", "digest", "subroot", "lefts", "rights", *carried)
    if above is None:
        return alone
    strings = pa.list_(pa.string())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at] for n in ("tree", "width", "nodes", "subroot", "lefts", "rights")}
                held = row["nodes"].values
                digests = [x.hex() for x in held.field("digest").to_pylist()]
                levels = regrown(digests, row["width"].as_py() <= SPAN)
                upper = row["lefts"].as_py(), row["rights"].as_py()
                lefts, rights = zip(*(siblings(levels, i) for i in range(len(digests))), strict=True)
                n = len(digests)
                arrays = [pa.array([row["tree"].as_py()] * n, pa.int64()), held.field("pos"), pa.array(digests, pa.string()), pa.array([row["subroot"].as_py()] * n, pa.string())]
                arrays += [pa.array([x + upper[0] for x in lefts], strings), pa.array([x + upper[1] for x in rights], strings)]
                yield pa.RecordBatch.from_arrays([*arrays, *(held.field(f.name) for f in fixed)], names=[c.split()[0] for c in columns])

    roofed = above.select(F.col("tree").alias("__tree"), F.col("pos").alias("__sub"), "subroot", "lefts", "rights")
    groups = _subtrees(nodes.where("width > 1"), carried)
    full = groups.join(roofed, (F.col("tree") == F.col("__tree")) & (F.col("sub") == F.col("__sub")))
    return alone.unionByName(full.select("tree", "width", "nodes", "subroot", "lefts", "rights").mapInArrow(walk, ", ".join(columns)))


def _walked_down(levels: list[DataFrame], roofs: DataFrame, carried: Sequence[str] = (), name: str = "merkle") -> DataFrame:
    """Paths of the lowest level; those of the higher ones, a 512th and less, are stored."""
    above = None
    for level in reversed(levels[1:]):
        above = stored(_paths(level, above, roofs), f"{name}-paths")
    return _paths(levels[0], above, roofs, carried)


def _roots(levels: list[DataFrame]) -> DataFrame:
    tops = [x.where("width = 1").select("tree", "digest") for x in levels]
    out = tops[0]
    for x in tops[1:]:
        out = out.unionByName(x)
    return out


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the trees and of the tree over their roots; the root is
    null for an empty table."""

    levels: list[DataFrame]
    roof_levels: list[DataFrame]
    root: str | None
    group: str
    carried: tuple[str, ...]


def build(docs: DataFrame, group: str = "lang", order: Sequence[str] = ("doc_id",), fields: Sequence[str] = FIELDS, carried: Sequence[str] = ()) -> Manifest:
    """Hash every row of ``docs`` and store the manifest's levels in the shared
    folder.  ``carried`` columns go along with the leaves; texts do not."""
    own = [group, *order]
    rows = docs.select(*dict.fromkeys([*own, *carried]), leaf_of(*fields).alias("digest"))
    placed = ranked(stored(rows, "merkle-leaves"), group, [*order, "digest"], "merkle-ranked")
    names = placed.groupBy(F.col(group).alias("__name")).agg(F.max("width").alias("__width")).withColumn("__all", F.lit(0))
    trees = stored(ranked(names, "__all", ["__name"], "merkle-names").select("__name", "__width", F.col("pos").alias("tree"), F.col("width").alias("__trees")), "merkle-trees")
    widest, n_trees = trees.agg(F.max("__width"), F.max("__trees")).first()
    kept = list(dict.fromkeys([*own, *carried]))
    bottom = placed.join(trees.select("__name", "tree"), F.col(group).eqNullSafe(F.col("__name"))).select("tree", "pos", "digest", "width", *kept)
    bottom = stored(bottom, "merkle-level")
    levels = _levels(bottom, widest or 0, "merkle")
    subroots = _roots(levels).select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest", F.lit(n_trees or 0).cast("long").alias("width"))
    roof_levels = _levels(stored(subroots, "merkle-roof"), n_trees or 0, "merkle-roof")
    root = _roots(roof_levels).first()
    return Manifest(levels, roof_levels, root["digest"] if root else None, group, tuple(kept))


def proofs(manifest: Manifest) -> DataFrame:
    """One row per row of the table: (tree, pos, digest, subroot, lefts, rights,
    the group and order columns and the carried ones).  ``lefts`` and ``rights``
    hold, level by level up to the root, what stands on either side of the path,
    as concatenated hex digests."""
    nothing = F.array().cast("array<string>")
    above_all = manifest.roof_levels[-1].where("width = 1").select("tree", F.col("digest").alias("subroot"), nothing.alias("lefts"), nothing.alias("rights"))
    roofs = _walked_down(manifest.roof_levels, above_all, name="merkle-roof")
    roofs = stored(roofs.select(F.col("pos").alias("tree"), F.col("digest").alias("subroot"), "lefts", "rights"), "merkle-roof-paths")
    return _walked_down(manifest.levels, roofs, manifest.carried)


def proof_digest() -> Column:
    """SHA-256 of the siblings of a row of ``proofs``, bottom-up, left to right."""
    sides = F.zip_with("lefts", "rights", lambda a, b: F.concat(a, b))
    return F.sha2(F.array_join(sides, "").cast("binary"), 256)


def folded(leaf: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of a row of ``proofs``."""
    return F.aggregate(F.arrays_zip("lefts", "rights"), leaf, lambda node, side: F.sha2(F.concat(side["lefts"], node, side["rights"]).cast("binary"), 256))
