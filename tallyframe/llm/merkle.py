"""Merkle dataset manifest (operator 12).

Method: a persistent tree with path copying. The rows of a group are leaves in order; runs of WIDTH nodes have
one parent, level by level, up to the group's subroot, and the subroots' tree ends in the root. A tampered leaf
makes a version of the tree that shares every node but the leaf's ancestors, which are copied.

The tree is cut into aligned blocks of WIDTH ** HEIGHT leaves. A task builds one block and gives its root, which
is a leaf of the blocks above, and so on up to one node per group; a tree of n leaves takes log(n) / log(4096)
stages. On the way down each block learns the one path from its own root to the root, so a version copies its
ancestors inside the block and goes on along that path. No row but leaves, block roots and paths is shuffled, no task
holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import cut_lineage, with_package
from tallyframe.llm.sharding import numbered

#: Children of a node, and levels of a block: 8 ** 4 leaves.
WIDTH, HEIGHT = 8, 4
#: Frames of at most so many rows (two numbers and a key each) may be broadcast.
SMALL = 1 << 16

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<slot:int,others:string>>"
_PATH = pa.list_(pa.struct([("slot", pa.int32()), ("others", pa.string())]))

Level = list[str]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def built(leaves: Level, height: int | None) -> list[Level]:
    """A block's levels from its leaves up; ``height`` levels above them, or, where it is None, up to one node."""
    levels = [leaves]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + WIDTH])) for i in range(0, len(below), WIDTH)])
    return levels


def upward(levels: list[Level], at: int) -> list[tuple[int, str]]:
    """A node's path through its block: its slot in each run, and the run's other digests, end to end."""
    path = []
    for level in levels[:-1]:
        slot, first = at % WIDTH, at - at % WIDTH
        run = level[first : first + WIDTH]
        path.append((slot, "".join(run[:slot] + run[slot + 1 :])))
        at //= WIDTH
    return path


def copied(leaf: str, path: list[tuple[int, str]]) -> list[str]:
    """The nodes of a version of its own: the changed leaf and its ancestors. All others are shared."""
    nodes = [leaf]
    for slot, others in path:
        nodes.append(digest(others[: 64 * slot] + nodes[-1] + others[64 * slot :]))
    return nodes


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row's values: each ``-`` if null, else its UTF-8 length, a colon and itself."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def positions(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows (key, ``values`` and n, equal rows counted) one by one, with ``at``, their place within their key in order
    of ``values``, and ``of``, the key's rows.

    Rows are dealt by ranges of (key, values) and counted where they are; a range starts where those before it end, which
    is known from one number per range and key. Reruns of a task see the same ranges, which are written once."""
    order = [F.col(c).asc_nulls_first() for c in ("key", *values)]
    ranges = cut_lineage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()))
    schema = ranges.schema

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, 0
        for batch in batches:
            before = []
            for own, n in zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if own != key:
                    key, total = own, 0
                before.append(total)
                total += n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(before, pa.int64())], names=[*batch.schema.names, "before"])

    inside = ranges.mapInArrow(counted, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields) + ", before long")
    sums = cut_lineage(ranges.groupBy("key", "range").agg(F.sum("n").alias("rows")))
    over = Window.partitionBy("key")
    earlier = F.coalesce(F.sum("rows").over(over.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("key", "range", earlier.alias("start"), F.sum("rows").over(over).alias("of"))
    if sums.count() <= SMALL:
        starts = F.broadcast(starts)
    placed = numbered(inside.join(starts, ["key", "range"]), "copy")
    return placed.select("key", *values, (F.col("start") + F.col("before") + F.col("copy") - 1).alias("at"), "of")


@dataclass
class Stage:
    """Nodes (key, at, digest, of) that are the leaves of one row of blocks of ``height``, and all their columns."""

    nodes: DataFrame
    height: int

    def blocks(self):
        return self.nodes.withColumn("block", F.floor(F.col("at") / WIDTH**self.height)).groupBy("key", "block")


def _levels(table: pa.Table, height: int) -> tuple[pa.Table, list[Level]]:
    """A block's nodes in order and its levels: of blocks in a row of several all, of one that is alone up to one node."""
    table = table.sort_by("at")
    return table, built(table.column("digest").to_pylist(), height if table.column("of")[0].as_py() > WIDTH**height else None)


def stages(leaves: DataFrame, height: int) -> tuple[list[Stage], DataFrame]:
    """All rows of blocks from the leaves (key, at, of, digest) up, and one node (key, digest) for each key."""

    def root(key: tuple, table: pa.Table) -> pa.Table:
        _, levels = _levels(table, height)
        of = -(-table.column("of")[0].as_py() // WIDTH**height)
        return pa.table({"key": [key[0].as_py()], "at": pa.array([key[1].as_py()], pa.int64()), "digest": levels[-1], "of": pa.array([of], pa.int64())})

    done = [Stage(leaves, height)]
    while True:
        above = cut_lineage(done[-1].blocks().applyInArrow(root, "key string, at long, digest string, of long"))
        if above.where("of > 1").isEmpty():
            return done, above.select("key", "digest")
        done.append(Stage(above, height))


def down(stage: Stage, paths: DataFrame, work: Callable[[pa.Table, list[Level], list[tuple[int, str]]], pa.Table], schema: str) -> DataFrame:
    """``work`` on each block of a stage: its nodes in order, its levels and the path (key, block, path) from its root on."""
    height = stage.height

    def both(key: tuple, nodes: pa.Table, path: pa.Table) -> pa.Table:
        nodes, levels = _levels(nodes, height)
        return work(nodes, levels, [(step["slot"], step["others"]) for step in path.column("path")[0].as_py()])

    return stage.blocks().cogroup(paths.groupBy("key", "block")).applyInArrow(both, schema)


def _path_rows(nodes: pa.Table, levels: list[Level], rest: list[tuple[int, str]]) -> pa.Table:
    paths = [[{"slot": s, "others": o} for s, o in upward(levels, i) + rest] for i in range(len(nodes))]
    return pa.table({"key": nodes.column("key"), "at": nodes.column("at"), "path": pa.array(paths, _PATH)})


def paths_down(done: list[Stage], tops: DataFrame) -> DataFrame:
    """Paths (key, block, path) of the blocks of the lowest stage, from those of each key's top (key, path)."""
    paths = tops.select("key", F.lit(0).cast("long").alias("block"), "path")
    for stage in reversed(done[1:]):
        paths = cut_lineage(down(stage, paths, _path_rows, f"key string, at long, path {PATH}").select("key", F.col("at").alias("block"), "path"))
    return paths


@dataclass
class Manifest:
    """A tree: its leaves' stages, subroots (key, subroot), root (one row) and the paths (key, block, path) of blocks
    of leaves, where a path names at each level the slot and the other digests of a run."""

    done: list[Stage]
    subroots: DataFrame
    root: str | None
    paths: DataFrame

    def _rows(self, work: Callable, schema: str) -> DataFrame:
        return down(self.done[0], self.paths, work, schema)

    def proofs(self) -> DataFrame:
        """Per row: key, id, leaf, proof_sha256 and folded_root (from the changed leaf, if there is one, and the original siblings)."""

        def work(nodes: pa.Table, levels: list[Level], rest: list[tuple[int, str]]) -> pa.Table:
            proofs, folded = [], []
            tail = "".join(others for _, others in rest)
            for i, (leaf, changed) in enumerate(zip(levels[0], nodes.column("changed").to_pylist(), strict=True)):
                own = upward(levels, i)
                proofs.append(digest("".join(others for _, others in own) + tail))
                folded.append(copied(changed or leaf, own + rest)[-1])
            return pa.table({"key": nodes.column("key"), "id": nodes.column("id"), "leaf": nodes.column("digest"), "proof_sha256": proofs, "folded_root": folded})

        return self._rows(work, "key string, id long, leaf string, proof_sha256 string, folded_root string")

    def versions(self) -> DataFrame:
        """The nodes that the version of each changed leaf has of its own: key, id, at (the leaf's place), level (0: the
        leaf), node (its place in that level of the key's tree; null above the subroot) and digest."""

        def work(nodes: pa.Table, levels: list[Level], rest: list[tuple[int, str]]) -> pa.Table:
            out = []
            height, left = 0, nodes.column("of")[0].as_py()
            while left > 1:
                height, left = height + 1, -(-left // WIDTH)
            for i, (leaf, changed) in enumerate(zip(levels[0], nodes.column("changed").to_pylist(), strict=True)):
                if changed and changed != leaf:
                    at = nodes.column("at")[i].as_py()
                    for level, node in enumerate(copied(changed, upward(levels, i) + rest)):
                        out.append((nodes.column("key")[i].as_py(), nodes.column("id")[i].as_py(), at, level, at // WIDTH**level if level <= height else None, node))
            types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            return pa.table([pa.array([row[k] for row in out], t) for k, t in enumerate(types)], names=["key", "id", "at", "level", "node", "digest"])

        return self._rows(work, "key string, id long, at long, level int, node long, digest string")


def manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The tree of rows (key, id, leaf, changed: the changed leaf or null). Within a key leaves ascend by id, then by leaf;
    equal rows are as many leaves. Keys are in the order of their bytes."""
    with_package(rows.sparkSession)
    counted = rows.groupBy("key", "id", "leaf", "changed").agg(F.count("*").alias("n"))
    leaves = cut_lineage(positions(counted, ["id", "leaf", "changed"]).withColumnRenamed("leaf", "digest"))
    done, subroots = stages(leaves, height)
    one = subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), "digest", F.lit(1).cast("long").alias("n"))
    upper, top = stages(cut_lineage(positions(one, ["name", "digest"])), height)
    root = top.select("digest").first()
    start = top.select("key", F.array().cast(PATH).alias("path"))
    over = cut_lineage(down(upper[0], paths_down(upper, start), _named_paths, f"key string, path {PATH}"))
    return Manifest(done, subroots.withColumnRenamed("digest", "subroot"), root and root["digest"], paths_down(done, over))


def _named_paths(nodes: pa.Table, levels: list[Level], rest: list[tuple[int, str]]) -> pa.Table:
    rows = _path_rows(nodes, levels, rest)
    return pa.table({"key": nodes.column("name"), "path": rows.column("path")})


def key_of(group: Column) -> Column:
    """A group's value as a key that is never null and has its order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def document_rows(documents: DataFrame) -> DataFrame:
    """key, id, leaf and changed of documents: the group is ``lang``, and where 3 divides the CRC-32 of a doc_id the
    changed leaf has the text with A-Z lower-cased."""
    names = [F.col(c) for c in FIELDS]
    # texts are lower-cased only where they are tampered with
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(tampered, leaf_digest([*names[:-1], lowered]))
    return documents.select(key_of(F.col("lang")).alias("key"), F.col("doc_id").cast("long").alias("id"), leaf_digest(names).alias("leaf"), changed.alias("changed"))


def document_manifest(documents: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and lang of each row.

    leaf: digest of the row's five columns; subroot: that of its lang; proof_sha256: digest of its siblings, level by
    level; folded_root: the root of the row's own version, which lower-cases its text where 3 divides the CRC-32 of the
    doc_id; verified: that this is the root.

    Null cells count as ``-`` in a leaf, so they differ from empty ones; a null lang is a group of its own, the first. A
    null doc_id comes first in its group and isn't tampered with. Rows that share a doc_id are in order of their leaves; equal
    rows are leaves of their own, so that their proofs differ. Columns beside the five aren't read, whatever their names. A
    lone leaf is its subroot, a lone subroot the root; no rows give no rows."""
    tree = manifest(document_rows(documents), height)
    rows = tree.proofs()
    subroots = tree.subroots.withColumn("root", F.lit(tree.root).cast("string"))
    if tree.subroots.count() <= SMALL:
        subroots = F.broadcast(subroots)
    lang = F.when(F.col("key") != "", F.expr("substring(key, 2)"))
    return rows.join(subroots, "key").select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), lang.alias("lang"))
