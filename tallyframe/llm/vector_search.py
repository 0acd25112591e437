"""Exact search for the vectors of largest inner product (operator 7).

Method: dual-tree search over cover trees. Data and queries are both indexed: each node has a centre and
the radius that covers its vectors, and children cover it by smaller radii. For a query node with centre a
and radius r and a data node with centre b and radius s, no pair scores above a.b + |a| s + |b| r + r s;
where that is below the worst kth score of the node's queries, the pair of nodes is left out.

The upper levels of the data's tree are shared: centres from a bounded sample cut all vectors into cells, and
centres within each large cell cut it into blocks, each with its own centre and radius. Queries go in groups of
one block: a group searches its own block first; with the kth scores found there it goes only to blocks whose
bound reaches the worst of them, and takes along only the queries whose own bound does. Equal vectors are searched
once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import cut_lineage, hash_sample, with_package

#: Vectors that the centres are chosen from; cells, and blocks of a cell, at most; and vectors of a block, about. A
#: block that comes out larger (beyond CELLS * WITHIN * BLOCK vectors all may) is cut by hash into parts of one radius.
SAMPLE, CELLS, WITHIN, BLOCK = 16_384, 256, 64, 4096
#: Parts of the rows that share a vector.
SALTS = 64
#: Vectors of a leaf, children of a node, and how much smaller a child's radius should be.
LEAF, FANOUT, SHRINK = 96, 8, 0.7
#: Queries of a group, about.
TOGETHER = 512


def pack(rows: np.ndarray) -> list[bytes]:
    """Vectors of whole numbers as bytes, without loss: 4 bytes a number where all are small."""
    small = (np.abs(rows) < 1 << 24).all(axis=1) if len(rows) else []
    return [(b"\4" + r.astype("<f4").tobytes()) if s else (b"\10" + r.astype("<f8").tobytes()) for r, s in zip(rows, small, strict=True)]


def unpack(values: list[bytes]) -> np.ndarray:
    """Rows of float64; shorter vectors are filled up with zeros."""
    rows = [np.frombuffer(v, "<f4" if v[0] == 4 else "<f8", offset=1) for v in values]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both with as many columns as the wider one."""
    n = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, n - x.shape[1]))) for x in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: in float64 while they fit, else in Python's integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    exact = [np.array([[int(x) for x in row] for row in m], object) for m in (a, b)]
    limit = (1 << 63) - 1
    return np.array([[max(-limit, min(limit, int(x))) for x in row] for row in exact[0] @ exact[1].T], np.int64).reshape(len(a), len(b))


def farthest_first(rows: np.ndarray, most: int, radius: float = 0.0) -> list[int]:
    """Row numbers that cover the rows within ``radius``, or ``most`` of them: each next one is the row
    farthest from those chosen, so centres are apart by more than they cover."""
    chosen = [0]
    far = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < most and (i := int(far.argmax())) not in chosen and far[i] > radius**2:
        chosen.append(i)
        far = np.minimum(far, ((rows - rows[i]) ** 2).sum(axis=1))
    return chosen


class Node:
    """A cover-tree node: its vectors' numbers (leaves), centre, covering radius and children."""

    __slots__ = ("centre", "children", "members", "norm", "radius")

    def __init__(self, rows: np.ndarray, members: np.ndarray):
        own = rows[members]
        self.centre = own.mean(axis=0)
        distance = np.sqrt(((own - self.centre) ** 2).sum(axis=1))
        self.radius, self.norm = float(distance.max()), float(np.sqrt((self.centre**2).sum()))
        self.members, self.children = members, []
        if len(members) > LEAF and self.radius > 0:
            centres = own[farthest_first(own, FANOUT, self.radius * SHRINK)]
            nearest = ((own**2).sum(axis=1)[:, None] - 2 * own @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)
            if len(set(nearest.tolist())) > 1:
                self.children = [Node(rows, members[nearest == k]) for k in np.unique(nearest)]


class Best:
    """The k best of each query so far: scores descending, then ids ascending."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.astype(np.float64)
        self.scores = np.full((n, k), -(1 << 63), np.int64)
        self.ids = np.full((n, k), (1 << 63) - 1, np.int64)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores >= self.floor[queries][:, None]).any(axis=1)
        queries, scores = queries[some], scores[some]
        if not len(queries):
            return
        every = np.concatenate([self.scores[queries], scores], axis=1)
        names = np.concatenate([self.ids[queries], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((names, -every.astype(np.float64), ~every), axis=1)[:, : self.k]
        self.scores[queries] = np.take_along_axis(every, order, axis=1)
        self.ids[queries] = np.take_along_axis(names, order, axis=1)
        self.floor[queries] = np.maximum(self.floor[queries], np.where(self.ids[queries, -1] < (1 << 63) - 1, self.scores[queries, -1], -np.inf))


def dual_search(data: np.ndarray, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Best:
    """Search all of ``data`` for all queries; ``floor``: a kth score that each has already."""
    best = Best(len(queries), k, floor)
    data, queries = widened(data, queries)
    stack = [(Node(queries, np.arange(len(queries))), Node(data, np.arange(len(data))))]
    while stack:
        q, d = stack.pop()
        bound = float(q.centre @ d.centre) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
        if bound + 1e-9 * abs(bound) + 1 < best.floor[q.members].min():
            continue
        if not q.children and not d.children:
            best.add(q.members, products(queries[q.members], data[d.members]), ids[d.members])
        elif q.children and (not d.children or q.radius > d.radius):
            stack += [(c, d) for c in q.children]
        else:
            # the most promising last, to be searched first
            stack += [(q, c) for c in sorted(d.children, key=lambda c: float(q.centre @ c.centre))]
    return best


def parsed(vectors: DataFrame) -> DataFrame:
    """vec_id and the vector's components floor(256 * x), packed. Vectors that are null or hold null or
    non-finite components, and null ids, are left out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for vec_id, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                values = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
                if np.isfinite(values).all():  # nulls become NaN
                    ids.append(vec_id)
                    out += pack(np.floor(values * 256)[None, :])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where("vec_id is not null and embedding is not null and not exists(embedding, x -> x is null)").mapInArrow(work, "vec_id long, v binary")


class Blocks:
    """The shared upper levels: centres of cells, and of the blocks of each."""

    def __init__(self, sample: np.ndarray, total: int):
        self.cells = sample[farthest_first(sample, min(CELLS, -(-total // BLOCK)))]
        own = nearest(sample, self.cells)
        each = [sample[own == c] for c in range(len(self.cells))]
        wanted = [-(-len(rows) * total // (len(sample) * BLOCK)) for rows in each]
        centres = [rows[farthest_first(rows, max(1, min(WITHIN, n)))] for rows, n in zip(each, wanted, strict=True)]
        self.first = np.concatenate([[0], np.cumsum([len(c) for c in centres])])
        self.centres = np.concatenate(centres)

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's block, and its distance from the block's centre."""
        rows, cells = widened(rows, self.cells)
        _, centres = widened(rows, self.centres)
        block = np.zeros(len(rows), np.int64)
        cell = nearest(rows, cells)
        for c in np.unique(cell):
            at = np.flatnonzero(cell == c)
            block[at] = self.first[c] + nearest(rows[at], centres[self.first[c] : self.first[c + 1]])
        return block, np.sqrt(((rows - centres[block]) ** 2).sum(axis=1))


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    if not len(rows):
        return np.empty(0, np.int64)
    return ((rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)


def reachable(queries: np.ndarray, floors: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks that may hold a score of a query group's, and the queries that each may hold one of.

    A block is left out for the whole group by the two balls' bound and the worst floor, then for queries one by one."""
    queries, centres = widened(queries, centres)
    middle = queries.mean(axis=0)
    reach = float(np.sqrt(((queries - middle) ** 2).sum(axis=1)).max())
    norms = np.sqrt((centres**2).sum(axis=1))
    bound = centres @ middle + np.sqrt((middle**2).sum()) * radii + norms * reach + radii * reach
    some = np.flatnonzero(bound + 1e-9 * np.abs(bound) + 1 >= floors.min())
    each = queries @ centres[some].T + np.sqrt((queries**2).sum(axis=1))[:, None] * radii[some][None, :]
    fits = each + 1e-9 * np.abs(each) + 1 >= floors[:, None]
    for column, k in enumerate(some):
        own = np.flatnonzero(fits[:, column])
        if len(own):
            yield int(k), own


def top_products(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each vec_id divisible by ``every``.

    Score: the integer inner product; of equal scores the smaller vec_id comes first; a query's own vec_id is
    no candidate. Fewer than k candidates give fewer rows.

    Vectors that are null, hold null or non-finite components or have a null vec_id take no part; shorter
    vectors count as filled up with zeros; rows that repeat vec_id and vector count once, and scores
    beyond 64 bits as the largest number. Other columns are not read, whatever their names; no rows give no rows."""
    spark = vectors.sparkSession
    with_package(spark)
    rows = cut_lineage(parsed(vectors).distinct())
    total = rows.count()
    # a vector that very many rows share is looked through in SALTS parts first
    first, part = Window.partitionBy("v").orderBy("vec_id"), Window.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).orderBy("vec_id")
    # k + 1 ids of equal vectors are enough: any more would rank behind them
    least = rows.withColumn("n", F.row_number().over(part)).where(F.col("n") <= k + 1)
    ids = least.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    sample = unpack([bytes(r.v) for r in sorted(hash_sample(rows, SAMPLE, "vec_id", "v").collect())])
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    upper = spark.sparkContext.broadcast(Blocks(sample, total))

    def placed_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, distance = upper.value.place(unpack(batch.column("v").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block.astype(np.int32)), pa.array(distance)], names=["rep", "ids", "v", "block", "distance"])

    placed = cut_lineage(ids.select(F.get("ids", F.lit(0)).alias("rep"), "ids", "v").mapInArrow(placed_in, "rep long, ids array<long>, v binary, block int, distance double"))
    # one row per block: CELLS * WITHIN at most
    summary = {r.block: (r.n, r.radius) for r in placed.groupBy("block").agg(F.count("*").alias("n"), F.max("distance").alias("radius")).collect()}
    names = np.array(sorted(summary))
    parts = np.array([-(-summary[b][0] // (2 * BLOCK)) for b in names])
    radii = np.array([summary[b][1] for b in names])
    shape = spark.createDataFrame([(int(b), int(n)) for b, n in zip(names, parts, strict=True)], "block int, parts int")
    data = placed.join(F.broadcast(shape), "block").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))

    asked = rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id").join(placed.select("v", "rep", "block"), "v").select("query_id", "rep", "v", "block")
    asked = cut_lineage(asked)
    distinct = asked.groupBy("rep").agg(F.first("v").alias("v"), F.first("block").alias("block"))
    # groups of about TOGETHER queries of a block
    sizes = distinct.groupBy("block").agg((F.count("*") / TOGETHER).cast("int").alias("more"))
    distinct = distinct.join(F.broadcast(sizes), "block").withColumn("team", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("more") + 1).cast("int")).drop("more")
    own = distinct.join(F.broadcast(shape), "block").withColumn("part", F.pmod("team", "parts").cast("int"))
    asking = own.groupBy("block", "part", "team").agg(F.collect_list(F.struct("rep", "v", F.lit(None).cast("double").alias("floor"))).alias("queries"))
    schema = "rep long, v binary, home int, team int, part int, found array<struct<score:long,id:long>>"
    query_type = "array<struct<rep:long,v:binary,floor:double>>"

    def search(groups: DataFrame) -> DataFrame:
        """Groups (block, part, home, team, queries) against the vectors of the block's part."""
        left = data.select("block", "part", F.lit(0).alias("side"), "rep", "v", F.lit(None).cast("int").alias("home"), F.lit(None).cast("int").alias("team"), F.lit(None).cast(query_type).alias("queries"))
        right = groups.select("block", "part", F.lit(1).alias("side"), F.lit(None).cast("long").alias("rep"), F.lit(None).cast("binary").alias("v"), "home", "team", "queries")
        return left.union(right).repartition("block", "part").sortWithinPartitions("block", "part", "side").mapInArrow(blocks_of, schema)

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, table, numbers = None, [], None, None
        for batch in batches:
            for block, part, side, rep, v, home, team, queries in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (block, part) != key:
                    key, held, table = (block, part), [], None
                if side == 0:
                    held.append((rep, v))
                    continue
                if table is None:
                    table, numbers = unpack([x for _, x in held]), np.array([r for r, _ in held], np.int64)
                yield answers(part, table, numbers, home, team, queries)

    def answers(part: int, table: np.ndarray, numbers: np.ndarray, home: int, team: int, queries: list[dict]) -> pa.RecordBatch:
        floor = np.array([-np.inf if q["floor"] is None else q["floor"] for q in queries])
        best = dual_search(table, numbers, unpack([q["v"] for q in queries]), floor, k + 1)
        real = best.ids < (1 << 63) - 1
        found = [[{"score": int(s), "id": int(i)} for s, i, ok in zip(*row, strict=True) if ok] for row in zip(best.scores, best.ids, real, strict=True)]
        n = len(queries)
        columns = [pa.array([q["rep"] for q in queries], pa.int64()), pa.array([q["v"] for q in queries], pa.binary()), pa.array([home] * n, pa.int32()), pa.array([team] * n, pa.int32()), pa.array([part] * n, pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.struct([("score", pa.int64()), ("id", pa.int64())])))], names=["rep", "v", "home", "team", "part", "found"])

    near = cut_lineage(search(asking.withColumn("home", F.col("block"))))

    target = pa.list_(pa.struct([("rep", pa.int64()), ("v", pa.binary()), ("floor", pa.float64())]))

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["home"], row["team"]) != key:
                    if rows:
                        yield from ways(rows)
                    key, rows = (row["home"], row["team"]), []
                rows.append(row)
        if rows:
            yield from ways(rows)

    def ways(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        """A group's queries for each block that they may find more in, but for the part that they have searched."""
        floors = np.array([r["found"][k]["score"] if len(r["found"]) > k else -np.inf for r in rows])
        home, team, had = rows[0]["home"], rows[0]["team"], rows[0]["part"]
        for b, fit in reachable(unpack([r["v"] for r in rows]), floors, upper.value.centres[names], radii):
            to = [part for part in range(parts[b]) if (names[b], part) != (home, had)]
            packed = [{"rep": rows[i]["rep"], "v": rows[i]["v"], "floor": float(floors[i])} for i in fit]
            n = len(to)
            yield pa.RecordBatch.from_arrays([pa.array([int(names[b])] * n, pa.int32()), pa.array(to, pa.int32()), pa.array([home] * n, pa.int32()), pa.array([team] * n, pa.int32()), pa.array([packed] * n, target)], names=["block", "part", "home", "team", "queries"])

    teams = near.repartition("home", "team").sortWithinPartitions("home", "team")
    routed = teams.mapInArrow(routes, f"block int, part int, home int, team int, queries {query_type}")
    far = search(routed)
    pairs = near.union(far).select("rep", F.explode("found").alias("x")).select("rep", "x.score", F.col("x.id").alias("other"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "other")
    pairs = pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    every_id = pairs.join(placed.select(F.col("rep").alias("other"), "ids"), "other").select("rep", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    # written, so that both sides of the join are shuffles, of which Spark splits what a much asked vector's queries fill
    every_id = cut_lineage(every_id.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n"))
    own = asked.select("query_id", "rep").join(every_id, "rep").where("query_id != vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
