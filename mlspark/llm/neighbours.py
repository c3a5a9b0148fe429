"""Nearest neighbours by vantage-point trees per shard (operator 10).

Vectors are scaled to length one, where the Euclidean distance falls as the cosine grows and obeys the
triangle inequality.  Equal vectors are searched once.  Vectors are dealt to shards of about
``SHARD`` vectors, larger ones where there would be many; each shard becomes a vantage-point tree.  A block of queries walks a tree: a subtree is
left out when the triangle inequality, relaxed by ``factor``, says that it cannot hold a nearer vector than
the k-th found so far.  Factor one is the exact bound; smaller factors prune more and may miss some.
Each (shard, block) pair is one group of both sides and one bounded task; per query only
the best of every shard are merged.  Scores are then taken anew in double precision from the original
vectors.

Defined cases: vectors that are missing, empty, zero, of another length than most, or hold a missing or
non-finite component take no part; a missing id takes no part; repeated rows of one id and vector count
once; a query with fewer candidates than k gets all; equal scores go to the smaller id; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.session import partitions, ship, written

NEAREST = 5
EVERY = 50
SHARD = 4096
BLOCK = 512
PARTS = 24  # shards, before they grow
VALUES = 1 << 21  # numbers of the vectors of a shard that has grown; a block of queries holds half as many
LEAF = 64
FACTOR = 1.0
SLACK = 1e-9  # rounding of distances near zero
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
TIE = 1e-7  # rounding of distances of equal directions: the root of that of their dot product


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) with double components, without the vectors that take no part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector")).filter("vec_id is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = rows.filter(finite).filter(F.exists("vector", lambda x: x != 0))
    sizes = sound.groupBy(F.size("vector").alias("_size")).agg(F.count(F.lit(1)).alias("_n"))
    usual = sizes.orderBy(F.desc("_n"), "_size").limit(1).select("_size")
    return sound.withColumn("_size", F.size("vector")).join(F.broadcast(usual), "_size").select("vec_id", "vector").distinct()


def representatives(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): each distinct vector once, with its ``keep`` smallest ids, taken in two levels."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(4 * partitions(rows.sparkSession))))
    inside = W.partitionBy("vector", "_salt").orderBy("vec_id")
    few = salted.withColumn("_r", F.row_number().over(inside)).filter(F.col("_r") <= keep)
    across = W.partitionBy("vector").orderBy("vec_id")
    fewer = few.withColumn("_r", F.row_number().over(across)).filter(F.col("_r") <= keep)
    return fewer.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


class Tree:
    """A vantage-point tree over rows of unit vectors."""

    def __init__(self, unit: np.ndarray, seed: int = 0) -> None:
        self.unit = unit
        self.rng = np.random.default_rng(seed)
        self.root = self.build(np.arange(len(unit)))

    def build(self, rows: np.ndarray):
        """A leaf is an array of rows; a node is (vantage row, radius, inner child, outer child)."""
        if len(rows) <= LEAF:
            return rows
        at = int(self.rng.integers(len(rows)))
        vantage, rest = rows[at], np.delete(rows, at)
        away = distances(self.unit[rest], self.unit[vantage][None])[:, 0]
        radius = float(np.median(away))
        inner = away <= radius
        if inner.all():
            return rows  # all at one distance: nothing to part
        return vantage, radius, self.build(rest[inner]), self.build(rest[~inner])

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """(distance, row) of the k nearest rows of each query; -1 where there are fewer."""
        best = Best(len(queries), k)
        self.visit(self.root, queries, np.arange(len(queries)), best, factor)
        return best.distance, best.row

    def visit(self, node, queries: np.ndarray, who: np.ndarray, best: Best, factor: float) -> None:
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            best.offer(who, distances(queries[who], self.unit[node]), node)
            return
        vantage, radius, inner, outer = node
        away = distances(queries[who], self.unit[vantage][None])
        best.offer(who, away, np.array([vantage]))
        away = away[:, 0]
        inside = away <= radius
        # the nearer side first; the other one only where the bound leaves it open
        self.visit(inner, queries, who[inside], best, factor)
        self.visit(outer, queries, who[~inside], best, factor)
        gap = np.abs(away - radius)
        still = gap <= factor * best.worst(who) + (TIE if factor == 1 else SLACK)
        self.visit(outer, queries, who[inside & still], best, factor)
        self.visit(inner, queries, who[~inside & still], best, factor)


class Best:
    """The k nearest rows of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.distance, self.row = np.full((n, k), np.inf), np.full((n, k), -1, np.int64)

    def worst(self, who: np.ndarray) -> np.ndarray:
        return self.distance[who, -1]

    def offer(self, who: np.ndarray, away: np.ndarray, rows: np.ndarray) -> None:
        better = away.min(axis=1) < self.distance[who, -1]
        who, away = who[better], away[better]
        if not len(who):
            return
        k = self.distance.shape[1]
        all_away = np.concatenate([self.distance[who], away], axis=1)
        all_rows = np.concatenate([self.row[who], np.broadcast_to(rows, away.shape)], axis=1)
        order = np.argsort(all_away, axis=1, kind="stable")[:, :k]
        self.distance[who] = np.take_along_axis(all_away, order, axis=1)
        self.row[who] = np.take_along_axis(all_rows, order, axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def matrix(column: pa.Array) -> np.ndarray:
    lists = column.flatten()
    return lists.to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    # large components first made small, so that squares stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row in a fixed order, so that equal vectors give equal bits."""
    scale_x, scale_y = np.abs(x).max(axis=1, keepdims=True), np.abs(y).max(axis=1, keepdims=True)
    big = (scale_x.max(initial=1) > 1e100) or (scale_y.max(initial=1) > 1e100) or scale_x.min(initial=1) < 1e-100 or scale_y.min(initial=1) < 1e-100
    if big:
        x, y = x / scale_x, y / scale_y
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def side_rows(least: int, n: int, values: int, dims: int) -> int:
    """Rows of one side that meet in a task: ``least``, and beyond ``PARTS`` parts as many as hold ``values`` numbers, since
    each part is a copy of the other side."""
    return max(least, min(values // max(1, dims), -(-n // PARTS)))


def _whole(table: pa.Table) -> pa.StructArray:
    return pa.concat_arrays(table.to_struct_array().chunks)


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, factor: float = FACTOR, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query, all other ids being candidates."""
    rows = written(usable(vectors), "vectors")
    # one id more than asked for, as the query's own vector is among them
    distinct = written(representatives(rows, k + 1), "distinct")
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_base, n_query = distinct.count(), queries.count()
    dims = (distinct.select(F.size("vector")).first() or [1])[0]
    n_shards = max(1, -(-n_base // side_rows(shard, n_base, VALUES, dims)))
    n_blocks = max(1, -(-n_query // max(BLOCK, VALUES // 2 // dims)))
    # every shard meets every block: copies of either side, one per partner
    base = distinct.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(n_shards)))
    base = base.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)).cast("array<long>")))
    # copies are made before a shuffle that the planner cannot leave out: it would send them through the driver
    tasks = max(partitions(vectors.sparkSession), min(4 * n_shards * n_blocks, 10_000))
    cell = ["shard", "block"]
    base, asked = base.repartition(tasks, *cell), asked.repartition(tasks, *cell)

    def run(near: pa.Table, wanted: pa.Table) -> pa.Table:
        found = [search_cell(_whole(near), _whole(wanted), k, factor)] if near.num_rows and wanted.num_rows else []
        return pa.Table.from_batches(found, FOUND)

    ship(vectors.sparkSession)
    found = base.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(run, "query_id long, vec_id long, score double")
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def within_ties(tree: Tree, queries: np.ndarray, size: int, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, row), by query: the k nearest rows and all others that are as near as the last of them but for rounding.

    Vectors of one direction and different lengths tie; a query whose ties fill its list is searched again with a
    list four times as long, up to all rows of the shard.
    """
    left, out, many = np.arange(len(queries)), [], min(size, k + 3)
    while len(left):
        away, rows = tree.search(queries[left], many, factor)
        limit = away[:, min(k, many) - 1] + TIE
        full = (away[:, -1] <= limit) & (many < size)
        who, at = np.nonzero((rows >= 0) & (away <= limit[:, None]) & ~full[:, None])
        out.append((left[who], rows[who, at]))
        left, many = left[full], min(size, 4 * many)
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    who, row = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(who, kind="stable")
    return who[order], row[order]


def search_cell(shard: pa.StructArray, block: pa.StructArray, k: int, factor: float) -> pa.RecordBatch:
    """The k nearest ids of a shard for each query of a block, by exact score and then id."""
    base, ids = matrix(shard.field("vector")), shard.field("ids").to_pylist()
    query, query_ids = matrix(block.field("vector")), block.field("vec_id").to_numpy()
    tree = Tree(unit(base))
    who, row = within_ties(tree, unit(query), len(base), k + 1, factor)
    score = cosine(query[who], base[row])
    out = []
    for q in range(len(query)):
        mine = who == q if len(query) < 2 else slice(*np.searchsorted(who, [q, q + 1]))
        pairs = [(-s, i) for s, r in zip(score[mine].tolist(), row[mine].tolist(), strict=True) for i in ids[r] if i != query_ids[q]]
        out += [(int(query_ids[q]), i, -s) for s, i in sorted(pairs)[:k]]
    columns = list(zip(*out, strict=True)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, FOUND.types, strict=True)], schema=FOUND)
