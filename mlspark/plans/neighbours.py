"""Exact nearest neighbours and similarity lists without a cross join.

Dense vectors: the base is cut into cells around pivots.  From the distances to the pivots, the cell
radii and the cell sizes, every query derives a bound on its k-th distance and goes, by an equi-join
on the cell, only to cells that can hold a neighbour (triangle inequality).  Cells are cut into chunks
and put together to groups, queries are dealt into blocks, so a task holds a bounded number of rows however uneven the
cells are, and a row is copied once for each group or block it meets.  Each task keeps k rows per query.

Sparse vectors: rows are dealt into blocks, and pairs of blocks are multiplied as sparse matrices inside tasks
that keep k rows per row and block, so the output of a task does not depend on how popular a dimension is.
Where few rows share a dimension, a block meets only the entries of its own dimensions instead of all other blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlspark.session import Wave, in_waves, partitions, ship, waves_for, written

CHUNK = 4096
PARTS, WIDEST = 24, 16  # parts of a side that are compared with each other, and how many chunks one may hold
SPARSE_CHUNK = 2048  # rows of a block of sparse vectors
PRODUCTS = 1 << 22  # products of weights made at once
POSTINGS = 1 << 21  # entries that a block of sparse vectors meets in one task
POSTING = 1 << 16  # entries of one dimension in one row
MET = 16  # bytes of an entry that meets a block
SPARSE = 4  # pairs of rows a product must stand for, to go by dimension instead of by pairs of blocks
FEW_PIVOTS = 256
DIGITS = 6


def stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def pairwise(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices."""
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def first_best(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values in falling order, earlier places first on ties."""
    if len(values) > k:
        floor = np.partition(values, len(values) - k)[len(values) - k]
        places = np.flatnonzero(values >= floor)
    else:
        places = np.arange(len(values))
    return places[(-values[places]).argsort(kind="stable")][:k]


def unit(vector: str | Column, zero_axis: int) -> Column:
    """Length-1 form with two spare axes: a zero vector becomes a spare axis, similar to nothing."""
    v = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    spare = [F.lit(1.0 if axis == zero_axis else 0.0) for axis in (0, 1)]
    return F.when(
        norm > 0, F.concat(F.transform(v, lambda x: x / norm), F.array(F.lit(0.0), F.lit(0.0)))
    ).otherwise(F.concat(F.transform(v, lambda x: F.lit(0.0)), F.array(*spare)))


@dataclass(frozen=True)
class Cells:
    """Pivots with the size and radius of the base rows nearest to each."""

    pivots: np.ndarray
    radius: np.ndarray
    count: np.ndarray

    def pieces(self, rows: int) -> np.ndarray:
        return np.maximum(1, -(-self.count // rows)).astype(np.int32)

    def chunks(self, rows: int) -> Column:
        """Array literal: number of chunks per cell."""
        return F.lit(self.pieces(rows))

    def groups(self, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group of every chunk, in the order of the cells, and the first and last group of every cell."""
        pieces = self.pieces(rows)
        size = np.repeat(self.count / pieces, pieces)
        limit = wide(int(self.count.sum()), rows)
        bins = np.zeros(len(size), dtype=np.int32)
        held, group = 0.0, 0
        for at, more in enumerate(size):
            if held and held + more > limit:
                held, group = 0.0, group + 1
            held += more
            bins[at] = group
        ends = np.cumsum(pieces)
        return bins, bins[ends - pieces], bins[ends - 1]


def wide(n: int, chunk: int) -> int:
    """Rows of one side that meet in a task: each side is shuffled once for every such part of the other, so
    that their number stays at ``PARTS`` until a part holds ``WIDEST`` chunks."""
    return max(chunk, min(WIDEST * chunk, -(-n // PARTS)))


def nearest_cell(pivots: np.ndarray):
    schema = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType())])

    @F.pandas_udf(schema)
    def assign(vectors: pd.Series) -> pd.DataFrame:
        distance = pairwise(stack(vectors), pivots) if len(vectors) else np.zeros((0, len(pivots)))
        cell = distance.argmin(1) if len(vectors) else np.zeros(0, int)
        return pd.DataFrame({"cell": cell.astype(np.int32), "far": distance[np.arange(len(cell)), cell]})

    return assign


def fit_cells(base: DataFrame, pivots: int | None, chunk: int) -> tuple[Cells, DataFrame]:
    """Pivots are a repeatable sample of base rows; only they and their cell sizes are collected.

    Their number follows the rows per chunk at first and the square root of the row count later, so that
    cells stay small and the distances to all pivots stay a small part of the search.
    """
    n = base.count()
    wanted = pivots or min(max(1, -(-n // chunk)), max(FEW_PIVOTS, math.isqrt(n)))
    sample = base.orderBy(F.xxhash64("base_id"), "base_id").limit(wanted).select("base_vec").collect()
    centres = np.array([r[0] for r in sample], dtype=np.float64)
    placed = base.withColumn("_at", nearest_cell(centres)("base_vec")).select("base_id", "base_vec", "_at.cell", "_at.far")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect()
    radius, count = np.zeros(len(centres)), np.zeros(len(centres), dtype=np.int64)
    for row in sizes:
        radius[row["cell"]], count[row["cell"]] = row["r"], row["n"]
    return Cells(centres, radius, count), placed.drop("far")


def cells_to_visit(cells: Cells, need: int | None, within: float | None):
    """UDF: cells that can hold one of the ``need`` nearest rows, or a row within a distance."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def visit(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=object)
        distance = pairwise(stack(vectors), cells.pivots)
        if within is not None:
            bound = np.full(len(distance), within)
        else:
            upper = distance + cells.radius
            order = upper.argsort(1)
            enough = cells.count[order].cumsum(1) >= need
            last = np.where(enough.any(1), enough.argmax(1), distance.shape[1] - 1)
            bound = np.take_along_axis(upper, order, 1)[np.arange(len(last)), last]
        useful = (distance - cells.radius <= bound[:, None] + 1e-9) & (cells.count > 0)
        return pd.Series([np.flatnonzero(row).astype(np.int32) for row in useful])

    return visit


def _search(
    queries: DataFrame, base: DataFrame, k: int | None, within: float | None, exclude_self: bool, pivots: int | None, chunk: int
) -> DataFrame:
    """(query_id, base_id, dist): k nearest per (query, group of cells), or all rows within a distance."""
    cells, placed = fit_cells(base, pivots, chunk)
    n = queries.count()
    blocks = max(1, -(-n // wide(n, chunk)))
    per_cell = cells.chunks(chunk)
    bins, first, last = cells.groups(chunk)
    block_of = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int")
    visits = cells_to_visit(cells, (k or 0) + int(exclude_self), within)

    def of(table: np.ndarray, cell: Column) -> Column:
        return F.element_at(F.lit(table), cell + 1)

    seen = queries.withColumn("cells", visits("query_vec")).withColumn("block", block_of)
    reached = F.flatten(F.transform("cells", lambda c: F.sequence(of(first, c), of(last, c))))
    left = seen.withColumn("group", F.explode(F.array_distinct(reached)))
    inside = F.filter("cells", lambda c: (of(first, c) <= F.col("group")) & (F.col("group") <= of(last, c)))
    left = left.withColumn("cells", inside)
    chunk_of = F.pmod(F.xxhash64("base_id", F.lit(2)), F.element_at(per_cell, F.col("cell") + 1)).cast("int")
    # a base row is copied only to the blocks whose queries visit its cell
    wanted = seen.select(F.explode("cells").alias("_cell"), F.col("block").alias("_block")).distinct()
    starts = np.concatenate([[0], np.cumsum(cells.pieces(chunk))[:-1]]).astype(np.int32)
    right = placed.withColumn("group", of(bins, of(starts, F.col("cell")) + chunk_of))
    right = right.join(wanted, F.col("cell") == F.col("_cell")).select("base_id", "base_vec", "cell", "group", F.col("_block").alias("block"))
    id_type = queries.schema["query_id"].dataType.simpleString()
    base_type = base.schema["base_id"].dataType.simpleString()

    def nearest(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame(columns=["query_id", "base_id", "dist", "exact"])
        if not len(q) or not len(b):
            return empty
        b = b.sort_values("base_id", kind="stable")
        every_id, every, cell = b["base_id"].to_numpy(), stack(b["base_vec"]), b["cell"].to_numpy()
        # queries with the same first cell are compared together, with the cells that any of them visits
        q = q.iloc[q["cells"].map(lambda c: c[0]).to_numpy().argsort(kind="stable")]
        parts = []
        step = max(16, PRODUCTS // len(b))
        for start in range(0, len(q), step):
            part = q.iloc[start:start + step]
            who = part["query_id"].to_numpy()
            met = np.flatnonzero(np.isin(cell, np.concatenate(part["cells"].to_list())))
            ids = every_id[met]
            exact = pairwise(stack(part["query_vec"]), every[met])
            distance = np.round(exact, DIGITS)
            if exclude_self:
                distance[who[:, None] == ids[None, :]] = np.inf
            if within is not None:
                rows, cols = np.nonzero(distance <= within)
            else:
                width = min(k, distance.shape[1])
                cols = np.concatenate([first_best(-row, width) for row in distance])
                rows = np.repeat(np.arange(len(part)), width)
                real = np.isfinite(distance[rows, cols])
                rows, cols = rows[real], cols[real]
            parts.append(pd.DataFrame({"query_id": who[rows], "base_id": ids[cols], "dist": distance[rows, cols], "exact": exact[rows, cols]}))
        return pd.concat(parts)

    group = ["group", "block"]
    return (
        left.groupBy(*group)
        .cogroup(right.groupBy(*group))
        .applyInPandas(nearest, f"query_id {id_type}, base_id {base_type}, dist double, exact double")
    )


def _sides(queries, base, query_id, base_id, vector, metric):
    def side(df: DataFrame, key: str, name: str, axis: int) -> DataFrame:
        vec = unit(vector, axis) if metric == "cosine" else F.col(vector).cast("array<double>")
        return df.select(F.col(key).alias(f"{name}_id"), vec.alias(f"{name}_vec"))

    return side(queries, query_id, "query", 0), side(base, base_id, "base", 1)


def vector_topk(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    query_id: str = "vec_id",
    base_id: str = "vec_id",
    vector: str = "embedding",
    metric: str = "l2",
    exclude_self: bool = False,
    pivots: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Exact k nearest base rows per query: (query_id, base_id, dist, rank), ties to the smaller id.

    ``metric`` is l2 or cosine; cosine adds ``similarity``.  Distances are rounded to 6 digits before
    ranking, so that copies tie.
    """
    left, right = _sides(queries, base, query_id, base_id, vector, metric)
    local = _search(left, right, k, None, exclude_self, pivots, chunk)
    best = W.partitionBy("query_id").orderBy("dist", "base_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))
    if metric == "cosine":
        ranked = ranked.withColumn("similarity", 1 - F.col("exact") * F.col("exact") / 2)
    return ranked.drop("exact")


def vector_within(
    queries: DataFrame,
    base: DataFrame,
    tolerance: float,
    query_id: str = "vec_id",
    base_id: str = "vec_id",
    vector: str = "embedding",
    exclude_self: bool = False,
    pivots: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """All pairs at a distance of at most ``tolerance``."""
    left, right = _sides(queries, base, query_id, base_id, vector, "l2")
    return _search(left, right, None, tolerance, exclude_self, pivots, chunk).drop("exact")


def sparse_topk(vectors: DataFrame, k: int, chunk: int = SPARSE_CHUNK) -> DataFrame:
    """Exact k most similar rows per row, from unit vectors (id, dim, weight >= 0) in long form.

    Returns (a, b, sim, rank); only rows with a positive similarity appear, ties go to the smaller id.

    Equal rows form a class, which stands for them by its k + 1 smallest ids.  Classes are dealt into
    blocks of about ``chunk``.  Where dimensions are popular, every pair of blocks is multiplied in one
    task, which keeps k + 1 ids for each class and block: a popular dimension makes no rows.  Where the
    products of weights are few next to the pairs of classes, see ``_by_dimension``.
    """
    entry = F.struct("dim", "weight")
    rows = vectors.groupBy("id").agg(F.array_sort(F.collect_list(entry)).alias("vec"))
    # lengths are sums in any order, so equal rows may differ in the last digits
    key = F.transform("vec", lambda e: F.struct(e["dim"], F.round(e["weight"], 12)))
    label = F.concat_ws(":", F.xxhash64(key), F.xxhash64(F.lit("second"), key))
    rows = written(rows.withColumn("label", label), "rows")
    place = F.row_number().over(W.partitionBy("label").orderBy("id"))
    first = rows.withColumn("_place", place).filter(F.col("_place") <= k + 1)
    classes = first.groupBy("label").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.min_by("vec", "id").alias("vec"))
    classes = written(classes, "classes")
    count = classes.count()
    n = max(1, -(-count // chunk))
    ship(vectors.sparkSession)
    if n > 1:
        sizes = classes.select(F.explode("vec.dim").alias("dim")).groupBy("dim").agg(F.count(F.lit(1)).alias("c"))
        most = sizes.agg(F.max("c").alias("c"), F.sum(F.col("c").cast("double") * F.col("c")).alias("products")).first()
    if n > 1 and most["products"] * SPARSE <= float(count) * count:
        lists = _by_dimension(classes, k, n, most["c"], most["products"])
    else:
        lists = _by_blocks(classes, k, n, vectors.schema["id"].dataType.simpleString())
    mine = F.slice(F.filter("list", lambda e: e["b"] != F.col("a")), 1, k)
    out = rows.select(F.col("id").alias("a"), "label").join(lists, "label").select("a", F.posexplode(mine).alias("_at", "e"))
    return out.select("a", F.col("e.b").alias("b"), F.col("e.sim").alias("sim"), (F.col("_at") + 1).cast("long").alias("rank"))


def _by_blocks(classes: DataFrame, k: int, n: int, kind: str) -> DataFrame:
    """(label, list): the k + 1 best ids of every class, from the products of all pairs of blocks."""
    dealt = classes.withColumn("_i", F.pmod(F.xxhash64("label"), F.lit(n)).cast("int"))
    packed = dealt.groupBy("_i").agg(F.collect_list(F.struct("label", "ids", "vec")).alias("rows"))
    left = packed.select("_i", F.col("rows").alias("left"), F.explode(F.sequence("_i", F.lit(n - 1))).alias("_j"))
    right = packed.select(F.col("_i").alias("_j"), F.col("rows").alias("right"), F.explode(F.sequence(F.lit(0), "_i")).alias("_i"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch.column("_i")[r].as_py() == batch.column("_j")[r].as_py()
                yield from block_lists(batch.column("left")[r].values, batch.column("right")[r].values, k, same)

    # few bytes, much work: the planner must not put all pairs of blocks into one task
    parts = max(partitions(classes.sparkSession), min(2 * n * (n + 1), 10_000))
    pairs = left.repartition(parts, "_i", "_j").join(right.repartition(parts, "_i", "_j"), ["_i", "_j"])
    found = pairs.select("_i", "_j", "left", "right").mapInArrow(run, f"label string, b {kind}, sim double")
    best = W.partitionBy("label").orderBy(F.round("sim", DIGITS).desc(), "b")
    lists = found.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= k + 1)
    return lists.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("_place", "b", "sim"))).alias("list"))


def _by_dimension(classes: DataFrame, k: int, n: int, most: int, products: float) -> DataFrame:
    """(label, list) as ``_by_blocks``, but a block meets only the entries of dimensions it holds.

    A class goes by its smallest id.  The entries of a dimension travel as two arrays to the blocks that
    hold the dimension, once for each, and are cut into parts by the other class, so that a task holds about
    ``POSTINGS`` of them however popular a dimension is.  Every part keeps k + 1 classes for each class.
    Blocks go in waves, as all copies of the entries would fill the disk.
    """
    kind = classes.schema["ids"].dataType.elementType.simpleString()
    parts = max(1, -(-most // POSTING), int(products // (n * POSTINGS)) + 1)
    spark = classes.sparkSession
    entries = classes.select(F.col("ids")[0].alias("c"), F.explode("vec").alias("e"))
    entries = entries.select("c", "e.dim", "e.weight").filter("weight IS NOT NULL")
    pair = F.collect_list(F.struct("c", "weight"))
    dealt = entries.withColumn("_i", F.pmod(F.xxhash64("c"), F.lit(n)).cast("int"))
    part = F.pmod(F.xxhash64("c", F.lit(1)), F.lit(parts)).cast("int").alias("_part")
    theirs = entries.groupBy(part, "dim").agg(pair.alias("l")).select(
        "_part", F.col("dim").alias("_dim"), F.col("l.c").alias("b"), F.col("l.weight").alias("wb")
    )
    waves = waves_for(products * MET)
    if waves > 1:
        theirs = written(theirs, "postings")

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        return posting_lists(pdf, k + 1)

    def first(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.slice(F.array_sort(F.flatten(F.collect_list("list"))), 1, k + 1).alias("list"))

    def lists(wave: Wave) -> DataFrame:
        mine = dealt.filter(wave.holds("_i")).groupBy("_i", "dim").agg(pair.alias("l"))
        mine = mine.select("_i", "dim", F.col("l.c").alias("a"), F.col("l.weight").alias("wa"))
        met = mine.join(theirs, F.col("dim").eqNullSafe(F.col("_dim"))).select("_i", "_part", "a", "wa", "b", "wb")
        # few bytes, much work: as many tasks as the planner's own partitions at least
        met = met.repartition(max(partitions(spark), min(-(-n * parts // waves), 10_000)), "_i", "_part")
        found = met.groupBy("_i", "_part").applyInPandas(best, f"a {kind}, bs array<{kind}>, sims array<double>")
        near = F.transform(F.arrays_zip("bs", "sims"), lambda e: F.struct((-F.round(e["sims"], DIGITS)).alias("_place"), e["bs"].alias("b"), e["sims"].alias("sim")))
        near = found.select("a", near.alias("list"))
        return first(near) if parts > 1 else near

    near = in_waves(spark, waves, lists, "near")
    copies = written(classes.filter(F.size("ids") > 1).select(F.col("ids")[0].alias("b"), "ids"), "copies")
    if not copies.isEmpty():
        near = written(near, "near")
        one = near.select("a", F.explode("list").alias("e")).select("a", "e.b", "e").join(copies, "b")
        more = one.select("a", F.transform(F.slice("ids", 2, k), lambda i: F.struct(F.col("e._place").alias("_place"), i.alias("b"), F.col("e.sim").alias("sim"))).alias("list"))
        near = first(near.unionByName(more))
    return classes.select("label", F.col("ids")[0].alias("a")).join(near, "a").select("label", "list")


def posting_lists(met: pd.DataFrame, k: int) -> pd.DataFrame:
    """(a, bs, sims): the k best b of every a, from rows (a, wa, b, wb) with the entries of one dimension each."""
    many_a, many_b = met["a"].map(len).to_numpy(), met["b"].map(len).to_numpy()
    ids_a, code_a = np.unique(np.concatenate(met["a"].to_list()), return_inverse=True)
    ids_b, code_b = np.unique(np.concatenate(met["b"].to_list()), return_inverse=True)
    w_a, w_b = np.concatenate(met["wa"].to_list()), np.concatenate(met["wb"].to_list())
    row = np.repeat(np.arange(len(met)), many_a)
    order = np.argsort(code_a, kind="stable")
    code_a, w_a, row = code_a[order], w_a[order], row[order]
    first, many = (np.cumsum(many_b) - many_b)[row], many_b[row]
    # the entries of an a stay together: cuts lie between two a
    starts = np.searchsorted(code_a, np.arange(len(ids_a) + 1))
    ends = np.concatenate([[0], np.cumsum(many)])[starts]
    width = len(ids_b)
    out: dict[str, list] = {"a": [], "bs": [], "sims": []}
    at = 0
    while at < len(ids_a):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + PRODUCTS, side="right")) - 1)
        own = slice(starts[at], starts[to])
        n = many[own]
        place = np.repeat(first[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        cell = np.repeat((code_a[own] - at) * width, n) + code_b[place]
        value = np.repeat(w_a[own], n) * w_b[place]
        if (to - at) * width <= SPARSE * len(cell):
            sums = np.bincount(cell, value, (to - at) * width)
            cell = np.flatnonzero(sums > 0)
            sums = sums[cell]
        else:
            by_cell = np.argsort(cell, kind="stable")
            cell, value = cell[by_cell], value[by_cell]
            new = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            cell, sums = cell[new], np.add.reduceat(value, new)
            cell, sums = cell[sums > 0], sums[sums > 0]
        who, other = np.divmod(cell, width)
        rank = np.lexsort((other, -np.round(sums, DIGITS), who))
        who, other, sums = who[rank], other[rank], sums[rank]
        begin = np.searchsorted(who, np.arange(to - at + 1))
        for r in range(to - at):
            if begin[r] < begin[r + 1]:
                best = slice(begin[r], min(begin[r] + k, begin[r + 1]))
                out["a"].append(ids_a[at + r])
                out["bs"].append(ids_b[other[best]])
                out["sims"].append(sums[best])
        at = to
    return pd.DataFrame(out, dtype=None if out["a"] else object)


def _flat(rows: pa.StructArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, dimension, weight) of every entry of a block's rows."""
    lists = rows.field("vec")
    entries = lists.flatten()
    owner = np.repeat(np.arange(len(rows)), np.diff(lists.offsets.to_numpy()))
    return owner, entries.field("dim"), entries.field("weight").to_numpy(zero_copy_only=False)


def product(left: pa.StructArray, right: pa.StructArray) -> np.ndarray:
    """Similarities of the rows of two blocks; only dimensions that both hold are multiplied."""
    (row_a, dim_a, w_a), (row_b, dim_b, w_b) = _flat(left), _flat(right)
    codes = pa.chunked_array([dim_a, dim_b]).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    code_a, code_b = codes[: len(row_a)], codes[len(row_a) :]
    order = np.argsort(code_b, kind="stable")
    row_b, w_b = row_b[order], w_b[order]
    first = np.searchsorted(code_b[order], code_a)
    many = np.searchsorted(code_b[order], code_a, side="right") - first
    sims = np.zeros(len(left) * len(right))
    ends = np.cumsum(many)
    at = 0
    while at < len(many):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PRODUCTS, side="right")))
        n = many[at:to]
        mine = np.repeat(np.arange(at, to), n)
        other = np.repeat(first[at:to] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        sims += np.bincount(row_a[mine] * len(right) + row_b[other], w_a[mine] * w_b[other], len(sims))
        at = to
    return sims.reshape(len(left), len(right))


def block_lists(left: pa.StructArray, right: pa.StructArray, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    """(label, b, sim): for each row of either block the k + 1 best ids of the other; ``same`` blocks go one way."""
    sims = product(left, right)
    for own, other, table in ((left, right, sims),) if same else ((left, right, sims), (right, left, sims.T)):
        ids = other.field("ids").to_pylist()
        by_id = np.array(sorted(range(len(ids)), key=lambda c: ids[c][0]))
        rounded = np.round(table[:, by_id], DIGITS)
        labels, found, values = [], [], []
        for r, label in enumerate(own.field("label").to_pylist()):
            pairs = [(-rounded[r, c], i, table[r, by_id[c]]) for c in first_best(rounded[r], k + 1) if table[r, by_id[c]] > 0 for i in ids[by_id[c]]]
            for _, i, value in sorted(pairs)[: k + 1]:
                labels.append(label)
                found.append(i)
                values.append(value)
        id_type = other.field("ids").type.value_type
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(found, id_type), pa.array(values, pa.float64())], ["label", "b", "sim"])


def unit_rows(entries: DataFrame, id: str, dim: str, value: str) -> DataFrame:
    """(id, dim, weight): every row's entries divided by its length; lengths are aggregated, then joined."""
    norms = entries.groupBy(id).agg(F.sqrt(F.sum(F.col(value).cast("double") * F.col(value))).alias("_norm"))
    return (
        entries.join(norms.filter("_norm > 0"), id)
        .select(F.col(id).alias("id"), F.col(dim).alias("dim"), (F.col(value) / F.col("_norm")).alias("weight"))
    )
