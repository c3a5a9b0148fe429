"""Look-ups, membership, nearest-value joins and similarity lists."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.plans.neighbours import sparse_topk, unit_rows, vector_topk, vector_within  # noqa: F401
from mlspark.plans.ordered import assign_buckets, null_safe_join, quantile_edges
from mlspark.session import Wave, in_waves, partitions, waves_for, written

PAIRS = 1 << 15  # pairs of users that one task opens
RATED = 12  # bytes of a rating in a list


def attach_titles(df: DataFrame, items: DataFrame, key: str, title: str, default: str = "N/A") -> DataFrame:
    """Title per row, a default when the key is unknown.  The planner broadcasts the items when their
    size is below the session's threshold, and splits skewed keys otherwise."""
    # a repeated key gives the smallest title, whatever the order of rows
    known = items.groupBy(key).agg(F.min(title).alias("_title"))
    return df.join(known, key, "left").withColumn(title, F.coalesce("_title", F.lit(default))).drop("_title")


def join_features(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return left.join(right, key, "inner")


def semi_known(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys each appear in ``known``."""
    for key in keys:
        df = df.join(known.select(key).distinct(), key, "left_semi")
    return df


def anti_seen(candidates: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    return candidates.join(seen.select(*keys), list(keys), "left_anti")


def nearest_join(
    left: DataFrame, right: DataFrame, value: str, left_id: str, right_id: str, buckets: int | None = None
) -> DataFrame:
    """Nearest right row per left row on one number, with replacement; ties go to the smaller right id.

    Both sides are laid on one line cut into quantile buckets.  Inside a bucket a window carries the
    last right row forward and the next one backward; what a bucket needs from outside comes from a
    table with one row per bucket.  Each distinct left value is matched once and its rows are joined back,
    so a value that many rows share is one point on the line.  Missing values match nothing.
    """
    x = F.col(value).cast("double")
    wanted = left.select(F.col(left_id).alias("_left"), x.alias("_x")).filter("_x IS NOT NULL AND NOT isnan(_x)")
    points = right.select(F.col(right_id).alias("_rid"), x.alias("_x")).filter("_x IS NOT NULL AND NOT isnan(_x)")
    single = points.groupBy("_x").agg(F.min("_rid").alias("_rid"))
    line = wanted.select("_x").distinct().select(F.lit(1).alias("_lid"), "_x", F.lit(None).alias("_rid")).unionByName(
        single.select(F.lit(None).alias("_lid"), "_x", "_rid")
    )
    line = assign_buckets(line, "_x", quantile_edges(line, "_x", buckets))
    point = F.when(F.col("_rid").isNotNull(), F.struct("_x", "_rid"))

    # "next" is "previous" in falling order: a frame that reaches to the end of a partition would be
    # evaluated anew for every row
    edges = line.groupBy("_bucket").agg(F.max(point).alias("hi"), F.min(point).alias("lo"))
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    later = W.orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    carried = edges.select(
        "_bucket",
        F.last("hi", ignorenulls=True).over(earlier).alias("_before"),
        F.last("lo", ignorenulls=True).over(later).alias("_after"),
    )
    rising = W.partitionBy("_bucket").orderBy("_x", F.col("_rid").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    falling = W.partitionBy("_bucket").orderBy(F.desc("_x"), F.col("_rid").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    inside = line.select(
        "_lid",
        "_x",
        "_bucket",
        F.last(point, ignorenulls=True).over(rising).alias("_below"),
        F.last(point, ignorenulls=True).over(falling).alias("_above"),
    ).filter(F.col("_lid").isNotNull())
    # one row per bucket
    both = inside.join(F.broadcast(carried), "_bucket")
    below, above = F.coalesce("_below", "_before"), F.coalesce("_above", "_after")

    def option(p):
        return F.when(p.isNotNull(), F.struct(F.abs(F.col("_x") - p["_x"]).alias("dist"), p["_rid"].alias("rid"), p["_x"].alias("x")))

    best = both.select("_x", F.array_min(F.array_compact(F.array(option(below), option(above)))).alias("m"))
    return wanted.join(best, "_x").select(
        F.col("_left").alias(left_id),
        F.col("m.rid").alias(f"matched_{right_id}"),
        F.col("m.x").alias(f"matched_{value}"),
        F.col("m.dist").alias("distance"),
    ).filter(F.col(f"matched_{right_id}").isNotNull())


def nearest_date(df: DataFrame, keys: Sequence[str], ts: str, value: str, target) -> DataFrame:
    """Value at the date nearest to ``target`` per series; the earlier date on ties."""
    closeness = F.struct(F.abs(F.datediff(F.col(ts), target)), F.col(ts))
    return df.groupBy(*keys).agg(F.min_by(ts, closeness).alias(ts), F.min_by(value, closeness).alias(value))


def annotate_events(series: DataFrame, notes: DataFrame, keys: Sequence[str], day: str, value: str, text: str) -> DataFrame:
    """Notes on the dates that exist in a series: direction from the text, label height from the mean."""
    mean = series.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    hits = null_safe_join(series.join(notes, day), mean, keys)
    return hits.select(
        *keys,
        day,
        value,
        text,
        F.when(F.contains(F.col(text), F.lit("drop")), "red").otherwise("green").alias("color"),
        (F.col(value) * F.when(F.col(value) < F.col("_mean"), 1.2).otherwise(0.8)).alias("label_y"),
    )


def user_similarity(ratings: DataFrame, k: int, user: str = "user_id", item: str = "item_id", rating: str = "rating") -> DataFrame:
    """Most similar users by cosine of rating rows (unrated = 0): (a, b, sim, rank)."""
    return sparse_topk(unit_rows(ratings, user, item, rating), k)


def item_similarity(weights: DataFrame, k: int, item: str = "item_id", term: str = "term", weight: str = "weight") -> DataFrame:
    """Most similar items by cosine of their term weights: (a, b, sim, rank)."""
    return sparse_topk(unit_rows(weights, item, term, weight), k)


def pair_similarity(pairs: DataFrame, entries: DataFrame, id: str, dim: str, value: str) -> DataFrame:
    """Cosine of the given (a, b) pairs only."""
    rows = unit_rows(entries, id, dim, value)
    a = pairs.join(rows.select(F.col("id").alias("a"), "dim", F.col("weight").alias("wa")), "a")
    dots = a.join(rows.select(F.col("id").alias("b"), "dim", F.col("weight").alias("wb")), ["b", "dim"])
    sums = dots.groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))
    return pairs.join(sums, ["a", "b"], "left").withColumn("sim", F.coalesce("sim", F.lit(0.0)))


@dataclass(frozen=True)
class Reach:
    """Neighbours next to the lists of what every user rated."""

    near: DataFrame  # user, b, sim
    rated: DataFrame  # user, ratings, items
    user: str
    item: str
    pairs: int  # of users
    met: int  # ratings in the lists of all pairs

    def open(self, wave: Wave) -> DataFrame:
        """(user, sim, item, rating) for unrated items that a neighbour rated, of the users in a wave."""
        user, item = self.user, self.item
        tasks = max(partitions(self.near.sparkSession), -(-self.pairs // (PAIRS * wave.waves)))
        lists = self.rated.select(F.col(user).alias("b"), "_rated")
        reach = self.near.filter(wave.holds(user)).join(lists, "b").drop("b").repartition(tasks, user)
        reach = reach.join(self.rated.filter(wave.holds(user)).select(user, "_own"), user, "left")

        def unseen(row: Column) -> Column:
            return ~F.coalesce(F.array_contains("_own", row[item]), F.lit(False))

        rest = [f.name for f in self.rated.schema["_rated"].dataType.elementType]
        return reach.select(user, F.filter("_rated", unseen).alias("_rated"), "sim").select(user, "sim", F.inline("_rated")).select(user, "sim", *rest)


def reach(neighbours: DataFrame, ratings: DataFrame, user: str = "user_id", item: str = "item_id") -> Reach:
    rest = [c for c in ratings.columns if c != user]
    rated = ratings.groupBy(user).agg(F.collect_list(F.struct(*rest)).alias("_rated"), F.collect_set(item).alias("_own"))
    rated = written(rated, "rated")
    near = written(neighbours.select(F.col("a").alias(user), "b", "sim"), "neighbours")
    sizes = rated.select(F.col(user).alias("b"), F.size("_rated").alias("_n"))
    met = near.groupBy("b").agg(F.count(F.lit(1)).alias("_c")).join(sizes, "b", "left")
    pairs, entries = met.agg(F.sum("_c"), F.sum(F.col("_c") * F.col("_n"))).first()
    return Reach(near, rated, user, item, pairs or 0, entries or 0)


def candidate_pairs(
    neighbours: DataFrame,
    ratings: DataFrame,
    user: str = "user_id",
    item: str = "item_id",
    then: Callable[[DataFrame, Wave], DataFrame] | None = None,
    each: int = RATED,
    more: float = 0,
) -> DataFrame:
    """(user, item, sim, rating) for unrated items that a neighbour rated: joins through the lists, no full product.

    A user's ratings travel as one list and are opened after the last shuffle, by user, so that the pairs of users
    and items are shuffled neither here nor by a grouping of them that names the user.  ``then`` makes of the rows what
    is wanted, for the users of one wave at a time: one list for each pair of users would fill the disk, if all travelled
    at once.  ``each`` is the number of bytes that it takes for a rating in a list, ``more`` those that it takes in all besides.
    """
    found = reach(neighbours, ratings, user, item)
    if then is None:
        return found.open(Wave(ratings.sparkSession))
    return in_waves(ratings.sparkSession, waves_for(found.met * each + more), lambda wave: then(found.open(wave), wave), "candidates")
