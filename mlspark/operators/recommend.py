"""Recommenders on long (user_id, item_id, rating) tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.operators.joins import RATED, anti_seen, candidate_pairs, semi_known
from mlspark.operators.metrics import precision_at_n, weighted_mean_score
from mlspark.operators.sampling import kfold, sample_fraction
from mlspark.operators.tuning import at_once
from mlspark.operators.windows import topn_per_group
from mlspark.plans.ordered import row_index
from mlspark.session import Wave, partitions, shared_dir, written

USER, ITEM, RATING = "user_id", "item_id", "rating"
PAIR = [USER, ITEM]
DIGITS = 6
USERS, CLASSES = 256, 8192  # rows and columns of a slice of content scores
CLASS = 1 << 16  # items of one piece of a class
BLOCKS = 64  # blocks of users that meet all items, before the blocks grow
ENTRY = 24  # bytes of an entry of a profile
SCORED = 64  # bytes that a candidate item takes while both models meet


def rank_items(scores: DataFrame, n: int, score: str = "score") -> DataFrame:
    """Best n items per user; scores are compared to 6 digits, ties go to the smaller item."""
    keyed = scores.withColumn("_s", F.round(score, DIGITS))
    return topn_per_group(keyed, [USER], "_s", n, [ITEM]).drop("_s")


# ---- neighbours -------------------------------------------------------------------------------


def cf_scores(
    neighbours: DataFrame, train: DataFrame, then: Callable[[DataFrame, Wave], DataFrame] = lambda scores, wave: scores, each: int = RATED, more: float = 0
) -> DataFrame:
    """Mean of the neighbours' ratings weighted by similarity, for unrated items a neighbour rated, or what
    ``then`` makes of the scores of one wave of users."""

    def score(reach: DataFrame, wave: Wave) -> DataFrame:
        return then(weighted_mean_score(reach, PAIR, "sim", RATING), wave)

    return candidate_pairs(neighbours, train.select(*PAIR, RATING), USER, ITEM, score, each, more)


def cf_topn(neighbours: DataFrame, train: DataFrame, n: int) -> DataFrame:
    """As ``cf_scores``, but items no neighbour rated score 0 and can fill the list, lowest ids first.

    Real scores are positive, so only users with fewer than n of them need zero rows.  Among the first
    rated + scored + n item ids at least n are neither rated nor scored.
    """
    scored = written(cf_scores(neighbours, train, lambda scores, wave: rank_items(scores, n)).drop("rank"), "cf-lists")
    have = scored.groupBy(USER).agg(F.count(F.lit(1)).alias("_scored"))
    rated = train.groupBy(USER).agg(F.count(F.lit(1)).alias("_rated"))
    short = rated.join(have, USER, "left").na.fill(0, ["_scored"]).filter(F.col("_scored") < n)
    catalogue = row_index(train.select(ITEM).distinct(), [], ITEM, out="_at")
    # only the first positions are asked for: a small table, whatever the catalogue's size
    short = written(short, "short")
    last = short.agg(F.max(F.col("_rated") + F.col("_scored")) + n).scalar()
    catalogue = written(catalogue.filter(F.col("_at") <= last), "first-items")
    reach = short.select(USER, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rated") + F.col("_scored") + n)).alias("_at"))
    zero = reach.join(catalogue, "_at").select(*PAIR)
    zero = anti_seen(anti_seen(zero, train, PAIR), scored, PAIR).withColumn("score", F.lit(0.0))
    return rank_items(scored.unionByName(zero), n)


# ---- content ----------------------------------------------------------------------------------


def content_profiles(train: DataFrame, weights: DataFrame) -> DataFrame:
    """(user_id, term, num, den): rating-weighted and plain sums of the term weights of rated items.

    A content score is a ratio of sums over rated items of item similarity, and similarity is a dot
    product of term weights, so it equals (item . num) / (item . den): no item-item table is needed.
    """
    return (
        train.join(weights, ITEM)
        .groupBy(USER, "term")
        .agg(F.sum(F.col(RATING) * F.col("weight")).alias("num"), F.sum("weight").alias("den"))
    )


def item_classes(weights: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label, piece, ids, codes, weights) and the numbers of the terms: items with equal term weights, which score alike for every user.

    Terms become numbers.  A class of more than ``CLASS`` items is cut into pieces by item.
    """
    codes = written(weights.select("term").distinct().withColumn("_code", F.monotonically_increasing_id()), "terms")
    coded = weights.join(codes, "term").select(ITEM, F.struct("_code", "weight").alias("e"))
    items = coded.groupBy(ITEM).agg(F.array_sort(F.collect_list("e")).alias("vec"))
    # lengths are sums in any order, so equal items may differ in the last digits
    key = F.transform("vec", lambda e: F.struct(e["_code"], F.round(e["weight"], 12)))
    items = items.withColumn("label", F.concat_ws(":", F.xxhash64(key), F.xxhash64(F.lit("second"), key)))
    place = F.row_number().over(W.partitionBy("label").orderBy(ITEM))
    pieces = items.withColumn("piece", F.floor((place - 1) / CLASS)).groupBy("label", "piece")
    found = pieces.agg(F.array_sort(F.collect_list(ITEM)).alias("ids"), F.min_by("vec", ITEM).alias("vec"))
    return found.select("label", "piece", "ids", F.col("vec._code").alias("codes"), F.col("vec.weight").alias("weights")), codes


@dataclass(frozen=True)
class Content:
    """Item classes and term numbers, made once for all waves of users."""

    items: DataFrame
    codes: DataFrame
    user_block: int
    size: float  # bytes that content lists of all users shuffle


def content_classes(train: DataFrame, weights: DataFrame, user_block: int = 4096, item_block: int = 65536, widest: int = 4) -> Content:
    """The classes of the items, and what the lists cost.

    Items are shuffled once for each block of users: up to ``BLOCKS`` blocks stay at ``user_block`` users, beyond that they grow to ``widest`` times as many.
    """
    items, codes = item_classes(weights)
    items = written(items, "item-classes")
    n = train.select(USER).distinct().count()
    block = max(user_block, min(widest * user_block, -(-n // BLOCKS)))
    terms = weights.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_t"))
    rated = train.groupBy(ITEM).agg(F.count(F.lit(1)).alias("_c")).join(terms, ITEM)
    entries = rated.agg(F.sum(F.col("_c") * F.col("_t"))).first()[0] or 0
    own = items.agg(F.sum(8 * F.size("ids") + 16 * F.size("codes"))).first()[0] or 0
    return Content(items, codes, block, float(entries) * ENTRY * (1 + _item_blocks(items, item_block)) + float(own) * -(-n // block))


def _item_blocks(items: DataFrame, item_block: int) -> int:
    size = items.agg(F.count(F.lit(1)), F.sum(F.size("ids"))).first()
    return max(1, -(-size[0] // item_block), -(-(size[1] or 0) // (16 * item_block)))


def content_lists(
    train: DataFrame,
    profiles: DataFrame,
    weights: DataFrame,
    n: int,
    cf: DataFrame | None = None,
    user_block: int = 4096,
    item_block: int = 65536,
    classes: Content | None = None,
) -> DataFrame:
    """Per user over all unrated items: number scored, lowest and highest score, and the best n items.

    With ``cf`` (user, item, score) the content scores of those pairs come along, next to the given
    scores: both models meet here, instead of in a join of two user-item tables.

    Every user meets every item, as the definition asks, in blocks of fixed size; items with equal term weights
    are scored once.  A block pair keeps n rows per user, and no user-item table is written.  Blocks are large, as
    each side is shuffled once for every block of the other; inside a task they are scored in slices.
    ``classes`` are those of the weights, with their block of users, where lists are made for some users at a time.
    """
    seen = train.groupBy(USER).agg(F.sort_array(F.collect_set(ITEM)).alias("seen"))
    if classes is None:
        items, codes = item_classes(weights)
        items = written(items, "item-classes")
    else:
        items, codes, user_block = classes.items, classes.codes, classes.user_block
    entry = F.struct("_code", "num", "den")
    users = profiles.join(codes, "term").groupBy(USER).agg(F.collect_list(entry).alias("p")).join(seen, USER)
    # plain arrays reach Python as NumPy arrays, structs would arrive as objects
    users = users.select(USER, "seen", F.col("p._code").alias("codes"), F.col("p.num").alias("num"), F.col("p.den").alias("den"))
    if cf is None:
        item_type = train.schema[ITEM].dataType.simpleString()
        users = users.withColumn("ask_items", F.array().cast(f"array<{item_type}>")).withColumn("ask_cf", F.array().cast("array<double>"))
    else:
        asked = cf.groupBy(USER).agg(F.sort_array(F.collect_list(F.struct(ITEM, "score"))).alias("a"))
        asked = asked.select(USER, F.col(f"a.{ITEM}").alias("ask_items"), F.col("a.score").alias("ask_cf"))
        users = users.join(asked, USER, "left")
    ub = max(1, -(-train.select(USER).distinct().count() // user_block))
    ib = _item_blocks(items, item_block)
    # both sides' keys have the same type: equal numbers of different types hash apart
    left = users.withColumn("i", F.pmod(F.xxhash64(USER), F.lit(ub)).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(ib - 1))))
    right = items.withColumn("j_", F.pmod(F.xxhash64("label", "piece"), F.lit(ib)).cast("int")).withColumn("i_", F.explode(F.sequence(F.lit(0), F.lit(ub - 1))))
    # few bytes, much work: the planner must not put all pairs of blocks into one task
    tasks = max(partitions(train.sparkSession), min(ub * ib, 10_000))
    left, right = left.repartition(tasks, "i", "j"), right.drop("label", "piece").repartition(tasks, "i_", "j_")

    def score(u: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        fields = ("user_id", "n", "lo", "hi", "items", "scores", "pair_items", "pair_cf", "pair_scores")
        out: dict[str, list] = {f: [] for f in fields}
        if not len(u) or not len(v):
            return pd.DataFrame(out, dtype=object)
        members = v["ids"].map(len).to_numpy()
        start = np.cumsum(members) - members
        flat = np.concatenate(v["ids"].to_list())
        by_id = np.argsort(flat, kind="stable")
        ids, owner = flat[by_id], np.repeat(np.arange(len(v)), members)[by_id]
        terms, code = np.unique(np.concatenate(v["codes"].to_list()), return_inverse=True)
        item = np.zeros((len(v), len(terms)))
        item[np.repeat(np.arange(len(v)), v["codes"].map(len)), code] = np.concatenate(v["weights"].to_list())
        for at in range(0, len(u), USERS):
            part = u.iloc[at : at + USERS]
            code = np.concatenate(part["codes"].to_list())
            row = np.repeat(np.arange(len(part)), part["codes"].map(len))
            place = np.minimum(np.searchsorted(terms, code), len(terms) - 1)
            here = terms[place] == code
            num, den = np.zeros((len(part), len(terms))), np.zeros((len(part), len(terms)))
            num[row[here], place[here]] = np.concatenate(part["num"].to_list())[here]
            den[row[here], place[here]] = np.concatenate(part["den"].to_list())[here]
            result = np.empty((len(part), len(v)))
            for cut in range(0, len(v), CLASSES):
                some = item[cut : cut + CLASSES]
                below = den @ some.T
                valid = below > 0
                result[:, cut : cut + CLASSES] = np.where(valid, (num @ some.T) / np.where(valid, below, 1.0), np.nan)
            for r, (user, known, ask_items, ask_cf) in enumerate(zip(part["user_id"], part["seen"], part["ask_items"], part["ask_cf"])):
                row = result[r]
                at_known = np.searchsorted(ids, known)
                near = at_known < len(ids)
                at_known = at_known[near][ids[at_known[near]] == known[near]]
                rated = np.bincount(owner[at_known], minlength=len(v))
                real = np.flatnonzero((members > rated) & ~np.isnan(row))
                if not len(real):
                    continue
                out["user_id"].append(user)
                out["n"].append(int((members[real] - rated[real]).sum()))
                out["lo"].append(row[real].min())
                out["hi"].append(row[real].max())
                # every class left holds an unrated item, so the n best classes and their equals hold the n best items
                rounded = np.round(row[real], DIGITS)
                floor = np.partition(rounded, len(rounded) - n)[len(rounded) - n] if len(rounded) > n else -np.inf
                best = real[rounded >= floor]
                many = np.minimum(members[best], n + rated[best])
                of = np.repeat(best, many)
                found = flat[start[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)]
                new = ~np.isin(found, known)
                of, found = of[new], found[new]
                order = np.lexsort((found, -np.round(row[of], DIGITS)))[:n]
                out["items"].append(found[order])
                out["scores"].append(row[of[order]])
                wanted = np.asarray(ask_items if ask_items is not None else [], dtype=ids.dtype)
                given = np.asarray(ask_cf if ask_cf is not None else [], dtype=float)
                place = np.searchsorted(ids, wanted)
                asked = np.flatnonzero(place < len(ids))
                asked = asked[(ids[place[asked]] == wanted[asked]) & ~np.isin(wanted[asked], known)]
                asked = asked[~np.isnan(row[owner[place[asked]]])]
                out["pair_items"].append(wanted[asked])
                out["pair_cf"].append(given[asked])
                out["pair_scores"].append(row[owner[place[asked]]])
        return pd.DataFrame(out, dtype=object if not out["n"] else None)

    id_type, item_type = (train.schema[c].dataType.simpleString() for c in PAIR)
    schema = f"user_id {id_type}, n long, lo double, hi double, items array<{item_type}>, scores array<double>, "
    schema += f"pair_items array<{item_type}>, pair_cf array<double>, pair_scores array<double>"
    return left.groupBy("i", "j").cogroup(right.groupBy("i_", "j_")).applyInPandas(score, schema)


def content_scores(lists: DataFrame, n: int) -> DataFrame:
    """Best n unrated items per user from the block lists."""
    rows = lists.select(USER, F.explode(F.arrays_zip("items", "scores")).alias("e")).select(
        USER, F.col("e.items").alias(ITEM), F.col("e.scores").alias("score")
    )
    return rank_items(rows, n)


def content_ranges(lists: DataFrame) -> DataFrame:
    return lists.groupBy(USER).agg(F.sum("n").alias("n_items"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def hybrid_scores(lists: DataFrame, cf: DataFrame, alpha: float = 0.5, epsilon: float = 1e-9) -> DataFrame:
    """Blend of both models on the items both scored, each min-max scaled over its own items first.

    ``lists`` are block lists made with ``cf``; the ranges of both models are one row per user.
    """
    pairs = lists.select(USER, F.inline(F.arrays_zip("pair_items", "pair_cf", "pair_scores")))
    cf_range = cf.groupBy(USER).agg(F.min("score").alias("_cl"), F.max("score").alias("_ch"))
    ranges = content_ranges(lists).select(USER, F.col("lo").alias("_tl"), F.col("hi").alias("_th")).join(cf_range, USER)

    def scaled(value: str, low: str, high: str) -> Column:
        return (F.col(value) - F.col(low)) / (F.col(high) - F.col(low) + F.lit(epsilon))

    blend = F.lit(alpha) * scaled("pair_cf", "_cl", "_ch") + F.lit(1 - alpha) * scaled("pair_scores", "_tl", "_th")
    return pairs.join(ranges, USER).select(USER, F.col("pair_items").alias(ITEM), blend.alias("score"))


def evaluate_recommenders(lists: dict[str, DataFrame], test: DataFrame, train: DataFrame, n: int, min_rating: int = 4) -> DataFrame:
    """Precision at n per model over users with positives that the training part knows."""
    positives = semi_known(test.filter(F.col(RATING) >= min_rating), train, [USER])
    out = None
    for name, ranked in lists.items():
        row = precision_at_n(ranked, positives, n).withColumn("model", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


# ---- matrix factorisation -----------------------------------------------------------------------


def biases(train: DataFrame) -> tuple[Column, DataFrame, DataFrame]:
    """Global mean, user offsets (mean of r - mean), item offsets (mean of r - mean - user offset)."""
    mean = train.select(F.avg(RATING)).scalar()
    users = train.groupBy(USER).agg((F.avg(RATING) - mean).alias("user_bias"))
    items = train.join(users, USER).groupBy(ITEM).agg((F.avg(F.col(RATING) - F.col("user_bias")) - mean).alias("item_bias"))
    return mean, users, items


def baseline(pairs: DataFrame, mean: Column, users: DataFrame, items: DataFrame) -> DataFrame:
    """Adds ``base`` = mean + known offsets."""
    joined = pairs.join(users, USER, "left").join(items, ITEM, "left")
    base = mean + F.coalesce("user_bias", F.lit(0.0)) + F.coalesce("item_bias", F.lit(0.0))
    return joined.withColumn("base", base).drop("user_bias", "item_bias")


def clipped(col: Column, low: float = 1.0, high: float = 5.0) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


# rounds of a factor fit between checkpoints: all factors shipped since the last one stay on local disk
ROUNDS_KEPT = 2
MANY = 4_000_000  # ratings whose fit keeps all cores busy and ships much: one round is kept, and one fold runs at a time
BLOCK_RATINGS = 10_000_000  # ratings of a block of users or items, which a task holds


def _als(train: DataFrame, rating: str, rank: int, iterations: int, reg: float, **kw):
    shared_dir(train.sparkSession)
    n = train.count()
    blocks = max(10, -(-n // BLOCK_RATINGS))
    kw = {"checkpointInterval": ROUNDS_KEPT} | kw | ({"checkpointInterval": 1} if n > MANY else {})
    return ALS(
        userCol=USER, itemCol=ITEM, ratingCol=rating, rank=rank, maxIter=iterations, regParam=reg, seed=42, coldStartStrategy="nan",
        numUserBlocks=blocks, numItemBlocks=blocks, **kw
    ).fit(train)


def _or(col: str, default) -> Column:
    return F.when(F.isnan(col) | F.col(col).isNull(), default).otherwise(F.col(col).cast("double"))


def mf_explicit(train: DataFrame, test: DataFrame, rank: int = 100, iterations: int = 20, reg: float = 0.1, **kw) -> DataFrame:
    """Biases plus latent factors of the residuals, clipped to the rating range: test rows + ``prediction``."""
    parts = biases(train)
    rest = written(baseline(train, *parts).withColumn("rest", F.col(RATING) - F.col("base")), "residuals")
    model = _als(rest.select(*PAIR, "rest"), "rest", rank, iterations, reg, **kw)
    scored = model.transform(baseline(test, *parts))
    return scored.withColumn("prediction", clipped(F.col("base") + _or("prediction", F.lit(0.0)))).drop("base")


def mf_nonnegative(train: DataFrame, rank: int = 15, iterations: int = 50, reg: float = 0.1):
    """Factor model with non-negative factors, which can be read as topics of taste."""
    return _als(train, RATING, rank, iterations, reg, nonnegative=True)


def predict_nonnegative(model, train: DataFrame, test: DataFrame) -> DataFrame:
    mean = train.select(F.avg(RATING)).scalar()
    return model.transform(test).withColumn("prediction", clipped(_or("prediction", mean)))


def factor_rows(factors: DataFrame, id: str) -> DataFrame:
    """(id, factor, weight) from a factor table."""
    return factors.select(F.col("id").alias(id), F.posexplode("features").alias("factor", "weight"))


def factor_top_items(model, n: int = 10) -> DataFrame:
    """Best n items of every latent factor."""
    return topn_per_group(factor_rows(model.itemFactors, ITEM), ["factor"], "weight", n, [ITEM])


def user_profile(model, users: DataFrame) -> DataFrame:
    return factor_rows(model.userFactors, USER).join(users.select(USER).distinct(), USER, "left_semi")


def mf_implicit_blend(train: DataFrame, test: DataFrame, rank: int = 20, iterations: int = 20, reg: float = 0.1) -> DataFrame:
    """Explicit model plus a signal from which items were rated, fitted on the explicit residuals."""
    scored = mf_explicit(train, train.unionByName(test), rank, iterations, reg, checkpointInterval=ROUNDS_KEPT)
    explicit = written(scored.withColumnRenamed("prediction", "explicit"), "explicit")
    ones = train.select(*PAIR, F.lit(1.0).alias("one"))
    signal = _als(ones, "one", rank, iterations, reg, implicitPrefs=True, alpha=1.0, checkpointInterval=ROUNDS_KEPT)
    both = signal.transform(explicit).withColumn("signal", _or("prediction", F.lit(0.0))).drop("prediction")
    known = both.join(train.select(*PAIR), PAIR, "left_semi")
    line = known.agg(
        F.regr_slope(F.col(RATING) - F.col("explicit"), F.col("signal")).alias("a"),
        F.regr_intercept(F.col(RATING) - F.col("explicit"), F.col("signal")).alias("b"),
    ).first()
    slope, shift = line["a"] or 0.0, line["b"] or 0.0
    tested = both.join(test.select(*PAIR), PAIR, "left_semi")
    return tested.select(*PAIR, RATING, clipped(F.col("explicit") + F.col("signal") * slope + shift).alias("prediction"))


def vector_sums(df: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """Sum of an array column per key, with partial sums before the shuffle."""
    sums = df.withColumn("_vec", array_to_vector(vec)).groupBy(*keys).agg(Summarizer.sum(F.col("_vec")).alias("_sum"))
    return sums.select(*keys, vector_to_array("_sum").alias(vec))


def _parts(k: int) -> list[str]:
    """Names of the columns of a vector: plain columns are added up by Spark's hash aggregate, arrays would not be."""
    return [f"v{j}" for j in range(k)]


def _times(vectors: DataFrame, id: str, matrix: np.ndarray) -> DataFrame:
    """Each row's vector times a matrix."""
    old, new = _parts(matrix.shape[0]), _parts(matrix.shape[1])

    def multiply(batches):
        for batch in batches:
            out = pd.DataFrame(batch[old].to_numpy(float) @ matrix, columns=new)
            out.insert(0, id, batch[id].to_numpy())
            yield out

    fields = ", ".join(f"{c} double" for c in new)
    return vectors.mapInPandas(multiply, f"{id} {vectors.schema[id].dataType.simpleString()}, {fields}")


def _gram(vectors: DataFrame, k: int) -> np.ndarray:
    """Sum of outer products: k * k numbers per partition, summed by Spark."""

    def outer(batches):
        total = np.zeros((k, k))
        for batch in batches:
            m = batch.to_numpy(float)
            total += m.T @ m
        yield pd.DataFrame({"g": [total.ravel()]})

    parts = vectors.select(_parts(k)).mapInPandas(outer, "g array<double>")
    return np.array(vector_sums(parts, [], "g").first()["g"]).reshape(k, k)


def _project(rest: DataFrame, mean: float, vectors: DataFrame, by: str, to: str, k: int) -> DataFrame:
    """Product of the filled matrix (or its transpose) with the vectors keyed by ``by``."""
    names = _parts(k)
    const = vectors.agg(*[F.sum(v).alias(v) for v in names]).first()
    sums = rest.join(vectors, by).groupBy(to).agg(*[F.sum(F.col("r") * F.col(v)).alias(v) for v in names])
    return sums.select(to, *[(F.col(v) + F.lit(const[v] * mean)).alias(v) for v in names])


def naive_svd(train: DataFrame, test: DataFrame, k: int = 20, iterations: int | None = None, seed: int = 42, settled: float = 0.01) -> DataFrame:
    """Rank-k rebuild of the mean-filled matrix, evaluated on known pairs only: (pair, rating, prediction).

    The filled matrix is mean + sparse part, so its products with a thin matrix are joins of the ratings
    with k-vectors plus one constant vector; the dense matrix never exists.  Subspace iteration with a
    Gram-matrix orthonormalisation finds the leading directions; every step is written out.  Without
    ``iterations`` it goes on until the squares held by all directions but the first, which is the mean's, grow by
    no more than the share ``settled``; they are at most those of the matrix, so it ends.
    """
    mean = float(train.agg(F.avg(RATING)).first()[0])
    rest = train.select(*PAIR, (F.col(RATING) - F.lit(mean)).alias("r"))
    start = [
        ((F.pmod(F.xxhash64(F.col(ITEM), F.lit(j), F.lit(seed)), F.lit(2000001)) - 1000000) / F.lit(1000000.0)).alias(v)
        for j, v in enumerate(_parts(k))
    ]
    basis = train.select(ITEM).distinct().select(ITEM, *start)

    held = 0.0
    for step in count():
        if step:
            users = written(_project(rest, mean, basis, ITEM, USER, k), "svd-users")
            basis = _project(rest, mean, users, USER, ITEM, k)
        basis = written(basis, "svd-items")
        gram = _gram(basis, k)
        values, vectors = np.linalg.eigh(gram)
        keep = values > values.max() * 1e-12
        whiten = vectors[:, keep] / np.sqrt(values[keep])
        basis = written(_times(basis, ITEM, whiten), "svd-basis")
        k = int(keep.sum())
        before, held = held, float(np.sqrt(values[keep][:-1]).sum())
        if step == iterations or (iterations is None and step > 1 and held - before <= settled * held):
            break
    users = _project(rest, mean, basis, ITEM, USER, k)
    known = semi_known(test, train, PAIR)
    # thin rows meet the users' vectors first, then the items'
    pairs = known.join(users.withColumnsRenamed({v: f"u{v}" for v in _parts(k)}), USER).join(basis, ITEM)
    dot = sum((F.col(f"u{v}") * F.col(v) for v in _parts(k)), F.lit(0.0))
    return pairs.select(*PAIR, RATING, dot.alias("prediction"))


def rating_errors(df: DataFrame) -> DataFrame:
    e = F.col(RATING) - F.col("prediction")
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("n"))


def cross_validate_mf(ratings: DataFrame, predict, key: Column, folds: int = 5, model: str = "model", parallelism: int = 1) -> DataFrame:
    """RMSE and MAE averaged over folds; ``predict(train, test)`` gives test rows with ``prediction``.  Folds run
    ``parallelism`` at a time: a fit is many short jobs, which alone leave cores idle.  Folds of many ratings run one
    after the other, as each fills the cores, and disks hold what all of them ship."""
    split = written(kfold(ratings.withColumn("_k", key), "_k", folds).drop("_k"), "folds")
    if split.count() > MANY:
        parallelism = 1

    def run(fold: int) -> tuple:
        train = split.filter(F.col("fold") != fold).drop("fold")
        return tuple(rating_errors(predict(train, split.filter(F.col("fold") == fold).drop("fold"))).first())

    out = ratings.sparkSession.createDataFrame(at_once(ratings.sparkSession, run, range(folds), parallelism), "rmse double, mae double, n long")
    return out.agg(F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"), F.sum("n").alias("n")).withColumn("model", F.lit(model))


def sparse_variant(ratings: DataFrame, key: Column, sparsity: float = 0.99, order: Column | None = None) -> DataFrame:
    """The share of the ratings that is left after dropping ``sparsity`` of them."""
    return sample_fraction(ratings.withColumn("_k", key), "_k", 1 - sparsity, order=order).drop("_k")


def enough_rows(ratings: DataFrame, minimum: int = 10) -> bool:
    return ratings.limit(minimum).count() >= minimum
