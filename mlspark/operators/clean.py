"""Cleaning: missing values, rules, validation, category columns, calendars."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.functions.columns import to_numeric
from mlspark.plans.ordered import row_index
from mlspark.session import written


def to_numeric_coerce(df: DataFrame, cols: Sequence[str], kind: str = "double") -> DataFrame:
    return df.withColumns({c: to_numeric(c, kind) for c in cols})


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols else None)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def categories(df: DataFrame, cols: Sequence[str]) -> dict[str, list]:
    """Sorted distinct values per column, for forms in which each becomes a column or a literal.

    The list reaches the driver, as the plan itself has an entry for each value; for columns of many values the
    callers have a sparse form, which keeps the values in a table.
    """
    return {c: sorted(r[0] for r in df.select(c).filter(F.col(c).isNotNull()).distinct().collect()) for c in cols}


def category_index(df: DataFrame, col: str) -> DataFrame:
    """(_value, _place): every distinct value with its 0-based place in sorted order, numbered on the executors."""
    values = df.select(F.col(col).alias("_value")).filter("_value IS NOT NULL").distinct()
    ranged = values.repartitionByRange("_value").sortWithinPartitions("_value").withColumn("_id", F.monotonically_increasing_id())
    indexed = row_index(written(ranged, "categories"), [], "_id", out="_idx")
    return written(indexed.select("_value", (F.col("_idx") - 1).alias("_place")), "category-index")


def one_hot_sparse(df: DataFrame, col: str, index: DataFrame, out: str, drop_first: bool = False) -> DataFrame:
    """Adds a sparse 0/1 vector over the places of ``index``; an unseen or missing value gives all 0."""
    skip = int(drop_first)
    n = index.count() - skip
    # n stands for no category: the encoder keeps it as a last place and drops that
    place = F.when(F.col("_place") >= skip, F.col("_place") - skip).otherwise(F.lit(n)).cast("double")
    joined = df.join(index, F.col(col) == F.col("_value"), "left").withColumn("_place", place)
    encoder = OneHotEncoder(inputCols=["_place"], outputCols=[out], handleInvalid="keep", dropLast=True)
    sizes = df.sparkSession.range(n).select(F.col("id").cast("double").alias("_place"))
    return encoder.fit(sizes).transform(joined).drop("_value", "_place")


def one_hot(
    df: DataFrame,
    cols: Sequence[str],
    drop_first: bool = False,
    fitted: Mapping[str, Sequence] | None = None,
    sparse: bool = False,
) -> DataFrame:
    """0/1 columns ``col_value`` in sorted category order, replacing the column; missing gives all 0.

    ``sparse`` gives one sparse vector ``col_onehot`` per column in that order instead, whatever the number of
    categories: the form is the caller's choice and does not change with the data.
    """
    if sparse:
        for c in cols:
            df = one_hot_sparse(df, c, category_index(df, c), f"{c}_onehot", drop_first)
        return df.drop(*cols)
    known = fitted or categories(df, cols)
    out = [F.col(c) for c in df.columns if c not in cols]
    for c in cols:
        for value in known[c][1 if drop_first else 0:]:
            out.append(F.coalesce((F.col(c) == value).cast("int"), F.lit(0)).alias(f"{c}_{value}"))
    return df.select(*out)


def rule_flags(
    df: DataFrame, rules: Mapping[str, Column], fired: str = "fired_rules", tag: str | None = "anomaly_prediction"
) -> DataFrame:
    """Adds the array of rules that hold, and -1 for rows with at least one of them, 1 for the others."""
    names = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    out = df.withColumn(fired, names)
    if tag:
        out = out.withColumn(tag, F.when(F.size(fired) > 0, -1).otherwise(1))
    return out


def matching(df: DataFrame, rules: Mapping[str, Column], combine: str = "or") -> DataFrame:
    """Rows for which any rule (or every rule) holds."""
    join = (lambda a, b: a | b) if combine == "or" else (lambda a, b: a & b)
    return df.filter(reduce(join, rules.values()))


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def validate_rows(df: DataFrame, constraints: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the names of the broken constraints); NULL breaks a constraint."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in constraints.items()])
    )
    checked = df.withColumn("reasons", broken)
    return checked.filter(F.size("reasons") == 0).drop("reasons"), checked.filter(F.size("reasons") > 0)


def most_frequent(df: DataFrame, cols: Sequence[str]) -> dict:
    """Most frequent value per column, the smallest on ties; counts are summed before they meet."""
    out = {}
    for c in cols:
        top = (
            df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(c)).first()
        )
        out[c] = top[0] if top else None
    return out


def fit_fill(df: DataFrame, mean: Sequence[str] = (), mode: Sequence[str] = (), constant: Mapping | None = None) -> dict:
    """Fill values learned from ``df``: one row of means, the most frequent values, given constants."""
    values: dict = dict(constant or {})
    if mean:
        values.update(df.agg(*[F.avg(c).alias(c) for c in mean]).first().asDict())
    values.update(most_frequent(df, mode))
    return values


def apply_fill(df: DataFrame, values: Mapping) -> DataFrame:
    def filled(c: str) -> Column:
        value = values.get(c)
        return F.col(c) if value is None else F.coalesce(F.col(c), F.lit(value)).alias(c)

    return df.select(*[filled(c) for c in df.columns])


def impute(df: DataFrame, mean: Sequence[str] = (), mode: Sequence[str] = (), constant: Mapping | None = None) -> DataFrame:
    return apply_fill(df, fit_fill(df, mean, mode, constant))


def resample_monthly(df: DataFrame, series: str, ts: str, value: str, out: str = "month") -> DataFrame:
    """Monthly means from the first to the last month of each series; empty months repeat the last mean."""
    monthly = df.groupBy(series, F.trunc(F.col(ts).cast("date"), "month").alias(out)).agg(F.avg(value).alias(value))
    span = monthly.groupBy(series).agg(F.min(out).alias("_lo"), F.max(out).alias("_hi"))
    calendar = span.select(series, F.explode(F.expr("sequence(_lo, _hi, interval 1 month)")).alias(out))
    # one row per calendar month: a series holds a few hundred rows at most
    order = W.partitionBy(series).orderBy(out)
    return calendar.join(monthly, [series, out], "left").select(
        series, out, F.last(value, ignorenulls=True).over(order).alias(value)
    )
