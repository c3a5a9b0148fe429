"""Time series, many series at once.

The model-based operators give one series to one task.  They expect a regular calendar grid (one row
per month or day), so a series is bounded by the calendar; the work spreads over series.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mlspark.functions.columns import inverse_minmax
from mlspark.operators.features import fit_minmax, minmax
from mlspark.operators.metrics import best_by, regression_metrics
from mlspark.operators.windows import chronological_split, supervised_windows
from mlspark.plans.arima import Shape, fit
from mlspark.plans.ordered import null_safe_join
from mlspark.plans.structural import NOISES, Structure
from mlspark.session import ship, written

# fixed value: 5 % critical value of the Dickey-Fuller test with a constant, large sample
CRITICAL = -2.86
TOO_SHORT = "series too short"


# ---- unit root ------------------------------------------------------------------------------------


def unit_root_test(df: DataFrame, series: str, ts: str, value: str, critical: float = CRITICAL) -> DataFrame:
    """Zero-lag Dickey-Fuller statistic per series: the t value of the level in a regression of the
    change on the level, from one aggregate."""
    w = W.partitionBy(series).orderBy(ts)
    pairs = df.select(series, (F.col(value) - F.lag(value).over(w)).alias("d"), F.lag(value).over(w).alias("x")).filter("x IS NOT NULL")
    fit = pairs.groupBy(series).agg(
        F.regr_slope("d", "x").alias("b"), F.regr_sxx("d", "x").alias("sxx"), F.regr_syy("d", "x").alias("syy"), F.count(F.lit(1)).alias("n")
    )
    sigma2 = (F.col("syy") - F.col("b") * F.col("b") * F.col("sxx")) / (F.col("n") - 2)
    stat = F.col("b") / F.sqrt(sigma2 / F.col("sxx"))
    return fit.select(
        series, stat.alias("statistic"), F.lit(0).alias("lags"), "n", F.lit(critical).alias("critical_value"), (stat < critical).alias("stationary")
    )


def augmented_unit_root_test(df: DataFrame, series: str, ts: str, value: str, lags: int | None = None, critical: float = CRITICAL) -> DataFrame:
    """Augmented statistic; without ``lags`` the number is chosen by AIC up to 12 (n / 100) ** 0.25.

    A series too short for the lags asked for keeps its row, with missing results and the reason.
    """
    kind = df.schema[series].dataType.simpleString()

    def fit(y: np.ndarray, k: int, top: int) -> tuple[float, float, int]:
        d = np.diff(y)
        rows = np.arange(top, len(d))
        x = np.column_stack([y[rows], *[d[rows - j] for j in range(1, k + 1)], np.ones(len(rows))])
        beta, *_ = np.linalg.lstsq(x, d[rows], rcond=None)
        rest = d[rows] - x @ beta
        free = max(1, len(rows) - x.shape[1])
        sigma2 = rest @ rest / free
        se = np.sqrt(sigma2 * np.linalg.pinv(x.T @ x)[0, 0])
        aic = len(rows) * np.log(max(rest @ rest / len(rows), 1e-300)) + 2 * x.shape[1]
        return (beta[0] / se if se > 0 else np.nan), aic, len(rows)

    def test(rows: pd.DataFrame) -> pd.DataFrame:
        y = rows.sort_values(ts)[value].to_numpy(float)
        # a fit with k lags needs more rows than its k + 2 coefficients
        most = lags if lags is not None else max(0, min(int(np.ceil(12 * (len(y) / 100) ** 0.25)), (len(y) - 1) // 2 - 2))
        if len(y) - 1 - most < most + 3:
            row = (rows[series].iloc[0], None, most, max(0, len(y) - 1 - most), critical, None, TOO_SHORT)
            return pd.DataFrame([row], columns=cols)
        best = lags if lags is not None else min(range(most + 1), key=lambda k: fit(y, k, most)[1])
        stat, _, n = fit(y, best, best)
        return pd.DataFrame([(rows[series].iloc[0], stat, best, n, critical, bool(stat < critical), None)], columns=cols)

    cols = [series, "statistic", "lags", "n", "critical_value", "stationary", "reason"]
    return df.select(series, ts, value).groupBy(series).applyInPandas(
        test, f"{series} {kind}, statistic double, lags int, n long, critical_value double, stationary boolean, reason string"
    )


# ---- rolling forecasts -----------------------------------------------------------------------------


def _products(short: int, seasonal: int, period: int) -> list[int]:
    """Lags of the product of a short and a seasonal polynomial, cross terms included."""
    return sorted({i + period * j for i in range(short + 1) for j in range(seasonal + 1)} - {0})


def _enough(shape: Shape, start: int) -> bool:
    """Whether the first ``start`` values hold every lag of the model and more values than parameters."""
    (p, _, q), (sp, _, sq, s) = shape.order, shape.seasonal
    ar, ma = _products(p, sp, s), _products(q, sq, s)
    lost = len(shape.difference()) - 1
    return start >= lost + max([*ar, *ma, 1]) + len(ar) + len(ma) + int(shape.mean) + 1


def _one_step(y: np.ndarray, shape: Shape, cuts: Sequence[int]) -> list[tuple[float, float, float]]:
    """(forecast, AIC, BIC) for each cut: the model fitted by maximum likelihood to all values before it.

    A fit begins where the one before ended.
    """
    out, x = [], None
    for cut in cuts:
        x, best, n, forecast = fit(y[:cut], shape, x)
        k = shape.parameters + 1
        out.append((forecast, 2 * k - 2 * best, k * np.log(n) - 2 * best))
    return out


NO_SEASON = (0, 0, 0, 1)
CUTS = 8  # steps that one task fits one after the other


def rolling_forecast(
    df: DataFrame,
    series: str,
    ts: str,
    value: str,
    order: tuple[int, int, int] = (1, 1, 1),
    seasonal: tuple[int, int, int, int] = NO_SEASON,
    test_ratio: float = 0.2,
    model: str = "ARIMA",
) -> DataFrame:
    """(series, ts, actual, forecast, aic, bic, model, reason) on the last part of each series; every step
    is fitted by maximum likelihood on all earlier values and looks one step ahead.

    ``CUTS`` steps of a series are one task's work, which holds the series up to them; AIC and BIC are those of
    a row's own fit.  A series whose first part is too short for the model keeps its rows, without forecasts
    and with the reason; one too short to be split shows all its rows so.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in (series, ts)}
    shape = Shape(tuple(order), tuple(seasonal))
    ship(df.sparkSession)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["_first"].iloc[0])
        rows = rows.sort_values(ts)
        y = rows[value].to_numpy(float)
        start = int(rows["_start"].iloc[0])
        cuts = range(first, min(first + CUTS, len(y)))
        out = rows.iloc[list(cuts)][[series, ts]].copy().assign(actual=y[list(cuts)])
        if not _enough(shape, start):
            return out.assign(forecast=np.nan, aic=np.nan, bic=np.nan, model=model, reason=TOO_SHORT)
        forecast, aic, bic = zip(*_one_step(y, shape, cuts), strict=True)
        return out.assign(forecast=forecast, aic=aic, bic=bic, model=model, reason=None)

    columns = f"{series} {kinds[series]}, {ts} {kinds[ts]}, actual double, forecast double, aic double, bic double, model string, reason string"
    rows = df.select(series, ts, value)
    sizes = rows.groupBy(series).agg(F.count(F.lit(1)).alias("_n"))
    split = F.floor(F.col("_n") * F.lit(1 - test_ratio))
    sizes = sizes.withColumn("_start", F.when(split < F.col("_n"), split).otherwise(0).cast("int"))
    steps = F.sequence("_start", (F.col("_n") - 1).cast("int"), F.lit(CUTS))
    rows = null_safe_join(rows, sizes, [series]).select(series, ts, value, "_start", F.explode(steps).alias("_first"))
    fitted = rows.groupBy(series, "_first").applyInPandas(run, columns)
    return fitted.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("forecast", "aic", "bic")})


def seasonal_rolling_forecast(df, series, ts, value, order=(1, 1, 1), seasonal=(1, 1, 1, 12), test_ratio=0.2, model="SARIMA") -> DataFrame:
    return rolling_forecast(df, series, ts, value, order, seasonal, test_ratio, model)


def naive_forecast(df: DataFrame, series: str, ts: str, value: str, lag: int = 1, test_ratio: float = 0.2, model: str = "naive") -> DataFrame:
    """The value ``lag`` steps before, on the last part of each series."""
    w = W.partitionBy(series).orderBy(ts)
    split = chronological_split(df.withColumn("forecast", F.lag(value, lag).over(w)), [series], ts, test_ratio, calendar=True)
    return split.filter("part = 'test'").select(series, ts, F.col(value).alias("actual"), "forecast", F.lit(model).alias("model"))


def compare_forecasts(forecasts: Sequence[DataFrame], series: str) -> tuple[DataFrame, DataFrame]:
    """(metrics per series and model, best model per series by RMSE).

    A model without any forecast for a series keeps its row, with missing metrics, and is never best.
    """
    both = None
    for f in forecasts:
        rows = f.select(series, "model", "actual", "forecast")
        both = rows if both is None else both.unionByName(rows)
    table = regression_metrics(both.filter("forecast IS NOT NULL"), "actual", "forecast", [series, "model"])
    best = best_by(table, "model", "rmse", largest=False, by=[series])
    return null_safe_join(both.select(series, "model").distinct(), table, [series, "model"], "left"), best


# ---- decomposition -------------------------------------------------------------------------------------


def decompose_baseline(df: DataFrame, series: str, ts: str, value: str, period: int = 12) -> DataFrame:
    """Centred moving average of one period and the mean deviation per calendar month."""
    w = W.partitionBy(series).orderBy(ts)
    half = period // 2
    full = F.count(value).over(w.rowsBetween(-half, half)) == 2 * half + 1
    ends = (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    inner = F.sum(value).over(w.rowsBetween(1 - half, half - 1))
    trend = df.withColumn("trend", F.when(full, (inner + ends) / period))
    month = F.month(ts)
    season = trend.filter("trend IS NOT NULL").groupBy(series, month.alias("_m")).agg(F.avg(F.col(value) - F.col("trend")).alias("seasonal"))
    joined = trend.withColumn("_m", month).join(season, [series, "_m"], "left").drop("_m")
    return joined.withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal"))


def structural_variances(df: DataFrame, series: str, ts: str, value: str, period: int = 12) -> DataFrame:
    """Noise variances of level, slope, seasonal and irregular part by maximum likelihood, one row per series.

    The likelihood is that of the values after the first period and one.  A series shorter than a period
    and three values keeps its row, with missing figures and the reason.
    """
    kind = df.schema[series].dataType.simpleString()
    columns = [series, *[f"{p}_variance" for p in NOISES], "log_likelihood", "n", "reason"]
    model = Structure(period)
    ship(df.sparkSession)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        y = rows.sort_values(ts)[value].to_numpy(float)
        key = rows[series].iloc[0]
        if len(y) < period + 3:
            return pd.DataFrame([(key, *[None] * 5, len(y), TOO_SHORT)], columns=columns)
        variances, best = model.fit(y)
        return pd.DataFrame([(key, *variances, best, len(y), None)], columns=columns)

    schema = f"{series} {kind}, " + ", ".join(f"{c} double" for c in columns[1:6]) + ", n long, reason string"
    return df.select(series, ts, value).groupBy(series).applyInPandas(run, schema)


def structural_decompose(df: DataFrame, series: str, ts: str, value: str, period: int = 12) -> DataFrame:
    """Level, slope and seasonal parts with 95 % bands, and the one-step fit.

    The four noise variances are those of greatest likelihood; a fixed-interval smoother gives
    the parts.  The first period and one values have no fit, as nothing is assumed of the start.  A series shorter than a period and three values keeps its rows, with missing parts.
    """
    kinds = {c: df.schema[c].dataType.simpleString() for c in (series, ts)}
    parts = NOISES[:3]
    columns = [series, ts, value, "fitted", *[f"{p}{s}" for p in parts for s in ("", "_lo", "_hi")]]
    model = Structure(period)
    ship(df.sparkSession)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(ts)
        y = rows[value].to_numpy(float)
        if len(y) < period + 3:
            return rows[[series, ts]].assign(**{value: y}).reindex(columns=columns)
        fitted, state, var = model.parts(y, model.fit(y)[0])
        out = pd.DataFrame({series: rows[series].to_numpy(), ts: rows[ts].to_numpy(), value: y, "fitted": fitted})
        for at, part in enumerate(parts):
            width = 1.96 * np.sqrt(var[:, at])
            out[part], out[f"{part}_lo"], out[f"{part}_hi"] = state[:, at], state[:, at] - width, state[:, at] + width
        return out[columns]

    schema = f"{series} {kinds[series]}, {ts} {kinds[ts]}, " + ", ".join(f"{c} double" for c in columns[2:])
    out = df.select(series, ts, value).groupBy(series).applyInPandas(run, schema)
    return out.withColumn("fitted", F.nanvl("fitted", F.lit(None).cast("double")))


# ---- lag regression --------------------------------------------------------------------------------------


def lag_regressor(
    df: DataFrame, series: str, ts: str, value: str, step: int = 60, test_ratio: float = 0.2, scale_on_all: bool = False
) -> DataFrame:
    """Next value from the ``step`` values before: (series, ts, actual, prediction) on the test part.

    Values are min-max scaled by the training part (by all rows with ``scale_on_all``), one linear
    model serves all series, and each series is shifted so that its first prediction meets its last
    training value.
    """
    split = written(chronological_split(df.select(series, ts, value), [series], ts, test_ratio, step, calendar=True), "lagged")
    params = fit_minmax(split if scale_on_all else split.filter("part = 'train'"), [value])[value]
    windows = supervised_windows(
        split.withColumn("_v", minmax(value, params)), [series], ts, "_v", step, target="_target", calendar=True
    ).select(series, F.col("target_order").alias(ts), "window", "_target")
    assemble = VectorAssembler(inputCols=[f"l{i}" for i in range(step)], outputCol="_x")
    spread = windows.select("*", *[F.col("window")[i].alias(f"l{i}") for i in range(step)])
    data = assemble.transform(spread).select(series, ts, "_x", "_target").join(split.select(series, ts, "part", F.col(value).alias("actual")), [series, ts])
    data = written(data, "windows")
    model = LinearRegression(featuresCol="_x", labelCol="_target", regParam=1e-4).fit(data.filter("part = 'train'"))
    low, high = (F.lit(float(v)) for v in params)
    scored = model.transform(data.filter("part = 'test'")).select(
        series, ts, "actual", inverse_minmax("prediction", low, high).alias("raw")
    )
    last = split.filter("part = 'train'").groupBy(series).agg(F.max_by(value, ts).alias("_last"))
    first = scored.groupBy(series).agg(F.min_by("raw", ts).alias("_first"))
    return (
        scored.join(last, series)
        .join(first, series)
        .select(series, ts, "actual", (F.col("raw") + F.col("_last") - F.col("_first")).alias("prediction"))
    )


