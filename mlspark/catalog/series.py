"""Time series queries on daily and monthly sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.catalog.ordered import rounded
from mlspark.operators import timeseries as S
from mlspark.operators.metrics import regression_metrics
from mlspark.plans.views import DAILY, MONTHLY, daily_sales, monthly_sales
from mlspark.session import written

KEYS = ("series_id", "month", "value")


@query(
    "X1_unit_root_test",
    "WITH " + DAILY + """, p AS (SELECT series_id, value - lag(value) OVER w AS d, lag(value) OVER w AS x FROM daily_sales WINDOW w AS (PARTITION BY series_id ORDER BY day)),
    r AS (SELECT series_id, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx, regr_syy(d, x) AS syy, count(*) AS n FROM p WHERE x IS NOT NULL GROUP BY 1),
    s AS (SELECT *, b / sqrt((syy - b * b * sxx) / (n - 2) / sxx) AS st FROM r)
    SELECT series_id, round(st, 4) AS statistic, 0 AS lags, n, CAST(-2.86 AS DOUBLE) AS critical_value, st < -2.86 AS stationary FROM s""",
)
def x1(spark, sf):
    return rounded(S.unit_root_test(daily_sales(spark, sf), "series_id", "day", "value"), 4, "statistic")


@query("X1_augmented_unit_root_test")
def x1_augmented(spark, sf):
    return S.augmented_unit_root_test(daily_sales(spark, sf), "series_id", "day", "value")


@query("X2_rolling_forecast")
def x2(spark, sf):
    return S.rolling_forecast(monthly_sales(spark, sf), *KEYS)


@query("X3_seasonal_rolling_forecast")
def x3(spark, sf):
    return S.seasonal_rolling_forecast(monthly_sales(spark, sf), *KEYS)


NAIVE = """nv AS (SELECT series_id, month, value AS actual, lag(value, {lag}) OVER w AS forecast, '{name}' AS model,
      row_number() OVER w AS idx, count(*) OVER (PARTITION BY series_id) AS n FROM monthly_sales WINDOW w AS (PARTITION BY series_id ORDER BY month))"""


@query(
    "X3_seasonal_naive",
    "WITH " + MONTHLY + ", " + NAIVE.format(lag=12, name="seasonal naive")
    + " SELECT series_id, month, actual, forecast, model FROM nv WHERE idx > floor(n * CAST(0.8 AS DOUBLE))",
)
def x3_naive(spark, sf):
    return S.naive_forecast(monthly_sales(spark, sf), *KEYS, lag=12, model="seasonal naive")


@query("X4_compare_forecasts")
def x4(spark, sf):
    sales = written(monthly_sales(spark, sf), "monthly")
    table, best = S.compare_forecasts([S.rolling_forecast(sales, *KEYS), S.seasonal_rolling_forecast(sales, *KEYS)], "series_id")
    return table.join(best, "series_id")


@query(
    "X4_compare_baselines",
    "WITH " + MONTHLY + ", " + NAIVE.format(lag=1, name="naive").replace("nv AS", "n1 AS") + ", " + NAIVE.format(lag=12, name="seasonal naive").replace("nv AS", "n12 AS")
    + """, f AS (SELECT * FROM n1 UNION ALL SELECT * FROM n12), t AS (SELECT * FROM f WHERE idx > floor(n * CAST(0.8 AS DOUBLE)) AND forecast IS NOT NULL),
    m AS (SELECT series_id, model, avg(abs(actual - forecast)) AS mae, sqrt(avg((actual - forecast) * (actual - forecast))) AS rmse,
                 avg(abs((actual - forecast) / actual)) * 100 AS mape FROM t GROUP BY 1, 2)
    SELECT series_id, model, round(mae, 2) AS mae, round(rmse, 2) AS rmse, round(mape, 4) AS mape,
           arg_min(model, rmse) OVER (PARTITION BY series_id) AS best FROM m""",
)
def x4_baselines(spark, sf):
    sales = monthly_sales(spark, sf)
    table, best = S.compare_forecasts(
        [S.naive_forecast(sales, *KEYS, lag=1, model="naive"), S.naive_forecast(sales, *KEYS, lag=12, model="seasonal naive")], "series_id"
    )
    out = table.join(best.select("series_id", "best"), "series_id").select("series_id", "model", "mae", "rmse", "mape", "best")
    return rounded(rounded(out, 2, "mae", "rmse"), 4, "mape")


@query("X5_structural_decompose")
def x5(spark, sf):
    return S.structural_decompose(monthly_sales(spark, sf), *KEYS)


@query("X5_structural_variances")
def x5_variances(spark, sf):
    return S.structural_variances(monthly_sales(spark, sf), *KEYS)


@query(
    "X5_decompose_baseline",
    "WITH " + MONTHLY.replace("CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)", "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 997")
    + """, t AS (SELECT *, CASE WHEN count(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 THEN
        (sum(value) OVER (w ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + (lag(value, 6) OVER w + lead(value, 6) OVER w) / 2) / 12 END AS trend
      FROM monthly_sales WINDOW w AS (PARTITION BY series_id ORDER BY month)),
    s AS (SELECT series_id, month(month) AS m, avg(value - trend) AS seasonal FROM t WHERE trend IS NOT NULL GROUP BY 1, 2)
    SELECT t.series_id, t.month, value, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(value - trend - seasonal, 6) AS residual
    FROM t LEFT JOIN s ON s.series_id = t.series_id AND s.m = month(t.month)""",
)
def x5_baseline(spark, sf):
    # an odd unit, so that no mean of whole cents falls on a rounding half
    sales = monthly_sales(spark, sf).withColumn("value", F.col("value") / 997)
    return rounded(S.decompose_baseline(sales, *KEYS), 6, "trend", "seasonal", "residual")


@query("X6_lag_regressor")
def x6(spark, sf):
    return S.lag_regressor(daily_sales(spark, sf), "series_id", "day", "value", 60)


@query("X6_lag_regressor_metrics")
def x6_metrics(spark, sf):
    out = S.lag_regressor(daily_sales(spark, sf), "series_id", "day", "value", 60)
    return regression_metrics(out, "actual", "prediction", ["series_id"]).withColumn("step", F.lit(60))
