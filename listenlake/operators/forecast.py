"""Daily play forecast from built-in aggregates.

The model is additive: a linear trend plus a weekday effect.  It is simpler than a
Bayesian trend with change points and gives other numbers.  A within-day pattern
cannot be found on one value per day, so there is none.

The only input is the daily series, already aggregated: a window partition holds
one row per calendar day of one series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.session import ensure_checkpoint_dir

# Horizon in days, least history, 80 % normal quantile, decimals.
HORIZON_DAYS = 7
MIN_DAYS = 2
Z_80 = 1.2816
METRIC_DECIMALS = 2

# Parameter names of the run log. The model has no within-day pattern.
RUN_PARAMS = {
    "forecast_periods": str(HORIZON_DAYS),
    "weekly_seasonality": "True",
    "daily_seasonality": "False",
    "yearly_seasonality": "False",
    "model_type": "linear trend with weekday effect",
}

_SERIES = "_series"


def _with_future(daily: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """History rows, then ``horizon`` days with ``y`` NULL after each series' last day.

    ``t`` is the number of days since the first one.  A series with too little
    history gives no rows.
    """
    whole = Window.partitionBy(*keys)
    last = F.max("ds").over(whole)
    spans = daily.select(
        *keys,
        "ds",
        "y",
        last.alias("_last"),
        F.min("ds").over(whole).alias("_first"),
        F.count(F.lit(1)).over(whole).alias("_days"),
    ).filter(F.col("_days") >= MIN_DAYS)
    ahead = F.when(
        F.col("ds") == F.col("_last"), F.sequence("ds", F.date_add("ds", horizon))
    ).otherwise(F.array("ds"))
    return spans.select(
        *keys, F.explode(ahead).alias("_point"), "ds", "y", "_first"
    ).select(
        *keys,
        F.col("_point").alias("ds"),
        F.when(F.col("_point") == F.col("ds"), F.col("y")).alias("y"),
        F.datediff("_point", "_first").alias("t"),
    )


def _banded(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """Add the interval: ``yhat`` plus or minus z times the residual deviation."""
    spread = F.lit(Z_80) * F.coalesce(
        F.stddev_samp(F.col("y") - F.col("yhat")).over(Window.partitionBy(*keys)), F.lit(0.0)
    )
    return fitted.select(
        *keys,
        "ds",
        "y",
        "yhat",
        (F.col("yhat") - spread).alias("yhat_lower"),
        (F.col("yhat") + spread).alias("yhat_upper"),
    )


def forecast_trend(
    daily: DataFrame, keys: list[str] | None = None, horizon: int = HORIZON_DAYS
) -> DataFrame:
    """Least-squares trend plus mean weekday residual, per series.

    Returns (keys, ds, y, yhat, yhat_lower, yhat_upper): the history, and
    ``horizon`` further days whose ``y`` is NULL.
    """
    source = daily if keys else daily.withColumn(_SERIES, F.lit("all"))
    by = keys or [_SERIES]
    whole = Window.partitionBy(*by)
    per_weekday = Window.partitionBy(*by, F.dayofweek("ds"))
    trend = F.regr_intercept("y", "t").over(whole) + F.regr_slope("y", "t").over(whole) * F.col("t")
    points = _with_future(source, by, horizon).withColumn("_trend", trend)
    weekly = F.coalesce(F.avg(F.col("y") - F.col("_trend")).over(per_weekday), F.lit(0.0))
    fitted = points.withColumn("yhat", F.col("_trend") + weekly)
    return _banded(fitted, by).drop(_SERIES)


def forecast_fourier(daily: DataFrame, horizon: int = HORIZON_DAYS, pairs: int = 3) -> DataFrame:
    """Trend and weekly sine/cosine pairs, fitted together by linear regression."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    points = _with_future(daily.withColumn(_SERIES, F.lit("all")), [_SERIES], horizon)
    names = ["t"]
    for k in range(1, pairs + 1):
        angle = F.col("t") * F.lit(2.0 * k / 7.0) * F.pi()
        points = points.withColumns({f"sin{k}": F.sin(angle), f"cos{k}": F.cos(angle)})
        names += [f"sin{k}", f"cos{k}"]
    # One row per day, read again by every pass of the fit.
    ensure_checkpoint_dir(daily.sparkSession)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(points.checkpoint())
    history = rows.filter(F.col("y").isNotNull()).withColumn("label", F.col("y").cast("double"))
    if history.isEmpty():
        return _banded(points.withColumn("yhat", F.lit(None).cast("double")), [_SERIES]).drop(
            _SERIES
        )
    model = LinearRegression(solver="normal", predictionCol="yhat").fit(history)
    return _banded(model.transform(rows), [_SERIES]).drop(_SERIES)


def latest_rows(forecast: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` days of a forecast, for display."""
    return forecast.orderBy(F.desc("ds")).limit(n)


def with_actuals(forecast: DataFrame, daily: DataFrame) -> DataFrame:
    """Forecast rows that have an observed value: inner join on ``ds``, so future
    days fall away. Both sides hold one row per day."""
    return forecast.select("ds", "yhat").join(daily.select("ds", "y"), "ds", "inner")


def forecast_metrics(forecast: DataFrame, daily: DataFrame) -> DataFrame:
    """In-sample errors and the size of the training series, as one row."""
    gap = F.col("yhat") - F.col("y")
    return (
        with_actuals(forecast, daily)
        .agg(
            F.round(F.avg(F.abs(gap)), METRIC_DECIMALS).alias("mae"),
            F.round(F.sqrt(F.avg(gap * gap)), METRIC_DECIMALS).alias("rmse"),
            F.count(F.lit(1)).alias("data_days"),
            F.sum("y").alias("total_plays"),
        )
        .filter("data_days > 0")
    )


def run_record(metrics: DataFrame, run_id: str, params: dict[str, str]) -> DataFrame:
    """Metrics and parameters of a run as (run_id, kind, name, value) text rows."""
    cells = [
        F.struct(
            F.lit("metric").alias("kind"),
            F.lit(name).alias("name"),
            F.col(name).cast("string").alias("value"),
        )
        for name in metrics.columns
    ] + [
        F.struct(
            F.lit("param").alias("kind"), F.lit(k).alias("name"), F.lit(v).alias("value")
        )
        for k, v in params.items()
    ]
    return metrics.select(F.inline(F.array(*cells))).select(
        F.lit(run_id).alias("run_id"), "kind", "name", "value"
    )


def fill_missing_days(daily: DataFrame, key: str) -> DataFrame:
    """Give every series a row for each day between the first and the last day of all
    series, 0 where it had none. Meant for a fixed small set of keys such as hours."""
    everything = Window.partitionBy(_SERIES)
    spans = (
        daily.withColumn(_SERIES, F.lit("all"))
        .select(
            key,
            F.min("ds").over(everything).alias("_first"),
            F.max("ds").over(everything).alias("_last"),
        )
        .distinct()
    )
    days = spans.select(key, F.explode(F.sequence("_first", "_last")).alias("ds"))
    return days.join(daily, [key, "ds"], "left").withColumn("y", F.coalesce("y", F.lit(0)))


def peak_hour_forecast(hourly: DataFrame) -> DataFrame:
    """Busiest hour of the next day, from one daily series per hour of day.

    ``hourly`` is (hour, ds, y): at most 24 series with one row per calendar day.
    """
    filled = fill_missing_days(hourly, "hour")
    ahead = forecast_trend(filled, ["hour"], horizon=1).filter(F.col("y").isNull())
    best = F.max(F.struct(F.round("yhat", 6).alias("yhat"), (-F.col("hour")).alias("before")))
    return (
        ahead.groupBy("ds")
        .agg(best.alias("best"))
        .select("ds", (-F.col("best.before")).alias("peak_hour"), F.col("best.yhat").alias("yhat"))
    )
