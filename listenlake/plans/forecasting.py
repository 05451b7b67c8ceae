"""The daily forecast as a job: series, model, stored rows, run log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from listenlake.operators import forecast, seasonal
from listenlake.operators.gold import daily_series
from listenlake.sinks import tables

# The models of the job, each with its name in the run log.
MODELS = {
    "trend": (forecast.forecast_trend, forecast.RUN_PARAMS["model_type"]),
    "changepoints": (seasonal.forecast_changepoints, "trend with change points and weekday effect"),
}


def run_forecast(silver: DataFrame, schema: str, run_id: str, model: str = "trend") -> DataFrame | None:
    """Store ``daily_play_forecast`` (history and horizon) and append to ``forecast_runs``.

    Returns the stored forecast, or None when there are fewer than two days of data;
    nothing is written then.
    """
    spark = silver.sparkSession
    tables.ensure_schema(spark, schema)
    daily = tables.save_table(daily_series(silver), f"{schema}.daily_play_series")
    if daily.limit(forecast.MIN_DAYS).count() < forecast.MIN_DAYS:
        return None
    fit, label = MODELS[model]
    rows = fit(daily).select("ds", "yhat", "yhat_lower", "yhat_upper")
    stored = tables.save_table(rows, f"{schema}.daily_play_forecast")
    metrics = forecast.forecast_metrics(stored, daily)
    record = forecast.run_record(metrics, run_id, forecast.RUN_PARAMS | {"model_type": label})
    tables.append_run(record, f"{schema}.forecast_runs")
    return stored
