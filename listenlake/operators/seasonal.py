"""Forecasts whose fit is a fold over a small array per series, inside Spark expressions.

``forecast_changepoints`` sums the Gram matrix of a hinge basis in one aggregate and solves
the ridge system of each series by elimination.  ``forecast_seasonal`` folds the state of a
seasonal recursion (level, trend, seven weekly effects) over the days of each series.

Both read a daily series (keys, ds, y) with one row per calendar day of a series, so an array
holds as many numbers as the series has days.  Rows without a day or a value are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.operators.forecast import _SERIES, HORIZON_DAYS, _banded, _with_future

# Change points lie evenly over the first part of the history.
CHANGE_POINTS = 6
CHANGE_RANGE = 0.8
# Penalty on the change of slope at a point; level and first slope are free.
RIDGE = 0.5

PERIOD = 7
# Smoothing of level, trend and season; each series takes the triple that predicted it best.
SMOOTHING = [(0.1, 0.01, 0.1), (0.1, 0.05, 0.3), (0.3, 0.01, 0.1), (0.3, 0.05, 0.3), (0.6, 0.05, 0.1)]


def _basis(u: Column, points: int) -> list[Column]:
    """1, u and a hinge per change point; u runs from 0 to 1 over the history."""
    hinges = [F.greatest(u - F.lit(CHANGE_RANGE * j / (points + 1)), F.lit(0.0)) for j in range(1, points + 1)]
    return [F.lit(1.0), u, *hinges]


def _eliminate(system: Column, size: int) -> Column:
    """The reduced form of an augmented system whose pivots are all positive."""

    def step(rows: Column, p: Column) -> Column:
        pivot = F.element_at(rows, p)
        head = F.element_at(pivot, p)
        return F.transform(
            rows,
            lambda row, i: F.when(i + 1 == p, F.transform(row, lambda x: x / head)).otherwise(
                F.zip_with(row, pivot, lambda x, q: x - F.element_at(row, p) * q / head)
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(size)), system, step)


def forecast_changepoints(
    daily: DataFrame, keys: list[str] | None = None, horizon: int = HORIZON_DAYS,
    points: int = CHANGE_POINTS, ridge: float = RIDGE,
) -> DataFrame:
    """A trend that may bend at ``points`` places, plus the mean weekday residual, per series.

    The trend's error on the history never exceeds the straight line's, which is the same fit
    with all bends zero.  Returns (keys, ds, y, yhat, yhat_lower, yhat_upper) like the straight one.
    """
    source = daily if keys else daily.withColumn(_SERIES, F.lit("all"))
    by = keys or [_SERIES]
    usable = source.where(F.col("ds").isNotNull() & F.col("y").isNotNull())
    days = _with_future(usable, by, horizon)
    seen = F.max(F.when(F.col("y").isNotNull(), F.col("t"))).over(Window.partitionBy(*by))
    rows = days.withColumn("_u", F.col("t") / seen)
    basis = _basis(F.col("_u"), points)
    size = len(basis)
    # Upper triangle and right side; the sums combine before the shuffle.
    sums = {f"_g{i}_{j}": F.sum(basis[i] * basis[j]) for i in range(size) for j in range(i, size)}
    sums |= {f"_r{i}": F.sum(basis[i] * F.col("y")) for i in range(size)}
    gram = rows.where("y is not null").groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])

    def cell(i: int, j: int) -> Column:
        value = F.col(f"_g{min(i, j)}_{max(i, j)}")
        return value + F.lit(ridge) if i == j and i > 1 else value

    system = F.array(*[F.array(*[cell(i, j) for j in range(size)], F.col(f"_r{i}")) for i in range(size)])
    solved = gram.select(
        *[F.col(k).alias(f"_key_{k}") for k in by],
        F.transform(_eliminate(system, size), lambda row: F.element_at(row, -1)).alias("_w"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in by]
    terms = [F.get("_w", F.lit(i)) * basis[i] for i in range(size)]
    trend = rows.join(solved, same).withColumn("_trend", sum(terms[1:], terms[0]))
    per_weekday = Window.partitionBy(*by, F.dayofweek("ds"))
    weekly = F.coalesce(F.avg(F.col("y") - F.col("_trend")).over(per_weekday), F.lit(0.0))
    return _banded(trend.withColumn("yhat", F.col("_trend") + weekly), by).drop(_SERIES)


def _recursion(values: Column, first: Column, alpha: float, beta: float, gamma: float) -> Column:
    """State after all days: level, trend, seven effects, the day's number and the squared error.

    ``first`` is the mean of the first week.  The effects are the first week's
    differences from it, so prediction starts with the eighth day.
    """
    effects = F.transform(
        F.sequence(F.lit(0), F.lit(PERIOD - 1)), lambda i: F.coalesce(F.get(values, i) - first, F.lit(0.0))
    )
    start = F.struct(
        first.alias("level"), F.lit(0.0).alias("trend"), effects.alias("season"),
        F.lit(PERIOD).alias("at"), F.lit(0.0).alias("sse"),
    )

    def step(s: Column, y: Column) -> Column:
        place = s["at"] % PERIOD
        effect = F.get(s["season"], place)
        ahead = s["level"] + s["trend"]
        level = alpha * (y - effect) + (1 - alpha) * ahead
        trend = beta * (level - s["level"]) + (1 - beta) * s["trend"]
        fresh = gamma * (y - level) + (1 - gamma) * effect
        gap = y - ahead - effect
        return F.struct(
            level.alias("level"), trend.alias("trend"),
            F.transform(s["season"], lambda x, i: F.when(i == place, fresh).otherwise(x)).alias("season"),
            (s["at"] + 1).alias("at"), (s["sse"] + gap * gap).alias("sse"),
        )

    later = F.slice(values, F.lit(PERIOD + 1), F.greatest(F.size(values) - PERIOD, F.lit(0)))
    return F.aggregate(later, start, step)


def forecast_seasonal(
    daily: DataFrame, keys: list[str], horizon: int = HORIZON_DAYS, smoothing: list[tuple[float, float, float]] | None = None
) -> DataFrame:
    """Seasonal recursion with a weekly period per series: (keys, ds, yhat, smoothing, mse).

    Days without a row between a series' first and last day count as 0.  ``smoothing`` is the
    number of the triple with the least squared one-day-ahead error, the first among equals;
    ``mse`` is its mean, NULL for a series of a week or less, which is forecast by its own week.
    """
    triples = smoothing or SMOOTHING
    usable = daily.where(F.col("ds").isNotNull() & F.col("y").isNotNull())
    points = usable.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("_days")
    )
    # Each day, then a 0 for every day up to the next one that has a row.
    filled = F.flatten(
        F.transform(
            "_days",
            lambda day, i: F.concat(
                F.array(day["y"]),
                F.array_repeat(F.lit(0.0), F.coalesce(F.datediff(F.get("_days", i + 1)["ds"], day["ds"]) - 1, F.lit(0))),
            ),
        )
    )
    series = points.select(
        *keys, F.element_at("_days", -1)["ds"].alias("_last"), filled.alias("_y")
    )
    week = F.slice("_y", 1, PERIOD)
    series = series.withColumn("_first", F.aggregate(week, F.lit(0.0), lambda a, x: a + x) / F.size(week))
    fits = F.array(*[
        F.struct(
            F.round(state["sse"], 6).alias("rank"), F.lit(number).alias("number"), state.alias("state"),
        )
        for number, state in enumerate(_recursion(F.col("_y"), F.col("_first"), *t) for t in triples)
    ])
    best = series.select(*keys, "_last", F.size("_y").alias("_n"), F.sort_array(fits)[0].alias("_best"))
    state = F.col("_best.state")
    # A series shorter than a week has its later effects at 0; its next day is number _n, not 7.
    number = F.greatest(F.col("_n"), F.lit(0)) + F.col("_step") - 1
    tested = F.col("_n") - PERIOD
    return best.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_step")).select(
        *keys,
        F.date_add("_last", F.col("_step")).alias("ds"),
        (state["level"] + F.col("_step") * state["trend"] + F.get(state["season"], number % PERIOD)).alias("yhat"),
        F.col("_best.number").alias("smoothing"),
        F.when(tested > 0, state["sse"] / tested).alias("mse"),
    )
