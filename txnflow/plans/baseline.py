"""Learned volume baseline: seasonal exponential smoothing of daily counts for each category.

A category's level and the share of each weekday follow the errors of forecasts
made one day ahead:

    error  = count - (level + weekday)
    level += level_rate * used, weekday += season_rate * used

where `used` is the error held within some usual weekly changes, so that a spike
neither moves the forecasts after it nor decides the rates. The rates are those
of a grid with the least sum of absolute used errors. A day's score is its error less
the median error, in units of the median absolute deviation.

Spark adds up the days and deals categories out; a task holds one number per day
of a category.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnflow.session import cut_lineage

SEASON = 7
#: The grid of rates.
LEVEL_RATES = (0.0625, 0.125, 0.25, 0.5)
SEASON_RATES = (0.0, 0.0625, 0.125, 0.25)
#: Errors are used up to so many usual weekly changes, and a day is a spike beyond so many deviations.
USED_CHANGES, SPIKE_DEVIATIONS = 4.0, 5.0
#: Median absolute deviations in one standard deviation of a normal distribution.
_NORMAL = 1.4826


def daily_volume(transactions: DataFrame, key: str = "mcc_category") -> DataFrame:
    """Transactions per day and key. Rows without a date are left out; a null key is a key of its own."""
    day = F.to_date("event_ts").alias("event_day")
    return transactions.where(F.col("event_ts").isNotNull()).groupBy(key, day).agg(F.count(F.lit(1)).alias("transactions"))


@dataclass
class _Model:
    level_rate: float
    season_rate: float
    bound: float
    level: float
    # From the weekday of the next day on.
    season: np.ndarray
    middle: float = 0.0
    scale: float = 0.0


def _middle(values: np.ndarray) -> float:
    """The median; of an even number of values the lower one of the middle two."""
    return float(np.sort(values)[(len(values) - 1) // 2])


def _fit(x: np.ndarray) -> tuple[_Model, np.ndarray]:
    """The best model of a series of at least two seasons, as it stands after the last day, and the errors from the second season on."""
    change = _middle(np.abs(x[SEASON:] - x[:-SEASON]))
    bound = USED_CHANGES * _NORMAL * max(change, 1.0)
    rates = np.array([(a, g) for a in LEVEL_RATES for g in SEASON_RATES])
    first = x[:SEASON].sum() / SEASON
    level = np.full(len(rates), first)
    season = np.repeat((x[:SEASON] - first)[:, None], len(rates), axis=1)
    lost = np.zeros(len(rates))
    errors = np.empty((len(x) - SEASON, len(rates)))
    for t in range(SEASON, len(x)):
        weekday = t % SEASON
        error = x[t] - (level + season[weekday])
        used = np.clip(error, -bound, bound)
        level = level + rates[:, 0] * used
        season[weekday] = season[weekday] + rates[:, 1] * used
        lost = lost + np.abs(used)
        errors[t - SEASON] = error
    best = int(np.argmin(lost))  # of equal ones the first: the smallest rates
    found = errors[:, best]
    middle = _middle(found)
    scale = max(_NORMAL * _middle(np.abs(found - middle)), 1.0)
    after = np.roll(season[:, best], -(len(x) % SEASON))
    return _Model(*map(float, rates[best]), bound, float(level[best]), after, middle, scale), found


def _go_on(model: _Model, x: np.ndarray) -> np.ndarray:
    """Errors of the days that follow; the model's state moves with them."""
    errors = np.empty(len(x))
    for t, count in enumerate(x):
        errors[t] = count - (model.level + model.season[0])
        used = min(max(errors[t], -model.bound), model.bound)
        model.level += model.level_rate * used
        model.season = np.append(model.season[1:], model.season[0] + model.season_rate * used)
    return errors


def _filled(rows: pd.DataFrame, first, last) -> np.ndarray:
    """Counts of all days from first to last; days without rows have none."""
    x = np.zeros((last - first).days + 1)
    for day, n in zip(rows["event_day"], rows["transactions"]):
        if first <= day <= last:
            x[(day - first).days] += n
    return x


def _scored(key, name: str, first, x: np.ndarray, errors: np.ndarray, model: _Model | None) -> pd.DataFrame:
    """The days of a series; forecasts and scores only for the last ones, as many as there are errors."""
    blank = np.full(len(x) - len(errors), np.nan)
    error = np.append(blank, errors)
    score = (error - model.middle) / model.scale if model else error
    days = pd.Series([first + timedelta(days=t) for t in range(len(x))], dtype=object)
    found = pd.DataFrame({"event_day": days, "transactions": x.astype("int64"), "forecast": x - error, "score": score})
    found.insert(0, name, pd.Series([key] * len(x), dtype=object))
    return found


def _with_span(daily: DataFrame) -> DataFrame:
    """Days with the first and the last day of all keys beside them."""
    first = daily.agg(F.min("event_day")).scalar()
    last = daily.agg(F.max("event_day")).scalar()
    return daily.withColumns({"first_day": first, "last_day": last})


def _marked(scored: DataFrame) -> DataFrame:
    """NaN, which pandas has in place of null, becomes null; the score decides on spikes before it is rounded."""
    number = {c: F.when(~F.isnan(c), F.col(c)) for c in ("forecast", "score")}
    spike = F.coalesce(F.abs("score") > SPIKE_DEVIATIONS, F.lit(False))
    marked = scored.withColumns(number).withColumn("is_spike", spike)
    return marked.withColumns({c: F.round(c, 6) for c in number})


def volume_baseline(daily: DataFrame, key: str = "mcc_category") -> DataFrame:
    """One row per key and day of the whole span: count, forecast of the day before, score, and whether it is a spike.

    Days without rows count as none. The first week has no forecast, and a span
    of less than two weeks none at all. An empty table gives an empty table.
    """
    daily = cut_lineage(daily.select(key, "event_day", "transactions"), "daily")
    kind = daily.schema[key].dataType.simpleString()

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, last = rows["first_day"].iloc[0], rows["last_day"].iloc[0]
        x = _filled(rows, first, last)
        model, errors = _fit(x) if len(x) >= 2 * SEASON else (None, np.zeros(0))
        return _scored(group[0], key, first, x, errors, model)

    schema = f"`{key}` {kind}, event_day date, transactions long, forecast double, score double"
    return _marked(_with_span(daily).groupBy(key).applyInPandas(run, schema))


_STATE = "level_rate double, season_rate double, bound double, level double, season array<double>, middle double, scale double"


def fit_volume(daily: DataFrame, key: str = "mcc_category") -> DataFrame:
    """One model per key, as it stands after the last day of the table; a small table to store.

    A span of less than two weeks gives no models.
    """
    daily = cut_lineage(daily.select(key, "event_day", "transactions"), "daily")
    kind = daily.schema[key].dataType.simpleString()
    names = ["level_rate", "season_rate", "bound", "level", "season", "middle", "scale"]

    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, last = rows["first_day"].iloc[0], rows["last_day"].iloc[0]
        x = _filled(rows, first, last)
        found = []
        if len(x) >= 2 * SEASON:
            model, _ = _fit(x)
            found = [[group[0], last, *(getattr(model, n) for n in names)]]
        return pd.DataFrame(found, columns=[key, "last_day", *names])

    return _with_span(daily).groupBy(key).applyInPandas(run, f"`{key}` {kind}, last_day date, {_STATE}")


def score_days(daily: DataFrame, models: DataFrame, key: str = "mcc_category") -> DataFrame:
    """Days after the models' last one, up to the newest of `daily`, scored without reading the days before.

    Keys without a model are left out; a key that has no rows any more goes on
    with days of none.
    """
    kind = models.schema[key].dataType.simpleString()
    daily = cut_lineage(daily.select(key, "event_day", "transactions"), "daily")
    models = models.withColumn("newest", daily.agg(F.max("event_day")).scalar())
    names = ["level_rate", "season_rate", "bound", "level", "season", "middle", "scale"]

    def run(group: tuple, model: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        nothing = _scored(None, key, None, np.zeros(0), np.zeros(0), None)
        if model.empty or pd.isna(model["newest"].iloc[0]):
            return nothing
        first, last = model["last_day"].iloc[0] + timedelta(days=1), model["newest"].iloc[0]
        if last < first:
            return nothing
        state = _Model(**{n: model[n].iloc[0] for n in names})
        x = _filled(rows, first, last)
        return _scored(group[0], key, first, x, _go_on(state, x), state)

    schema = f"`{key}` {kind}, event_day date, transactions long, forecast double, score double"
    return _marked(models.groupBy(key).cogroup(daily.groupBy(key)).applyInPandas(run, schema))
