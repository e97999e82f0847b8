"""The learned volume baseline: planted spikes, stored models and small or odd inputs."""

import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnflow.plans.baseline import LEVEL_RATES, SEASON_RATES, daily_volume, fit_volume, score_days, volume_baseline

START = date(2024, 1, 1)
SCHEMA = "mcc_category string, event_day date, transactions long"
WEEK = (400, 420, 430, 460, 600, 700, 300)


def series(category, counts, skip=()):
    return [(category, START + timedelta(days=t), int(n)) for t, n in enumerate(counts) if t not in skip]


def weekly(days, seed, growth=0.0, noise=True):
    """Counts with a weekly course, slow growth and noise as counts have it."""
    draw = np.random.default_rng(seed)
    mean = [WEEK[t % 7] * (1 + growth * t) for t in range(days)]
    return [draw.poisson(m) if noise else round(m) for m in mean]


def scored(spark, rows):
    return volume_baseline(spark.createDataFrame(rows, SCHEMA))


def test_planted_spikes_are_found_and_clean_days_left_alone(spark):
    rows, planted = [], set()
    for k in range(6):
        counts = weekly(400, k, growth=0.002)
        for t, factor in ((120 + k, 2.0), (200 + k, 0.3), (201 + k, 0.3), (333 + k, 1.8)):
            counts[t] = int(counts[t] * factor)
            planted.add((f"c{k}", START + timedelta(days=t)))
        rows += series(f"c{k}", counts)
    found = {(r.mcc_category, r.event_day) for r in scored(spark, rows).where("is_spike").collect()}
    assert planted <= found
    # Of 2 376 clean days at most two in a thousand.
    assert len(found - planted) <= 4


def test_a_week_and_a_season_are_learned(spark):
    found = scored(spark, series("a", weekly(60, 0, noise=False))).orderBy("event_day").collect()
    assert [r.forecast for r in found[:7]] == [None] * 7
    assert [(r.forecast, r.score, r.is_spike) for r in found[7:]] == [(WEEK[t % 7], 0.0, False) for t in range(7, 60)]


def plain(x, a, g, bound):
    """Errors of one pair of rates, and what they cost."""
    level = sum(x[:7]) / 7
    season = [n - level for n in x[:7]]
    errors, lost = [], 0.0
    for t in range(7, len(x)):
        error = x[t] - level - season[t % 7]
        used = max(-bound, min(bound, error))
        level, season[t % 7] = level + a * used, season[t % 7] + g * used
        errors.append(error)
        lost += abs(used)
    return errors, lost


def test_the_best_rates_of_the_grid(spark):
    x = weekly(90, 3, growth=0.01)
    x[40] = 5000
    changes = sorted(abs(b - a) for a, b in zip(x, x[7:]))
    bound = 4 * 1.4826 * max(changes[(len(changes) - 1) // 2], 1)
    costs = {(a, g): plain(x, a, g, bound)[1] for a in LEVEL_RATES for g in SEASON_RATES}
    model = fit_volume(spark.createDataFrame(series("a", x), SCHEMA)).first()
    best = min(costs.values())
    assert costs[model.level_rate, model.season_rate] == pytest.approx(best)
    errors, _ = plain(x, model.level_rate, model.season_rate, bound)
    found = scored(spark, series("a", x)).orderBy("event_day").collect()
    assert [r.forecast for r in found[7:]] == pytest.approx([n - e for n, e in zip(x[7:], errors)], abs=1e-5)
    middle = sorted(errors)[(len(errors) - 1) // 2]
    spread = sorted(abs(e - middle) for e in errors)[(len(errors) - 1) // 2]
    assert [r.score for r in found[7:]] == pytest.approx([(e - middle) / (1.4826 * spread) for e in errors], abs=1e-5)
    assert model.season and model.last_day == START + timedelta(days=89)


def test_stored_models_go_on_as_if_the_days_were_one_run(spark):
    x = weekly(101, 8)
    x[95] = 4000
    old = spark.createDataFrame(series("a", x[:87]) + series("b", [5] * 87), SCHEMA)
    models = fit_volume(old)
    stored = models.where("mcc_category = 'a'").first()
    new = spark.createDataFrame(series("a", x, skip={90}) + series("new", [3] * 101), SCHEMA)
    errors90 = list(x)
    errors90[90] = 0
    errors, _ = plain(errors90, stored.level_rate, stored.season_rate, stored.bound)
    found = {c: [r for r in score_days(new, models).orderBy("event_day").collect() if r.mcc_category == c] for c in ("a", "b", "new")}
    assert [r.event_day for r in found["a"]] == [START + timedelta(days=t) for t in range(87, 101)]
    assert [r.forecast for r in found["a"]] == pytest.approx([n - e for n, e in zip(errors90[87:], errors[80:])], abs=1e-5)
    assert [r.event_day for r in found["a"] if r.is_spike] == [START + timedelta(days=t) for t in (90, 95)]
    # A category without rows has days of none; one without a model is not scored.
    assert [r.transactions for r in found["b"]] == [0] * 14 and found["b"][0].forecast == 5.0
    assert found["new"] == []
    assert score_days(old, models).count() == 0


def test_null_category_missing_days_and_repeated_rows(spark):
    rows = series(None, weekly(30, 1), skip={11}) + series("late", [7] * 30, skip=set(range(12)))
    rows += [(None, START, 10)]  # a second row of one day is added to the first
    found = scored(spark, rows)
    assert found.groupBy("mcc_category").count().orderBy("mcc_category").collect() == [(None, 30), ("late", 30)]
    by_day = {r.event_day: r for r in found.where("mcc_category is null").collect()}
    assert by_day[START].transactions == rows[0][2] + 10
    assert by_day[START + timedelta(days=11)].transactions == 0
    assert fit_volume(spark.createDataFrame(rows, SCHEMA)).count() == 2


@pytest.mark.parametrize("days", [0, 1, 13])
def test_short_spans_have_no_forecasts(spark, days):
    found = scored(spark, series("a", [4] * days)).collect()
    assert len(found) == days and all(r.forecast is None and r.score is None and not r.is_spike for r in found)
    daily = spark.createDataFrame(series("a", [4] * days), SCHEMA)
    models = fit_volume(daily)
    assert models.count() == 0 and score_days(daily, models).count() == 0


def test_daily_volume_leaves_rows_without_a_date_out(spark):
    rows = [("a", datetime(2024, 1, 1, 23, 59)), ("a", datetime(2024, 1, 1)), ("a", None), (None, datetime(2024, 1, 2))]
    daily = daily_volume(spark.createDataFrame(rows, "mcc_category string, event_ts timestamp_ntz"))
    found = daily.orderBy(F.col("event_day")).collect()
    assert [tuple(r) for r in found] == [("a", START, 2), (None, START + timedelta(days=1), 1)]
    assert not any(math.isnan(r.transactions) for r in found)
