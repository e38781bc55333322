"""Fits side by side: order, bound, repeats and errors."""

import threading
import time

import pytest

from loanloom.operators.fits import side_by_side


def test_order_and_bound(spark):
    now, most, lock = [], [], threading.Lock()

    def fit(i):
        with lock:
            now.append(i)
            most.append(len(now))
        time.sleep(0.02 * (6 - i))
        pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        rows = spark.range(i).count()
        with lock:
            now.remove(i)
        return i, rows, pool

    got = side_by_side(spark, fit, range(6), at_once=3)
    assert [g[:2] for g in got] == [(i, i) for i in range(6)] and 1 < max(most) <= 3
    assert {g[2] for g in got} <= {"fits-0", "fits-1", "fits-2"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_failing_fit_is_repeated_alone(spark):
    tries = dict.fromkeys(range(4), 0)

    def fit(i):
        tries[i] += 1
        if i == 2 and tries[i] < 3:
            raise OSError("lost")
        return i * i

    assert side_by_side(spark, fit, range(4), at_once=2) == [0, 1, 4, 9]
    assert tries == {0: 1, 1: 1, 2: 3, 3: 1}


def test_error_stops_what_has_not_started(spark):
    seen = []

    def fit(i):
        seen.append(i)
        raise ValueError(i)

    with pytest.raises(ValueError):
        side_by_side(spark, fit, range(50), at_once=2, attempts=2)
    assert len(set(seen)) <= 4
    assert side_by_side(spark, fit, [], at_once=2) == []
    with pytest.raises(ValueError):
        side_by_side(spark, fit, [1], at_once=0)
