"""Indicators continued from stored state equal those computed from the start."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barline.operators import resume as R
from barline.operators.indicators import compute_all_indicators
from barline.schemas import INDICATOR_COLUMNS
from barline.session import stored

D0 = dt.date(2024, 1, 1)
SCHEMA = "symbol string, exchange string, date date, open double, high double, low double, close double, volume double"


@pytest.fixture(scope="module")
def daily(spark):
    rnd, rows = random.Random(4), []
    for symbol, first, n, gap in (("A", 0, 260, 1), ("B", 3, 150, 2), ("C", 230, 30, 1), ("D", 0, 40, 1), (None, 5, 120, 3)):
        price = 100.0
        for i in range(n):
            price = max(1.0, price + rnd.choice([-2.0, -1.0, 0.0, 1.0, 2.0]))
            rows.append((symbol, "x", D0 + dt.timedelta(days=first + i * gap), price, price + 1, price - 1, price, float(rnd.randrange(50))))
    return stored(spark.createDataFrame(rows, SCHEMA), "daily").cache()


def close_to(got, want):
    key = lambda r: (r["symbol"] or "", r["date"])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    for a, b in zip(got, want, strict=True):
        for c in INDICATOR_COLUMNS:
            assert (a[c] is None) == (b[c] is None) and (a[c] is None or a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-9)), (key(a), c)


@pytest.mark.parametrize("cuts", [[250], [1, 60, 61, 200, 300], list(range(100, 130))])
def test_runs_of_days_equal_one_run(spark, daily, cuts):
    whole = compute_all_indicators(daily).collect()
    state, out, low = None, [], D0 - dt.timedelta(days=1)
    for cut in [*cuts, 10_000]:
        high = D0 + dt.timedelta(days=cut)
        new = daily.filter((F.col("date") > F.lit(low)) & (F.col("date") <= F.lit(high)))
        rows = stored(R.continue_indicators(new, state), "continued")
        out += rows.filter("is_new").collect()
        state = stored(R.last_rows(rows), "state")
        low = high
    close_to(out, whole)
    assert state.groupBy("symbol").count().filter(f"count > {R.HALO}").count() == 0


def test_late_row_restarts_from_the_stored_tables(spark, daily):
    at = D0 + dt.timedelta(days=140)
    changed = daily.withColumn("close", F.when((F.col("symbol") == "A") & (F.col("date") == F.lit(at)), 500.0).otherwise(F.col("close")))
    before = compute_all_indicators(daily)
    got = R.continue_indicators(changed.filter(F.col("date") >= F.lit(at)), R.state_before(daily, before, at)).filter("is_new")
    want = compute_all_indicators(changed).filter(F.col("date") >= F.lit(at))
    close_to(got.collect(), want.collect())


def test_plan_reads_state_and_new_rows_once(spark, daily):
    state = stored(R.last_rows(R.continue_indicators(daily.filter("date < '2024-06-01'"), None)), "state")
    plan = R.continue_indicators(daily.filter("date >= '2024-06-01'"), state)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_by_exchange(spark, daily):
    both = daily.filter("symbol in ('A', 'D')").union(daily.filter("symbol = 'A'").withColumn("exchange", F.lit("y")).withColumn("close", F.col("close") + 7)).select(*daily.columns)
    keys = ("symbol", "exchange")
    rows = stored(R.continue_indicators(both.filter("date < '2024-04-01'"), None, keys), "first")
    second = R.continue_indicators(both.filter("date >= '2024-04-01'"), R.last_rows(rows, keys), keys).filter("is_new")
    want = compute_all_indicators(both, partition_by=keys).filter("date >= '2024-04-01'")
    for e in ("x", "y"):
        close_to(second.filter(F.col("exchange") == e).collect(), want.filter(F.col("exchange") == e).collect())
