"""Trailing means: cut and uncut series against a plain Python loop."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderflow.operators import trailing
from orderflow.operators.trailing import with_trailing_means

SCHEMA = "store_id string, product_id string, date date, tie bigint, units_sold double, note string"
DAY0 = dt.date(2022, 1, 1)


def brute_force(rows):
    by_series = {}
    for row in rows:
        by_series.setdefault(row[:2], []).append(row)
    expected = {}
    for series in by_series.values():
        series.sort(key=lambda r: (r[2], r[3]))
        for i, row in enumerate(series):
            expected[row[:4]] = (
                mean([r[4] for r in series[max(0, i - 6) : i + 1]]),
                mean([r[4] for r in series[max(0, i - 7) : i]]),
            )
    return expected


def mean(values):
    present = [v for v in values if v is not None]
    return sum(present) / len(present) if present else None


def result(df, long_rows, **options):
    out = with_trailing_means(
        df, ("store_id", "product_id"), ("date", "tie"), "units_sold", long_rows=long_rows, **options
    )
    assert out.columns == [*df.columns, "avg_daily_sales_7d", "ma7_previous"]
    rows = out.collect()
    got = {
        (r.store_id, r.product_id, r.date, r.tie): (r.avg_daily_sales_7d, r.ma7_previous)
        for r in rows
    }
    assert len(got) == len(rows)
    assert all(r.note == "kept" for r in rows)
    return got


def make_rows(seed=1):
    """A hot series with one very long day, a sparse one, and a short one."""
    rng = random.Random(seed)
    rows, tie = [], 0
    for store, days, per_day in (("hot", 40, 5), ("sparse", 60, 1), ("short", 4, 1)):
        for day in range(days):
            n = 120 if (store == "hot" and day == 17) else rng.randint(0, per_day)
            for _ in range(n):
                tie += rng.randint(1, 3)
                units = rng.choice([None, 0.0, float(rng.randint(1, 50))])
                rows.append((store, "p", DAY0 + dt.timedelta(day), tie, units, "kept"))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("long_rows", [1, 3, 10, 50, 1000])
def test_cut_series_equal_brute_force(spark, long_rows):
    rows = make_rows()
    assert result(spark.createDataFrame(rows, SCHEMA), long_rows) == brute_force(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    data=st.lists(
        st.tuples(
            st.sampled_from(["a", "b"]),
            st.integers(0, 6),
            st.integers(0, 30),
            st.one_of(st.none(), st.integers(0, 20)),
        ),
        min_size=1,
        max_size=60,
        unique_by=lambda r: (r[0], r[1], r[2]),
    ),
    long_rows=st.integers(1, 12),
)
def test_any_cut_gives_the_same_frames(spark, data, long_rows):
    rows = [
        (s, "p", DAY0 + dt.timedelta(d), t, None if u is None else float(u), "kept")
        for s, d, t, u in data
    ]
    assert result(spark.createDataFrame(rows, SCHEMA), long_rows) == brute_force(rows)


def test_order_without_numeric_tie_breaker(spark):
    rows = [("s", "p", DAY0 + dt.timedelta(d), 0, float(d), "kept") for d in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = with_trailing_means(df, ("store_id", "product_id"), ("date",), "units_sold", long_rows=4)
    got = {(r.store_id, r.product_id, r.date, r.tie): (r.avg_daily_sales_7d, r.ma7_previous)
           for r in out.collect()}
    assert got == brute_force(rows)


@pytest.mark.parametrize("ties", ["clustered", "text", "constant day"])
def test_cells_are_bounded_for_any_order(spark, ties):
    """3,000 rows of one day, as two scan splits number them, or with text keys."""
    if ties == "clustered":
        keys = [str(i if i < 10 else (1 << 33) + i).zfill(12) for i in range(3000)]
    else:
        keys = [str(i) for i in range(3000)]
    rows = [("s", "p", DAY0 + dt.timedelta(i // 40 if ties == "constant day" else 0), k, float(i))
            for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "store_id string, product_id string, date date, tie string, units_sold double")
    series, order = ("store_id", "product_id"), ("date", "tie")
    sizes = trailing._cells(df, 3000, series, order, 100).groupBy("cell").count().collect()
    assert sum(r["count"] for r in sizes) == 3000 and max(r["count"] for r in sizes) <= 200
    out = with_trailing_means(df, series, order, "units_sold", long_rows=100)
    got = {(r.store_id, r.product_id, r.date, r.tie): (r.avg_daily_sales_7d, r.ma7_previous)
           for r in out.collect()}
    assert got == brute_force(rows)


def test_cells_are_bounded_for_a_constant_first_tie_breaker(spark):
    rows = [("s", "p", DAY0, 0, i, float(i)) for i in range(3000)]
    df = spark.createDataFrame(
        rows, "store_id string, product_id string, date date, tie int, second int, units_sold double")
    order = ("date", "tie", "second")
    sizes = trailing._cells(df, 3000, ("store_id", "product_id"), order, 100).groupBy("cell").count()
    assert max(r["count"] for r in sizes.collect()) <= 200


@pytest.mark.parametrize("long_rows", [3, 1000])
def test_rows_without_a_series_key_have_no_means(spark, long_rows):
    rows = [(s, p, DAY0 + dt.timedelta(d), d, float(d + 1), "kept")
            for s, p in (("a", "p"), (None, "p"), ("a", None)) for d in range(5)]
    got = result(spark.createDataFrame(rows, SCHEMA), long_rows)
    keyed = brute_force([r for r in rows if None not in r[:2]])
    assert got == {**{r[:4]: (None, None) for r in rows}, **keyed}


def test_known_small_input_skips_the_search(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("series must not be counted")

    monkeypatch.setattr(trailing, "_long_series", fail)
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df, 1000, rows_at_most=len(rows)) == brute_force(rows)


def test_first_row_of_a_series_has_no_history(spark):
    df = spark.createDataFrame([("s", "p", DAY0, 1, 4.0, "kept")], SCHEMA)
    assert list(result(df, 100).values()) == [(4.0, None)]
