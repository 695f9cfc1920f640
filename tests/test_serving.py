"""Serving queries on hand-made marts."""

import datetime as dt

from tripflow.operators import serving

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _daily(spark, rows):
    return spark.createDataFrame(rows, "trip_date DATE, borough STRING, taxi_type STRING, trip_count BIGINT, "
                                       "total_revenue DOUBLE, avg_distance DOUBLE")


def test_kpis_and_unweighted_mean_of_means(spark):
    daily = _daily(spark, [(D1, "A", "yellow", 1, 10.0, 1.0), (D1, "B", "yellow", 99, 990.0, 3.0),
                           (D2, "A", "green", 5, 0.1, None)])
    assert serving.total_trips(daily).first().total_trips == 105
    assert serving.total_revenue(daily).first().total_revenue == 1000.1
    assert serving.avg_distance(daily).first().avg_distance == 2.0   # (1 + 3) / 2, not trip-weighted
    by_type = {r.taxi_type: r.trip_count for r in serving.trips_by_type(daily).collect()}
    assert by_type == {"yellow": 100, "green": 5}


def test_values_that_no_decimal_holds_count(spark):
    nan, inf = float("nan"), float("inf")
    daily = _daily(spark, [(D1, "A", "yellow", 1, 1.0, nan), (D1, "B", "yellow", 1, inf, 2.0), (D2, "A", "green", 1, 2.0, 4.0)])
    assert str(serving.avg_distance(daily).first().avg_distance) == "nan"
    assert serving.total_revenue(daily).first().total_revenue == inf
    by_type = {r.taxi_type: r.total_revenue for r in serving.daily_revenue_by_type(daily).collect()}
    assert by_type == {"yellow": inf, "green": 2.0}
    assert serving.avg_distance(daily.limit(0)).first().avg_distance is None


def test_top_days_order_is_total(spark):
    daily = _daily(spark, [(D2, "B", "yellow", 5, 1.0, 1.0), (D2, "A", "yellow", 5, 1.0, 1.0),
                           (D2, "A", "green", 5, 1.0, 1.0), (D1, "Z", "fhvheavy", 50, 1.0, 1.0)])
    got = [(r.trip_date, r.borough, r.taxi_type) for r in serving.top_days(daily, 3).collect()]
    assert got == [(D2, "A", "green"), (D2, "A", "yellow"), (D2, "B", "yellow")]


def test_payment_labels_and_airport_totals(spark):
    pay = spark.createDataFrame([(D1, 1, "yellow", 1, 5.0, 4.0), (D1, 7, "yellow", 1, 6.0, 5.0),
                                 (D1, 5, "green", 1, 7.0, 6.0)],
                                "trip_date DATE, payment_type BIGINT, taxi_type STRING, trip_count BIGINT, "
                                "total_revenue DOUBLE, avg_fare DOUBLE")
    got = {r.payment_method: r.total_revenue for r in serving.payment_trend(pay).collect()}
    assert got == {"Credit Card": 5.0, "Unknown": 13.0}
    assert serving.avg_fare(pay).first().avg_fare == 5.0
    air = spark.createDataFrame([(D1, "yellow", 1, 2, 3, 4, 5, 6, 9), (D2, "yellow", 1, 0, 0, 0, 0, 1, 2)],
                                "trip_date DATE, taxi_type STRING, jfk_pickups BIGINT, jfk_dropoffs BIGINT, "
                                "laguardia_pickups BIGINT, laguardia_dropoffs BIGINT, newark_pickups BIGINT, "
                                "newark_dropoffs BIGINT, total_airport_trips BIGINT")
    r = serving.airport_comparison(air).first()
    assert (r.jfk_total_trips, r.laguardia_total_trips, r.newark_total_trips) == (4, 7, 12)


def test_smoke_counts_labels(spark):
    a, b = spark.range(3), spark.range(0)
    got = {r.table_name: r.row_count for r in serving.smoke_counts({"x": a, "y": b}).collect()}
    assert got == {"x": 3, "y": 0}
