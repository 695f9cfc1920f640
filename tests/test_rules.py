"""Hand-made edge rows: each rule, reason, mart and audit boundary."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tripflow import config
from tripflow.functions.rules import RULES
from tripflow.operators import audit, marts, quality
from tripflow.operators.conform import conform_trips, conform_zones
from tripflow.operators.dedup import dedup_trips
from tripflow.plans import medallion as M
from tripflow.sources.files import RAW_SCHEMAS

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)


def yellow_row(**kw):
    row = dict(tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=18),
               PULocationID=10, DOLocationID=20, VendorID=1, passenger_count=1, trip_distance=3.0,
               fare_amount=20.0, total_amount=25.0, payment_type=1)
    row.update(kw)
    return row


def yellow_df(spark, rows):
    cols = [f.split(" ")[0] for f in RAW_SCHEMAS["yellow"].split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], RAW_SCHEMAS["yellow"])


def verdicts(spark, rows):
    """Per row: (kept by drop rules, quarantine reason or None)."""
    raw = M.bronze(yellow_df(spark, rows))
    conf = conform_trips(raw, "yellow", "2025-01-01 00:00:00")
    flags = conf.select(quality.all_pass(RULES["yellow"].drop_rules).alias("kept")).collect()
    q = M.quarantine(raw, "yellow", "2025-01-01 00:00:00")
    reasons = {(r.pickup_location_id, r.dropoff_location_id): r.quarantine_reason for r in q.collect()}
    return [f.kept for f in flags], reasons


@pytest.mark.parametrize("fare,kept,reason", [
    (0.0, True, None), (10000.0, True, "excessive_fare"), (10000.01, False, "excessive_fare"),
    (-0.01, False, "negative_fare"), (None, False, None)])
def test_fare_bounds(spark, fare, kept, reason):
    k, reasons = verdicts(spark, [yellow_row(fare_amount=fare)])
    assert k == [kept]
    assert reasons.get((10, 20)) == reason


@pytest.mark.parametrize("total,kept,reason", [
    (50000.0, True, "excessive_total"), (None, False, None), (-1.0, False, "negative_total")])
def test_total_bounds(spark, total, kept, reason):
    k, reasons = verdicts(spark, [yellow_row(total_amount=total)])
    assert k == [kept]
    assert reasons.get((10, 20)) == reason


@pytest.mark.parametrize("loc,kept", [(0, False), (1, True), (265, True), (266, False), (None, False)])
def test_location_bounds(spark, loc, kept):
    k, reasons = verdicts(spark, [yellow_row(PULocationID=loc)])
    assert k == [kept]
    expected = None if kept or loc is None else "invalid_pickup_location"
    assert reasons.get((loc, 20)) == expected


@pytest.mark.parametrize("seconds,kept", [(0, True), (86400, True), (86401, False), (-60, False)])
def test_duration_bounds(spark, seconds, kept):
    drop = T0 + dt.timedelta(seconds=seconds)
    k, _ = verdicts(spark, [yellow_row(tpep_dropoff_datetime=drop)])
    assert k == [kept]


def test_duration_value_and_null(spark):
    rows = [yellow_row(tpep_dropoff_datetime=T0 + dt.timedelta(minutes=1440, seconds=1)),
            yellow_row(tpep_dropoff_datetime=None, PULocationID=11)]
    conf = conform_trips(M.bronze(yellow_df(spark, rows)), "yellow").orderBy("pickup_location_id")
    got = [r.trip_duration_mins for r in conf.collect()]
    assert got == [1440.02, None]


@pytest.mark.parametrize("pickup,kept", [
    (dt.datetime(2024, 1, 1), True), (dt.datetime(2027, 1, 1), False), (dt.datetime(2023, 12, 31, 23, 59, 59), False)])
def test_date_range(spark, pickup, kept):
    k, _ = verdicts(spark, [yellow_row(tpep_pickup_datetime=pickup,
                                       tpep_dropoff_datetime=pickup + dt.timedelta(minutes=5))])
    assert k == [kept]


def test_null_pickup_reason_and_drop(spark):
    k, reasons = verdicts(spark, [yellow_row(tpep_pickup_datetime=None, tpep_dropoff_datetime=None)])
    assert k == [False]
    assert reasons[(10, 20)] == "null_pickup_datetime, null_dropoff_datetime"


def test_reason_order_and_join(spark):
    _, reasons = verdicts(spark, [yellow_row(PULocationID=0, DOLocationID=300, fare_amount=-5.0,
                                             total_amount=60000.0)])
    assert reasons[(0, 300)] == ("invalid_pickup_location, invalid_dropoff_location, negative_fare, "
                                 "excessive_total")


def test_complete_quarantine_traces_every_drop(spark):
    rows = [yellow_row(tpep_dropoff_datetime=T0 - dt.timedelta(minutes=5)),  # negative duration
            yellow_row(fare_amount=None, PULocationID=12)]
    raw = M.bronze(yellow_df(spark, rows))
    ref = M.quarantine(raw, "yellow", complete=False).count()
    full = {r.pickup_location_id: r.quarantine_reason for r in M.quarantine(raw, "yellow", complete=True).collect()}
    assert ref == 0
    assert full == {10: "valid_trip_duration", 12: "valid_fare_amount"}


def test_dedup_keeps_deterministic_survivor(spark):
    rows = [yellow_row(fare_amount=30.0), yellow_row(fare_amount=20.0), yellow_row(fare_amount=25.0),
            yellow_row(VendorID=2)]
    conf = conform_trips(M.bronze(yellow_df(spark, rows)), "yellow", "2025-01-01 00:00:00")
    out = dedup_trips(conf, "yellow").orderBy("VendorID").collect()
    assert [(r.VendorID, r.fare_amount) for r in out] == [(1, 20.0), (2, 20.0)]
    assert dedup_trips(dedup_trips(conf, "yellow"), "yellow").count() == 2  # idempotent


def test_rule_metrics_pass_plus_fail_is_input(spark):
    rows = [yellow_row(), yellow_row(fare_amount=None, PULocationID=3), yellow_row(passenger_count=12, PULocationID=4)]
    conf = conform_trips(M.bronze(yellow_df(spark, rows)), "yellow")
    m = {r.rule_name: r for r in quality.rule_metrics(conf, RULES["yellow"]).collect()}
    assert all(r.passed_records + r.failed_records == 3 for r in m.values())
    assert m["valid_fare_amount"].failed_records == 1
    assert m["no_zero_fare"].failed_records == 1          # NULL fails
    assert m["valid_passenger_count"].failed_records == 1
    assert m["valid_fare_amount"].action == "drop" and m["no_zero_fare"].action == "warn"


def _zones(spark):
    z = spark.createDataFrame([(132, "Queens", "JFK Airport"), (138, "Queens", "LaGuardia Airport"),
                               (1, "EWR", "Newark Airport"), (10, "Manhattan", "Z10"), (264, None, None)],
                              "LocationID INT, Borough STRING, Zone STRING")
    return quality.apply_rules(conform_zones(z), RULES["zone"])


def _silver_from(spark, rows):
    """Silver tables: the given yellow rows, the other sources empty."""
    out = {t: M.silver(M.bronze(spark.createDataFrame([], RAW_SCHEMAS[t])), t) for t in config.TAXI_TYPES}
    out["yellow"] = M.silver(M.bronze(yellow_df(spark, rows)), "yellow")
    return out


def test_airport_trip_counts_once(spark):
    silver = _silver_from(spark, [yellow_row(PULocationID=132, DOLocationID=138)])
    r = marts.airport_metrics(silver).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.jfk_pickups, r.laguardia_dropoffs, r.total_airport_trips) == (1, 1, 1)
    assert (r.jfk_dropoffs, r.laguardia_pickups, r.newark_pickups, r.newark_dropoffs) == (0, 0, 0, 0)


def test_zone_revenue_keeps_unmatched_location(spark):
    silver = _silver_from(spark, [yellow_row(PULocationID=264), yellow_row(PULocationID=10, total_amount=7.0)])
    out = {r.pickup_location_id: r for r in marts.zone_revenue(silver, _zones(spark)).collect()}
    assert out[264].borough is None and out[264].trip_count == 1
    assert out[10].borough == "Manhattan" and out[10].total_revenue == 7.0
    daily = marts.daily_borough_metrics(silver, _zones(spark)).collect()
    assert [(r.borough, r.trip_count) for r in daily] == [("Manhattan", 1)]


@pytest.mark.parametrize("odd, want", [(float("inf"), float("inf")), (1e20, (1e20 + 2) / 2), (None, 2.0), (float("nan"), None)])
def test_average_takes_in_what_no_decimal_holds(spark, odd, want):
    silver = _silver_from(spark, [yellow_row(PULocationID=10, trip_distance=2.0, VendorID=1),
                                  yellow_row(PULocationID=10, trip_distance=odd, VendorID=2)])
    got = [r.avg_distance for r in marts.daily_borough_metrics(silver, _zones(spark)).collect()]
    assert len(got) == 1 and (got[0] != got[0] if want is None else got[0] == want)


def test_marts_refuse_undeclared_columns(spark):
    with pytest.raises(ValueError, match="extra"):
        marts.conform_to_ddl(spark.range(1).withColumn("extra", marts.F.lit(1)), "id LONG")


def test_day_of_week_sunday_is_one(spark):
    sunday = dt.datetime(2024, 1, 7, 10, 0)
    silver = _silver_from(spark, [yellow_row(tpep_pickup_datetime=sunday, PULocationID=10,
                                             tpep_dropoff_datetime=sunday + dt.timedelta(minutes=3))])
    r = marts.hourly_demand(silver, _zones(spark)).collect()
    assert [(x.hour_of_day, x.day_of_week) for x in r] == [(10, 1)]


@pytest.mark.parametrize("code,desc", [(1, "Street-hail"), (2, "Dispatch"), (3, "Unknown")])
def test_trip_type_desc(spark, code, desc):
    from tripflow.functions.expressions import trip_type_desc
    assert spark.range(1).select(trip_type_desc(F.lit(code)).alias("d")).first().d == desc


@pytest.mark.parametrize("code,label", [(0, "Unknown"), (1, "Credit Card"), (4, "Dispute"), (5, "Unknown"),
                                        (None, "Unknown")])
def test_payment_label(spark, code, label):
    from tripflow.functions.expressions import payment_label
    assert spark.range(1).select(payment_label(F.lit(code).cast("long")).alias("d")).first().d == label


def _ev(spark, rows):
    return spark.createDataFrame(rows, audit.EVENT_LOG_DDL)


def test_layer_first_match_wins(spark):
    ev = _ev(spark, [("1", dt.datetime(2024, 1, 1), "flow_progress", "INFO", "",
                      audit.flow_details("bronze_to_gold", "COMPLETED", 10, 2.0, [
                          {"name": "r", "dataset": "d", "passed_records": 0, "failed_records": 0}]))])
    r = audit.dq_log(ev).first()
    assert r.data_layer == "bronze" and r.pass_rate_pct is None
    assert audit.row_count_log(ev).first().rows_per_second == 5.0


@pytest.mark.parametrize("hours,breach,severity", [(6, False, "OK"), (6.01, True, "WARNING"),
                                                    (12, True, "WARNING"), (12.01, True, "CRITICAL")])
def test_sla_boundaries(spark, hours, breach, severity):
    now = dt.datetime(2024, 2, 1)
    ev = _ev(spark, [("1", now - dt.timedelta(hours=hours), "flow_progress", "INFO", "",
                      audit.flow_details("bronze.x", "COMPLETED"))])
    r = audit.sla_monitoring(ev, "2024-02-01 00:00:00").first()
    assert (r.sla_threshold_hours, r.sla_breach, r.severity) == (6, breach, severity)


def test_error_classification(spark):
    ev = _ev(spark, [("1", T0, "flow_progress", "ERROR", "schema drift is critical", "{}"),
                     ("2", T0, "flow_progress", "ERROR", "Schema permission", "{}")])
    got = {r.event_id: (r.error_category, r.severity) for r in audit.error_log(ev).collect()}
    assert got == {"1": ("SCHEMA", "CRITICAL"), "2": ("PERMISSION", "HIGH")}


def test_null_codes_excluded_from_code_marts(spark):
    green_schema = RAW_SCHEMAS["green"]
    rows = [(T0, T0 + dt.timedelta(minutes=5), 10, 20, 1, 1, 1.0, 5.0, 6.0, pay, tt)
            for pay, tt in [(0, 1), (5, 2), (None, 3), (1, None)]]
    silver = {t: M.silver(M.bronze(spark.createDataFrame([], RAW_SCHEMAS[t])), t) for t in config.TAXI_TYPES}
    green = spark.createDataFrame([(r[0] + dt.timedelta(seconds=i),) + r[1:] for i, r in enumerate(rows)],
                                  green_schema)
    silver["green"] = M.silver(M.bronze(green), "green")
    pay = {r.payment_type: r.trip_count for r in marts.payment_trends(silver).collect()}
    assert pay == {0: 1, 5: 1, 1: 1}                                   # NULL payment excluded
    tt = {r.trip_type: r.trip_type_desc for r in marts.trip_type_summary(silver, _zones(spark)).collect()}
    assert tt == {1: "Street-hail", 2: "Dispatch", 3: "Unknown"}      # NULL trip_type excluded


def test_hot_key_dedup_collapses_map_side(spark):
    """One key with 300k rows (plus a few others): one survivor per key, the
    minimum fare; the plan pre-aggregates before the shuffle."""
    from pyspark.sql import functions as F
    from tripflow.operators.dedup import dedup_batch
    hot = (spark.range(300_000)
           .select(F.lit(1).alias("k"), (F.col("id") % 997).cast("double").alias("fare"), F.col("id")))
    cold = spark.range(5).select((F.col("id") + 2).alias("k"), F.lit(1.0).alias("fare"), F.col("id"))
    out = dedup_batch(hot.unionByName(cold), ["k"], ["fare", "id"])
    got = {r.k: (r.fare, r.id) for r in out.collect()}
    assert got[1] == (0.0, 0) and len(got) == 6
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")   # partial below the exchange
