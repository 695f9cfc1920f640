"""Serving queries over the marts (dashboard widgets), the latest-days
report and the row-count smoke report.

Widget semantics: group by the non-aggregated fields, aggregate the rest.
Double measures of a mart are re-summed exactly (decimal) so the answer does
not depend on the order partitions arrive in. Every query here reads a mart
(thousands of rows per year of trips), so each is one small aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow import config
from tripflow.functions.expressions import exact, payment_label


def _resum(c: str):
    """Exact sum; what no decimal holds (NaN, infinity) is added to it as DOUBLE."""
    held = exact(c, config.EXACT_REAGG)
    whole, odd = F.sum(held).cast("double"), F.sum(F.when(held.isNull(), F.col(c)))
    return F.coalesce(whole + odd, whole, odd)


def _reavg(c: str):
    return F.try_divide(_resum(c), F.count(c))


def total_trips(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("trip_count").alias("total_trips"))


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(_resum("total_revenue").alias("total_revenue"))


def avg_distance(daily: DataFrame) -> DataFrame:
    """Unweighted mean of the per-group averages (as the dashboard shows)."""
    return daily.agg(_reavg("avg_distance").alias("avg_distance"))


def avg_fare(payment: DataFrame) -> DataFrame:
    """Unweighted mean of the per-group average fares."""
    return payment.agg(_reavg("avg_fare").alias("avg_fare"))


def daily_revenue_by_type(daily: DataFrame) -> DataFrame:
    return daily.groupBy("taxi_type", "trip_date").agg(_resum("total_revenue").alias("total_revenue"))


def trips_by_type(daily: DataFrame) -> DataFrame:
    return daily.groupBy("taxi_type").agg(F.sum("trip_count").alias("trip_count"))


def hourly_profile(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("hour_of_day").agg(F.sum("trip_count").alias("trip_count"))


def day_of_week_profile(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("day_of_week").agg(F.sum("trip_count").alias("trip_count"))


def airport_comparison(airport: DataFrame) -> DataFrame:
    return airport.groupBy("taxi_type").agg(
        F.sum(F.col("jfk_pickups") + F.col("jfk_dropoffs")).alias("jfk_total_trips"),
        F.sum(F.col("laguardia_pickups") + F.col("laguardia_dropoffs")).alias("laguardia_total_trips"),
        F.sum(F.col("newark_pickups") + F.col("newark_dropoffs")).alias("newark_total_trips"))


def zones_by_revenue(zone_rev: DataFrame) -> DataFrame:
    """Revenue per zone name (no ordering or limit, as the widget has)."""
    return zone_rev.groupBy("zone_name").agg(_resum("total_revenue").alias("total_revenue"))


def payment_trend(payment: DataFrame) -> DataFrame:
    return (payment.withColumn("payment_method", payment_label("payment_type"))
            .groupBy("payment_method", "trip_date")
            .agg(_resum("total_revenue").alias("total_revenue")))


def trip_type_breakdown(trip_type: DataFrame) -> DataFrame:
    return trip_type.groupBy("trip_type_desc").agg(F.sum("trip_count").alias("trip_count"))


def top_days(daily: DataFrame, n: int = 20) -> DataFrame:
    """Latest days, busiest first; borough and taxi type complete the order
    so the cut at ``n`` is deterministic. Planned as a top-k (each task
    keeps n rows), never a full sort."""
    return daily.orderBy(F.col("trip_date").desc(), F.col("trip_count").desc(),
                         F.col("borough").asc(), F.col("taxi_type").asc()).limit(n)


def smoke_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Labelled row counts of several tables, one row each (UNION ALL)."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


SERVING = {
    "srv_total_trips": ("daily_borough_metrics", total_trips),
    "srv_total_revenue": ("daily_borough_metrics", total_revenue),
    "srv_avg_distance": ("daily_borough_metrics", avg_distance),
    "srv_avg_fare": ("payment_trends", avg_fare),
    "srv_daily_revenue": ("daily_borough_metrics", daily_revenue_by_type),
    "srv_trips_by_type": ("daily_borough_metrics", trips_by_type),
    "srv_hourly": ("hourly_demand", hourly_profile),
    "srv_dow": ("hourly_demand", day_of_week_profile),
    "srv_airport": ("airport_metrics", airport_comparison),
    "srv_zones": ("zone_revenue", zones_by_revenue),
    "srv_payment": ("payment_trends", payment_trend),
    "srv_trip_type": ("trip_type_summary", trip_type_breakdown),
}
