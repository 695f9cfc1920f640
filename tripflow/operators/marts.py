"""Gold marts: union of silver sources -> zone join -> grouped measures.

Each mart is a ``MartSpec``: per-source projection, row filter, group keys,
mergeable measures (count / exact sum / non-NULL count / min / max) and the
finishing projection. Trips are first aggregated per pickup location (map-side
combine); only these partial rows meet the zones, and the zone join merges them. So
the trip volume never meets the join, whatever the dimension's size, and a hot location can't
skew it.

Measures are summed exactly (decimal) and returned as DOUBLE; what no decimal
holds (NaN, infinities, 1e18 and more) is summed beside them as DOUBLE. Averages are
the sum divided by the count of non-NULL values, NULL when there is none. Each mart projects only its columns, so silver scans are pruned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow import config
from tripflow.functions.expressions import trip_type_desc
from tripflow.operators.joins import attach_zones, zone_side

PRICED = ("yellow", "green", "fhvheavy")
ZONE_COLS = ("borough", "zone_name")


@dataclass(frozen=True)
class Measure:
    """A partial aggregate over trip rows and how partials merge."""
    name: str
    partial: Column
    merge: str = "sum"  # sum | min | max

    def merged(self) -> Column:
        return F.expr(f"{self.merge}(`{self.name}`)").alias(self.name)


# Measures and finishing expressions are SQL text: one JVM call per column.

def count_all() -> Measure:
    return Measure("_n", F.expr("count(1)"))


def exact_total(c: str) -> list[Measure]:
    """Exact (decimal) sum, and beside it the sum of what no decimal holds."""
    cast = f"try_cast(`{c}` AS {config.EXACT_MEASURE})"
    return [Measure(f"_sum_{c}", F.expr(f"sum({cast})")),
            Measure(f"_odd_{c}", F.expr(f"sum(CASE WHEN {cast} IS NULL THEN CAST(`{c}` AS DOUBLE) END)"))]


def nonnull(c: str) -> Measure:
    return Measure(f"_cnt_{c}", F.expr(f"count(`{c}`)"))


def count_when(name: str, cond_sql: str) -> Measure:
    return Measure(name, F.expr(f"sum(CASE WHEN {cond_sql} THEN 1 ELSE 0 END)"))


def extreme(name: str, fn: str, c: str) -> Measure:
    return Measure(name, F.expr(f"{fn}(`{c}`)"), fn)


def _total(c: str) -> str:
    exact = f"CAST(`_sum_{c}` AS DOUBLE)"
    return f"(CASE WHEN `_odd_{c}` IS NULL THEN {exact} ELSE coalesce({exact}, 0D) + `_odd_{c}` END)"


def finish_sum(c: str) -> Column:
    return F.expr(_total(c))


def finish_avg(c: str) -> Column:
    return F.expr(f"try_divide({_total(c)}, `_cnt_{c}`)")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def conform_to_ddl(df: DataFrame, ddl: str) -> DataFrame:
    """Order and cast columns by a declared schema; fail on a missing or extra one."""
    fields = [f.strip().split(" ", 1) for f in ddl.split(",")]
    names = [n for n, _ in fields]
    if odd := set(names) ^ set(df.columns):
        raise ValueError(f"columns missing from the frame or from the declared schema: {sorted(odd)}")
    return df.selectExpr(*[f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in fields])


@dataclass(frozen=True)
class MartSpec:
    name: str
    sources: tuple[str, ...]
    project: Callable[[str, DataFrame], list]      # source -> columns of the common trip shape
    keys: list[str]                                # output keys (may name zone columns)
    measures: list[Measure]
    finish: list[Column]                           # output columns after merging
    where: Callable[[], Column] | None = None      # row filter before aggregation
    zones: str | None = None                       # None, "matched" (left + borough not null) or "left"
    extra: Callable[[DataFrame], DataFrame] = field(default=lambda df: df)

    @property
    def pre_keys(self) -> list[str]:
        """Keys without zone columns, plus the pickup location when zones join."""
        ks = [k for k in self.keys if k not in ZONE_COLS]
        if self.zones and "pickup_location_id" not in ks:
            ks.append("pickup_location_id")
        return ks

    def trips(self, silver: dict[str, DataFrame]) -> DataFrame:
        out = union_all([silver[t].select(*self.project(t, silver[t])) for t in self.sources])
        return out.filter(self.where()) if self.where else out

    def _finish(self, grouped: DataFrame) -> DataFrame:
        return conform_to_ddl(self.extra(grouped.select(*self.keys, *self.finish)),
                              config.MART_DDL[self.name])


def _zone_filter(df: DataFrame, spec: MartSpec) -> DataFrame:
    return df.filter(F.col("borough").isNotNull()) if spec.zones == "matched" else df


def build(spec: MartSpec, silver: dict[str, DataFrame], zones: DataFrame | None = None) -> DataFrame:
    """One mart from silver."""
    pre = spec.trips(silver).groupBy(*spec.pre_keys).agg(*[m.partial.alias(m.name) for m in spec.measures])
    if not spec.zones:
        return spec._finish(pre)
    parts = _zone_filter(attach_zones(pre, zone_side(zones), "left"), spec)
    return spec._finish(parts.groupBy(*spec.keys).agg(*[m.merged() for m in spec.measures]))


# --------------------------------------------------------------------------- the six marts


def _date() -> Column:
    return F.col("pickup_datetime").cast("date").alias("trip_date")


def _rev(t: str) -> str:
    return "base_passenger_fare" if t == "fhvheavy" else "total_amount"


def _dist(t: str) -> str:
    return "trip_miles" if t == "fhvheavy" else "trip_distance"


def _hits(c: str, loc: int) -> str:
    return f"{c} = {loc}"


AIRPORTS = f"({config.JFK_LOCATION_ID}, {config.LAGUARDIA_LOCATION_ID}, {config.NEWARK_LOCATION_ID})"

_SPECS = {
    "daily_borough_metrics": lambda: MartSpec(
        "daily_borough_metrics", PRICED,
        lambda t, s: [_date(), "pickup_location_id", "taxi_type",
                      F.col(_rev(t)).alias("revenue"), F.col(_dist(t)).alias("trip_distance")],
        ["trip_date", "borough", "taxi_type"],
        [count_all(), *exact_total("revenue"), *exact_total("trip_distance"), nonnull("trip_distance")],
        [F.col("_n").alias("trip_count"), finish_sum("revenue").alias("total_revenue"),
         finish_avg("trip_distance").alias("avg_distance")],
        zones="matched"),
    "hourly_demand": lambda: MartSpec(
        "hourly_demand", config.TAXI_TYPES,
        lambda t, s: [F.hour("pickup_datetime").alias("hour_of_day"),
                      F.dayofweek("pickup_datetime").alias("day_of_week"), "pickup_location_id", "taxi_type"],
        ["hour_of_day", "day_of_week", "borough", "taxi_type"],
        [count_all()], [F.col("_n").alias("trip_count")],
        zones="matched"),
    "airport_metrics": lambda: MartSpec(
        "airport_metrics", config.TAXI_TYPES,
        lambda t, s: [_date(), "pickup_location_id", "dropoff_location_id", "taxi_type"],
        ["trip_date", "taxi_type"],
        [count_when("jfk_pickups", _hits("pickup_location_id", config.JFK_LOCATION_ID)),
         count_when("jfk_dropoffs", _hits("dropoff_location_id", config.JFK_LOCATION_ID)),
         count_when("laguardia_pickups", _hits("pickup_location_id", config.LAGUARDIA_LOCATION_ID)),
         count_when("laguardia_dropoffs", _hits("dropoff_location_id", config.LAGUARDIA_LOCATION_ID)),
         count_when("newark_pickups", _hits("pickup_location_id", config.NEWARK_LOCATION_ID)),
         count_when("newark_dropoffs", _hits("dropoff_location_id", config.NEWARK_LOCATION_ID)),
         count_all()],
        [F.col(c) for c in ("jfk_pickups", "jfk_dropoffs", "laguardia_pickups", "laguardia_dropoffs",
                            "newark_pickups", "newark_dropoffs")] + [F.col("_n").alias("total_airport_trips")],
        where=lambda: F.expr(f"pickup_location_id IN {AIRPORTS} OR dropoff_location_id IN {AIRPORTS}")),
    "zone_revenue": lambda: MartSpec(
        "zone_revenue", PRICED,
        lambda t, s: ["pickup_location_id", "taxi_type", F.col(_rev(t)).alias("revenue")],
        ["pickup_location_id", "zone_name", "borough", "taxi_type"],
        [count_all(), *exact_total("revenue"), nonnull("revenue"),
         extreme("_min", "min", "revenue"), extreme("_max", "max", "revenue")],
        [F.col("_n").alias("trip_count"), finish_sum("revenue").alias("total_revenue"),
         finish_avg("revenue").alias("avg_revenue"), F.col("_min").alias("min_revenue"),
         F.col("_max").alias("max_revenue")],
        zones="left"),
    "payment_trends": lambda: MartSpec(
        "payment_trends", ("yellow", "green"),
        lambda t, s: [_date(), "payment_type", "taxi_type", "total_amount", "fare_amount"],
        ["trip_date", "payment_type", "taxi_type"],
        [count_all(), *exact_total("total_amount"), *exact_total("fare_amount"), nonnull("fare_amount")],
        [F.col("_n").alias("trip_count"), finish_sum("total_amount").alias("total_revenue"),
         finish_avg("fare_amount").alias("avg_fare")],
        where=lambda: F.col("payment_type").isNotNull() & F.col("trip_date").isNotNull()),
    "trip_type_summary": lambda: MartSpec(
        "trip_type_summary", ("green",),
        lambda t, s: [_date(), "pickup_location_id", "trip_type"],
        ["trip_date", "borough", "trip_type"],
        [count_all()], [F.col("_n").alias("trip_count")],
        where=lambda: F.col("trip_type").isNotNull(),
        zones="matched",
        extra=lambda df: df.withColumn("trip_type_desc", trip_type_desc("trip_type"))),
}


def spec(name: str) -> MartSpec:
    """One mart spec (built on demand: columns need an active session)."""
    return _SPECS[name]()


def specs() -> dict[str, MartSpec]:
    return {n: b() for n, b in _SPECS.items()}


def daily_borough_metrics(silver, zones) -> DataFrame:
    return build(spec("daily_borough_metrics"), silver, zones)


def hourly_demand(silver, zones) -> DataFrame:
    return build(spec("hourly_demand"), silver, zones)


def airport_metrics(silver) -> DataFrame:
    return build(spec("airport_metrics"), silver)


def zone_revenue(silver, zones) -> DataFrame:
    return build(spec("zone_revenue"), silver, zones)


def payment_trends(silver) -> DataFrame:
    return build(spec("payment_trends"), silver)


def trip_type_summary(silver, zones) -> DataFrame:
    return build(spec("trip_type_summary"), silver, zones)


MARTS = {
    "daily_borough_metrics": daily_borough_metrics,
    "hourly_demand": hourly_demand,
    "airport_metrics": airport_metrics,
    "zone_revenue": zone_revenue,
    "payment_trends": payment_trends,
    "trip_type_summary": trip_type_summary,
}


def all_marts(silver: dict[str, DataFrame], zones: DataFrame) -> dict[str, DataFrame]:
    return {n: build(spec, silver, zones if spec.zones else None) for n, spec in specs().items()}
