"""Property tests against brute force on small random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripflow.operators.dedup import dedup_batch
from tripflow.operators.storage import apply_change_feed, change_feed

SCHEMA = "k1 INT, k2 STRING, a DOUBLE, b STRING"
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)),
                          st.one_of(st.none(), st.sampled_from(["x", "y"])),
                          st.one_of(st.none(), st.floats(-5, 5, allow_nan=False).map(lambda f: round(f, 2))),
                          st.one_of(st.none(), st.sampled_from(["p", "q", "r"]))),
                max_size=25)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _nulls_first(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows)
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    got = [tuple(r) for r in dedup_batch(df, ["k1", "k2"], ["a", "b"]).collect()]
    best = {}
    for r in data:
        key = (r[0], r[1])
        rank = (_nulls_first(r[2]), _nulls_first(r[3]))
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    want = [v[1] for v in best.values()]
    norm = lambda rs: sorted(rs, key=lambda r: tuple(_nulls_first(x) for x in r))
    assert norm(got) == norm(want)


keyed = st.dictionaries(st.integers(0, 6), st.tuples(st.one_of(st.none(), st.sampled_from(["u", "v"])),
                                                     st.one_of(st.none(), st.integers(0, 3))), max_size=6)


@SETTINGS
@given(keyed, keyed)
def test_change_feed_matches_brute_force(spark, old, new):
    schema = "k INT, s STRING, n INT"
    o = spark.createDataFrame([(k, *v) for k, v in old.items()], schema)
    n = spark.createDataFrame([(k, *v) for k, v in new.items()], schema)
    cf = change_feed(o, n, ["k"])
    got = sorted((r._change_type, r.k) for r in cf.collect())
    want = sorted([("insert", k) for k in new.keys() - old.keys()]
                  + [("delete", k) for k in old.keys() - new.keys()]
                  + [(t, k) for k in old.keys() & new.keys() if old[k] != new[k]
                     for t in ("update_preimage", "update_postimage")])
    assert got == want
    rebuilt = sorted((tuple(r) for r in apply_change_feed(o, cf, ["k"]).collect()), key=lambda r: r[0])
    assert rebuilt == sorted(((k, *v) for k, v in new.items()), key=lambda r: r[0])


trip_vals = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 5.0, 10000.0, 10000.01])),
                               st.one_of(st.none(), st.sampled_from([-2.0, 0.0, 49999.99, 50000.0, 60000.0])),
                               st.one_of(st.none(), st.sampled_from([0, 1, 132, 265, 266]))),
                     min_size=1, max_size=12)


@SETTINGS
@given(trip_vals)
def test_fare_total_location_rules_match_brute_force(spark, vals):
    """Drop rules (NULL fails, bounds inclusive) and reference reasons
    (NULL adds nothing, upper bounds >=) against plain Python."""
    import datetime as dt
    from tripflow.functions.rules import RULES
    from tripflow.operators.conform import conform_trips
    from tripflow.operators.quality import all_pass
    from tripflow.plans import medallion as M
    from tripflow.sources.files import RAW_SCHEMAS
    t0 = dt.datetime(2024, 5, 1, 12)
    raw = spark.createDataFrame(
        [(t0 + dt.timedelta(seconds=i), t0 + dt.timedelta(seconds=i + 600), pu, 10, 1, 1, 1.0, fare, total, 1)
         for i, (fare, total, pu) in enumerate(vals)], RAW_SCHEMAS["yellow"])
    conf = conform_trips(M.bronze(raw), "yellow")
    kept = [r.k for r in conf.select(all_pass(RULES["yellow"].drop_rules).alias("k")).orderBy("pickup_datetime").collect()]

    def ok(v, lo, hi):
        return v is not None and lo <= v <= hi
    assert kept == [ok(f, 0, 10000) and ok(t, 0, 50000) and ok(p, 1, 265) for f, t, p in vals]

    q = {r.pickup_datetime: r.quarantine_reason for r in M.quarantine(M.bronze(raw), "yellow").collect()}
    for i, (fare, total, pu) in enumerate(vals):
        want = []
        if pu is not None and not 1 <= pu <= 265:
            want.append("invalid_pickup_location")
        if fare is not None and fare < 0:
            want.append("negative_fare")
        if fare is not None and fare >= 10000:
            want.append("excessive_fare")
        if total is not None and total < 0:
            want.append("negative_total")
        if total is not None and total >= 50000:
            want.append("excessive_total")
        assert q.get(t0 + dt.timedelta(seconds=i)) == (", ".join(want) or None)


silver_vals = st.lists(st.tuples(st.sampled_from([1, 2, 3, 99]),                 # pickup location (99: no zone)
                                 st.sampled_from([0, 1]),                         # day offset
                                 st.one_of(st.none(), st.sampled_from([1.25, 2.5, 10.0, 0.1])),   # revenue
                                 st.one_of(st.none(), st.sampled_from([0.5, 3.0, 7.25]))),        # distance
                       min_size=1, max_size=15)


@SETTINGS
@given(silver_vals)
def test_marts_match_brute_force(spark, vals):
    """daily_borough_metrics and zone_revenue on random silver rows with NULL
    measures and unmatched locations."""
    import datetime as dt
    from decimal import Decimal
    from tripflow import config
    from tripflow.operators import marts
    from tripflow.plans import medallion as M
    from tripflow.sources.files import RAW_SCHEMAS
    d0 = dt.datetime(2024, 3, 4, 8)
    rows = [(d0 + dt.timedelta(days=day, seconds=i), d0 + dt.timedelta(days=day, seconds=i + 300), pu, 5, 1, 1,
             dist, 5.0, rev, 1) for i, (pu, day, rev, dist) in enumerate(vals)]
    silver = {t: M.silver(M.bronze(spark.createDataFrame([], RAW_SCHEMAS[t])), t) for t in config.TAXI_TYPES}
    silver["yellow"] = M.bronze(spark.createDataFrame(rows, RAW_SCHEMAS["yellow"]))
    silver["yellow"] = M.conformed(silver["yellow"], "yellow")   # keep NULL totals: bypass the drop rules
    zones = spark.createDataFrame([(1, "A", "z1"), (2, "A", "z2"), (3, "B", "z3")],
                                  "location_id INT, borough STRING, zone_name STRING")
    borough = {1: "A", 2: "A", 3: "B"}

    daily = {(r.trip_date, r.borough): r for r in marts.daily_borough_metrics(silver, zones).collect()}
    want = {}
    for pu, day, rev, dist in vals:
        if pu not in borough:
            continue
        g = want.setdefault(((d0 + dt.timedelta(days=day)).date(), borough[pu]), [0, [], []])
        g[0] += 1
        g[1].append(rev)
        g[2].append(dist)
    assert set(daily) == set(want)
    for k, (n, revs, dists) in want.items():
        r = daily[k]
        revs_nn = [Decimal(str(x)) for x in revs if x is not None]
        dists_nn = [Decimal(str(x)) for x in dists if x is not None]
        assert r.trip_count == n
        assert r.total_revenue == (float(sum(revs_nn)) if revs_nn else None)
        assert r.avg_distance == (float(sum(dists_nn)) / len(dists_nn) if dists_nn else None)

    zr = {r.pickup_location_id: r for r in marts.zone_revenue(silver, zones).collect()}
    assert set(zr) == {pu for pu, *_ in vals}                       # unmatched location 99 kept
    for pu, r in zr.items():
        revs = [rev for p, _, rev, _ in vals if p == pu and rev is not None]
        assert r.trip_count == sum(1 for p, *_ in vals if p == pu)
        assert r.borough == borough.get(pu)
        assert r.min_revenue == (min(revs) if revs else None) and r.max_revenue == (max(revs) if revs else None)
