"""Queries without SQL, against plain Python over the same tables."""

import heapq
import math

import duckdb
import numpy as np
import pytest

from isoreach.plans.domain import OBJECTS
from isoreach.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    con = duckdb.connect()

    def get(sql):
        for t in ("customer", "supplier", "nation", "orders", "part", "conversations", "lineitem"):
            con.execute(f"create or replace view {t} as select * from '{SF}/{t}.parquet'")
        table = con.sql(sql).to_arrow_table()
        return table.to_pylist()

    return get


def domain(rows, name):
    table, exprs = OBJECTS[name]
    return rows(f"select {', '.join(exprs)} from {table}")


def run(spark, name):
    return REGISTRY[name][0](spark, SF).collect()


def one(spark, name):
    (r,) = run(spark, name)
    return r.asDict()


def near(r, p):
    """Distance of a point to a segment, and where its foot is."""
    dx, dy = r["x1"] - r["x0"], r["y1"] - r["y0"]
    t = max(0.0, min(1.0, ((p[0] - r["x0"]) * dx + (p[1] - r["y0"]) * dy) / (dx * dx + dy * dy)))
    return math.hypot(p[0] - r["x0"] - t * dx, p[1] - r["y0"] - t * dy), t


@pytest.fixture(scope="module")
def lines(rows):
    return [{"edge_id": d["dest_id"], "x0": d["dx"], "y0": d["dy"], "x1": d["dx"] + 30, "y1": d["dy"] + 20} for d in domain(rows, "dests")]


def test_counters(spark, rows, lines):
    want = {}
    for c in domain(rows, "cells"):
        found = []
        for e in lines:
            d, _ = near(e, (c["x"], c["y"]))
            turn = abs(math.degrees(math.atan2(30, 20)) % 360 - c["cell_id"] % 360)
            if d <= 25 and min(turn, 360 - turn) <= 60:
                found.append((round(d, 6), e["edge_id"]))
        if found:
            want[c["cell_id"]] = min(found)[::-1]
    assert want and {r.counter_id: (r.edge_id, r.dist) for r in run(spark, "j16_counters")} == {k: (e, pytest.approx(d, abs=1e-4)) for k, (e, d) in want.items()}


def test_projected_nodes(spark, rows, lines):
    want, length = {}, math.hypot(30, 20)
    for c in domain(rows, "cells"):
        found = [(round(near(e, (c["x"], c["y"]))[0], 6), e["edge_id"], near(e, (c["x"], c["y"]))[1]) for e in lines]
        d, edge, t = min(found)
        if d <= 25:
            node = "u" if t * length < 5 else "v" if (1 - t) * length < 5 else "new"
            want[c["cell_id"]] = (edge, node, pytest.approx({"u": 0.0, "v": 1.0, "new": t}[node], abs=1e-4))
    assert want and {r.cell_id: (r.edge_id, r.node, r.share) for r in run(spark, "n15_projected_nodes")} == want


def test_sidepaths(spark, rows):
    ways = [{"way_id": d["dest_id"], "c": d["category"], "x0": d["dx"], "y0": d["dy"], "x1": d["dx"] + 30, "y1": d["dy"] + 5} for d in domain(rows, "dests")]
    kept = [w | {"x1": w["x0"] + 400} for w in ways if w["c"]]
    want = set()
    for w in ways:
        at = [(w["x0"] + k / 10 * 30, w["y0"] + k / 10 * 5) for k in range(11)]
        if not w["c"] and sum(any(near(e, p)[0] <= 20 for e in kept) for p in at) >= 0.8 * 11:
            want.add(w["way_id"])
    assert {r.way_id for r in run(spark, "n9_sidepaths")} == want


def graph(rows):
    best = {}
    for e in rows("select o_custkey as u, (o_custkey * 7 + o_orderkey) % 1499 as v, o_totalprice / 1000 as w from orders"):
        best[e["u"], e["v"]] = min(e["w"], best.get((e["u"], e["v"]), math.inf))
    out = {}
    for (u, v), w in best.items():
        out.setdefault(u, []).append((v, w))
    return out


def cheapest(g, o):
    cost, heap = {}, [(0.0, o)]
    while heap:
        c, u = heapq.heappop(heap)
        if u not in cost:
            cost[u] = c
            for v, w in g.get(u, ()):
                heapq.heappush(heap, (c + w, v))
    return cost


def test_paths(spark, rows):
    g, want = graph(rows), {}
    nodes = set(g) | {v for out in g.values() for v, _ in out}
    for c in rows("select c_custkey as k, c_nationkey + 1 as o, (c_custkey * 31) % 1499 as d from customer"):
        cost = cheapest(g, c["o"]) if c["o"] in nodes else {}
        if c["d"] in cost and c["d"] != c["o"]:
            want[c["k"]] = cost[c["d"]]
    got = {r.trip_id: r.cost for r in run(spark, "r4_path_metrics")}
    assert want and got == {k: pytest.approx(v, abs=1e-3) for k, v in want.items()}
    assert sum(r.trips for r in run(spark, "r5_betweenness")) == sum(r.n_edges for r in run(spark, "r4_path_metrics"))


def test_path_features(spark, rows):
    for r in run(spark, "h8_path_features"):
        assert r.n_edges >= 1 and r.cost > 0 and r.t >= r.cost - 1e-9 and 0 <= r.signals <= 1


def test_chains(spark, rows):
    edges = [(e["u"], e["v"], e["w"]) for e in rows("select o_custkey as u, (o_custkey * 7 + o_orderkey) % 1499 as v, o_totalprice / 1000 as w from orders")]
    got = run(spark, "n5_chain_collapse")
    beside, degree, loops = {}, {}, set()
    for u, v, _ in edges:
        for a, b in ((u, v), (v, u)):
            degree[a] = degree.get(a, 0) + 1
            if u == v:
                loops.add(u)
            else:
                beside.setdefault(a, set()).add(b)
    inner = {n for n, d in degree.items() if n not in loops and len(beside.get(n, ())) == 2 and d in (2, 4)}
    assert inner and all(r.u not in inner and r.v not in inner for r in got)
    plain = sorted((u, v, w) for u, v, w in edges if u not in inner and v not in inner)
    assert sorted((r.u, r.v, r.length) for r in got if r.n_parts == 1) == [(u, v, pytest.approx(w, abs=1e-3)) for u, v, w in plain]


def test_smoothing(spark, rows):
    for r in (got := run(spark, "w9_smoothing")):
        assert r.smooth is not None
    by = {}
    for r in got:
        by.setdefault(r.category, {})[r.bin] = (r.t, r.smooth)
    for bins in by.values():
        for b, (t, s) in bins.items():
            runs = [b]
            while runs[0] - 1 in bins:
                runs.insert(0, runs[0] - 1)
            while runs[-1] + 1 in bins:
                runs.append(runs[-1] + 1)
            if len(runs) < 5:
                assert s == pytest.approx(t, abs=1e-3)
                continue
            at = min(max(b, runs[0] + 2), runs[-1] - 2)
            x = np.arange(at - 2, at + 3)
            fit = np.polyfit(x - at, [bins[k][0] for k in x.tolist()], 2)
            assert s == pytest.approx(np.polyval(fit, b - at), abs=2e-3)


def test_simplified_lines_stay_within_the_tolerance(spark, rows):
    lines = {}
    for r in rows("select l_orderkey as k, l_linenumber::double as x, l_quantity as y from lineitem order by 1, 2, 3"):
        lines.setdefault(r["k"], []).append((r["x"], r["y"]))

    def kept(p):
        if len(p) <= 2:
            return p
        e = {"x0": p[0][0], "y0": p[0][1], "x1": p[-1][0], "y1": p[-1][1]}
        far = [near(e, q)[0] for q in p[1:-1]]
        k = int(np.argmax(far))
        return [p[0], p[-1]] if far[k] <= 10 else kept(p[: k + 2])[:-1] + kept(p[k + 1 :])

    want = {k: kept(p) for k, p in lines.items()}
    got = {r.l_orderkey: (r.n, r.length) for r in run(spark, "n14_simplification")}
    assert {k: n for k, (n, _) in got.items()} == {k: len(p) for k, p in want.items()}
    assert all(got[k][1] == pytest.approx(sum(math.dist(a, b) for a, b in zip(p, p[1:], strict=False)), abs=1e-3) for k, p in want.items())


def cells(rows):
    c = domain(rows, "cells")
    return [np.array([float(r[k]) for r in c]) for k in ("cell_id", "x", "y", "population")]


def test_poisson_solves_its_equations(spark, rows):
    _, x, y, pop = cells(rows)
    fit, t = one(spark, "e2_poisson"), np.floor(pop / 1000)
    mu = np.exp(fit["const"] + fit["a"] * x / 1000 + fit["b"] * y / 1000)
    for f in (1.0, x / 1000, y / 1000):
        assert np.sum((t - mu) * f) == pytest.approx(0, abs=1e-5 * len(t))


def test_median_regression_is_a_minimum(spark, rows):
    _, x, _, pop = cells(rows)
    fit, a, t = one(spark, "e3_median_regression"), x / 1000, pop / 1000
    loss = lambda c, s: np.abs(t - c - s * a).sum()
    best = loss(fit["const"], fit["a"])
    # the exact minimum goes through two of the points
    exact = min(loss(t[i] - (t[j] - t[i]) / (a[j] - a[i]) * a[i], (t[j] - t[i]) / (a[j] - a[i])) for i in range(len(t)) for j in range(i) if a[i] != a[j])
    assert best <= exact * 1.002


def test_huber_solves_its_equations(spark, rows):
    _, x, _, pop = cells(rows)
    fit, a, t = one(spark, "e4_huber"), x / 1000, pop / 1000
    psi = np.clip(t - fit["const"] - fit["a"] * a, -1.345 * 2, 1.345 * 2)
    assert psi.sum() == pytest.approx(0, abs=1e-3) and (psi * a).sum() == pytest.approx(0, abs=1e-3)


def test_interval_regression_is_near_the_likelihoods_maximum(spark):
    from isoreach.operators import estimators as E

    r = np.random.default_rng(4)
    x = r.uniform(0, 10, 3000)
    y = 3 + 2 * x + r.normal(0, 2, 3000)
    table = spark.createDataFrame([(float(a), float(4 * math.floor(b / 4)), float(4 * math.floor(b / 4) + 4)) for a, b in zip(x, y, strict=True)], "x double, lo double, hi double")
    fit = E.interval_em(table, "lo", "hi", ["x"], rounds=30, burn_in=20)
    assert fit["const"] == pytest.approx(3, abs=0.25) and fit["x"] == pytest.approx(2, abs=0.05)
    assert set(one(spark, "e5_interval_em")) == {"const", "a"}


def choices(rows):
    n, x, y, _ = cells(rows)
    car = (n * 13 % 100) / 50.0 + x / 500 < y / 500 + 1
    return n, x / 500, y / 500, car


def test_multinomial_logit_solves_its_equations(spark, rows):
    _, car_t, bus_t, car = choices(rows)
    fit = one(spark, "e9_multinomial_logit")
    v = fit["asc_car"] + fit["b_time"] * (car_t - bus_t)
    p = 1 / (1 + np.exp(-v))
    assert (car - p).sum() == pytest.approx(0, abs=1e-3) and ((car - p) * (car_t - bus_t)).sum() == pytest.approx(0, abs=1e-3)
    assert fit["ll"] == pytest.approx(np.where(car, np.log(p), np.log(1 - p)).sum(), abs=1e-4)


def nested_ll(rows, asc, time, scale):
    n, car_t, bus_t, car = choices(rows)
    rail_t = bus_t * 500 / 450 + 0.2
    rail = ~car & (n % 3 == 0)
    vc, vb, vr = asc + time * car_t, time * bus_t, time * rail_t
    inclusive = np.log(np.exp(vb / scale) + np.exp(vr / scale))
    total = np.log(np.exp(vc) + np.exp(scale * inclusive))
    return np.where(car, vc - total, np.where(rail, vr, vb) / scale - inclusive + scale * inclusive - total).sum()


def test_nested_logit_is_a_maximum(spark, rows):
    fit = one(spark, "e9_nested_logit")
    at = (fit["asc_car"], fit["b_time"], fit["lambda_public"])
    best = nested_ll(rows, *at)
    assert fit["ll"] == pytest.approx(best, abs=1e-5) and fit["ll_null"] == pytest.approx(nested_ll(rows, 0, 0, 1), abs=1e-6)
    for k in range(3):
        for step in (-0.1, 0.1):
            other = [v + step * (i == k) for i, v in enumerate(at)]
            assert nested_ll(rows, *other) <= best + 0.02


def test_specifications(spark, rows):
    _, x, y, pop = cells(rows)
    got = {r.spec: r for r in run(spark, "e7_spec_grid")}
    design = np.stack([np.ones(len(x)), x / 1000, y / 1000], axis=1)
    free = np.linalg.lstsq(design, pop / 1000, rcond=None)[0]
    assert (got["two"].const, got["two"].a, got["two"].b) == pytest.approx(tuple(free), abs=1e-6)
    bound = got["two_constrained"]
    assert bound.a >= 0 and bound.b >= 0
    loss = lambda b: ((pop / 1000 - design @ np.array(b)) ** 2).sum()
    found = loss([bound.const, bound.a, bound.b])
    for grid in np.random.default_rng(1).uniform(0, 6, (400, 3)):
        assert found <= loss(grid) + 1e-9


def test_intensities_meet_the_conditions_of_the_least_squares(spark, rows):
    got = {r.tag: r for r in run(spark, "d4_nnls_intensities")}
    total = rows("select sum(100.0 + n_nationkey * 10) as t from nation")[0]["t"]
    assert all(r.intensity >= 0 for r in got.values())
    assert sum(r.contribution for r in got.values()) == pytest.approx(float(total), rel=1e-6)
    area = {}
    for b in domain(rows, "buildings"):
        cx, cy = (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2
        if cx < 1000 and cy < 1000:
            area.setdefault((int(cy // 200) * 5 + int(cx // 200)), {}).setdefault(b["tag"], []).append((b["x1"] - b["x0"]) * (b["y1"] - b["y0"]))
    tags = sorted(got)
    x = np.array([[sum(area.get(c, {}).get(t, [])) for t in tags] for c in range(25)])
    scale = np.array([got[t].intensity for t in tags])
    y = np.array([100.0 + 10 * c for c in range(25)])
    raw = scale / max(1e-12, (x @ scale).sum()) * (x @ scale).sum()
    k = (raw @ x.T @ y) / max(1e-12, raw @ x.T @ x @ raw)  # the fit before its totals were scaled
    slope = x.T @ (y - x @ (k * raw))
    assert all(abs(s) <= 1e-4 * np.abs(x.T @ y).max() if b > 0 else s <= 1e-4 * np.abs(x.T @ y).max() for s, b in zip(slope, raw, strict=True))


def test_weighted_draws(spark, rows):
    got = {r.cell_id: r.times for r in run(spark, "x1_weighted_sample")}
    n, _, _, pop = cells(rows)
    assert sum(got.values()) == 1000 and all(pop[n == k][0] > 0 for k in got)
    expected = 1000 * pop / pop.sum()
    seen = np.array([got.get(int(k), 0) for k in n])
    assert ((seen - expected) ** 2 / np.maximum(expected, 1)).sum() < 2 * len(n)


def test_destination_sample(spark, rows):
    got = run(spark, "x2_destination_sample")
    place = {c["cell_id"]: (c["x"], c["y"]) for c in domain(rows, "cells")}
    dest = {d["dest_id"]: (d["dx"], d["dy"], d["weight"]) for d in domain(rows, "dests")}
    share = {0: 0.5, 1: 0.3, 2: 0.2}
    reach = {}
    for o, (x, y) in place.items():
        for d, (dx, dy, w) in dest.items():
            b = int(math.hypot(x - dx, y - dy) // 100)
            if math.hypot(x - dx, y - dy) <= 300 and w > 0 and b in share:
                reach.setdefault(o, {}).setdefault(b, {})[d] = w
    times = {}
    for r in got:
        times.setdefault(r.cell_id, {})[r.dest_id] = r.times
    assert set(times) == set(reach) and all(sum(t.values()) == 20 for t in times.values())
    seen, expected = {0: 0, 1: 0, 2: 0}, {0: 0.0, 1: 0.0, 2: 0.0}
    for o, bins in reach.items():
        for b, members in bins.items():
            expected[b] += 20 * share[b] / sum(share[k] for k in bins)
            seen[b] += sum(times[o].get(d, 0) for d in members)
    assert all(abs(seen[b] - expected[b]) < 0.12 * max(expected[b], 60) for b in seen)


def test_consolidated_nodes(spark, rows):
    place = {c["cell_id"]: (c["x"], c["y"]) for c in domain(rows, "cells")}
    root = {k: k for k in place}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for u in place:
        v = u * 7 % 97
        if u != v and v in place and math.dist(place[u], place[v]) <= 300:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    assert {r.node_id: r.cluster for r in run(spark, "n7_consolidation")} == {k: find(k) for k in place}


SPEEDS = {"walk": (2.0, 8.0), "car": (5.0, 130.0), "transit": (None, None)}


def test_trips(spark, rows):
    legs = {}
    for r in rows("select conv_id, turn, length(text) * 2.0::double as d, conv_id % 5 as five from conversations order by 1, 2"):
        mode = "transit" if r["turn"] % 4 == 1 else "car" if r["turn"] % 4 == 3 and r["five"] == 0 else "walk"
        d, dep = r["d"], r["turn"] * 900.0 + 28_800
        t = round(d / 90) * 60 + 60
        legs.setdefault(r["conv_id"], []).append({"mode": mode, "d": d, "t": t, "dep": dep, "arr": dep + t, "ox": r["turn"] * 300.0, "dx": r["turn"] * 300.0 + d / 2})
    want = {}
    for trip, own in legs.items():
        at = [k for k, x in enumerate(own) if x["mode"] == "transit"]
        cars = [k for k, x in enumerate(own) if x["mode"] == "car"]
        fine = (len(own) == 1 and own[0]["mode"] == "walk") or (not at and len(cars) == 1)
        fine |= bool(at) and not any(at[0] < k < at[-1] for k in cars) and sum(k < at[0] for k in cars) <= 1 and sum(k > at[-1] for k in cars) <= 1
        if not fine:
            continue
        main = "transit" if at else "car" if cars else "walk"
        span = own[-1]["arr"] - own[0]["dep"]
        line = abs(own[-1]["dx"] - own[0]["ox"])
        excess = 0.0
        for x in own:
            low, minutes = SPEEDS[x["mode"]][0], round(x["t"] / 60)
            exact = max(minutes - 0.5, 0) * 60
            rounded = (0.0 if minutes == 5 else max(minutes - 2.5, 0) * 60) if minutes % 5 == 0 else exact
            if x["mode"] != main and low:
                excess += max(0.0, min(exact, rounded) - x["d"] / (low / 3.6))
        gap = span - sum(x["t"] for x in own)
        others = max(0.0 if x["mode"] == main else x["t"] for x in own)
        want[trip] = (main, len(own), len(at), pytest.approx(sum(x["d"] for x in own)), pytest.approx(span), pytest.approx(line), pytest.approx(gap), pytest.approx(gap + excess), int(line >= 100), int(others <= (1800 if main == "transit" else 900)))
    got = {r.trip_id: (r.mode, r.n_legs_in_trip, r.n_transit_legs, r.dist_measured, r.time_measured, r.dist_line, r.time_gap, r.time_unexplained, r.is_above_min_dist_line, r.is_within_other_legs_time) for r in run(spark, "t2_trips")}
    assert want and got == want


def test_every_query_without_sql_has_a_plain_version():
    checked = {"n7_consolidation", "j16_counters", "n15_projected_nodes", "n9_sidepaths", "r4_path_metrics", "r5_betweenness", "h8_path_features", "n5_chain_collapse", "w9_smoothing", "n14_simplification", "e2_poisson", "e3_median_regression", "e4_huber", "e5_interval_em", "e9_multinomial_logit", "e9_nested_logit", "e7_spec_grid", "d4_nnls_intensities", "x1_weighted_sample", "x2_destination_sample", "t2_trips"}
    assert {k for k, (_, sql) in REGISTRY.items() if not sql} <= checked
