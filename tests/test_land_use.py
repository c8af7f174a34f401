import logging

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isoreach.operators import dasymetric as D

BUILDING = "building_id long, tag string, x0 double, y0 double, x1 double, y1 double"
CELL = "cell_id long, cx0 double, cy0 double, cx1 double, cy1 double, total double"


def square(k, tag, x, y, side=10.0):
    return (k, tag, float(x), float(y), float(x) + side, float(y) + side)


def cell(k, x, y, total):
    return (k, float(x), float(y), x + 100.0, y + 100.0, float(total))


def fit(spark, buildings, cells, fallback=None):
    b, c = spark.createDataFrame(buildings, BUILDING), spark.createDataFrame(cells, CELL)
    return {r.tag: r for r in D.fit_intensities(spark, D.area_long(b, c, fallback), c.select("cell_id", "total")).collect()}


CORNERS = [(0, 0), (200, 0), (0, 200), (200, 200)]


def test_nnls_recovers_known_intensities(spark):
    buildings, k = [], 0
    for (x, y), offices, homes in zip(CORNERS, (1, 1, 0, 2), (0, 1, 3, 1), strict=True):
        for n in range(offices + homes):
            buildings.append(square(k, "office" if n < offices else "residential", x + 5 + 20 * n, y + 5))
            k += 1
    got = fit(spark, buildings, [cell(i, x, y, t) for i, ((x, y), t) in enumerate(zip(CORNERS, (5, 6, 3, 11), strict=True))])
    assert got["office"].intensity == pytest.approx(0.05) and got["residential"].intensity == pytest.approx(0.01)
    assert got["office"].contribution == pytest.approx(20) and got["residential"].contribution == pytest.approx(5)
    assert got["office"].n_observations == 3


def test_nnls_is_never_negative(spark):
    got = fit(spark, [square(0, "office", 5, 5), square(1, "shed", 30, 5), square(2, "office", 205, 5)], [cell(0, 0, 0, 5), cell(1, 200, 0, 6)])
    assert all(r.intensity >= 0 for r in got.values())


def test_nnls_p_value(spark):
    totals = (5, 5.5, 4.8, 5.2, 4.9)
    got = fit(spark, [square(k, "office", 200 * k + 5, 5) for k in range(5)], [cell(k, 200 * k, 0, t) for k, t in enumerate(totals)])
    assert 0 <= got["office"].p_value < 0.01


def test_nnls_warns_of_collinear_tags(spark, caplog):
    buildings = []
    for k, n in enumerate((1, 2, 3)):
        buildings += [square(10 * k + j, "a", 200 * k + 5, 5 + 20 * j) for j in range(n)] + [square(100 + 10 * k + j, "b", 200 * k + 50, 5 + 20 * j) for j in range(n)]
    with caplog.at_level(logging.WARNING):
        fit(spark, buildings, [cell(k, 200 * k, 0, t) for k, t in enumerate((10, 22, 31))])
    assert "collinearity" in caplog.text


@pytest.mark.parametrize("fallback", [None, 200.0])
def test_nnls_fallback(spark, fallback):
    got = fit(spark, [square(0, "office", 5, 5, 20.0), square(1, "office", 310, 5)], [cell(0, 0, 0, 20), cell(1, 200, 0, 5)], fallback)
    assert got["office"].intensity == pytest.approx(0.05 if fallback else 25 / 400)


def test_nnls_unreachable_cell_raises_the_others(spark):
    got = fit(spark, [square(0, "office", 5, 5)], [cell(0, 0, 0, 10), cell(1, 14_000, 0, 5)], 200.0)
    assert got["office"].intensity == pytest.approx(0.15)


def test_merge_categories(spark):
    s = "tag string, intensity double, n_observations long"
    got = {r.tag: r for r in D.merge_categories({"p": spark.createDataFrame([("office", 0.5, 3), ("shop", 0.3, 2)], s), "q": spark.createDataFrame([("farm", 0.7, 4)], s)}).collect()}
    assert got["office"].intensity_p == 0.5 and got["office"].intensity_q is None and got["farm"].n_observations == 4


def test_merge_values_fills_with_zero(spark):
    s = "k long, value double"
    got = sorted(D.merge_values({"p": spark.createDataFrame([(0, 10.0), (1, 20.0)], s), "q": spark.createDataFrame([(1, 5.0), (2, 15.0)], s)}, "k").collect())
    assert [tuple(r) for r in got] == [(0, 10.0, 0.0), (1, 20.0, 5.0), (2, 0.0, 15.0)]


def test_apply_intensities_and_precision(spark):
    b = spark.createDataFrame([(1, "office", 100.0), (2, "shop", 200.0), (3, "unknown", 50.0), (4, "null", 10.0)], "building_id long, tag string, area double")
    i = spark.createDataFrame([("office", 0.5), ("shop", 0.2), ("null", None)], "tag string, intensity double")
    assert {r.building_id: r.value for r in D.apply_intensities(b, i).collect()} == {1: 50.0, 2: 40.0, 4: 0.0}
    i = spark.createDataFrame([("office", 0.00004), ("shop", 0.00007 / 2), ("unknown", 0.24698)], "tag string, intensity double")
    assert {r.building_id: r.value for r in D.apply_intensities(b, i).collect()} == {1: 0.0, 2: 0.01, 3: 12.35}
    assert next(r.value for r in D.apply_intensities(b, i, None).collect() if r.building_id == 2) == pytest.approx(0.007)


def test_proportional_split(spark):
    subs = spark.createDataFrame([(100001, 1, 0.7), (100002, 1, 0.3), (200001, 2, 0.2), (200002, 2, 0.8), (300000, None, 1.0)], "k long, p long, v double")
    parents = spark.createDataFrame([(1, 100.0), (2, 50.0)], "p long, total double")
    got = {r.k: r.split for r in D.split_in_proportion(subs, "k", parents, "p", "v").collect()}
    assert got == pytest.approx({100001: 70.0, 100002: 30.0, 200001: 10.0, 200002: 40.0, 300000: 0.0})


def test_coverage(spark):
    b = spark.createDataFrame([square(0, "office", 5, 5), square(1, "office", 900, 900), square(2, "office", 1200, 900)], BUILDING)
    i = spark.createDataFrame([("office", 1.0)], "tag string, intensity double")
    assert [tuple(r) for r in D.allocate(b, spark.createDataFrame([cell(0, 0, 0, 50)], CELL), i, 10.0).collect()] == [(0, 50.0)]
    outside = spark.createDataFrame([square(7, "office", 150, 45)], BUILDING)
    assert [tuple(r) for r in D.allocate(outside, spark.createDataFrame([cell(0, 0, 0, 30)], CELL), i, 200.0).collect()] == [(7, 30.0)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(0, 300), st.integers(1, 40)), min_size=1, max_size=8))
def test_allocation_keeps_the_totals(spark, boxes):
    b = spark.createDataFrame([square(k, "t", x, y, float(s)) for k, (x, y, s) in enumerate(boxes)], BUILDING)
    c = spark.createDataFrame([cell(10 * i + j, 100 * i, 100 * j, 7 + i + j) for i in range(4) for j in range(4)], CELL)
    i = spark.createDataFrame([("t", 2.0)], "tag string, intensity double")
    hit = {10 * (q // 100) + (r // 100) for x, y, s in boxes for q in (x, min(399, x + s - 1)) for r in (y, min(399, y + s - 1))}
    want = sum(7 + h // 10 + h % 10 for h in hit)
    assert sum(r.value for r in D.allocate(b, c, i).collect()) == pytest.approx(want)
