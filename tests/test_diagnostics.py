import math

import numpy as np
import pytest

from framewell.functions.quantiles import exact_quantile, exact_quantiles
from framewell.geometry import Geometry
from framewell.operators import diagnostics as dg
from tests.fixtures import map_frame

GRID = Geometry(height=20, width=16, n_asics=4)


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    v = rng.gamma(2.0, 5.0, (20, 16))
    v[0, 0], v[0, 1], v[1, 0] = np.nan, np.inf, 0.0
    return v


def column(df, name, order="bin"):
    return [r[name] for r in df.orderBy(order).collect()]


def assert_histogram(df, numbers, bins, span):
    counts, edges = np.histogram(numbers, bins=bins, range=span)
    assert column(df, "n") == counts.tolist()
    np.testing.assert_allclose(column(df, "lower") + [column(df, "upper")[-1]], edges)


def test_summary_uses_finite_values(spark, values):
    row = dg.summary(map_frame(spark, v=values), "v").first()
    good = values[np.isfinite(values)]
    np.testing.assert_allclose(
        [row["n"], row["mean"], row["std"], row["median"]], [good.size, good.mean(), good.std(), np.median(good)]
    )


def test_full_histogram(spark, values):
    good = values[np.isfinite(values)]
    assert_histogram(dg.full_histogram(map_frame(spark, v=values), "v"), good, 100, (good.min(), good.max()))


def test_histogram_of_equal_values_has_a_range(spark):
    found = dg.full_histogram(map_frame(spark, v=np.full((2, 2), 3.0)), "v", bins=4)
    assert_histogram(found, np.full(4, 3.0), 4, (3.0, 3.0))


def test_percentile_histogram_drops_the_tails(spark, values):
    clean = np.nan_to_num(values, nan=1.0, posinf=2.0)
    masked = Geometry(20, 16, 4, masked=(2,))
    found = dg.percentile_histogram(map_frame(spark, v=clean), "v", where=masked.is_active("x"))
    inside = np.delete(clean, range(8, 12), axis=1).ravel()
    assert_histogram(found, inside, 200, tuple(np.percentile(inside, (0.5, 99.5))))


def test_noise_histogram(spark, values):
    clean = np.nan_to_num(values, nan=1.0, posinf=2.0)
    found = dg.noise_histogram(map_frame(spark, noise=clean), GRID)
    assert_histogram(found, clean.ravel(), 200, (0, np.percentile(clean, 99.5)))
    usable = values[np.isfinite(values) & (values > 0)]
    found = dg.noise_histogram(map_frame(spark, noise=values), GRID, usable_only=True)
    assert_histogram(found, usable, 200, (0, np.percentile(usable, 99.5)))


def test_adjusted_edges(spark, values):
    good = values[np.isfinite(values)]
    table = map_frame(spark, adu_sum=np.zeros((20, 16)), adu_seed=values)
    want = np.linspace(*np.percentile(good, (0.5, 99.5)), 11)
    np.testing.assert_allclose(column(dg.adjusted_edges(table, range(11)), "edge", "i"), want)
    nothing = map_frame(spark, v=np.full((2, 2), np.nan))
    assert column(dg.adjusted_edges(nothing, [1.0, 4.0], "v"), "edge", "i") == [1.0, 4.0]
    text = spark.createDataFrame([("a",)], "name string")
    assert column(dg.adjusted_edges(text, [1.0, 4.0]), "edge", "i") == [1.0, 4.0]


def test_map_limits_and_nan_policy(spark, values):
    pooled = dg.pool((map_frame(spark, v=values), "v"), (map_frame(spark, v=values), "v"))
    row = dg.map_limits(pooled, (0.01, 0.5), nan_result=False).first()
    want = np.nanpercentile(np.concatenate([values.ravel()] * 2), (1, 50))
    np.testing.assert_allclose([row["p1"], row["p50"]], want)
    assert math.isnan(dg.map_limits(pooled, (0.01,)).first()["p1"])


def test_maps_and_profiles(spark):
    masked = Geometry(2, 4, 2, masked=(1,))
    maps = map_frame(
        spark,
        offset_median=np.full((2, 4), 5.0),
        offset_sigclip=np.full((2, 4), 3.0),
        noise=np.full((2, 4), 2.0),
        n_clipped=np.zeros((2, 4)),
        is_bad=np.eye(2, 4, dtype=bool),
    )
    diff = {(r["y"], r["x"]): r["diff"] for r in dg.offset_difference(maps, masked).collect()}
    assert diff[0, 0] == 2.0 and math.isnan(diff[0, 3])
    hidden = {(r["y"], r["x"]): r["noise"] for r in dg.noise_without_bad(maps).collect()}
    assert math.isnan(hidden[0, 0]) and hidden[0, 1] == 2.0
    assert dg.mask_size(maps).first()[0] == 2
    clip = dg.clip_map_summary(maps).first()
    assert (clip["avg_clipped"], clip["scale_max"]) == (0.0, 1)


def test_cm_frame_average_and_limits(spark):
    rng = np.random.default_rng(5)
    rows = [(0, f, y, f"C{a}", float(np.float32(rng.normal(0, 9)))) for f in range(30) for y in range(6) for a in range(3)]
    rows[0] = (0, 0, 0, "C0", math.nan)
    cm = spark.createDataFrame(rows, "file_id int, frame_id bigint, y int, asic string, cm float")
    averages = {(r["frame_id"], r["asic"]): r["avg_cm"] for r in dg.cm_frame_average(cm).collect()}
    assert math.isnan(averages[0, "C0"])
    assert averages[1, "C2"] == pytest.approx(np.mean([r[4] for r in rows if r[1] == 1 and r[3] == "C2"]))
    limits = {r["asic"]: r["limit"] for r in dg.cm_limits(cm).collect()}
    assert math.isnan(limits["C0"])
    assert limits["C1"] == pytest.approx(np.percentile([abs(r[4]) for r in rows if r[3] == "C1"], 99))
    whole = dg.cm_limits(cm.drop("asic").where("not isnan(cm)")).first()
    assert whole["limit"] == pytest.approx(np.percentile([abs(r[4]) for r in rows[1:]], 99))


@pytest.mark.parametrize("q", [0.0, 0.37, 0.5, 0.99, 1.0])
def test_quantiles_by_counting_equal_sorting(spark, q):
    rng = np.random.default_rng(11)
    groups = {
        "spread": rng.normal(0, 1e6, 3001),
        "copies": np.concatenate([np.full(2000, 7.0), rng.random(1000)]),  # one value holds most rows
        "tiny": np.array([1.0, 1.0 + 2**-50, 2.0]),
        "one": np.array([4.0]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("spread", math.nan), ("copies", None)]
    table = spark.createDataFrame(rows, "g string, v double")
    found = {r["g"]: r["quantile"] for r in exact_quantile(table, "v", q, ["g"], nan_result=False).collect()}
    for g, vs in groups.items():
        assert found[g] == pytest.approx(np.quantile(vs, q), rel=1e-12), g
    several = exact_quantiles(table, "v", [q, 0.5], ["g"], nan_result=False).collect()
    assert {(r["g"], r["i"]) for r in several} == {(g, i) for g in groups for i in (0, 1)}
    for r in several:
        assert r["quantile"] == pytest.approx(np.quantile(groups[r["g"]], (q, 0.5)[r["i"]]), rel=1e-12), r
    strict = {r["g"]: r["quantile"] for r in exact_quantile(table, "v", q, ["g"]).collect()}
    assert math.isnan(strict["spread"]) and not math.isnan(strict["copies"])


def test_quantile_of_nothing_is_nan(spark):
    table = spark.createDataFrame([("a", None)], "g string, v double")
    assert math.isnan(exact_quantile(table, "v", 0.5, ["g"]).first()["quantile"])
