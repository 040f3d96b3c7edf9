import math

import pytest
from pyspark.sql import functions as F

from rangemap.operators import focal, grid, landcover, raster, terrain

#: A dome with its peak in the middle.
HILL = [[30 - 2 * (r - 2) ** 2 - 2 * (c - 2) ** 2 for c in range(5)] for r in range(5)]
SPEC5 = grid.GridSpec(0, 5, 1, 5, 5)


def cells(spark, values, name="v"):
    data = [(r, c, None if v is None else float(v)) for r, line in enumerate(values) for c, v in enumerate(line)]
    return spark.createDataFrame(data, f"row int, col int, {name} double")


def table(df, name):
    return {(r["row"], r["col"]): r[name] for r in df.collect()}


@pytest.fixture(scope="module")
def hill(spark):
    return cells(spark, HILL, "dem").cache()


def test_focal_windows_are_strict(hill):
    mean = table(focal.multiscale_mean(hill, [3], 100.0), "dem_150m" if "dem_150m" in focal.multiscale_mean(hill, [3]).columns else "dem_200m")
    assert mean[0, 0] is None and mean[2, 2] == pytest.approx(sum(map(sum, [r[1:4] for r in HILL[1:4]])) / 9)
    rough = table(focal.focal_std(hill, "dem"), "roughness")
    assert rough[0, 0] is None and rough[4, 4] is None and rough[2, 2] > 0


def test_position_is_positive_on_the_peak(hill):
    assert table(focal.position_index(hill, "dem"), "tpi")[2, 2] > 0


def test_slope_is_level_on_the_peak_and_faces_outward(hill):
    out = terrain.slope_aspect(hill, "dem", 1.0)
    slope, aspect = table(out, "slope"), table(out, "aspect")
    assert slope[2, 2] == 0 and aspect[2, 2] is None and all(v >= 0 for v in slope.values())
    assert aspect[1, 2] == pytest.approx(0) and aspect[2, 3] == pytest.approx(90) and aspect[3, 2] == pytest.approx(180) and aspect[2, 1] == pytest.approx(270)


def test_aspect_components_in_range(hill):
    out = terrain.aspect_components(terrain.slope_aspect(hill, "dem", 1.0)).filter("aspect IS NOT NULL").collect()
    assert all(-1 <= r["eastness"] <= 1 and -1 <= r["northness"] <= 1 for r in out)
    east = [r for r in out if (r["row"], r["col"]) == (2, 3)][0]
    assert east["eastness"] == pytest.approx(1)


def test_flow_of_the_hill(hill):
    flow = table(terrain.flow_accumulation(hill, "dem"), "flow")
    assert sum(1 for v in flow.values() if v == 1) >= 1 and flow[2, 2] == 1 and max(flow.values()) > 1
    ends = [k for k, v in terrain.flow_targets(hill, "dem").rdd.map(lambda r: ((r["row"], r["col"]), r["to_row"])).collect() if v is None]
    assert sum(flow[k] for k in ends) == 25  # every cell drains to one end


def test_long_flow_path(spark):
    line = cells(spark, [list(range(70, 0, -1))], "dem")
    flow = table(terrain.flow_accumulation(line, "dem"), "flow")
    assert [flow[0, c] for c in range(70)] == list(range(1, 71))


def test_terrain_bundle_bands(hill):
    out = terrain.terrain_attributes(hill, "dem", 1.0)
    assert set(out.columns) == {"row", "col", "slope", "eastness", "northness", "weighted_eastness", "weighted_northness", "roughness", "tpi", "twi", "planform_curvature"}
    assert out.count() == 25


def test_profile_curvature_and_unknown_kind(hill):
    assert terrain.curvature(hill, "dem", 1.0, "profile").count() == 25
    with pytest.raises(ValueError):
        terrain.curvature(hill, "dem", 1.0, "other")


def test_constant_stays_constant(spark):
    flat = cells(spark, [[3] * 8] * 7)
    for name, out in (("v_150m", focal.multiscale_mean(flat, [3])), ("s", focal.gaussian(flat, 7, 8, "v", 1.5, name="s"))):
        values = [v for v in table(out, name if name in out.columns else out.columns[-1]).values() if v is not None]
        assert values and all(v == pytest.approx(3) for v in values)


def test_gaussian_keeps_the_sum_and_mirrors_small_grids(spark):
    spot = cells(spark, [[0, 0, 0], [0, 9, 0]])
    out = table(focal.gaussian(spot, 2, 3, "v", 2.0), "v")
    assert sum(out.values()) == pytest.approx(9) and len(out) == 6


def test_coarsen_conserves_the_sum_and_trims(spark):
    c = cells(spark, [[i * 7 + j for j in range(7)] for i in range(5)])
    spec = grid.GridSpec(0, 5, 1, 5, 7)
    out = raster.coarsen_sum(c, spec, 2)
    assert out.count() == 6
    assert sum(table(out, "v").values()) == sum(i * 7 + j for i in range(4) for j in range(6))
    assert raster.coarsen_stats(c, 1, "v", "p", 1).columns == ["p_mean_1m", "p_min_1m", "p_max_1m", "p_std_1m"]
    assert raster.coarsen_stats(c, 2, "v", "p", 200).count() == 12


def test_null_rules_of_coarsening(spark):
    c = cells(spark, [[1, None], [None, None]]).unionByName(cells(spark, [[None, None]]).withColumn("row", F.lit(2)))
    spec = grid.GridSpec(0, 4, 1, 4, 2)
    assert table(raster.coarsen_sum(c, spec, 2), "v") == {(0, 0): 1.0, (1, 0): 0.0}
    assert table(raster.coarsen_sum(c, spec, 2, strict=True), "v") == {(0, 0): None, (1, 0): None}


def test_gaps_are_filled_without_extrapolation(spark):
    c = cells(spark, [[None, 1, None, 3], [None, None, None, None], [None, 5, None, None]])
    out = table(raster.interpolate_gaps(c), "v")
    assert out[1, 1] == 3 and out[0, 2] == 2 and out[0, 0] is None and out[2, 3] is None


def test_merge_refuses_equal_bands(spark):
    a = cells(spark, [[1]])
    with pytest.raises(ValueError):
        raster.merge_layers({"a": a, "b": a})
    both = raster.merge_layers({"a": a, "b": cells(spark, [[1, 2]], "w")})
    assert table(both, "v") == {(0, 0): 1.0, (0, 1): None}


def test_binary_layers_keep_nulls(spark):
    c = cells(spark, [[1, 2, 3], [3, 2, 1], [None, 1, 2]])
    assert table(landcover.binary_layers(c, "v", {1: "one"}), "one") == {(0, 0): 1, (0, 1): 0, (0, 2): 0, (1, 0): 0, (1, 1): 0, (1, 2): 1, (2, 0): None, (2, 1): 1, (2, 2): 0}


def test_habitats(spark):
    names = {"Neutral grassland": 1.0, "Calcareous grassland": 2.0, "Bog": 3.0, "Inland rock": 4.0, "Urban": 5.0}
    c = cells(spark, [[0] * 3] * 3).select("row", "col", *(F.lit(v).alias(k) for k, v in names.items()))
    out = landcover.aggregate_layers(c, landcover.HABITATS, ["Inland rock"])
    assert set(out.columns) == {"row", "col", "Grassland", "Wetland", "Urban"}
    assert set(table(out, "Grassland").values()) == {3.0}


def test_resampling(spark):
    spec, half = grid.GridSpec(0, 4, 1, 4, 4), grid.GridSpec(0, 4, 2, 2, 2)
    c = cells(spark, [[float(4 * i + j) for j in range(4)] for i in range(4)])
    for method in ("bilinear", "average"):
        assert table(raster.resample(c, spec, half, grid.model_grid(spark, half), method), "v") == {(0, 0): 2.5, (0, 1): 4.5, (1, 0): 10.5, (1, 1): 12.5}
    near = table(raster.resample(c, spec, spec, grid.model_grid(spark, spec), "nearest"), "v")
    assert near == table(c, "v")
    with pytest.raises(ValueError):
        raster.resample(c, spec, half, grid.model_grid(spark, half), "cubic")


def test_scaling(spark):
    c = cells(spark, [[1, 2, None, 3]])
    assert table(raster.min_max(c, ["v"]), "v") == {(0, 0): 0, (0, 1): 0.5, (0, 2): None, (0, 3): 1}
    assert table(raster.min_max(cells(spark, [[4, 4]]), ["v"]), "v") == {(0, 0): 0.5, (0, 1): 0.5}
    z = table(raster.z_score(c, ["v"]), "v")
    assert z[0, 1] == 0 and z[0, 3] == pytest.approx(1 / math.sqrt(2 / 3))


@pytest.mark.parametrize("classes", [3, 150, 700])
def test_diversity_of_few_and_many_classes(spark, classes):
    import numpy as np

    v = np.random.default_rng(1).integers(0, classes, (30, 30))
    rows = [(r, c, None if (r + c) % 7 == 0 else int(v[r, c])) for r in range(30) for c in range(30)]
    out = focal.diversity(spark.createDataFrame(rows, "row int, col int, k bigint"), "k", 5).collect()
    known = {(r, c): k for r, c, k in rows if k is not None}
    assert len(out) == len(rows)
    for x in out:
        seen = {known[q] for q in ((r, c) for r in range(x["row"] - 2, x["row"] + 3) for c in range(x["col"] - 2, x["col"] + 3)) if q in known}
        assert x["diversity"] == len(seen)


def test_flow_rounds_shrink_and_the_bundle_reads_its_cells_once(spark, monkeypatch, tmp_path):
    # A path of 40 cells beside 400 pits: after the first round only the path's cells and those they reach are left.
    path, pits = [(0, c, 100.0 - c) for c in range(40)], [(10 + 2 * r, 2 * c, 1.0) for r in range(20) for c in range(20)]
    spark.createDataFrame(path + pits, "row int, col int, v double").write.parquet(f"{tmp_path}/cells")
    cells = spark.read.parquet(f"{tmp_path}/cells")
    sizes, plain = [], terrain._session.written

    def counted(df, name):
        out = plain(df, name)
        if name == "flow":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(terrain._session, "written", counted)
    flow = {(r["row"], r["col"]): r["flow"] for r in terrain.flow_accumulation(cells, "v").collect()}
    assert flow == {(0, c): c + 1 for c in range(40)} | {(r, c): 1 for r, c, _ in pits}
    assert sizes[0] == 440 and all(n <= 40 for n in sizes[1:])
    bundle = terrain.terrain_attributes(cells, "v", 100.0)
    assert bundle.count() == 440 and not any(str(tmp_path) in f for f in bundle.inputFiles())
