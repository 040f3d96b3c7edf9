import json

import pytest
from pyspark.sql import functions as F

from rangemap.functions import scalars as S
from rangemap.operators import grid, occurrence, raster
from rangemap.sources import geojson, tables


@pytest.fixture()
def collection(tmp_path):
    features = [
        {"type": "Feature", "properties": {"unique_id": "a", "latin_name": "Myotis brandtii", "accuracy": 10}, "geometry": {"type": "Point", "coordinates": [430000.5, 433000]}},
        {"type": "Feature", "properties": {"unique_id": "b", "latin_name": None, "accuracy": 500}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"unique_id": "c", "accuracy": None}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
        {"type": "Feature", "properties": {"name": "square"}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [100, 0], [100, 100], [0, 100], [0, 0]]]}},
        {"type": "Feature", "properties": {"name": "two"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}},
        {"type": "Feature", "properties": {"name": "line"}, "geometry": {"type": "LineString", "coordinates": [[0, 0], [5, 5]]}},
        {"type": "Feature", "properties": {"name": "lines"}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [5, 5]], [[1, 1], [2, 2]]]}},
    ]
    path = tmp_path / "x.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    return str(path)


def plain(path):
    """(unique_id, accuracy, geometry type, coordinates) of all features by the json module."""
    kept = []
    for f in json.loads(open(path).read())["features"]:
        p, g = f["properties"], f["geometry"]
        kept.append((p.get("unique_id"), p.get("accuracy"), g["type"], json.dumps(g["coordinates"])))
    return sorted(kept, key=str)


def split_rows(spark, path):
    rows = geojson.read_features(spark, path, {"unique_id": "string", "accuracy": "double"})
    return sorted(((r[0], r[1], r[2], json.dumps(json.loads(r[3]))) for r in rows.collect()), key=str), rows.rdd.getNumPartitions()


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_one_collection_is_read_by_several_tasks(spark, tmp_path, style):
    made = []
    for i in range(400):
        # Texts with what a border looks like, escaped as JSON has it, and brackets.
        name = f'{{"type": "Feature", "n": {i}}}, ]}} \\" \u00e4' if i % 3 == 0 else f"id {i}" * (i % 40)
        at = [[[i, 0.5], [i + 1, 0], [i, 1], [i, 0.5]]] if i % 2 else [i, -i / 2]
        made.append({"type": "Feature", "id": i, "properties": {"unique_id": name, "accuracy": i / 4 if i % 5 else None}, "geometry": {"type": "Polygon" if i % 2 else "Point", "coordinates": at}})
    path = tmp_path / "many.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:27700"}}, "features": made, "bbox": [0, 0, 1, 1]}, **style))
    settings = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = {k: spark.conf.get(k) for k in settings}
    try:
        for size in (1 << 30, 3001, 997):
            for k in settings:
                spark.conf.set(k, size)
            rows, tasks = split_rows(spark, str(path))
            assert rows == plain(path)
            assert tasks == 1 if size > 1 << 20 else tasks > 10
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_collections_of_other_forms(spark, tmp_path):
    feature = lambda i: {"type": "Feature", "properties": {"unique_id": str(i)}, "geometry": {"type": "Point", "coordinates": [i, i]}}
    turned = lambda i: dict(reversed(feature(i).items()))
    whole = lambda fs: {"type": "FeatureCollection", "features": fs}
    cases = {
        "turned": json.dumps(whole([turned(i) for i in range(3)])),  # the type comes last: read whole
        "mixed": json.dumps(whole([feature(0), turned(1), feature(2), turned(3), turned(4)])),  # several in a piece
        "spaced": json.dumps(whole([feature(0)]))[:-2] + ', {"type" :  "Feature", "properties": null, "geometry": {"type": "Point", "coordinates": [1, 1]}}]}',
        "empty": json.dumps(whole([])),
        "nested": json.dumps(whole([feature(0), feature(1)])) + "\n",
    }
    for name, text in cases.items():
        path = tmp_path / f"{name}.geojson"
        path.write_text(text)
        rows = geojson.read_features(spark, str(path), {"unique_id": "string"})
        want = [tuple(f["geometry"]["coordinates"]) for f in json.loads(text)["features"]]
        assert sorted(tuple(json.loads(r["coordinates"])) for r in rows.collect()) == sorted(want), name
    # Two files of a folder, the second spaced in another way, are both read.
    folder = tmp_path / "both"
    folder.mkdir()
    (folder / "a.geojson").write_text(json.dumps(whole([feature(i) for i in range(5)])))
    (folder / "b.geojson").write_text(json.dumps(whole([feature(i) for i in range(2)]), separators=(",", ":")))
    assert geojson.read_features(spark, str(folder), {"unique_id": "string"}).count() == 7


def test_a_broken_collection_is_an_error(spark, tmp_path):
    path = tmp_path / "cut.geojson"
    path.write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"unique_id": "a"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"type": "Feature", "prop')
    with pytest.raises(Exception, match="not a feature collection|Malformed"):
        geojson.read_features(spark, str(path), {"unique_id": "string"}).collect()
    with pytest.raises(Exception, match="(?i)not exist|PATH_NOT_FOUND"):
        geojson.read_features(spark, str(tmp_path / "none.geojson"), {"unique_id": "string"})


def test_points(spark, collection):
    out = geojson.read_points(spark, collection).collect()
    assert [(r["unique_id"], r["x"], r["y"]) for r in out] == [("a", 430000.5, 433000.0)]


def test_shapes_and_grid(spark, collection):
    out = geojson.read_shapes(spark, collection, {"name": "string"}, "name")
    assert {(r["name"], r["part"], len(r["rings"])) for r in out.collect()} == {("square", 0, 1), ("two", 0, 1), ("two", 1, 1), ("line", 0, 1), ("lines", 0, 1), ("lines", 1, 1)}
    spec = geojson.boundary_grid(out.filter("name = 'square'"), 50, 20)
    assert spec.bounds == (-50, -50, 150, 150)
    text = geojson.features_json(out.filter("name = 'square'"), ["name"]).first()["value"]
    assert json.loads(text)["geometry"]["coordinates"][0][2] == [100, 100]


def test_cells_are_cleaned_merged_and_partitioned(spark, tmp_path):
    c = spark.createDataFrame([(0, 0, 1.0), (0, 1, -9999.0), (300, 1, float("nan")), (300, 2, 1e35)], "row int, col int, v double")
    tables.write_cells(grid.with_tile(c), str(tmp_path / "c"))
    assert sorted(p.name for p in (tmp_path / "c").glob("tile=*")) == ["tile=0_0", "tile=1_0"]
    back = tables.read_cells(spark, str(tmp_path / "c"))
    assert sorted((r["row"], r["col"], r["v"]) for r in back.collect() if r["v"] is not None) == [(0, 0, 1.0)]
    stack = tables.read_stack(spark, {"a": str(tmp_path / "c"), "b": str(tmp_path / "c")})
    assert set(stack.columns) == {"row", "col", "a_v", "b_v"} and stack.count() == 4
    assert tables.grid_points(back.drop("tile")).count() == 1


def test_datasets_tiles_cache_and_climate(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(f"{base}/roads.parquet")
    spark.range(2).withColumn("n", F.lit(1)).write.parquet(f"{base}/water.parquet")
    both = tables.read_datasets(spark, base, ["roads", "absent", "water"])
    assert {r["dataset"]: r["count"] for r in both.groupBy("dataset").count().collect()} == {"roads": 3, "water": 2}
    with pytest.raises(FileNotFoundError):
        tables.read_datasets(spark, base, ["absent"])
    spark.range(4).coalesce(1).write.parquet(f"{base}/tiles/NZ_road_link")
    assert tables.cache_layer(spark.range(5), f"{base}/cache").count() == 5
    assert tables.cache_layer(spark.range(9), f"{base}/cache").count() == 5
    assert tables.cache_layer(spark.range(9), f"{base}/cache", overwrite=True).count() == 9
    spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0)], "row int, col int, v double").write.parquet(f"{base}/bio5.parquet")
    out = tables.read_climate(spark, base, ["bio5", "none"], spark.createDataFrame([(0, 0)], "row int, col int"))
    assert list(out) == ["bio5"] and out["bio5"].count() == 1
    assert tables.read_tiles(spark, f"{base}/tiles", ".parquet", "road").filter("dataset = 'road'").count() == 4


def test_csv_results_models_and_predictions(spark, tmp_path):
    base = str(tmp_path)
    (tmp_path / "x.csv").write_text("id,name\n1,a\n2,b\n")
    tables.csv_to_parquet(spark, f"{base}/x.csv", f"{base}/x.parquet")
    assert spark.read.parquet(f"{base}/x.parquet").count() == 2 and tables.read_summary(spark, f"{base}/x.csv").columns == ["id", "name"]
    tables.write_results(spark.range(1), f"{base}/results")
    tables.write_results(spark.range(1), f"{base}/results")
    assert spark.read.parquet(f"{base}/results").filter("timestamp IS NOT NULL").count() == 2
    tables.write_training(spark.createDataFrame([("a", 1), ("b", 2)], "identifier string, v int"), f"{base}/training")
    assert spark.read.parquet(f"{base}/training").filter("identifier = 'a'").count() == 1
    tables.write_models(spark.range(2), f"{base}/models")
    spark.createDataFrame([("x_Roost", 70), ("x_Roost", -1), ("y", 5)], "identifier string, p int").write.parquet(f"{base}/p")
    assert sorted(str(r["p"]) for r in tables.read_predictions(spark, f"{base}/p", "Roost", True).collect()) == ["0.7", "None"]
    assert tables.read_background(spark, f"{base}/models").columns == ["id", "weight"]
    assert tables.sample_cells(spark.range(10).withColumnRenamed("id", "cell_id"), 4).count() == 4


def test_names(spark):
    assert S.tidy_name("Mean - Temp. (C)/2020__x ") == "mean_temp_c_2020_x"
    df = spark.createDataFrame([("Mean - Temp. (C)/2020__x ", "Myotis daubentonii")], "n string, l string")
    r = df.select(S.tidy(F.col("n")), S.species_code(F.col("l")), S.identifier(F.col("l"), F.lit("Roost"))).first()
    assert tuple(r) == ("mean_temp_c_2020_x", "Myo_dau", "Myotis daubentonii_Roost")
    assert S.climate_name("bio5") == "Bioclimatic variable 5" and S.climate_name("prec") == "Precipitation" and S.climate_name("x") == "x"
    a = spark.createDataFrame([("Roosting",), ("In Flight",), ("other",), (None,)], "a string").select(occurrence.tidy_activity(F.col("a")).alias("a")).collect()
    assert [r["a"] for r in a] == ["Roost", "In flight", "other", None]


def test_filter_on_absent_column_only_warns(spark):
    assert occurrence.filter_records(spark.range(3), genus="Myotis").count() == 3


def test_merge_names(spark):
    spec = grid.GridSpec(0, 2, 1, 2, 2)
    cells = grid.model_grid(spark, spec).select("row", "col", F.lit(1.0).alias("A b"), F.lit(2.0).alias("C"))
    out = raster.merge_on_grid({"Layer X": (cells, spec), "one": (cells.select("row", "col", F.lit(3.0).alias("q")), spec)}, spec, grid.model_grid(spark, spec))
    assert set(out.columns) == {"row", "col", "layer_x_a_b", "layer_x_c", "one"}
