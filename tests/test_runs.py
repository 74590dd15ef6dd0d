import json

import pytest
from pyspark.sql import functions as F

from helioquery.fixtures import fixture
from helioquery.functions import rules, shapes
from helioquery.operators import areas, benchmarks, facets, labels, maps
from helioquery.plans import runs
from helioquery.sources import readers

SF = "/root/testdata/sf0.001"


def test_manifest_survives_and_a_broken_one_is_empty(spark, tmp_path):
    path = f"file://{tmp_path}/run/manifest.json"
    m = runs.Manifest(spark, path)
    m.mark_done(-1, 3, "k", 7)
    m.mark_failed(0, 0, "k", "no data")
    m.save()
    m.save()
    again = runs.Manifest(spark, path)
    assert again.is_current(-1, 3, "k") and not again.is_current(-1, 3, "other") and not again.is_current(0, 0, "k")
    assert again.error_for(0, 0) == "no data" and again.error_for(-1, 3) is None and again.table().count() == 2
    (tmp_path / "bad.json").write_text("{")
    with pytest.warns(UserWarning):
        assert runs.Manifest(spark, f"{tmp_path}/bad.json").entries == {}


def test_sidecars_vouch_for_content(spark, tmp_path):
    path = f"{tmp_path}/a.parquet"
    with pytest.raises(FileNotFoundError):
        runs.write_sidecar(spark, path, "k")
    spark.range(5).write.parquet(path)
    (tmp_path / "a.parquet.key").write_text("k")
    assert runs.read_sidecar(spark, path) is None and not runs.sidecar_matches(spark, path, "k")
    assert runs.adopt_sidecar(spark, path) and not runs.adopt_sidecar(spark, path)
    assert runs.sidecar_matches(spark, path, "k") and not runs.sidecar_matches(spark, path, "other")
    spark.range(6).write.mode("overwrite").parquet(path)
    assert not runs.sidecar_matches(spark, path, "k")


def test_keys_labels_and_guards():
    base = runs.surface_key(1, 2, 2.0, "s")
    assert runs.radiation_key(base, [3, 1], "e") == runs.radiation_key(base, [1, 3], "e") != runs.radiation_key(base, None, "e")
    assert json.loads(runs.scoring_key("r", "s", "multiplane"))["version"] == runs.SCORING_VERSION
    assert runs.run_label() == "12day_" + runs.SCORING_VERSION and runs.run_label([1]).startswith("1day_")
    assert runs.parse_days("calibrated") is None and runs.parse_days("15, 45") == [15, 45]
    assert runs.run_folder("out/", "dc", "x") == "out/dc/x" and runs.positive_int("n", 2) == 2
    for bad in ("", "..", "a/b"):
        with pytest.raises(ValueError):
            runs.check_label(bad)
    for bad in (0, True, 1.0, "1"):
        with pytest.raises(ValueError):
            runs.positive_int("n", bad)


def test_a_bad_tile_does_not_stop_the_city(spark, tmp_path):
    tiles = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "tile_row int, tile_col int")

    def score(part):
        rows = part.withColumn("building_id", F.explode(F.sequence(F.lit(1), F.col("tile_row") * 2)))
        return rows.withColumn("x", F.when((F.col("tile_row") == 1) & (F.col("tile_col") == 1), F.raise_error(F.lit("broken"))).otherwise(1))

    m = runs.Manifest(spark, f"{tmp_path}/m.json")
    rows = tiles.where("tile_row = 1")
    city = runs.run_city(rows.union(spark.createDataFrame([(2, 5)], rows.schema)), lambda p: score(p).where("tile_row < 3"), m, "k", f"{tmp_path}/city")
    assert sorted(map(tuple, city.select("tile_row", "tile_col", "building_id").collect())) == [(1, 0, 1), (1, 0, 2), (2, 5, 1), (2, 5, 2), (2, 5, 3), (2, 5, 4)]
    assert "broken" in m.error_for(1, 1) and m.is_current(1, 0, "k") and not m.is_current(1, 1, "k")
    runs.append_log(m.table(), f"{tmp_path}/log")
    runs.append_log(m.table(), f"{tmp_path}/log")
    assert spark.read.json(f"{tmp_path}/log").count() == 2 * m.table().count()


def test_labels_refuse_what_they_must(spark, tmp_path):
    known = spark.createDataFrame([("1",), ("2",)], "building_id string")
    rows = spark.createDataFrame([("1", "2", "y", None), ("9", "x", "y", " exclude me")], "building_id string, n_major_planes string, has_obstruction string, notes string")
    labels.check_labels(rows, known)
    labels.check_labels(rows.where("building_id = 1").drop("notes"), known)
    with pytest.raises(ValueError, match="unknown"):
        labels.check_labels(rows.withColumn("notes", F.lit(None).cast("string")), known)
    labels.label_template(known, f"{tmp_path}/labels")
    with pytest.raises(Exception, match="exists"):
        labels.label_template(known, f"{tmp_path}/labels")
    with pytest.raises(ValueError, match="3"):
        labels.read_sample(spark.createDataFrame([("3",)], "building_id string"), known)
    with pytest.raises(Exception, match="unfittable"):
        known.select(rules.roof_type(F.lit(0), F.lit("flat"))).collect()
    none = labels.spot_sample(fixture(spark, SF, "buildings").withColumn("roof_class", F.lit("flat")), {"nowhere": F.lit(False)})
    assert none.count() == 0 and none.columns == list(labels.SAMPLE)


def test_readers_and_features(spark, tmp_path):
    b = fixture(spark, SF, "buildings")
    assert readers.buildings(spark, b) is b
    with pytest.raises(NotImplementedError):
        readers.buildings(spark, "x.gpkg")
    with pytest.raises(ValueError):
        readers.surface_items(spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], "minx double, miny double, maxx double, maxy double"), 2.0, 2.0, 3.0, 3.0)
    with pytest.raises(NotImplementedError):
        facets.fit_planes(b, "block")
    assert areas.merge_tiles(empty=b).count() == 0
    ring = shapes.box(*(F.lit(float(v)) for v in (323000, 4298000, 323100, 4298050)))
    rows = spark.range(1).select("id", ring.alias("rings"))
    maps.write_features(maps.polygon_features(rows, ["id"]), f"{tmp_path}/f")
    feature = json.loads((spark.read.text(f"{tmp_path}/f").first())[0])
    (lon, lat), *_ = feature["geometry"]["coordinates"][0]
    assert feature["properties"] == {"id": 0} and abs(lon + 77.0) < 0.1 and lat == round(lat, 6)
    text = benchmarks.markdown(spark.createDataFrame([("a", 1.25, None)], "m string, v double, n int"))
    assert text.splitlines()[0] == "| m | v | n |" and text.splitlines()[2] == "| a | 1.2 |  |"


def test_surface_is_built_in_one_plan(spark):
    layers = spark.createDataFrame([(h, r, c, z) for h, z in (("a", 1.0), ("b", 2.0)) for r in range(6) for c in range(6) if not (h == "a" and c == 3)], "href string, r int, c int, z double")
    items = spark.createDataFrame([("a", 0), ("b", 1)], "href string, ord int")
    lon, lat = rules.transverse_mercator_inverse((F.col("j") + 0.5) * 2 + 320000.0, (F.col("i") + 0.5) * 2 + 4300000.0)
    targets = spark.range(36).select((F.col("id") / 6).cast("int").alias("i"), (F.col("id") % 6).cast("int").alias("j")).select("i", "j", lon.alias("lon"), lat.alias("lat"))
    rings = shapes.box(*(F.lit(float(v)) for v in (320000, 4300000, 320012, 4300006)))
    got = maps.build_surface(items, layers, targets, rings, (320000.0, 4300000.0), 2.0, (320000.0, 4300000.0), 2.0).collect()
    assert len(got) == 18 and {round(r["z"], 3) for r in got if r["c"] == 3} == {2.0} and {round(r["z"], 3) for r in got if r["c"] == 0} == {1.0}


def test_command_line_from_pixels_to_tracts(spark, tmp_path, capsys):
    from helioquery.__main__ import main
    from helioquery.label_queries import hand_labels
    from helioquery.roof_queries import px

    at = lambda name: f"{tmp_path}/{name}"
    px(spark, SF).write.parquet(at("px"))
    fixture(spark, SF, "sun").write.parquet(at("sun"))
    for method in ("multiplane", "ransac"):
        main(["score", at("px"), at("sun"), at("out"), "--method", method, "--label", method], spark)
    done = spark.read.parquet(at("out/city/multiplane/buildings.parquet"))
    assert done.count() == spark.read.parquet(at("out/city/ransac/buildings.parquet")).count() == 150
    assert "| no_plane_fit |" in capsys.readouterr().out
    placed = done.join(px(spark, SF).groupBy("building_id").agg(F.min("x").alias("x"), F.min("y").alias("y")), "building_id").withColumn("rings", shapes.box(F.col("x"), F.col("y"), F.col("x") + 18, F.col("y") + 16))
    placed.write.parquet(at("roofs.parquet"))
    half = lambda name, a, b: spark.range(1).select(F.lit(name).alias("GEOID"), F.lit(a).alias("minx"), F.lit(0.0).alias("miny"), F.lit(b).alias("maxx"), F.lit(9000.0).alias("maxy"))
    half("1", 0.0, 2000.0).union(half("2", 2000.5, 9000.0)).write.parquet(at("tracts"))
    spark.createDataFrame([("1", 10.0, 30.0), ("2", 0.0, 5.0)], "GEOID string, households double, population double").write.parquet(at("people"))
    spark.createDataFrame([("1", 0.1)], "GEOID string, energy_burden double").write.parquet(at("burden"))
    main(["aggregate", at("roofs.parquet"), at("tracts"), at("people"), at("burden"), at("agg")], spark)
    got = {r["GEOID"]: r for r in spark.read.parquet(at("agg")).collect()}
    assert got["1"]["equity_class"] == "high_potential_high_burden" and got["2"]["equity_class"] == "unknown" and got["1"]["n_buildings"] + got["2"]["n_buildings"] == 150
    main(["publish", at("roofs.parquet"), at("web")], spark)
    assert spark.read.text(at("web")).count() == 150
    rows = facets.stacked(px(spark, SF), fixture(spark, SF, "sun"), (0.0, 0.0), 2.0)
    for name in ("planes", "obstructions", "buildings"):
        (rows.where("plane_id = 0") if name == "buildings" else rows).write.parquet(at(f"score/{name}.parquet"))
    hand_labels(spark, SF).coalesce(1).write.csv(at("labels"), header=True)
    main(["compare", at("labels"), at("score"), at("cmp")], spark)
    assert spark.read.csv(at("cmp"), header=True).groupBy("method").count().count() == 2 and "| multiplane |" in capsys.readouterr().out
