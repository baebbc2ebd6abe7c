"""Writers, refreshed slices, choice of sources and polygon crosswalks."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from apportion.operators import crosswalk, diagnose, population, resolve, tune
from apportion.sources import geojson, outputs, tables, versions


def lines(spark, path):
    return [r["value"] for r in spark.read.text(path).collect()]


def square(x, y, w):
    return [[{"x": a, "y": b} for a, b in ((x, y), (x, y + w), (x + w, y + w), (x + w, y), (x, y))]]


RINGS = "array<array<struct<x: double, y: double>>>"


def test_overlay_makes_a_crosswalk(spark):
    precincts = spark.createDataFrame([(1, "a county", "001", square(0.0, 0.0, 4.0)), (2, "a county", "002", square(4.0, 0.0, 4.0))], f"id int, county string, code string, rings {RINGS}")
    districts = spark.createDataFrame([("01", square(-10.0, -10.0, 11.0)), ("2", square(1.0, -10.0, 30.0))], f"SLDLST string, rings {RINGS}")
    found = crosswalk.from_overlay(precincts, districts, "state_house", 2.0)
    got = {(r["code"], r["district"]): round(r["share"], 9) for r in found.splits.collect()}
    assert set(got) == {("1", "1"), ("1", "2"), ("2", "2")} and got[("2", "2")] == 1.0
    # District 1 covers [0, 1] x [0, 1] of precinct 1, district 2 the 12 square units right of x = 1.
    assert got[("1", "1")] == round(1 / 13, 9) and got[("1", "2")] == round(12 / 13, 9)
    with pytest.raises(ValueError):
        crosswalk.pick_column(precincts)


def test_block_weights_of_any_vintage(spark):
    rows = spark.createDataFrame([("b", "5", "2"), ("c", "0", None)], "GEOID10 string, ALAND10 string, AWATER10 string")
    assert sorted(tuple(r) for r in crosswalk.block_weights(rows).collect()) == [("b", 7.0), ("c", 1.0)]
    with pytest.raises(ValueError):
        crosswalk.block_weights(rows.drop("ALAND10"))


def test_choice_of_sources(spark, tmp_path):
    areas = spark.createDataFrame([("congressional", "X", "1", "1", 1.0)], "scope string, county string, code string, district string, weight double")
    names = spark.createDataFrame([("001", "X")], "countyfp string, county string")
    with zipfile.ZipFile(tmp_path / "good.zip", "w") as z:
        z.writestr("VTD.txt", "BLOCKID|COUNTYFP|DISTRICT\n1|001|7\n")
        z.writestr("CD.txt", "BLOCKID|DISTRICT\n1|3\n")
    with zipfile.ZipFile(tmp_path / "narrow.zip", "w") as z:
        z.writestr("VTD.txt", "BLOCKID|COUNTYFP|DISTRICT\n1|001|7\n")
        z.writestr("CD.txt", "BLOCKID|OTHER\n1|3\n")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w") as z:
        z.writestr("VTD.txt", "BLOCKID|COUNTYFP|DISTRICT\n")
        z.writestr("CD.txt", "BLOCKID|DISTRICT\n")
    with zipfile.ZipFile(tmp_path / "memberless.zip", "w") as z:
        z.writestr("VTD.txt", "BLOCKID|COUNTYFP|DISTRICT\n1|001|7\n")
    (tmp_path / "broken.zip").write_bytes(b"no archive")

    def blocks(name, columns=("BLOCKID", "DISTRICT")):
        path = str(tmp_path / name)
        weights = spark.createDataFrame([("1", 2.0)], "BLOCKID string, weight double")
        return crosswalk.from_blocks(tables.zipped_text(spark, path, "VTD.txt", ("BLOCKID", "COUNTYFP", "DISTRICT")), tables.zipped_text(spark, path, "CD.txt", columns), weights, names, "congressional")

    def overlay():
        return crosswalk.from_areas(areas)

    assert [r["district"] for r in crosswalk.chosen("auto", overlay, lambda: blocks("good.zip")).splits.collect()] == ["3"]
    for name in ("gone.zip", "narrow.zip", "memberless.zip", "empty.zip", "broken.zip"):
        with pytest.warns(UserWarning):
            assert [r["district"] for r in crosswalk.chosen("auto", overlay, lambda name=name: blocks(name)).splits.collect()] == ["1"]
        with pytest.raises((FileNotFoundError, ValueError, KeyError)):
            crosswalk.chosen("blockassign", overlay, lambda name=name: blocks(name))
    with pytest.warns(UserWarning):  # a column that the planner misses
        crosswalk.chosen("auto", overlay, lambda: crosswalk.from_areas(areas.drop("code")))
    with pytest.raises(ZeroDivisionError):
        crosswalk.chosen("auto", overlay, lambda: 1 / 0)
    with pytest.raises(ValueError):
        crosswalk.chosen("other", overlay, overlay)
    (tmp_path / "here.csv").write_text("a")
    outputs.require(spark, str(tmp_path / "here.csv"))
    with pytest.raises(FileNotFoundError):
        outputs.require(spark, str(tmp_path / "here.csv"), str(tmp_path / "gone.csv"))


def test_csv_is_in_one_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1.0), ("a", None), ("a", 3.0)], "k string, e double").repartition(3)
    outputs.write_csv(rows, str(tmp_path / "out"), (F.coalesce("e", F.lit(0.0)), True), F.col("k"))
    parts = sorted(p for p in (tmp_path / "out").glob("part-*"))
    assert [line for p in parts for line in p.read_text().splitlines() if line != "k,e"] == ["a,3.0", "b,1.0", "a,"]


def test_canonical_rows_are_counted_and_sorted(spark, tmp_path):
    rows = spark.createDataFrame([(*(str(9 - i) for _ in range(6)), str(i), 2000 + i % 2) for i in range(8)], ", ".join(f"{c} string" for c in tables.CANONICAL) + ", year int")
    assert tables.write_canonical(rows, str(tmp_path / "out")) == 8
    got = [line.split(",")[0] for p in sorted((tmp_path / "out" / "year=2001").glob("part-*")) for line in p.read_text().splitlines()[1:]]
    assert got == ["2", "4", "6", "8"]


def test_reports_and_summary(spark, tmp_path):
    columns = "scope string, contest_type string, year int, district string, raw_abs_error_pct double, needs_calibration string, status string"
    rows = spark.createDataFrame([("state_house", "president", 2020, "1", 0.5, "no", "ok"), ("congressional", "president", 2020, "1", 2.0, "yes", "ok"), ("congressional", "president", 2020, "2", None, "yes", "missing_output")], columns)
    outputs.write_margin_report(rows, str(tmp_path))
    read = spark.read.option("header", True).csv(str(tmp_path / "district_margin_target_report"))
    assert read.columns == rows.columns and read.count() == 3
    assert spark.read.option("header", True).csv(str(tmp_path / "district_margin_target_outliers")).count() == 2
    outputs.write_summary(spark, str(tmp_path / "summary"), rows=3, elapsed_seconds=0.1)
    assert [json.loads(x) for x in lines(spark, str(tmp_path / "summary"))] == [{"elapsed_seconds": 0.1, "rows": 3}]


def test_features_both_ways(spark, tmp_path):
    """Rings to features and back: lines, collections of many parts and of one, one-line and indented files of others."""
    donut, pair = [square(0.0, 0.0, 9.0)[0], square(3.0, 3.0, 3.0)[0][::-1]], [square(0.0, 0.0, 1.0)[0], square(5.0, 5.0, 2.0)[0]]
    layer = [(k, f"name {k}", [square(float(k), 0.0, 1.0), donut, pair, []][k % 4]) for k in range(40)]
    rows = spark.createDataFrame(layer, f"id int, name string, rings {RINGS}").repartition(7).withColumn("g", geojson.polygon(F.col("rings")))
    made = geojson.features(rows, "g", "id", "name", keep=("id",))
    geojson.write_features(made, str(tmp_path / "lines"))
    geojson.write_collection(made, str(tmp_path / "parts"), "id")
    geojson.write_collection(made, str(tmp_path / "one"), "id", one_file=True)
    text = ["".join(p.read_text() for p in sorted((tmp_path / k).glob("part-*"))) for k in ("parts", "one")]
    assert text[0] == text[1] and len(list((tmp_path / "one").glob("part-*"))) == 1
    whole = json.loads(text[0])
    assert whole["type"] == "FeatureCollection" and [f["properties"]["id"] for f in whole["features"]] == list(range(40))
    assert [f["geometry"] and (f["geometry"]["type"], len(f["geometry"]["coordinates"])) for f in whole["features"][:4]] == [("Polygon", 1), ("Polygon", 2), ("MultiPolygon", 2), None]
    assert whole["features"][0]["geometry"]["coordinates"][0][1] == [0.0, 1.0]
    (tmp_path / "flat.geojson").write_text("\ufeff" + json.dumps(whole))
    (tmp_path / "tall.geojson").write_text(json.dumps(whole, indent=2))
    want = sorted((str(k), f"name {k}", [[(p["x"], p["y"]) for p in r] for r in rings]) for k, _, rings in layer)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (split, "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        for path in ("lines", "parts", "one", "flat.geojson", "tall.geojson"):
            got = geojson.read(spark, str(tmp_path / path)).select("properties", geojson.rings(F.col("geometry")).alias("rings"))
            assert sorted((r["properties"]["id"], r["properties"]["name"], [[(p["x"], p["y"]) for p in x] for x in r["rings"]]) for r in got.collect()) == want, (path, size)
        if size == "1k":
            assert geojson.read(spark, str(tmp_path / "flat.geojson")).rdd.getNumPartitions() > 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_labels_of_contests_are_read_once(spark, tmp_path, monkeypatch):
    def read(office, year):
        with open(tmp_path / "seen", "a") as f:
            f.write("x")
        return "district", "state_house", office[-1]

    monkeypatch.setattr(crosswalk, "office_class", lambda *c: F.udf(read, "kind string, contest_type string, district string")(*c))
    rows = [("A COUNTY", "001 - X", f"House {1 + k % 2}", 2023, k % 2 + 1.0) for k in range(400)] + [("A COUNTY", "001 - X", "House 2", 2023, -7.0)]
    found = crosswalk.from_contests(spark.createDataFrame(rows, "county string, precinct string, office string, year int, votes double"))
    assert sorted((r["code"], r["district"], r["share"]) for r in found.splits.collect()) == [("1", "1", 1 / 3), ("1", "2", 2 / 3)]
    assert (tmp_path / "seen").stat().st_size < 40


def test_parts_of_a_collection_are_read(spark, tmp_path):
    rows = spark.range(200).withColumn("g", geojson.point(F.col("id") * 1.0, F.lit(2.0)))
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a large layer has many parts, and but one begins the collection
    geojson.write_collection(geojson.features(rows, "g", "id", keep=("id",)), str(tmp_path / "parts"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert sum(p.stat().st_size > 0 for p in (tmp_path / "parts").glob("part-*")) > 2
    assert sorted(int(r["properties"]["id"]) for r in geojson.read(spark, str(tmp_path / "parts")).collect()) == list(range(200))
    for k, text in enumerate(('{"type":"FeatureCollection","features":[', '{"type":"Feature","properties":{},"geometry":null}', "]}")):
        (tmp_path / f"{k}.txt").write_text(text)
    assert geojson.read(spark, [str(tmp_path / f"{k}.txt") for k in range(3)]).count() == 1
    (tmp_path / "cut.txt").write_text(',{"type":"Feature","properties":{"a":')
    with pytest.raises(Exception, match="GeoJSON"):
        geojson.read(spark, str(tmp_path / "cut.txt")).collect()


def test_what_is_no_geojson_is_an_error(spark, tmp_path):
    (tmp_path / "late.json").write_text('{"features":[{"properties":{"a":"1"},"geometry":null,"type":"Feature"},{"properties":{"a":"2"},"geometry":null,"type":"Feature"}],"type":"FeatureCollection"}')
    assert [r["properties"]["a"] for r in geojson.read(spark, str(tmp_path / "late.json"), whole=True).collect()] == ["1", "2"]
    (tmp_path / "none.json").write_text('{"type":"FeatureCollection","features":[]}')
    assert geojson.read(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "rows.json").write_text('[{"a":1}]')
    (tmp_path / "cut.json").write_text('{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"a":')
    for name in ("late.json", "rows.json", "cut.json"):
        with pytest.raises(Exception, match="GeoJSON"):
            geojson.read(spark, str(tmp_path / name)).collect()
    with pytest.raises(Exception, match="collection"):
        geojson.read(spark, str(tmp_path / "rows.json"), whole=True).collect()


def test_points_and_populations(spark, tmp_path):
    rows = spark.createDataFrame([(1, None)], "id int, name string")
    geojson.write_features(geojson.features(rows.withColumn("g", geojson.point(F.lit(1.0), F.lit(2.0))), "g", "id", "name"), str(tmp_path / "p"))
    assert [json.loads(x) for x in lines(spark, str(tmp_path / "p"))] == [{"type": "Feature", "properties": {"id": 1, "name": None}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]
    people = spark.createDataFrame([("B CITY", 2), ("A COUNTY", 1)], "normalized_name string, estimate_2020 long")
    outputs.write_population(people, str(tmp_path / "people"))
    assert [json.loads(x)["estimate_2020"] for x in lines(spark, str(tmp_path / "people" / "json"))] == [1, 2]


def test_slices_with_their_manifest(spark, tmp_path):
    path = str(tmp_path / "slices")
    with pytest.raises(FileNotFoundError):
        tables.read_slices(spark, path)
    payloads = spark.createDataFrame([("congressional", 2020, '{"a":1}'), ("state_house", 2021, '{"b":2}')], "scope string, year int, payload string")
    meta = spark.createDataFrame([("congressional", 2020, 11), ("state_house", 2021, 3)], "scope string, year int, rows int")
    assert tables.write_slices(payloads, path, "scope", "year", meta=meta) == 1
    assert json.loads(versions.latest(spark, path)["note"])["files"][0] == {"rows": 11, "scope": "congressional", "year": 2020}
    # A targeted fix reads the slices that it replaces.
    fixed = tables.read_slices(spark, path).withColumn("payload", F.when(F.col("year") == 2020, F.lit("{}")).otherwise(F.col("payload")))
    assert tables.write_slices(fixed, path, "scope", "year") == 2
    got = sorted((r["scope"], r["year"], r["payload"]) for r in tables.read_slices(spark, path).collect())
    assert got == [("congressional", 2020, "{}"), ("state_house", 2021, '{"b":2}')]


def test_a_write_that_ends_halfway_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "v")
    rows = spark.createDataFrame([(1, "a")], "k int, x string")
    versions.publish(rows, path, "parquet", "k", note="first")
    bad = rows.withColumn("x", F.raise_error(F.lit("killed")))
    with pytest.raises(Exception, match="killed"):
        versions.publish(bad, path, "parquet", "k")
    # And one that ends after its data, before they are named.
    rows.withColumn("x", F.lit("half")).write.mode("overwrite").parquet(f"{path}/data/version=2")
    (tmp_path / "v" / "current" / "version=2" / "_temporary").mkdir(parents=True)
    assert (versions.latest(spark, path)["note"], [r["x"] for r in versions.current(spark, path).collect()]) == ("first", ["a"])
    assert versions.publish(versions.current(spark, path).withColumn("x", F.upper("x")), path, "parquet", "k", note="second") == 2
    assert versions.publish(rows.limit(0), path, "parquet") == 3
    assert versions.tidy(spark, path, keep=2) == [1] and versions.latest(spark, path)["version"] == 3
    assert versions.current(spark, path, "k int, x string").count() == 0
    assert not (tmp_path / "v" / "data" / "version=1").exists()


def test_refreshed_manifest_is_read(spark, tmp_path):
    (tmp_path / "manifest.json").write_text(json.dumps({"files": [{"scope": "congressional", "contest_type": "president", "year": 2020, "file": "x.json", "rows": 1, "dem_total": 2, "rep_total": 3, "major_party_contested": True}]}))
    assert outputs.read_manifest(spark, str(tmp_path / "manifest.json")).first()["file"] == "x.json"


def test_population_notes_and_completeness(spark):
    cells = spark.createDataFrame([("Annual Estimates of the Resident Population for Counties",), ("x",), ("Release Date: March 2026",)], "c0 string")
    assert population.table_notes(cells) == ("Annual Estimates of the Resident Population for Counties", "March 2026")
    assert population.table_notes(cells.limit(0)) == ("Annual Estimates of the Resident Population", "")
    rows = spark.createDataFrame([("VIRGINIA",), ("A COUNTY",)], "normalized_name string")
    places = spark.createDataFrame([("A COUNTY",)], "normalized_name string")
    assert population.check_complete(rows, places, 1).count() == 2
    for bad, where, n in ((rows.where("normalized_name != 'VIRGINIA'"), places, 1), (rows, places.union(spark.createDataFrame([("B CITY",)], "n string")), 1), (rows, places, 2)):
        with pytest.raises(ValueError):
            population.check_complete(bad, where, n)


def test_suggestions_name_the_targets_that_improve(spark):
    columns = "scope string, contest_type string, year int, district string, target_margin_pct double, county string, bucket string, fixed double, at_total double, at_party double"
    rows = [("congressional", "president", 2020, "1", -40.0, "C", b, f, t, p) for b, f, t, p in (("dem", 50.0, 0.0, 40.0), ("rep", 50.0, 20.0, 0.0))]
    start = {("congressional", None): 0.0001}
    (best,) = tune.suggestions(spark.createDataFrame(rows, columns), start, [("congressional", "C")], [0.25, 1.0])
    (top,) = json.loads(best["top_improved_targets"])
    assert best["suggested_value"] == 1.0 and top["district"] == "1" and top["abs_error_improvement_pct"] == round(best["mae_gain"], 3)


def test_orders_and_leftovers(spark):
    rows = spark.createDataFrame([("c", "K1", None, 5.0), ("c", "K2", "K2", 10.0), ("d", "K3", None, 4.0)], "county string, code string, matched string, votes double").withColumn("g", F.lit(1))
    got = sorted((r["county"], str(r["matched"]), r["votes"]) for r in resolve.redistributed(rows, ["g"]).collect())
    assert got == [("c", "K2", 15.0), ("d", "None", 4.0)]
    assert len(diagnose.report_order()) == 6 and len(diagnose.coverage_order()) == 4


def test_files_are_read_by_their_names(spark, tmp_path):
    wide, long, other = tmp_path / "Virginia_Elections_Database__2020_President_General_Election_including_precincts.csv", tmp_path / "Election Results_2023.csv", tmp_path / "notes.csv"
    wide.write_text("County/City,Ward,Pct,A One,B Two,Total Votes Cast\n,,,Democratic,Republican,\nX County,-,101 - Main,\"1,000\",5,1005\n")
    long.write_text("LocalityName,PrecinctName,OfficeTitle,CandidateName,Party,TOTAL_VOTES,DistrictType,DistrictName,ElectionDate,ElectionType\nY CITY,202 - Oak,Governor,C Three,Democratic,7,,,2023-11-07,General\n")
    other.write_text("nothing\n")
    got = sorted((r["file"], r["county"], r["candidate"], r["votes"]) for r in tables.converted(spark, *map(str, (wide, long, other))).collect())
    assert got == [(long.name, "Y CITY", "C Three", 7), (wide.name, "X COUNTY", "A One", 1000), (wide.name, "X COUNTY", "B Two", 5)]
    with pytest.raises(FileNotFoundError):
        tables.converted(spark, str(other))


def test_points_lie_inside(spark):
    from apportion.operators import geo

    # A U whose middle of bounds lies outside it, and a precinct that brings its own point.
    u = [[{"x": float(x), "y": float(y)} for x, y in ((0, 0), (9, 0), (9, 10), (8, 10), (8, 1), (2, 1), (2, 10), (0, 10))]]
    rows = spark.createDataFrame([(1, u, None, None), (2, u, "3.5", "4.5"), (3, [], None, None)], f"id int, rings {RINGS}, lon string, lat string")
    assert sorted(tuple(r) for r in geo.centroid_layer(rows).collect()) == [(1, 1.0, 5.0), (2, 3.5, 4.5), (3, None, None)]
