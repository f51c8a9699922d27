"""Readers, writers and the taxonomy on small files."""

import json

import pytest
from pyspark.errors import AnalysisException

from reviewlens import schemas
from reviewlens.operators import cities, density, expertise, features
from reviewlens.sources import readers, sinks
from reviewlens.sources import taxonomy as tax

TAXONOMY_TEXT = '''Restaurants, Lounges,Bars,American ,"Beer, Wine & Spirits",Nightlife
Shopping,Bakeries,Nightlife,,,
Health,Optometrists,Bakeries,Bars
'''


@pytest.fixture
def taxonomy_file(tmp_path):
    path = tmp_path / "taxonomy.csv"
    path.write_text(TAXONOMY_TEXT)
    return str(path)


def pairs(df, a, b):
    return {(row[a], row[b]) for row in df.collect()}


def test_taxonomy_reads_quoted_and_padded_fields(spark, taxonomy_file):
    rows = tax.read_taxonomy(spark, taxonomy_file)
    last = dict(pairs(tax.last_wins(rows), "sub_category", "category"))
    assert last == {
        "Restaurants": "Restaurants",
        "Lounges": "Restaurants",
        "American": "Restaurants",
        "Beer, Wine & Spirits": "Restaurants",
        "Nightlife": "Shopping",
        "Shopping": "Shopping",
        "Bars": "Health",
        "Bakeries": "Health",
        "Health": "Health",
        "Optometrists": "Health",
    }
    members = pairs(tax.membership(rows), "category", "sub_category")
    assert {c for c, s in members if s == "Nightlife"} == {"Restaurants", "Shopping"}
    arrays = {r["category"]: r["sub_category"] for r in tax.membership_arrays(rows).collect()}
    assert arrays["Health"] == ["Bakeries", "Bars", "Health", "Optometrists"]


def test_taxonomy_literal_split(spark, taxonomy_file):
    rows = tax.read_taxonomy(spark, taxonomy_file, literal_split=True)
    last = dict(pairs(tax.last_wins(rows), "sub_category", "category"))
    assert {" Lounges", "American ", '"Beer', ' Wine & Spirits"', ""} <= set(last)
    assert last[""] == "Shopping"


def test_taxonomy_normalized(spark, taxonomy_file):
    rows = tax.read_taxonomy(spark, taxonomy_file)
    business = spark.createDataFrame([("b1", ["BARS ", "x"])], "business_id string, categories array<string>")
    exact = features.business_category(business, tax.last_wins(rows))
    loose = features.business_category(business, tax.last_wins(rows, True), normalize=True)
    assert exact.count() == 0
    assert pairs(loose, "business_id", "category") == {("b1", "Health")}


def test_json_round_trips(spark, tmp_path):
    business = spark.createDataFrame(
        [("b1", "Café", 4.5, 33.4, -112.0, ["Bars", "Food"], "Phoenix", "AZ"), ("b2", None, None, None, None, None, None, None)],
        schemas.BUSINESS,
    )
    path = str(tmp_path / "business")
    sinks.write_json(business, path)
    assert sorted(readers.read_business(spark, path).collect(), key=str) == sorted(business.collect(), key=str)
    with pytest.raises(AnalysisException):
        sinks.write_json(business, path)
    sinks.write_json(business.limit(1), path, mode="overwrite")
    assert readers.read_business(spark, path).count() == 1
    assert readers.read_table(spark, path).columns  # inferred


def test_user_and_checkin_json(spark, tmp_path):
    user = {"user_id": "u1", "name": "A", "votes": {"funny": 1, "useful": 2, "cool": 3}, "elite": [2012], "yelping_since": "2010-02", "extra": 1}
    (tmp_path / "user.json").write_text(json.dumps(user) + "\n")
    row = readers.read_user(spark, str(tmp_path / "user.json")).first()
    assert (row["votes"]["cool"], row["elite"], row["fans"]) == (3, [2012], None)
    (tmp_path / "checkin.json").write_text('{"business_id":"b1","checkin_info":{"9-5":3,"10-1":4}}\n')
    row = readers.read_checkin(spark, str(tmp_path / "checkin.json")).first()
    assert row["checkin_info"] == {"9-5": 3, "10-1": 4}


def test_text_outputs(spark, tmp_path):
    rows = spark.createDataFrame([("b1", 4.5, "east")], "business_id string, stars double, region string")
    sinks.write_tsv(rows, str(tmp_path / "tsv"))
    assert [r[0] for r in readers.read_lines(spark, str(tmp_path / "tsv")).collect()] == ["b1\t4.5\teast"]
    sinks.write_json_text(rows, str(tmp_path / "text"))
    line = readers.read_lines(spark, str(tmp_path / "text")).first()[0]
    assert json.loads(line) == {"business_id": "b1", "stars": 4.5, "region": "east"}
    sinks.write_lines(rows.select("region"), str(tmp_path / "lines"))
    assert readers.read_lines(spark, str(tmp_path / "lines")).first()[0] == "east"


def test_centers_round_trip_in_single_precision(spark, tmp_path):
    centers = spark.createDataFrame([("u1", 1, 33.4, -112.01)], "user_id string, cluster_id int, latitude double, longitude double")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    sinks.write_centers(density.centers_as_arrays(users, centers), str(tmp_path / "centers"))
    back = readers.read_centers(spark, str(tmp_path / "centers"))
    assert {r["user_id"]: len(r["cluster_centers"]) for r in back.collect()} == {"u1": 1, "u2": 0}
    row = density.centers_as_rows(back).first()
    assert row["longitude"] == pytest.approx(-112.01, abs=1e-4)


def test_predictions_prune_by_category(spark, tmp_path):
    rows = spark.createDataFrame(
        [("u1", 0.2, "Shopping"), ("u2", 0.3, "Beauty and Spa")], "user_id string, prediction double, category string"
    )
    path = str(tmp_path / "predictions")
    sinks.write_predictions(rows, path)
    chosen = readers.read_predictions(spark, path, "Shopping")
    assert [tuple(r) for r in chosen.collect()] == [("u1", 0.2)]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    assert readers.read_predictions(spark, path, "Nothing").count() == 0
    sinks.write_json(rows.where("category = 'Beauty and Spa'").drop("category"), str(tmp_path / "pred_beauty_and_spa.json"))
    assert readers.read_prediction_file(spark, str(tmp_path), "Beauty and Spa").count() == 1


def test_world_cities_first_match(spark, tmp_path):
    (tmp_path / "cities.txt").write_text(
        "us,phoenix,Phoenix,AZ,1500000,33.45,-112.07\n"
        "us,phoenix,Phoenix,az,,1.0,2.0\n"
        "us,-,Nowhere,NV,,3.0,4.0\n"
    )
    rows = readers.read_world_cities(spark, str(tmp_path / "cities.txt"))
    renamed = rows.withColumnsRenamed({"City": "city", "Region": "region", "Latitude": "latitude", "Longitude": "longitude"})
    assert rows.where("City IS NULL").count() == 1
    business = spark.createDataFrame(
        [("b1", "PHOENIX", "Az", 4.0, 33.46, -112.07, ["x", "y"]), ("b2", "Gotham", "NJ", 4.0, 1.0, 1.0, [])],
        "business_id string, city string, state string, stars double, latitude double, longitude double, categories array<string>",
    )
    found = {r["business_id"]: r["city_latitude"] for r in cities.city_lookup(business, renamed).collect()}
    assert found == {"b1": 33.45, "b2": None}
    assert cities.city_no_match(business, renamed).first()["no_match"] == 1
    regions = cities.business_region(business, renamed)
    assert [r["region"] for r in regions.collect()] == ["central"]
    assert cities.region_by_category(regions).count() == 2


def test_features_partitioned_by_category(spark, tmp_path):
    row = ("u1", "A", 3, 4.0, 1, 2, 3, 10.0, 0.2, 4, "Shopping", 2, 3, 20.0, 4.5)
    df = spark.createDataFrame([row], schemas.USER_FEATURES)
    sinks.write_user_features(df, str(tmp_path / "features"))
    assert spark.read.parquet(str(tmp_path / "features")).where("category = 'Shopping'").count() == 1
    vector = expertise.assembled(df).first()["features"]
    assert list(vector.toArray()) == [4.0, 20.0, 4.5, 2.0, 3.0, 10.0, 3.0, 1.0, 2.0, 3.0]
