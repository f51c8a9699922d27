"""Ledgers of bad lines, place order, buckets and states that merge."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlens import schemas
from reviewlens.functions.curve import BITS, z_key
from reviewlens.operators import features, locality, merging
from reviewlens.operators.scale import cut_lineage
from reviewlens.plans import features as feature_plans
from reviewlens.sources import layouts, ledger
from reviewlens.sources.taxonomy import membership
from reviewlens.testbed import catalog
from reviewlens.testbed.tables import AS_OF, CENTER, Tables

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(tuple(row) for row in catalog._rounded(df).collect())


# --- ledger ----------------------------------------------------------------------------------

LINES = [
    '{"user_id": "u1", "business_id": "b1", "stars": 4, "text": "fine"}',
    '{"user_id": "u2", "business_id": "b1", "stars": 5, "text": "cut o',
    "",
    '{"user_id": "u3", "stars": 2}',
    '{"user_id": "u4", "business_id": "b2", "stars": "many", "text": "x"}',
    "no json at all",
    '{"user_id": "u5", "business_id": null, "stars": null, "text": ""}',
]


@pytest.fixture
def taken(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(LINES[:4]) + "\n")
    (tmp_path / "in" / "b.json").write_text("\n".join(LINES[4:]) + "\n")
    return ledger.take_in(spark, str(tmp_path / "in"), str(tmp_path / "out"), schemas.REVIEW)


def test_good_rows_bad_lines_and_counts(taken):
    assert (taken.good_rows, taken.bad_rows) == (3, 3)
    assert taken.good.columns == schemas.REVIEW.names
    assert {r["user_id"]: r["stars"] for r in taken.good.collect()} == {"u1": 4, "u3": 2, "u5": None}
    bad = {(r["file"].rsplit("/", 1)[-1], r["line"]) for r in taken.bad.collect()}
    assert bad == {("a.json", LINES[1]), ("b.json", LINES[4]), ("b.json", LINES[5])}


def test_each_table_reads_its_own_folder(taken):
    assert "isnotnull(is_bad" in plan_of(taken.good) and "PartitionFilters: [isnotnull(is_bad" in plan_of(taken.bad)
    assert all("is_bad=false" in name for name in taken.good.where("stars > 0").select(F.input_file_name()).first())


def test_too_many_bad_lines_fail(taken):
    assert taken.check(0.5) is taken
    with pytest.raises(ValueError, match="3 of 6"):
        taken.check(0.4)


def test_csv_lines_with_other_numbers_of_fields_are_bad(spark, tmp_path):
    (tmp_path / "in.csv").write_text("u1,3.5\nu2\nu3,x\nu4,1.0,more\nu5,\n")
    found = ledger.take_in(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), schemas.PREDICTIONS, "csv")
    assert {r["user_id"]: r["prediction"] for r in found.good.collect()} == {"u1": 3.5, "u5": None}
    assert {r["line"] for r in found.bad.collect()} == {"u2", "u3,x", "u4,1.0,more"}


def test_an_empty_source_gives_empty_tables(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n\n")
    found = ledger.take_in(spark, str(tmp_path / "in.json"), str(tmp_path / "out"), schemas.REVIEW).check()
    assert (found.good_rows, found.bad_rows, found.good.count(), found.bad.count()) == (0, 0, 0, 0)


def test_names_of_the_ledger_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="file"):
        ledger.take_in(spark, str(tmp_path), str(tmp_path / "out"), StructType(schemas.REVIEW.fields[:]).add("file", "string"))


# --- place order -----------------------------------------------------------------------------


def test_z_key_alternates_the_bits_of_both_coordinates(spark):
    spots = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (33.45, -112.07), (-12.3, 45.6), (89.9999, -0.0001), (95.0, 400.0)]
    df = spark.createDataFrame([*spots, (None, 1.0)], "lat double, lon double")
    found = [r[0] for r in df.select(z_key(F.col("lat"), F.col("lon"))).collect()]

    def step(value, low, width):
        return min(max(int((value - low) / width * 2**BITS // 1), 0), 2**BITS - 1)

    def key(lat, lon):
        y, x = step(lat, -90.0, 180.0), step(lon, -180.0, 360.0)
        return sum(((y >> b & 1) << (2 * b + 1)) | ((x >> b & 1) << (2 * b)) for b in range(BITS))

    assert found == [*(key(*spot) for spot in spots), None]


def groups_met(path, box):
    """Row groups, and those whose ranges meet the box."""
    south, north, west, east = box
    groups = met = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            spans = {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}
            lat, lon = spans["latitude"], spans["longitude"]
            groups += 1
            met += lat.min <= north and lat.max >= south and lon.min <= east and lon.max >= west
    return groups, met


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    while leaves.head().getClass().getName().endswith("QueryStageExec"):
        leaves = leaves.head().plan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_a_radius_query_skips_most_files_in_place_order(spark, tmp_path):
    n = 40_000
    spots = spark.range(n).select(
        F.concat(F.lit("b"), "id").alias("business_id"),
        F.concat(F.lit("name "), "id").alias("name"),
        F.lit(3.0).alias("stars"),
        (F.rand(1) * 40 + 20).alias("latitude"),
        (F.rand(2) * 60 - 130).alias("longitude"),
        F.array(F.lit("ECONOMY")).alias("categories"),
    )
    mixed, placed = str(tmp_path / "mixed"), str(tmp_path / "placed")
    spots.repartition(64).write.parquet(mixed)
    layouts.write_in_place_order(spark.read.parquet(mixed), placed, files=64)
    box = (CENTER[0] - 0.3, CENTER[0] + 0.3, CENTER[1] - 0.4, CENTER[1] + 0.4)
    assert groups_met(mixed, box) == (64, 64)
    groups, met = groups_met(placed, box)
    assert groups == 64 and met <= 4
    members = membership(Tables(spark, SF_DIR).taxonomy)

    def near(path):
        return locality.local_businesses(spark.read.parquet(path), members, "Restaurants", CENTER, 20.0)

    assert rows_of(near(mixed)) == rows_of(near(placed)) != []
    box_rows = [
        spark.read.parquet(path).where(F.col("latitude").between(*box[:2]) & F.col("longitude").between(*box[2:])).select("name")
        for path in (mixed, placed)
    ]
    assert rows_scanned(box_rows[0]) == n
    assert rows_scanned(box_rows[1]) <= n * 4 / 64 * 1.2


def test_rows_without_coordinates_are_kept_in_place_order(spark, tmp_path):
    rows = [("a", None, 1.0), ("b", 2.0, None), ("c", 5.0, 5.0), ("c", 5.0, 5.0)]
    df = spark.createDataFrame(rows, "business_id string, latitude double, longitude double")
    layouts.write_in_place_order(df, str(tmp_path / "p"), files=2)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "p")).collect())) == sorted(map(str, df.collect()))


# --- buckets ---------------------------------------------------------------------------------


def test_features_of_buckets_exchange_no_review_and_no_user(spark):
    t = Tables(spark, SF_DIR)
    [(review, user)] = feature_plans.co_located(t.review, t.user, 8)
    found = feature_plans.user_features(t.business, review, user, t.taxonomy, AS_OF, keep_layout=True)
    assert "hashpartitioning(user_id" in plan_of(catalog._features(t))
    assert "hashpartitioning(user_id" not in plan_of(found)
    assert rows_of(found) == rows_of(catalog._features(t))


def test_joins_of_bucketed_tables_need_no_exchange(spark, tmp_path):
    t = Tables(spark, SF_DIR)
    one = layouts.write_bucketed(t.predictions, "b_predictions", str(tmp_path / "p"), buckets=8)
    two = layouts.write_bucketed(catalog._centers(t), "b_centers", str(tmp_path / "c"), buckets=8)
    joined = one.hint("merge").join(two, "user_id")
    assert "Exchange" not in plan_of(joined)
    spark.sql("DROP TABLE b_predictions")
    schema = ", ".join(f"{name} {kind}" for name, kind in t.predictions.dtypes)
    again = layouts.open_bucketed(spark, "b_predictions", str(tmp_path / "p"), schema, buckets=8)
    assert "Exchange" not in plan_of(again.hint("merge").join(two, "user_id"))
    assert rows_of(again) == rows_of(t.predictions)


def test_users_with_many_reviews_stay_out_of_the_buckets(spark):
    t = Tables(spark, SF_DIR)
    parts = feature_plans.co_located(t.review, t.user, 8, large_user=60)
    assert len(parts) == 2
    sizes = parts[1][0].groupBy("user_id").count()
    assert sizes.count() > 0 and sizes.where("count <= 60").count() == 0
    assert sum(user.count() for _, user in parts) == t.user.count()
    found = [feature_plans.user_features(t.business, r, u, t.taxonomy, AS_OF) for r, u in parts]
    assert rows_of(found[0].unionByName(found[1])) == rows_of(catalog._features(t))


# --- states ----------------------------------------------------------------------------------

REVIEWS = [
    ("u1", "b1", 5, "abc"), ("u1", "b1", 3, None), ("u1", "b2", None, "x"), ("u1", "b1", 5, "abc"),
    ("u2", "b3", 1, ""), ("u2", "b9", 2, "no category"), (None, "b1", 4, "nobody"),
]
CATEGORIES = [("b1", "Food"), ("b1", "Food"), ("b1", "Bars"), ("b2", "Food"), ("b3", "Food")]


@pytest.fixture
def small(spark):
    review = spark.createDataFrame(REVIEWS, schemas.REVIEW)
    categories = spark.createDataFrame(CATEGORIES, "business_id string, category string")
    spots = [("b1", 1.0, 1.0), ("b2", None, None), ("b3", 50.0, 5.0), ("b3", 50.0, 5.0), ("b9", 1.0, 1.0)]
    business = spark.createDataFrame(spots, "business_id string, latitude double, longitude double")
    return review, categories, business


def test_merged_parts_equal_the_whole_in_any_order(spark, small):
    review, categories, business = small
    numbers = merging.business_numbers(business)
    whole = sorted(map(str, features.user_category_agg(review, categories).collect()))
    parts = [
        merging.state_of(spark.createDataFrame(REVIEWS[a:b], schemas.REVIEW), categories, numbers)
        for a, b in ((0, 2), (2, 4), (4, 7), (0, 0))
    ]
    one = merging.merged(merging.merged(parts[0], parts[1]), merging.merged(parts[2], parts[3]))
    two = merging.merged(parts[3], parts[2], parts[1], parts[0])
    assert sorted(map(str, merging.user_category_agg(one).collect())) == whole
    assert sorted(map(str, merging.user_category_agg(two).collect())) == whole


def test_known_businesses_keep_their_numbers(spark, small):
    business = small[2]
    known = merging.business_numbers(business.where("business_id <> 'b2'"))
    more = {r[0]: r[1] for r in merging.business_numbers(business, known).collect()}
    before = {r[0]: r[1] for r in known.collect()}
    assert len(more) == 4 and len(set(more.values())) == 4
    assert {b: n for b, n in more.items() if b != "b2"} == before
    assert sorted(before.values()) == [0, 1, 2] and more["b2"] == 3
    none = merging.business_numbers(business, known.limit(0))
    assert none.count() == 4


def test_only_pairs_are_shuffled_for_a_state(spark):
    t = Tables(spark, SF_DIR)
    numbers = merging.business_numbers(t.business)
    plan = plan_of(merging.state_of(t.review, catalog.business_category_exploded(t), numbers))
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert "REPARTITION_BY_COL" in exchanges[0]
    below = plan.split(exchanges[0], 1)[1]
    assert "bitmap_construct_agg" in plan and "bitmap_construct_agg" not in below


def test_states_of_scattered_businesses_stay_small(spark):
    n = 3_000
    business = spark.range(n).selectExpr("id as business_id", "id * 0.01 as latitude", "id * 0.02 as longitude")
    review = spark.range(n).selectExpr("1L as user_id", "id * 7 % 3000 as business_id", "3L as stars", "'x' as text")
    categories = business.selectExpr("business_id", "'Food' as category")
    numbers = merging.business_numbers(business)
    near, far = (merging.state_of(review.where(rows), categories, numbers) for rows in ("true", "business_id % 500 = 0"))
    assert dict(far.dtypes)["businesses"] == "bigint"  # eight bytes a row, however few businesses it has
    assert (near.count(), far.count()) == (-(-n // merging.SPAN), n // 500)
    every = [merging.state_of(review.where(f"business_id % 3 = {i}"), categories, numbers) for i in range(3)]
    [row] = merging.user_category_agg(merging.merged(*every, near)).collect()
    assert (row["cat_business_count"], row["cat_review_count"]) == (n, 2 * n)


def test_a_merged_state_is_shuffled_once(spark, small):
    review, categories, business = small
    state = cut_lineage(merging.state_of(review, categories, merging.business_numbers(business)))
    plan = plan_of(merging.user_category_agg(merging.merged(state, state)))
    assert plan.count("Exchange hashpartitioning") == 1 and "bitmap" not in plan
