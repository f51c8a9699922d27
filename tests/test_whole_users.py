"""Users that fit into a task against the same users by joins of rows, and what is exchanged for them."""

import numpy as np
import pytest

from reviewlens.operators import dense_exemplars, density, exemplars, mixture, scale, visits

PLACES = "user_id bigint, place_id bigint, latitude double, longitude double, visits bigint"


def some_places(spark, users=12, seed=3):
    """Places in a few towns, some on one spot, with one user of no place but null rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for user in range(users):
        n = int(rng.integers(1, 60))
        town = rng.integers(0, 3, n)
        lat, lon = 40 + town * 0.4 + rng.normal(0, 0.05, n), 179.9 + town * 0.1 + rng.normal(0, 0.05, n)
        lon = (lon + 180) % 360 - 180
        rows += [(user, 1000 - i, float(lat[i // 2 * 2]), float(lon[i]), int(rng.integers(1, 4))) for i in range(n)]
    rows += [(None, 1, 40.0, 10.0, 9), (77, 2, None, 10.0, 9)]
    return spark.createDataFrame(rows, PLACES).repartition(5)


def exchanges(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return plan.count("Exchange"), plan.count("Join")


def test_density_of_whole_users_equals_that_by_cells(spark):
    places = some_places(spark)
    whole = density.density_labels(places)
    by_cells = density.density_labels(places, large_user=10)
    assert sorted(whole.collect(), key=str) == sorted(by_cells.collect(), key=str)
    assert {r["cluster_id"] is None for r in whole.collect()} == {True, False}
    assert exchanges(whole) == (1, 0)  # places by user, and no cell or pair besides
    assert density.density_labels(places.limit(0)).count() == 0


def test_density_of_named_places(spark):
    names = "concat('p', lpad(place_id, 5, '0')) as place_id"
    places = some_places(spark).selectExpr("concat('u', user_id) as user_id", names, "latitude", "longitude", "visits")
    whole, by_cells = density.density_labels(places), density.density_labels(places, large_user=10)
    assert sorted(whole.collect(), key=str) == sorted(by_cells.collect(), key=str)


@pytest.mark.parametrize("radius", [0.5, 4.0, 40.0])
def test_neighbours_of_whole_users_equal_those_by_cells(spark, radius):
    places = some_places(spark)
    whole, by_cells = visits.near_counts(places, radius), visits.near_counts(places, radius, large_user=10)
    assert sorted(whole.collect()) == sorted(by_cells.collect())
    assert exchanges(whole) == (1, 0)


@pytest.mark.parametrize("radius", [0.5, 4.0, 40.0])
def test_pairs_of_whole_users_equal_those_by_cells(spark, radius):
    odd = [(5, None, 40.0, 179.9, 1), (5, None, 40.3, 179.9, 1), (5, 970, 40.05, 179.95, 1), (5, 970, 40.01, 179.9, 1)]
    places = some_places(spark).union(spark.createDataFrame(odd, PLACES))
    whole = visits.near_pairs(places, radius)
    assert exchanges(whole) == (1, 0)  # places by user, and no cell or pair besides
    by_cells = visits.near_pairs(places, radius, large_user=10)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(whole) == rows(by_cells)
    assert whole.schema.names == by_cells.schema.names and whole.count()
    named = places.selectExpr("user_id", "concat('p', lpad(place_id, 5, '0')) as place_id", "latitude", "longitude")
    assert visits.near_pairs(named, radius).where("place_a > place_b").isEmpty()
    assert visits.near_pairs(named, radius).count() == whole.count()
    assert visits.near_pairs(places.limit(0), radius).count() == 0


def test_mixtures_of_whole_users_equal_those_in_rounds_of_jobs(spark):
    places = some_places(spark, users=9).where("user_id is null or user_id != 3")
    whole = mixture.mixture_models(places)
    in_rounds = mixture.mixture_models(places, trace=[])
    spread = mixture.mixture_models(places, large_user=10)
    rows = lambda df: sorted(df.drop("settled", "parts").collect())
    expected = rows(in_rounds)
    assert len(expected) % 4 == 0 and len(expected) >= 24
    for found in (rows(whole), rows(spread)):
        assert [r[:2] for r in found] == [r[:2] for r in expected]
        assert np.allclose([r[2:] for r in found], [r[2:] for r in expected], rtol=0, atol=1e-6)
    assert whole.schema == in_rounds.schema
    few = mixture.mixture_models(places, max_rounds=2)
    assert np.allclose([r[2:] for r in rows(few)], [r[2:] for r in rows(mixture.mixture_models(places, max_rounds=2, trace=[]))], atol=1e-6)
    assert not all(r["settled"] for r in few.collect())


def test_mixtures_need_no_rounds_of_jobs(spark, monkeypatch):
    def rounds(*_):
        raise AssertionError("ordinary users took rounds of jobs")

    monkeypatch.setattr(mixture, "_fitted", rounds)
    assert mixture.mixture_models(some_places(spark)).count()
    with pytest.raises(ValueError):
        mixture.mixture_models(some_places(spark).limit(0))


def test_exemplars_of_whole_users_equal_those_by_joins(spark):
    places = some_places(spark, users=7)
    rng = np.random.default_rng(8)
    far = [(50 + u, i, float(rng.uniform(-89, 89)), float(rng.uniform(-180, 180)), int(rng.integers(1, 4))) for u in range(4) for i in range(25)]
    places = places.union(spark.createDataFrame(far, PLACES))
    whole = exemplars.exemplar_centers(places)
    by_joins = exemplars.exemplar_centers(places, large_user=2)
    assert sorted(whole.collect()) == sorted(by_joins.collect())
    assert whole.schema.names == by_joins.schema.names
    assert {r["user_id"] for r in whole.collect()} == {*range(7), *range(50, 54), 77}


def test_candidates_are_not_exchanged(spark, monkeypatch):
    def joined(*_):
        raise AssertionError("ordinary users went through joins")

    monkeypatch.setattr(exemplars, "similarities", joined)
    assert exemplars.exemplar_centers(some_places(spark)).count()
    assert exemplars.exemplar_centers(some_places(spark).limit(0)).count() == 0


def test_exemplars_leave_out_no_place_and_no_candidate(spark):
    """Places within a mile, and places of far towns that are not the main ones there, count each for itself."""
    rng = np.random.default_rng(11)
    rows = []
    for user in range(4):
        towns = [(33.4, -112.0), (34.3, -111.2), (40.0, -80.0)]
        points = np.concatenate([rng.normal(town, (0.004, 0.1)[user % 2], (8, 2)) for town in towns])
        rows += [(user, i, float(a), float(b), int(rng.integers(1, 5))) for i, (a, b) in enumerate(points)]
    places = spark.createDataFrame(rows, PLACES)
    spots = exemplars.sites(places)
    assert spots.count() == len(rows)
    assert exemplars.candidates(spots).count() == sum(24 * 23 for _ in range(4))
    got = exemplars.exemplar_centers(places)
    assert sorted(got.collect()) == sorted(dense_exemplars.dense_exemplar_centers(places).collect())
    odd = [(0, 90, None, 3.0, 1), (0, 91, 3.0, None, 1), (8, None, 33.4, -112.0, 2), (None, 1, 3.0, 3.0, 1)]
    with_odd = exemplars.exemplar_centers(places.union(spark.createDataFrame(odd, PLACES))).collect()
    added = [r for r in with_odd if r["site"] == 90 or r["user_id"] == 8]
    assert len(with_odd) == got.count() + 2
    assert {(r["user_id"], r["latitude"], r["longitude"], r["visits"]) for r in added} == {(0, None, 3.0, 1), (8, 33.4, -112.0, 2)}


def test_places_are_stored_without_what_follows_from_them(spark, monkeypatch):
    written = []

    def recorded(df):
        written.append(set(df.columns))
        return scale.cut_lineage(df)

    monkeypatch.setattr(dense_exemplars, "cut_lineage", recorded)
    known = dense_exemplars.preferences(dense_exemplars.spots(some_places(spark)))
    chosen = scale.cut_lineage(dense_exemplars.exemplars_of(known))
    net = dense_exemplars.net_similarities(known, chosen)
    assert net.count() == chosen.select("user_id").distinct().count()
    assert not any({"vx", "vy", "vz", "leads"} & columns for columns in written)
    assert exchanges(net)[1] == 0  # exemplars are dealt with the places, not joined
