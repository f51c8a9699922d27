"""Exemplars over all pairs against textbook message passing on the whole matrix."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import dense_exemplars as dense
from tests.test_clustering import PLACES, brute_exemplars, crowd, distance_matrix, spot_rows

TOWNS = [(33.4, -112.0), (34.3, -111.2), (40.0, -80.0)]


def cases():
    """Towns near and far, one town, scattered places, equal places, one place, two places."""
    out = []
    for user, seed in enumerate(range(60, 66)):
        points = crowd(seed, TOWNS, 5, 0.05)
        out += spot_rows(user, points, np.random.default_rng(seed).integers(1, 6, len(points)))
    for user, seed in enumerate(range(70, 74), 10):
        points = np.random.default_rng(seed).uniform((-60, -170), (60, 170), (14, 2))
        out += spot_rows(user, points, np.random.default_rng(seed).integers(1, 3, len(points)))
    out += spot_rows(20, [(45.0, -73.0)])
    out += spot_rows(21, [(45.0, -73.0), (46.0, -73.0)], [3, 1])
    out += spot_rows(22, crowd(80, [(45.0, -73.0)], 12, 0.01))
    out += spot_rows(23, [(45.0, -73.0)] * 3 + [(45.2, -73.0)])
    return out


def weighted_median(matrix, visits):
    apart = ~np.eye(len(visits), dtype=bool)
    order = np.argsort(matrix[apart], kind="stable")
    weight = np.cumsum(np.outer(visits, visits)[apart][order])
    return max(0.01, round(float(matrix[apart][order][np.searchsorted(weight * 2, weight[-1])]), 6)) if len(visits) > 1 else 0.01


@pytest.fixture(scope="module")
def found(spark):
    rows = cases()
    places = spark.createDataFrame([(*r, "x", 0.5) for r in rows], PLACES + ", site string, spread double")
    known = dense.preferences(dense.spots(places))
    return rows, places, known


def test_exemplars_of_all_pairs_are_found_for_every_user(spark, found):
    rows, places, known = found
    own = {(r["user_id"], r["i"]): r["s"] for r in dense.similarities(known).where("i = k").collect()}
    got = dense.dense_exemplar_centers(places).collect()
    pruned = dense.similarities(known).groupBy("user_id").count().collect()
    assert sum(r["count"] for r in pruned) < 0.85 * sum(sum(r[0] == u for r in rows) ** 2 for u in {r[0] for r in rows})
    for user in sorted({r[0] for r in rows}):
        mine = [r for r in rows if r[0] == user]
        visits = np.array([r[4] for r in mine])
        matrix = distance_matrix(spark, mine)
        median = weighted_median(matrix, visits)
        edges = [
            (mine[i][1], mine[k][1], own[user, mine[i][1]] if i == k else -matrix[i, k] * visits[i])
            for i in range(len(mine))
            for k in range(len(mine))
        ]
        assert all(-own[user, r[1]] == pytest.approx(median, rel=2e-6) for r in mine)
        expected = brute_exemplars(edges)
        assert {r["site"] for r in got if r["user_id"] == user} == expected
        where = {r[1]: (r[2], r[3], r[4]) for r in mine}
        assert all((r["latitude"], r["longitude"], r["visits"]) == where[r["site"]] for r in got if r["user_id"] == user)


def test_blocks_change_nothing(spark, found, monkeypatch):
    _, places, known = found
    monkeypatch.setattr(dense, "BLOCK", 4)
    small = dense.spots(places.repartition(5))
    assert small.agg(F.max("parts")).first()[0] == 4
    columns = ["user_id", "site", "nearest", "spread"]
    rows = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert rows(dense.preferences(small)) == rows(known)
    keys = lambda df: sorted(map(tuple, dense.similarities(df).select("user_id", "i", "k").collect()))
    assert keys(dense.preferences(small)) == keys(known)


def test_net_similarity_is_that_of_the_matrix(spark, found):
    rows, _, known = found
    chosen = known.where("site % 4 = 0").select("user_id", "site")
    got = {r["user_id"]: r["net"] for r in dense.net_similarities(known, chosen).collect()}
    for user in (0, 11, 20, 23):
        mine = [r for r in rows if r[0] == user]
        matrix = distance_matrix(spark, mine)
        leaders = [i for i, r in enumerate(mine) if r[1] % 4 == 0]
        median = weighted_median(matrix, np.array([r[4] for r in mine]))
        cost = sum(r[4] * matrix[i, leaders].min() for i, r in enumerate(mine) if i not in leaders)
        assert -got[user] == pytest.approx(cost + median * len(leaders), rel=1e-5)


def test_places_without_user_or_coordinates_and_empty_tables(spark):
    rows = [(None, 1, 1.0, 1.0, 1), (1, 2, None, 1.0, 1), (1, 3, 2.0, 2.0, 2)]
    got = dense.dense_exemplar_centers(spark.createDataFrame(rows, PLACES)).collect()
    assert [(r["user_id"], r["site"]) for r in got] == [(1, 3)]
    assert dense.dense_exemplar_centers(spark.createDataFrame([], PLACES)).count() == 0


def test_pairs_are_filtered_where_they_appear(found):
    _, _, known = found
    plan = dense.similarities(known)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Exchange" not in plan[: plan.index("Generate explode(members")]
    assert "CartesianProduct" not in plan and "Python" not in plan


def test_whole_users_have_the_exemplars_of_joined_pairs(spark, found, monkeypatch):
    _, places, known = found
    whole = sorted(dense.dense_exemplar_centers(places, max_rounds=20).collect())
    chosen = known.where("site % 4 = 0").select("user_id", "site")
    net = {r["user_id"]: r["net"] for r in dense.net_similarities(known, chosen).collect()}
    monkeypatch.setattr(dense, "BLOCK", 1)
    small = dense.preferences(dense.spots(places))
    joined = sorted(dense.dense_exemplar_centers(places, max_rounds=20).collect())
    assert whole == joined and {r["settled"] for r in whole} == {True, False}
    assert sorted(dense.exemplars_of(small, max_rounds=20).collect()) == [(r[0], r[1], r[5]) for r in joined]
    by_joins = {r["user_id"]: r["net"] for r in dense.net_similarities(small, chosen).collect()}
    assert net.keys() == by_joins.keys() and all(net[u] == pytest.approx(by_joins[u], rel=1e-9) for u in net)


def test_no_pair_of_a_whole_user_is_joined_or_exchanged(spark, found, monkeypatch):
    def joined(*_):
        raise AssertionError("ordinary users went through joins")

    monkeypatch.setattr(dense, "_pairs", joined)
    monkeypatch.setattr(dense, "exemplar_sites", joined)
    _, places, known = found
    chosen = dense.exemplars_of(known)
    plan = chosen._jdf.queryExecution().sparkPlan().toString()
    assert (plan.count("Exchange"), plan.count("Join")) == (1, 0)
    assert dense.net_similarities(dense.preferences(dense.spots(places)), chosen).count() == chosen.select("user_id").distinct().count()
    assert dense.dense_exemplar_centers(places).count() == chosen.count()
