"""Silhouettes and agreement of clusterings against their definitions over pairs of visits."""

import math
import random
from itertools import combinations

import pytest

from reviewlens.operators import agreement


def rows_of(seed):
    rng = random.Random(seed)
    rows = []
    for user in range(6):
        centers = [(rng.uniform(30, 45), rng.uniform(-120, -80)) for _ in range(1 + user % 4)]
        for _ in range(25):
            at = rng.randrange(len(centers))
            lat, lon = (c + rng.gauss(0, 0.5) for c in centers[at])
            rows.append((user, at if rng.random() < 0.9 else None, lat, lon, rng.randint(1, 3), rng.randrange(3)))
    return rows + [(9, 0, 30.0, -100.0, 1, 0), (10, 0, 30.0, -100.0, 2, 0), (10, 1, 30.0, -100.0, 1, 1)]


SCHEMA = "user_id long, cluster_id long, latitude double, longitude double, visits long, two long"


def chord(p, q):
    def unit(r):
        lat, lon = math.radians(r[2]), math.radians(r[3])
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    return sum((a - b) ** 2 for a, b in zip(unit(p), unit(q)))


def visits_of(rows, user):
    return [r for r in rows if r[0] == user and r[1] is not None for _ in range(r[4])]


def test_silhouettes_equal_the_pairwise_definition(spark):
    rows = rows_of(1)
    found = {r.user_id: r for r in agreement.silhouettes(spark.createDataFrame(rows, SCHEMA)).collect()}
    for user in {r[0] for r in rows}:
        visits = visits_of(rows, user)
        clusters = {v[1] for v in visits}
        assert (found[user].clusters, found[user].visits) == (len(clusters), len(visits))
        if len(clusters) == 1:
            assert found[user].silhouette is None
            continue
        values = []
        for i, v in enumerate(visits):
            mean = {c: [chord(v, w) for j, w in enumerate(visits) if w[1] == c and j != i] for c in clusters}
            if not mean[v[1]]:
                values.append(0.0)
                continue
            a = sum(mean[v[1]]) / len(mean[v[1]])
            b = min(sum(m) / len(m) for c, m in mean.items() if c != v[1])
            values.append((b - a) / max(a, b) if max(a, b) > 1e-15 else 0.0)
        assert found[user].silhouette == pytest.approx(sum(values) / len(values), abs=1e-7)


def test_adjusted_rand_equals_the_pairwise_definition(spark):
    rows = rows_of(2)
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("cluster_id", "one")
    for r in agreement.adjusted_rand(frame).collect():
        visits = visits_of(rows, r.user_id)
        both = one = two = 0
        for p, q in combinations(visits, 2):
            one, two, both = one + (p[1] == q[1]), two + (p[5] == q[5]), both + (p[1] == q[1] and p[5] == q[5])
        pairs = len(visits) * (len(visits) - 1) / 2
        expected = one * two / pairs if pairs else 0
        most = (one + two) / 2
        assert r.visits == len(visits)
        assert r.adjusted_rand == pytest.approx(1.0 if most == expected or not pairs else (both - expected) / (most - expected))


def test_places_go_to_the_nearest_center(spark):
    rows = rows_of(3)
    places = spark.createDataFrame(rows, SCHEMA).drop("cluster_id", "two")
    centers = [(u, 30.0 + 3 * i, -120.0 + 9 * i) for u in range(5) for i in range(4)] + [(9, 1.0, 1.0), (9, 1.0, 1.0)]
    found = agreement.by_nearest_center(places, spark.createDataFrame(centers, "user_id long, latitude double, longitude double")).collect()
    assert {r.user_id for r in found} == {0, 1, 2, 3, 4, 9}
    for r in found:
        own = sorted(c[1:] for c in centers if c[0] == r.user_id)
        assert r.cluster_id == min(range(len(own)), key=lambda i: (round(chord((0, 0, r.latitude, r.longitude), (0, 0, *own[i])), 12), i))


def test_axes_are_not_sent_through_shuffles(spark):
    places = spark.createDataFrame(rows_of(3), SCHEMA).drop("cluster_id", "two")
    centers = places.select("user_id", "latitude", "longitude")
    plan = agreement.by_nearest_center(places, centers)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("COS(") < plan.index("Join")
