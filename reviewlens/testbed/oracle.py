"""Independent SQL for the deterministic queries, written from the definitions.

Each text is standard SQL with common table expressions over the driver's tables. Distances use
the half-angle form of the ellipsoidal formula and clusters a recursive expression over plain
pairs, neither of which the engine uses.
"""

from __future__ import annotations

import re

_VIEWS: dict[str, str] = {}

_VIEWS["fx_business"] = """
SELECT p_partkey AS business_id, p_name AS name, 1e0 + (p_size % 9) * 5e-1 AS stars,
 3e1 + (p_partkey % 5) * 3e0 + ((p_partkey * 7919) % 1000) * 3e-4 AS latitude,
 -12e1 + (p_partkey % 5) * 8e0 + ((p_partkey * 104729) % 997) * 3e-4 AS longitude,
 n_name AS city, r_name AS state
FROM part JOIN nation ON n_nationkey = p_partkey % 25 JOIN region ON r_regionkey = n_regionkey"""

_VIEWS["fx_business_category_raw"] = """
SELECT p_partkey AS business_id, p_type AS category FROM part
UNION ALL SELECT p_partkey AS business_id, p_brand AS category FROM part"""

_VIEWS["fx_taxonomy"] = """
SELECT * FROM (VALUES (1, 'Restaurants', 'ECONOMY'), (1, 'Restaurants', 'SMALL'),
 (1, 'Restaurants', 'Brand#1'), (1, 'Restaurants', 'PROMO'), (2, 'Shopping', 'LARGE'),
 (2, 'Shopping', 'Brand#2'), (2, 'Shopping', 'Brand#3'), (3, 'Beauty and Spa', 'MEDIUM'),
 (3, 'Beauty and Spa', 'Brand#3'), (4, 'Health and Medical', 'PROMO'),
 (4, 'Health and Medical', 'Brand#4')) AS t(line_no, category, sub_category)"""

_VIEWS["fx_review"] = """
SELECT o_custkey AS user_id, l_partkey AS business_id,
 CAST(1 + CAST(l_quantity AS INT) % 5 AS BIGINT) AS stars,
 concat(o_orderpriority, ' ', l_returnflag, l_linestatus) AS text
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_VIEWS["fx_elite_year"] = """
SELECT DISTINCT o_custkey AS user_id, CAST(year(o_orderdate) AS BIGINT) AS yr
FROM orders WHERE o_totalprice > 300000"""

_VIEWS["fx_votes"] = """
SELECT user_id, CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS cool,
 CAST(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS funny,
 CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS useful
FROM events GROUP BY user_id"""

_VIEWS["fx_user"] = """
SELECT c_custkey AS user_id, c_name AS name, COALESCE(rv.n, 0) AS review_count,
 COALESCE(rv.s, 0e0) AS average_stars, COALESCE(v.cool, 0) AS cool, COALESCE(v.funny, 0) AS funny,
 COALESCE(v.useful, 0) AS useful, CAST(c_nationkey AS BIGINT) AS fans, os.yelping_since
FROM customer
LEFT JOIN (SELECT user_id, COUNT(*) AS n, AVG(stars) AS s FROM fx_review GROUP BY user_id) rv
 ON rv.user_id = c_custkey
LEFT JOIN fx_votes v ON v.user_id = c_custkey
LEFT JOIN (SELECT o_custkey, substr(CAST(MIN(o_orderdate) AS VARCHAR), 1, 7) AS yelping_since
 FROM orders GROUP BY o_custkey) os ON os.o_custkey = c_custkey"""

_VIEWS["fx_checkin"] = """
SELECT business_id, CAST(SUM(n) AS INT) AS tc FROM (
 SELECT event_id % 200 AS business_id, hour(ts) AS h, day(ts) % 7 AS d, COUNT(*) AS n
 FROM events GROUP BY 1, 2, 3) GROUP BY business_id"""

_VIEWS["fx_zip"] = """
SELECT * FROM (VALUES ('00000', 3015e-2, -11985e-2), ('00001', 3315e-2, -11185e-2),
 ('00002', 3615e-2, -10385e-2), ('00003', 3915e-2, -9585e-2), ('00004', 4215e-2, -8785e-2))
 AS t(zip, latitude, longitude)"""

_VIEWS["fx_request"] = """
SELECT c_custkey AS user_id, concat('0000', CAST(c_custkey % 5 AS VARCHAR)) AS zip,
 CASE c_custkey % 4 WHEN 0 THEN 'Restaurants' WHEN 1 THEN 'Shopping' WHEN 2 THEN 'Beauty and Spa'
 ELSE 'Health and Medical' END AS category FROM customer"""

_VIEWS["fx_city"] = """
SELECT n_nationkey + 1 AS line_no, n_name AS city, r_name AS region,
 3015e-2 + (n_nationkey % 5) * 3e0 AS latitude, -11985e-2 + (n_nationkey % 5) * 8e0 AS longitude
FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey < 23
UNION ALL SELECT 100 + n_nationkey AS line_no, n_name AS city, r_name AS region, 0e0 AS latitude,
 0e0 AS longitude
FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey < 3"""


def _elite(next_year: int) -> str:
    return f"""
SELECT u.user_id,
 COALESCE(SUM(e.yr / ({next_year}e0 - e.yr) ORDER BY e.yr) / SUM(CAST(e.yr AS DOUBLE)), 0e0) AS elite,
 CAST(COALESCE(SUM(floor(e.yr / ({next_year}e0 - e.yr))), 0) AS BIGINT) AS elite_v0
FROM (SELECT c_custkey AS user_id FROM customer) u
LEFT JOIN fx_elite_year e ON e.user_id = u.user_id GROUP BY u.user_id"""


_VIEWS["fx_elite"] = _elite(2003)
_VIEWS["fx_elite_before"] = _elite(2002)

_VIEWS["fx_mapped"] = """
SELECT r.business_id, t.category FROM fx_business_category_raw r
JOIN (SELECT sub_category, max_by(category, line_no) AS category FROM fx_taxonomy
 GROUP BY sub_category) t ON t.sub_category = r.category"""

_VIEWS["fx_member"] = """
SELECT DISTINCT r.business_id, t.category FROM fx_business_category_raw r
JOIN fx_taxonomy t ON t.sub_category = r.category"""

_AGG = """
SELECT r.user_id, m.category, COUNT(DISTINCT r.business_id) AS cat_business_count,
 COUNT(*) AS cat_review_count, AVG(length(r.text)) AS cat_avg_review_len,
 AVG(r.stars) AS cat_avg_stars
FROM fx_review r JOIN {mapped} m ON m.business_id = r.business_id
GROUP BY r.user_id, m.category"""

_VIEWS["fx_agg"] = _AGG.format(mapped="(SELECT DISTINCT * FROM fx_mapped)")
_VIEWS["fx_agg_parity"] = _AGG.format(mapped="fx_mapped")

_MONTHS = """CAST(datediff('month', CAST(concat(u.yelping_since, '-01') AS DATE),
 DATE '2002-01-15') AS DOUBLE)"""

_VIEWS["fx_features"] = f"""
SELECT u.user_id, u.name, u.review_count, u.average_stars, u.cool AS votes_cool,
 u.funny AS votes_funny, u.useful AS votes_useful, {_MONTHS} AS months_yelping, e.elite,
 CAST(floor(e.elite / 5e-2) AS INT) AS elite_cat, a.category, a.cat_business_count,
 a.cat_review_count, a.cat_avg_review_len, a.cat_avg_stars
FROM fx_user u JOIN fx_elite e ON e.user_id = u.user_id JOIN fx_agg a ON a.user_id = u.user_id"""


def _with_miles(rows: str, lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """SELECT of the rows plus ``miles`` between two coordinate pairs they hold."""
    return f"""
SELECT *, CASE WHEN s_ = 0 THEN 0e0 ELSE 6378137e0 / 1609.344e0 * (s_ - (1 / 298.257223563e0) / 2 * (
  (s_ - sin(s_)) * power(sin((b1_ + b2_) / 2) * cos((b2_ - b1_) / 2) / cos(s_ / 2), 2)
  + (s_ + sin(s_)) * power(cos((b1_ + b2_) / 2) * sin((b2_ - b1_) / 2) / sin(s_ / 2), 2))) END AS miles
FROM (SELECT *, 2 * asin(least(1e0, sqrt(power(sin((b2_ - b1_) / 2), 2)
   + cos(b1_) * cos(b2_) * power(sin(radians({lon2} - {lon1}) / 2), 2)))) AS s_
 FROM (SELECT *, atan((1 - 1 / 298.257223563e0) * tan(radians({lat1}))) AS b1_,
   atan((1 - 1 / 298.257223563e0) * tan(radians({lat2}))) AS b2_ FROM ({rows}) x) y) z"""


_VIEWS["fx_first_city"] = """
SELECT lower(city) AS city_key, lower(region) AS state_key, latitude AS city_latitude,
 longitude AS city_longitude
FROM (SELECT *, row_number() OVER (PARTITION BY lower(city), lower(region) ORDER BY line_no) AS rn
 FROM fx_city) WHERE rn = 1"""

_VIEWS["fx_placed"] = _with_miles(
    """SELECT b.*, c.city_latitude, c.city_longitude FROM fx_business b JOIN fx_first_city c
 ON c.city_key = lower(b.city) AND c.state_key = lower(b.state)""",
    "city_latitude",
    "city_longitude",
    "latitude",
    "longitude",
)

_VIEWS["fx_region"] = """
SELECT *, CASE WHEN miles <= 3 THEN 'central' WHEN degree > -45 AND degree <= 45 THEN 'east'
 WHEN degree > 45 AND degree <= 135 THEN 'north'
 WHEN (degree > 135 AND degree <= 180) OR (degree >= -180 AND degree <= -135) THEN 'west'
 WHEN degree > -135 AND degree <= -45 THEN 'south' END AS region
FROM (SELECT *, degrees(atan2(longitude - city_longitude, latitude - city_latitude)) AS degree
 FROM fx_placed)"""

_VIEWS["fx_place"] = """
SELECT r.user_id, MIN(r.business_id) AS place_id, b.latitude, b.longitude, COUNT(*) AS visits
FROM fx_review r JOIN fx_business b ON b.business_id = r.business_id
GROUP BY r.user_id, b.latitude, b.longitude"""

_VIEWS["fx_pair"] = (
    "SELECT user_id, a, b, visits, miles FROM ("
    + _with_miles(
        """SELECT p.user_id, p.place_id AS a, q.place_id AS b, q.visits, p.latitude AS lat1,
 p.longitude AS lon1, q.latitude AS lat2, q.longitude AS lon2
 FROM fx_place p JOIN fx_place q ON q.user_id = p.user_id
 WHERE abs(p.latitude - q.latitude) <= 6e-2 AND abs(p.longitude - q.longitude) <= 1e-1""",
        "lat1",
        "lon1",
        "lat2",
        "lon2",
    )
    + ") WHERE miles <= 4"
)

_VIEWS["fx_core"] = """
SELECT user_id, a AS place_id FROM fx_pair GROUP BY user_id, a HAVING SUM(visits) >= 5"""

_VIEWS["fx_link"] = """
SELECT p.user_id, p.a, p.b FROM fx_pair p
JOIN fx_core c ON c.user_id = p.user_id AND c.place_id = p.a
JOIN fx_core d ON d.user_id = p.user_id AND d.place_id = p.b"""

_VIEWS["fx_reach"] = """
SELECT user_id, place_id, place_id AS root FROM fx_core
UNION
SELECT l.user_id, l.b AS place_id, r.root FROM fx_reach r
JOIN fx_link l ON l.user_id = r.user_id AND l.a = r.place_id"""

_VIEWS["fx_component"] = """
SELECT user_id, place_id, MIN(root) AS root FROM fx_reach GROUP BY user_id, place_id"""

_VIEWS["fx_label"] = """
SELECT p.user_id, p.place_id, p.latitude, p.longitude, p.visits, m.cluster_id,
 c.place_id IS NOT NULL AS is_core
FROM fx_place p
LEFT JOIN fx_core c ON c.user_id = p.user_id AND c.place_id = p.place_id
LEFT JOIN (SELECT q.user_id, q.a, MIN(k.root) AS cluster_id FROM fx_pair q
 JOIN fx_component k ON k.user_id = q.user_id AND k.place_id = q.b GROUP BY q.user_id, q.a) m
 ON m.user_id = p.user_id AND m.a = p.place_id"""

_VIEWS["fx_center"] = """
SELECT user_id, cluster_id, degrees(atan2(z, sqrt(x * x + y * y))) AS latitude,
 degrees(atan2(y, x)) AS longitude
FROM (SELECT user_id, cluster_id,
 SUM(visits * cos(radians(latitude)) * cos(radians(longitude))) / SUM(visits) AS x,
 SUM(visits * cos(radians(latitude)) * sin(radians(longitude))) / SUM(visits) AS y,
 SUM(visits * sin(radians(latitude))) / SUM(visits) AS z
 FROM fx_label WHERE cluster_id IS NOT NULL GROUP BY user_id, cluster_id)"""

_VIEWS["fx_near_business"] = (
    "SELECT zip, business_id FROM ("
    + _with_miles(
        """SELECT z.zip, b.business_id, z.latitude AS lat1, z.longitude AS lon1, b.latitude AS lat2,
 b.longitude AS lon2 FROM fx_zip z JOIN fx_business b
 ON abs(z.latitude - b.latitude) <= 1e-1""",
        "lat1",
        "lon1",
        "lat2",
        "lon2",
    )
    + ") WHERE miles <= 5"
)

_VIEWS["fx_near_user"] = (
    "SELECT DISTINCT zip, user_id FROM ("
    + _with_miles(
        """SELECT z.zip, c.user_id, z.latitude AS lat1, z.longitude AS lon1, c.latitude AS lat2,
 c.longitude AS lon2 FROM fx_zip z JOIN fx_center c ON abs(z.latitude - c.latitude) <= 1e-1""",
        "lat1",
        "lon1",
        "lat2",
        "lon2",
    )
    + ") WHERE miles < 5"
)

_VIEWS["fx_local_business"] = """
SELECT b.business_id, b.name, b.stars FROM fx_business b
WHERE b.business_id IN (SELECT business_id FROM fx_near_business WHERE zip = '00000')
 AND b.business_id IN (SELECT business_id FROM fx_member WHERE category = 'Restaurants')"""

_VIEWS["fx_local_user"] = "SELECT user_id FROM fx_near_user WHERE zip = '00000'"

_VIEWS["fx_pair_rating"] = """
SELECT r.user_id, r.business_id, MIN(b.name) AS business_name, MIN(b.stars) AS business_stars,
 AVG(r.stars) AS avg_rev_stars
FROM fx_review r JOIN fx_local_business b ON b.business_id = r.business_id
JOIN fx_local_user u ON u.user_id = r.user_id GROUP BY r.user_id, r.business_id"""

_VIEWS["fx_weighted"] = """
SELECT j.*, p.elite AS elite_score, j.avg_rev_stars * p.elite AS w_score
FROM fx_pair_rating j JOIN fx_elite p ON p.user_id = j.user_id"""

_VIEWS["fx_rank"] = """
SELECT business_id, business_name, business_stars, AVG(w_score) AS rank FROM fx_weighted
GROUP BY business_id, business_name, business_stars"""

_VIEWS["fx_stale"] = """
SELECT a.user_id, a.category, e.elite AS label, b.elite AS prediction FROM fx_agg a
JOIN fx_elite e ON e.user_id = a.user_id JOIN fx_elite_before b ON b.user_id = a.user_id"""

_VIEWS["fx_stale_class"] = """
SELECT user_id, category, CAST(floor(label / 5e-2) AS INT) AS label,
 CAST(floor(prediction / 5e-2) AS INT) AS prediction FROM fx_stale"""

_VIEWS["fx_k1"] = """
SELECT m.user_id, m.latitude, m.longitude, m.n, SUM(p.visits * (power(p.latitude - m.latitude, 2)
 + power(p.longitude - m.longitude, 2))) / m.n AS spread
FROM (SELECT user_id, CAST(SUM(visits) AS DOUBLE) AS n,
 SUM(visits * latitude) / SUM(visits) AS latitude, SUM(visits * longitude) / SUM(visits) AS longitude
 FROM fx_place GROUP BY user_id HAVING SUM(visits) >= 5) m
JOIN fx_place p ON p.user_id = m.user_id GROUP BY m.user_id, m.latitude, m.longitude, m.n"""

_VIEWS["fx_k1_fit"] = """
SELECT *, -ln(2 * pi() * variance) - spread / (2 * variance) AS ll
FROM (SELECT *, greatest(spread / 2, 1e-3) AS variance FROM fx_k1)"""

_RECURSIVE = {"fx_reach"}
_MATERIALIZED = {"fx_place", "fx_pair", "fx_core", "fx_link", "fx_label", "fx_center", "fx_review"}


def _needed(text: str) -> list[str]:
    """Views a query uses, directly or through others, in their order of definition."""
    found: set[str] = set()
    todo = [text]
    while todo:
        for name in set(re.findall(r"\bfx_\w+", todo.pop())) - found:
            found.add(name)
            todo.append(_VIEWS[name])
    return [name for name in _VIEWS if name in found]


def _query(body: str) -> str:
    views = []
    for name in _needed(body):
        how = "MATERIALIZED " if name in _MATERIALIZED else ""
        views.append(f"{name} AS {how}({_VIEWS[name]})")
    if not views:
        return body
    return "WITH RECURSIVE " + ",\n".join(views) + "\n" + body


def _r(names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names.split())


_MISS = """SELECT b.business_id, c.city_latitude, c.city_longitude FROM fx_business b
LEFT JOIN fx_first_city c ON c.city_key = lower(b.city) AND c.state_key = lower(b.state)"""

_BODIES: dict[str, str] = {
    "taxonomy_last_wins": """SELECT t.sub_category, t.category, v.business_count
FROM (SELECT sub_category, max_by(category, line_no) AS category FROM fx_taxonomy
 GROUP BY sub_category) t
JOIN (SELECT category AS sub_category, COUNT(*) AS business_count FROM fx_business_category_raw
 GROUP BY category) v ON v.sub_category = t.sub_category""",
    "taxonomy_membership": """SELECT t.sub_category, t.category, v.business_count
FROM (SELECT DISTINCT category, sub_category FROM fx_taxonomy) t
JOIN (SELECT category AS sub_category, COUNT(*) AS business_count FROM fx_business_category_raw
 GROUP BY category) v ON v.sub_category = t.sub_category""",
    "predictions_for_category": """SELECT user_id, round(elite + 1, 9) AS prediction FROM fx_elite""",
    "zip_lookup": f"""SELECT r.user_id, r.zip, {_r('latitude longitude')} FROM fx_request r
JOIN fx_zip z ON z.zip = r.zip""",
    "project_review": "SELECT user_id, business_id, stars FROM fx_review",
    "review_len": "SELECT *, CAST(length(text) AS INT) AS review_len FROM fx_review",
    "votes_flatten": """SELECT user_id, cool AS votes_cool, funny AS votes_funny,
 useful AS votes_useful FROM fx_user""",
    "user_profile_v0": """SELECT u.user_id, u.name AS "userName", u.review_count AS "totalReviews",
 u.funny, u.cool, u.useful, u.fans, CAST(2002 * 12 + 1 - (CAST(substr(u.yelping_since, 1, 4) AS BIGINT)
 * 12 + CAST(substr(u.yelping_since, 6, 2) AS BIGINT)) AS BIGINT) AS "yelpingSince",
 e.elite_v0 AS elite, CAST(0 AS BIGINT) AS k
FROM fx_user u JOIN fx_elite e ON e.user_id = u.user_id""",
    "filter_category": "SELECT DISTINCT * FROM fx_mapped WHERE category = 'Restaurants'",
    "filter_in_list": "SELECT DISTINCT * FROM fx_mapped WHERE category IN ('Restaurants', 'Shopping')",
    "local_businesses": "SELECT * FROM fx_local_business",
    "local_users": "SELECT * FROM fx_local_user",
    "distinct_users": "SELECT DISTINCT user_id FROM fx_place",
    "months_yelping": f"SELECT u.user_id, {_MONTHS} AS months_yelping FROM fx_user u",
    "months_calendar": """SELECT user_id, CAST(2002 * 12 + 1 - (CAST(substr(yelping_since, 1, 4) AS BIGINT)
 * 12 + CAST(substr(yelping_since, 6, 2) AS BIGINT)) AS BIGINT) AS months FROM fx_user""",
    "elite_score": f"SELECT user_id, {_r('elite', 9)} FROM fx_elite",
    "elite_score_v0": "SELECT user_id, elite_v0 AS elite FROM fx_elite",
    "elite_category": "SELECT user_id, CAST(floor(elite / 5e-2) AS INT) AS elite_cat FROM fx_elite",
    "category_slug": """SELECT DISTINCT business_id, category, replace(lower(category), ' ', '_') AS slug
FROM fx_mapped""",
    "geo_distance": f"SELECT business_id, {_r('miles')} FROM fx_placed",
    "spherical_centroid": """SELECT city, state,
 round(degrees(atan2(z, sqrt(x * x + y * y))), 6) AS latitude, round(degrees(atan2(y, x)), 6) AS longitude
FROM (SELECT city, state, AVG(cos(radians(latitude)) * cos(radians(longitude))) AS x,
 AVG(cos(radians(latitude)) * sin(radians(longitude))) AS y, AVG(sin(radians(latitude))) AS z
 FROM fx_business GROUP BY city, state)""",
    "business_category_exploded": "SELECT * FROM fx_mapped",
    "business_category": "SELECT DISTINCT * FROM fx_mapped",
    "business_review": """SELECT r.business_id, r.user_id, r.stars, m.category FROM fx_review r
JOIN (SELECT DISTINCT * FROM fx_mapped) m ON m.business_id = r.business_id""",
    "user_category_agg": f"""SELECT user_id, category, cat_business_count, cat_review_count,
 {_r('cat_avg_review_len cat_avg_stars')} FROM fx_agg""",
    "user_category_agg_parity": f"""SELECT user_id, category, cat_business_count, cat_review_count,
 {_r('cat_avg_review_len cat_avg_stars')} FROM fx_agg_parity""",
    "user_features": f"""SELECT user_id, name, review_count, votes_cool, votes_funny, votes_useful,
 elite_cat, category, cat_business_count, cat_review_count,
 {_r('average_stars months_yelping elite cat_avg_review_len cat_avg_stars')} FROM fx_features""",
    "user_locations": f"""SELECT r.user_id, {_r('latitude longitude')} FROM fx_review r
JOIN fx_business b ON b.business_id = r.business_id""",
    "locations_per_user": """SELECT user_id, COUNT(*) AS places, CAST(SUM(visits) AS BIGINT) AS visits,
 round(SUM(latitude), 6) AS latitude_sum, round(SUM(longitude), 6) AS longitude_sum
FROM fx_place GROUP BY user_id""",
    "user_pair_distances": f"""SELECT user_id, a AS place_a, b AS place_b, {_r('miles')} FROM fx_pair
WHERE a < b""",
    "user_city_counts": """SELECT r.user_id, b.city, COUNT(*) AS count FROM fx_review r
JOIN fx_business b ON b.business_id = r.business_id GROUP BY r.user_id, b.city""",
    "user_city_state_counts": """SELECT r.user_id, b.city, b.state, COUNT(*) AS count FROM fx_review r
JOIN fx_business b ON b.business_id = r.business_id GROUP BY r.user_id, b.city, b.state""",
    "user_frequent_cities": """SELECT u.user_id, COUNT(g.user_id) AS k FROM fx_user u
LEFT JOIN (SELECT r.user_id FROM fx_review r JOIN fx_business b ON b.business_id = r.business_id
 GROUP BY r.user_id, b.city, b.state HAVING COUNT(*) > 3) g ON g.user_id = u.user_id
GROUP BY u.user_id""",
    "places_per_user": """SELECT r.user_id, COUNT(*) AS count FROM fx_review r
JOIN fx_business b ON b.business_id = r.business_id GROUP BY r.user_id""",
    "avg_rating_per_user": """SELECT user_id, round(AVG(stars), 6) AS avg_rating FROM fx_review
GROUP BY user_id""",
    "checkin_totals": "SELECT business_id, tc FROM fx_checkin",
    "stars_vs_checkins": """SELECT b.business_id, b.stars AS avg_rating, c.tc AS num_checkins
FROM fx_business b JOIN fx_checkin c ON c.business_id = b.business_id""",
    "all_categories": "SELECT DISTINCT category FROM fx_business_category_raw",
    "city_lookup": f"SELECT business_id, {_r('city_latitude city_longitude')} FROM ({_MISS})",
    "city_no_match": f"SELECT COUNT(*) AS no_match FROM ({_MISS}) WHERE city_latitude IS NULL",
    "business_region": f"SELECT business_id, stars, region, {_r('miles degree')} FROM fx_region",
    "region_by_category": f"""SELECT g.business_id, c.category, region, {_r('miles degree')}
FROM fx_region g JOIN fx_business_category_raw c ON c.business_id = g.business_id""",
    "dbscan_labels": "SELECT user_id, place_id, visits, cluster_id, is_core FROM fx_label",
    "dbscan_centers": f"SELECT user_id, cluster_id, {_r('latitude longitude')} FROM fx_center",
    "local_user_business": f"""SELECT user_id, business_id, business_name, business_stars,
 {_r('avg_rev_stars')} FROM fx_pair_rating""",
    "weighted_scores": f"""SELECT user_id, business_id, business_name, business_stars,
 {_r('avg_rev_stars elite_score w_score')} FROM fx_weighted""",
    "rank_businesses": f"SELECT business_id, business_name, business_stars, {_r('rank')} FROM fx_rank",
    "rank_topk": f"""SELECT business_id, business_name, business_stars, {_r('rank')}
FROM (SELECT * FROM fx_rank ORDER BY rank DESC, business_id LIMIT 20)""",
    "rank_batch": f"""SELECT zip, category, business_id, business_name, business_stars, {_r('rank')}
FROM (SELECT q.zip, q.category, v.business_id, MIN(v.name) AS business_name,
 MIN(v.stars) AS business_stars, AVG(v.avg_rev_stars * (v.elite + CASE q.category
  WHEN 'Shopping' THEN 1 WHEN 'Beauty and Spa' THEN 2 WHEN 'Health and Medical' THEN 3 ELSE 0 END)) AS rank
 FROM (SELECT DISTINCT zip, category FROM fx_request) q
 JOIN fx_near_business nb ON nb.zip = q.zip
 JOIN fx_member m ON m.business_id = nb.business_id AND m.category = q.category
 JOIN (SELECT r.user_id, r.business_id, MIN(b.name) AS name, MIN(b.stars) AS stars,
   AVG(r.stars) AS avg_rev_stars, MIN(e.elite) AS elite FROM fx_review r
   JOIN fx_business b ON b.business_id = r.business_id JOIN fx_elite e ON e.user_id = r.user_id
   GROUP BY r.user_id, r.business_id) v ON v.business_id = nb.business_id
 JOIN fx_near_user nu ON nu.zip = q.zip AND nu.user_id = v.user_id
 GROUP BY q.zip, q.category, v.business_id)""",
    "local_vs_overall_rating": """SELECT b.business_id, b.stars, round(AVG(r.stars), 6) AS avg_rating
FROM fx_local_business b JOIN fx_review r ON r.business_id = b.business_id
JOIN fx_local_user u ON u.user_id = r.user_id GROUP BY b.business_id, b.stars""",
    "assembled_features": """SELECT user_id, category, round(average_stars, 6) AS x0,
 round(cat_avg_review_len, 6) AS x1, round(cat_avg_stars, 6) AS x2,
 CAST(cat_business_count AS DOUBLE) AS x3, CAST(cat_review_count AS DOUBLE) AS x4,
 months_yelping AS x5, CAST(review_count AS DOUBLE) AS x6, CAST(votes_cool AS DOUBLE) AS x7,
 CAST(votes_funny AS DOUBLE) AS x8, CAST(votes_useful AS DOUBLE) AS x9
FROM fx_features WHERE months_yelping IS NOT NULL""",
    "train_test_split": """SELECT user_id, category,
 CAST('0x' || substr(md5(concat(CAST(user_id AS VARCHAR), ':11')), 1, 8) AS BIGINT) % 10 < 7 AS is_train
FROM fx_features""",
    "near_place_counts": """SELECT user_id, a AS place_id,
 CAST(SUM(CASE WHEN a <> b THEN 1 ELSE 0 END) AS BIGINT) AS near_places,
 CAST(SUM(CASE WHEN a <> b THEN visits ELSE 0 END) AS BIGINT) AS near_visits
FROM fx_pair GROUP BY user_id, a""",
    "gmm_models_k1": f"""SELECT user_id, round(radians(latitude), 5) AS latitude,
 round(radians(longitude), 5) AS longitude, {_r('variance ll', 5)},
 round(-2 * ll * n + 3 * ln(n), 5) AS bic FROM fx_k1_fit""",
    "exemplar_consistency": """SELECT user_id, COUNT(*) AS places,
 CAST(SUM(visits) AS BIGINT) AS visits, CAST(0 AS BIGINT) AS strays FROM fx_place GROUP BY user_id""",
    "exemplar_net_similarity": f"""SELECT * FROM (WITH far AS (SELECT user_id, a, w, met, miles FROM ({
        _with_miles(
            """SELECT p.user_id, p.place_id AS a, p.visits * q.visits AS w, q.visits AS met, p.latitude AS lat1,
 p.longitude AS lon1, q.latitude AS lat2, q.longitude AS lon2
 FROM fx_place p JOIN fx_place q ON q.user_id = p.user_id AND q.place_id <> p.place_id""",
            "lat1",
            "lon1",
            "lat2",
            "lon2",
        )
    })),
upto AS (SELECT user_id, d, SUM(w) OVER (PARTITION BY user_id ORDER BY d) AS upto,
 SUM(w) OVER (PARTITION BY user_id) AS total
 FROM (SELECT user_id, round(miles, 6) AS d, SUM(w) AS w FROM far GROUP BY 1, 2)),
median AS (SELECT user_id, MIN(d) AS d FROM upto WHERE upto * 2 >= total GROUP BY user_id),
single AS (SELECT user_id, MIN(cost) AS cost FROM (SELECT user_id, a, SUM(met * miles) AS cost FROM far GROUP BY 1, 2)
 GROUP BY user_id)
SELECT u.user_id, u.places, round(greatest(coalesce(m.d, 0.01), 0.01), 6) AS preference,
 round(-coalesce(s.cost, 0) - greatest(coalesce(m.d, 0.01), 0.01), 4) AS one_exemplar, CAST(0 AS BIGINT) AS worse
FROM (SELECT user_id, COUNT(*) AS places FROM fx_place GROUP BY user_id) u
LEFT JOIN median m ON m.user_id = u.user_id LEFT JOIN single s ON s.user_id = u.user_id)""",
    "user_profiles_v0": """SELECT u.user_id, u.name AS "userName", u.review_count AS "totalReviews",
 u.funny, u.cool, u.useful, u.fans, CAST(2002 * 12 + 1 - (CAST(substr(u.yelping_since, 1, 4) AS BIGINT)
 * 12 + CAST(substr(u.yelping_since, 6, 2) AS BIGINT)) AS BIGINT) AS "yelpingSince",
 e.elite_v0 AS elite, COALESCE(g.k, 0) AS k
FROM fx_user u JOIN fx_elite e ON e.user_id = u.user_id
LEFT JOIN (SELECT user_id, COUNT(*) AS k FROM (SELECT r.user_id FROM fx_review r
  JOIN fx_business b ON b.business_id = r.business_id
  GROUP BY r.user_id, b.city, b.state HAVING COUNT(*) > 3) GROUP BY user_id) g
 ON g.user_id = u.user_id""",
    "metric_mse": """SELECT category, round(AVG(power(label - prediction, 2)), 9) AS mse FROM fx_stale
GROUP BY category""",
    "metric_rmse": """SELECT category, round(sqrt(AVG(power(label - prediction, 2))), 9) AS rmse
FROM fx_stale GROUP BY category""",
    "metric_accuracy": """SELECT category,
 round(AVG(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 9) AS accuracy
FROM fx_stale_class GROUP BY category""",
    "metric_weighted_f1": """SELECT category, round(SUM(support * f1) / SUM(support), 9) AS weighted_f1
FROM (SELECT s.category, s.support,
  2e0 * s.hits / (s.support + COALESCE(p.predicted, 0)) AS f1
 FROM (SELECT category, label, COUNT(*) AS support,
   SUM(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS hits
  FROM fx_stale_class GROUP BY category, label) s
 LEFT JOIN (SELECT category, prediction, COUNT(*) AS predicted FROM fx_stale_class
  GROUP BY category, prediction) p ON p.category = s.category AND p.prediction = s.label)
GROUP BY category""",
}


_VIEWS["fx_axes"] = """
SELECT *, cos(radians(latitude)) * cos(radians(longitude)) AS x, cos(radians(latitude)) * sin(radians(longitude)) AS y,
 sin(radians(latitude)) AS z FROM fx_label WHERE cluster_id IS NOT NULL"""

_VIEWS["fx_mass"] = """
SELECT user_id, cluster_id, SUM(visits) AS n, SUM(visits * x) AS sx, SUM(visits * y) AS sy, SUM(visits * z) AS sz
FROM fx_axes GROUP BY user_id, cluster_id"""

_VIEWS["fx_silhouette"] = """
SELECT user_id, CAST(SUM(visits) AS BIGINT) AS visits, MAX(others) + 1 AS clusters,
 CASE WHEN MAX(others) > 0 THEN round(SUM(visits * (b - a) / greatest(a, b)) / SUM(visits), 4) END AS silhouette
FROM (SELECT p.user_id, p.place_id, p.visits, COUNT(*) FILTER (m.cluster_id <> p.cluster_id) AS others,
  MIN(CASE WHEN m.cluster_id <> p.cluster_id THEN 2e0 - 2e0 * (p.x * sx + p.y * sy + p.z * sz) / n END) AS b,
  MIN(CASE WHEN m.cluster_id = p.cluster_id THEN (2e0 * n - 2e0 * (p.x * sx + p.y * sy + p.z * sz)) / (n - 1) END) AS a
 FROM fx_axes p JOIN fx_mass m ON m.user_id = p.user_id GROUP BY p.user_id, p.place_id, p.visits)
GROUP BY user_id"""

_VIEWS["fx_shared"] = """
SELECT l.user_id, l.cluster_id, b.city, CAST(SUM(l.visits) AS DOUBLE) AS n FROM fx_label l
JOIN fx_business b ON b.business_id = l.place_id WHERE l.cluster_id IS NOT NULL
GROUP BY l.user_id, l.cluster_id, b.city"""

_BODIES["clustering_agreement"] = """SELECT s.user_id, s.clusters, s.visits, s.silhouette,
 CASE WHEN (o + c) / 2 = o * c / w THEN 1e0 ELSE round((i - o * c / w) / ((o + c) / 2 - o * c / w), 4) END AS adjusted_rand
FROM fx_silhouette s
JOIN (SELECT user_id, SUM(n * (n - 1) / 2) AS i, SUM(n) * (SUM(n) - 1) / 2 AS w FROM fx_shared GROUP BY user_id) h
 ON h.user_id = s.user_id
JOIN (SELECT user_id, SUM(n * (n - 1) / 2) AS o FROM (SELECT user_id, SUM(n) AS n FROM fx_shared
 GROUP BY user_id, cluster_id) GROUP BY user_id) one ON one.user_id = s.user_id
JOIN (SELECT user_id, SUM(n * (n - 1) / 2) AS c FROM (SELECT user_id, SUM(n) AS n FROM fx_shared
 GROUP BY user_id, city) GROUP BY user_id) two ON two.user_id = s.user_id"""

_VIEWS["fx_train"] = """
SELECT * FROM fx_features WHERE months_yelping IS NOT NULL
 AND CAST('0x' || substr(md5(concat(CAST(user_id AS VARCHAR), ':11')), 1, 8) AS BIGINT) % 10 < 7"""

# A fitted tree's leaves hold all training rows, and their means give the labels' sum back.
_BODIES["tree_leaf_means"] = """SELECT category, COUNT(*) AS train_rows, round(SUM(elite), 6) AS label_sum,
 CAST(0 AS BIGINT) AS wrong_leaves FROM fx_train GROUP BY category"""
_BODIES["forest_tree_means"] = """SELECT category, COUNT(*) AS train_rows, CAST(0 AS BIGINT) AS wrong_rows
FROM fx_train GROUP BY category"""
# The data's side of the gradient's equations, which a model at its optimum meets in every cell.
_INPUTS = ("average_stars cat_avg_review_len cat_avg_stars cat_business_count cat_review_count months_yelping "
           "review_count votes_cool votes_funny votes_useful 1").split()
_BODIES["logistic_gradient"] = "SELECT category, reg_param, class, input, observed, 1 AS flat FROM (" + " UNION ALL ".join(
    f"""SELECT category, elite_cat AS class, {i} AS input, round(SUM(CAST({name} AS DOUBLE)), 4) AS observed
FROM fx_train GROUP BY category, elite_cat"""
    for i, name in enumerate(_INPUTS)
) + ") m, (VALUES (1e-1), (1e-2)) AS p(reg_param)"

_BODIES["review_ledger"] = """SELECT user_id, CASE WHEN user_id % 7 = 0 THEN 'bad' ELSE 'good' END AS kind,
 COUNT(*) AS reviews, CAST(SUM(CASE WHEN user_id % 7 <> 0 THEN stars END) AS BIGINT) AS stars,
 (SELECT COUNT(*) FROM fx_review WHERE user_id % 7 <> 0) AS good_rows,
 (SELECT COUNT(*) FROM fx_review WHERE user_id % 7 = 0) AS bad_rows
FROM fx_review GROUP BY user_id"""
# The mean of a fitted mixture is the mean of its data, however many components there are.
_BODIES["gmm_moments"] = """SELECT user_id, CAST(k AS INT) AS k, CAST(n AS BIGINT) AS visits,
 round(radians(latitude), 5) AS latitude, round(radians(longitude), 5) AS longitude, 1 AS as_stated
FROM fx_k1, (VALUES (1), (2), (3), (4)) AS c(k)"""
_BODIES["features_from_json"] = _BODIES["user_features"]
_BODIES["user_category_merged"] = _BODIES["user_category_agg"]
_BODIES["user_features_co_located"] = _BODIES["user_features"]
_BODIES["local_businesses_in_place_order"] = _BODIES["local_businesses"]
_BODIES["dbscan_centers_refreshed"] = _BODIES["dbscan_centers"]
_BODIES["rank_from_stored_centers"] = _BODIES["rank_businesses"]


def oracle_sql() -> dict[str, str]:
    return {name: _query(body) for name, body in _BODIES.items()}
