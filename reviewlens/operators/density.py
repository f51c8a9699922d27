"""Home areas by density: all users are clustered in the same DataFrame jobs.

Exact density clustering without ever listing all pairs of a group. Places are put on a grid
whose cells have a diagonal of at most ``eps``:

* a cell holding ``min_visits`` or more visits is *crowded*: all its places are core and lie in
  one cluster, so the cell becomes one graph node;
* a place in any other cell has fewer than ``min_visits`` cell mates, so distances are measured
  from those places only, which bounds the pairs by a constant number per place;
* two crowded cells are linked if any two of their places are within ``eps``. That is decided
  on representatives of ever finer sub-cells; a pair of sub-cells is dropped once its distance
  bounds rule a link in or out.

That serves users with very many places. Those of all others come together in one shuffle and meet
in arrays within a task, so that neither cells nor pairs are ever exchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from reviewlens.functions import geo, geo_arrays
from reviewlens.functions.grid import Grid
from reviewlens.operators import whole_users
from reviewlens.operators.components import connected_components
from reviewlens.operators.scale import apart_by_size, cut_lineage, width_for

# Slack in miles when ruling sub-cells out: far above the error of the distance formula.
_SLACK = 1e-3


def _gridded(places: DataFrame, grid: Grid, min_visits: int) -> DataFrame:
    """Places with unit vector, cell, whether the cell is crowded, and their graph node.

    Written out evenly over the cluster, however full single cells are, since the next step
    lists the cells around each place.
    """
    places = cut_lineage(places)  # read twice, and its size sets the width
    spots = geo.with_vector(places).withColumn(
        "cell", grid.cell(F.col("latitude"), F.col("longitude"))
    )
    cells = spots.groupBy("user_id", "cell").agg(
        (F.sum("visits") >= min_visits).alias("crowded"), F.min("place_id").alias("first_place")
    )
    return cut_lineage(
        spots.join(cells, ["user_id", "cell"])
        .withColumn("node", F.when(F.col("crowded"), F.col("first_place")).otherwise(F.col("place_id")))
        .drop("first_place")
        .repartition(width_for(places), "user_id", "place_id")
    )


def _pairs_of_quiet_places(spots: DataFrame, eps: float) -> DataFrame:
    """(user_id, place_id, node, node_crowded, visits): for a quiet place every graph node with
    places within eps, itself included, and the visits those places hold."""
    grid = Grid(eps)  # about nine cells around a place, fewer than on the finer grid
    seekers = grid.near_cells(spots.where(~F.col("crowded")), eps, "near_cell").select(
        "user_id",
        "place_id",
        *(F.col(f"v{axis}").alias(f"a{axis}") for axis in "xyz"),
        "near_cell",
    )
    targets = spots.select(
        "user_id",
        grid.cell(F.col("latitude"), F.col("longitude")).alias("near_cell"),
        "visits",
        "node",
        F.col("crowded").alias("node_crowded"),
        "vx",
        "vy",
        "vz",
    )
    near = geo.near_between(geo.vector_columns("a"), geo.vector_columns("v"), eps)
    return (
        seekers.join(targets, ["user_id", "near_cell"])
        .where(near)
        .groupBy("user_id", "place_id", "node", "node_crowded")
        .agg(F.sum("visits").alias("visits"))
    )


def _summaries(spots: DataFrame, keys: list[str]) -> DataFrame:
    """Per sub-cell: one representative vector, an upper bound of its width, and its size."""
    spans = sum((F.max(f"v{a}") - F.min(f"v{a}")) * (F.max(f"v{a}") - F.min(f"v{a}")) for a in "xyz")
    return spots.groupBy("user_id", *keys).agg(
        F.min_by(F.struct("vx", "vy", "vz"), "place_id").alias("rep"),
        (F.sqrt(spans) * (geo.RADIUS_MILES * 1.001)).alias("width"),
        F.count("*").alias("size"),
    )


def _side(summaries: DataFrame, side: str) -> DataFrame:
    """Rename all but the user so that two sub-cells fit in one row."""
    return summaries.select(
        "user_id",
        *(F.col(name).alias(f"{name}_{side}") for name in summaries.columns if name != "user_id"),
    )


def _judged(pairs: DataFrame, eps: float) -> DataFrame:
    """Add ``linked`` and ``undecided`` to pairs of sub-cells."""
    vectors = [tuple(F.col(f"rep_{s}.v{axis}") for axis in "xyz") for s in "ab"]
    reach = F.col("width_a") + F.col("width_b") + _SLACK
    both_single = (F.col("size_a") == 1) & (F.col("size_b") == 1)
    return pairs.withColumn("miles", geo.miles_between(*vectors)).select(
        "*",
        (F.col("miles") <= eps).alias("linked"),
        ((F.col("miles") > eps) & ~both_single & (F.col("miles") - reach <= eps)).alias("undecided"),
    )


def _links_of_crowded_cells(spots: DataFrame, grid: Grid, eps: float) -> DataFrame:
    """Distinct (user_id, node, other) for crowded cells with places within eps, one way."""
    crowded = spots.where("crowded").select(
        "user_id", "cell", "node", "place_id", "latitude", "longitude", "vx", "vy", "vz"
    )
    whole = _summaries(crowded, ["cell", "node"])
    firsts = crowded.where(F.col("place_id") == F.col("node"))
    around = grid.near_cells(firsts, 2.0 * eps, "cell_b").select(
        "user_id", F.col("cell").alias("cell_a"), "cell_b"
    )
    pairs = (
        around.where(F.col("cell_a") < F.col("cell_b"))
        .join(_side(whole, "b"), ["user_id", "cell_b"])
        .join(_side(whole, "a"), ["user_id", "cell_a"])
    )
    judged = cut_lineage(_judged(pairs, eps))
    ends = ["user_id", "cell_a", "cell_b", "node_a", "node_b"]
    links = judged.where("linked").select(*ends)
    pending = judged.where("undecided").select(*ends)
    # Powers of two scale exactly, so every finer sub-cell lies in one coarser sub-cell.
    scale = 2.0 ** (math.ceil(-math.log2(grid.height)) + 2)
    part = F.lit(0)
    pending = pending.withColumns({"part_a": part, "part_b": part})
    while not pending.isEmpty():
        part = F.struct(
            F.floor(F.col("latitude") * scale).alias("row"),
            F.floor(F.col("longitude") * scale).alias("column"),
        )
        finer = crowded.withColumn("part", part)
        up = F.struct(
            F.floor(F.col("part.row") / 4).alias("row"),
            F.floor(F.col("part.column") / 4).alias("column"),
        )
        first_level = not dict(pending.dtypes)["part_a"].startswith("struct")
        finer = finer.withColumn("up", F.lit(0) if first_level else up)
        open_cells = pending.select("user_id", F.explode(F.array("cell_a", "cell_b")).alias("cell"))
        finer = finer.join(open_cells.distinct(), ["user_id", "cell"], "left_semi")
        subs = _summaries(finer, ["cell", "part", "up"])
        upper = pending.withColumnsRenamed({"part_a": "up_a", "part_b": "up_b"})
        pairs = upper.join(_side(subs, "a"), ["user_id", "cell_a", "up_a"]).join(
            _side(subs, "b"), ["user_id", "cell_b", "up_b"]
        )
        judged = cut_lineage(_judged(pairs, eps))
        found = judged.where("linked").select(*ends).distinct()
        links = links.union(found)
        pending = (
            judged.where("undecided")
            .select(*ends, "part_a", "part_b")
            .join(found, ends, "left_anti")
        )
        scale *= 4.0
    return links.select("user_id", F.col("node_a").alias("node"), F.col("node_b").alias("other"))


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select("user_id", F.col("other").alias("node"), F.col("node").alias("other"))


def _clusters(
    node: np.ndarray, visits: np.ndarray, i: np.ndarray, k: np.ndarray, min_visits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per node the smallest core node of its cluster (their number for noise) and whether it is core.
    Rows i and k are near each other, sorted by i; ``node`` is each row's, in order."""
    nodes = node[-1] + 1
    one, other = node[i], node[k]
    core = np.bincount(one, visits[k], nodes) >= min_visits
    firsts = np.flatnonzero(np.diff(one, prepend=-1))  # every node is near itself
    both = np.flatnonzero(core[one] & core[other])
    link, linked = one[both], other[both]
    starts = np.flatnonzero(np.diff(link, prepend=-1))
    label = np.arange(nodes)
    while len(both):
        lower = label.copy()
        lower[link[starts]] = np.minimum.reduceat(label[linked], starts)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return np.minimum.reduceat(np.where(core[other], label[other], nodes), firsts), core


def _labels_of_whole_users(places: DataFrame, eps: float, min_visits: int) -> DataFrame:
    """The labels of users whose places fit into a task, one shuffle for all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_users.few_users(batches):
            number = whole_users.numbers
            at = geo_arrays.unit_vectors(number(table, "latitude"), number(table, "longitude"))
            i, k = whole_users.all_pairs(starts, table.num_rows)
            near = geo_arrays.near(at, i, k, eps)
            firsts = whole_users.starts_of(table, "user_id", "place_id")
            node = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, table.num_rows)))
            cluster, core = _clusters(node, number(table, "visits"), i[near], k[near], min_visits)
            names = pa.array(np.append(firsts, 0)[cluster], mask=cluster == len(firsts)).take(pa.array(node))
            found = table.append_column("cluster_id", table["place_id"].combine_chunks().take(names))
            yield from found.append_column("is_core", pa.array(core[node])).combine_chunks().to_batches()

    schema = StructType(
        [
            *places.schema.fields,
            StructField("cluster_id", places.schema["place_id"].dataType),
            StructField("is_core", BooleanType()),
        ]
    )
    return whole_users.dealt(places, "place_id").mapInArrow(run, schema)


def density_labels(
    places: DataFrame, eps_miles: float = 4.0, min_visits: int = 5, large_user: int = whole_users.LARGE
) -> DataFrame:
    """Cluster every user's places: the places' columns plus ``cluster_id`` and ``is_core``.

    A place is core if places within ``eps_miles`` (limit included) hold ``min_visits`` visits,
    its own counted. A cluster is named by its smallest core place; a border place in reach of
    several clusters joins the smallest; ``cluster_id`` is null for noise. Users with more than
    ``large_user`` places are clustered by joins of cells.
    """
    known = cut_lineage(places.dropna(subset=["user_id", "latitude", "longitude"]))
    ordinary, large = apart_by_size(known, "user_id", large_user)
    labels = _labels_of_whole_users(ordinary, eps_miles, min_visits)
    if large is None:
        return labels
    return labels.union(_labels_by_cells(large, eps_miles, min_visits))


def _labels_by_cells(places: DataFrame, eps_miles: float, min_visits: int) -> DataFrame:
    """The labels of users with very many places."""
    grid = Grid.with_diagonal(eps_miles)
    spots = _gridded(places, grid, min_visits)
    near = cut_lineage(_pairs_of_quiet_places(spots, eps_miles))

    quiet_core = (
        near.groupBy("user_id", "place_id")
        .agg(F.sum("visits").alias("weight"))
        .where(F.col("weight") >= min_visits)
        .select("user_id", F.col("place_id").alias("node"))
    )
    crowded = spots.where(F.col("crowded") & (F.col("place_id") == F.col("node")))
    nodes = crowded.select("user_id", "node").union(quiet_core)
    core_pairs = (
        near.join(quiet_core.withColumnRenamed("node", "place_id"), ["user_id", "place_id"], "left_semi")
        .join(nodes, ["user_id", "node"], "left_semi")
        .where(F.col("node") != F.col("place_id"))
        .select("user_id", F.col("place_id").alias("node"), F.col("node").alias("other"), "node_crowded")
    )
    # Pairs of two quiet places are there in both directions already.
    links = _links_of_crowded_cells(spots, grid, eps_miles)
    edges = cut_lineage(
        core_pairs.drop("node_crowded")
        .union(_turned(core_pairs.where("node_crowded")))
        .union(links)
        .union(_turned(links))
    )
    labels = connected_components(nodes, edges)

    of_quiet = (
        near.join(labels, ["user_id", "node"])
        .groupBy("user_id", "place_id")
        .agg(F.min("label").alias("cluster_id"))
        .join(quiet_core.withColumnsRenamed({"node": "place_id"}).withColumn("is_core", F.lit(True)),
              ["user_id", "place_id"], "left")
    )
    columns = [name for name in places.columns]
    quiet = (
        spots.where(~F.col("crowded"))
        .join(of_quiet, ["user_id", "place_id"], "left")
        .select(*columns, "cluster_id", F.coalesce("is_core", F.lit(False)).alias("is_core"))
    )
    packed = (
        spots.where("crowded")
        .join(labels, ["user_id", "node"])
        .select(*columns, F.col("label").alias("cluster_id"), F.lit(True).alias("is_core"))
    )
    return quiet.union(packed)


def density_centers(labels: DataFrame) -> DataFrame:
    """Visit-weighted centre on the sphere of every cluster: one row per home area."""
    lat, lon = geo.spherical_center(F.col("latitude"), F.col("longitude"), F.col("visits"))
    return (
        labels.where(F.col("cluster_id").isNotNull())
        .groupBy("user_id", "cluster_id")
        .agg(lat.alias("latitude"), lon.alias("longitude"))
    )


def centers_as_arrays(users: DataFrame, centers: DataFrame) -> DataFrame:
    """Home areas as one array per user, empty for users without any.

    Home areas of a user are apart by construction, so an array is bounded by the number of
    separate areas on earth and in practice by the cities the user visits.
    """
    arrays = centers.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("latitude", "longitude"))).alias("cluster_centers")
    )
    none = F.array().cast("array<struct<latitude:double,longitude:double>>")
    return users.select("user_id").distinct().join(arrays, "user_id", "left").select(
        F.coalesce("cluster_centers", none).alias("cluster_centers"), "user_id"
    )


def centers_as_rows(arrays: DataFrame) -> DataFrame:
    """Inverse of ``centers_as_arrays``: users without home areas give no row."""
    return arrays.select("user_id", F.explode("cluster_centers").alias("c")).select(
        "user_id", F.col("c.latitude").alias("latitude"), F.col("c.longitude").alias("longitude")
    )
