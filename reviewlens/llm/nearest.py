"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are scaled to length one, where the largest cosine is the smallest distance. A table hashes
by ``HASHES`` normal projections cut into cells of ``WIDTH``. A query looks into its own cell and the
neighbouring ones in the order of their estimated success: the sum of squared distances from its
projections to the walls that have to be crossed. What all tables give is merged and ranked by the
exact cosine of the original vectors. A query that meets fewer than k candidates so is compared with all rows.

Nearly random vectors have no near neighbours: the five nearest of 64 random components lie at
angles not far below a right one, and any hash must visit most of the cells to find them. The
defaults reach a recall above 0.95 there, visiting 96 % of the vectors; on clustered data the first cells
hold the neighbours.

Vectors that are null, empty, zero or hold null or non-finite components take no part, as queries or
as candidates. Candidates are all rows but the query's own; ids that repeat are separate rows, null ids
rank last. Ties go to the smaller id. Vectors of different length are never compared. An empty table gives
no rows.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import stored
from reviewlens.llm.vectors import cosine, matrix, unit, usable

TABLES = 2
HASHES = 3
WIDTH = 2.0
PROBES = 16
SEED = 7
#: Candidates and queries of a cell that meet in one group.
BLOCK = 1024
QUERY_BLOCK = 512
#: Cells whose list is broadcast, some 2 MB.
FEW = 50_000


def projections(rows: np.ndarray, table: int) -> np.ndarray:
    """Position of each unit row on the axes of a table, in cells."""
    rng = np.random.default_rng([SEED, table, rows.shape[1]])
    axes, shift = rng.normal(size=(rows.shape[1], HASHES)), rng.uniform(0, WIDTH, HASHES)
    return (rows @ axes + shift) / WIDTH


def probes(position: np.ndarray, number: int) -> np.ndarray:
    """The cells to visit for each row, likeliest first: [rows, number, hashes]."""
    cell = np.floor(position)
    inside = position - cell
    steps = np.array(list(product((-2, -1, 0, 1, 2), repeat=position.shape[1])))
    score = np.zeros((len(position), len(steps)))
    for axis in range(position.shape[1]):
        step = steps[:, axis]
        down, up = inside[:, axis, None] - step - 1, step - inside[:, axis, None]
        score += np.where(step == 0, 0.0, np.where(step < 0, down, up)) ** 2
    best = np.argsort(score, axis=1, kind="stable")[:, :number]
    return cell[:, None, :].astype(np.int64) + steps[best]


def cell_number(cells: np.ndarray) -> np.ndarray:
    """One number per cell; 21 bits an axis."""
    number = np.zeros(cells.shape[:-1], np.int64)
    for axis in range(cells.shape[-1]):
        number = (number << 21) | (cells[..., axis] & 0x1FFFFF)
    return number


def _cells(vectors: DataFrame, number: int) -> DataFrame:
    """(table, cell, key, id, size, vec) of each vector: its own cell, or the first ``number``."""

    def run(stream):
        for batch in stream:
            for size in np.unique(batch["size"].to_numpy()):
                rows = batch.filter(pa.array(batch["size"].to_numpy() == size))
                for first in range(0, rows.num_rows, 1024):
                    some = rows.slice(first, 1024)
                    scaled = unit(matrix(some["vec"]))
                    for table in range(TABLES):
                        cells = cell_number(probes(projections(scaled, table), number))
                        at = np.repeat(np.arange(len(scaled)), cells.shape[1])
                        where = [pa.array(np.full(len(at), table, np.int32)), pa.array(cells.ravel())]
                        yield pa.RecordBatch.from_arrays(
                            where + [some[n].take(pa.array(at)) for n in ("key", "id", "size", "vec")], names=["table", "cell", "key", "id", "size", "vec"]
                        )

    return vectors.select("key", "id", "size", "vec").mapInArrow(run, "table int, cell long, key long, id long, size int, vec array<double>")


def _met(asked: DataFrame, offered: DataFrame, k: int, few: int = FEW) -> DataFrame:
    """(query, query_id, key, vec_id, score): of each query the k nearest in each group it meets.

    Within a cell, blocks of queries meet blocks of candidates; a group holds at most one of each,
    so a cell with a third of all vectors is dealt over many groups. The list of cells that are
    asked for goes to every task up to ``few`` of them, so no cell gathers in one task before.
    """
    keys = ["table", "cell", "size"]
    n_asked = asked.groupBy(*keys).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    n_offered = offered.groupBy(*keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    grid = stored(n_asked.join(n_offered, keys), "cells")
    if grid.count() <= few:
        grid = F.broadcast(grid)

    def placed(side: DataFrame, own: str, other: str, query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("key"), F.col(own)).cast("int")
        met = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        dealt = side.join(grid, keys).select(*keys, "key", "id", "vec", block.alias("a"), met.alias("b"))
        low, high = ("a", "b") if query else ("b", "a")
        return dealt.select(*keys, F.col(low).alias("query_block"), F.col(high).alias("block"), F.lit(query).alias("asks"), "key", "id", "vec")

    together = placed(asked, "query_blocks", "blocks", True).unionByName(placed(offered, "blocks", "query_blocks", False))

    def best(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy(zero_copy_only=False)
        queries, others = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
        one = two = np.zeros(0, np.int64)
        score = np.zeros(0)
        if queries.num_rows and others.num_rows:
            q, c = matrix(queries["vec"]), matrix(others["vec"])
            own, key = queries["key"].to_numpy(), others["key"].to_numpy()
            names = others["id"].fill_null(np.iinfo(np.int64).max).to_numpy()
            rough = unit(q) @ unit(c).T
            rough[own[:, None] == key[None, :]] = -2
            kth = -np.partition(-rough, min(k, len(key)) - 1, axis=1)[:, min(k, len(key)) - 1]
            # All within rounding of the k-th are measured exactly; of equal ones the smaller ids stay.
            one, two = np.nonzero((rough >= kth[:, None] - 1e-9) & (rough > -2))
            score = cosine(q[one], c[two])
            order = np.lexsort((key[two], names[two], -score, one))
            one, two, score = one[order], two[order], score[order]
            kept = np.arange(len(one)) - np.searchsorted(one, one) < k
            one, two, score = one[kept], two[kept], score[kept]
        one, two = pa.array(one), pa.array(two)
        columns = [queries["key"].take(one), queries["id"].take(one), others["key"].take(two), others["id"].take(two), pa.array(score, pa.float64())]
        return pa.table(columns, names=["query", "query_id", "key", "vec_id", "score"])

    return together.groupBy(*keys, "query_block", "block").applyInArrow(best, "query long, query_id long, key long, vec_id long, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 5, number: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that ``is_query`` holds for.

    Queries whose cells hold fewer than k candidates meet all rows, in blocks.
    """
    vec = F.col("vec").cast("array<double>")
    named = vectors.where(usable()).select(
        F.monotonically_increasing_id().alias("key"),
        F.col("vec_id").cast("long").alias("id"),
        F.size("embedding").alias("size"),
        F.col("embedding").alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = stored(named, "vectors").withColumn("vec", vec)
    found = _met(_cells(rows.where("asks"), number), _cells(rows, 1), k)
    found = stored(found.groupBy("query", "query_id", "key", "vec_id").agg(F.max("score").alias("score")), "found")
    enough = found.groupBy("query").count().where(F.col("count") >= k).select(F.col("query").alias("key"))
    short = stored(rows.where("asks").drop("asks").join(enough, "key", "left_anti"), "short")
    if not short.isEmpty():
        one = {"table": F.lit(-1), "cell": F.lit(0).cast("long")}
        whole = _met(short.withColumns(one), rows.drop("asks").withColumns(one), k)
        found = found.join(short.select(F.col("key").alias("query")), "query", "left_anti").unionByName(whole)
        found = found.groupBy("query", "query_id", "key", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
