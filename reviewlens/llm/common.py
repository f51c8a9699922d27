"""What several operators share: tables, stored steps, held-out rows, word chunks, components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, one beside the warehouse, which
    only a session within one process may do."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not named and not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_steps"


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str = "step") -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends there, and a lost
    executor costs a step, not the job."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str | Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 2 when divided by 4."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def batches(table_or_batch, rows: int = 512):
    """Slices of an Arrow batch, so that what a task builds for a batch stays small."""
    for start in range(0, table_or_batch.num_rows, rows):
        yield table_or_batch.slice(start, rows)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[start:start + length]`` over all pairs."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return values[index]


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of n positions over the given links (arrays)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        root = np.minimum(root, root[root])
        if np.array_equal(before, root):
            return root


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component_id): the smallest id reachable over ``links`` (left, right), itself included.

    Contraction: each round every linked node joins the smallest of its neighbours and itself in a
    pseudo-random order, so the number of nodes shrinks by a constant factor; links become links of
    the joined nodes, equal ones merge. A group's rows meet only in joins (split when skewed) and
    in minima, which are formed before the shuffle. Links must name ids of ``nodes``.
    """

    def tagged(column: str) -> Column:
        return F.struct(F.xxhash64(column).alias("order"), F.col(column).alias("id"))

    left = stored(links.where("left <> right").select("left", "right").distinct(), "links")
    steps = []
    while not left.isEmpty():
        both = left.union(left.select(F.col("right"), F.col("left"))).toDF("id", "near")
        parent = stored(
            both.groupBy("id")
            .agg(F.min(tagged("near")).alias("near"))
            .select("id", F.least(tagged("id"), F.col("near"))["id"].alias("parent")),
            "parents",
        )
        steps.append(parent)
        one = parent.toDF("left", "left_parent")
        two = parent.toDF("right", "right_parent")
        left = stored(
            left.join(one, "left")
            .join(two, "right")
            .where("left_parent <> right_parent")
            .select(
                F.least("left_parent", "right_parent").alias("left"),
                F.greatest("left_parent", "right_parent").alias("right"),
            )
            .distinct(),
            "links",
        )
    if not steps:
        return nodes.select("id", F.col("id").alias("component_id"))
    found = steps[0]
    for step in steps[1:]:
        found = found.join(step.toDF("parent", "next"), "parent", "left").select(
            "id", F.coalesce("next", "parent").alias("parent")
        )
    found = stored(found, "roots")
    smallest = found.groupBy("parent").agg(F.min("id").alias("component_id"))
    linked = found.join(smallest, "parent").select("id", "component_id")
    return nodes.select("id").join(linked, "id", "left").select(
        "id", F.coalesce("component_id", "id").alias("component_id")
    )
