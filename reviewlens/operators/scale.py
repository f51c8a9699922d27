"""Helpers that keep jobs safe at scale: lineage cuts, checked broadcasts, hot-key splitting."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Narrow rows (an id and a few numbers) up to this count are some tens of megabytes.
BROADCAST_ROWS = 500_000


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the session names in ``spark.checkpoint.dir``.

    Only a session within one process may go without one; it then gets a folder that is removed
    when the process ends. The session's settings are never changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _own_folder()
    return folder


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="reviewlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there.

    A lost executor then costs one step of a loop, not the loop; and unlike other ways to cut
    lineage a written table has a known size, so small states are joined without a shuffle.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/reviewlens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow frame for broadcast after counting that it is small enough.

    Beyond the bound the frame is returned as it is and Spark shuffles the join. Worth one
    narrow scan where the other side is the review table, which then needs no shuffle at all. The
    count is a sum of the tasks' counts; no rows are gathered for it.
    """
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


def width_for(df: DataFrame, rows_each: int = 1_000_000) -> int:
    """Partition count for a layout that loops keep: by the measured size of the frame, and at
    least the session's. Given to ``repartition`` it keeps adaptive execution from merging
    partitions, so joins and groups on the same key need no exchange. Meant for written tables,
    whose count is read from their footers."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows_each))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("group_rows"))


def apart_by_size(df: DataFrame, key: str, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of groups beyond the limit if there are any.

    Both halves get the same computation, the second spread by a finer key, so a group that
    holds a third of all rows is not bound to one task. The list of large groups is written
    out: it has a row per ``limit`` rows at most, and Spark broadcasts it if it is small.
    """
    large = group_sizes(df, key).where(F.col("group_rows") > limit).select(key)
    large = cut_lineage(large)
    if large.isEmpty():
        return df, None
    return df.join(large, key, "left_anti"), df.join(large, key, "left_semi")


def split_hot_groups(
    df: DataFrame, key: str, spread_by: list[str], target_rows: int = 50_000
) -> DataFrame:
    """Add ``part`` and ``parts``: groups beyond the target are dealt over several parts.

    Work keyed by (key, part) then has bounded pieces even if one key holds most rows. Ordinary
    groups keep the single part 0.
    """
    sizes = group_sizes(df, key).select(
        key, F.ceil(F.col("group_rows") / target_rows).cast("int").alias("parts")
    )
    return df.join(sizes, key).withColumn(
        "part", F.pmod(F.xxhash64(*spread_by), F.col("parts")).cast("int")
    )
