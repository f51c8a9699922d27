"""Stored layouts that later jobs need no shuffle or no full scan for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions.curve import z_key
from reviewlens.operators.scale import width_for


def in_place_order(
    df: DataFrame, files: int | None = None, tie: str = "business_id"
) -> DataFrame:
    """Rows along the Z curve of their coordinates, in ranges of keys.

    Written so, a file and a row group cover a small box each, and the box test of a radius query
    skips all others by their statistics. The ranges are cut by a sample of the keys and the tie
    column, so places with one key are split too. Rows without coordinates come first.
    """
    key = z_key(F.col("latitude"), F.col("longitude"))
    order = [key, F.col(tie)]
    return df.repartitionByRange(files or width_for(df), *order).sortWithinPartitions(*order)


def write_in_place_order(
    df: DataFrame,
    path: str,
    files: int | None = None,
    group_bytes: int = 16 << 20,
    mode: str = "errorifexists",
) -> None:
    """Write a table of places in place order; small row groups cut the box of each."""
    ordered = in_place_order(df, files)
    ordered.write.mode(mode).option("parquet.block.size", group_bytes).parquet(path)


def write_bucketed(
    df: DataFrame,
    name: str,
    path: str,
    key: str = "user_id",
    buckets: int = 200,
    mode: str = "errorifexists",
) -> DataFrame:
    """Write a table in buckets of a key, sorted within each, and give it back as a table.

    Tables with one key and one number of buckets are joined and grouped on the key without an
    exchange. Rows are dealt by the bucket's own hash first, so a bucket is one file. A bucket
    is read by one task: keys with very many rows belong in a plain table beside it
    (``scale.apart_by_size``).
    """
    dealt = df.repartition(buckets, key)
    writer = dealt.write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(
    spark: SparkSession, name: str, path: str, schema: str, key: str = "user_id", buckets: int = 200
) -> DataFrame:
    """Name a folder written by ``write_bucketed`` in a session whose catalogue does not know it."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
