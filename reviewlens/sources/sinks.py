"""Writers. The default mode fails where the target exists; files stay as many as Spark has
partitions unless one file is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "errorifexists",
    partition_by: tuple[str, ...] = (),
    single_file: bool = False,
) -> None:
    """Write a table. ``single_file`` sends all rows through one task: small results only."""
    rows = df.coalesce(1) if single_file else df
    writer = rows.write.format(format).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_table(df, path, "json", mode)


def as_json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in a single text column ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def write_json_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_lines(as_json_lines(df), path, mode)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a one-column text table, one line per row."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("sep", "\t").csv(path)


def write_user_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Features laid out by category, the column every training job filters on."""
    write_table(df, path, mode=mode, partition_by=("category",))


def write_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Predictions of all categories as one table with a folder per category."""
    rows = df.select("user_id", "prediction", "category")
    write_table(rows, path, mode=mode, partition_by=("category",))


def write_centers(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Home areas as one array per user, in single precision as they are exchanged."""
    narrow = "array<struct<latitude:float,longitude:float>>"
    write_json(
        df.select(F.col("cluster_centers").cast(narrow).alias("cluster_centers"), "user_id"),
        path,
        mode,
    )
