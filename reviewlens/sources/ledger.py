"""Tables read from text with a ledger of the lines that do not fit.

A reader with a declared schema gives a broken line as a row of nulls, which later sums cannot tell
from data. Here a table is taken in by one scan that parts the lines: good rows go to Parquet, bad
lines keep their text and file, and both are counted while they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Ledger:
    """``good`` has the schema's columns; ``bad`` has ``file`` and ``line``; counts are of rows."""

    good: DataFrame
    bad: DataFrame
    good_rows: int
    bad_rows: int

    def check(self, most: float = 0.0) -> Ledger:
        """The ledger, or a failure where bad lines are more than a share of all lines."""
        total = self.good_rows + self.bad_rows
        if self.bad_rows > most * total:
            raise ValueError(f"{self.bad_rows} of {total} lines do not fit the schema")
        return self


def take_in(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    format: str = "json",
    mode: str = "errorifexists",
    **options: str,
) -> Ledger:
    """Read JSON lines or CSV under ``source`` once and write them under ``target``.

    A line is bad where it cannot be parsed, where a value has another type than declared or, in
    CSV, where it has another number of fields. Blank lines are no lines; a missing JSON field is null
    and good. An empty source gives two empty tables. No column of the schema may have the name of
    the corrupt text's column or of the layout's own.
    """
    taken = {CORRUPT, "is_bad", "file"}.intersection(schema.names)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the ledger's own")
    read_as = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    lines = (
        spark.read.format(format)
        .options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .schema(read_as)
        .load(source)
    )
    is_bad = F.col(CORRUPT).isNotNull()
    # What could be parsed of a bad line is left out: its text is kept whole.
    parted = lines.select(
        *(F.when(~is_bad, F.col(f"`{name}`")).alias(name) for name in schema.names),
        CORRUPT,
        F.when(is_bad, F.col("_metadata.file_path")).alias("file"),
        is_bad.alias("is_bad"),
    )
    counts = Observation()
    counted = parted.observe(
        counts, F.count_if(~is_bad).alias("good_rows"), F.count_if(is_bad).alias("bad_rows")
    )
    counted.write.mode(mode).partitionBy("is_bad").parquet(target)
    found = counts.get
    return opened(spark, target, schema, found["good_rows"], found["bad_rows"])


def opened(
    spark: SparkSession, target: str, schema: StructType, good_rows: int, bad_rows: int
) -> Ledger:
    """The two tables of a target; either reads its own folder only."""
    laid = StructType(
        [
            *schema.fields,
            StructField(CORRUPT, StringType(), True),
            StructField("file", StringType(), True),
        ]
    )
    rows = spark.read.schema(laid.add("is_bad", "boolean")).parquet(target)
    good = rows.where(~F.col("is_bad")).select(*(F.col(f"`{name}`") for name in schema.names))
    bad = rows.where("is_bad").select("file", F.col(CORRUPT).alias("line"))
    return Ledger(good, bad, good_rows, bad_rows)
