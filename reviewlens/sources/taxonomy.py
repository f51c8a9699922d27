"""Category taxonomy: one line per parent, the parent first and its sub-categories after it.

Two readings exist on purpose. Features give each sub-category one parent, the last line that
names it; ranking lets a sub-category belong to every parent that lists it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.sources.readers import file_position

# Commas outside double quotes.
_FIELD_BREAK = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def category_key(name: Column, normalize: bool = False) -> Column:
    """Form of a category name that is compared: as it is, or trimmed and lower-cased."""
    return F.lower(F.trim(name)) if normalize else name


def _fields(line: Column, literal_split: bool) -> Column:
    if literal_split:
        return F.split(F.rtrim(line), ",")
    bare = F.transform(
        F.split(line, _FIELD_BREAK), lambda field: F.trim(F.regexp_replace(field, '"', ""))
    )
    return F.filter(bare, lambda field: field != "")


def read_taxonomy(spark: SparkSession, path: str, literal_split: bool = False) -> DataFrame:
    """Rows (position, category, sub_category), the parent being a sub-category of itself.

    Quoted fields are read as one field, trimmed, empty ones dropped. ``literal_split`` instead
    cuts at every comma and keeps blanks and quote marks as they are.
    """
    lines = spark.read.text(path).select(
        file_position().alias("position"), _fields(F.col("value"), literal_split).alias("fields")
    )
    return lines.where(F.size("fields") > 0).select(
        "position",
        F.element_at("fields", 1).alias("category"),
        F.explode("fields").alias("sub_category"),
    )


def last_wins(taxonomy: DataFrame, normalize: bool = False) -> DataFrame:
    """One parent per sub-category: that of the last line naming it."""
    key = category_key(F.col("sub_category"), normalize)
    return taxonomy.groupBy(key.alias("sub_category")).agg(
        F.max_by("category", "position").alias("category")
    )


def membership(taxonomy: DataFrame, normalize: bool = False) -> DataFrame:
    """Distinct (category, sub_category): a sub-category may have several parents."""
    key = category_key(F.col("sub_category"), normalize)
    return taxonomy.select("category", key.alias("sub_category")).distinct()


def membership_arrays(taxonomy: DataFrame) -> DataFrame:
    """One row per parent with its sub-categories as an array, as long as one taxonomy line."""
    return taxonomy.groupBy("category").agg(
        F.array_sort(F.collect_set("sub_category")).alias("sub_category")
    )
