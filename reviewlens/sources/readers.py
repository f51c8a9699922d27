"""Table readers with declared schemas: one scan per table and no inference pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlens import schemas
from reviewlens.functions.members import category_slug


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, format: str = "json"
) -> DataFrame:
    """Read JSON lines, Parquet or another Spark format. Without a schema JSON is inferred."""
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_business(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.BUSINESS, format)


def read_review(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.REVIEW, format)


def read_user(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.USER, format)


def read_checkin(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.CHECKIN, format)


def read_user_features(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.USER_FEATURES, format)


def read_centers(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.CENTERS, format)


def read_zip_centroids(spark: SparkSession, path: str, format: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.ZIP_CENTROIDS, format)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def file_position() -> Column:
    """Orderable place of a row in its file, also when the file is read in many splits."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_world_cities(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """City gazetteer; ``-`` and the empty string are null. Column ``position`` is file order.

    Every line is data unless ``header`` is set: a header line would read as a city that no
    business has, with null numbers.
    """
    raw = (
        spark.read.schema(schemas.WORLD_CITIES)
        .option("nullValue", "-")
        .option("header", header)
        .csv(path)
    )
    blank_free = {
        field.name: F.nullif(F.col(field.name), F.lit(""))
        for field in schemas.WORLD_CITIES
        if field.dataType.typeName() == "string"
    }
    return raw.withColumns({**blank_free, "position": file_position()})


def predictions_for_category(predictions: DataFrame, category: str) -> DataFrame:
    """Predictions of one category. On a table partitioned by category this is partition
    pruning; a category without predictions gives no rows rather than a failure."""
    return predictions.where(F.col("category") == category).select("user_id", "prediction")


def read_predictions(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Read a predictions table written by ``sinks.write_predictions``."""
    table = spark.read.parquet(path)
    return table if category is None else predictions_for_category(table, category)


def read_prediction_file(spark: SparkSession, folder: str, category: str) -> DataFrame:
    """Read the JSON predictions stored under the category's slug in a folder."""
    name = spark.range(1).select(category_slug(F.lit(category)).alias("slug"))
    slug = name.first()["slug"]
    return read_table(spark, f"{folder}/pred_{slug}.json", schemas.PREDICTIONS)
