"""Landed API pages: JSON lines, one folder per request shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from prflow import schemas

_CORRUPT = "_corrupt_record"

# Why a page was accepted or not.
ACCEPTED = "accepted"
ERRORS = "errors"
OTHER = "other"


# Columns of where a parsed page lies: its file and the row in it.
PLACE = ("page_file", "page_row")


def with_place(pages: DataFrame) -> DataFrame:
    """Pages read from parquet, with the columns of ``PLACE``."""
    place = zip(("file_path", "row_index"), PLACE)
    return pages.select(*pages.columns, *[F.col(f"_metadata.{c}").alias(p) for c, p in place])


def page_folder(landing: str, shape: str) -> str:
    return f"{landing.rstrip('/')}/{shape}"


def classify_pages(pages: DataFrame) -> DataFrame:
    """Add ``outcome``: a page with data is accepted, also if it has errors
    beside; without data it failed, with or without the API saying why."""
    return pages.withColumn(
        "outcome",
        F.when(F.col("body.data").isNotNull(), F.lit(ACCEPTED))
        .when(F.col("body.errors").isNotNull(), F.lit(ERRORS))
        .otherwise(F.lit(OTHER)),
    )


def parse_pages(lines: DataFrame, shape: str, column: str = "value") -> DataFrame:
    """Pages from a text column; a malformed line has no body, so it fails as
    ``other`` when classified."""
    return lines.select(
        "*", F.from_json(F.col(column), schemas.page_schema(shape)).alias("_page")
    ).select(*lines.columns, "_page.*")


def read_pages(spark: SparkSession, landing: str, shape: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, failed) pages of one shape. Only this shape's folder is
    listed and read; the schema is given, so nothing is inferred."""
    pages = classify_pages(
        spark.read.schema(schemas.page_schema(shape, _CORRUPT))
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(page_folder(landing, shape))
    )
    accepted = pages.filter(F.col("outcome") == ACCEPTED).drop("outcome", _CORRUPT)
    failed = pages.filter(F.col("outcome") != ACCEPTED)
    return accepted, failed


def landed_schema(shape: str) -> StructType:
    """Parsed pages with their outcome and the file they came from."""
    more = [StructField("outcome", StringType()), StructField("landed_file", StringType())]
    return StructType([*schemas.page_schema(shape).fields, *more])


def landed_files(spark: SparkSession, landing: str, shape: str) -> DataFrame:
    """(path) of the landed files of a shape; they are listed, not read."""
    try:
        files = spark.read.format("binaryFile").load(page_folder(landing, shape))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")
    return files.select("path")


def parse_files(spark: SparkSession, shape: str, paths: Sequence[str]) -> DataFrame:
    """Pages of some landed files, failed ones too, in ``landed_schema``. Parsed
    once: later jobs read only the nested fields they use (nested column
    pruning works on parquet, not on JSON)."""
    lines = spark.read.schema(schemas.page_schema(shape)).json(list(paths))
    return classify_pages(lines.withColumn("landed_file", F.col("_metadata.file_path"))).select(
        *landed_schema(shape).names
    )


def land_as_parquet(spark: SparkSession, landing: str, shape: str, out: str) -> None:
    """Convert accepted pages once, for runs with ``parquet_pages=True``."""
    accepted, _ = read_pages(spark, landing, shape)
    accepted.write.mode("overwrite").parquet(page_folder(out, shape))


def read_parquet_pages(spark: SparkSession, folder: str, shape: str) -> DataFrame:
    return spark.read.schema(schemas.page_schema(shape)).parquet(page_folder(folder, shape))
