"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark.operators.cleaning import markers_to_null, nan_to_null

# Text cells that mean "missing".
MISSING_MARKERS = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar table with NaN turned into NULL."""
    return nan_to_null(spark.read.parquet(path))


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Delimited text with a header, quoted cells and a declared schema.

    Columns are found by their names in the header, in any order; further ones are left out.
    A declared column that the header lacks is an error, and so is a file of the set whose
    header differs from the first one's. A cell that does not parse is missing.
    """
    return _typed(_text_table(spark, path), schema)


def _text_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def _typed(raw: DataFrame, schema: StructType, *extra: Column) -> DataFrame:
    cells = markers_to_null(raw.select(*[F.col(f"`{f.name}`") for f in schema], *extra), MISSING_MARKERS, schema.names)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema if not isinstance(f.dataType, StringType)}
    return nan_to_null(cells.withColumns(typed) if typed else cells)


def read_per_entity(
    spark: SparkSession, pattern: str, schema: StructType, entity: str = "plant",
    number: str = r"Plant_(\d+)_[^/]*",
) -> DataFrame:
    """All files of a set that holds one file per entity, as one table.

    The entity number is taken from the file or folder name, so that per-entity work
    becomes a grouping column and not a loop over files.
    """
    found = F.regexp_extract(F.col("_metadata.file_path"), number, 1)
    return _typed(_text_table(spark, pattern), schema, found.cast("int").alias(entity))


def read_sql(spark: SparkSession, query: str, views: dict[str, DataFrame]) -> DataFrame:
    """A SQL string over the given tables; only the columns and rows it asks for are read."""
    return spark.sql(query, **views)


def read_database(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Full table of a database; pass ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions`` to read it in parallel."""
    return nan_to_null(
        spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    )


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Overwrite a folder of delimited text files with a header; blanks are kept. Compressed ones
    (``gzip``) are read like others, a file in one task."""
    writer = df.write.mode("overwrite").option("header", True)
    if compression:
        writer = writer.options(**{"compression": compression, "zlib.compress.level": "BEST_SPEED"})
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None
) -> None:
    writer = df.write.mode("overwrite")
    writer = writer.option("compression", compression) if compression else writer
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def export_variants(df: DataFrame, root: str, variants: dict[str, Sequence[str]]) -> dict[str, str]:
    """Write one table in several projections: ``variants`` maps a name to the columns to drop.

    The rows are computed once, for the first variant that drops nothing (if any); the
    others are projections of that file.
    """
    paths = {name: f"{root}/{name}" for name in variants}
    whole = next((name for name, dropped in variants.items() if not dropped), None)
    source = df
    if whole is not None:
        write_parquet(df, paths[whole])
        source = df.sparkSession.read.schema(df.schema).parquet(paths[whole])
    for name, dropped in variants.items():
        if name != whole:
            write_parquet(source.drop(*dropped), paths[name])
    return paths
