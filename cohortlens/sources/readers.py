"""Sources. A missing path raises Spark's PATH_NOT_FOUND AnalysisException at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, types as T


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A parquet table stored as ``root/name.parquet`` (one file or a directory of parts)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{name}.parquet")


def load_tables(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, root, name) for name in names}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header row and declared types (nothing is re-inferred); an empty field is NULL."""
    return spark.read.schema(schema).options(header=True, escape='"', mode="FAILFAST").csv(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; give ``split_on`` and its value range to read it in parallel slices."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if split_on is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of the split column")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()
