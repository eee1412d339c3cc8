"""Readers: delimited text, Parquet folders, SQL over a path, catalog and JDBC tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkmart.schema import RAW

# Header row, comma, double quote, backslash escape.
CSV_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": "\\", "enforceSchema": "false"}


def read_raw_sales(
    spark: SparkSession, path: str, multi_line: bool = False, corrupt: str | None = None
) -> DataFrame:
    """Delimited sales file(s), all twelve columns as text.

    ``corrupt`` names one more column: the text of rows that do not have twelve fields.

    With ``enforceSchema`` off a file whose header differs is an error, not shifted data.
    ``multi_line`` allows line breaks inside quotes, but then a file is one task.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line)
    if corrupt is None:
        return reader.schema(RAW).csv(path)
    return reader.option("columnNameOfCorruptRecord", corrupt).schema(with_corrupt(corrupt)).csv(path)


def layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by the column names of their header lines; only first splits are read."""
    lines = spark.read.option("lineSep", "\n").text(path).filter(F.col("_metadata.file_block_start") == 0)
    heads = lines.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place"), "value")
    first = F.regexp_replace(F.min_by("value", "place"), '[\r"\ufeff]', "")
    names = F.transform(F.split(first, CSV_OPTIONS["sep"], -1), F.trim)
    found: dict[tuple[str, ...], list[str]] = {}
    for row in heads.groupBy("file").agg(names.alias("names")).collect():
        found.setdefault(tuple(row["names"]), []).append(row["file"])
    return found


def read_raw_by_name(spark: SparkSession, path: str, corrupt: str) -> DataFrame:
    """Like ``read_raw_sales`` with ``corrupt``, each file's columns taken by the names in its header.

    Files of one layout are one scan. Other columns than the twelve are dropped; a missing or repeated one is an error.
    Adds ``source_path``.
    """
    scans = None
    for names, files in sorted(layouts(spark, path).items()):
        if any(names.count(c) != 1 for c in RAW.names) or len(set(names)) < len(names):
            raise ValueError(f"header without one column each of {', '.join(RAW.names)}: {files[0]}")
        layout = StructType([*[StructField(n, StringType()) for n in names], StructField(corrupt, StringType())])
        reader = spark.read.options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", corrupt).schema(layout)
        scan = reader.csv(sorted(files)).select(*RAW.names, corrupt, F.col("_metadata.file_path").alias("source_path"))
        scans = scan if scans is None else scans.unionByName(scan)
    if scans is None:
        return empty_table(spark, StructType([*with_corrupt(corrupt), StructField("source_path", StringType())]))
    return scans


def with_corrupt(name: str) -> StructType:
    """The raw layout and a column for rows that do not fit it."""
    return StructType([*RAW.fields, StructField(name, StringType())])


def with_source(raw: DataFrame) -> DataFrame:
    """Adds the full path of the file each row came from, and a folder name made of it."""
    path = F.col("_metadata.file_path")
    return raw.withColumns({"source_path": path, "source_file": F.md5(path.cast("binary"))})


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All Parquet files below ``path``; a given schema saves the inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_path_sql(spark: SparkSession, path: str, columns: str = "*") -> DataFrame:
    """``SELECT columns FROM parquet.`path```."""
    return spark.sql(f"SELECT {columns} FROM parquet.`{path}`")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog."""
    return spark.table(name)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of a schema. The constant filter lets Catalyst drop joins with it."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select([F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def table_or_empty(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """The catalog table when it exists, else an empty relation of that schema."""
    if spark.catalog.tableExists(name):
        return spark.table(name).select(*schema.names)
    return empty_table(spark, schema)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split: tuple[str, str, str, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table; ``split`` = (column, lower, upper, partitions) reads in parallel.

    The bounds only place the splits; rows outside them are read too. Filters on the
    result, such as the extract window, are pushed to the database.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    if split is not None:
        column, lower, upper, partitions = split
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()
