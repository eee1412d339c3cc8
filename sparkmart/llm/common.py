"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.sources.staging import new_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read again: cuts lineage, fixes row numbers."""
    spark, schema = df.sparkSession, df.schema
    path = new_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Adds a row number without order or shuffle; write the frame before using the number twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have; Spark's names ignore case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def group_count(rows: int, each: int) -> int:
    """Groups of about ``each`` rows."""
    return max(1, -(-rows // each))


def ascii_lower(text: Column) -> Column:
    """Lower case of A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
