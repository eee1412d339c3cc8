"""Validation after a load: counts and integrity of the gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.schema import DIMS, DimSpec


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows); each count reads no column of its table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def dq_date_id(sales: DataFrame) -> DataFrame:
    """Date_IDs that stand for more than one calendar day.

    Distinct days first, as a hash aggregate, so a hot Date_ID is a few rows when counted.
    """
    return (
        sales.select("Date_ID", "Day", "Month", "Year")
        .distinct()
        .groupBy("Date_ID")
        .agg(F.count(F.lit(1)).alias("n_days"))
        .filter(F.col("n_days") > 1)
    )


def _dim_integrity(dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Counters of one dimension: rows, NULLs and repeating rows, both sides of the key."""

    def repeated(column: str) -> DataFrame:
        per_value = dim.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col(column).isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
            F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("n") - 1)), F.lit(0)).alias("n_repeated"),
        ).select(
            F.lit(spec.name).alias("dim_name"), F.lit(column).alias("column_name"),
            "n_rows", "n_null", "n_repeated",
        )

    return repeated(spec.sk).unionByName(repeated(spec.nk))


def dq_key_integrity(dims: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension key column: rows, NULLs and rows beyond the first of their value."""
    return reduce(
        DataFrame.unionByName, [_dim_integrity(dims[s.name], s) for s in DIMS if s.name in dims]
    )


def dq_fact_totals(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows and measure sums of silver and of the row-level fact; both lines must agree."""

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("Revenue").alias("Revenue"),
            F.sum("Units_Sold").alias("Units_Sold"),
        ).select(F.lit(name).alias("table_name"), "n_rows", "Revenue", "Units_Sold")

    return totals(silver, "silver").unionByName(totals(fact, "fact_sales"))


def dq_unmatched(fact: DataFrame) -> DataFrame:
    """Fact rows in all and rows without key, per dimension."""
    specs = [s for s in DIMS if s.sk in fact.columns]
    counters = [F.count_if(F.col(s.sk).isNull()).alias(s.sk) for s in specs]
    rows = [
        F.struct(F.lit(s.name).alias("dim_name"), F.col("n_rows"), F.col(s.sk).alias("n_unmatched"))
        for s in specs
    ]
    return fact.agg(F.count(F.lit(1)).alias("n_rows"), *counters).select(F.inline(F.array(*rows)))
