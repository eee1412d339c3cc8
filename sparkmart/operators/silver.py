"""Cleaned layer: two derived columns, the null policy and the yearly report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions import blank_to_null, model_category, revenue_per_unit
from sparkmart.schema import NATURAL_KEYS


def enrich(bronze: DataFrame) -> DataFrame:
    """Adds ``model_category`` and ``revenue_per_unit``; row-local, no shuffle."""
    return bronze.withColumns(
        {"model_category": model_category(), "revenue_per_unit": revenue_per_unit()}
    )


def standardise(bronze: DataFrame) -> DataFrame:
    """Trims the natural keys and turns blank ones into NULL; measures stay as they are."""
    return bronze.withColumns({c: blank_to_null(c) for c in NATURAL_KEYS if c in bronze.columns})


def null_report(bronze: DataFrame) -> DataFrame:
    """Per natural key: rows in all, rows without value, rows with blank text.

    All counters come from one aggregate over one scan.
    """
    counters = [F.count(F.lit(1)).alias("n_rows")]
    for c in NATURAL_KEYS:
        counters.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
        counters.append(F.count_if(F.trim(F.col(c)) == "").alias(f"{c}_blank"))
    per_column = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n_rows"),
            F.col(f"{c}_null").alias("n_null"),
            F.col(f"{c}_blank").alias("n_blank"),
        )
        for c in NATURAL_KEYS
    ]
    return bronze.agg(*counters).select(F.inline(F.array(*per_column)))


def units_by_year_branch(silver: DataFrame) -> DataFrame:
    """Units per year and branch name, years ascending, best branch first."""
    return (
        silver.groupBy("Year", "Branch_Name")
        .agg(F.sum("Units_Sold").alias("Total_Units_Sold"))
        .orderBy(F.asc("Year"), F.desc("Total_Units_Sold"), F.asc("Branch_Name"))
    )
