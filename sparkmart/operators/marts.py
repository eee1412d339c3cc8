"""Analytics on the star: aggregate the fact by surrogate key first, then join.

The fact never meets a dimension row by row: partial sums shrink it before the only
shuffle, and a hot member is one row per map task by then. The joins are left joins,
so sales without a member stay in the report under NULL and totals are whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions import revenue_per_unit
from sparkmart.schema import DIM_BRANCH, DIM_DATE, DIM_DEALER, DIM_MODEL, DimSpec


def _totals(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys).agg(
        F.sum("Revenue").alias("Revenue"),
        F.sum("Units_Sold").alias("Units_Sold"),
        F.count(F.lit(1)).alias("n_sales"),
    )


def member_performance(fact: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Revenue, units, sales and revenue per unit of each member."""
    return (
        _totals(fact, spec.sk)
        .join(dim, spec.sk, "left")
        .select(
            *spec.member_columns,
            "Revenue",
            "Units_Sold",
            "n_sales",
            revenue_per_unit().alias("revenue_per_unit"),
        )
    )


def dealer_performance(fact: DataFrame, dim_dealer: DataFrame) -> DataFrame:
    return member_performance(fact, dim_dealer, DIM_DEALER)


def branch_performance(fact: DataFrame, dim_branch: DataFrame) -> DataFrame:
    return member_performance(fact, dim_branch, DIM_BRANCH)


def model_trend(fact: DataFrame, dim_model: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue and units by model category and month."""
    by_keys = fact.groupBy(DIM_MODEL.sk, DIM_DATE.sk).agg(
        F.sum("Revenue").alias("Revenue"), F.sum("Units_Sold").alias("Units_Sold")
    )
    return (
        by_keys.join(dim_model, DIM_MODEL.sk, "left")
        .join(dim_date, DIM_DATE.sk, "left")
        .groupBy("model_category", "Year", "Month")
        .agg(F.sum("Revenue").alias("Revenue"), F.sum("Units_Sold").alias("Units_Sold"))
    )


def revenue_growth(fact: DataFrame, dim_branch: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Yearly revenue per branch, the year before (NULL without sales then), and the relative change.

    The window runs over a handful of years per branch, after all aggregation.
    """
    by_keys = fact.groupBy(DIM_BRANCH.sk, DIM_DATE.sk).agg(F.sum("Revenue").alias("Revenue"))
    yearly = (
        by_keys.join(dim_date.select(DIM_DATE.sk, "Year"), DIM_DATE.sk, "left")
        .groupBy(DIM_BRANCH.sk, "Year")
        .agg(F.sum("Revenue").alias("Revenue"))
        .join(dim_branch, DIM_BRANCH.sk, "left")
    )
    by_year = Window.partitionBy("Branch_ID").orderBy("Year")
    previous = F.when(F.lag("Year").over(by_year) == F.col("Year") - 1, F.lag("Revenue").over(by_year))
    change = F.try_divide(F.col("Revenue") - F.col("previous_revenue"), F.col("previous_revenue"))
    return (
        yearly.withColumn("previous_revenue", previous)
        .withColumn("growth", change)
        .select("Branch_ID", "Branch_Name", "Year", "Revenue", "previous_revenue", "growth")
    )
