"""Sales records derived from the star-benchmark tables (lineitem, orders, part, supplier).

A sale is one lineitem row. Orders, part and supplier are unique on their key and
joined from the left, so a query that needs no column of a table skips its join and
still sees every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.schema import BRONZE_COLUMNS

EPOCH = "1995-01-01"  # Date_ID DT00001


def _code(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded code; longer numbers keep all their digits (plain lpad would cut them)."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def _columns() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Canonical column -> (expression, tables it needs besides lineitem)."""
    day = F.to_date("o_orderdate")
    ordinal = F.datediff(day, F.lit(EPOCH).cast("date")) + 1
    model = F.concat(F.substring("p_type", 1, 3), F.lit("-M"), F.col("p_size").cast("string"))
    return {
        "Branch_ID": (_code("BR", F.col("l_suppkey"), 4), ()),
        "Dealer_ID": (_code("DLR", F.col("o_custkey"), 6), ("orders",)),
        "Model_ID": (model, ("part",)),
        "Revenue": (F.floor("l_extendedprice").cast("bigint"), ()),
        "Units_Sold": (F.col("l_quantity").cast("bigint"), ()),
        "Date_ID": (_code("DT", ordinal, 5), ("orders",)),
        "Day": (F.dayofmonth(day).cast("smallint"), ("orders",)),
        "Month": (F.month(day).cast("smallint"), ("orders",)),
        "Year": (F.year(day).cast("smallint"), ("orders",)),
        "Branch_Name": (F.col("s_name"), ("supplier",)),
        "Product_Name": (F.col("p_name"), ("part",)),
        # plain source attributes, for feeds that carry dirty values
        "l_returnflag": (F.col("l_returnflag"), ()),
        "l_linestatus": (F.col("l_linestatus"), ()),
        "l_shipdate": (F.col("l_shipdate"), ()),
        "o_orderstatus": (F.col("o_orderstatus"), ("orders",)),
        "o_orderpriority": (F.col("o_orderpriority"), ("orders",)),
        "p_type": (F.col("p_type"), ("part",)),
    }


_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
}


def sales(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = BRONZE_COLUMNS
) -> DataFrame:
    """The requested columns of every sale, in bronze types."""
    known = _columns()
    needed = {table for c in columns for table in known[c][1]}
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for table, (left, right) in _JOINS.items():
        if table in needed:
            other = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            df = df.join(other, F.col(left) == F.col(right), "left")
    return df.select([known[c][0].alias(c) for c in columns])
