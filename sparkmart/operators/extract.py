"""High-water-mark extraction on Date_ID (a batch bound, not an event-time watermark)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current_max(source: DataFrame) -> DataFrame:
    """One row ``max_date``: the newest Date_ID in the source, NULL when empty."""
    return source.agg(F.max("Date_ID").alias("max_date"))


def current_max_above(source: DataFrame, lo: str) -> DataFrame:
    """The same above a bound, NULL when nothing is newer.

    The bound lets the scan skip all row groups that earlier extracts have covered.
    """
    return current_max(source.filter(F.col("Date_ID") > F.lit(lo)))


def open_rows(source: DataFrame, lo: str) -> DataFrame:
    """``current_max_above`` with ``n_rows`` above the bound and ``n_tasks``, over how many tasks in a row they lie."""
    above = source.filter(F.col("Date_ID") > F.lit(lo)).select("Date_ID", F.spark_partition_id().alias("task"))
    return above.agg(
        F.max("Date_ID").alias("max_date"), F.count(F.lit(1)).alias("n_rows"), (F.max("task") - F.min("task") + 1).alias("n_tasks")
    )


def window(source: DataFrame, lo: str | Column, hi: str | Column | None) -> DataFrame:
    """Rows with ``lo < Date_ID <= hi``. Literal bounds reach the Parquet scan.

    Without an upper bound the source was empty, so nothing is extracted.
    """
    lower = F.lit(lo) if isinstance(lo, str) else lo
    upper = hi if isinstance(hi, Column) else F.lit(hi).cast("string")
    return source.filter((F.col("Date_ID") > lower) & (F.col("Date_ID") <= upper))


def near_window(source: DataFrame, lo: str, hi: str | None = None) -> DataFrame:
    """A superset of the window over codes that blanks may surround; the bounds reach the scan.

    A leading blank sorts below "DT", a trailing one adds no more than the "!" behind it.
    """
    code = F.col("Date_ID")
    near = source.filter((code > F.lit(lo)) | (code < F.lit("DT")))
    return near if hi is None else near.filter(code < F.lit(hi + "!"))


def bound_of(position: str) -> str:
    """The date bound of a position: what a load reached, behind which loads of late rows count up."""
    return position.partition(".")[0]


def next_position(position: str, newest: str) -> str:
    """The position after a load: its newest Date_ID, or one more at the same bound."""
    bound, _, count = position.partition(".")
    return newest if newest > bound else f"{bound}.{int(count or 0) + 1:06d}"


def last_load(state: DataFrame) -> str:
    """The stored bound (the state table holds one row); '' before the first load."""
    row = state.first()
    return (row and row["last_load"]) or ""


def advance(state: DataFrame, current: DataFrame) -> DataFrame:
    """New one-row state: never moves back, unchanged when the source is empty."""
    newest = state.select("last_load").unionByName(
        current.select(F.col("max_date").alias("last_load"))
    )
    return newest.agg(F.max("last_load").alias("last_load"))


def late_rows(landed: DataFrame, lo: str, by: Sequence[str] = ()) -> DataFrame:
    """Count of newly landed rows that the strict lower bound will never extract.

    ``by`` counts per group, e.g. per landed file.
    """
    late = F.col("Date_ID").isNotNull() & (F.col("Date_ID") <= F.lit(lo))
    return landed.groupBy(*by).agg(F.count_if(late).alias("late_rows"))
