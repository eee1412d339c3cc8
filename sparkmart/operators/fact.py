"""Fact rows: key lookup in the four dimensions, and the 4-key grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.upsert import upsert
from sparkmart.schema import DIMS, FACT_KEYS, MEASURES, DimSpec


def build_fact(
    silver: DataFrame,
    dims: Mapping[str, DataFrame],
    specs: Sequence[DimSpec] = DIMS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One fact row per silver row: measures and surrogate keys, NULL where unmatched.

    Pass dimensions that are read from storage: Spark then knows their size and
    broadcasts those below ``spark.sql.autoBroadcastJoinThreshold`` without moving
    the fact. Larger ones become sort-merge left joins, whose hot keys adaptive
    execution splits. Natural keys are unique per dimension, so no row multiplies.
    """
    fact = silver.select(*MEASURES, *[s.nk for s in specs], *keep)
    for spec in specs:
        fact = fact.join(dims[spec.name].select(spec.nk, spec.sk), spec.nk, "left")
    return fact.select(*MEASURES, *[s.sk for s in specs], *keep)


def to_grain(fact: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """Measures summed to one row per key combination (partial sums before the shuffle)."""
    sums = [F.sum(m).alias(m) for m in MEASURES]
    return fact.groupBy(*keys).agg(*sums).select(*MEASURES, *keys)


def upsert_fact(target: DataFrame, source: DataFrame, null_safe: bool = True) -> DataFrame:
    """Grain rows of ``source`` replace or extend those of ``target``.

    Replacing means the source must hold every row of a grain it touches. Extracted
    windows do: a grain has one Date_ID, and a window takes a Date_ID whole.
    """
    return upsert(target, source, FACT_KEYS, null_safe)
