"""Dimension maintenance: members, known/new split, keys and the type-1 update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions import date_ordinal
from sparkmart.operators.keys import assign_keys, next_base
from sparkmart.operators.upsert import upsert
from sparkmart.schema import DimSpec
from sparkmart.sources.files import empty_table
from sparkmart.sources.staging import stage


def empty_dim(spark: SparkSession, spec: DimSpec) -> DataFrame:
    """The dimension before its first load."""
    return empty_table(spark, spec.schema)


def members(silver: DataFrame, spec: DimSpec, by: Sequence[str] = ()) -> DataFrame:
    """One row per natural key: attributes of the latest Date_ID, ties by highest value.

    Rows without natural key are no members. The first aggregate works on (key,
    attributes) with an INT maximum, so it is a hash aggregate that shrinks a hot
    member to one row per map task before the shuffle; the second, which has to
    compare text, only sees the few distinct attribute versions of a member.
    ``by`` adds grouping columns, e.g. to find the members of several loads in one
    pass.
    """
    named = silver.filter(F.col(spec.nk).isNotNull())
    if not spec.attrs:
        return named.select(*by, spec.nk).distinct()
    # All sales of a date member have that one date, so there is nothing to compare.
    at = F.lit(0) if spec.nk == "Date_ID" else date_ordinal()
    versions = named.groupBy(*by, *spec.member_columns).agg(F.max(at).alias("_at"))
    latest = F.max(F.struct("_at", *spec.attrs)).alias("_latest")
    return (
        versions.groupBy(*by, spec.nk)
        .agg(latest)
        .select(*by, spec.nk, *[F.col(f"_latest.{a}").alias(a) for a in spec.attrs])
    )


def classify(found: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Members with the key they already have, NULL for new ones."""
    return found.join(dim.select(spec.nk, spec.sk), spec.nk, "left").select(*spec.columns)


def known_members(found: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Members that have a key."""
    return classify(found, dim, spec).filter(F.col(spec.sk).isNotNull())


def new_members(found: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Members without a key; an anti join, as Catalyst keeps an outer join + IS NULL.

    The dimension is first cut down to the members at hand. Few members are broadcast
    for that, so a large dimension is not shuffled for a small increment.
    """
    present = dim.select(spec.nk).join(found.select(spec.nk), spec.nk, "left_semi")
    return found.join(present, spec.nk, "left_anti").select(*spec.member_columns)


def keyed_members(found: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Union of new members with fresh keys and known members with theirs."""
    fresh = assign_keys(
        new_members(found, dim, spec), spec.nk, spec.sk, next_base(dim, spec.sk)
    )
    return fresh.select(*spec.columns).unionByName(known_members(found, dim, spec))


def merge_members(dim: DataFrame, keyed: DataFrame, spec: DimSpec) -> DataFrame:
    """Type-1 update matched on the surrogate key."""
    return upsert(dim, keyed, [spec.sk])


def build_dim(found: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """The dimension after one load; the first load is this on an empty dimension.

    Same rows as ``merge_members(dim, keyed_members(...))`` with one join less: both
    sides are unique on the natural key, so known rows are updated by it directly
    and new ones are appended.
    """
    updates = found.withColumn("_hit", F.lit(True))
    for a in spec.attrs:
        updates = updates.withColumnRenamed(a, f"_s_{a}")
    kept = dim.join(updates, spec.nk, "left").select(
        spec.nk,
        *[
            F.when(F.col("_hit"), F.col(f"_s_{a}")).otherwise(F.col(a)).alias(a)
            for a in spec.attrs
        ],
        spec.sk,
    )
    fresh = assign_keys(
        new_members(found, dim, spec), spec.nk, spec.sk, next_base(dim, spec.sk)
    )
    return kept.unionByName(fresh.select(*spec.columns))


def load_dim(silver: DataFrame, dim: DataFrame, spec: DimSpec) -> DataFrame:
    """Members of ``silver`` into ``dim``; silver is scanned once."""
    return build_dim(stage(members(silver, spec)), dim, spec)
