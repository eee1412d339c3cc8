"""Update-or-insert between two DataFrames, for tables kept as plain Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class MergeConflict(ValueError):
    """Several source rows would update one target row."""


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [
        left[k].eqNullSafe(right[f"_s_{k}"]) if null_safe else left[k] == right[f"_s_{k}"]
        for k in keys
    ]
    return reduce(lambda a, b: a & b, pairs)


def _prefixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select([F.col(c).alias(f"_s_{c}") for c in columns])


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Matched rows take every source value, unmatched source rows are added.

    A matched value is replaced even by NULL. Without ``null_safe`` a NULL in a key
    matches nothing, so that source row is added.

    Written as a left join plus an anti join, not as one full outer join. A source
    below the broadcast threshold is broadcast to the target (its values for the
    update, its keys for finding the rows already present, where Catalyst moves the
    semi join below the distinct), so a large target is not shuffled. Above it,
    adaptive execution splits a hot target key in the left join, which it cannot do in
    a full outer join, and the distinct collapses it before the shuffle in the other.
    Pass a stored or staged source, as it is read three times.
    """
    columns = target.columns
    incoming = _prefixed(source, columns).withColumn("_hit", F.lit(True))
    kept = target.join(incoming, _match(target, incoming, keys, null_safe), "left").select(
        [F.when(F.col("_hit"), F.col(f"_s_{c}")).otherwise(target[c]).alias(c) for c in columns]
    )
    wanted = _prefixed(source, keys)
    stored = target.select(*keys).distinct()
    present = stored.join(wanted, _match(stored, wanted, keys, null_safe), "left_semi")
    present = _prefixed(present, keys)
    added = source.select(columns)
    added = added.join(present, _match(added, present, keys, null_safe), "left_anti")
    return kept.unionByName(added)


def replace_where(target: DataFrame, source: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """``target`` without the rows whose ``key`` is one of ``values`` (NULL included), and all of ``source``.

    An update-or-insert for a source that holds every row of the keys it touches. Target and source
    are read once; with values to broadcast, as days of a calendar, the target is not shuffled.
    """
    gone = values.select(F.col(key).alias("_gone"))
    kept = target.join(gone, target[key].eqNullSafe(F.col("_gone")), "left_anti")
    return kept.unionByName(source.select(*target.columns))


def conflicts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Keys of target rows that more than one source row would update, with the count.

    Both sides are reduced to one row per key before they meet, so a hot key is one
    row in the join.
    """
    rows = source if null_safe else source.dropna(subset=list(keys))
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_source"))
    repeated = repeated.filter(F.col("n_source") > 1)
    present = _prefixed(target, keys).distinct()
    return repeated.join(present, _match(repeated, present, keys, null_safe), "left_semi")


def require_no_conflicts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> None:
    """Raises before anything is written when an update would be ambiguous."""
    example = conflicts(target, source, keys, null_safe).first()
    if example is not None:
        raise MergeConflict(f"several source rows for {example.asDict()}")
