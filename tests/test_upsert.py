from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkmart.operators.upsert import MergeConflict, conflicts, require_no_conflicts, upsert

SCHEMA = "a bigint, b bigint, v bigint, w string"
KEYS = ["a", "b"]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def merged(spark, target, source, null_safe=False):
    t, s = (spark.createDataFrame(x, SCHEMA) for x in (target, source))
    return rows(upsert(t, s, KEYS, null_safe))


def model(target, source, null_safe):
    """The same merge, row by row."""

    def same(t, s):
        if null_safe:
            return t[:2] == s[:2]
        return None not in (*t[:2], *s[:2]) and t[:2] == s[:2]

    out = [next((s for s in source if same(t, s)), t) for t in target]
    return Counter(out + [s for s in source if not any(same(t, s) for t in target)])


def test_updates_inserts_and_keeps(spark):
    got = merged(spark, [(1, 1, 10, "x"), (2, 2, 20, "y")], [(2, 2, 21, "z"), (3, 3, 30, "n")])
    assert got == Counter([(1, 1, 10, "x"), (2, 2, 21, "z"), (3, 3, 30, "n")])


def test_null_value_overwrites(spark):
    assert merged(spark, [(1, 1, 10, "x")], [(1, 1, None, None)]) == Counter([(1, 1, None, None)])


def test_null_key_is_added_or_matched(spark):
    target, source = [(1, None, 10, "x")], [(1, None, 11, "y")]
    assert merged(spark, target, source) == Counter(target + source)
    assert merged(spark, target, source, null_safe=True) == Counter(source)


def test_two_source_rows_for_an_absent_key_are_both_added(spark):
    source = [(5, 5, 1, "p"), (5, 5, 2, "q")]
    assert merged(spark, [(1, 1, 10, "x")], source) == Counter([(1, 1, 10, "x"), *source])


def test_one_source_row_updates_every_matching_target_row(spark):
    target = [(1, 1, 10, "x"), (1, 1, 11, "y")]
    assert merged(spark, target, [(1, 1, 0, "n")]) == Counter({(1, 1, 0, "n"): 2})


def test_empty_sides(spark):
    some = [(1, 1, 10, "x")]
    assert merged(spark, [], some) == Counter(some)
    assert merged(spark, some, []) == Counter(some)


def test_conflicts_only_lists_keys_that_are_in_the_target(spark):
    target = spark.createDataFrame([(1, 1, 0, "x"), (2, None, 0, "x")], SCHEMA)
    source = spark.createDataFrame(
        [(1, 1, 1, "a"), (1, 1, 2, "b"), (9, 9, 1, "a"), (9, 9, 2, "b"), (2, None, 1, "a"), (2, None, 2, "b")],
        SCHEMA,
    )
    assert rows(conflicts(target, source, KEYS)) == Counter([(1, 1, 2)])
    assert rows(conflicts(target, source, KEYS, null_safe=True)) == Counter([(1, 1, 2), (2, None, 2)])
    with pytest.raises(MergeConflict):
        require_no_conflicts(target, source, KEYS)
    require_no_conflicts(target, source.filter("a = 9"), KEYS)


key = st.sampled_from([None, 1, 2])
value = st.sampled_from([None, 10, 20])
text = st.sampled_from([None, "x", "y"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(key, key, value, text), max_size=6),
    st.lists(st.tuples(key, key, value, text), max_size=6, unique_by=lambda r: r[:2]),
    st.booleans(),
)
def test_any_tables(spark, target, source, null_safe):
    assert merged(spark, target, source, null_safe) == model(target, source, null_safe)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(key, key, value, text), max_size=6, unique_by=lambda r: r[:2]))
def test_merging_again_changes_nothing(spark, source):
    once = merged(spark, [(1, 1, 5, "t")], source, null_safe=True)
    assert merged(spark, list(once.elements()), source, null_safe=True) == once
