import contextlib
import io

import pytest
from pyspark.sql import functions as F

from batches import BATCH_1, BATCH_2, raw, tuples
from sparkmart.operators import dims, silver
from sparkmart.operators.conform import conform
from sparkmart.schema import DIM_BRANCH, DIM_DATE, DIM_DEALER, DIM_MODEL, DIMS

pytestmark = pytest.mark.usefixtures("interpreted")


def loaded(spark, *batches):
    return [silver.enrich(silver.standardise(conform(raw(spark, b)))) for b in batches]


def after(spark, spec, *batches):
    dim = dims.empty_dim(spark, spec)
    for increment in loaded(spark, *batches):
        dim = dims.load_dim(increment, dim, spec)
    return dim


def test_one_row_per_member_on_first_load(spark):
    assert tuples(after(spark, DIM_BRANCH, BATCH_1)) == [("BR0001", "North", 1), ("BR0002", "South", 2)]
    assert tuples(after(spark, DIM_DEALER, BATCH_1)) == [("DLR0001", 1), ("DLR0002", 2)]
    assert tuples(after(spark, DIM_MODEL, BATCH_1)) == [("Aaa-M1", "Aaa", 1), ("Bbb-M2", "Bbb", 2)]
    assert tuples(after(spark, DIM_DATE, BATCH_1)) == [("DT00001", 1, 1, 2019, 1), ("DT00002", 2, 1, 2019, 2)]


def test_new_members_get_keys_above_all_existing_ones(spark):
    """Also a member that sorts before them, and without touching another member's key."""
    increment = BATCH_2[:2]
    assert tuples(after(spark, DIM_BRANCH, BATCH_1, increment)) == [
        ("BR0000", "West", 3), ("BR0001", "North", 1), ("BR0002", "South-East", 2)]
    assert tuples(after(spark, DIM_DEALER, BATCH_1, increment))[-1] == ("DLR0003", 3)
    assert tuples(after(spark, DIM_MODEL, BATCH_1, increment))[-1] == ("ZZZ9", "ZZZ9", 3)
    assert tuples(after(spark, DIM_DATE, BATCH_1, increment), "Date_ID", "dim_date_key") == [
        ("DT00001", 1), ("DT00002", 2), ("DT00003", 3), ("DT00400", 4)]


@pytest.mark.parametrize("spec", [DIM_BRANCH, DIM_DATE], ids=lambda s: s.name)
def test_same_increment_twice_changes_nothing(spark, spec):
    assert tuples(after(spark, spec, BATCH_1, BATCH_2, BATCH_2)) == tuples(after(spark, spec, BATCH_1, BATCH_2))


@pytest.mark.parametrize("spec", DIMS, ids=lambda s: s.name)
def test_short_form_equals_union_and_merge(spark, spec):
    first, second = loaded(spark, BATCH_1, BATCH_2)
    dim = dims.load_dim(first, dims.empty_dim(spark, spec), spec)
    found = dims.members(second, spec)
    merged = dims.merge_members(dim, dims.keyed_members(found, dim, spec), spec)
    assert tuples(merged) == tuples(dims.build_dim(found, dim, spec))


def test_latest_attribute_wins_and_ties_take_the_highest(spark):
    rows = [("B1", "old", "DT00001"), ("B1", "new", "DT00009"), ("B1", "mid", "DT00005"),
            ("B2", "P", "DT00003"), ("B2", "Q", "DT00003"), ("B3", "n", "DT00001"), ("B3", None, "DT00002"),
            (None, "lost", "DT00001")]
    df = spark.createDataFrame(rows, "Branch_ID string, Branch_Name string, Date_ID string")
    assert tuples(dims.members(df, DIM_BRANCH)) == [("B1", "new"), ("B2", "Q"), ("B3", None)]


def test_one_date_code_with_two_days_is_one_member(spark):
    rows = [("DT00001", 28, 5, 2020), ("DT00001", 30, 5, 2020)]
    df = spark.createDataFrame(rows, "Date_ID string, Day smallint, Month smallint, Year smallint")
    assert tuples(dims.members(df, DIM_DATE)) == [("DT00001", 30, 5, 2020)]


def test_missing_natural_keys_are_no_members_on_any_run(spark):
    blank = tuple("  " if i == 1 else v for i, v in enumerate(BATCH_1[0]))
    none = tuple(None if i == 1 else v for i, v in enumerate(BATCH_1[0]))
    dim = after(spark, DIM_DEALER, [*BATCH_1, blank, none], [blank, none])
    assert tuples(dim) == [("DLR0001", 1), ("DLR0002", 2)]


def test_classify_known_and_new(spark):
    first, second = loaded(spark, BATCH_1, BATCH_2)
    dim = dims.load_dim(first, dims.empty_dim(spark, DIM_DATE), DIM_DATE)
    found = dims.members(second, DIM_DATE)
    assert tuples(dims.classify(found, dim, DIM_DATE), "Date_ID", "dim_date_key") == [
        ("DT00002", 2), ("DT00003", None), ("DT00400", None)]
    assert tuples(dims.known_members(found, dim, DIM_DATE), "Date_ID") == [("DT00002",)]
    assert tuples(dims.new_members(found, dim, DIM_DATE), "Date_ID") == [("DT00003",), ("DT00400",)]


def explained(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_first_load_joins_nothing(spark):
    found = spark.createDataFrame([("D1",)], "Dealer_ID string")
    empty = dims.empty_dim(spark, DIM_DEALER)
    assert empty.schema == DIM_DEALER.schema and empty.count() == 0
    assert "Join" not in explained(dims.new_members(found, empty, DIM_DEALER))


def test_no_cross_product_and_no_text_maximum_on_sales(spark):
    sales = spark.range(1000).select(
        F.concat(F.lit("B"), (F.col("id") % 10).cast("string")).alias("Branch_ID"),
        F.lit("n").alias("Branch_Name"),
        F.lit("DT00001").alias("Date_ID"),
    )
    dim = spark.createDataFrame([("B1", "n", 1)], DIM_BRANCH.schema)
    found = dims.members(sales, DIM_BRANCH)
    text = explained(dims.classify(found, dim, DIM_BRANCH))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # the aggregate next to the sales is a hash aggregate; sorting starts behind its shuffle
    first_sort = max(text.find("SortAggregate"), 0)
    assert text.find("HashAggregate") > first_sort


def test_result_does_not_depend_on_partitioning(spark):
    first, second = loaded(spark, BATCH_1, BATCH_2)
    want = tuples(after(spark, DIM_BRANCH, BATCH_1, BATCH_2))
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 9):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            dim = dims.load_dim(first.repartition(n), dims.empty_dim(spark, DIM_BRANCH), DIM_BRANCH)
            assert tuples(dims.load_dim(second.repartition(n), dim, DIM_BRANCH)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)
