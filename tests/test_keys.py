import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from batches import tuples
from sparkmart.operators.keys import assign_keys, next_base
from sparkmart.schema import DIM_DEALER


def by_single_window(df, base):
    number = F.row_number().over(Window.orderBy("nk")) + F.lit(base)
    return df.withColumn("sk", number.cast("long"))


def distinct_keys(spark, n):
    # md5 spreads the keys, so neither input order nor partitions follow key order
    return spark.range(0, n, 1, 7).select(F.md5(F.col("id").cast("string")).alias("nk"))


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_equals_a_global_row_number(spark, partitions, coalesce):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                            "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        df = distinct_keys(spark, 5000)
        keyed = assign_keys(df, "nk", "sk", 40)
        assert dict(keyed.dtypes)["sk"] == "bigint"
        assert tuples(keyed) == tuples(by_single_window(df, 40))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_reading_twice_gives_the_same_keys(spark):
    keyed = assign_keys(distinct_keys(spark, 3000).repartition(5), "nk", "sk")
    assert tuples(keyed) == tuples(keyed)


def test_mixed_text_sorts_by_bytes(spark):
    names = ["b", "B", "", "é", "z", "zz", "Ω", "😀", "a-1", "a 1", "A"]
    keyed = assign_keys(spark.createDataFrame([(n,) for n in names], "nk string"), "nk", "sk")
    ordered = sorted(names, key=lambda n: n.encode())
    assert tuples(keyed) == sorted((n, i + 1) for i, n in enumerate(ordered))


def test_base_of_an_empty_and_a_filled_table(spark):
    schema = DIM_DEALER.schema
    one = spark.range(1)
    empty, filled = spark.createDataFrame([], schema), spark.createDataFrame([("a", 7)], schema)
    assert one.select(next_base(empty, DIM_DEALER.sk)).first()[0] == 0
    assert one.select(next_base(filled, DIM_DEALER.sk)).first()[0] == 7


def test_no_rows(spark):
    df = spark.createDataFrame([], "nk string")
    assert assign_keys(df, "nk", "sk").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text(alphabet="aAbZ09 -é", max_size=4), min_size=1, max_size=40), st.integers(0, 10**12))
def test_any_set_of_keys(spark, names, base):
    df = spark.createDataFrame([(n,) for n in names], "nk string")
    keyed = assign_keys(df, "nk", "sk", base)
    ordered = sorted(names, key=lambda n: n.encode())
    assert tuples(keyed) == sorted((n, base + 1 + i) for i, n in enumerate(ordered))
