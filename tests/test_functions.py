from sparkmart.functions import blank_to_null, date_ordinal, model_category, revenue_per_unit, typed


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_model_category_takes_the_part_before_the_first_dash(spark):
    rows = [("Jee-M10",), ("A-B-C",), ("ZYXM13",), ("",), (None,), ("-x",)]
    got = values(spark, rows, "Model_ID string", model_category())
    assert got == ["Jee", "A", "ZYXM13", "", None, ""]


def test_revenue_per_unit_is_null_without_units(spark):
    rows = [(100, 2), (50, 0), (0, 0), (7, None), (None, 7), (10, 4)]
    got = values(spark, rows, "Revenue bigint, Units_Sold bigint", revenue_per_unit())
    assert got == [50.0, None, None, None, None, 2.5]


def test_typed_is_strict(spark):
    rows = [("5",), ("-7",), (" 8 ",), ("+9",), ("5.5",), ("",), ("abc",), ("1e3",), (None,),
            ("9223372036854775808",)]
    got = values(spark, rows, "c string", typed("c", "bigint"))
    assert got == [5, -7, 8, 9, None, None, None, None, None, None]


def test_small_numbers_keep_their_range(spark):
    got = values(spark, [("200",), ("255",), ("40000",)], "c string", typed("c", "smallint"))
    assert got == [200, 255, None]


def test_blank_to_null(spark):
    got = values(spark, [(" a ",), ("  ",), ("",), (None,)], "c string", blank_to_null("c"))
    assert got == ["a", None, None, None]


def test_date_ordinal_only_reads_well_formed_codes(spark):
    rows = [("DT00042",), ("DT0042",), ("XX00042",), ("DT000421",), (None,)]
    assert values(spark, rows, "Date_ID string", date_ordinal()) == [42, None, None, None, None]
