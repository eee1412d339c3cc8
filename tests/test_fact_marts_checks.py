import pytest
from pyspark.sql import functions as F

from batches import BATCH_1, BATCH_2, raw, tuples
from sparkmart.operators import checks, dims, fact, marts, silver
from sparkmart.operators.conform import conform
from sparkmart.operators.upsert import MergeConflict, require_no_conflicts
from sparkmart.schema import DIMS, FACT_COLUMNS, FACT_KEYS


def enriched(spark, rows):
    return silver.enrich(silver.standardise(conform(raw(spark, rows))))


@pytest.fixture(scope="module")
def star(spark):
    first = enriched(spark, BATCH_1)
    tables = {s.name: dims.load_dim(first, dims.empty_dim(spark, s), s) for s in DIMS}
    return first, tables, fact.build_fact(first, tables)


def test_fact_has_one_row_per_sale(star):
    _, _, facts = star
    assert facts.columns == list(FACT_COLUMNS)
    assert tuples(facts) == [(50, 0, 2, 1, 1, 2), (70, 1, 1, 1, 1, 1), (100, 2, 1, 1, 1, 1), (300, 3, 1, 2, 2, 2)]


def test_grain_sums_sales_with_the_same_keys(star):
    _, _, facts = star
    grain = fact.to_grain(facts)
    assert tuples(grain) == [(50, 0, 2, 1, 1, 2), (170, 3, 1, 1, 1, 1), (300, 3, 1, 2, 2, 2)]
    # unaggregated, the same rows would update one grain twice
    with pytest.raises(MergeConflict):
        require_no_conflicts(grain, facts, FACT_KEYS)


def test_unknown_members_keep_their_rows(spark, star):
    _, tables, _ = star
    later = fact.build_fact(enriched(spark, BATCH_2), tables)
    assert tuples(later) == [(10, 1, 1, 1, 1, 2), (40, 4, None, 1, None, None), (90, 3, 2, None, 2, None)]
    assert tuples(checks.dq_unmatched(later)) == sorted(
        [("dim_branch", 3, 1), ("dim_dealer", 3, 1), ("dim_model", 3, 1), ("dim_date", 3, 2)])


def test_fact_upsert_replaces_and_is_repeatable(star):
    _, _, facts = star
    grain = fact.to_grain(facts)
    corrected = grain.withColumn("Revenue", F.col("Revenue") + 1)
    once = fact.upsert_fact(grain, corrected)
    assert tuples(once) == tuples(corrected)
    assert tuples(fact.upsert_fact(once, corrected)) == tuples(corrected)


def test_report_order(spark):
    report = silver.units_by_year_branch(enriched(spark, BATCH_1 + BATCH_2[:2]))
    assert [tuple(r) for r in report.collect()] == [
        (2019, "North", 6), (2019, "South-East", 3), (2019, "South", 0), (2020, "West", 4)]


def test_report_breaks_ties_by_name(spark):
    rows = [(2019, "b", 5), (2019, "a", 5), (2019, "c", 9)]
    df = spark.createDataFrame(rows, "Year smallint, Branch_Name string, Units_Sold bigint")
    assert [r["Branch_Name"] for r in silver.units_by_year_branch(df).collect()] == ["c", "a", "b"]


def test_null_report_counts(spark):
    rows = [(None, "a", " ", "DT00001"), ("b", "", None, "DT00002"), ("b", "a", "m", None)]
    df = spark.createDataFrame(rows, "Branch_ID string, Dealer_ID string, Model_ID string, Date_ID string")
    assert tuples(silver.null_report(df)) == [
        ("Branch_ID", 3, 1, 0), ("Date_ID", 3, 1, 0), ("Dealer_ID", 3, 0, 1), ("Model_ID", 3, 1, 1)]


def test_performance(star):
    _, tables, facts = star
    assert tuples(marts.branch_performance(facts, tables["dim_branch"])) == [
        ("BR0001", "North", 470, 6, 3, 470 / 6), ("BR0002", "South", 50, 0, 1, None)]
    assert tuples(marts.dealer_performance(facts, tables["dim_dealer"])) == [
        ("DLR0001", 220, 3, 3, 220 / 3), ("DLR0002", 300, 3, 1, 100.0)]


def test_sales_without_a_member_stay_in_the_reports(spark, star):
    _, tables, _ = star
    facts = fact.build_fact(enriched(spark, BATCH_2), tables)
    assert tuples(marts.dealer_performance(facts, tables["dim_dealer"])) == [
        (None, 90, 3, 1, 30.0), ("DLR0001", 50, 5, 2, 10.0)]
    trend = marts.model_trend(facts, tables["dim_model"], tables["dim_date"])
    assert tuples(trend) == [(None, None, None, 40, 4), ("Aaa", 2019, 1, 10, 1), ("Bbb", None, None, 90, 3)]
    growth = marts.revenue_growth(facts, tables["dim_branch"], tables["dim_date"])
    assert growth.count() == 3 and growth.groupBy().sum("Revenue").first()[0] == 140


def test_trend(star):
    _, tables, facts = star
    assert tuples(marts.model_trend(facts, tables["dim_model"], tables["dim_date"])) == [
        ("Aaa", 2019, 1, 220, 3), ("Bbb", 2019, 1, 300, 3)]


def test_growth(spark):
    rows = [("B1", 2019, 100, "DT00001"), ("B1", 2020, 150, "DT00400"), ("B1", 2021, 0, "DT00800"),
            ("B1", 2022, 10, "DT01200"), ("B2", 2020, 7, "DT00400")]
    df = spark.createDataFrame(rows, "Branch_ID string, Year smallint, Revenue bigint, Date_ID string").selectExpr(
        "*", "'n' as Branch_Name", "1L as Units_Sold", "cast(1 as smallint) as Day", "cast(1 as smallint) as Month")
    specs = [s for s in DIMS if s.name in ("dim_branch", "dim_date")]
    tables = {s.name: dims.load_dim(df, dims.empty_dim(spark, s), s) for s in specs}
    facts = fact.build_fact(df, tables, specs)
    growth = marts.revenue_growth(facts, tables["dim_branch"], tables["dim_date"])
    assert tuples(growth, "Branch_ID", "Year", "Revenue", "previous_revenue", "growth") == [
        ("B1", 2019, 100, None, None), ("B1", 2020, 150, 100, 0.5), ("B1", 2021, 0, 150, -1.0),
        ("B1", 2022, 10, 0, None), ("B2", 2020, 7, None, None)]


def test_integrity_checks_find_damage(spark, star):
    first, tables, facts = star
    clean = checks.dq_key_integrity(tables)
    assert clean.filter("n_null > 0 or n_repeated > 0").count() == 0
    branch = tables["dim_branch"]
    broken = branch.union(branch.limit(1)).union(
        spark.createDataFrame([(None, "x", None)], branch.schema))
    damage = checks.dq_key_integrity({"dim_branch": broken})
    assert tuples(damage) == [("dim_branch", "Branch_ID", 4, 1, 1), ("dim_branch", "dim_branch_key", 4, 1, 1)]
    assert tuples(checks.dq_fact_totals(first, facts)) == [("fact_sales", 4, 520, 6), ("silver", 4, 520, 6)]


def test_date_code_with_two_days_is_reported(spark):
    rows = [("DT01246", 28, 5, 2020), ("DT01246", 30, 5, 2020), ("DT01247", 31, 5, 2020)]
    df = spark.createDataFrame(rows, "Date_ID string, Day smallint, Month smallint, Year smallint")
    assert tuples(checks.dq_date_id(df)) == [("DT01246", 2)]


def test_growth_needs_the_year_before(spark):
    fact = spark.createDataFrame([(100, 1, 1), (300, 1, 2), (150, 1, 3)], "Revenue long, dim_branch_key long, dim_date_key long")
    branch = spark.createDataFrame([("B", "North", 1)], "Branch_ID string, Branch_Name string, dim_branch_key long")
    dates = spark.createDataFrame([(1, 2019), (2, 2021), (3, 2022)], "dim_date_key long, Year short")
    rows = marts.revenue_growth(fact, branch, dates).orderBy("Year").collect()
    assert [(r.Year, r.previous_revenue, r.growth) for r in rows] == [(2019, None, None), (2021, None, None), (2022, 300, -0.5)]


def test_key_integrity_counts_rows_beyond_the_first(spark):
    dim = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3), (None, 4)], "Branch_ID string, dim_branch_key long")
    rows = {r.column_name: r for r in checks.dq_key_integrity({"dim_branch": dim}).collect()}
    assert rows["Branch_ID"].n_repeated == 2 and rows["Branch_ID"].n_null == 2
    assert rows["dim_branch_key"].n_repeated == 1
