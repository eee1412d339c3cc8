import pytest

from batches import BATCH_1, BATCH_2, raw, tuples, write_csv
from sparkmart.operators import conform
from sparkmart.plans import load_job, queries
from sparkmart.schema import BRONZE, LANDED, RAW_COLUMNS
from sparkmart.sources.files import (
    read_jdbc,
    read_parquet,
    read_path_sql,
    read_raw_sales,
    read_table,
    table_or_empty,
)
from sparkmart.sources.staging import stage
from sparkmart.sources.store import Store
from sparkmart.streaming.landing import land_new_files


def test_csv_keeps_quoted_commas(spark, tmp_path):
    df = read_raw_sales(spark, write_csv(tmp_path / "a.csv", BATCH_1))
    assert df.columns == list(RAW_COLUMNS)
    assert tuples(df) == sorted(BATCH_1)


def test_csv_with_other_header_is_refused(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Dealer_ID,Branch_ID," + ",".join(RAW_COLUMNS[2:]) + "\n" + ",".join("x" * 12) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_sales(spark, str(path)).collect()


def test_conform_renames_types_and_drops(spark):
    df = conform.conform(raw(spark, BATCH_1))
    assert df.columns == BRONZE.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in BRONZE]
    assert ("BR0001", "DLR0002", "Bbb-M2", 300, 3, "DT00002", 2, 1, 2019, "North", "Beta") in tuples(df)


def changed(row, **values):
    return tuple(values.get(c, v) for c, v in zip(RAW_COLUMNS, row))


def test_rows_that_do_not_convert_are_kept_apart(spark):
    good = BATCH_1[0]
    rows = [
        good,
        changed(good, Revenue="abc"),
        changed(good, Revenue="5.5", Units_Sold=""),
        changed(good, Day="200"),
        changed(good, Revenue=None),
    ]
    df = raw(spark, rows)
    assert conform.conform(df).count() == 3
    reasons = tuples(conform.rejects(df), "reject_reason")
    assert reasons == [("Revenue",), ("Revenue,Units_Sold",)]
    with pytest.raises(conform.ConversionError):
        conform.require_clean(df)
    assert conform.require_clean(raw(spark, BATCH_1)).count() == 4


def test_landing_a_file_again_replaces_it(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    bad = changed(BATCH_1[0], Revenue="n/a")
    one = write_csv(tmp_path / "one.csv", [*BATCH_1, bad])
    two = write_csv(tmp_path / "two.csv", BATCH_2)
    load_job.land(store, one)
    load_job.land(store, two)
    load_job.land(store, one)
    assert load_job.source_table(store).count() == 7
    assert tuples(load_job.rejected_rows(store)) == [(*bad, "Revenue")]
    write_csv(tmp_path / "one.csv", BATCH_1)  # corrected at the source
    load_job.land(store, one)
    assert load_job.source_table(store).count() == 7
    assert load_job.rejected_rows(store).count() == 0


def test_strict_landing_leaves_nothing_behind(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    path = write_csv(tmp_path / "bad.csv", [changed(BATCH_1[0], Year="x")])
    with pytest.raises(conform.ConversionError):
        load_job.land(store, path, strict=True)
    assert load_job.source_table(store).count() == 0


def test_stream_lands_each_file_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    folder = tmp_path / "incoming"
    folder.mkdir()
    write_csv(folder / "one.csv", BATCH_1)
    land_new_files(store, str(folder))
    land_new_files(store, str(folder))
    assert load_job.source_table(store).count() == 4
    write_csv(folder / "two.csv", BATCH_2)
    land_new_files(store, str(folder))
    assert load_job.source_table(store).count() == 7


def test_parquet_path_and_catalog_scans(spark, tmp_path):
    path = str(tmp_path / "bronze")
    df = conform.conform(raw(spark, BATCH_1))
    df.write.parquet(path)
    assert tuples(read_parquet(spark, path, BRONZE)) == tuples(df)
    assert tuples(read_path_sql(spark, path, "Branch_ID, Revenue")) == tuples(df, "Branch_ID", "Revenue")
    df.createOrReplaceTempView("scan_me")
    assert read_table(spark, "scan_me").count() == 4
    assert table_or_empty(spark, "scan_me", BRONZE).count() == 4
    missing = table_or_empty(spark, "no_such_table", BRONZE)
    assert missing.count() == 0 and missing.columns == BRONZE.names
    spark.catalog.dropTempView("scan_me")


def test_jdbc_reader_needs_a_driver(spark):
    with pytest.raises(Exception, match="(?i)driver"):
        read_jdbc(spark, "jdbc:nothing:here", "dbo.source", ("Date_ID", "0", "9", 4))


def test_day_and_month_beyond_a_byte_are_rejected(spark):
    from sparkmart.operators.conform import rejects

    good = BATCH_1[0]
    rows = [changed(good, Day="255"), changed(good, Day="256"), changed(good, Month="-1"), changed(good, Month="300")]
    assert sorted(r.reject_reason for r in rejects(raw(spark, rows)).collect()) == ["Day", "Month", "Month"]


def test_files_of_equal_names_in_two_folders_both_land(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for folder, rows in (("a", BATCH_1), ("b", BATCH_2)):
        (tmp_path / folder).mkdir()
        load_job.land(store, write_csv(tmp_path / folder / "sales.csv", rows))
    assert load_job.source_table(store).count() == 7
    # emptied at the source and landed again
    load_job.land(store, write_csv(tmp_path / "b" / "sales.csv", []))
    assert load_job.source_table(store).count() == 4


def test_rows_without_a_well_formed_date_code_are_rejects(spark, tmp_path):
    good = BATCH_1[0]
    codes = ["dt00001", " DT00001 ", "", "DT1", None]
    store = Store(spark, str(tmp_path / "store"))
    path = write_csv(tmp_path / "a.csv", [good, *[changed(good, Date_ID=c) for c in codes]])
    load_job.land(store, path)
    assert tuples(load_job.source_table(store), "Date_ID") == [("DT00001",), ("DT00001",)]
    assert tuples(load_job.rejected_rows(store), "reject_reason") == [("Date_ID",)] * 4
    assert tuples(load_job.landing_accounts(store).drop("source_path")) == [(6, 2, 4, 2)]


def test_short_and_long_rows_are_rejects_with_their_text(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    path = write_csv(tmp_path / "a.csv", [BATCH_1[0], BATCH_1[1][:8], (*BATCH_1[2], "x", "y")])
    load_job.land(store, path)
    assert load_job.source_table(store).count() == 1
    assert tuples(load_job.rejected_rows(store), "reject_reason") == [("malformed row",)] * 2
    texts = [t for (t,) in tuples(load_job.malformed_rows(store), "raw_text")]
    assert sorted(t.split(",")[0] for t in texts) == ["BR0001", "BR0002"]


def test_feeds_landed_rows_and_staged_tables_are_written_small(spark, tmp_path):
    rows = spark.createDataFrame(BATCH_1, ", ".join(f"{c} string" for c in RAW_COLUMNS))
    store = Store(spark, str(tmp_path / "store"))
    queries._write_csv(rows, store.path("in"), "gzip")
    load_job.land(store, store.path("in"))
    assert tuples(load_job.source_table(store)) and load_job.source_table(store).count() == len(BATCH_1)
    assert [f.name for f in tmp_path.glob("store/in/part-*") if not f.name.endswith(".csv.gz")] == []
    for files in (list(tmp_path.glob("store/source_sales/source_file=*/*.parquet")), stage(rows).inputFiles()):
        assert files and all(str(f).endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("by, shuffled", [("files", False), ("window", True)])
def test_late_files_are_not_shuffled_on_the_way_to_bronze(spark, tmp_path, monkeypatch, by, shuffled):
    store = Store(spark, str(tmp_path))
    later = [("DT09999" if k == RAW_COLUMNS.index("Date_ID") else v for k, v in enumerate(r)) for r in BATCH_1]
    plans = []
    kept = Store.write_load
    monkeypatch.setattr(Store, "write_load", lambda self, df, *a: plans.append(df._jdf.queryExecution().toString()) or kept(self, df, *a))
    for name, some in (("a.csv", BATCH_1), ("b.csv", [tuple(r) for r in later])):
        load_job.land(store, write_csv(tmp_path / name, some))
        load_job.extract_landed(store, by)
    assert ("REBALANCE" in plans[1], "SortMergeJoin" in plans[1]) == (shuffled, False)


def test_landed_rows_do_not_pass_through_the_driver(spark, tmp_path):
    """Stored rows look small, a list of files has no known size: only the list may be broadcast."""
    store = Store(spark, str(tmp_path / "store"))
    path = write_csv(tmp_path / "a.csv", BATCH_1)
    load_job.land(store, path)
    rows = store.read_partitions("source_sales", LANDED)
    first = spark.createDataFrame([(r[0], "") for r in tuples(rows.select("source_path").distinct())], "source_path string, landed_at string")
    counts = load_job._landed_counts(rows, first)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastExchange") == 1 and "BuildRight" in plan and "SortMergeJoin" not in plan
    assert tuples(counts.drop("source_path")) == [(4, 4, 0, 0, "DT00001", "DT00002")]
