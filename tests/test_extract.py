import contextlib
import io

import pytest
from pyspark.sql import functions as F

from batches import BATCH_1, BATCH_2, raw, tuples
from sparkmart.operators import extract
from sparkmart.operators.conform import conform
from sparkmart.plans import load_job
from sparkmart.schema import BRONZE, WATERMARK
from sparkmart.sources.store import Store


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def source(spark):
    return conform(raw(spark, BATCH_1 + BATCH_2))


def state(spark, bound):
    return spark.createDataFrame([(bound,)], WATERMARK)


def test_window_is_open_below_and_closed_above(source):
    dates = tuples(extract.window(source, "DT00001", "DT00003"), "Date_ID")
    assert dates == [("DT00002",)] * 3 + [("DT00003",)]
    assert extract.window(source, "", "DT00400").count() == 7


def test_empty_source_extracts_nothing_and_keeps_the_state(spark, source, tmp_path):
    empty = source.filter("1 = 0")
    assert extract.current_max(empty).first()["max_date"] is None
    assert extract.window(source, "", None).count() == 0
    assert extract.current_max_above(source, "DT00400").first()["max_date"] is None
    assert extract.current_max_above(source, "DT00002").first()["max_date"] == "DT00400"
    assert extract.advance(state(spark, "DT00002"), extract.current_max(empty)).first()[0] == "DT00002"
    store = Store(spark, str(tmp_path))
    assert load_job.extract_increment(store, empty) is None
    assert extract.last_load(store.read_state("bronze")) == ""


def test_state_never_moves_back(spark, source):
    assert extract.advance(state(spark, "DT99999"), extract.current_max(source)).first()[0] == "DT99999"
    assert extract.advance(state(spark, "DT00002"), extract.current_max(source)).first()[0] == "DT00400"


def test_late_rows(spark):
    assert extract.late_rows(conform(raw(spark, BATCH_2)), "DT00002").first()[0] == 1


def test_bounds_reach_the_scan(spark, source, tmp_path):
    path = str(tmp_path / "source")
    source.write.parquet(path)
    stored = spark.read.schema(BRONZE).parquet(path)
    text = plan(extract.window(stored, "DT00001", "DT00003").select("Revenue"))
    assert "GreaterThan(Date_ID,DT00001)" in text and "LessThanOrEqual(Date_ID,DT00003)" in text
    assert "ReadSchema: struct<Revenue:bigint,Date_ID:string>" in text


@pytest.mark.parametrize("bounds", [[], ["DT00001"], ["DT00001", "DT00002", "DT00003"], ["DT00300"]])
def test_bronze_does_not_depend_on_the_windows(spark, source, tmp_path, bounds):
    store = Store(spark, str(tmp_path / "-".join(bounds)))
    for bound in bounds:
        load_job.extract_increment(store, source.filter(F.col("Date_ID") <= bound))
    load_job.extract_increment(store, source)
    assert tuples(store.read_loads("bronze", BRONZE)) == tuples(source)
    assert extract.last_load(store.read_state("bronze")) == "DT00400"


def test_extract_repeated_after_a_crash_replaces_its_folder(spark, source, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    early = source.filter(F.col("Date_ID") <= "DT00002")

    def crash(*_):
        raise RuntimeError("lost before the state was written")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_state", crash)
        with pytest.raises(RuntimeError):
            load_job.extract_increment(store, early)
    assert extract.last_load(store.read_state("bronze")) == ""
    assert load_job.extract_increment(store, source) == "DT00400"  # more rows by now
    assert store.read_loads("bronze", BRONZE).count() == 7


@pytest.mark.parametrize("rows_a_file, gathered", [(2, False), (100, True)])
def test_only_a_thin_increment_is_shuffled_on_the_way_to_bronze(spark, source, tmp_path, monkeypatch, rows_a_file, gathered):
    monkeypatch.setattr(load_job, "ROWS_A_FILE", rows_a_file)
    store = Store(spark, str(tmp_path))
    plans = []
    kept = Store.write_load
    monkeypatch.setattr(Store, "write_load", lambda self, df, *a: plans.append(df._jdf.queryExecution().toString()) or kept(self, df, *a))
    load_job.extract_increment(store, source.filter(F.col("Date_ID") <= "DT00002"))
    load_job.extract_increment(store, source)
    assert ["REBALANCE" in p for p in plans] == [False, gathered]
    assert tuples(store.read_loads("bronze", BRONZE)) == tuples(source)


def test_open_rows_and_the_tasks_they_lie_in(spark):
    codes = spark.range(0, 40, 1, 4).select(F.format_string("DT%05d", "id").alias("Date_ID"))
    assert tuple(extract.open_rows(codes, "DT00014").first()) == ("DT00039", 25, 3)
    assert tuple(extract.open_rows(codes, "DT00039").first()) == (None, 0, None)
