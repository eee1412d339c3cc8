"""Ledger, extraction by file, accounts, whole days and commits by list."""

import pytest
from pyspark.sql import functions as F

from batches import BATCH_1, BATCH_2, tuples, write_csv
from sparkmart.operators import conform
from sparkmart.operators.upsert import replace_where
from sparkmart.plans import load_job
from sparkmart.schema import BRONZE, BRONZE_COLUMNS, FACT, LANDED, LEDGER
from sparkmart.sources.files import read_raw_sales
from sparkmart.sources.store import Store

pytestmark = pytest.mark.usefixtures("interpreted")


def changed(row, **values):
    names = ("Branch_ID", "Dealer_ID", "Model_ID", "Revenue", "Units_Sold", "Date_ID", "Day", "Month", "Year")
    return tuple(values.get(c, v) for c, v in zip(names, row)) + tuple(row[len(names):])


def accounts(store):
    return {
        r.source_path.rpartition("/")[2]: (r.n_received, r.n_rejected, r.n_late, r.n_open, r.n_gold, r.n_missing)
        for r in load_job.file_accounts(store).collect()
    }


@pytest.fixture
def three(tmp_path):
    """Two files of one day, and one of a later day."""
    bad = changed(BATCH_1[0], Revenue="x")
    return [
        write_csv(tmp_path / "a.csv", [*BATCH_1, bad]),
        write_csv(tmp_path / "b.csv", [changed(BATCH_1[1], Revenue="7", Date_ID=" DT00002 "), BATCH_2[0]]),
        write_csv(tmp_path / "c.csv", [BATCH_2[1]]),
    ]


def test_a_second_file_of_a_day_reaches_gold_by_files(spark, tmp_path, three):
    root = str(tmp_path / "store")
    for path in three:
        store = load_job.run(spark, root, [path], extract_by="files")
    assert accounts(store) == {"a.csv": (5, 1, 0, 0, 4, 0), "b.csv": (2, 0, 0, 0, 2, 0), "c.csv": (1, 0, 0, 0, 1, 0)}
    assert sorted(r[0] for r in tuples(load_job.gold(store)["fact_sales"])) == [7, 40, 50, 70, 90, 100, 300]
    assert load_job.extract_landed(store, "files") is None
    loads = [tuple(r) for r in load_job.validate(store)["loads"].orderBy("load").collect()]
    assert loads == [("0", 4, 4, 4), ("DT00002", 2, 2, 2), ("DT00003", 1, 1, 1)]


def test_late_files_alone_do_not_move_the_bound(spark, tmp_path, three):
    root = str(tmp_path / "store")
    load_job.run(spark, root, three[:1], extract_by="files")
    for n in range(2):
        late = write_csv(tmp_path / f"late{n}.csv", [changed(BATCH_1[0], Revenue=str(n))])
        store = load_job.run(spark, root, [late], extract_by="files")
        assert load_job.gold(store)["fact_sales"].count() == 5 + n
    assert tuples(store.read_state("bronze")) == [("DT00002.000002",)]
    # the next window begins at the bound, not at the count behind it
    store = load_job.run(spark, root, three[1:])
    assert accounts(store)["b.csv"] == (2, 0, 1, 0, 1, 0) and accounts(store)["c.csv"] == (1, 0, 0, 0, 1, 0)
    load_job.transform(store, mode="initial")
    assert load_job.gold(store)["fact_sales"].count() == 8


def test_window_says_what_it_leaves(spark, tmp_path, three):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, three[:1])
    load_job.land(store, three[1])
    assert accounts(store)["b.csv"] == (2, 0, 1, 1, 0, 0)
    store = load_job.run(spark, root)
    assert accounts(store)["b.csv"] == (2, 0, 1, 0, 1, 0)
    store = load_job.run(spark, root, extract_by="files")
    assert accounts(store)["b.csv"] == (2, 0, 0, 0, 2, 0)


def test_accounts_see_every_term_that_breaks(spark, tmp_path, three):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, three[:1])
    load_job.land(store, three[1])
    good = accounts(store)
    assert all(v[-1] == 0 for v in good.values())
    silver, ledger = store.live("silver"), store.read_version("ledger", LEDGER)
    store.list_live("silver", [])  # rows that never got to gold
    assert accounts(store)["a.csv"][-1] == 4
    store.list_live("silver", [*silver, *[(t, load + "x", f) for t, load, f in silver]])  # and rows that got there twice
    assert accounts(store)["a.csv"][-1] in (0, -4)
    store.list_live("silver", silver)
    assert accounts(store) == good
    for column in ("n_received", "n_rejected", "n_late"):
        store.commit(ledger.withColumn(column, ledger[column] + 1), "ledger")
        assert {v[-1] for v in accounts(store).values()} != {0}
        store.commit(ledger, "ledger")
    folder = [p for p in (tmp_path / "store/source_sales").iterdir() if load_job._folder(spark.read.schema(LANDED).parquet(str(p)).first().source_path) == p.name]
    for path in folder:  # open rows that are gone
        if spark.read.schema(LANDED).parquet(str(path)).first().source_path.endswith("b.csv"):
            spark.read.schema(LANDED).parquet(str(path)).limit(0).write.mode("append").parquet(str(path / "x"))
            for file in path.glob("*.parquet"):
                file.unlink()
    assert accounts(store)["b.csv"][-1] == 1


def test_only_unread_files_are_opened(spark, tmp_path, three):
    root = str(tmp_path / "store")
    load_job.run(spark, root, three[:1], extract_by="files")
    for file in (tmp_path / "store/source_sales").glob("*/*.parquet"):
        file.write_bytes(b"no longer readable")
    store = load_job.run(spark, root, three[1:2], extract_by="files")
    assert load_job.gold(store)["fact_sales"].count() == 6


def test_extract_by_files_after_a_crash(spark, tmp_path, three, monkeypatch):
    store = load_job.run(spark, str(tmp_path / "store"), three[:1], extract_by="files")
    load_job.land(store, three[1])

    def crash(*_):
        raise RuntimeError("executor lost")

    for step in ("write_load", "write_state"):
        with monkeypatch.context() as patch:
            patch.setattr(Store, step, crash)
            with pytest.raises(RuntimeError):
                load_job.extract_landed(store, "files")
    load_job.run(spark, store.root, three[2:], extract_by="files")
    assert {v[-1] for v in accounts(store).values()} == {0}
    assert store.read_loads("bronze", BRONZE).count() == 7


def test_grain_of_a_padded_code_keeps_its_sum(spark, tmp_path):
    root = str(tmp_path / "store")
    one = write_csv(tmp_path / "one.csv", [BATCH_1[0]])
    two = write_csv(tmp_path / "two.csv", [changed(BATCH_1[0], Revenue="5", Date_ID="DT00001 ")])
    for path in (one, two):
        store = load_job.run(spark, root, [path], fact_mode="grain", extract_by="files")
    assert tuples(load_job.gold(store)["fact_grain"], "Revenue") == [(105,)]


def test_odd_codes_of_a_typed_source(spark, tmp_path):
    good = conform.conform(spark.createDataFrame([BATCH_1[0]], read_raw_sales(spark, write_csv(tmp_path / "x.csv", [])).schema)).first()

    def rows(*codes):
        at = BRONZE_COLUMNS.index("Date_ID")
        return spark.createDataFrame([(*good[:at], c, *good[at + 1 :]) for c in codes], BRONZE)

    root = str(tmp_path / "store")
    load_job.run(spark, root, source=rows("DT00001", "dt00001", None, "DT1", "DT00001\n"))
    store = load_job.run(spark, root, source=rows("DT00001", "dt00001", "  DT00002 ", "DT00002"))
    assert tuples(load_job.gold(store)["fact_sales"].select("Revenue")) == [(100,)] * 3
    assert tuples(store.read_state("bronze")) == [("DT00002",)]
    assert conform.typed_rejects(rows("DT00001", "dt00001", None)).count() == 2
    with pytest.raises(ValueError, match="extract"):
        load_job.run(spark, root, source=rows("DT00003"), extract_by="files")


@pytest.mark.parametrize("fact_mode", ["rows", "grain"])
def test_a_reader_keeps_what_it_started_with(spark, tmp_path, three, fact_mode):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, three[:1], fact_mode=fact_mode)
    before = load_job.gold(store)
    rows = {name: tuples(df) for name, df in before.items()}
    load_job.run(spark, root, three[1:], mode="initial", fact_mode=fact_mode)
    assert {name: tuples(df) for name, df in before.items()} == rows
    assert {name: tuples(df) for name, df in load_job.gold(store).items()} != rows


def test_gold_changes_by_its_list_alone(spark, tmp_path, three, monkeypatch):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, three[:1])
    rows = {name: tuples(df) for name, df in load_job.gold(store).items()}

    def crash(*_):
        raise RuntimeError("executor lost")

    for mode in ("incremental", "initial"):
        with monkeypatch.context() as patch:
            list_live = Store.list_live
            patch.setattr(Store, "list_live", lambda self, name, entries: crash() if name == "gold" else list_live(self, name, entries))
            with pytest.raises(RuntimeError):
                load_job.run(spark, root, three[1:], mode=mode)
        assert {name: tuples(df) for name, df in load_job.gold(store).items()} == rows
    load_job.run(spark, root)
    assert load_job.gold(store)["fact_sales"].count() == 6


def test_folders_of_older_lists_go(spark, tmp_path, three):
    root = str(tmp_path / "store")
    for path in (*three, three[0]):
        store = load_job.run(spark, root, [path], mode="initial", fact_mode="grain")
    assert len(list((tmp_path / "store/silver/load=0").iterdir())) == 2
    assert len(list((tmp_path / "store/live/gold").iterdir())) == 2
    assert len(list((tmp_path / "store/dim_branch").iterdir())) == 2
    assert load_job.gold(store)["fact_grain"].count() == 5


def test_the_stored_fact_is_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    target = spark.createDataFrame([(k, k, 1, 1, 1, k % 9) for k in range(90)], FACT)
    target.write.parquet(str(tmp_path / "target"))
    target = spark.read.schema(FACT).parquet(str(tmp_path / "target"))
    source = spark.createDataFrame([(500, 5, 1, 1, 1, 3), (7, 7, 1, 1, 1, None)], FACT)
    days = spark.createDataFrame([(3,), (None,)], "dim_date_key long")
    merged = replace_where(target, source, "dim_date_key", F.broadcast(days))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan.count("FileScan") == 1
    assert merged.count() == 82 and merged.filter("dim_date_key = 3").count() == 1
