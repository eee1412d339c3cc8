import pathlib

import pytest
from pyspark.sql import functions as F

from batches import BATCH_1, BATCH_2, tuples, write_csv
from sparkmart.operators import extract
from sparkmart.plans import load_job
from sparkmart.plans.main import main
from sparkmart.schema import BRONZE, DIMS, FACT_COLUMNS, SILVER
from sparkmart.sources.store import Store

pytestmark = pytest.mark.usefixtures("interpreted")

FACT_AFTER_1 = [(50, 0, 2, 1, 1, 2), (70, 1, 1, 1, 1, 1), (100, 2, 1, 1, 1, 1), (300, 3, 1, 2, 2, 2)]
FACT_AFTER_2 = sorted([*FACT_AFTER_1, (90, 3, 2, 3, 2, 3), (40, 4, 3, 1, 3, 4)])


@pytest.fixture
def files(tmp_path):
    return write_csv(tmp_path / "first.csv", BATCH_1), write_csv(tmp_path / "second.csv", BATCH_2)


def contents(store):
    return {name: tuples(df) for name, df in load_job.gold(store).items()}


def test_initial_and_incremental_run(spark, tmp_path, files):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, [files[0]], mode="initial")
    assert contents(store)["fact_sales"] == FACT_AFTER_1
    assert extract.last_load(store.read_state("gold")) == "DT00002"

    store = load_job.run(spark, root, [files[1]])
    result = contents(store)
    assert result["fact_sales"] == FACT_AFTER_2
    assert result["dim_branch"] == [("BR0000", "West", 3), ("BR0001", "North", 1), ("BR0002", "South-East", 2)]
    assert result["dim_dealer"] == [("DLR0001", 1), ("DLR0002", 2), ("DLR0003", 3)]
    assert result["dim_model"] == [("Aaa-M1", "Aaa", 1), ("Bbb-M2", "Bbb", 2), ("ZZZ9", "ZZZ9", 3)]
    assert extract.last_load(store.read_state("bronze")) == "DT00400"
    silver = store.read_loads("silver", SILVER)
    assert tuples(silver, "revenue_per_unit") == [(None,), (10.0,), (30.0,), (50.0,), (70.0,), (100.0,)]

    # the same increment again: nothing extracted, nothing changed
    assert contents(load_job.run(spark, root, [files[1]])) == result

    report = load_job.validate(store)
    assert tuples(report["layer_counts"]) == [
        ("dim_branch", 3), ("dim_date", 4), ("dim_dealer", 3), ("dim_model", 3), ("fact_sales", 6)]
    assert report["key_integrity"].filter("n_null + n_repeated > 0").count() == 0
    assert report["unmatched"].filter("n_unmatched > 0").count() == 0
    totals = tuples(report["fact_totals"])
    assert totals[0][1:] == totals[1][1:]


def test_late_rows_of_a_new_file_are_counted_not_extracted(spark, tmp_path, files):
    store = load_job.run(spark, str(tmp_path / "store"), [files[0]])
    load_job.land(store, files[1])
    assert load_job.late_rows(store, "second.csv").first()["late_rows"] == 1
    load_job.extract_increment(store, load_job.source_table(store))
    assert store.read_loads("bronze", BRONZE).count() == 6


def test_initial_mode_rebuilds_the_same_facts_from_bronze(spark, tmp_path, files):
    root = str(tmp_path / "store")
    load_job.run(spark, root, [files[0]])
    store = load_job.run(spark, root, [files[1]])
    before = contents(store)
    load_job.transform(store, mode="initial")
    after = contents(store)
    assert len(after["fact_sales"]) == 6
    assert [r[:2] for r in after["fact_sales"]] == [r[:2] for r in before["fact_sales"]]
    # built from empty, keys follow the natural order of all members
    assert after["dim_branch"] == [("BR0000", "West", 1), ("BR0001", "North", 2), ("BR0002", "South-East", 3)]


@pytest.fixture(scope="module")
def calm(spark, tmp_path_factory):
    """Both increments in both fact modes, without a disturbance."""
    folder = tmp_path_factory.mktemp("calm")
    batches = [write_csv(folder / "first.csv", BATCH_1), write_csv(folder / "second.csv", BATCH_2)]
    return {
        mode: [load_job.run(spark, str(folder / mode), [f], fact_mode=mode) for f in batches][-1]
        for mode in ("rows", "grain")
    }


@pytest.mark.parametrize(
    "step, fact_mode",
    [("_load_dimension", "rows"), ("_write_fact_rows", "rows"), ("_write_fact_grain", "grain"),
     ("write_state", "rows"), ("write_state", "grain")],
)
def test_run_after_a_crash_ends_like_an_undisturbed_one(
    spark, tmp_path, files, calm, monkeypatch, step, fact_mode
):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, [files[0]], fact_mode=fact_mode)
    load_job.land(store, files[1])
    load_job.extract_increment(store, load_job.source_table(store))

    def crash(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(Store if step == "write_state" else load_job, step, crash)
        with pytest.raises(RuntimeError):
            load_job.transform(store, fact_mode=fact_mode)
    assert load_job.transform(store, fact_mode=fact_mode)
    undisturbed = calm[fact_mode]
    for spec in DIMS:
        both = [tuples(s.read_version(spec.name, spec.schema)) for s in (store, undisturbed)]
        assert both[0] == both[1]
    table = "fact_sales" if fact_mode == "rows" else "fact_grain"
    same = [tuples(load_job.gold(s)[table], *FACT_COLUMNS) for s in (store, undisturbed)]
    assert same[0] == same[1] and len(same[0]) == (6 if fact_mode == "rows" else 5)


def test_incremental_run_after_a_broken_rebuild_rebuilds(spark, tmp_path, files, monkeypatch):
    root = str(tmp_path / "store")
    load_job.run(spark, root, [files[0]])
    store = load_job.run(spark, root, [files[1]])

    def crash(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(load_job, "_write_fact_rows", crash)
        with pytest.raises(RuntimeError):
            load_job.transform(store, mode="initial")
    assert load_job.transform(store)
    report = load_job.validate(store)
    totals = tuples(report["fact_totals"])
    assert totals[0][1:] == totals[1][1:] and totals[0][1] == 6
    assert report["unmatched"].filter("n_unmatched > 0").count() == 0


def test_grain_mode_rewrites_only_touched_days(spark, tmp_path, files):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, [files[0]], fact_mode="grain")
    assert tuples(store.read_partitions("fact_grain", load_job.GRAIN), *FACT_COLUMNS) == [
        (50, 0, 2, 1, 1, 2), (170, 3, 1, 1, 1, 1), (300, 3, 1, 2, 2, 2)]
    # an increment of other days alone
    path = write_csv(tmp_path / "third.csv", [BATCH_2[1]])
    before = {e for e in store.live("gold") if e[0] == "fact_grain"}
    load_job.run(spark, root, [path], fact_mode="grain")
    after = {e for e in store.live("gold") if e[0] == "fact_grain"}
    assert before < after and {e[1] for e in after} == {"0", "12"}
    assert store.read_partitions("fact_grain", load_job.GRAIN).count() == 4


def test_grain_mode_is_published_and_checked(spark, calm):
    store = calm["grain"]
    load_job.publish(store, "grain_test")
    assert spark.table("grain_test.fact_grain").columns == list(FACT_COLUMNS)
    assert spark.table("grain_test.fact_grain").count() == 5
    assert not spark.catalog.tableExists("grain_test.fact_sales")
    spark.sql("DROP DATABASE grain_test CASCADE")
    report = load_job.validate(store)
    silver, facts = sorted(tuples(report["fact_totals"]), reverse=True)
    assert silver[2:] == facts[2:] and (silver[1], facts[1]) == (6, 5)


def test_changing_the_fact_mode_needs_a_rebuild(spark, tmp_path, files):
    root = str(tmp_path / "store")
    load_job.run(spark, root, [files[0]], fact_mode="rows")
    with pytest.raises(ValueError, match="initial"):
        load_job.run(spark, root, [files[1]], fact_mode="grain")
    store = Store(spark, root)
    assert load_job.transform(store, mode="initial", fact_mode="grain")
    tables = load_job.gold(store)
    assert tables["fact_grain"].count() == 5 and "fact_sales" not in tables


def test_grain_mode_refuses_a_date_code_in_two_months(spark, tmp_path):
    row = list(BATCH_1[0])
    row[8] = "2021"
    path = write_csv(tmp_path / "odd.csv", [BATCH_1[0], tuple(row)])
    with pytest.raises(ValueError, match="several months"):
        load_job.run(spark, str(tmp_path / "store"), [path], fact_mode="grain")


def test_staged_tables_are_gone_after_a_run(spark, tmp_path, files):
    staged = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "sparkmart"
    before = set(staged.glob("*"))
    load_job.run(spark, str(tmp_path / "store"), [files[0]])
    assert set(staged.glob("*")) == before


def test_unfinished_versions_are_ignored(spark, tmp_path, files):
    store = load_job.run(spark, str(tmp_path / "store"), [files[0]])
    good = tuples(store.read_version("dim_branch", DIMS[0].schema))
    half = tmp_path / "store/dim_branch/v=00000099"
    half.mkdir()
    assert tuples(store.read_version("dim_branch", DIMS[0].schema)) == good


def test_published_names_follow_the_newest_version(spark, tmp_path, files):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, [files[0]])
    load_job.publish(store, "gold_test")
    load_job.publish(store, "gold_test")  # can be repeated
    assert spark.table("gold_test.dim_branch").count() == 2
    load_job.run(spark, root, [files[1]])
    load_job.publish(store, "gold_test")
    assert tuples(spark.table("gold_test.fact_sales")) == FACT_AFTER_2
    assert spark.sql("select count(*) from gold_test.dim_branch").first()[0] == 3
    spark.sql("DROP DATABASE gold_test CASCADE")


def test_command_line(spark, tmp_path, files):
    root = str(tmp_path / "store")
    main(["--root", root, "--file", files[0], "--incremental-flag", "0"])
    main(["--root", root, "--file", files[1], "--incremental-flag", "1", "--validate"])
    assert contents(Store(spark, root))["fact_sales"] == FACT_AFTER_2


def test_empty_source_is_no_run(spark, tmp_path):
    path = write_csv(tmp_path / "empty.csv", [])
    store = load_job.run(spark, str(tmp_path / "store"), [path])
    assert contents(store) == {"fact_sales": [], **{s.name: [] for s in DIMS}}
    assert extract.last_load(store.read_state("bronze")) == ""


def test_sums_survive_any_split_into_loads(spark, tmp_path, files):
    whole = load_job.run(spark, str(tmp_path / "whole"), files)
    source = load_job.source_table(whole)
    split = None
    for bound in ("DT00001", "DT00002", "DT00003", "DT99999"):
        split = load_job.run(
            spark, str(tmp_path / "split"), source=source.filter(F.col("Date_ID") <= bound))
    totals = [
        df.agg(F.count(F.lit(1)), F.sum("Revenue"), F.sum("Units_Sold")).first()
        for df in (load_job.gold(whole)["fact_sales"], load_job.gold(split)["fact_sales"], source)
    ]
    assert totals[0] == totals[1] == totals[2]


def test_rebuild_leaves_out_a_load_that_was_broken_off(spark, tmp_path, files, monkeypatch):
    root = str(tmp_path / "store")
    store = load_job.run(spark, root, [files[0]])
    load_job.land(store, files[1])

    def crash(*_):
        raise RuntimeError("lost before the state was written")

    with monkeypatch.context() as patch:
        patch.setattr(Store, "write_state", crash)
        with pytest.raises(RuntimeError):
            load_job.extract_increment(store, load_job.source_table(store))
    load_job.transform(store, mode="initial")
    assert load_job.gold(store)["fact_sales"].count() == 4
    load_job.run(spark, root)
    assert load_job.gold(store)["fact_sales"].count() == 6


def test_grain_mode_keeps_rows_without_month(spark, tmp_path):
    store = None
    for n, code in enumerate(("DT00001", "DT00002")):
        row = list(BATCH_1[0])
        row[5], row[7] = code, None
        path = write_csv(tmp_path / f"{n}.csv", [tuple(row)])
        store = load_job.run(spark, str(tmp_path / "store"), [path], fact_mode="grain")
    assert store.read_partitions("fact_grain", load_job.GRAIN).count() == 2


def test_published_names_follow_later_runs(spark, tmp_path):
    root, branches = str(tmp_path / "store"), []
    for n, code in enumerate(("DT00001", "DT00002", "DT00003")):
        row = list(BATCH_1[0])
        row[0], row[5] = f"BR000{n}", code
        store = load_job.run(spark, root, [write_csv(tmp_path / f"{n}.csv", [tuple(row)])])
        if n == 0:
            load_job.publish(store, "followed")
        branches.append(spark.sql("select count(*) from followed.dim_branch").first()[0])
        assert spark.sql("select count(*) from followed.fact_sales").first()[0] == n + 1
    assert branches == [1, 2, 3]
    spark.sql("DROP DATABASE followed CASCADE")
