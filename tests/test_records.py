"""Line breaks inside quotes, over many splits, against Spark's own multi-line reader."""

import csv
import random

import pytest

from batches import BATCH_1, tuples, write_csv
from sparkmart.plans import load_job
from sparkmart.plans.main import main
from sparkmart.schema import CORRUPT, RAW_COLUMNS
from sparkmart.sources.files import read_raw_sales
from sparkmart.sources.records import read_raw_by_splits
from sparkmart.sources.staging import stage
from sparkmart.sources.store import Store


@pytest.fixture
def small_splits(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def odd_rows(rng, n):
    """Rows whose texts hold line breaks, commas, quotes and backslashes."""
    def text():
        return "".join(rng.choice(["a", "b ", ",", "\n", '"', "\\", "x\ny", "\n\n", "é", ""]) for _ in range(rng.randrange(7)))

    return [tuple(text() if k in (9, 10, 11) else v for k, v in enumerate(rng.choice(BATCH_1))) for _ in range(n)]


def write_odd(path, rows, newline="\n"):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f, quotechar='"', escapechar="\\", doublequote=False, quoting=csv.QUOTE_ALL, lineterminator=newline)
        writer.writerow(RAW_COLUMNS)
        writer.writerows(rows)
    return str(path)


@pytest.mark.parametrize("seed", range(3))
def test_records_equal_the_multi_line_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(2):
        write_odd(folder / f"{k}.csv", odd_rows(rng, 120))
    # quotes amid plain fields, short and long rows
    plain = [",".join(BATCH_1[0][:9]) + ',5" disk,pl"ain,end', "only,three,fields", ",".join(["z"] * 14), '"a\nb",' + ",".join(["q"] * 11)]
    (folder / "plain.csv").write_text("\n".join([",".join(RAW_COLUMNS), *plain * 40]) + "\n")
    mine = read_raw_by_splits(spark, str(folder))
    theirs = read_raw_sales(spark, str(folder), multi_line=True, corrupt=CORRUPT)
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 10
    assert mine.count() == 240 + 160
    assert tuples(mine, *RAW_COLUMNS) == tuples(theirs, *RAW_COLUMNS)
    assert [sum(r[CORRUPT] is not None for r in df.collect()) for df in (mine, theirs)] == [80, 80]


def test_records_of_a_split_are_joined_where_they_are_read(spark, tmp_path, small_splits, monkeypatch):
    written = []

    def kept(df):
        written.append(out := stage(df))
        return out

    monkeypatch.setattr("sparkmart.sources.records.stage", kept)
    rows = [(*BATCH_1[0][:9], "two\nlines\nand more", f"p{k}", "x") for k in range(300)]
    path = write_odd(tmp_path / "in.csv", rows)
    assert read_raw_by_splits(spark, path).count() == 300
    splits = spark.read.text(path).rdd.getNumPartitions()
    # What is written first are records; besides these, a few rows at the ends of each split.
    assert splits > 5 and written[0].count() < 301 + 4 * splits < 900


def test_line_ends_and_headers(spark, tmp_path):
    rows = [(*BATCH_1[0][:9], "two\nlines", "", "x")]
    one, two = write_odd(tmp_path / "lf.csv", rows), write_odd(tmp_path / "crlf.csv", rows, "\r\n")
    assert tuples(read_raw_by_splits(spark, one), *RAW_COLUMNS) == tuples(read_raw_by_splits(spark, two), *RAW_COLUMNS)
    assert tuples(read_raw_by_splits(spark, one), "BranchName") == [("two\nlines",)]
    assert read_raw_by_splits(spark, write_csv(tmp_path / "empty.csv", [])).count() == 0
    (tmp_path / "other.csv").write_text(",".join(RAW_COLUMNS[::-1]) + "\n" + ",".join("x" * 12) + "\n")
    with pytest.raises(ValueError, match="header"):
        read_raw_by_splits(spark, str(tmp_path / "other.csv"))


def test_landing_by_splits_from_the_command_line(spark, tmp_path, small_splits):
    rows = [(*r[:9], "North\nEast, \\ upper", *r[10:]) for r in BATCH_1] * 30
    path = write_odd(tmp_path / "in.csv", rows)
    root = str(tmp_path / "store")
    main(["--root", root, "--file", path, "--multi-line", "--extract", "files"])
    store = Store(spark, root)
    assert load_job.gold(store)["fact_sales"].count() == 120
    assert tuples(load_job.source_table(store).select("Branch_Name").distinct()) == [("North\nEast, \\ upper",)]
    assert [r.n_missing for r in load_job.file_accounts(store).collect()] == [0]


def test_columns_by_name(spark, tmp_path):
    order = [11, 3, 0, 7, 5, 1, 2, 4, 6, 8, 9, 10]
    turned = [tuple(r[k] for k in order) for r in [RAW_COLUMNS, *BATCH_1]]
    one = write_csv(tmp_path / "one.csv", BATCH_1)
    with open(tmp_path / "two.csv", "w", newline="") as f:
        csv.writer(f).writerows([(*r, "more") for r in turned])
    stores = [Store(spark, str(tmp_path / name)) for name in ("a", "b")]
    for store, path in zip(stores, (one, str(tmp_path / "two.csv"))):
        load_job.land(store, path, by_name=True)
    assert tuples(load_job.source_table(stores[0])) == tuples(load_job.source_table(stores[1]))
    load_job.land(stores[0], str(tmp_path / "*.csv"), by_name=True)
    assert load_job.source_table(stores[0]).count() == 8 and load_job.file_accounts(stores[0]).count() == 2
    (tmp_path / "bad.csv").write_text(",".join(RAW_COLUMNS[1:]) + "\n")
    with pytest.raises(ValueError, match="header"):
        load_job.land(stores[0], str(tmp_path / "bad.csv"), by_name=True)
