"""The full run: land, extract, clean, dimensions, fact, checks.

Every step is keyed by the bound it starts from and replaces what an interrupted
attempt left there, so a step or the whole run can simply be started again.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkmart.operators import checks, conform, extract, fact, silver
from sparkmart.operators.dims import empty_dim, load_dim
from sparkmart.operators.upsert import replace_where
from sparkmart.schema import (
    BRONZE,
    BRONZE_COLUMNS,
    CORRUPT,
    DIM_DATE,
    DIMS,
    FACT,
    FACT_COLUMNS,
    FACT_KEYS,
    LANDED,
    LEDGER,
    LINEAGE,
    SILVER,
    SILVER_COLUMNS,
    DimSpec,
)
from sparkmart.sources.files import read_raw_by_name, read_raw_sales, with_source
from sparkmart.sources.records import read_raw_by_splits
from sparkmart.sources.staging import stage, staging_area
from sparkmart.sources.store import Store, load_id

SOURCE_TABLE = "source_sales"
MONTH = ["Year", "Month"]
GRAIN = StructType([*FACT.fields, *[SILVER[c] for c in MONTH]])
#: The days of one folder of the grain fact; codes have five digits, so there are at most 3,126 folders.
DAYS_A_PART = 32
#: An increment of fewer rows per scan task is gathered before it is written, some MB of Parquet a file.
ROWS_A_FILE = 100_000
PART = "day_part"


def side_by_side(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> list:
    """Runs independent Spark jobs at the same time, as none of them fills a cluster."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [
            pool.submit(copy_context().run, inheritable_thread_target(spark)(task))
            for task in tasks
        ]
        return [f.result() for f in futures]


# landing -------------------------------------------------------------------------


def write_landed(store: Store, raw: DataFrame, landing: str) -> None:
    """Typed rows and rejects in one pass, in one folder per full path of a source file."""
    if "source_path" in raw.columns:
        raw = raw.withColumn("source_file", F.md5(F.col("source_path").cast("binary")))
    else:
        raw = with_source(raw)
    landed = conform.land_columns(raw, "source_path", "source_file")
    store.write_partitions(landed.withColumn("landing", F.lit(landing)), SOURCE_TABLE, ["source_file"])


def land(store: Store, path: str, strict: bool = False, multi_line: bool = False, by_name: bool = False) -> None:
    """Appends a delimited file to the source table; the same file again replaces itself.

    A file is known by its full path. One that is landed again without a row loses those it had.
    ``multi_line`` allows line breaks inside quotes; the file is then read by splits as well. ``by_name`` takes
    columns by the header's names, in whatever order; without it another order is an error.
    """
    if multi_line and by_name:
        raise ValueError("columns by name and line breaks inside quotes do not go together")
    raw = read_raw_sales(store.spark, path, corrupt=CORRUPT)
    files = raw.inputFiles()
    if multi_line:
        raw = read_raw_by_splits(store.spark, path)
    elif by_name:
        raw = read_raw_by_name(store.spark, path, CORRUPT)
    if strict:
        conform.require_clean(raw)
    landing = uuid.uuid4().hex
    write_landed(store, raw, landing)
    # The list of files writes local paths with three slashes, the metadata column with one.
    account_landed(store, landing, [re.sub("^file:/+", "file:/", f) for f in files])


def _folder(path: str) -> str:
    return f"source_file={hashlib.md5(path.encode()).hexdigest()}"


def _accepted() -> Column:
    return F.col("reject_reason").isNull()


def account_landed(store: Store, landing: str, paths: Sequence[str] | None = None) -> None:
    """Enters the files of a landing in the ledger: what came, was accepted, and between which dates.

    Reads the folders of these files alone (of ``paths``; without them, what carries ``landing``).
    """
    spark = store.spark
    if paths is None:
        rows = store.read_partitions(SOURCE_TABLE, LANDED).filter(F.col("landing") == landing)
        named = rows.select("source_path").distinct()
    else:
        there = [_folder(p) for p in paths if store.exists(f"{store.path(SOURCE_TABLE)}/{_folder(p)}")]
        rows = store.read_folders(SOURCE_TABLE, there, LANDED).filter(F.col("landing") == landing)
        named = spark.createDataFrame([(p,) for p in paths], "source_path string").distinct()
    before = store.read_version("ledger", LEDGER)
    position = extract.last_load(store.read_state("bronze"))
    # A file that landed before keeps the place where it came in.
    first = named.withColumn("source_file", F.md5(F.col("source_path").cast("binary"))).join(
        before.select("source_file", "landed_at", "taken"), "source_file", "left"
    ).withColumn("landed_at", F.coalesce("landed_at", F.lit(position)))
    counts = _landed_counts(rows, first.select("source_path", "landed_at"))
    entered = first.join(counts, "source_path", "left").withColumn("landing", F.lit(landing)).fillna(
        0, ["n_received", "n_accepted", "n_rejected", "n_late"]
    )
    others = before.join(entered.select("source_file"), "source_file", "left_anti")
    ledger = store.commit(others.select(*LEDGER.names).unionByName(entered.select(*LEDGER.names)), "ledger")
    store.drop_old_versions("ledger")
    for row in ledger.filter((F.col("landing") == landing) & (F.col("n_received") == 0)).collect():
        store.drop(f"{SOURCE_TABLE}/{_folder(row['source_path'])}")


def _landed_counts(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Counts and dates per file of a landing; ``first`` has (source_path, landed_at), a row per file.

    The hint is needed: of ``first`` Spark knows no size, and the few columns of ``rows`` look small enough in a file
    to be broadcast themselves, all landed rows through the driver.
    """
    code, good = F.col("Date_ID"), _accepted()
    late = good & (code <= _bound(F.col("landed_at")))
    return rows.join(F.broadcast(first), "source_path").groupBy("source_path").agg(
        F.count(F.lit(1)).alias("n_received"), F.count_if(good).alias("n_accepted"), F.count_if(~good).alias("n_rejected"),
        F.count_if(late).alias("n_late"), F.min(F.when(good, code)).alias("min_date"), F.max(F.when(good, code)).alias("max_date"),
    )


def _bound(position: Column) -> Column:
    return F.substring_index(position, ".", 1)


def source_table(store: Store) -> DataFrame:
    """Landed rows that converted."""
    landed = store.read_partitions(SOURCE_TABLE, LANDED)
    return landed.filter(F.col("reject_reason").isNull()).select(*BRONZE_COLUMNS)


def rejected_rows(store: Store) -> DataFrame:
    """Landed rows that did not, as received, with the columns that failed."""
    landed = store.read_partitions(SOURCE_TABLE, LANDED)
    return landed.filter(F.col("reject_reason").isNotNull()).select("received.*", "reject_reason")


def malformed_rows(store: Store) -> DataFrame:
    """(source_path, raw_text) of landed rows with too few, too many or broken fields."""
    landed = store.read_partitions(SOURCE_TABLE, LANDED)
    return landed.filter(F.col("raw_text").isNotNull()).select("source_path", "raw_text")


def landing_accounts(store: Store) -> DataFrame:
    """Per landed file: rows received, accepted and rejected, and accepted rows above the bound
    reached, which the next extract takes."""
    landed = store.read_partitions(SOURCE_TABLE, LANDED)
    good = _accepted()
    lo = _bronze_bound(store)
    return landed.groupBy("source_path").agg(
        F.count(F.lit(1)).alias("n_received"),
        F.count_if(good).alias("n_accepted"),
        F.count_if(~good).alias("n_rejected"),
        F.count_if(good & (F.col("Date_ID") > F.lit(lo))).alias("n_open"),
    )


def late_rows(store: Store, *file_names: str) -> DataFrame:
    """Count of rows in these landed files (names, or full paths as stored) that lie at or below
    the bound reached so far."""
    landed = store.read_partitions(SOURCE_TABLE, LANDED)
    name = F.substring_index("source_path", "/", -1)
    landed = landed.filter(name.isin(*file_names) | F.col("source_path").isin(*file_names))
    landed = landed.filter(F.col("reject_reason").isNull())
    return extract.late_rows(landed, _bronze_bound(store))


def _bronze_bound(store: Store) -> str:
    return extract.bound_of(extract.last_load(store.read_state("bronze")))


def file_accounts(store: Store) -> DataFrame:
    """Per landed file: where its rows are, counted on the landed rows and, behind bronze, in silver.

    ``n_late`` were below the bound when they landed, ``n_open`` are above the present one, and no load has
    either; ``n_gold`` are rows that silver, from which gold is built, holds of the file. What these and
    the rejects leave of ``n_received`` is ``n_missing``: 0, or rows were lost or doubled on the way.
    """
    ledger = store.read_version("ledger", LEDGER)
    position = extract.last_load(store.read_state("bronze"))
    taken = F.coalesce(F.col("taken") < F.lit(load_id(position)), F.lit(False))
    known = ledger.withColumn("n_late", F.when(taken, 0).otherwise(F.col("n_late")))
    # Dates of a file tell whether it can have open rows; only those files are read.
    above = ledger.filter(~taken & (F.col("max_date") > F.lit(extract.bound_of(position))))
    folders = [_folder(r["source_path"]) for r in above.select("source_path").collect()]
    waiting = store.read_folders(SOURCE_TABLE, folders, LANDED).filter(_accepted() & (F.col("Date_ID") > F.lit(extract.bound_of(position))))
    waiting = waiting.groupBy("source_path").agg(F.count(F.lit(1)).alias("n_open"))
    stored = store.read_loads("silver", StructType([LINEAGE])).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_gold"))
    whole = known.join(waiting, "source_path", "left").join(stored, "source_file", "left").fillna(0, ["n_open", "n_gold"])
    terms = ["n_rejected", "n_late", "n_open", "n_gold"]
    rest = F.col("n_received") - sum((F.col(t) for t in terms[1:]), F.col(terms[0]))
    return whole.select("source_path", "n_received", *terms, rest.alias("n_missing"))


def load_accounts(store: Store) -> DataFrame:
    """(load, n_bronze, n_silver, n_fact) of every load that gold holds; counts come from file footers.

    A rebuild makes one load of all, so the sums over loads are what must agree. ``n_fact`` is NULL for the grain fact.
    """
    reached = extract.last_load(store.read_state("gold"))
    tables = {"n_bronze": ("bronze", "bronze"), "n_silver": ("silver", "silver"), "n_fact": ("gold", "fact_sales")}
    counts = None
    for column, (listed, table) in tables.items():
        for name, load, folder in store.live(listed):
            if name == table and load < reached:
                one = store.read_folders(table, [folder], StructType([])).agg(F.count(F.lit(1)).alias("n"))
                one = one.select(F.lit(load).alias("load"), F.lit(column).alias("layer"), "n")
                counts = one if counts is None else counts.unionByName(one)
    if counts is None:
        return store.spark.createDataFrame([], "load string, n_bronze long, n_silver long, n_fact long")
    return counts.groupBy("load").pivot("layer", list(tables)).agg(F.sum("n"))


# bronze --------------------------------------------------------------------------


def extract_increment(store: Store, source: DataFrame) -> str | None:
    """Copies the open window of a typed source to bronze, then moves the state. Returns the new bound.

    Rows with a malformed code, day or month stay behind, as in landing. The upper bound is fixed
    before the copy. If the state is not reached, the next run writes the same load again.
    """
    position = extract.last_load(store.read_state("bronze"))
    lo = extract.bound_of(position)
    source = source.select(*BRONZE_COLUMNS)
    found = extract.open_rows(conform.conform_typed(extract.near_window(source, lo)), lo).first()
    hi = found["max_date"]
    if hi is None:
        return None
    rows = extract.window(conform.conform_typed(extract.near_window(source, lo, hi)), lo, hi)
    _add_load(store, rows, position, hi, thin=found["n_rows"] < ROWS_A_FILE * found["n_tasks"])
    return hi


def _add_load(store: Store, rows: DataFrame, position: str, newest: str, thin: bool = True) -> None:
    if position and thin:
        # A thin slice of a large source: gather it, or every scan task writes a tiny file.
        rows = rows.hint("rebalance")
    store.write_load(rows, "bronze", position)
    store.write_state(_state_row(store.spark, extract.next_position(position, newest)), "bronze")


def extract_landed(store: Store, by: str = "window") -> str | None:
    """Copies landed rows to bronze and moves the state. Returns the new bound, None if nothing is open.

    ``window`` takes the rows above the bound. ``files`` takes all rows that no load has, so those too that
    landed below the bound, as a second file of the same day does. The ledger says which files
    have such rows, and how far they go; no other file is read.
    """
    position = extract.last_load(store.read_state("bronze"))
    lo = extract.bound_of(position)
    ledger = store.read_version("ledger", LEDGER)
    open_ = F.coalesce(F.col("max_date") > F.lit(lo), F.lit(False))
    if by == "files":
        open_ = open_ | (F.col("n_late") > 0)
    # A file whose load never became part of the state is taken again.
    unread = ledger.filter(open_ & F.coalesce(F.col("taken") >= F.lit(load_id(position)), F.lit(True)))
    files = unread.select("source_file", "source_path", "landed_at", "max_date").collect()
    if not files:
        return None
    hi = max(lo, *(f["max_date"] for f in files))
    rows = store.read_folders(SOURCE_TABLE, [_folder(f["source_path"]) for f in files], LANDED).filter(_accepted())
    if by == "files":
        came = store.spark.createDataFrame([(f["source_path"], extract.bound_of(f["landed_at"])) for f in files], "came_path string, came_at string")
        # A row per file that is taken; of a list, Spark knows no size.
        rows = rows.join(F.broadcast(came), F.col("source_path") == F.col("came_path"))
        rows = rows.filter((F.col("Date_ID") > F.lit(lo)) | (F.col("Date_ID") <= F.col("came_at")))
    else:
        rows = extract.window(rows, lo, hi)
    rows = rows.select(*BRONZE_COLUMNS, F.md5(F.col("source_path").cast("binary")).alias(LINEAGE.name))
    if by == "files":
        names = [f["source_file"] for f in files]
        chosen = ledger.join(store.spark.createDataFrame([(n, load_id(position)) for n in names], "source_file string, now string"), "source_file", "left")
        store.commit(chosen.withColumn("taken", F.coalesce("now", "taken")).select(*LEDGER.names), "ledger")
        store.drop_old_versions("ledger")
    # Late files are read alone and most of their rows are taken, so there is nothing to gather.
    _add_load(store, rows, position, hi, thin=by == "window")
    return hi


def _state_row(spark: SparkSession, bound: str) -> DataFrame:
    return spark.range(1).select(F.lit(bound).cast("string").alias("last_load"))


# silver, dimensions, fact ----------------------------------------------------------


def _stored_dim(store: Store, spec: DimSpec) -> DataFrame:
    """The dimension that gold names."""
    folders = [folder for name, _, folder in store.live("gold") if name == spec.name]
    return store.read_folders(spec.name, folders, spec.schema) if folders else empty_dim(store.spark, spec)


def _load_dimension(store: Store, increment: DataFrame, spec: DimSpec, anew: bool) -> DataFrame:
    before = empty_dim(store.spark, spec) if anew else _stored_dim(store, spec)
    return store.commit(load_dim(increment, before, spec), spec.name)


def _write_fact_rows(store: Store, rows: DataFrame, lo: str, anew: bool) -> list[tuple[str, str, str]]:
    folder = store.new_part("gold", "fact_sales", f"load={load_id(lo)}")
    rows.write.mode("overwrite").parquet(f"{store.path('fact_sales')}/{folder}")
    others = [] if anew else [e for e in store.live("gold") if e[0] == "fact_sales" and e[1] != load_id(lo)]
    return [*others, ("fact_sales", load_id(lo), folder)]


def _day_part() -> Column:
    number = F.try_to_number(F.substring("Date_ID", 3, 5), F.lit("99999")).cast("int")
    return F.coalesce(F.floor(number / DAYS_A_PART).cast("string"), F.lit("none")).alias(PART)


def _whole_days(store: Store, touched: DataFrame, lo: str) -> DataFrame:
    """All silver rows of the touched days, whichever load brought them.

    An index of the days of each load tells which loads have any; the others are not opened.
    """
    days = store.read_loads("silver_days", StructType([SILVER["Date_ID"], StructField("load", StringType())]))
    # One name per load, and at most 100,000 codes.
    loads = {r["load"] for r in days.join(touched, days["Date_ID"].eqNullSafe(touched["Date_ID"]), "left_semi").select("load").distinct().collect()}
    folders = [folder for _, load, folder in store.live("silver") if load in loads or load == load_id(lo)]
    rows = store.read_folders("silver", folders, SILVER)
    return rows.join(touched.withColumnRenamed("Date_ID", "_day"), F.col("Date_ID").eqNullSafe(F.col("_day")), "left_semi")


def _write_fact_grain(
    store: Store, dims: dict[str, DataFrame], increment: DataFrame, lo: str, anew: bool
) -> list[tuple[str, str, str]]:
    """The fact at its 4-part key, built day by day from all rows of the days that the increment touches.

    Days lie in parts; only the touched parts are read and written again. As touched days are rebuilt whole,
    their stored rows simply give way, and the stored fact meets a list of days alone.
    """
    touched = stage(increment.select("Date_ID").distinct())
    source = increment if anew else _whole_days(store, touched, lo)
    split = checks.dq_date_id(source.select("Date_ID", *MONTH, F.lit(1).alias("Day"))).first()
    if split is not None:
        raise ValueError(f"Date_ID {split['Date_ID']} lies in several months")
    rows = fact.build_fact(source.withColumn(PART, _day_part()), dims, keep=[*MONTH, PART])
    grain = fact.to_grain(rows, [*FACT_KEYS, *MONTH, PART]).select(*GRAIN.names, PART)
    others: list[tuple[str, str, str]] = []
    if not anew:
        parts = {r[0] for r in touched.select(_day_part()).distinct().collect()}
        stored = [e for e in store.live("gold") if e[0] == "fact_grain"]
        others = [e for e in stored if e[1] not in parts]
        target = store.read_folders("fact_grain", [e[2] for e in stored if e[1] in parts], GRAIN)
        name = F.regexp_extract(F.col("_metadata.file_path"), f"{PART}=([^/]+)", 1)
        target = target.withColumn(PART, name) if any(e[1] in parts for e in stored) else target.withColumn(PART, F.lit(""))
        days = dims[DIM_DATE.name].select(DIM_DATE.nk, DIM_DATE.sk)
        keys = stage(touched.join(days, DIM_DATE.nk, "left").select(DIM_DATE.sk))
        # Codes have five digits, so there are 100,000 days at most.
        grain = replace_where(target, grain, DIM_DATE.sk, F.broadcast(keys))
    folder = store.new_part("gold", "fact_grain", "days").replace("/", "-")
    # Gathers a part's rows into few files and still splits a large part.
    grain.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(f"{store.path('fact_grain')}/{folder}")
    written = [n for n in store.children(f"fact_grain/{folder}") if n.startswith(f"{PART}=")]
    return [*others, *(("fact_grain", n.partition("=")[2], f"{folder}/{n}") for n in written)]


def transform(store: Store, mode: str = "incremental", fact_mode: str = "rows") -> bool:
    """Bronze loads not yet in gold -> silver, dimensions, fact.

    ``initial`` starts from empty tables and all of bronze; ``incremental`` reads only
    the bronze folders at or above its own bound. ``fact_mode`` ``rows`` keeps one
    fact row per sale, ``grain`` upserts one row per 4-part key.
    """
    if mode not in ("initial", "incremental") or fact_mode not in ("rows", "grain"):
        raise ValueError(f"unknown mode: {mode}, {fact_mode}")
    lo = "" if mode == "initial" else extract.last_load(store.read_state("gold"))
    hi = extract.last_load(store.read_state("bronze"))
    if hi <= lo:
        return False
    anew = not lo
    fact_table = {"rows": "fact_sales", "grain": "fact_grain"}[fact_mode]
    if not anew and fact_table not in {name for name, _, _ in store.live("gold")}:
        raise ValueError(f"earlier loads are not in {fact_table}: run once with mode='initial'")
    if anew:
        # A run that follows a broken rebuild starts here too; until then gold stays as it was.
        store.write_state(_state_row(store.spark, ""), "gold")
    with staging_area(store.spark):
        entries = _transform_window(store, lo, hi, anew, fact_mode)
    # Dimensions and fact change together, by one list. Facts of another mode are no part of it.
    before = store.live("gold")
    store.list_live("gold", entries)
    store.write_state(_state_row(store.spark, hi), "gold")
    # Views name version folders, so they follow before an old version goes.
    database = extract.last_load(store.read_state("published"))
    if database and store.spark.catalog.databaseExists(database):
        publish(store, database)
    for spec in DIMS:
        store.drop_old_versions(spec.name, but=[e[2] for e in before])
    return True


def _transform_window(store: Store, lo: str, hi: str, anew: bool, fact_mode: str) -> list[tuple[str, str, str]]:
    """Silver, dimensions and fact of the open loads; the folders that gold is made of then."""
    # A load that starts at the state was broken off; the next extract writes it again.
    bronze = store.read_loads("bronze", StructType([*BRONZE, LINEAGE]), since=lo, before=hi)
    cleaned = silver.enrich(silver.standardise(bronze)).select(*SILVER_COLUMNS, LINEAGE.name)
    add = store.write_loads_anew if anew else (lambda df, table: store.write_load(df, table, lo))
    add(cleaned, "silver")
    increment = store.read_loads("silver", StructType([*SILVER, LINEAGE]), since=lo)
    if fact_mode == "grain":
        add(increment.select("Date_ID").distinct().withColumn("load", F.lit(load_id(lo))), "silver_days")

    loaded = side_by_side(
        store.spark,
        [lambda s=s: _load_dimension(store, increment, s, anew) for s in DIMS],
    )
    dims = {s.name: d for s, d in zip(DIMS, loaded)}
    if fact_mode == "grain":
        facts = _write_fact_grain(store, dims, increment, lo, anew)
    else:
        facts = _write_fact_rows(store, fact.build_fact(increment, dims, keep=[LINEAGE.name]), lo, anew)
    return [*facts, *((s.name, "", store.current_path(s.name).rpartition("/")[2]) for s in DIMS)]


# reading the result ----------------------------------------------------------------


def _fact_tables(store: Store) -> dict[str, StructType]:
    kinds = {"fact_sales": FACT, "fact_grain": GRAIN}
    return {name: schema for name, schema in kinds.items() if name in {e[0] for e in store.live("gold")}}


def gold(store: Store) -> dict[str, DataFrame]:
    """The gold tables as of the last commit: the fact in the mode it was built, and the dimensions."""
    live = store.live("gold")
    tables = {"fact_sales": FACT, "fact_grain": GRAIN, **{s.name: s.schema for s in DIMS}}
    found = {
        name: store.read_folders(name, [folder for table, _, folder in live if table == name], schema)
        for name, schema in tables.items()
    }
    found.pop("fact_sales" if "fact_grain" in {e[0] for e in live} else "fact_grain")
    return found


def publish(store: Store, database: str = "gold") -> None:
    """Catalog names for the gold tables that exist; later runs keep those of the last database."""
    store.create_database(database)
    if extract.last_load(store.read_state("published")) != database:
        store.write_state(_state_row(store.spark, database), "published")
    live = store.live("gold")
    columns = {"fact_sales": FACT_COLUMNS, "fact_grain": FACT_COLUMNS, **{s.name: s.columns for s in DIMS}}
    for name in {table for table, _, _ in live}:
        store.publish(database, name, store.glob(name, [folder for table, _, folder in live if table == name]), columns[name])


def run(
    spark: SparkSession,
    root: str,
    files: Sequence[str] = (),
    source: DataFrame | None = None,
    mode: str = "incremental",
    fact_mode: str = "rows",
    extract_by: str = "window",
    strict: bool = False,
    multi_line: bool = False,
    by_name: bool = False,
) -> Store:
    """Lands ``files`` (or takes ``source``), extracts what is open and updates gold.

    ``extract_by`` ``files`` also takes landed rows below the bound that no load has; a ``source`` has a window only.
    """
    if extract_by not in ("window", "files") or (source is not None and extract_by == "files"):
        raise ValueError(f"no extract by {extract_by} here")
    store = Store(spark, root)
    with staging_area(spark):
        for path in files:
            land(store, path, strict, multi_line, by_name)
    if source is None:
        extract_landed(store, extract_by)
    else:
        extract_increment(store, source)
    transform(store, mode, fact_mode)
    return store


def validate(store: Store) -> dict[str, DataFrame]:
    """Checks to look at after a run; they run last, on what is stored."""
    tables = gold(store)
    dims = {s.name: tables[s.name] for s in DIMS}
    facts = next(df for name, df in tables.items() if name not in dims)
    stored_silver = store.read_loads("silver", SILVER)
    return {
        "layer_counts": checks.layer_counts(tables),
        "key_integrity": checks.dq_key_integrity(dims),
        "fact_totals": checks.dq_fact_totals(stored_silver, facts),
        "unmatched": checks.dq_unmatched(facts),
        "date_id": checks.dq_date_id(stored_silver),
        "null_report": silver.null_report(stored_silver),
        "files": file_accounts(store),
        "loads": load_accounts(store),
    }
