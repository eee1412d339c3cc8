"""The registered queries: every operator applied to the whole sales feed.

Feeds with dirty or changing values derive them from attributes of the tables (return
flag, order status, part type), never from row subsets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.operators import checks, conform, dims, extract, fact, marts, silver, upsert
from sparkmart.operators.keys import assign_keys, next_base
from sparkmart.plans import load_job
from sparkmart.schema import (
    BRONZE,
    BRONZE_COLUMNS,
    DIM_BRANCH,
    DIM_DATE,
    DIM_DEALER,
    DIM_MODEL,
    DIMS,
    FACT_KEYS,
    MEASURES,
    NATURAL_KEYS,
    RAW_COLUMNS,
    SILVER_COLUMNS,
    DimSpec,
)
from sparkmart.sources.files import CSV_OPTIONS, read_path_sql, read_table
from sparkmart.sources.sales_feed import sales
from sparkmart.sources.staging import new_folder, stage
from sparkmart.sources.store import Store
from sparkmart.streaming.landing import land_new_files

LOAD_BOUND = "DT01200"  # the first of two loads ends here
BRONZE_BOUNDS = ("DT00800", "DT01600")  # two early extracts; the third takes the rest

Query = Callable[[SparkSession, str], DataFrame]


# feeds -------------------------------------------------------------------------------


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve text columns as a delimited file would hold them."""
    extra = ["o_orderpriority", "p_type"]
    df = sales(spark, sf_dir, [*BRONZE_COLUMNS, *extra])
    text = {c: F.col(c).cast("string") for c in ("Revenue", "Units_Sold", "Day", "Month", "Year")}
    return (
        df.withColumns(text)
        .withColumn("DealerName", F.concat("o_orderpriority", F.lit(', "'), "Branch_Name", F.lit('"')))
        .withColumn("Product_Name", F.concat("Product_Name", F.lit(", "), "p_type"))
        .withColumnRenamed("Branch_Name", "BranchName")
        .select(*RAW_COLUMNS)
    )


def dirty_raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text in which returns, pending orders and open returns carry bad numbers."""
    flags = ["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority"]
    df = sales(spark, sf_dir, [*BRONZE_COLUMNS, *flags])
    open_line = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A")
    text = {
        "Units_Sold": F.when(F.col("l_returnflag") == "R", F.lit("R")).otherwise(
            F.col("Units_Sold").cast("string")
        ),
        "Revenue": F.when(
            F.col("o_orderstatus") == "P", F.concat(F.col("Revenue").cast("string"), F.lit(".5"))
        ).otherwise(F.col("Revenue").cast("string")),
        "Day": F.when(open_line, F.lit("")).otherwise(F.col("Day").cast("string")),
        "Month": F.col("Month").cast("string"),
        "Year": F.col("Year").cast("string"),
        "DealerName": F.col("o_orderpriority"),
        "BranchName": F.col("Branch_Name"),
    }
    return df.withColumns(text).select(*RAW_COLUMNS)


def blank_id_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with blank, padded and missing natural keys."""
    df = sales(spark, sf_dir, [*BRONZE_COLUMNS, "l_returnflag", "o_orderpriority", "p_type"])
    ids = {
        "Branch_ID": F.when(F.col("l_returnflag") == "R", F.lit("  ")).otherwise(F.col("Branch_ID")),
        "Dealer_ID": F.when(
            F.col("o_orderpriority") != "5-LOW", F.concat(F.lit(" "), "Dealer_ID", F.lit(" "))
        ),
        "Model_ID": F.when(F.col("p_type") == "PROMO", F.lit(""))
        .when(F.col("p_type") != "LARGE", F.col("Model_ID")),
    }
    return df.withColumns(ids).select(*BRONZE_COLUMNS)


def branch_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches whose name changes from sale to sale, with ties on one day."""
    df = sales(spark, sf_dir, ["Branch_ID", "Branch_Name", "Date_ID", "l_returnflag"])
    return df.withColumn("Branch_Name", F.concat("Branch_Name", F.lit("/"), "l_returnflag"))


def _by_load(df: DataFrame) -> DataFrame:
    late = F.col("Date_ID") > LOAD_BOUND
    return df.withColumn("load", F.when(late, F.lit(2)).otherwise(F.lit(1)))


# star building -----------------------------------------------------------------------


def _silver_for(spark: SparkSession, sf_dir: str, specs: Sequence[DimSpec]) -> DataFrame:
    """Stored silver with the columns these dimensions and the measures need."""
    wanted = {*MEASURES, "Date_ID", *[c for s in specs for c in s.member_columns]}
    columns = [c for c in BRONZE_COLUMNS if c in wanted]
    df = sales(spark, sf_dir, columns)
    if "model_category" in wanted:
        df = df.withColumn("model_category", silver.model_category())
    return stage(_by_load(df), partition_by=["load"])


def _load_dims(
    spark: SparkSession, stored: DataFrame, specs: Sequence[DimSpec], loads: Sequence[int]
) -> dict[str, DataFrame]:
    """Dimensions after these loads, the dimensions side by side."""

    def one(spec: DimSpec) -> DataFrame:
        dim = dims.empty_dim(spark, spec)
        for load in loads:
            dim = stage(dims.load_dim(stored.filter(F.col("load") == load), dim, spec))
        return dim

    built = load_job.side_by_side(spark, [lambda s=s: one(s) for s in specs])
    return {s.name: d for s, d in zip(specs, built)}


def _initial_star(
    spark: SparkSession, sf_dir: str, specs: Sequence[DimSpec]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Fact rows and dimensions of one initial load of everything."""
    stored = _silver_for(spark, sf_dir, specs)
    found = load_job.side_by_side(
        spark,
        [
            lambda s=s: stage(dims.load_dim(stored, dims.empty_dim(spark, s), s))
            for s in specs
        ],
    )
    tables = {s.name: d for s, d in zip(specs, found)}
    return fact.build_fact(stored, tables, specs), tables


def _members_of_load(spark: SparkSession, sf_dir: str, spec: DimSpec) -> dict[int, DataFrame]:
    """Members of both loads from a single pass over the feed."""
    if spec is DIM_BRANCH:
        feed = branch_feed(spark, sf_dir)
    else:
        columns = [c for c in BRONZE_COLUMNS if c in {*spec.member_columns, "Date_ID"}]
        feed = sales(spark, sf_dir, columns)
        if "model_category" in spec.attrs:
            feed = feed.withColumn("model_category", silver.model_category())
    both = stage(dims.members(_by_load(feed), spec, by=["load"]))
    return {n: both.filter(F.col("load") == n).drop("load") for n in (1, 2)}


def _first_dim(spark: SparkSession, found: DataFrame, spec: DimSpec) -> DataFrame:
    return stage(dims.build_dim(found, dims.empty_dim(spark, spec), spec))


def _with_natural_keys(facts: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    for spec in DIMS:
        facts = facts.join(tables[spec.name].select(spec.sk, spec.nk), spec.sk, "left")
    return facts


# landing and extract -----------------------------------------------------------------


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform(raw_feed(spark, sf_dir))


def conform_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform(stage(dirty_raw_feed(spark, sf_dir)))


def conform_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.rejects(stage(dirty_raw_feed(spark, sf_dir)))


def _write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "enforceSchema"}
    # A writer trims unless told otherwise.
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.options(**options, compression=compression).mode("append").csv(path)


def csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files -> typed source table; landed twice, stored once."""
    store = Store(spark, new_folder(spark))
    folder = store.path("incoming")
    _write_csv(raw_feed(spark, sf_dir), folder)
    load_job.land(store, folder)
    load_job.land(store, folder)
    return load_job.source_table(store)


def csv_landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by reason of the rejects that landing keeps apart."""
    store = Store(spark, new_folder(spark))
    folder = store.path("incoming")
    # An empty field of a delimited file means "no value", so keep the text visible.
    named = dirty_raw_feed(spark, sf_dir).replace({"": "-"}, subset=["Day"])
    _write_csv(named, folder, "gzip")
    load_job.land(store, folder)
    rejected = load_job.rejected_rows(store)
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def landing_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows received, accepted, rejected and still to extract, per folder of landed files.

    Both folders hold bad numbers, the second also date codes that are not well-formed.
    """
    store = Store(spark, new_folder(spark))
    named = stage(dirty_raw_feed(spark, sf_dir).replace({"": "-"}, subset=["Day"]))
    odd = F.when(F.col("DealerName") == "5-LOW", F.lower("Date_ID")).otherwise(F.col("Date_ID"))
    for folder, feed in (("a", named), ("b", named.withColumn("Date_ID", odd))):
        _write_csv(feed, store.path(folder), "gzip")
        load_job.land(store, store.path(folder))
    early = load_job.source_table(store).filter(F.col("Date_ID") <= LOAD_BOUND)
    load_job.extract_increment(store, early)
    accounts = load_job.landing_accounts(store)
    folder = F.element_at(F.split("source_path", "/"), -2).alias("folder")
    counts = ["n_received", "n_accepted", "n_rejected", "n_open"]
    return accounts.groupBy(folder).agg(*[F.sum(c).alias(c) for c in counts])


def multi_line_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited files with line breaks inside quotes, read by splits."""
    store = Store(spark, new_folder(spark))
    broken = F.concat("BranchName", F.lit(',\n "'), "Model_ID", F.lit('"'))
    _write_csv(raw_feed(spark, sf_dir).withColumn("BranchName", broken), store.path("incoming"))
    load_job.land(store, store.path("incoming"), multi_line=True)
    return load_job.source_table(store)


def by_name_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of files whose columns stand in different orders land alike."""
    store = Store(spark, new_folder(spark))
    feed = stage(raw_feed(spark, sf_dir))
    early = F.col("Date_ID") <= LOAD_BOUND
    _write_csv(feed.filter(early), store.path("incoming/a"))
    _write_csv(feed.filter(~early).select(*sorted(RAW_COLUMNS), F.lit("more").alias("Comment")), store.path("incoming/b"))
    load_job.land(store, store.path("incoming/*"), by_name=True)
    return load_job.source_table(store)


def _arrivals(spark: SparkSession, sf_dir: str, store: Store) -> list[str]:
    """Folders of files in three arrivals: early days, more of the same days with blanks around the codes, later days."""
    feed = stage(raw_feed(spark, sf_dir))
    early, odd = F.col("Date_ID") <= LOAD_BOUND, F.col("Units_Sold").cast("int") % 2 == 1
    padded = feed.filter(early & ~odd).withColumn("Date_ID", F.concat(F.lit(" "), "Date_ID", F.lit("  ")))
    parts = {"a": feed.filter(early & odd), "b": padded, "c": feed.filter(~early)}
    for name, part in parts.items():
        _write_csv(part, store.path(name), "gzip")
    return [store.path(name) for name in parts]


def _by_files(spark: SparkSession, sf_dir: str, fact_mode: str) -> dict[str, DataFrame]:
    store = Store(spark, new_folder(spark))
    for folder in _arrivals(spark, sf_dir, store):
        load_job.run(spark, store.root, [folder], fact_mode=fact_mode, extract_by="files")
    return load_job.gold(store)


def late_files_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals, the second one of days that gold had already reached: all of it gets there."""
    tables = _by_files(spark, sf_dir, "rows")
    return _with_natural_keys(tables["fact_sales"], tables).select(*MEASURES, *NATURAL_KEYS)


def late_files_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same at the 4-key grain: days that get more rows are summed from all of them."""
    tables = _by_files(spark, sf_dir, "grain")
    return _with_natural_keys(tables["fact_grain"], tables).select(*MEASURES, *NATURAL_KEYS, *load_job.MONTH)


def file_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the rows of three arrivals are, per folder; the first is in gold, the others only landed."""
    store = Store(spark, new_folder(spark))
    named = stage(dirty_raw_feed(spark, sf_dir).replace({"": "-"}, subset=["Day"]))
    early, low = F.col("Date_ID") <= LOAD_BOUND, F.col("DealerName") == "5-LOW"
    for name, part in (("a", early & ~low), ("b", low), ("c", ~early & ~low)):
        _write_csv(named.filter(part), store.path(name), "gzip")
        if name == "a":
            load_job.run(spark, store.root, [store.path(name)])
        else:
            load_job.land(store, store.path(name))
    folder = F.element_at(F.split("source_path", "/"), -2).alias("folder")
    counts = ["n_received", "n_rejected", "n_late", "n_open", "n_gold", "n_missing"]
    return load_job.file_accounts(store).groupBy(folder).agg(*[F.sum(c).alias(c) for c in counts])


def typed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after two extracts of a typed source with padded and malformed date codes."""
    feed = sales(spark, sf_dir, [*BRONZE_COLUMNS, "o_orderpriority"])
    code = F.col("Date_ID")
    odd = F.when(F.col("o_orderpriority") == "5-LOW", F.lower(code)).when(
        F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit(" "), code, F.lit(" "))
    )
    source = stage(feed.withColumn("Date_ID", F.coalesce(odd, code)))
    store = Store(spark, new_folder(spark))
    load_job.extract_increment(store, source.filter(F.upper(F.trim("Date_ID")) <= LOAD_BOUND))
    load_job.extract_increment(store, source)
    return store.read_loads("bronze", BRONZE)


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the file stream: two arrivals, three starts."""
    store = Store(spark, new_folder(spark))
    folder = store.path("incoming")
    raw = stage(raw_feed(spark, sf_dir))
    _write_csv(raw.filter(F.col("Date_ID") <= LOAD_BOUND), folder)
    land_new_files(store, folder)
    _write_csv(raw.filter(F.col("Date_ID") > LOAD_BOUND), folder)
    land_new_files(store, folder)
    land_new_files(store, folder)
    return load_job.source_table(store)


def hwm_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.current_max(sales(spark, sf_dir, ["Date_ID"]))


def hwm_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = sales(spark, sf_dir, ["Date_ID"])
    return extract.window(sales(spark, sf_dir), LOAD_BOUND, extract.current_max(dates).scalar())


def hwm_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = spark.range(1).select(F.lit(LOAD_BOUND).alias("last_load"))
    return extract.advance(state, extract.current_max(sales(spark, sf_dir, ["Date_ID"])))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows per landed file; sales of each order status arrive in a file of their own."""
    feed = sales(spark, sf_dir, ["Date_ID", "o_orderstatus"])
    feed = feed.withColumnRenamed("o_orderstatus", "source_file")
    return extract.late_rows(feed, LOAD_BOUND, by=["source_file"])


def _extract_in_steps(spark: SparkSession, sf_dir: str) -> Store:
    store = Store(spark, new_folder(spark))
    source = stage(sales(spark, sf_dir))
    for bound in BRONZE_BOUNDS:
        load_job.extract_increment(store, source.filter(F.col("Date_ID") <= bound))
    load_job.extract_increment(store, source)
    return store


def bronze_accumulate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three extracts from a growing source; bronze holds them all."""
    store = _extract_in_steps(spark, sf_dir)
    return spark.read.parquet(store.path("bronze"))


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bound after two extracts of a growing source."""
    store = Store(spark, new_folder(spark))
    source = stage(sales(spark, sf_dir))
    load_job.extract_increment(store, source.filter(F.col("Date_ID") <= LOAD_BOUND))
    load_job.extract_increment(store, source)
    return store.read_state("bronze")


# silver ------------------------------------------------------------------------------


def silver_model_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    model = F.col("Model_ID")
    variants = (
        F.when(kind == "PROMO", F.replace(model, F.lit("-"), F.lit("")))
        .when(kind == "SMALL", F.lit(""))
        .when(kind == "MEDIUM", F.concat(model, F.lit("-X")))
        .when(kind != "LARGE", model)
    )
    feed = sales(spark, sf_dir, ["Model_ID", "p_type"]).withColumn("Model_ID", variants)
    return feed.select("Model_ID", silver.model_category().alias("model_category"))


def silver_revenue_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines count as no units sold."""
    feed = sales(spark, sf_dir, ["Revenue", "Units_Sold", "l_returnflag"])
    units = F.when(F.col("l_returnflag") == "R", F.lit(0)).otherwise(F.col("Units_Sold"))
    feed = feed.withColumn("Units_Sold", units.cast("bigint"))
    return feed.select(*MEASURES, silver.revenue_per_unit().alias("revenue_per_unit"))


def silver_null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.null_report(blank_id_feed(spark, sf_dir))


def silver_standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.standardise(blank_id_feed(spark, sf_dir))


def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.enrich(sales(spark, sf_dir)).select(*SILVER_COLUMNS)


def units_by_year_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.units_by_year_branch(sales(spark, sf_dir, ["Year", "Branch_Name", "Units_Sold"]))


def path_sql_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver overwritten as a whole, then read by SQL over its path."""
    store = Store(spark, new_folder(spark))
    enriched = silver.enrich(sales(spark, sf_dir)).select(*SILVER_COLUMNS)
    store.write_loads_anew(enriched, "silver")
    store.write_loads_anew(enriched, "silver")
    return read_path_sql(spark, store.live_path("silver"), ", ".join(SILVER_COLUMNS))


# dimensions --------------------------------------------------------------------------


def dim_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.members(branch_feed(spark, sf_dir), DIM_BRANCH)


def _second_load(
    spark: SparkSession, sf_dir: str, spec: DimSpec
) -> tuple[DataFrame, DataFrame]:
    """Members of the second load and the dimension after the first."""
    found = _members_of_load(spark, sf_dir, spec)
    return found[2], _first_dim(spark, found[1], spec)


def dim_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.classify(*_second_load(spark, sf_dir, DIM_DATE), DIM_DATE)


def dim_known_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.known_members(*_second_load(spark, sf_dir, DIM_BRANCH), DIM_BRANCH)


def dim_new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.new_members(*_second_load(spark, sf_dir, DIM_DATE), DIM_DATE)


def dim_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = sales(spark, sf_dir, ["Dealer_ID"])
    return dims.load_dim(feed, dims.empty_dim(spark, DIM_DEALER), DIM_DEALER)


def surrogate_keys_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = sales(spark, sf_dir, ["Dealer_ID"])
    return assign_keys(dims.members(feed, DIM_DEALER), DIM_DEALER.nk, DIM_DEALER.sk)


def surrogate_keys_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, dim = _second_load(spark, sf_dir, DIM_DATE)
    new = dims.new_members(found, dim, DIM_DATE)
    return assign_keys(new, DIM_DATE.nk, DIM_DATE.sk, next_base(dim, DIM_DATE.sk))


def dim_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.keyed_members(*_second_load(spark, sf_dir, DIM_DEALER), DIM_DEALER)


def _scd1(spark: SparkSession, sf_dir: str, spec: DimSpec) -> DataFrame:
    found, dim = _second_load(spark, sf_dir, spec)
    keyed = stage(dims.keyed_members(found, dim, spec))
    upsert.require_no_conflicts(dim, keyed, [spec.sk])
    return dims.merge_members(dim, keyed, spec)


def scd1_upsert_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir, DIM_MODEL)


def scd1_upsert_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scd1(spark, sf_dir, DIM_BRANCH)


def _dim_query(spec: DimSpec) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found, dim = _second_load(spark, sf_dir, spec)
        return dims.build_dim(found, dim, spec)

    return query


def catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dimension, published under a catalog name and read back by it."""
    store = Store(spark, new_folder(spark))
    found = _members_of_load(spark, sf_dir, DIM_MODEL)
    first = store.commit(dims.build_dim(found[1], dims.empty_dim(spark, DIM_MODEL), DIM_MODEL), "dim_model")
    store.commit(dims.build_dim(found[2], first, DIM_MODEL), "dim_model")
    store.create_database("sparkmart_gold")
    store.publish(
        "sparkmart_gold", "dim_model", store.current_path("dim_model"), DIM_MODEL.columns
    )
    return read_table(spark, "sparkmart_gold.dim_model")


# fact --------------------------------------------------------------------------------


def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _silver_for(spark, sf_dir, DIMS)
    return fact.build_fact(stored, _load_dims(spark, stored, DIMS, [1, 2]))


def _fact_with_first_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _silver_for(spark, sf_dir, DIMS)
    return fact.build_fact(stored, _load_dims(spark, stored, DIMS, [1]))


def fact_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions stop at the first load; later sales keep NULL where they find no key."""
    return _fact_with_first_dims(spark, sf_dir)


def fact_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, _ = _initial_star(spark, sf_dir, DIMS)
    return fact.to_grain(facts)


def fact_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-load grains, then the whole feed with corrected measures: replace and extend."""
    stored = _silver_for(spark, sf_dir, DIMS)
    tables = _load_dims(spark, stored, DIMS, [1, 2])
    grain = fact.to_grain(fact.build_fact(stored, tables, keep=["load"]), [*FACT_KEYS, "load"])
    grain = stage(grain)
    target = grain.filter(F.col("load") == 1).drop("load")
    corrected = grain.drop("load").withColumn("Revenue", F.col("Revenue") + 1)
    return fact.upsert_fact(target, corrected)


def fact_upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grains with NULL keys merged into themselves: found null-safe, added by plain equality."""
    grain = stage(fact.to_grain(_fact_with_first_dims(spark, sf_dir)))

    def rows(null_safe: bool) -> DataFrame:
        merged = fact.upsert_fact(grain, grain, null_safe=null_safe)
        return merged.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(null_safe).alias("null_safe"), "n_rows"
        )

    return rows(True).unionByName(rows(False))


def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales that share all four keys would update one grain several times."""
    rows = stage(sales(spark, sf_dir, [*MEASURES, *NATURAL_KEYS]))
    return upsert.conflicts(fact.to_grain(rows, NATURAL_KEYS), rows, NATURAL_KEYS)


# whole runs on storage ---------------------------------------------------------------


def _two_runs(spark: SparkSession, sf_dir: str, fact_mode: str) -> Store:
    root = new_folder(spark)
    source = stage(sales(spark, sf_dir))
    first = source.filter(F.col("Date_ID") <= LOAD_BOUND)
    load_job.run(spark, root, source=first, mode="initial", fact_mode=fact_mode)
    return load_job.run(spark, root, source=source, fact_mode=fact_mode)


def two_load_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial and incremental run; the stored fact with the members its keys stand for."""
    tables = load_job.gold(_two_runs(spark, sf_dir, "rows"))
    return _with_natural_keys(tables["fact_sales"], tables).select(
        *MEASURES, *NATURAL_KEYS, *FACT_KEYS
    )


def two_load_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two runs with the fact kept at its 4-key grain."""
    store = _two_runs(spark, sf_dir, "grain")
    tables = load_job.gold(store)
    return _with_natural_keys(tables["fact_grain"], tables).select(*MEASURES, *NATURAL_KEYS, *load_job.MONTH)


# checks ------------------------------------------------------------------------------


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, tables = _initial_star(spark, sf_dir, DIMS)
    return checks.layer_counts({"fact_sales": facts, **tables})


def dq_date_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-date codes against the calendar parts of the shipping date."""
    ship = F.to_date("l_shipdate")
    parts = {"Day": F.dayofmonth(ship), "Month": F.month(ship), "Year": F.year(ship)}
    feed = sales(spark, sf_dir, ["Date_ID", "l_shipdate"]).withColumns(parts)
    return checks.dq_date_id(feed)


def dq_key_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _silver_for(spark, sf_dir, DIMS)
    return checks.dq_key_integrity(_load_dims(spark, stored, DIMS, [1, 2]))


def dq_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.dq_unmatched(_fact_with_first_dims(spark, sf_dir))


def dq_fact_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _silver_for(spark, sf_dir, DIMS)
    facts = fact.build_fact(stored, _load_dims(spark, stored, DIMS, [1, 2]))
    return checks.dq_fact_totals(stored, facts)


# analytics ---------------------------------------------------------------------------


def dealer_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, tables = _initial_star(spark, sf_dir, [DIM_DEALER])
    return marts.dealer_performance(facts, tables["dim_dealer"])


def branch_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, tables = _initial_star(spark, sf_dir, [DIM_BRANCH])
    return marts.branch_performance(facts, tables["dim_branch"])


def model_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, tables = _initial_star(spark, sf_dir, [DIM_MODEL, DIM_DATE])
    return marts.model_trend(facts, tables["dim_model"], tables["dim_date"])


def revenue_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts, tables = _initial_star(spark, sf_dir, [DIM_BRANCH, DIM_DATE])
    return marts.revenue_growth(facts, tables["dim_branch"], tables["dim_date"])


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        conform_types,
        conform_accepted,
        conform_rejects,
        csv_landing,
        csv_landing_rejects,
        multi_line_landing,
        by_name_landing,
        landing_accounts,
        file_accounts,
        typed_source,
        late_files_star,
        late_files_grain,
        stream_landing,
        hwm_current,
        hwm_window,
        hwm_advance,
        late_rows,
        bronze_accumulate,
        state_lookup,
        silver_model_category,
        silver_revenue_per_unit,
        silver_null_policy,
        silver_standardised,
        silver_enriched,
        units_by_year_branch,
        path_sql_scan,
        dim_members,
        dim_classify,
        dim_known_members,
        dim_new_members,
        dim_first_load,
        surrogate_keys_initial,
        surrogate_keys_incremental,
        dim_union,
        scd1_upsert_model,
        scd1_upsert_branch,
        catalog_scan,
        fact_sales,
        fact_unmatched,
        fact_grain,
        fact_upsert,
        fact_upsert_null_keys,
        merge_conflicts,
        two_load_star,
        two_load_grain,
        layer_counts,
        dq_date_id,
        dq_key_integrity,
        dq_unmatched,
        dq_fact_totals,
        dealer_performance,
        branch_performance,
        model_trend,
        revenue_growth,
    )
} | {spec.name: _dim_query(spec) for spec in DIMS}
