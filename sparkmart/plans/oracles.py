"""Plain SQL with the results the registered queries must have.

Written against the base tables alone: dense keys are a global ``row_number()``,
latest-wins attributes are a ranked window, an upsert is a full join.
"""

from __future__ import annotations

from sparkmart.plans.queries import BRONZE_BOUNDS, LOAD_BOUND
from sparkmart.schema import (
    BRONZE_COLUMNS,
    DIM_BRANCH,
    DIM_DATE,
    DIM_DEALER,
    DIM_MODEL,
    DIMS,
    SILVER_COLUMNS,
    DimSpec,
)


def _code(prefix: str, number: str, width: int) -> str:
    text = f"cast({number} as varchar)"
    return f"'{prefix}' || lpad({text}, cast(greatest(length({text}), {width}) as integer), '0')"


_DAY = "cast(o_orderdate as date)"
_DATE_NUMBER = f"(date_diff('day', date '1995-01-01', {_DAY}) + 1)"

SALES = f"""sales as (
  select {_code("BR", "l_suppkey", 4)} as Branch_ID,
         {_code("DLR", "o_custkey", 6)} as Dealer_ID,
         substr(p_type, 1, 3) || '-M' || cast(p_size as varchar) as Model_ID,
         cast(floor(l_extendedprice) as bigint) as Revenue,
         cast(l_quantity as bigint) as Units_Sold,
         {_code("DT", _DATE_NUMBER, 5)} as Date_ID,
         cast(day({_DAY}) as smallint) as Day,
         cast(month({_DAY}) as smallint) as Month,
         cast(year({_DAY}) as smallint) as Year,
         s_name as Branch_Name,
         p_name as Product_Name,
         l_returnflag, l_linestatus, l_shipdate, o_orderstatus, o_orderpriority, p_type
  from lineitem
  left join orders on l_orderkey = o_orderkey
  left join part on l_partkey = p_partkey
  left join supplier on l_suppkey = s_suppkey)"""

SILVER = """silver as (
  select *, split_part(Model_ID, '-', 1) as model_category,
         cast(Revenue as double) / nullif(Units_Sold, 0) as revenue_per_unit
  from sales)"""

_BRONZE = ", ".join(BRONZE_COLUMNS)


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# dimensions: members m1/m2 of the two loads, tables d1/d2 after them -------------------

_CHANGING_BRANCHES = """silver as (
  select * replace (Branch_Name || '/' || l_returnflag as Branch_Name) from sales)"""


def _members(name: str, spec: DimSpec, condition: str) -> str:
    order = ", ".join(f"{c} desc nulls last" for c in ("Date_ID", *spec.attrs))
    columns = ", ".join(spec.member_columns)
    return f"""{name} as (
  select {columns} from (
    select {columns}, row_number() over (partition by {spec.nk} order by {order}) as rn
    from silver where {spec.nk} is not null and {condition})
  where rn = 1)"""


def _dim(spec: DimSpec, tag: str = "") -> list[str]:
    """CTEs {tag}m1, {tag}d1 (first load), {tag}m2, {tag}d2 (both loads)."""
    columns = ", ".join(spec.member_columns)
    kept = ", ".join(
        f"case when m.{spec.nk} is not null then m.{a} else d.{a} end as {a}" for a in spec.attrs
    )
    kept = f", {kept}" if kept else ""
    return [
        _members(f"{tag}m1", spec, f"Date_ID <= '{LOAD_BOUND}'"),
        f"{tag}d1 as (select {columns}, row_number() over (order by {spec.nk}) as {spec.sk}"
        f" from {tag}m1)",
        _members(f"{tag}m2", spec, f"Date_ID > '{LOAD_BOUND}'"),
        f"""{tag}new as (
  select {columns}, coalesce((select max({spec.sk}) from {tag}d1), 0)
         + row_number() over (order by {spec.nk}) as {spec.sk}
  from {tag}m2 m where not exists (select 1 from {tag}d1 d where d.{spec.nk} = m.{spec.nk}))""",
        f"""{tag}d2 as (
  select d.{spec.nk}{kept}, d.{spec.sk} from {tag}d1 d left join {tag}m2 m on m.{spec.nk} = d.{spec.nk}
  union all
  select {columns}, {spec.sk} from {tag}new)""",
    ]


def _dim_sql(spec: DimSpec, body: str) -> str:
    source = _CHANGING_BRANCHES if spec is DIM_BRANCH else SILVER
    return _with(SALES, source, *_dim(spec)) + body


def _key(spec: DimSpec, expression: str) -> str:
    return f"cast({expression} as bigint) as {spec.sk}"


def _dim_table(spec: DimSpec, table: str = "d2") -> str:
    return _dim_sql(
        spec,
        f"select {', '.join(spec.member_columns)}, {_key(spec, spec.sk)} from {table}",
    )


def _classified(spec: DimSpec) -> str:
    columns = ", ".join(f"m.{c}" for c in spec.member_columns)
    return (
        f"select {columns}, {_key(spec, 'd.' + spec.sk)}"
        f" from m2 m left join d1 d on d.{spec.nk} = m.{spec.nk}"
    )


# fact ----------------------------------------------------------------------------------

_TAG = {DIM_BRANCH: "b", DIM_DEALER: "e", DIM_MODEL: "o", DIM_DATE: "t"}
_STAR = [SALES, SILVER, *[cte for s in DIMS for cte in _dim(s, _TAG[s])]]


def _fact(version: int, name: str = "fact") -> str:
    joins = "\n  ".join(
        f"left join {_TAG[s]}d{version} on {_TAG[s]}d{version}.{s.nk} = silver.{s.nk}" for s in DIMS
    )
    keys = ", ".join(f"cast({_TAG[s]}d{version}.{s.sk} as bigint) as {s.sk}" for s in DIMS)
    return f"""{name} as (
  select Revenue, Units_Sold, {keys}, silver.Date_ID
  from silver
  {joins})"""


_KEYS = ", ".join(s.sk for s in DIMS)
_NK = "Branch_ID, Dealer_ID, Model_ID, Date_ID"
_GRAIN_SUMS = (
    "cast(sum(Revenue) as bigint) as Revenue, cast(sum(Units_Sold) as bigint) as Units_Sold"
)


def _performance(spec: DimSpec) -> str:
    # names do not change in this feed, so members group by all their columns
    columns = ", ".join(spec.member_columns)
    return (
        _with(SALES)
        + f"""select {columns}, {_GRAIN_SUMS}, count(*) as n_sales,
       cast(sum(Revenue) as double) / nullif(cast(sum(Units_Sold) as bigint), 0) as revenue_per_unit
from sales group by {columns}"""
    )


_BAD = {
    "Revenue": "o_orderstatus = 'P'",
    "Units_Sold": "l_returnflag = 'R'",
    "Day": "(l_linestatus = 'O' and l_returnflag = 'A')",
}
_ANY_BAD = " or ".join(_BAD.values())
_REASON = "concat_ws(',', " + ", ".join(f"case when {c} then '{n}' end" for n, c in _BAD.items()) + ")"

_BLANK_IDS = """dirty as (
  select * replace (
    case when l_returnflag = 'R' then '  ' else Branch_ID end as Branch_ID,
    case when o_orderpriority <> '5-LOW' then ' ' || Dealer_ID || ' ' end as Dealer_ID,
    case when p_type = 'PROMO' then '' when p_type <> 'LARGE' then Model_ID end as Model_ID)
  from sales)"""


def _null_line(column: str) -> str:
    return (
        f"select '{column}' as column_name, count(*) as n_rows,"
        f" count(*) filter ({column} is null) as n_null,"
        f" count(*) filter (trim({column}) = '') as n_blank from dirty"
    )


_LANDED = _with(SALES) + f"""select {_BRONZE}
from (select * replace (Product_Name || ', ' || p_type as Product_Name) from sales)"""

_MODEL_VARIANTS = """case when p_type = 'PROMO' then replace(Model_ID, '-', '')
       when p_type = 'SMALL' then ''
       when p_type = 'MEDIUM' then Model_ID || '-X'
       when p_type <> 'LARGE' then Model_ID end"""


def _integrity(spec: DimSpec, column: str) -> str:
    return (
        f"select '{spec.name}' as dim_name, '{column}' as column_name, count(*) as n_rows,"
        f" count(*) filter ({column} is null) as n_null,"
        f" count({column}) - count(distinct {column}) as n_repeated from {_TAG[spec]}d2"
    )


ORACLES: dict[str, str] = {
    "conform_types": _LANDED,
    "csv_landing": _LANDED,
    "by_name_landing": _LANDED,
    "multi_line_landing": _LANDED.replace(
        "as Product_Name)", "as Product_Name, Branch_Name || ',' || chr(10) || ' \"' || Model_ID || '\"' as Branch_Name)"
    ),
    "stream_landing": _LANDED,
    "conform_accepted": _with(SALES) + f"select {_BRONZE} from sales where not ({_ANY_BAD})",
    "conform_rejects": _with(SALES)
    + f"""select Branch_ID, Dealer_ID, Model_ID,
       case when {_BAD["Revenue"]} then cast(Revenue as varchar) || '.5' else cast(Revenue as varchar) end as Revenue,
       case when {_BAD["Units_Sold"]} then 'R' else cast(Units_Sold as varchar) end as Units_Sold,
       Date_ID,
       case when {_BAD["Day"]} then '' else cast(Day as varchar) end as Day,
       cast(Month as varchar) as Month, cast(Year as varchar) as Year,
       Branch_Name as BranchName, o_orderpriority as DealerName, Product_Name,
       {_REASON} as reject_reason
from sales where {_ANY_BAD}""",
    "csv_landing_rejects": _with(SALES)
    + f"select {_REASON} as reject_reason, count(*) as n_rows from sales where {_ANY_BAD} group by 1",
    "landing_accounts": _with(SALES)
    + ", checked as ("
    + " union all ".join(
        f"""select '{folder}' as folder, Date_ID, {bad} as bad from sales"""
        for folder, bad in (("a", f"({_ANY_BAD})"), ("b", f"({_ANY_BAD} or o_orderpriority = '5-LOW')"))
    )
    + f""") select folder, count(*) as n_received, count(*) filter (not bad) as n_accepted,
       count(*) filter (bad) as n_rejected,
       count(*) filter (not bad and Date_ID > '{LOAD_BOUND}') as n_open
from checked group by folder""",
    "file_accounts": _with(SALES)
    + f""", placed as (select *, ({_ANY_BAD}) as bad,
       case when o_orderpriority = '5-LOW' then 'b' when Date_ID <= '{LOAD_BOUND}' then 'a' else 'c' end as folder,
       (select max(Date_ID) from sales where Date_ID <= '{LOAD_BOUND}' and o_orderpriority <> '5-LOW' and not ({_ANY_BAD})) as reached
  from sales)
select folder, count(*) as n_received, count(*) filter (bad) as n_rejected,
       count(*) filter (not bad and folder <> 'a' and Date_ID <= reached) as n_late,
       count(*) filter (not bad and Date_ID > reached) as n_open,
       count(*) filter (not bad and folder = 'a') as n_gold,
       cast(0 as bigint) as n_missing
from placed group by folder""",
    "typed_source": _with(SALES) + f"select {_BRONZE} from sales where o_orderpriority <> '5-LOW'",
    "late_files_star": _with(SALES)
    + "select Revenue, Units_Sold, Branch_ID, Dealer_ID, Model_ID, Date_ID from sales",
    "late_files_grain": _with(SALES)
    + """select cast(sum(Revenue) as bigint) as Revenue, cast(sum(Units_Sold) as bigint) as Units_Sold,
       Branch_ID, Dealer_ID, Model_ID, Date_ID, Year, Month
from sales group by Branch_ID, Dealer_ID, Model_ID, Date_ID, Year, Month""",
    "hwm_current": _with(SALES) + "select max(Date_ID) as max_date from sales",
    "hwm_window": _with(SALES)
    + f"select {_BRONZE} from sales where Date_ID > '{LOAD_BOUND}'"
    " and Date_ID <= (select max(Date_ID) from sales)",
    "hwm_advance": _with(SALES)
    + f"select greatest('{LOAD_BOUND}', max(Date_ID)) as last_load from sales",
    "state_lookup": _with(SALES) + "select max(Date_ID) as last_load from sales",
    "late_rows": _with(SALES)
    + f"""select o_orderstatus as source_file, count(*) filter (Date_ID <= '{LOAD_BOUND}') as late_rows
from sales group by 1""",
    # a load is named after the newest Date_ID that earlier extracts had reached
    "bronze_accumulate": _with(
        SALES,
        *[
            f"b{i} as (select max(Date_ID) as last_load from sales where Date_ID <= '{bound}')"
            for i, bound in enumerate(BRONZE_BOUNDS)
        ],
    )
    + f"""select {_BRONZE},
       case when Date_ID <= b0.last_load then '0'
            when Date_ID <= b1.last_load then b0.last_load
            else b1.last_load end as load
from sales cross join b0 cross join b1 where Date_ID is not null""",
    "silver_model_category": _with(SALES)
    + f"select Model_ID, split_part(Model_ID, '-', 1) as model_category"
    f" from (select {_MODEL_VARIANTS} as Model_ID from sales)",
    "silver_revenue_per_unit": _with(SALES)
    + """select Revenue, Units_Sold, cast(Revenue as double) / nullif(Units_Sold, 0) as revenue_per_unit
from (select Revenue, case when l_returnflag = 'R' then 0 else Units_Sold end as Units_Sold from sales)""",
    "silver_null_policy": _with(SALES, _BLANK_IDS)
    + "\nunion all ".join(_null_line(c) for c in ("Branch_ID", "Dealer_ID", "Model_ID", "Date_ID")),
    "silver_standardised": _with(SALES, _BLANK_IDS)
    + f"""select {_BRONZE} from (select * replace (nullif(trim(Branch_ID), '') as Branch_ID,
  nullif(trim(Dealer_ID), '') as Dealer_ID, nullif(trim(Model_ID), '') as Model_ID,
  nullif(trim(Date_ID), '') as Date_ID) from dirty)""",
    "silver_enriched": _with(SALES, SILVER) + f"select {', '.join(SILVER_COLUMNS)} from silver",
    "path_sql_scan": _with(SALES, SILVER) + f"select {', '.join(SILVER_COLUMNS)} from silver",
    "units_by_year_branch": _with(SALES)
    + """select Year, Branch_Name, cast(sum(Units_Sold) as bigint) as Total_Units_Sold
from sales group by Year, Branch_Name order by Year, Total_Units_Sold desc, Branch_Name""",
    "dim_members": _with(SALES, _CHANGING_BRANCHES, _members("m", DIM_BRANCH, "true"))
    + "select Branch_ID, Branch_Name from m",
    "dim_classify": _dim_sql(DIM_DATE, _classified(DIM_DATE)),
    "dim_known_members": _dim_sql(
        DIM_BRANCH, _classified(DIM_BRANCH) + f" where d.{DIM_BRANCH.sk} is not null"
    ),
    "dim_new_members": _dim_sql(DIM_DATE, "select Date_ID, Day, Month, Year from new"),
    "dim_first_load": _with(SALES)
    + """select Dealer_ID, row_number() over (order by Dealer_ID) as dim_dealer_key
from (select distinct Dealer_ID from sales where Dealer_ID is not null)""",
    "surrogate_keys_incremental": _dim_sql(
        DIM_DATE, f"select Date_ID, Day, Month, Year, {_key(DIM_DATE, DIM_DATE.sk)} from new"
    ),
    "dim_union": _dim_sql(
        DIM_DEALER,
        f"select Dealer_ID, {_key(DIM_DEALER, DIM_DEALER.sk)} from new union all "
        + _classified(DIM_DEALER)
        + f" where d.{DIM_DEALER.sk} is not null",
    ),
    "scd1_upsert_model": _dim_table(DIM_MODEL),
    "scd1_upsert_branch": _dim_table(DIM_BRANCH),
    "catalog_scan": _dim_table(DIM_MODEL),
    **{spec.name: _dim_table(spec) for spec in DIMS},
    "fact_sales": _with(*_STAR, _fact(2)) + f"select Revenue, Units_Sold, {_KEYS} from fact",
    "fact_unmatched": _with(*_STAR, _fact(1)) + f"select Revenue, Units_Sold, {_KEYS} from fact",
    "fact_upsert": _with(
        *_STAR,
        _fact(2),
        f"src as (select {_GRAIN_SUMS}, {_KEYS}, min(Date_ID) as Date_ID from fact group by {_KEYS})",
        f"tgt as (select * from src where Date_ID <= '{LOAD_BOUND}')",
        "upd as (select * replace (Revenue + 1 as Revenue) from src)",
    )
    + """select case when s.dim_date_key is not null then s.Revenue else t.Revenue end as Revenue,
       case when s.dim_date_key is not null then s.Units_Sold else t.Units_Sold end as Units_Sold,
       coalesce(s.dim_branch_key, t.dim_branch_key) as dim_branch_key,
       coalesce(s.dim_dealer_key, t.dim_dealer_key) as dim_dealer_key,
       coalesce(s.dim_model_key, t.dim_model_key) as dim_model_key,
       coalesce(s.dim_date_key, t.dim_date_key) as dim_date_key
from tgt t full join upd s on s.dim_branch_key = t.dim_branch_key
  and s.dim_dealer_key = t.dim_dealer_key and s.dim_model_key = t.dim_model_key
  and s.dim_date_key = t.dim_date_key""",
    "fact_upsert_null_keys": _with(
        *_STAR, _fact(1), f"grain as (select {_GRAIN_SUMS}, {_KEYS} from fact group by {_KEYS})"
    )
    + f"""select true as null_safe, count(*) as n_rows from grain
union all
select false, count(*) + count(*) filter ({" or ".join(f"{s.sk} is null" for s in DIMS)}) from grain""",
    "merge_conflicts": _with(SALES)
    + f"""select {_NK}, count(*) as n_source from sales
where Branch_ID is not null and Dealer_ID is not null and Model_ID is not null and Date_ID is not null
group by {_NK} having count(*) > 1""",
    "two_load_star": _with(*_STAR, _fact(2))
    + f"""select Revenue, Units_Sold, bd2.Branch_ID, ed2.Dealer_ID, od2.Model_ID, td2.Date_ID,
       fact.dim_branch_key, fact.dim_dealer_key, fact.dim_model_key, fact.dim_date_key
from fact left join bd2 using (dim_branch_key) left join ed2 using (dim_dealer_key)
  left join od2 using (dim_model_key) left join td2 using (dim_date_key)""",
    "two_load_grain": _with(SALES)
    + f"select {_GRAIN_SUMS}, {_NK}, Year, Month from sales group by {_NK}, Year, Month",
    "layer_counts": _with(SALES)
    + "select 'fact_sales' as table_name, count(*) as n_rows from sales"
    + "".join(f"\nunion all select '{s.name}', count(distinct {s.nk}) from sales" for s in DIMS),
    "dq_date_id": _with(SALES)
    + """select Date_ID, count(*) as n_days
from (select distinct Date_ID, cast(l_shipdate as date) as shipped from sales)
group by Date_ID having count(*) > 1""",
    "dq_key_integrity": _with(*_STAR)
    + "\nunion all ".join(_integrity(s, c) for s in DIMS for c in (s.sk, s.nk)),
    "dq_unmatched": _with(*_STAR, _fact(1))
    + "\nunion all ".join(
        f"select '{s.name}' as dim_name, count(*) as n_rows,"
        f" count(*) filter ({s.sk} is null) as n_unmatched from fact"
        for s in DIMS
    ),
    "dq_fact_totals": _with(SALES)
    + f"""select t.table_name, count(*) as n_rows, {_GRAIN_SUMS}
from sales cross join (values ('silver'), ('fact_sales')) t(table_name) group by t.table_name""",
    "dealer_performance": _performance(DIM_DEALER),
    "branch_performance": _performance(DIM_BRANCH),
    "model_trend": _with(SALES, SILVER)
    + f"""select model_category, Year, Month, {_GRAIN_SUMS}
from silver group by model_category, Year, Month""",
    "revenue_growth": _with(
        SALES,
        """yearly as (select Branch_ID, Branch_Name, Year, cast(sum(Revenue) as bigint) as Revenue
  from sales group by Branch_ID, Branch_Name, Year)""",
        """lagged as (select *, case when lag(Year) over (partition by Branch_ID order by Year) = Year - 1
    then lag(Revenue) over (partition by Branch_ID order by Year) end as previous_revenue
  from yearly)""",
    )
    + """select Branch_ID, Branch_Name, Year, Revenue, previous_revenue,
       cast(Revenue - previous_revenue as double) / nullif(previous_revenue, 0) as growth
from lagged""",
}
ORACLES["surrogate_keys_initial"] = ORACLES["dim_first_load"]
ORACLES["fact_grain"] = (
    _with(
        SALES,
        SILVER,
        *[
            f"k_{s.name} as (select {s.nk}, row_number() over (order by {s.nk}) as {s.sk}"
            f" from (select distinct {s.nk} from sales where {s.nk} is not null))"
            for s in DIMS
        ],
    )
    + f"select {_GRAIN_SUMS}, {_KEYS} from sales "
    + " ".join(f"left join k_{s.name} using ({s.nk})" for s in DIMS)
    + f" group by {_KEYS}"
)
