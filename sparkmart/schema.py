"""Column layouts of every layer and the four dimension specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names and types every layer must carry.
RAW_COLUMNS = (
    "Branch_ID",
    "Dealer_ID",
    "Model_ID",
    "Revenue",
    "Units_Sold",
    "Date_ID",
    "Day",
    "Month",
    "Year",
    "BranchName",
    "DealerName",
    "Product_Name",
)

# raw name, canonical name, Spark type (tinyint 0..255 needs SMALLINT here)
MAPPING = (
    ("Branch_ID", "Branch_ID", "string"),
    ("Dealer_ID", "Dealer_ID", "string"),
    ("Model_ID", "Model_ID", "string"),
    ("Revenue", "Revenue", "bigint"),
    ("Units_Sold", "Units_Sold", "bigint"),
    ("Date_ID", "Date_ID", "string"),
    ("Day", "Day", "smallint"),
    ("Month", "Month", "smallint"),
    ("Year", "Year", "smallint"),
    ("BranchName", "Branch_Name", "string"),
    ("Product_Name", "Product_Name", "string"),
)

#: Raw columns whose sink type, an unsigned byte, is narrower than the Spark type here.
LIMITS = {"Day": (0, 255), "Month": (0, 255)}

DATE_ID_PATTERN = r"^DT[0-9]{5}\z"
WHOLE_NUMBER = "^ *[+-]?[0-9]+ *$"

MEASURES = ("Revenue", "Units_Sold")
NATURAL_KEYS = ("Branch_ID", "Dealer_ID", "Model_ID", "Date_ID")

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "smallint": T.ShortType()}

#: Column with the text of a row that has too few, too many or broken fields.
CORRUPT = "_corrupt_row"

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])
BRONZE = T.StructType([T.StructField(name, _TYPES[t]) for _, name, t in MAPPING])
BRONZE_COLUMNS = tuple(BRONZE.names)
LANDED = T.StructType(
    [
        *BRONZE.fields,
        T.StructField("reject_reason", T.StringType()),
        T.StructField("received", RAW),
        T.StructField("raw_text", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("landing", T.StringType()),
    ]
)
#: Hidden column of bronze, silver and the row fact: the landed file of a row, NULL for other sources.
LINEAGE = T.StructField("source_file", T.StringType())
#: One row per landed file. ``landed_at`` is the position of bronze when it first landed, ``taken``
#: the load that took what was left of it.
LEDGER = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("source_file", "source_path", "landing", "landed_at")],
        *[T.StructField(c, T.LongType()) for c in ("n_received", "n_accepted", "n_rejected", "n_late")],
        *[T.StructField(c, T.StringType()) for c in ("min_date", "max_date", "taken")],
    ]
)
#: One row per live folder of a table: its load or part, and where it lies below the table.
LIVE = T.StructType([T.StructField(c, T.StringType()) for c in ("table_name", "part", "folder")])
SILVER = T.StructType(
    [
        *BRONZE.fields,
        T.StructField("model_category", T.StringType()),
        T.StructField("revenue_per_unit", T.DoubleType()),
    ]
)
SILVER_COLUMNS = tuple(SILVER.names)
WATERMARK = T.StructType([T.StructField("last_load", T.StringType())])


@dataclass(frozen=True)
class DimSpec:
    """One dimension: its natural key, its attributes and its surrogate key."""

    name: str
    nk: str
    attrs: tuple[str, ...]
    sk: str

    @property
    def member_columns(self) -> tuple[str, ...]:
        return (self.nk, *self.attrs)

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.member_columns, self.sk)

    @property
    def schema(self) -> T.StructType:
        fields = [SILVER[c] for c in self.member_columns]
        return T.StructType([*fields, T.StructField(self.sk, T.LongType())])


DIM_BRANCH = DimSpec("dim_branch", "Branch_ID", ("Branch_Name",), "dim_branch_key")
DIM_DEALER = DimSpec("dim_dealer", "Dealer_ID", (), "dim_dealer_key")
DIM_MODEL = DimSpec("dim_model", "Model_ID", ("model_category",), "dim_model_key")
# Day, Month and Year ride along so that trends need no second look at silver.
DIM_DATE = DimSpec("dim_date", "Date_ID", ("Day", "Month", "Year"), "dim_date_key")

DIMS = (DIM_BRANCH, DIM_DEALER, DIM_MODEL, DIM_DATE)
FACT_KEYS = tuple(d.sk for d in DIMS)

FACT = T.StructType(
    [SILVER[c] for c in MEASURES] + [T.StructField(k, T.LongType()) for k in FACT_KEYS]
)
FACT_COLUMNS = tuple(FACT.names)
