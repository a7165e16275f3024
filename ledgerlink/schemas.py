"""Fixed schemas and the required-column contract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and types of the two source lists and of the registry,
# equal to the reference's so its data and queries carry over unchanged.
SOURCE1_SCHEMA = T.StructType([
    T.StructField("corporate_name_s1", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("activity_places", T.StringType()),
    T.StructField("top_suppliers", T.StringType()),
])

# revenue/profit arrive as text in CSV and are converted with try_cast
SOURCE2_RAW_SCHEMA = T.StructType([
    T.StructField("corporate_name_s2", T.StringType()),
    T.StructField("main_customers", T.StringType()),
    T.StructField("revenue", T.StringType()),
    T.StructField("profit", T.StringType()),
])

REGISTRY_SCHEMA = T.StructType([
    T.StructField("corporate_id", T.StringType()),
    T.StructField("canonical_name", T.StringType()),
    T.StructField("canonical_address", T.StringType()),
    T.StructField("activity_places", T.StringType()),
    T.StructField("top_suppliers", T.StringType()),
    T.StructField("main_customers", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("profit", T.DoubleType()),
    T.StructField("match_confidence", T.DoubleType()),
    T.StructField("source1_present", T.BooleanType()),
    T.StructField("source2_present", T.BooleanType()),
    T.StructField("last_updated_ts", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("match_type", T.StringType()),
])
REGISTRY_COLUMNS = [f.name for f in REGISTRY_SCHEMA.fields]
REGISTRY_KEY = "corporate_id"

# The four link kinds a registry row can carry.
MATCH_TYPES = ("exact_name", "fuzzy_name", "source1_only", "source2_only")

LIST_COLUMNS = ("top_suppliers", "main_customers", "activity_places")
FEATURE_COUNT_COLUMNS = ("num_top_suppliers", "num_main_customers", "num_activity_places")


class ContractError(ValueError):
    """A DataFrame lacks columns (or types) an operator needs."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input",
                    types: dict[str, T.DataType] | None = None) -> None:
    """Fail before any job runs when required columns are absent or mistyped."""
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c not in present]
    if missing:
        raise ContractError(f"{what} is missing required columns: {missing}")
    wrong = [f"{c}: {present[c].simpleString()} != {t.simpleString()}"
             for c, t in (types or {}).items() if c in present and present[c] != t]
    if wrong:
        raise ContractError(f"{what} has mistyped columns: {wrong}")
