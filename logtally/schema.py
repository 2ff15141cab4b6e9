"""Schemas and fixed values of the audit log."""

from __future__ import annotations

from pyspark.sql import types as T

# They name things in the source data and must stay as they are.
TUTORIAL_MAP = "s000"
TICKET_ITEM = "safari-zone-ticket"
KST_OFFSET_HOURS = 9
ARCHIVE_EPOCH = "2026-01-01"
SERIES_DAYS = 90

# One line of an archive object. ``ip`` is readable here and stored nowhere.
ARCHIVE_LINE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("account_id", T.IntegerType()),
        T.StructField("action", T.StringType()),
        T.StructField("status", T.ShortType()),
        T.StructField("detail", T.VariantType()),
        T.StructField("ip", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("account_id", T.IntegerType()),
        T.StructField("action", T.StringType()),
        T.StructField("status", T.ShortType()),
        T.StructField("detail", T.VariantType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)

LOAD_LOG = T.StructType(
    [
        T.StructField("run_at", T.TimestampNTZType()),
        T.StructField("scanned_from", T.DateType()),
        T.StructField("files_scanned", T.LongType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("max_id", T.LongType()),
    ]
)

LOADED_OBJECTS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)

SOURCE_SHAPE = T.StructType(
    [
        T.StructField("observed_at", T.TimestampNTZType()),
        T.StructField("sampled", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
    ]
)


def _strings(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names.split()])


# Columns of the dimension files that the views read; all strings.
POKEMON_FILE = _strings(
    "id comment type1 type2 tier generation growth_group"
    " rate_capture rate_flee height_m weight_kg base_exp"
)
ITEM_FILE = _strings("id comment category tier buy sell purchasable sellable")
DIM_VERSION = T.StructType(
    [
        T.StructField("sha", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
    ]
)
