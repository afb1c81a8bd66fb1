"""Names of the housekeeping columns and codes shared by all operators."""

from __future__ import annotations

# Column names, codes and load types that stored tables and
# control rows already carry.
OP_CODE = "op_code"
TIME_KEY = "time_key"
DELETED_FLAG = "hvr_is_deleted"
LOAD_STAMP = "load_ts"
UPDATED_BY = "hive_updated_by"
UPDATED_DATE = "hive_updated_date"
HOUSEKEEPING = (UPDATED_BY, UPDATED_DATE, OP_CODE, TIME_KEY, DELETED_FLAG, LOAD_STAMP)

OP_DELETE = 0
OP_INSERT = 1
OP_IGNORED = 5

FULL = "FULL"
INCREMENTAL = "INCREMENTAL"
APPEND_ONLY = "APPEND_ONLY"
LOAD_TYPES = (FULL, INCREMENTAL, APPEND_ONLY)

STATUS_RUNNING = "R"
STATUS_COMPLETED = "C"
STATUS_ERROR = "E"


def check_load_type(load_type: str) -> str:
    if load_type not in LOAD_TYPES:
        raise ValueError(f"unknown load type {load_type!r}, expected one of {LOAD_TYPES}")
    return load_type
