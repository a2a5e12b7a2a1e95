"""Scalar functions for SQL scripts, as temporary SQL functions that Spark inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from millrace.functions.dates import VOID_PARTITION
from millrace.functions.status import GRADES, SEVERITY

_DAY = "try_to_timestamp(substring(trim(c), 1, 10), 'yyyy-MM-dd')"
_SECOND = "try_to_timestamp(substring(trim(c), 1, 19), 'yyyy-MM-dd HH:mm:ss')"
_GRADE_MAP = ", ".join(f"'{k}', '{v}'" for k, v in GRADES.items())

FUNCTIONS = {
    "status_rank(c STRING) RETURNS INT": f"CASE WHEN length(c) = 1 THEN instr('{SEVERITY}', c) ELSE 0 END",
    "status_grade(c STRING) RETURNS STRING": f"map({_GRADE_MAP})[c]",
    "is_integer_text(c STRING) RETURNS BOOLEAN": "c RLIKE '^[-+]?[0-9]*$'",
    "is_valid_date(c STRING) RETURNS BOOLEAN": f"{_DAY} IS NOT NULL",
    "is_valid_datetime(c STRING) RETURNS BOOLEAN": f"{_SECOND} IS NOT NULL",
    "date_partition(c STRING) RETURNS STRING": (
        f"CASE WHEN c IS NULL OR trim(c) = '' THEN '{VOID_PARTITION}' "
        f"WHEN {_DAY} IS NOT NULL THEN date_format({_DAY}, 'yyyy/MM/dd') "
        "ELSE cast(raise_error(concat('not a date or datetime: ', c)) AS STRING) END"
    ),
    "month_of(c STRING) RETURNS STRING": "substring(c, 1, 6)",
}


def register(spark: SparkSession) -> list[str]:
    """Create all functions in the session; returns their names."""
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in FUNCTIONS]
