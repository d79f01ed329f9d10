"""Column expressions: time parsing and formatting, ratio rounding, bucket
predicates and the ``k=v|k=v`` record codec. All are built-in Spark
expressions evaluated in the JVM (no Python); all but the array lambdas of
``set_record_field`` are compiled by whole-stage code generation."""

from sessionscope.functions.buckets import STEP_BUCKETS, VISIT_BUCKETS, Bucket, bucket_sql
from sessionscope.functions.numbers import ratio_half_up
from sessionscope.functions.records import encode_record, record_field, set_record_field
from sessionscope.functions.timefmt import (
    date_hour, date_key, format_action_time, format_date, format_time, minute_key, parse_action_time,
    parse_date_key, seconds_between, time_after, time_before, today, yesterday,
)

__all__ = [
    "Bucket", "STEP_BUCKETS", "VISIT_BUCKETS", "bucket_sql", "ratio_half_up",
    "encode_record", "record_field", "set_record_field", "date_hour", "date_key", "format_action_time",
    "format_date", "format_time", "minute_key", "parse_action_time", "parse_date_key", "seconds_between",
    "time_after", "time_before", "today", "yesterday",
]
