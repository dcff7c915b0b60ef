from tidemark.functions.jsontext import json_text
from tidemark.functions.normalize import normalize_row, normalize_value
from tidemark.functions.temporal import (
    index_text,
    interval_time_of_day,
    iso_date,
    iso_time,
    iso_timestamp,
    micros_time_of_day,
    replace_zero_dates,
    zero_date_default,
)
from tidemark.functions.text import (
    ascii_fold,
    binary_text,
    decimal_text,
    fit_to_width,
    replace_invalid_utf8,
    truncate_text,
    uuid_text,
)

__all__ = [
    "ascii_fold",
    "binary_text",
    "decimal_text",
    "fit_to_width",
    "index_text",
    "interval_time_of_day",
    "iso_date",
    "iso_time",
    "iso_timestamp",
    "json_text",
    "micros_time_of_day",
    "normalize_row",
    "normalize_value",
    "replace_invalid_utf8",
    "replace_zero_dates",
    "truncate_text",
    "uuid_text",
    "zero_date_default",
]
