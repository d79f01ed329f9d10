"""The ``k=v|k=v`` text form of a session record.

Older outputs keep a session as one text value. ``record_field`` reads one
field back as a column expression: of the ``|``-separated parts, those that
split on ``=`` into exactly two pieces with a non-empty value count, and the
first whose key matches wins. A missing field, an empty value and a value
containing ``=`` all read as NULL.
``encode_record`` writes the text form from named columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELD_SEPARATOR = "|"
KEY_VALUE_SEPARATOR = "="

# Field names of the text session record.
FIELD_SESSION_ID = "sessionid"
FIELD_SEARCH_KEYWORDS = "searchKeywords"
FIELD_CLICK_CATEGORY_IDS = "clickCategoryIds"
FIELD_AGE = "age"
FIELD_PROFESSIONAL = "professional"
FIELD_CITY = "city"
FIELD_SEX = "sex"
FIELD_VISIT_LENGTH = "visitLength"
FIELD_STEP_LENGTH = "stepLength"

# record field -> (our column, type)
SESSION_RECORD_FIELDS = {
    FIELD_SESSION_ID: ("session_id", "string"),
    FIELD_SEARCH_KEYWORDS: ("search_keywords", "string"),
    FIELD_CLICK_CATEGORY_IDS: ("click_category_ids", "string"),
    FIELD_VISIT_LENGTH: ("visit_length", "bigint"),
    FIELD_STEP_LENGTH: ("step_length", "bigint"),
    FIELD_AGE: ("age", "int"),
    FIELD_PROFESSIONAL: ("professional", "string"),
    FIELD_CITY: ("city", "string"),
    FIELD_SEX: ("sex", "string"),
}


def _field_pattern(field: str) -> str:
    # a whole part "field=value": value non-empty and without "|" or "=";
    # trailing "=" are allowed, since splitting drops trailing empty pieces
    return r"(?:^|\|)" + re.escape(field) + r"=([^|=]+)=*(?:\||$)"


def record_field(record: Column, field: str) -> Column:
    """Value of the first part ``field=value`` that splits on ``=`` into
    exactly two pieces with a non-empty value; NULL when there is none."""
    return F.nullif(F.regexp_extract(record, _field_pattern(field), 1), F.lit(""))


def set_record_field(record: Column, field: str, value: Column) -> Column:
    """Replace the first part named ``field`` (the text before its first
    ``=``) by ``field=value``; a record without such a part is unchanged."""
    parts = F.split(record, r"\|")
    names = F.transform(parts, lambda p: F.substring_index(p, KEY_VALUE_SEPARATOR, 1))
    at = F.array_position(names, F.lit(field))
    new_part = F.concat(F.lit(f"{field}{KEY_VALUE_SEPARATOR}"), F.coalesce(value.cast("string"), F.lit("")))
    replaced = F.transform(parts, lambda p, i: F.when(i == at - 1, new_part).otherwise(p))
    return F.when(at > 0, F.array_join(replaced, FIELD_SEPARATOR)).otherwise(record)


def encode_record(fields: dict[str, Column]) -> Column:
    """Join ``key=value`` pairs with ``|``; NULL values become empty text."""
    parts = [F.concat(F.lit(f"{key}{KEY_VALUE_SEPARATOR}"), F.coalesce(value.cast("string"), F.lit("")))
             for key, value in fields.items()]
    return F.concat_ws(FIELD_SEPARATOR, *parts)


def encode_sessions(rendered: DataFrame) -> DataFrame:
    """Session records (lists already rendered as text) to one text column."""
    return rendered.select(encode_record(
        {field: F.col(col) for field, (col, _) in SESSION_RECORD_FIELDS.items()}).alias("record"))


# every readable part, in order: its key, and its value (same matches)
_READABLE_KEYS = r"(?:^|\|)([^|=]+)=[^|=]+=*(?=\||$)"
_READABLE_VALUES = r"(?:^|\|)[^|=]+=([^|=]+)=*(?=\||$)"


def decode_sessions(encoded: DataFrame, record_col: str = "record") -> DataFrame:
    """Text session records back to typed columns; empty values are NULL.

    Two scans per record list the readable parts' keys and values; a field
    is the value at its key's first position — what ``record_field`` returns
    (a test checks they agree), with two regex scans instead of one per field.
    """
    rec = F.col(record_col)
    parts = encoded.select(F.regexp_extract_all(rec, F.lit(_READABLE_KEYS), 1).alias("_k"),
                           F.regexp_extract_all(rec, F.lit(_READABLE_VALUES), 1).alias("_v"))
    return parts.select(*[
        F.get(F.col("_v"), F.array_position(F.col("_k"), F.lit(field)) - 1).try_cast(typ).alias(col)
        for field, (col, typ) in SESSION_RECORD_FIELDS.items()])
