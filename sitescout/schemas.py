"""Explicit schemas of the raw files, and the key of each derived table.

The field names are fixed values: the files have them.
"""

from __future__ import annotations

from pyspark.sql import types as T

from sitescout.settings import TABLES


def _fields(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


CORRUPT = "_corrupt_record"

_text, _int, _double = T.StringType(), T.IntegerType(), T.DoubleType()

RAW_BUSINESS = _fields(
    ("business_id", _text),
    ("name", _text),
    ("neighborhood", _text),
    ("address", _text),
    ("city", _text),
    ("state", _text),
    ("postal_code", _text),
    ("latitude", _double),
    ("longitude", _double),
    ("stars", _double),
    ("review_count", _int),
    ("is_open", _int),
    ("categories", T.ArrayType(_text)),
)

# weekday -> hour label -> count; a map, because inference would make one field per day and hour
CHECKIN_TIMES = T.MapType(_text, T.MapType(_text, _int))
RAW_CHECKIN = _fields(("business_id", _text), ("time", CHECKIN_TIMES))

RAW_TIP = _fields(("business_id", _text), ("user_id", _text), ("date", _text), ("text", _text))

RAW_USER = _fields(
    ("user_id", _text),
    ("name", _text),
    ("yelping_since", _text),
    ("fans", _int),
    ("review_count", _int),
)

LEXICON = _fields(("word", _text), ("sentiment", _int))
NAME_GENDER = _fields(("name", _text), ("gender", _text))

# A write to a table replaces the row that has the same key.
KEYS: dict[str, tuple[str, ...]] = {
    TABLES.business_categories: ("business_id", "category"),
    TABLES.category_profiles: ("business_id",),
    TABLES.business_similarity: ("profile_id1", "profile_id2"),
    TABLES.checkin_hourly: ("business_id", "day_of_week", "day_hour"),
    TABLES.checkin_daily: ("business_id", "day_of_week"),
    TABLES.categories: ("category",),
    TABLES.users: ("user_id",),
    TABLES.name_gender: ("name", "gender"),
    TABLES.directory: ("business_id", "city", "state"),
    TABLES.sentiments: ("business_id",),
    TABLES.positive_words: ("word",),
    TABLES.negative_words: ("word",),
}
