"""Text to typed value, as Column expressions. Null means "does not convert".

Each conversion tries the plain form first, on a cheap shape test, and looks at the
rarer accepted forms only where that fails.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The shapes of the two accepted date formats. A day may be written as a
# blank and one digit; a year always has four digits.
_US_DATE = r"\A[0-9]{1,2}/(?:[0-9]{1,2}| [1-9])/(?!0000)[0-9]{4}\z"
_ISO_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{1,2}-(?:[0-9]{1,2}| [1-9])\z"

# Number shapes. Blanks around a number and single underscores between
# digits are allowed; a whole number may carry a zero fraction but no exponent.
_PLAIN_INTEGER = r"\A[+-]?[0-9]{1,18}\z"
_INTEGER = r"\A[+-]?[0-9]+(?:_[0-9]+)*(?:\.0+)?\z"
_PLAIN_NUMBER = r"\A[+-]?[0-9]{1,300}(?:\.[0-9]*)?\z"
_NUMBER = (
    r"\A(?!.*__)(?!.*_\z)[+-]?"
    r"(?:[0-9][0-9_]*(?:\.[0-9_]*)?|\.[0-9][0-9_]*)(?:[eE][+-]?[0-9][0-9_]*)?\z"
)
_BLANKS = " \t\n\r\f\x0b\xa0"


def parse_date(text: Column) -> Column:
    """``M/D/YYYY`` or ``YYYY-M-D``; anything else, or no such day, is null."""
    month = F.substring_index(text, "/", 1)
    day = F.ltrim(F.substring_index(F.substring_index(text, "/", 2), "/", -1))
    year = F.substring_index(text, "/", -1)
    iso = F.when(F.contains(text, F.lit(" ")), F.replace(text, F.lit(" "), F.lit(""))).otherwise(text)
    return F.when(text.rlike(_US_DATE), F.concat_ws("-", year, month, day).try_cast("date")).when(
        text.rlike(_ISO_DATE), iso.try_cast("date")
    )


def _bare(text: Column) -> Column:
    return F.btrim(text, F.lit(_BLANKS))


def to_integer(text: Column, dtype: T.DataType) -> Column:
    """Whole numbers, also written ``250.0``; out of range is null."""
    whole = F.translate(F.substring_index(_bare(text), ".", 1), "_", "")
    return F.when(text.rlike(_PLAIN_INTEGER), text.try_cast(dtype)).when(
        _bare(text).rlike(_INTEGER), whole.try_cast(dtype)
    )


def to_double(text: Column) -> Column:
    """Finite numbers in decimal or exponent notation."""
    value = F.translate(_bare(text), "_", "").try_cast("double")
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double")).when(
        _bare(text).rlike(_NUMBER) & (F.abs(value) < float("inf")), value
    )


def coerce(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return parse_date(text)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return to_integer(text, dtype)
    if isinstance(dtype, T.DoubleType):
        return to_double(text)
    return text
