"""Best-effort coercion: bad values become null, nothing raises, never NaN."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings accepted as a flag, exact case.
TRUE_TOKENS = ["1", "1.0", "true", "True", "TRUE", "y", "Y", "yes", "YES"]
FALSE_TOKENS = ["0", "0.0", "false", "False", "FALSE", "n", "N", "no", "NO"]
# Spellings of the home and the away side, any case.
HOME_TOKENS = ["true", "1", "y", "yes", "home", "vs"]
AWAY_TOKENS = ["false", "0", "n", "no", "away", "@"]

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def literal_map(values: dict, dtype: str = "map<string,string>") -> Column:
    """A constant map, passed as one literal and folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(values)), dtype)


def null_of(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def number(value: Column) -> Column:
    """Numeric column as double with NaN turned into null."""
    return F.nanvl(value.try_cast("double"), null_of("double"))


def number_text(value: Column) -> Column:
    """Text to double; text that is not a plain number becomes null."""
    text = value.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def whole(value: Column) -> Column:
    """Double to bigint, only where it is integral."""
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def num_of(df: DataFrame, name: str) -> Column:
    """Double value of a column, whatever its type."""
    dtype = type_of(df, name)
    return number_text(F.col(name)) if isinstance(dtype, T.StringType) else number(F.col(name))


def int_of(df: DataFrame, name: str) -> Column:
    """Bigint value of a column, whatever its type; fractions become null."""
    dtype = type_of(df, name)
    value = F.col(name)
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return value.cast("bigint")
    if isinstance(dtype, T.StringType):
        return F.coalesce(value.try_cast("bigint"), whole(number_text(value)))
    return whole(number(value))


def text_of(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string")


# Date forms of the feeds besides ISO, in the order in which they are tried.
DATE_FORMS = ["M/d/yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyyMMdd", "yyyy/M/d", "M-d-yyyy"]


def date_of(value: Column) -> Column:
    """Date of a date, timestamp or text column (ISO or ``DATE_FORMS``); unreadable text is null."""
    text = F.trim(value.cast("string"))
    return F.coalesce(value.try_cast("date"), *[F.try_to_date(text, form) for form in DATE_FORMS])


def date_text(value: Column) -> Column:
    return F.date_format(date_of(value), "yyyy-MM-dd")


def flag(value: Column, default: bool | None = None) -> Column:
    """Three-valued boolean from the accepted tokens."""
    text = value.cast("string")
    out = F.when(text.isin(TRUE_TOKENS), True).when(text.isin(FALSE_TOKENS), False)
    return out if default is None else F.when(value.isNull(), F.lit(default)).otherwise(out)


def flag_int(value: Column) -> Column:
    """0/1 (or the truncated number behind the text); null and junk count as 0."""
    text = value.cast("string")
    truncated = number_text(text).try_cast("bigint")
    return F.coalesce(flag(value).cast("bigint"), truncated, F.lit(0).cast("bigint"))


def flag_of(df: DataFrame, name: str) -> Column:
    """Three-valued boolean of a column; only text is compared as text."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.BooleanType):
        return F.col(name)
    if isinstance(dtype, T.NumericType):
        return F.when(F.col(name) == 1, True).when(F.col(name) == 0, False)
    return flag(F.col(name))


def flag_int_of(df: DataFrame, name: str) -> Column:
    """0/1 of a column, null and junk counting as 0; only text is compared as text."""
    dtype = type_of(df, name)
    zero = F.lit(0).cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.col(name).cast("bigint"), zero)
    if isinstance(dtype, T.NumericType):
        return F.coalesce(number(F.col(name)).try_cast("bigint"), zero)
    return flag_int(F.col(name))


def home_flag(value: Column) -> Column:
    token = F.lower(F.trim(value.cast("string")))
    return F.when(token.isin(HOME_TOKENS), True).when(token.isin(AWAY_TOKENS), False)


def blank_to_null(value: Column) -> Column:
    trimmed = F.trim(value)
    return F.when(trimmed != "", trimmed)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, null when the denominator is null or zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def either(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def any_null(columns: list[Column]) -> Column:
    return either([c.isNull() for c in columns])
