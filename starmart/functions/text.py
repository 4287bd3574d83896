"""JSON text, message keys and lenient parsing of numbers, flags and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def encode_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """All (or the named) columns as one JSON object; nulls are written, NaN is written as null."""
    fields = []
    for field in df.schema:
        if columns is not None and field.name not in columns:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = nan_to_null(value)
        fields.append(value.alias(field.name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def message_key(*columns: str) -> Column:
    """Key text: the parts joined by ``_``, a missing part spelled ``None``."""
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])


#: how every text begins that reads as a real number, the spellings of infinity and NaN among them
REAL_START = r"^[\x00-\x20]*[+-]?([0-9.]|(?i:inf|nan))"


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def number_text(raw: Column) -> Column:
    """Text of a JSON scalar without the quotes a non-standard token such as NaN arrives with."""
    return F.trim(F.btrim(raw, F.lit('"')))


def has_number_text(raw: Column) -> Column:
    """Whether a JSON scalar says something: neither missing, empty nor a spelling of no value."""
    return F.coalesce(~F.lower(number_text(raw)).isin("", "nan", "null", "none"), F.lit(False))


def lenient(raw: Column, target: T.DataType) -> Column:
    """Parse JSON scalar text as ``target``; text that does not fit becomes NULL, never an error.

    Integers are accepted as ``1``, ``1.0`` or ``"1"`` but not as ``1.5``; NaN becomes NULL.
    """
    if isinstance(target, T.StringType):
        return raw
    text = number_text(raw)
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # a failed cast costs an exception per row, so the common "5.0" must not be tried as a BIGINT, nor words as a number
        real = text.try_cast("double")
        whole = F.when(real == F.floor(real), real.try_cast("bigint"))
        digits = text.rlike(r"^[+-]?[0-9]{1,19}$")
        return F.when(digits, text.try_cast("bigint")).when(text.rlike(REAL_START), whole).try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.when(text.rlike(REAL_START), text.try_cast(target)))
    return text.try_cast(target)


def parse_time(raw: Column) -> Column:
    """ISO text to a timestamp, NULL if it cannot be read (without the cost of an exception per bad row)."""
    return raw.try_cast("timestamp")
