"""Source type names and their Spark types, and conversions between types."""

from __future__ import annotations

from pyspark.sql import Column as Expr
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ChangeError

# Type names of the change protocol and the bounds of its decimals.
SOURCE_TYPES: dict[str, T.DataType] = {
    "BOOLEAN": T.BooleanType(),
    "SHORT": T.ShortType(),
    "INT": T.IntegerType(),
    "LONG": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "NAIVE_DATE": T.DateType(),
    "NAIVE_TIME": T.TimeType(6),
    "NAIVE_DATETIME": T.TimestampNTZType(),
    "UTC_DATETIME": T.TimestampType(),
    "BINARY": T.BinaryType(),
    "STRING": T.StringType(),
    "JSON": T.StringType(),
    "XML": T.StringType(),
}
DECIMAL_MAX_PRECISION = 38
DECIMAL_DEFAULT = (18, 3)

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def spark_type(name: str, precision: int | None = None, scale: int | None = None) -> T.DataType:
    """Spark type of a source type name; decimals take a precision (1..38) and a scale (0..precision)."""
    if name == "DECIMAL":
        if precision is None:
            return T.DecimalType(*DECIMAL_DEFAULT)
        scale = scale or 0
        if not 1 <= precision <= DECIMAL_MAX_PRECISION:
            raise ChangeError(f"Decimal precision must be between 1 and {DECIMAL_MAX_PRECISION}, got {precision}")
        if not 0 <= scale <= precision:
            raise ChangeError(f"Decimal scale must be between 0 and the precision {precision}, got {scale}")
        return T.DecimalType(precision, scale)
    if name not in SOURCE_TYPES:
        raise ChangeError(f"Cannot convert source type <{name}>")
    return SOURCE_TYPES[name]


def source_type(dtype: T.DataType) -> str:
    """Source type name of a Spark type. JSON and XML are stored as text and come back as STRING."""
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL"
    if isinstance(dtype, T.TimeType):
        return "NAIVE_TIME"
    for name, candidate in SOURCE_TYPES.items():
        if candidate == dtype:
            return name
    raise ChangeError(f"Type <{dtype.simpleString()}> has no source type")


def from_text(raw: Expr, dtype: T.DataType) -> Expr:
    """Typed value of a cell: text as it is, binaries from base64, the rest by an ANSI cast.

    An empty cell of a type that has no empty value is NULL.
    """
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.BinaryType):
        return F.to_binary(raw, F.lit("base64"))
    filled = F.nullif(raw, F.lit(""))
    return _whole_number(filled, dtype) if isinstance(dtype, _INTEGRAL) else filled.cast(dtype)


def _whole_number(text: Expr, dtype: T.DataType) -> Expr:
    """Integer of a text; fractions are rounded half up, and what is no number or too large fails."""
    return F.coalesce(text.try_cast(dtype), F.round(text.cast(T.DecimalType(38, 18)), 0).cast(dtype))


def try_from_text(raw: Expr, dtype: T.DataType) -> Expr:
    """:func:`from_text`, with NULL for a cell that is not of the type."""
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.BinaryType):
        return F.try_to_binary(raw, F.lit("base64"))
    filled = F.nullif(raw, F.lit(""))
    if not isinstance(dtype, _INTEGRAL):
        return filled.try_cast(dtype)
    return F.coalesce(filled.try_cast(dtype), F.round(filled.try_cast(T.DecimalType(38, 18)), 0).try_cast(dtype))


def convert(value: Expr, old: T.DataType, new: T.DataType) -> Expr:
    """Change of a stored column's type. Fractions are rounded, where a bare cast would cut them off."""
    if old == new:
        return value
    if isinstance(new, _INTEGRAL):
        if isinstance(old, (T.FloatType, T.DoubleType)):
            return F.rint(value).cast(new)
        if isinstance(old, T.DecimalType):
            return F.round(value, 0).cast(new)
        if isinstance(old, T.StringType):
            return _whole_number(value, new)
    return value.cast(new)


def default_value(text: str | None, dtype: T.DataType) -> Expr:
    """Literal of a column default; without a default, NULL."""
    if text is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit(text)
    return F.lit(text).cast(dtype)


def key_filler(dtype: T.DataType) -> str:
    """Default of a column that joins the key of a table that already has rows."""
    if isinstance(dtype, T.StringType):
        return ""
    if isinstance(dtype, T.DateType):
        return "1970-01-01"
    if isinstance(dtype, T.TimestampType):
        return "1970-01-01T00:00:00Z"
    if isinstance(dtype, T.TimestampNTZType):
        return "1970-01-01 00:00:00"
    if isinstance(dtype, T.TimeType):
        return "00:00:00"
    return "0"


def instant(text: str, dtype: T.DataType) -> Expr:
    """Literal of a UTC moment given as ISO text, as a timestamp with or without zone."""
    return F.lit(text if isinstance(dtype, T.TimestampType) else text.removesuffix("Z")).cast(dtype)


# The end of a version that is still open, and the moment given to deleted rows.
OPEN_END = "9999-12-31T23:59:59.999Z"
EPOCH = "1970-01-01T00:00:00Z"


def just_before(moment: Expr) -> Expr:
    """One millisecond earlier: where a version ends when the next one starts."""
    return moment - F.expr("INTERVAL '0.001' SECOND")
