"""Declared column types: parsing, Spark equivalents, cleansing defaults, source and target derivation."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import types as T

_TYPE_TEXT = re.compile(r"^\s*([A-Za-z_0-9 ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$")

# Accepted type names per Spark type.
STRING_TYPES = ("varchar", "char", "text", "mediumtext", "longtext", "varchar2", "nvarchar", "nchar", "string")
TINY_TYPES = ("tinyint", "bit")
SMALL_TYPES = ("smallint",)
INT_TYPES = ("int", "integer", "mediumint")
BIG_TYPES = ("bigint", "identity", "smallidentity", "bigidentity")
DECIMAL_TYPES = ("decimal", "numeric", "number", "double")
FLOAT_TYPES = ("float", "real")
RECOERCED_TYPES = ("decimal", "double", "float", "numeric", "real")

# Replacement for a missing value by type family; keys and other columns agree.
EMPTY_STRING = ""
ZERO_INT = 0
ZERO_DECIMAL = 0.0
ZERO_BOOLEAN = False
# the zero date of the original systems is no valid date; the first day of the epoch stands in
ZERO_DATE = dt.date(1970, 1, 1)

DEFAULT_DATE_FORMAT = "yyyy-MM-dd"
# Text types that get twice their length, up to a limit, but never less than their own.
WIDENED_STRING_TYPES = ("varchar2", "nvarchar", "nchar")
WIDENED_LIMIT = 255
MAX_PRECISION = 38


@dataclass(frozen=True)
class DeclaredType:
    base: str
    precision: int | None = None
    scale: int | None = None

    @property
    def is_string(self) -> bool:
        return self.base in STRING_TYPES

    @property
    def is_dated(self) -> bool:
        return "date" in self.base or "timestamp" in self.base

    def __str__(self) -> str:
        if self.precision is None:
            return self.base
        if self.scale is None:
            return f"{self.base}({self.precision})"
        return f"{self.base}({self.precision},{self.scale})"


def parse_type(text: str) -> DeclaredType:
    match = _TYPE_TEXT.match(text)
    if not match:
        raise ValueError(f"unreadable type: {text!r}")
    base, precision, scale = match.groups()
    return DeclaredType(base.lower(), int(precision) if precision else None, int(scale) if scale else None)


def _decimal(precision: int, scale: int) -> T.DecimalType:
    if precision > MAX_PRECISION:
        raise ValueError(f"{precision} digits do not fit a decimal; {MAX_PRECISION} do")
    return T.DecimalType(precision, scale)


def spark_type(text: str) -> T.DataType:
    declared = parse_type(text)
    base, precision, scale = declared.base, declared.precision, declared.scale
    if base in STRING_TYPES:
        return T.StringType()
    if base in TINY_TYPES:
        return T.ByteType()
    if base in SMALL_TYPES:
        return T.ShortType()
    if base in INT_TYPES:
        return T.IntegerType()
    if base in BIG_TYPES:
        return T.LongType()
    if base == "ubigint":
        return T.DecimalType(20, 0)
    if base == "double" and precision is None:
        return T.DoubleType()
    if base in DECIMAL_TYPES:
        return _decimal(precision or MAX_PRECISION, scale if scale is not None else (0 if precision else 10))
    if base in FLOAT_TYPES:
        return _decimal(precision, scale) if scale is not None else T.DoubleType()
    if base == "currency":
        return T.DecimalType(19, 4)
    if base in ("boolean", "bool"):
        return T.BooleanType()
    if base == "date":
        return T.DateType()
    if base in ("datetime", "timestamp"):
        return T.TimestampNTZType()
    if base in ("blob", "longvarbinary", "binary"):
        return T.BinaryType()
    if base == "longvarchar":
        return T.StringType()
    raise ValueError(f"no Spark type for {text!r}")


def default_value(text: str, key: bool = False, date_default: dt.date = ZERO_DATE):
    """The cleansing value of a declared type; ``None`` where no default is known."""
    kind = spark_type(text)
    if isinstance(kind, T.StringType):
        return EMPTY_STRING
    if isinstance(kind, T.BooleanType):
        return ZERO_BOOLEAN
    if isinstance(kind, T.IntegralType):
        return ZERO_INT
    if isinstance(kind, (T.DecimalType, T.DoubleType)):
        return ZERO_DECIMAL
    if isinstance(kind, T.DateType):
        return date_default
    if isinstance(kind, T.TimestampNTZType):
        return dt.datetime.combine(date_default, dt.time())
    if key:
        raise ValueError(f"{text!r} has no key default")
    return None


def normalise_source_type(text: str) -> str:
    """The common name of a source catalogue type; precision and scale are kept."""
    declared = parse_type(text)
    base = declared.base
    if base in ("smallidentity", "identity", "bigidentity", "ubigint"):
        # an unsigned 64-bit value does not fit a signed one, so it keeps its own name
        renamed = "ubigint" if base == "ubigint" else "bigint"
    elif "float" in base:
        renamed = "float"
    elif base == "longvarbinary" or "longvarchar" in base:
        renamed = "blob"
    elif "integer" in base:
        renamed = "int"
    elif "numeric" in base:
        renamed = "numeric"
    elif "tinyint" in base:
        renamed = "tinyint"
    elif "smallint" in base:
        renamed = "smallint"
    elif "currency" in base:
        return "decimal(19,4)"
    else:
        renamed = base
    return str(DeclaredType(renamed, declared.precision, declared.scale))


def derive_target_type(
    base: str,
    length: int | None = None,
    precision: int | None = None,
    scale: int | None = None,
    default_type: str | None = None,
) -> str:
    """Target type of a source column: texts keep their length, some get room to grow, -1 means text.

    ``default_type`` overrides the derivation, as the conversion table's default flag does.
    """
    if length == -1:
        return "text"
    if default_type:
        return default_type
    if base in DECIMAL_TYPES and precision is not None:
        return f"decimal({precision},{scale or 0})"
    if "int" in base:
        return f"{base}({precision})" if precision is not None else base
    if base in STRING_TYPES and length is not None:
        room = max(length, min(2 * length, WIDENED_LIMIT)) if base in WIDENED_STRING_TYPES else length
        name = {"varchar2": "varchar", "nvarchar": "varchar", "nchar": "char"}.get(base, base)
        return f"{name}({room})"
    if "bit" in base:
        return "bit(1)"
    if base == "float" and scale is not None:
        return f"float({precision},{scale})"
    return base
