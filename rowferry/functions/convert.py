"""Converters for dirty columns, as native column expressions.

Every converter maps bad input to NULL (or a default) instead of failing the
job, so they use ``try_cast`` throughout: the session runs with ANSI on.
A ``Column`` does not know its type before analysis, so converters that treat
types differently take ``dtype``; ``Columns(df)`` fills it from the schema.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters a text trim removes (white space and line ends).
WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

ASCII_WHITESPACE = WHITESPACE[:6]

# What a numeric prefix looks like after leading white space.
INTEGER_PREFIX = r"^[+-]?[0-9]+"
FLOAT_PREFIX = r"^[+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"

# Fixed value: the furthest instant from the epoch, in milliseconds, a date may hold.
MAX_EPOCH_MILLIS = 8_640_000_000_000_000

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def kind_of(dtype: T.DataType | str) -> str:
    """Collapse a data type to the few kinds the converters tell apart."""
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    if name.startswith(("string", "varchar", "char")):
        return "string"
    if name in _INTEGRAL:
        return "integral"
    if name in ("float", "double") or name.startswith("decimal"):
        return "fractional"
    if name in ("boolean", "date", "timestamp", "timestamp_ntz"):
        return name
    return "other"


def _whole(col: Column) -> Column:
    return col == F.floor(col)


def as_text(col: Column, dtype: T.DataType | str = "string") -> Column:
    """Text of a value; whole fractional numbers print without a fraction part."""
    if kind_of(dtype) == "fractional":
        return F.when(_whole(col), F.coalesce(col.try_cast("bigint").cast("string"), col.cast("string"))).otherwise(
            col.cast("string")
        )
    return col if kind_of(dtype) == "string" else col.cast("string")


def _blank_set(col: Column) -> Column:
    """What to trim off: the cost grows with the set, and text of single bytes needs only the first six."""
    single_bytes = F.octet_length(col) == F.char_length(col)
    return F.when(single_bytes, F.lit(ASCII_WHITESPACE)).otherwise(F.lit(WHITESPACE))


def trimmed(col: Column) -> Column:
    return F.btrim(col, _blank_set(col))


def left_trimmed(col: Column) -> Column:
    return F.ltrim(col, _blank_set(col))


def _cut(col: Column, max_length: int | None) -> Column:
    return F.substring(col, 1, max_length) if max_length else col


def safe_string(col: Column, max_length: int | None = None, dtype: T.DataType | str = "string") -> Column:
    """Trim, then cut. Empty input is NULL; white space alone becomes the empty text."""
    text = as_text(col, dtype)
    if kind_of(dtype) == "string":
        text = F.when(text != "", trimmed(text))
    return _cut(text, max_length)


def normalize_string(col: Column, max_length: int | None = None, dtype: T.DataType | str = "string") -> Column:
    """Trim, then cut; empty and white-space-only input are both NULL."""
    text = as_text(col, dtype)
    if kind_of(dtype) == "string":
        text = F.nullif(trimmed(text), F.lit(""))
    return _cut(text, max_length)


def _prefix(col: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(left_trimmed(col), pattern, 0), F.lit(""))


def safe_integer(col: Column, dtype: T.DataType | str = "string") -> Column:
    """Leading whole number of a text, the rest ignored; out of BIGINT range is NULL."""
    kind = kind_of(dtype)
    if kind == "string":
        return _prefix(col, INTEGER_PREFIX).try_cast("bigint")
    if kind in ("integral", "fractional"):
        return col.try_cast("bigint")
    return F.lit(None).cast("bigint")


def safe_float(col: Column, dtype: T.DataType | str = "string") -> Column:
    """Leading decimal number of a text, the rest ignored."""
    kind = kind_of(dtype)
    if kind == "string":
        return _prefix(col, FLOAT_PREFIX).try_cast("double")
    if kind in ("integral", "fractional"):
        value = col.cast("double")
        return F.when(~F.isnan(value), value)
    return F.lit(None).cast("double")


def safe_date(
    col: Column, dtype: T.DataType | str = "string", formats: tuple[str, ...] | list[str] = ()
) -> Column:
    """Timestamp without zone. Numbers are epoch milliseconds; text is ISO or one of ``formats``.

    Text with an explicit offset is moved to UTC; text without one is taken as written.
    """
    kind = kind_of(dtype)
    if kind == "timestamp_ntz":
        return col
    if kind == "timestamp":
        return _utc(col)
    if kind == "date":
        return col.cast("timestamp_ntz")
    if kind in ("integral", "fractional"):
        millis = col.try_cast("bigint")
        return F.when(millis.between(-MAX_EPOCH_MILLIS, MAX_EPOCH_MILLIS), _utc(F.timestamp_millis(millis)))
    if kind != "string":
        return F.lit(None).cast("timestamp_ntz")
    has_offset = F.contains(col, F.lit(":")) & col.rlike(r":[0-9]{2}(?:\.[0-9]+)?\s*(?:Z|[+-][0-9]{2}:?[0-9]{2})\s*$")
    iso = F.when(has_offset, _utc(col.try_cast("timestamp"))).otherwise(col.try_cast("timestamp_ntz"))
    text = trimmed(col)
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def _utc(instant: Column) -> Column:
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def safe_boolean(col: Column, dtype: T.DataType | str = "string") -> Column:
    """Truthiness: only NULL, the empty text, zero, NaN and false are false. Any other text is true."""
    kind = kind_of(dtype)
    if kind == "string":
        return F.coalesce(col != "", F.lit(False))
    if kind == "integral":
        return F.coalesce(col != 0, F.lit(False))
    if kind == "fractional":
        return F.coalesce((col != 0) & ~F.isnan(col.cast("double")), F.lit(False))
    if kind == "boolean":
        return F.coalesce(col, F.lit(False))
    return col.isNotNull()


def flag_boolean(col: Column) -> Column:
    """A Y/N, true/false or 1/0 flag by its meaning; anything else is NULL."""
    text = F.lower(trimmed(col.cast("string")))
    return F.when(text.isin("y", "yes", "true", "1"), True).when(text.isin("n", "no", "false", "0"), False)


def flag_yn(col: Column, dtype: T.DataType | str = "int") -> Column:
    """'Y' for the number one, otherwise 'N'; a text or NULL is never the number one."""
    if kind_of(dtype) not in ("integral", "fractional"):
        return F.lit("N")
    return F.when(col == 1, F.lit("Y")).otherwise(F.lit("N"))


def safe_json(col: Column, dtype: T.DataType | str = "string") -> Column:
    """JSON text of a value, NULL fields kept; a NULL value stays NULL."""
    options = {"ignoreNullFields": "false"}
    name = dtype if isinstance(dtype, str) else dtype.simpleString()
    if name.startswith(("struct", "map", "array")):
        return F.to_json(col, options)
    boxed = F.to_json(F.array(col), options)
    return F.when(col.isNotNull(), boxed.substr(F.lit(2), F.length(boxed) - 2))


def with_default(converted: Column, default: Any) -> Column:
    return F.coalesce(converted, default if isinstance(default, Column) else F.lit(default))


def make_converter(converter, default: Any):
    """A converter that puts ``default`` where ``converter`` gives NULL."""

    def convert(col: Column, **options) -> Column:
        return with_default(converter(col, **options), default)

    return convert


def integer_with_default(default: int = 0):
    return make_converter(safe_integer, default)


def string_with_default(default: str = ""):
    return make_converter(safe_string, default)


def date_with_default(default: str):
    """``default`` is the load time as text: a run must not read the clock per row."""
    return make_converter(safe_date, F.lit(default).cast("timestamp_ntz"))


def string_or_default(
    col: Column, default: str, max_length: int | None = None, dtype: T.DataType | str = "string"
) -> Column:
    """``safe_string``, where the empty text takes the default as well as NULL."""
    return F.coalesce(F.nullif(safe_string(col, max_length, dtype), F.lit("")), F.lit(default))


def first_present(*candidates: tuple[Column, T.DataType | str]) -> Column:
    """First candidate that is not NULL, empty text, zero or false, as text."""
    return F.coalesce(*[as_text(F.when(safe_boolean(c, d), c), d) for c, d in candidates])


class Columns:
    """The converters bound to one DataFrame, so that each column's type is known."""

    def __init__(self, df: DataFrame):
        self._df = df
        self._types = {field.name: field.dataType for field in df.schema.fields}

    def has(self, name: str) -> bool:
        return name in self._types

    def __getitem__(self, name: str) -> Column:
        if name not in self._types:
            raise KeyError(f"no column {name!r}; there are {list(self._types)}")
        return F.col(f"`{name}`")

    def dtype(self, name: str) -> T.DataType:
        self[name]
        return self._types[name]

    def text(self, name: str) -> Column:
        return as_text(self[name], self.dtype(name))

    def string(self, name: str, max_length: int | None = None) -> Column:
        return safe_string(self[name], max_length, self.dtype(name))

    def normalized(self, name: str, max_length: int | None = None) -> Column:
        return normalize_string(self[name], max_length, self.dtype(name))

    def string_or(self, name: str, default: str, max_length: int | None = None) -> Column:
        return string_or_default(self[name], default, max_length, self.dtype(name))

    def integer(self, name: str, default: int | None = None) -> Column:
        value = safe_integer(self[name], self.dtype(name))
        return value if default is None else with_default(value, default)

    def float(self, name: str, default: float | None = None) -> Column:
        value = safe_float(self[name], self.dtype(name))
        return value if default is None else with_default(value, default)

    def date(self, name: str, formats: tuple[str, ...] = (), default: Column | None = None) -> Column:
        value = safe_date(self[name], self.dtype(name), formats)
        return value if default is None else with_default(value, default)

    def boolean(self, name: str) -> Column:
        return safe_boolean(self[name], self.dtype(name))

    def yn(self, name: str) -> Column:
        return flag_yn(self[name], self.dtype(name))

    def json(self, name: str) -> Column:
        return safe_json(self[name], self.dtype(name))

    def first_present(self, *names: str) -> Column:
        """Over the names this frame has; NULL text when it has none of them."""
        found = [(self[n], self.dtype(n)) for n in names if self.has(n)]
        return first_present(*found) if found else F.lit(None).cast("string")
