"""Value text: lists, ranges, mask numbers and typed literals.

Two forms of every rule live here. The plain Python form reads the one text a
caller hands to a filter. The Column form reads a whole table of texts as a
Spark expression, for rule matching; there a bad text gives NULL, not an error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import date_math, instant_column
from .resolve import FRACTIONAL, INSTANT, INTEGRAL


class ValueTextError(ValueError):
    """A value text that does not follow the rules."""


# Characters trimmed from value text, and the number grammars.
BLANKS = "".join(chr(i) for i in range(33))
INTEGER = r"^[+-]?[0-9]+$"
HEX = r"^0[xX][+-]?[0-9a-fA-F]+$"
BINARY = r"^0[bB][+-]?[01]+$"
DECIMAL = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?$"
INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"
RANGE_SEPARATOR = " TO "
SHORTEST_RANGE = len("[ TO ]")


def _text(value: str | None) -> str:
    if value is None:
        raise ValueTextError("value is missing")
    text = value.strip(BLANKS)
    if not text:
        raise ValueTextError("value is blank")
    return text


def parse_list(value: str | None, separator: str = ",") -> list[str]:
    """``(a, b)`` is two values; text without parentheses is one value."""
    text = _text(value)
    if text[0] != "(":
        return [text]
    if text[-1] != ")":
        raise ValueTextError(f"missing ')' in {value!r}")
    items = [item.strip(BLANKS) for item in text[1:-1].split(separator)]
    items = [item for item in items if item]
    if not items:
        raise ValueTextError(f"no value in {value!r}")
    return items


@dataclass(frozen=True)
class RangeText:
    """Ends of a range as text; ``None`` is an open end."""

    lower: str | None
    upper: str | None
    include_lower: bool = True
    include_upper: bool = True


def parse_range(value: str | None) -> RangeText:
    """``[a TO b]``, ``(a TO b)`` or mixed; ``*`` or nothing is an open end."""
    text = _text(value)
    if len(text) < SHORTEST_RANGE or text[0] not in "[(" or text[-1] not in "])":
        raise ValueTextError(f"not a range: {value!r}")
    parts = text[1:-1].split(RANGE_SEPARATOR)
    if len(parts) != 2 or not parts[1]:
        raise ValueTextError(f"not a range: {value!r}")
    lower, upper = (_open_end(part) for part in parts)
    return RangeText(lower, upper, text[0] == "[", text[-1] == "]")


def _open_end(text: str) -> str | None:
    text = text.strip(BLANKS)
    return None if text in ("", "*") else text


def parse_mask_number(text: str) -> int:
    """Signed decimal, ``0x`` hexadecimal or ``0b`` binary 64-bit number."""
    for pattern, base, skip in ((INTEGER, 10, 0), (HEX, 16, 2), (BINARY, 2, 2)):
        if re.match(pattern, text):
            return _within(int(text[skip:], base), 64, text)
    raise ValueTextError(f"not a mask number: {text!r}")


def parse_mask(value: str | int | list | tuple) -> int:
    """OR of every number of a value list."""
    if isinstance(value, int):
        return _within(value, 64, value)
    items = parse_list(value) if value is None or isinstance(value, str) else value
    if not items:
        raise ValueTextError("no value in mask list")
    mask = 0
    for item in items:
        mask |= parse_mask_number(item) if isinstance(item, str) else _within(item, 64, item)
    return mask


def _within(number: int, bits: int, shown: object) -> int:
    if not -(1 << (bits - 1)) <= number < 1 << (bits - 1):
        raise ValueTextError(f"{shown!r} does not fit {bits} bits")
    return number


def check_comparable(dtype: T.DataType, what: str) -> None:
    """Value filters work on single values only."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        raise TypeError(f"{what} needs a single-valued column, not {dtype.simpleString()}")


def typed_literal(value: object, dtype: T.DataType | str, now=None) -> Column:
    """``value`` as a literal of the type of the column it is compared with.

    A text that cannot be read as that type fails here, while the query is
    being built, whether or not the table has rows.
    """
    if dtype == "char":
        return F.lit(str(value)[:1])
    if not isinstance(value, str):
        return F.lit(value).cast(dtype)
    if isinstance(dtype, INTEGRAL):
        if not re.match(INTEGER, value):
            raise ValueTextError(f"not a {dtype.simpleString()}: {value!r}")
        return F.lit(_within(int(value), INTEGER_BITS[type(dtype)], value)).cast(dtype)
    if isinstance(dtype, FRACTIONAL):
        if not re.match(DECIMAL, value):
            raise ValueTextError(f"not a {dtype.simpleString()}: {value!r}")
        return F.lit(value.rstrip("fFdD") if value[-1:] in "fFdD" else value).cast(dtype)
    if isinstance(dtype, T.DecimalType):
        try:
            return F.lit(Decimal(value))
        except InvalidOperation:
            raise ValueTextError(f"not a number: {value!r}") from None
    if isinstance(dtype, T.BooleanType):
        return F.lit(value.lower() == "true")
    if isinstance(dtype, INSTANT):
        return date_math(value, now=now, ntz=isinstance(dtype, T.TimestampNTZType))
    if isinstance(dtype, T.DateType):
        return date_math(value, now=now, ntz=True).cast(dtype)
    return F.lit(value)


def list_value(item: object, dtype: T.DataType) -> object:
    """A listed item as a Python value of the column's type, ``None`` if no value of
    that type equals it. A text that cannot be read fails."""
    if item is None:
        return None
    if isinstance(dtype, T.StringType):
        return item if isinstance(item, str) else str(item).lower() if isinstance(item, bool) else str(item)
    if isinstance(dtype, T.BooleanType):
        return item.lower() == "true" if isinstance(item, str) else bool(item)
    if isinstance(dtype, INTEGRAL):
        if isinstance(item, str):
            if not re.match(INTEGER, item):
                raise ValueTextError(f"not a {dtype.simpleString()}: {item!r}")
            return _within(int(item), INTEGER_BITS[type(dtype)], item)
        whole = int(item) if item == item and abs(item) != float("inf") else None
        limit = 1 << (INTEGER_BITS[type(dtype)] - 1)
        return whole if whole == item and -limit <= whole < limit else None
    if isinstance(dtype, FRACTIONAL):
        if isinstance(item, str):
            if not re.match(DECIMAL, item):
                raise ValueTextError(f"not a {dtype.simpleString()}: {item!r}")
            item = item.rstrip("fFdD") if item[-1:] in "fFdD" else item
        return float(item) + 0.0
    if isinstance(dtype, T.DecimalType):
        try:
            number = Decimal(item if isinstance(item, str) else str(item))
        except InvalidOperation:
            raise ValueTextError(f"not a number: {item!r}") from None
        if not number.is_finite():
            raise ValueTextError(f"not a number: {item!r}")
        scaled = number.scaleb(dtype.scale)
        return number if scaled == scaled.to_integral_value() and abs(scaled) < 10**dtype.precision else None
    return item


def list_literal(item: object, dtype: T.DataType) -> Column | None:
    """The same as a literal of that type."""
    if isinstance(item, str) and isinstance(dtype, (*INSTANT, T.DateType)):
        return typed_literal(item, dtype)
    value = list_value(item, dtype)
    return None if value is None else F.lit(value).cast(dtype)


# --- the same rules as Column expressions over a table of texts ---------------
# These take trimmed text (``trim_column``). Keep it in a column of its own, and
# the lists too: an expression used many times over is then worked out once.


def trim_column(text: Column) -> Column:
    return F.regexp_replace(text, TRIM, "")


def inner_column(text: Column) -> Column:
    """What stands between the first and the last character."""
    return F.substr(text, F.lit(2), F.length(text) - 2)


def list_column(text: Column, separator: str = ",") -> Column:
    """Array of the values of a list text, empty where the text is bad."""
    many = F.when(
        text.rlike(r"(?s)^\(.*\)$"), F.split(inner_column(text), re.escape(separator), -1)
    )
    items = F.when(text.startswith("("), many).otherwise(F.array(text))
    return F.filter(F.transform(items, trim_column), lambda item: item != "")


def range_parts_column(text: Column) -> Column:
    """The two end texts of a range text, NULL where the text is bad."""
    parts = F.split(inner_column(text), RANGE_SEPARATOR, -1)
    shape = (F.length(text) >= SHORTEST_RANGE) & text.rlike(r"(?s)^[\[(].*[\])]$")
    good = F.filter(F.array(parts), lambda p: (F.size(p) == 2) & (p[1] != ""))
    return F.transform(F.when(shape, F.get(good, F.lit(0))), trim_column)


def end_column(parts: Column, index: int) -> Column:
    """One end of ``range_parts_column``, NULL where it is open."""
    return F.nullif(F.nullif(F.get(parts, F.lit(index)), F.lit("*")), F.lit(""))


def mask_number_column(text: Column) -> Column:
    """Number of one mask item, NULL where the text is bad or too large."""
    digits = F.regexp_replace(F.substr(text, F.lit(3), F.length(text)), r"^[+-]", "")
    digits = F.regexp_replace(digits, r"^0+(?=.)", "")
    sign = F.when(text.rlike(r"^..-"), F.lit("-")).otherwise(F.lit(""))

    def based(base: int) -> Column:
        # A radix conversion yields unsigned text; the cast rejects what is too large.
        longest = 16 if base == 16 else 64
        number = F.concat(sign, F.conv(digits, base, 10)).try_cast("bigint")
        return F.when(F.length(digits) <= longest, number)

    return (
        F.when(text.rlike(INTEGER), text.try_cast("bigint"))
        .when(text.rlike(HEX), based(16))
        .when(text.rlike(BINARY), based(2))
    )


def mask_column(items: Column) -> Column:
    """OR of every number of a list, NULL where any of them is bad or there is none."""
    merged = F.aggregate(
        F.transform(items, mask_number_column), F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b)
    )
    return F.when(F.size(items) > 0, merged)


def typed_column(text: Column, dtype: T.DataType) -> Column:
    """``text`` read as ``dtype``, NULL where it cannot be."""
    if isinstance(dtype, INTEGRAL):
        return F.when(text.rlike(INTEGER), text.try_cast(dtype))
    if isinstance(dtype, FRACTIONAL):
        number = F.regexp_replace(text, "[fFdD]$", "").try_cast(dtype)
        # adding zero turns -0.0 into 0.0, so both spellings are one value
        return F.when(text.rlike(DECIMAL), number + F.lit(0).cast(dtype))
    if isinstance(dtype, T.DecimalType):
        return text.try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lower(text) == "true"
    if isinstance(dtype, INSTANT):
        return instant_column(text, ntz=isinstance(dtype, T.TimestampNTZType))
    if isinstance(dtype, T.DateType):
        return instant_column(text, ntz=True).cast(dtype)
    return text


def reading_type(dtype: T.DataType) -> T.DataType:
    """Type to read value texts with: decimals keep digits the column does not have."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, max(dtype.scale, min(18, 38 - (dtype.precision - dtype.scale))))
    return dtype


def same_value_column(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` as ``target`` where that is the same value, else NULL."""
    if source == target or isinstance(target, T.StringType):
        return column.cast(target)
    if isinstance(source, T.StringType):
        wide = reading_type(target)
        read = typed_column(trim_column(column), wide)
        return read if wide == target else same_value_column(read, wide, target)
    cast = column.try_cast(target)
    return F.when(cast.try_cast(source) == column, cast)
