"""Date literals with date math, in UTC.

``NOW`` or an ISO instant (``1995-12-31T23:59:59Z``), followed by any number of
``+n UNIT`` / ``-n UNIT`` shifts and ``/UNIT`` roundings, as in
``NOW/DAY-3MONTHS``. The work is done on microseconds since 1970 and on plain
dates, so the session zone never matters.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names of the date grammar, and lengths in microseconds or months.
UNITS = {
    "YEAR": ("YEAR", "YEARS"),
    "MONTH": ("MONTH", "MONTHS"),
    "DAY": ("DAY", "DAYS", "DATE"),
    "HOUR": ("HOUR", "HOURS"),
    "MINUTE": ("MINUTE", "MINUTES"),
    "SECOND": ("SECOND", "SECONDS"),
    "MILLI": ("MILLI", "MILLIS", "MILLISECOND", "MILLISECONDS"),
}
MICROS = {
    "DAY": 86_400_000_000, "HOUR": 3_600_000_000, "MINUTE": 60_000_000,
    "SECOND": 1_000_000, "MILLI": 1_000,
}
MONTHS = {"YEAR": 12, "MONTH": 1}
NAMES = {name: unit for unit, names in UNITS.items() for name in names}
INSTANT_TEXT = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?Z"
STEP = "(?:[+-][0-9]+|/)(?:" + "|".join(sorted(NAMES, key=len, reverse=True)) + ")"
WHOLE = f"^(NOW|{INSTANT_TEXT})((?:{STEP})*)$"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def date_math(text: str, now: datetime | None = None, ntz: bool = False) -> Column:
    """Literal instant of ``text``. Bad text fails at once.

    The result is a constant expression, which Catalyst folds, so a comparison
    with it still reaches the scan. ``now`` fixes ``NOW``; without it ``NOW`` is
    the start of the query (of each micro-batch in a stream).
    """
    match = re.match(WHOLE, text)
    if not match:
        raise ValueError(f"not a date: {text!r}")
    start, steps = match.groups()
    if start == "NOW":
        value = _now(now)
    else:
        try:
            value = _micros(datetime.fromisoformat(start))
        except ValueError:
            raise ValueError(f"not a date: {text!r}") from None
    for step in re.findall(STEP, steps):
        unit = NAMES[re.search("[A-Z]+$", step).group()]
        if step[0] == "/":
            value = _floor_months(value, unit) if unit in MONTHS else _floor_micros(value, F.lit(MICROS[unit]))
        else:
            amount = int(re.match("[+-][0-9]+", step).group())
            if abs(amount) >= 1 << 31:
                raise ValueError(f"shift too large in {text!r}")
            if unit in MONTHS:
                value = _shift_months(value, F.lit(amount * MONTHS[unit]))
            else:
                value = value + F.lit(amount * MICROS[unit])
    return _instant(value, ntz)


def instant_column(text: Column, now: datetime | None = None, ntz: bool = False) -> Column:
    """Date math over a column of texts; NULL where the text is bad."""
    lengths = _lengths()

    def read_step(step: Column) -> Column:
        return F.struct(
            step.startswith("/").alias("floor"),
            # a failed try_cast costs an exception, so roundings get a number too
            F.when(step.startswith("/"), F.lit(1))
            .otherwise(F.translate(step, LETTERS, "").try_cast("int")).alias("amount"),
            lengths[F.translate(step, "/+-0123456789", "")].alias("unit"),
        )

    def apply(value: Column, step: Column) -> Column:
        micros, months = step["unit"]["micros"], step["unit"]["months"]
        moved = F.when(micros > 0, value + step["amount"] * micros).otherwise(
            _shift_months(value, step["amount"] * months)
        )
        floored = (
            F.when(micros > 0, _floor_micros(value, micros))
            .when(months == 1, _floor_months(value, "MONTH"))
            .otherwise(_floor_months(value, "YEAR"))
        )
        return F.when(step["floor"], floored).otherwise(moved)

    def evaluate(parts: Column) -> Column:
        start, steps = parts[0], parts[1]
        first = F.when(start == "NOW", _now(now)).otherwise(F.unix_micros(start.try_cast("timestamp")))
        listed = F.transform(F.split(steps, r"(?=[+/-])"), read_step)
        # most texts carry no math; those never enter the fold
        return F.when(steps == "", first).otherwise(F.aggregate(listed, first, apply))

    # one pass of the grammar per text: start and steps, or the text unchanged if it does not fit
    marked = F.regexp_replace(text, WHOLE, "$1|$2")
    value = _let(marked, lambda m: F.when(m != text, _let(F.split(m, r"\|", 2), evaluate)))
    return _instant(value, ntz)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def utc_instant(value: Column) -> Column:
    """The instant whose UTC wall-clock time is the zone-free ``value``."""
    return F.make_timestamp_ltz(
        F.year(value), F.month(value), F.dayofmonth(value),
        F.hour(value), F.minute(value), F.extract(F.lit("SECOND"), value), F.lit("UTC"),
    )


def _micros(moment: datetime) -> Column:
    return F.lit((moment - EPOCH) // timedelta(microseconds=1)).cast("bigint")


def _now(now: datetime | None) -> Column:
    if now is None:
        return F.unix_micros(F.current_timestamp())
    return _micros(now if now.tzinfo else now.replace(tzinfo=timezone.utc))


def _instant(micros: Column, ntz: bool) -> Column:
    if not ntz:
        return F.timestamp_micros(micros)
    since = F.make_dt_interval(secs=F.lit(0.000001).cast("decimal(18,6)")) * micros
    return F.lit("1970-01-01").cast("timestamp_ntz") + since


def _lengths() -> Column:
    """Map from unit name to its length, in microseconds or months."""
    pairs = []
    for name, unit in NAMES.items():
        length = F.struct(
            F.lit(MICROS.get(unit, 0)).cast("bigint").alias("micros"),
            F.lit(MONTHS.get(unit, 0)).alias("months"),
        )
        pairs += [F.lit(name), length]
    return F.create_map(*pairs)


def _floor_micros(value: Column, length: Column) -> Column:
    return value - F.pmod(value, length)


def _date(value: Column) -> Column:
    days = (value - F.pmod(value, F.lit(MICROS["DAY"]))) / F.lit(MICROS["DAY"])
    return F.date_from_unix_date(F.round(days).cast("int"))


def _midnight(date: Column) -> Column:
    return F.unix_date(date).cast("bigint") * F.lit(MICROS["DAY"])


def _shift_months(value: Column, months: Column) -> Column:
    """Same day of the month and time of day, or the month's last day."""
    return _midnight(F.add_months(_date(value), months)) + F.pmod(value, F.lit(MICROS["DAY"]))


def _floor_months(value: Column, unit: str) -> Column:
    return _midnight(F.trunc(_date(value), unit))
