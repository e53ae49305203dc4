"""Matching a table of filter rules to a table of rows.

Rules are rows ``rule_id, op, value_text, not``. Their texts are read with
Column expressions, so any number of rules is parsed as a Spark job. Rows and
rules then meet in places, through one equality join over one scan of the rows,
and a rule is filed only where rows that may fit come by:

* ``in`` rules wait at the hash of each listed value.
* ``range`` rules with two ends wait at bins. A rule is filed under a bin width
  of at least its own span, so it takes very few bins; a row looks into one bin
  per width in use.
* ``range`` rules with one end, and complements of ranges, wait at nodes of a tree
  over the ends: a threshold covers all that lies on one side of it with a few nodes
  a level, and a row visits the nodes on its path, so it meets a rule once, and only
  rules near their own end are tested in vain.
* ``cbit`` rules wait at the rarest of their bits, ``bit`` rules at each of them, and
  a row visits the bits it has set. A pair counts at the lowest bit that both share.
  Complements do the same with bits that are not set.
* what holds for every row, or every row with a value, or every row without, waits in
  a place of its own.

Complements of ``in`` rules hold for nearly every row, so they are not tested one by
one: rows meet them by the ``CHUNK``, and the rules that list the row's value, found by
an equality join, are taken out of the chunk.

The exact test is the condition of the join. Rules are broadcast only after their
number, text size and places were measured. Beyond that bound the same join runs
shuffled: a sketch finds the places that many rows visit, and only those rows are
dealt out over salts and only the rules that wait there are copied to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import utc_instant
from ..functions.resolve import FRACTIONAL, Expr, resolve, type_of
from ..functions.scalars import long_value
from ..functions.values import (
    check_comparable,
    end_column,
    list_column,
    mask_column,
    range_parts_column,
    reading_type,
    same_value_column,
    trim_column,
    typed_column,
)
from ..sources.shared import materialize
from .skew import find_hot_keys, hot_share

OPS = ("in", "range", "bit", "cbit")
#: Largest rule set that is broadcast: rules, places they take per rule, and text.
BROADCAST_RULES = 10_000
PLACES_PER_RULE = 20
BROADCAST_TEXT_BYTES = 8 * 1024 * 1024
#: Least number of tasks a place that many rows visit is dealt out to.
SALTS = 32
#: Kinds of rules.
LISTED, EXCEPT, BINNED, SIDED, MASKED, ANYWHERE = range(6)
#: Kinds of places. Outside the range of bin widths, which name places too; tree levels
#: go down from NODE.
VALUE, BIT_ON, BIT_OFF, VALUED, NONE, EVERY, NODE = range(-10_000, -10_007, -1)
PLACES = "array<struct<width:int,bin:bigint>>"
#: Bin widths are powers of 2 ** WIDTH_STEP, to keep the number of widths low.
WIDTH_STEP = 2
BINS_PER_RULE = 3
#: Bins narrower than this share of the ends' size would exceed double precision.
PRECISION_BITS = 50
LARGEST_BITS = 900
#: Bits of a tree level, and levels at most. Leaves outnumber the ends by 2 ** SPARE_BITS.
NODE_BITS, LEVELS, SPARE_BITS = 4, 7, 8
#: Complements of lists that a row meets at once.
CHUNK = 1000
#: Bytes of a text that tell its position.
TEXT_BYTES = 6


@dataclass(frozen=True)
class RuleSet:
    """Parsed rules of one column type. ``rejects`` holds ``rule_id, op,
    value_text, not, error``."""

    valid: DataFrame
    rejects: DataFrame


def parse_rules(rules: DataFrame, dtype: T.DataType) -> RuleSet:
    """Read the rule texts for a column of type ``dtype``."""
    check_comparable(dtype, "rule matching")
    op, shown, wide = F.col("op"), dtype.simpleString(), reading_type(dtype)
    is_mask = op.isin("bit", "cbit")
    negated = F.coalesce(F.col("not"), F.lit(False)) if "not" in rules.columns else F.lit(False)
    read = (
        rules.select("rule_id", "op", "value_text", negated.alias("negated"),
                     F.coalesce(trim_column(F.col("value_text")), F.lit("")).alias("text"))
        .withColumns({
            "items": F.when(op != "range", list_column(F.col("text"))),
            "parts": F.when(op == "range", range_parts_column(F.col("text"))),
        })
        .withColumns({
            "listed": F.when(op == "in", F.transform("items", lambda v: typed_column(v, wide))),
            "mask": F.when(is_mask, mask_column(F.col("items"))),
            "lower_text": end_column(F.col("parts"), 0),
            "upper_text": end_column(F.col("parts"), 1),
        })
        .withColumns({
            "lower": typed_column(F.col("lower_text"), wide),
            "upper": typed_column(F.col("upper_text"), wide),
        })
    )
    bad_end = (
        (F.col("lower_text").isNotNull() & F.col("lower").isNull())
        | (F.col("upper_text").isNotNull() & F.col("upper").isNull())
    )
    error = (
        F.when(~F.coalesce(op.isin(*OPS), F.lit(False)), "unknown filter")
        .when(F.col("text") == "", "value is missing or blank")
        .when((op == "in") & (F.size("listed") <= 0), "not a value list")
        .when((op == "in") & F.exists("listed", lambda v: v.isNull()), f"a value is not a {shown}")
        .when((op == "range") & F.col("parts").isNull(), "not a range")
        .when((op == "range") & bad_end, f"an end is not a {shown}")
        .when(is_mask & F.lit(not _has_bits(dtype)), "masks need a numeric column")
        .when(is_mask & F.col("mask").isNull(), "not a list of mask numbers")
    )
    read = read.withColumn("error", error)
    rejects = read.filter("error is not null").select(
        "rule_id", "op", "value_text", F.col("negated").alias("not"), "error"
    )
    listed = F.col("listed")
    if wide != dtype:
        # a number the column cannot hold is no value of it
        listed = F.array_compact(F.transform(listed, lambda v: same_value_column(v, wide, dtype)))
    valid = read.filter("error is null").select(
        "rule_id", "op", "negated", F.array_distinct(listed).alias("listed"), "lower", "upper",
        F.col("text").startswith("[").alias("include_lower"),
        F.col("text").endswith("]").alias("include_upper"),
        "mask", F.length("value_text").alias("text_size"),
    )
    return RuleSet(valid, rejects)


def _has_bits(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType))


def match_rules(
    df: DataFrame, key: str | Sequence[str], col: Expr, rules: DataFrame,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """``key, rule_id`` for every row and rule that fit. Rules that cannot be
    read match nothing; ``parse_rules`` lists them with the reason.

    The rules are read first, and a small aggregate over them chooses the plan. The
    column is read before the result only to count the bits it has set, where a
    ``cbit`` rule has several, and to find frequent places, where the rules are too
    many to broadcast. A stream is not read ahead: its rules go by their highest bit,
    and all its places are spread.
    """
    column = resolve(df, col)
    dtype = type_of(df, column)
    valid, few = _stored(rules, dtype, broadcast_rules)
    seen = _summary(valid, dtype)
    levels = _levels(seen["sided"])
    places = seen["listed"] + seen["binned"] * BINS_PER_RULE + seen["bits"] + seen["sided"] * levels * 2**NODE_BITS
    small = few and places <= broadcast_rules * PLACES_PER_RULE

    # own names for the keys, so that none is taken for a column of the rules
    keys = {f"__k_{i}": k for i, k in enumerate([key] if isinstance(key, str) else key)}
    bits = long_value(column, dtype) if _has_bits(dtype) else F.lit(0).cast("bigint")
    rows = df.select(*[F.col(k).alias(n) for n, k in keys.items()], _plain_zero(column, dtype).alias("__v"), bits.alias("__bits"))
    grid = Grid.over(seen, levels)
    order = {on: _bit_order(rows, seen[f"{on}_all"], on) for on in ("on", "off")}
    visited = _visited(dtype, seen, grid, order)
    if not small:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        spread = _Spread(rows, visited, keys, max(SALTS, tasks))
        visited = F.transform(visited, lambda at: F.struct(at["width"].alias("width"), at["bin"].alias("bin"), spread.row(at).alias("salt")))
    visits = rows.withColumn("__at", F.explode(visited))

    waiting = _waiting(valid, dtype, grid, order, seen["sided"] > 0)
    parts = ["width", "bin"]
    if small:
        waiting = F.broadcast(waiting)  # by the count above; Spark's own estimate does not see the places
    else:
        waiting = waiting.withColumn("__r_salt", F.explode(spread.rule(F.col("__r")))).hint("merge")
        visits = visits.withColumn("__salt", F.col("__at.salt"))
    same = [F.col(f"__at.{part}") == F.col(f"__r.{part}") for part in parts]
    if not small:
        same.append(F.col("__salt") == F.col("__r_salt"))
    pairs = visits.join(waiting, [*same, _fits(dtype)], "inner")
    names = [F.col(n).alias(k) for n, k in keys.items()]
    pairs = pairs.select(*names, "rule_id")
    if not seen["except"]:
        return pairs
    return pairs.union(_except_listed(rows, valid, seen["except"], small, keys).select(*names, "rule_id"))


def _stored(rules: DataFrame, dtype: T.DataType, most: int) -> tuple[DataFrame, bool]:
    """The rules that can be read, parsed once and stored, and whether they are few."""
    valid = parse_rules(rules, dtype).valid.withColumn("__rid", F.monotonically_increasing_id())
    valid = materialize(valid.withColumn("kind", _kind(dtype)).withColumn("width", _width(dtype)))
    size = valid.agg(F.count("*").alias("n"), F.coalesce(F.sum("text_size"), F.lit(0)).alias("bytes")).first()
    return valid, size["n"] <= most and size["bytes"] <= BROADCAST_TEXT_BYTES


def _summary(valid: DataFrame, dtype: T.DataType) -> dict:
    """What the plan depends on, one row of fixed size."""
    kind, zero = F.col("kind"), F.lit(0).cast("bigint")
    is_any = (F.col("op") == "bit") != F.col("negated")
    masks = {
        f"{on}_{some}": F.coalesce(F.bit_or(F.when((kind == MASKED) & (F.col("negated") == (on == "off")) & (is_any == (some == "any")), F.col("mask"))), zero)
        for on in ("on", "off") for some in ("any", "all")
    }
    ends = [_scaled(_position(F.col(c), dtype)) for c in ("lower", "upper")]
    finite = [F.when((kind == SIDED) & (F.abs(e) < float("inf")), e) for e in ends]
    # widths are exponents of doubles in steps, so there is a bound to their number too
    return valid.agg(
        F.coalesce(F.sum(F.when(kind == LISTED, F.size("listed"))), zero).alias("listed"),
        *(F.count(F.when(kind == k, 1)).alias(name) for k, name in ((BINNED, "binned"), (SIDED, "sided"), (EXCEPT, "except"), (ANYWHERE, "anywhere"))),
        F.coalesce(F.sum(F.when(kind == MASKED, F.bit_count("mask"))), zero).alias("bits"),
        F.collect_set("width").alias("widths"), F.min(F.least(*finite)).alias("low"), F.max(F.greatest(*finite)).alias("high"),
        *(c.alias(name) for name, c in masks.items()),
    ).first().asDict()


def _levels(ends: int) -> int:
    return min(LEVELS, math.ceil((math.log2(max(ends, 1)) + SPARE_BITS) / NODE_BITS))


@dataclass(frozen=True)
class Grid:
    """A tree over scaled positions. The first and last leaf are for what lies outside
    the ends of all rules."""

    low: float
    high: float
    levels: int

    @staticmethod
    def over(seen: dict, levels: int) -> Grid:
        low = seen["low"] if seen["low"] is not None else 0.0
        return Grid(low, seen["high"] if seen["high"] is not None else low, levels)

    def leaf(self, scaled: Column) -> Column:
        inside = 2 ** (NODE_BITS * self.levels) - 3
        steps = inside / (self.high - self.low) if self.high > self.low else 0.0
        at = F.floor(F.least(F.greatest((scaled - self.low) * steps, F.lit(0.0)), F.lit(float(inside)))) + 1
        last = F.lit(inside + 2).cast("bigint")
        return F.when(scaled < self.low, F.lit(0).cast("bigint")).when(scaled > self.high, last).otherwise(at.cast("bigint"))

    def path(self, leaf: Column) -> list[Column]:
        return [_place(NODE - k, F.shiftright(leaf, NODE_BITS * k)) for k in range(self.levels)]

    def beside(self, leaf: Column, above: bool) -> Column:
        """Nodes that cover the leaf and all above it, or all below it; none twice."""
        digits = F.sequence(F.lit(0).cast("bigint"), F.lit(2**NODE_BITS - 1).cast("bigint"))

        def level(k: Column) -> Column:
            at = F.call_function("shiftright", leaf, k * NODE_BITS)
            own = at.bitwiseAND(F.lit(2**NODE_BITS - 1))
            further = F.filter(digits, lambda d: d > own if above else d < own)
            return F.transform(further, lambda d: _place(F.lit(NODE) - k, at - own + d))

        nodes = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(self.levels - 1)), level))
        return F.concat(F.array(_place(NODE, leaf)).cast(PLACES), nodes.cast(PLACES))


def _bit_order(rows: DataFrame, mask: int, on: str) -> list[int]:
    """Bits of ``mask``, those that fewest rows have (or, for ``off``, lack) first."""
    bits = [b for b in range(64) if mask >> b & 1]
    if len(bits) < 2 or rows.isStreaming:
        return bits[::-1]
    found = rows.agg(*(F.count(F.when((F.shiftright("__bits", b).bitwiseAND(F.lit(1)) == 1) == F.lit(on == "on"), 1)).alias(f"b{b}") for b in bits)).first()
    return sorted(bits, key=lambda b: (found[f"b{b}"], b))


def _visited(dtype: T.DataType, seen: dict, grid: Grid, order: dict[str, list[int]]) -> Column:
    """Places of a row, only those of kinds that a rule may wait at."""
    v, nowhere = F.col("__v"), F.array().cast(PLACES)
    with_value, ordered, always = [], [], []
    if seen["listed"]:
        with_value.append(_place(VALUE, F.xxhash64("__v")))
    if seen["anywhere"]:
        with_value.append(_place(VALUED, F.lit(0)))
        always.append(F.array(_place(EVERY, F.lit(0))))
    missing = v.isNull()
    if _has_position(dtype):
        if isinstance(dtype, FRACTIONAL):
            missing = missing | F.isnan(v)
        position = _position(v, dtype)
        ordered = [_place(w, _bin(position, w)) for w in sorted(seen["widths"])]
        if seen["sided"]:
            ordered += grid.path(grid.leaf(_scaled(position)))
    out = [F.when(v.isNotNull(), F.array(*with_value)).otherwise(nowhere)] if with_value else []
    if ordered:
        out.append(F.when(~missing, F.array(*ordered)).otherwise(nowhere))
    if seen["sided"] or seen["anywhere"]:
        out.append(F.when(missing, F.array(_place(NONE, F.lit(0)))).otherwise(nowhere))
    for on, kind, bits in (("on", BIT_ON, F.col("__bits")), ("off", BIT_OFF, F.bitwise_not("__bits"))):
        used = sorted({*order[on], *(b for b in range(64) if seen[f"{on}_any"] >> b & 1)})
        if used:
            held = F.filter(F.array(*(F.lit(b) for b in used)), lambda b: F.call_function("shiftright", bits, b).bitwiseAND(F.lit(1)) == 1)  # noqa: B023
            out.append(F.transform(held, lambda b: _place(kind, b)))  # noqa: B023
    out += always
    return F.concat(*out).cast(PLACES) if out else nowhere


def _place(width: int | Column, bin_: Column) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.struct(width.cast("int").alias("width"), bin_.cast("bigint").alias("bin"))


class _Spread:
    """Salts of the places that many rows visit; of all places in a stream."""

    def __init__(self, rows: DataFrame, visited: Column, keys: Iterable[str], salts: int):
        self.salts, self.keys, self.hot = salts, list(keys), None
        if not rows.isStreaming:
            visits = rows.select(F.explode(visited).alias("at")).select(self._name(F.col("at")).alias("at"))
            self.hot = find_hot_keys(visits, "at", hot_share(rows.sparkSession))

    @staticmethod
    def _name(at: Column) -> Column:
        return F.xxhash64(at["width"], at["bin"])

    def _is_hot(self, at: Column) -> Column:
        if self.hot is None:
            return F.lit(True)
        return self._name(at).isin(*self.hot) if self.hot else F.lit(False)

    def row(self, at: Column) -> Column:
        dealt = F.pmod(F.xxhash64(*self.keys, "__v"), F.lit(self.salts)).cast("int")
        return F.when(self._is_hot(at), dealt).otherwise(F.lit(0))

    def rule(self, at: Column) -> Column:
        return F.when(self._is_hot(at), F.sequence(F.lit(0), F.lit(self.salts - 1))).otherwise(F.array(F.lit(0)))


def _waiting(rules: DataFrame, dtype: T.DataType, grid: Grid, order: dict[str, list[int]], sided: bool) -> DataFrame:
    """Rules once per place they wait at, as ``__r``; with the value at places of values."""
    nothing, kind, negated = F.lit(None).cast(dtype), F.col("kind"), F.col("negated")
    places = F.when(kind == ANYWHERE, F.array(_anywhere(dtype))).when(kind == MASKED, _bits_filed(order))
    if _has_position(dtype):
        low, high = (_position(F.col(c), dtype) for c in ("lower", "upper"))
        spanned = F.when(low <= high, F.sequence(_bin(low, F.col("width")), _bin(high, F.col("width"))))
        places = places.when(kind == BINNED, F.transform(spanned, lambda b: _place(F.col("width"), b)))
    if sided:
        below, above = _ends(dtype)
        at_low, at_high = (grid.leaf(_scaled(end)) for end in (low, high))
        nowhere = F.array().cast(PLACES)
        # a complement holds below the lower end, above the upper one, and where nothing is
        outside = F.array_distinct(F.concat(
            F.when(below, grid.beside(at_low, False)).otherwise(nowhere), F.when(above, grid.beside(at_high, True)).otherwise(nowhere),
            F.array(_place(NONE, F.lit(0)))))
        inside = F.when(below, grid.beside(at_low, True)).otherwise(grid.beside(at_high, False))
        places = places.when(kind == SIDED, F.when(negated, outside).otherwise(inside))
    listed = F.transform("listed", lambda v: F.struct(F.lit(VALUE).alias("width"), F.xxhash64(v).alias("bin"), v.alias("value")))
    others = F.transform(places, lambda at: F.struct(at["width"].alias("width"), at["bin"].alias("bin"), nothing.alias("value")))
    filed = rules.filter(kind != EXCEPT).withColumn("__r", F.explode(F.when(kind == LISTED, listed).otherwise(others)))
    # the value a rule waits with is all of its list that is needed there
    return filed.select("rule_id", "op", "negated", "kind", "lower", "upper", "include_lower", "include_upper", "mask", "__r")


def _bits_filed(order: dict[str, list[int]]) -> Column:
    """``cbit`` rules at the rarest bit of their mask, ``bit`` rules at each; complements
    the other way round, among the bits that are off."""
    negated, mask = F.col("negated"), F.col("mask")
    is_any = (F.col("op") == "bit") != negated
    place = F.when(negated, F.lit(BIT_OFF)).otherwise(F.lit(BIT_ON))

    def of(bits: Column) -> Column:
        return F.filter(bits, lambda b: F.call_function("shiftright", mask, b).bitwiseAND(F.lit(1)) == 1)

    known = {on: F.array(*map(F.lit, bits)).cast("array<int>") for on, bits in order.items()}
    rarest = F.slice(F.when(negated, of(known["off"])).otherwise(of(known["on"])), 1, 1)
    return F.transform(F.when(is_any, of(F.sequence(F.lit(0), F.lit(63)))).otherwise(rarest), lambda b: _place(place, b))


def _ends(dtype: T.DataType) -> tuple[Column, Column]:
    """Whether a range really ends below and above; an infinite end that is included does not."""
    below, above = F.col("lower").isNotNull(), F.col("upper").isNotNull()
    if isinstance(dtype, FRACTIONAL):
        below = below & ~((F.col("lower") == float("-inf")) & F.col("include_lower"))
        above = above & ~((F.col("upper") == float("inf")) & F.col("include_upper"))
    return below, above


def _kind(dtype: T.DataType) -> Column:
    op, negated = F.col("op"), F.col("negated")
    kind = F.when(op == "in", F.when(negated, F.lit(EXCEPT)).otherwise(F.lit(LISTED)))
    kind = kind.when(op.isin("bit", "cbit"), F.when(F.col("mask") == 0, F.lit(ANYWHERE)).otherwise(F.lit(MASKED)))
    if _has_position(dtype):
        below, above = _ends(dtype)
        empty = F.coalesce(F.col("lower") > F.col("upper"), F.lit(False))
        if isinstance(dtype, FRACTIONAL):
            empty = empty | F.coalesce(F.isnan("lower"), F.lit(False)) | F.coalesce(F.isnan("upper"), F.lit(False))
        # infinite or astronomic ends cannot be cut into a few bins
        near = F.greatest(*[F.abs(_position(F.col(c), dtype)) for c in ("lower", "upper")]) < 2.0**LARGEST_BITS
        two_ends = F.col("lower").isNotNull() & F.col("upper").isNotNull() & ~negated
        kind = kind.when(empty | ~(below | above), F.lit(ANYWHERE)).when(two_ends & near, F.lit(BINNED)).otherwise(F.lit(SIDED))
    return kind.otherwise(F.lit(ANYWHERE)) if not _has_position(dtype) else kind


def _anywhere(dtype: T.DataType) -> Column:
    """The place of rules that hold for every row, for every row with a value or for
    those without; what holds for none waits there too and is refused by the test."""
    op, negated = F.col("op"), F.col("negated")
    if not _has_position(dtype):
        return F.when((op == "range") & ~negated, _place(VALUED, F.lit(0))).otherwise(_place(EVERY, F.lit(0)))
    below, above = _ends(dtype)
    open_ = (op == "range") & ~(below | above)
    return (
        F.when(open_ & negated, _place(NONE, F.lit(0))).when((op == "range") & ~negated, _place(VALUED, F.lit(0)))
        .otherwise(_place(EVERY, F.lit(0)))
    )


def _except_listed(rows: DataFrame, valid: DataFrame, count: int, small: bool, keys: Iterable[str]) -> DataFrame:
    """Rows with the complements of lists that hold for them: all but those that list the
    row's value. Rules with one id are still rules of their own."""
    chunks = math.ceil(count / CHUNK)
    named = F.struct("__rid", "rule_id").alias("named")
    rules = valid.filter(F.col("kind") == EXCEPT).select(named, "listed", F.pmod(F.xxhash64("__rid"), F.lit(chunks)).cast("int").alias("__chunk"))
    whole = rules.groupBy("__chunk").agg(F.collect_list("named").alias("__rules"))
    out = rules.select(F.explode("listed").alias("__listed"), F.col("__chunk").alias("__out"), "named")
    out = out.groupBy("__listed", "__out").agg(F.collect_list("named").alias("__less"))
    met = rows.withColumn("__c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    if small:
        met = met.join(F.broadcast(whole), F.col("__c") == F.col("__chunk"))
        out = F.broadcast(out)
    else:
        # a row for each chunk and CHUNK of its matches; few chunks, so their rows are dealt out
        salts = max(SALTS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        met = met.withColumn("__salt", F.pmod(F.xxhash64(*keys, "__v"), F.lit(salts)).cast("int"))
        whole = whole.withColumn("__w_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        out = out.hint("merge")
        whole = whole.hint("merge")
    if small:
        met = met.join(out, (F.col("__v") == F.col("__listed")) & (F.col("__c") == F.col("__out")), "left")
    else:
        met = met.join(out, (F.col("__v") == F.col("__listed")) & (F.col("__c") == F.col("__out")), "left")
        met = met.join(whole, (F.col("__c") == F.col("__chunk")) & (F.col("__salt") == F.col("__w_salt")))
    left = F.when(F.col("__less").isNull(), F.col("__rules")).otherwise(F.array_except("__rules", "__less"))
    return met.select(*keys, F.explode(left).alias("named")).select(*keys, F.col("named.rule_id").alias("rule_id"))


def _has_position(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType, T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType))


def _position(value: Column, dtype: T.DataType) -> Column:
    """A number that never falls as ``value`` grows; rounding only merges bins."""
    if isinstance(dtype, T.TimestampNTZType):
        value = F.unix_micros(utc_instant(value))
    elif isinstance(dtype, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(dtype, T.DateType):
        value = F.unix_date(value)
    elif isinstance(dtype, T.StringType):
        first = F.rpad(F.substring(F.hex(value.cast("binary")), 1, 2 * TEXT_BYTES), 2 * TEXT_BYTES, "0")
        value = F.conv(first, 16, 10)
    return value.cast("double")


def _scaled(position: Column) -> Column:
    """The same order on a scale that widely spread ends share out evenly."""
    return F.signum(position) * F.log1p(F.abs(position))


def _width(dtype: T.DataType) -> Column:
    """Exponent of the bin width of a binned rule."""
    if not _has_position(dtype):
        return F.lit(None).cast("int")
    low, high = _position(F.col("lower"), dtype), _position(F.col("upper"), dtype)
    smallest = F.greatest(F.abs(low), F.abs(high)) / F.lit(2.0**PRECISION_BITS)
    span = F.greatest(high - low, smallest, F.lit(2.0**-PRECISION_BITS))
    width = (F.ceil(F.log2(span) / WIDTH_STEP) * WIDTH_STEP).cast("int")
    return F.when(F.col("kind") == BINNED, width)


def _bin(position: Column, width: Column | int) -> Column:
    scale = F.pow(F.lit(2.0), F.lit(width) if isinstance(width, int) else width.cast("double"))
    return F.floor(F.greatest(F.least(position / scale, F.lit(2.0**60)), F.lit(-(2.0**60))))


def _in_range(dtype: T.DataType) -> Column:
    v, low, high = F.col("__v"), F.col("lower"), F.col("upper")
    above = low.isNull() | (v > low) | (F.col("include_lower") & (v == low))
    below = high.isNull() | (v < high) | (F.col("include_upper") & (v == high))
    inside = v.isNotNull() & above & below
    if isinstance(dtype, FRACTIONAL):
        # Spark sorts NaN above all numbers; it lies in no range that has an end, and ends none
        numbers = ~F.isnan(v) & ~F.isnan(low) & ~F.isnan(high)
        inside = inside & (numbers | (low.isNull() & high.isNull()))
    return F.coalesce(inside, F.lit(False))


def _fits(dtype: T.DataType) -> Column:
    v, mask, bits, negated = F.col("__v"), F.col("mask"), F.col("__bits"), F.col("negated")
    is_bit, is_range = F.col("op") == "bit", F.col("op") == "range"
    shared = bits.bitwiseAND(mask)
    fits = F.when(is_range, _in_range(dtype)).when(is_bit, shared != 0).otherwise(shared == mask)
    # a rule that waits at several bits counts at the lowest one that decides
    deciding = F.when(is_bit, shared).otherwise(F.bitwise_not(bits).bitwiseAND(mask))
    lowest = deciding.bitwiseAND(-deciding) == F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__r.bin").cast("int"))
    once = (F.col("kind") != MASKED) | (is_bit == negated) | lowest
    # hashes may collide, so the value itself decides
    return F.when(F.col("kind") == LISTED, v == F.col("__r.value")).otherwise((fits != negated) & once)


def _plain_zero(column: Column, dtype: T.DataType) -> Column:
    """Adding zero turns -0.0 into 0.0, so that both hash alike."""
    return column + F.lit(0).cast(dtype) if isinstance(dtype, FRACTIONAL) else column
