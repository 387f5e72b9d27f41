"""Number parsing and rounding with the semantics of the reference data files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[ \t\r\n\x0B\f]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n\x0B\f]*$"
_UNDERSCORED = r"(?<=[0-9])_(?=[0-9])"
_SPECIAL = r"^[+-]?(inf|infinity)$"
_PLAIN_DECIMAL = r"^\s*[+-]?[0-9]{1,18}(\.[0-9]{0,9})?\s*$"


def round_half_even(value: Column, digits: int) -> Column:
    """Round a double to `digits` decimals by its exact binary value, ties to even.

    `F.round` and `F.bround` look at the shortest decimal text instead, so 2.675 becomes 2.68
    there and 2.67 here.  Where the scaled value is too close to a tie to tell, the value is
    split into two halves (Veltkamp) whose products with 2*10^digits are exact.  From 2^30 on, a
    value has so few binary places after the point that the fraction times 10^digits is exact.
    """
    scale = float(10**digits)
    size = F.abs(value)
    scaled = size * scale
    low = F.floor(scaled).cast("double")
    tie = 2.0 * low + 1.0
    spread = size * 134217729.0
    high_half = spread - (spread - size)
    low_half = size - high_half
    beyond_tie = (high_half * (2.0 * scale) - tie) + low_half * (2.0 * scale)
    nearest = (
        F.when(F.abs(scaled - low - 0.5) > 1e-2, F.floor(scaled + 0.5).cast("double"))
        .when(beyond_tie > 0, low + 1.0)
        .when(beyond_tie < 0, low)
        .otherwise(low + F.pmod(low, F.lit(2.0)))
    )
    rounded = nearest / scale
    signed = F.when(value < 0, -rounded).otherwise(rounded)
    whole = F.floor(size).cast("double")
    large = whole + F.rint((size - whole) * scale) / scale
    signed_large = F.when(value < 0, -large).otherwise(large)
    # Infinite, NaN and values from 2^52 on, which are whole, are their own rounding.
    return F.when(size < 2.0**30, signed).when(size < 2.0**52, signed_large).otherwise(value)


def parse_number(text: Column) -> Column:
    """Double behind a text cell; anything that is not a number (also `1,250`) counts as 0."""
    return F.nanvl(_parse(text), F.lit(0.0))


def parse_number_v2(text: Column) -> Column:
    """As `parse_number` after dropping thousands commas; the text `nan` stays NaN."""
    return _parse(_without_commas(text), underscores=True)


def _without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def _parse(text: Column, underscores: bool = False) -> Column:
    """0 where `text` is not a number; NaN only for the text `nan`."""
    if underscores:
        text = F.regexp_replace(text, _UNDERSCORED, "")
    word = F.lower(F.trim(text))
    # An exponent too large for a double is not a number for the current rules, infinite for v2.
    value = text.try_cast("double")
    if not underscores:
        value = F.when(F.abs(value) == float("inf"), 0.0).otherwise(value)
    return (
        F.when(text.rlike(_NUMBER), F.coalesce(value, F.lit(0.0)))
        .when(word.rlike(_SPECIAL), F.when(word.startswith("-"), float("-inf")).otherwise(float("inf")))
        .when(word.rlike("^[+-]?nan$"), float("nan"))
        .otherwise(0.0)
    )


def to_count(number: Column) -> Column:
    """Whole number, truncated toward zero; infinities and NaN count as 0.

    A finite number that a bigint cannot hold is an error rather than another number.
    """
    whole = number.try_cast("bigint")
    beyond = F.raise_error(F.concat(F.lit("a count is too large: "), number.cast("string"))).cast("bigint")
    finite = (F.abs(number) < float("inf")) & ~F.isnan(number)
    return F.when((F.abs(number) >= 2.0**63) & finite, beyond).otherwise(F.coalesce(whole, F.lit(0).cast("bigint")))


def plain_decimal(text: Column) -> Column:
    """The cell as an exact decimal, or NULL when it needs a double (exponents, many digits)."""
    return F.when(text.rlike(_PLAIN_DECIMAL), F.trim(text).try_cast("decimal(28,9)"))


def fixed2(value: Column) -> Column:
    """Two-decimal text of an already rounded double."""
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .otherwise(F.format_string("%.2f", value))
    )


# A finite double is cut into digits of 32 bits; digit `place` counts units of 2^(32 * place).
_BASE = 1 << 32


def exact_digits(column: str) -> Column:
    """The non-zero digits (place, digit) of a double, signed; none for zero, infinities and NaN.

    Digits of many values add up per place without rounding, so in any order.  The scaling is by
    powers of two and therefore exact; a product of two powers reaches values of any exponent.
    """
    top = f"CAST(floor(log2(abs({column})) / 32) AS INT)"
    scaled = f"(abs({column}) * pow(2D, -16 * {top}) * pow(2D, -16 * {top}))"
    # 53 bits lie in three places; the fourth is for a logarithm that was rounded up to a whole number.
    digit = f"floor(CASE WHEN j = 0 THEN {scaled} ELSE ({scaled} * pow(2D, 32 * j)) % {_BASE}D END)"
    digits = (
        f"transform(array(0, 1, 2, 3), j -> named_struct('place', {top} - j,"
        f" 'digit', CAST(sign({column}) AS BIGINT) * {digit}))"
    )
    finite = f"{column} <> 0 AND abs({column}) < double('infinity')"
    none = "CAST(array() AS ARRAY<STRUCT<place: INT, digit: BIGINT>>)"
    return F.expr(f"CASE WHEN {finite} THEN filter({digits}, d -> d.digit <> 0) ELSE {none} END")


def _carried(digits: str) -> str:
    """Digits from the lowest place up, each brought into 0 to 2^32 - 1; beyond the last place is the sign."""
    total = "CAST(s.carry + d AS DECIMAL(38,0))"
    digit = f"CAST(pmod({total}, {_BASE}BD) AS DECIMAL(10,0))"
    return (
        f"aggregate({digits}, named_struct('carry', CAST(0 AS DECIMAL(38,0)), 'digits', CAST(array() AS ARRAY<DECIMAL(10,0)>)),"
        f" (s, d) -> named_struct('carry', CAST(({total} - {digit}) div {_BASE}BD AS DECIMAL(38,0)),"
        f" 'digits', concat(s.digits, array({digit}))), s -> s.digits)"
    )


def _let(name: str, value: str, then: str) -> str:
    """`then`, in which `name` stands for `value`, computed once however often it is named."""
    return f"element_at(transform(array({value}), {name} -> {then}), 1)"


def total_of_digits(digits: str) -> str:
    """The double nearest to the exact total of summed digits, as SQL.

    `digits` is an array of (place, digit), each place once, digits as decimal(38,0).  A total beyond the
    largest double is infinite; one below 2^-1022 may be off by its last bit.
    """
    zero = "CAST(0 AS DECIMAL(38,0))"
    dense = f"transform(sequence(low, array_max(places) + 3), p -> coalesce(try_element_at(map_from_entries(ds), p), {zero}))"
    # The three highest digits have 65 bits at least; one more bit says whether anything lies below them.
    head = " + ".join(f"CAST(coalesce(get(size_, high - {k}), 0) AS DECIMAL(10,0)) * {1 << (97 - 32 * k)}BD" for k in (1, 2, 3))
    rest = "CASE WHEN high > 3 AND exists(slice(size_, 1, high - 3), d -> d <> 0) THEN 1BD ELSE 0BD END"
    half = "CAST(floor(power_ / 2) AS INT)"
    value = f"CAST({head} + {rest} AS DOUBLE) * pow(2D, {half}) * pow(2D, power_ - {half})"
    value = _let("power_", "32 * (low + high - 3) - 1", f"CASE WHEN below THEN -({value}) ELSE {value} END")
    value = _let("high", "array_max(filter(sequence(1, size(size_)), i -> element_at(size_, i) <> 0))", f"CASE WHEN high IS NULL THEN 0D ELSE {value} END")
    negated = _carried("transform(dense, d -> CAST(-d AS DECIMAL(38,0)))")
    value = _let("size_", f"CASE WHEN below THEN {negated} ELSE plus END", value)
    value = _let("below", "element_at(plus, -1) <> 0", value)
    value = _let("plus", _carried("dense"), value)
    value = _let("dense", dense, value)
    value = _let("low", "array_min(places)", value)
    value = _let("places", "transform(ds, d -> d.place)", value)
    return _let("ds", digits, f"CASE WHEN size(ds) = 0 THEN 0D ELSE {value} END")
