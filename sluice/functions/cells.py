"""Cell cleaners: ``Column -> Column`` built only from Spark SQL functions.

Every cleaner picks its expression from the *input* type as well as the
target type: raw tables arrive typed (a number must not be printed and
re-parsed, a timestamp must not be re-parsed from its text). All parsing uses
the ``try_`` forms, so results are the same with ANSI mode on or off, and all
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from sluice.functions import fixed, timetext

NUMERIC_TYPES = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def as_of_col(as_of: str | datetime | Column | None) -> Column:
    """The run's clock as a foldable literal (``None`` = query start time)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        if as_of.tzinfo is not None:
            return F.lit(as_of)
        as_of = as_of.isoformat(sep=" ")
    # Naive text is read in the session time zone, like every parsed cell.
    return F.lit(str(as_of)).cast(TimestampType())


def as_text(c: Column, in_type: DataType | None = None) -> Column:
    """Text form of a cell (no-op for strings)."""
    if isinstance(in_type, StringType):
        return c
    return c.cast(StringType())


def is_junk_time_text(text: Column) -> Column:
    """Text that cannot be a time: 1-3 letters, 3 chars or fewer, or no digit.

    Letters-only text has no digit, so the first rule is implied by the last
    and is not evaluated separately.
    """
    return (F.length(text) <= fixed.JUNK_MAX_LENGTH) | ~text.rlike(fixed.HAS_DIGIT_PATTERN)


def parse_timestamp_text(text: Column, as_of: Column, clamp_parsed: bool = False, day_first: bool = False) -> Column:
    """Text to timestamp: the native ISO cast, then one parse of the shaped text.

    Junk text and bare times of day give NULL. Naive text is read in the
    session time zone; text with an offset is converted. ``clamp_parsed`` turns
    future values into as_of where the native cast did not take the text.
    """
    shaped = timetext.shaped_timestamp(text, as_of, day_first)
    if clamp_parsed:
        shaped = F.when(shaped > as_of, as_of).otherwise(shaped)
    six_digits = (F.length(text) == 6) & text.rlike(r"^\d{6}$")  # yyMMdd, where the native cast sees a year
    native = F.when(~six_digits, F.try_to_timestamp(text))
    return F.when(~is_junk_time_text(text) & ~text.rlike(timetext.BARE_TIME), F.coalesce(native, shaped))


def to_timestamp_cell(c: Column, in_type: DataType, as_of: Column, clamp_parsed: bool = False,
                      day_first: bool = False) -> Column:
    """Any input to ``TimestampType`` (no range or future rule yet).

    Numbers are seconds since 1970; like text, three characters or fewer are junk.
    """
    if isinstance(in_type, TimestampType):
        return c
    if isinstance(in_type, (TimestampNTZType, DateType)):
        return c.cast(TimestampType())
    if isinstance(in_type, NUMERIC_TYPES):
        return F.when(F.length(c.cast(StringType())) > fixed.JUNK_MAX_LENGTH, c.try_cast(TimestampType()))
    return parse_timestamp_text(as_text(c, in_type), as_of, clamp_parsed, day_first)


def timestamp_in_range(ts: Column, as_of: Column) -> Column:
    """NULL unless the year lies in [MIN_YEAR, year(as_of) + MAX_YEARS_AHEAD]."""
    return F.when(
        F.year(ts).between(F.lit(fixed.MIN_YEAR), F.year(as_of) + fixed.MAX_YEARS_AHEAD), ts
    )


def apply_future_policy(value: Column, as_of: Column, policy: str) -> Column:
    """``keep`` future values, ``clamp`` them to as_of, or turn them to ``null``."""
    if policy == "keep":
        return value
    if policy == "clamp":
        return F.when(value > as_of, as_of).otherwise(value)
    if policy == "null":
        return F.when(value <= as_of, value)
    raise ValueError(f"unknown future policy {policy!r}")


def clamp_future(value: Column, as_of: Column) -> Column:
    """Future values become as_of."""
    return apply_future_policy(value, as_of, "clamp")


def etl_default(ts: Column, as_of: Column) -> Column:
    """ETL timestamps are never NULL: fall back to the run time."""
    return F.coalesce(ts, as_of)


def date_parse_parts(c: Column, in_type: DataType, as_of: Column,
                     day_first: bool = False) -> tuple[Column, Column | None]:
    """Parse any input to ``DateType``; returns ``(date, iso_flag)``.

    ``iso_flag`` is None for dates, which are kept as they are. For text it tells
    whether the text had the ISO shape: those dates are kept even in the future,
    others are not (see ``date_future_rule``). Timestamps keep the year range and
    count as other text. ISO text takes the native cast, the rest one shaped parse.
    """
    if isinstance(in_type, DateType):
        return c, None
    if isinstance(in_type, (TimestampType, TimestampNTZType)):
        return F.to_date(timestamp_in_range(c, as_of)), F.lit(False)
    text = as_text(c, in_type)
    iso = text.rlike(fixed.ISO_DATE_PATTERN)
    shaped = F.when(~is_junk_time_text(text), timetext.shaped_date(text, as_of, day_first))
    return F.when(iso, F.try_to_date(text)).otherwise(shaped), iso


def date_future_rule(parsed: Column, iso_flag: Column | None, as_of: Column) -> Column:
    """Dates parsed from non-ISO text that lie after the as_of date become NULL."""
    if iso_flag is None:
        return parsed
    return F.when(iso_flag | (parsed <= F.to_date(as_of)), parsed)


def to_date_cell(c: Column, in_type: DataType, as_of: Column) -> Column:
    """Any input to ``DateType``.

    ISO text ``yyyy-MM-dd`` is cast directly and kept even when in the future;
    a date parsed from other text, or taken from a timestamp, is dropped when it
    lies after the as_of date. (``conform`` computes the parse and the rule in
    two projections so the parse runs once per cell.)
    """
    parsed, iso = date_parse_parts(c, in_type, as_of)
    return date_future_rule(parsed, iso, as_of)


def numeric_text(text: Column) -> Column:
    """Commas removed, spaces trimmed."""
    return F.trim(F.regexp_replace(text, ",", ""))


def to_number_cell(c: Column, in_type: DataType, out_type: DataType) -> Column:
    """Decimal or double cleaning.

    Numbers are cast directly. Text must match ``-?digits(.digits)?`` once
    commas are removed and spaces trimmed; anything else, and any value that
    does not fit, is NULL. Decimals round half away from zero.
    """
    if isinstance(in_type, NUMERIC_TYPES):
        return c.try_cast(out_type)
    cleaned = numeric_text(as_text(c, in_type))
    # NULL when the text does not match (no failed cast to catch), and the
    # cleaned text is computed once
    return F.regexp_substr(cleaned, F.lit(fixed.NUMERIC_PATTERN)).try_cast(out_type)


def _token_map(true_value, false_value) -> Column:
    pairs = []
    for tok in fixed.TRUE_TOKENS:
        pairs += [F.lit(tok), F.lit(true_value)]
    for tok in fixed.FALSE_TOKENS:
        pairs += [F.lit(tok), F.lit(false_value)]
    return F.create_map(*pairs)


def to_boolean_cell(c: Column, in_type: DataType) -> Column:
    """true/1/yes/t and false/0/no/f in any case; everything else NULL."""
    if isinstance(in_type, BooleanType):
        return c
    return F.try_element_at(_token_map(True, False), F.lower(as_text(c, in_type)))


def boolean_text_cell(c: Column, in_type: DataType) -> Column:
    """Boolean tokens become TRUE/FALSE text; other text passes unchanged."""
    text = as_text(c, in_type)
    return F.coalesce(F.try_element_at(_token_map(fixed.TRUE_TEXT, fixed.FALSE_TEXT), F.lower(text)), text)


# Any number, string and nesting that fits a cell is valid JSON.
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_bad",
    "maxNumLen": "2147483647",
    "maxStringLen": "2147483647",
    "maxNestingDepth": "2147483647",
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}


def is_json_text(text: Column) -> Column:
    """True when the text is one complete JSON value, of any size.

    The reader ignores what follows a complete value, so the text is read twice,
    once as an object member and once as an array element: trailing text breaks
    at least one of the two wraps. Values are skipped, not built. NaN and Infinity
    are rejected (they are not JSON).
    """

    def whole(before: str, after: str) -> Column:
        wrapped = F.concat(F.lit(before), text, F.lit(after))
        return F.from_json(wrapped, "_unused int, _bad string", _JSON_OPTIONS)["_bad"].isNull()

    return whole('{"v":', "}") & whole('{"v":[', "]}")


def json_text_cell(c: Column, in_type: DataType) -> Column:
    """The text itself when it is valid JSON, else NULL.

    Nested input (struct, map, array, variant) is already structured: it is
    written out as JSON text rather than checked.
    """
    if isinstance(in_type, (StructType, MapType, ArrayType, VariantType)):
        return F.to_json(c, {"ignoreNullFields": "false"})
    text = as_text(c, in_type)
    return F.when(is_json_text(text), text)


def has_timestamp_garbage(ts: Column) -> Column:
    """Printed timestamp holds characters other than digits and ``-:. ``."""
    return F.regexp_replace(as_text(ts), fixed.TIMESTAMP_CHARS_PATTERN, "") != ""


def is_present(c: Column, in_type: DataType) -> Column:
    """A raw cell that carries a value (non-NULL, not blank text)."""
    if isinstance(in_type, StringType):
        return c.isNotNull() & (F.trim(c) != "")
    return c.isNotNull()
