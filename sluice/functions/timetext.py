"""Date and time text of common shapes, rewritten to ISO order and parsed once.

A cell belongs to one class of shapes (a month name, numbers with separators,
digits only). Its class's anchored rewrites put the text into the order
``year-month-day time``; a text that no rewrite matches stays as it is and fails
the one parse that follows. A rewritten text starts with a mark that no rule
accepts, so one rule at most reads a text and none reads another's output. A new
shape costs a rewrite in its class, not another parse of every cell. Month comes
before day where both readings are possible, unless the caller knows the column
to be day first; a first number above 12 is a day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A two-digit year is read in the century that puts it less than this many
#: years after the as_of year.
CENTURY_WINDOW = 50

_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
#: A bare time of day names no date and is not parsed.
BARE_TIME = rf"^T?\d{{1,2}}:(?!.*\s(?:\d{{1,4}}([/.-])\d{{1,2}}\1\d{{1,4}}|.*(?i:{_MONTH})))"

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
_NTH = r"(?:st|nd|rd|th)?"
_YEAR = r"(\d{4}|\d{2}(?!:))"
_END = r"(?=[ T,]|$)"
_CLOCK = r"(\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)"
_MARK = "="  # before a rewritten text

# (pattern, rewrite); '#' stands for the month's number.
_WITH_MONTH_NAME = (
    (rf"(?i)^{_WEEKDAY}{_MONTH}[a-z]*\.?[ -]+(\d{{1,2}}){_NTH}(?:,\s*|[ -]+){_YEAR}{_END}", "$3-#-$2"),
    (rf"(?i)^{_WEEKDAY}(\d{{1,2}}){_NTH}[ -]+{_MONTH}[a-z]*\.?,?[ -]+{_YEAR}{_END}", "$3-#-$1"),
    (rf"(?i)^(\d{{4}})[ /-]{_MONTH}[a-z]*[ /-](\d{{1,2}}){_END}", "$1-#-$3"),
    (rf"(?i)^{_WEEKDAY}{_MONTH}[a-z]*\.?\s+(\d{{1,2}})\s+{_CLOCK}(\s(?:UTC|GMT))?\s+(\d{{4}})$", "$5-#-$2 $3$4"),
)
_DAY_NUMBER = r"(0?[1-9]|[12]\d|3[01])"
_MONTH_NUMBER = r"(0?[1-9]|1[0-2])"
_MONTH_FIRST = (
    (rf"^{_MONTH_NUMBER}([/.-]){_DAY_NUMBER}\2{_YEAR}{_END}", "$4-$1-$3"),
    (rf"^(1[3-9]|2\d|3[01])([/.-]){_MONTH_NUMBER}\2{_YEAR}{_END}", "$4-$3-$1"),
)
_DAY_FIRST = (
    (rf"^{_DAY_NUMBER}([/.-]){_MONTH_NUMBER}\2{_YEAR}{_END}", "$4-$3-$1"),
    (rf"^{_MONTH_NUMBER}([/.-])(1[3-9]|2\d|3[01])\2{_YEAR}{_END}", "$4-$1-$3"),
)
_YEAR_FIRST = ((rf"^(\d{{4}})([/.])(\d{{1,2}})\2(\d{{1,2}}){_END}", "$1-$3-$4"),)
_DIGITS_ONLY = (
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{2})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})(Z?)$", "$1-$2-$3 $4:$5:$6$7"),
    (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})$", "$1-$2-$3 $4:$5"),
)
# The time of day: one space before it, AM or PM in capitals after one space, a colon in the offset.
_HALF_DAY = r"(?i)\d\s*[ap]\.?m\.?(?=[\s,]|$)"
_HALF_DAY_FORMAT = "y-M-d h[:m[:s]] a[ xxx][ xx]"
# Applied one after another to the time after the date.
_CLOCK_SPELLINGS = (
    (r"\s*\([A-Za-z ]+\)$", ""),  # the zone's name after its offset
    (r"(:\d{2}),(\d{1,9})$", "$1.$2"),
    (r"(:\d{2}(?:\.\d+)?\s*[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"^(\S+ \d{1,2}:\d{2})(\s*(?:Z|UTC|GMT|[+-]\d{2}:\d{2}))$", "$1:00$2"),
)
_TIME_FIRST = rf"^{_CLOCK}\s+(\S.*)$"


def _rewrite(text: Column, rules) -> Column:
    for pattern, to in rules:
        text = F.regexp_replace(text, pattern, _MARK + to)
    return text


def iso_order(text: Column, day_first: Column | bool = False) -> Column:
    """The text with its date part as year-month-day (years as written).

    ``day_first`` reads ``3/10/2024`` as 3 October: a flag, or a column of them.
    """
    if isinstance(day_first, bool):
        ambiguous = _rewrite(text, _DAY_FIRST if day_first else _MONTH_FIRST)
    else:
        ambiguous = F.when(day_first, _rewrite(text, _DAY_FIRST)).otherwise(_rewrite(text, _MONTH_FIRST))
    named = text.rlike(f"(?i){_MONTH}")
    number = (F.instr(F.lit(_MONTHS), F.lower(F.regexp_extract(text, f"(?i){_MONTH}", 1))) + 2) / 3
    with_name = F.replace(_rewrite(text, _WITH_MONTH_NAME), F.lit("#"), number.cast("int").cast("string"))
    ordered = (
        F.when(named, with_name)
        .when(text.rlike(r"^\d{5,}T?\d*Z?$"), _rewrite(text, _DIGITS_ONLY))
        .otherwise(_rewrite(ambiguous, _YEAR_FIRST))
    )
    return F.regexp_replace(
        F.regexp_replace(ordered, rf"^{_MARK}", ""),
        r"^(\d+-\d+-\d+)(?:,|\s|T)+(?:at\s+)?(?=\d)", "$1 ",
    )


def _date_before_time(text: Column) -> Column:
    """``10:00 3/10/2024`` with the date first."""
    return F.regexp_replace(F.trim(text), _TIME_FIRST, "$2 $1")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _dated(ordered: Column, parse, as_of: Column) -> Column:
    """Parse with two-digit years read in this century, or the last one if too far ahead."""
    value = parse(F.regexp_replace(ordered, r"^(\d{2})-", "20$1-"))
    ahead = F.year(as_of) + CENTURY_WINDOW
    return F.when(
        ordered.rlike(r"^\d{2}-"),
        _bind(value, lambda v: F.when(F.year(v) >= ahead, v - F.expr("INTERVAL 100 YEARS")).otherwise(v)),
    ).otherwise(value)


def shaped_timestamp(text: Column, as_of: Column, day_first: Column | bool = False) -> Column:
    """Timestamp of a text of one of the shapes, else NULL (never an error)."""

    def half_day(t: Column) -> Column:
        spaced = F.regexp_replace(F.upper(t), r"\s*([AP])\.?M\.?(?:\s*([+-]\d{2}:?\d{2}))?\s*$", " $1M $2")
        return F.try_to_timestamp(F.rtrim(spaced), F.lit(_HALF_DAY_FORMAT))

    def full_day(t: Column) -> Column:
        for pattern, to in _CLOCK_SPELLINGS:
            t = F.regexp_replace(t, pattern, to)
        return F.try_to_timestamp(t)

    return _bind(
        iso_order(_date_before_time(text), day_first),
        lambda o: F.when(o.rlike(_HALF_DAY), _dated(o, half_day, as_of)).otherwise(_dated(o, full_day, as_of)),
    )


def shaped_date(text: Column, as_of: Column, day_first: Column | bool = False) -> Column:
    """Date of a text of one of the shapes (the date as written), else NULL."""

    def day(t: Column) -> Column:
        return F.try_to_date(F.regexp_substr(t, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}(?=\s|$)")))

    return _bind(iso_order(_date_before_time(text), day_first), lambda o: _dated(o, day, as_of))
