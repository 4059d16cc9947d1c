"""Opt-in lenient parsing of time text that no built-in pattern accepts.

This is the one place Python runs per value, and only when asked for: a
vectorised (Arrow-batched) pandas UDF over the cells the built-in chain left
NULL. Callers pass NULL for every other row, so the UDF's work is limited to
the residue. Missing date parts are taken from the as_of date (where the
replaced system took today's date), so results are repeatable; the junk and
bare-time rules of the built-in path apply here too.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from sluice.functions import fixed, timetext

_LETTERS_ONLY = re.compile(fixed.LETTERS_ONLY_PATTERN)
_DIGIT = re.compile(fixed.HAS_DIGIT_PATTERN)
_BARE_TIME = re.compile(timetext.BARE_TIME)


def _is_junk(s: str) -> bool:
    return (len(s) <= fixed.JUNK_MAX_LENGTH or _LETTERS_ONLY.search(s) is not None
            or _DIGIT.search(s) is None or _BARE_TIME.search(s) is not None)


def lenient_timestamp(text: Column, as_of: Column, zone: str) -> Column:
    """Parse free-form time text (month first when ambiguous) as wall clock in ``zone``.

    Returns a timestamp; NULL text, junk and unparseable text give NULL.
    """
    try:
        from dateutil import parser as du
    except ImportError as exc:  # pragma: no cover - dateutil ships with pandas
        raise RuntimeError("lenient parsing needs python-dateutil") from exc

    @F.pandas_udf(TimestampType())
    def parse(values: pd.Series, clock: pd.Series) -> pd.Series:
        out = pd.Series(pd.NaT, index=values.index, dtype="datetime64[us]")
        todo = values.notna()
        for i in values.index[todo]:
            s = values[i]
            if _is_junk(s):
                continue
            base = pd.Timestamp(clock[i]).to_pydatetime().replace(
                hour=0, minute=0, second=0, microsecond=0, tzinfo=None)
            try:
                ts = du.parse(s, default=base)
            except (ValueError, OverflowError):
                continue
            stamp = pd.Timestamp(ts)
            if stamp.tzinfo is not None:
                stamp = stamp.tz_convert(zone).tz_localize(None)
            out[i] = stamp
        # naive values are read by Spark as wall clock in the session zone
        return out

    return parse(text, as_of)
