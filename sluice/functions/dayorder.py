"""Day first or month first: one reading a column, voted by its unambiguous cells.

``3/10/2024`` alone says nothing, but one ``25/10/2024`` in the same column of the same
extract does. One aggregated pass counts, per column, the cells that only one reading
takes, so that the ambiguous cells of the column are read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FIRST, MONTH_FIRST, CONFLICT, UNDECIDED = "day_first", "month_first", "conflict", "undecided"
_NUMBERS = r"(?:^|\s)(\d{1,2})([/.-])(\d{1,2})\2(?:\d{4}|\d{2})(?=[ T,]|$)"


def vote_counts(text: Column) -> list[Column]:
    """Aggregates over a column of text: cells only a day-first reading takes, only a month-first, and either."""
    a, b = (F.regexp_extract(text, _NUMBERS, i).try_cast("int") for i in (1, 3))
    month_a, month_b = a.between(1, 12), b.between(1, 12)
    day_a, day_b = a.between(13, 31), b.between(13, 31)
    return [F.count_if(day_a & month_b), F.count_if(month_a & day_b), F.count_if(month_a & month_b & (a != b))]


def reading(day_only: Column, month_only: Column) -> Column:
    """What the counts say: both kinds of cells are a conflict, none leaves it undecided."""
    return (
        F.when((day_only > 0) & (month_only > 0), CONFLICT)
        .when(day_only > 0, DAY_FIRST).when(month_only > 0, MONTH_FIRST).otherwise(UNDECIDED)
    )
