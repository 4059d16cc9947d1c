"""Checked queries on how dates and times are read, expected from the clean column."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions import cells
from sluice.operators import conform as C
from sluice.plans.tpch_queries import AS_OF, Query, ntz, read
from sluice.sources.raw import spread_by
from sluice.spec import make_spec

# Spellings of one day with a two-digit year, in both engines' patterns, and of one
# moment of it in forms the native cast does not take.
TWO_DIGIT = (("M/d/yy", "%-m/%-d/%y"), ("MM/dd/yy", "%m/%d/%y"), ("M-d-yy", "%-m-%-d-%y"), ("MM.dd.yy", "%m.%d.%y"),
             ("d-MMM-yy", "%-d-%b-%y"), ("MMM d, yy", "%b %-d, %y"), ("yyMMdd", "%y%m%d"))
MOMENTS = (("M/d/yy H:mm", "%-m/%-d/%y %-H:%M"), ("EEE MMM dd HH:mm:ss yyyy", "%a %b %d %H:%M:%S %Y"),
           ("M/d/yyyy hh:mm:ss a '+0000'", "%-m/%-d/%Y %I:%M:%S %p +0000"),
           ("EEE, d MMM yyyy HH:mm:ss '+0000 (UTC)'", "%a, %-d %b %Y %H:%M:%S +0000 (UTC)"),
           ("HH:mm M/d/yyyy", "%H:%M %-m/%-d/%Y"), ("yyyy-MM-dd HH:mm:ss',250'", "%Y-%m-%d %H:%M:%S,250"),
           ("yyyy-MM-dd HH:mm 'UTC'", "%Y-%m-%d %H:%M UTC"))


def _turn(cells_: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cells_))
    return f"CASE o_orderkey % {len(cells_)} {cases} END"


def q_date_two_digit_years(spark, sf_dir):
    """Orders moved by 0 to 40 years, each spelled with a two-digit year or as a moment of the day."""
    day = "(CAST(o_orderdate AS DATE) + make_ym_interval(CAST(o_orderkey % 41 AS INT), 0))"
    moment = f"(CAST({day} AS TIMESTAMP_NTZ) + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), CAST(o_orderkey % 60 AS INT), 0))"
    texts = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(_turn([f"date_format({day}, '{p}')" for p, _ in TWO_DIGIT])).alias("day_text"),
        F.expr(_turn([f'date_format({moment}, "{p}")' for p, _ in MOMENTS])).alias("moment_text"),
    )
    clock = cells.as_of_col(AS_OF)
    parsed, iso = cells.date_parse_parts(F.col("day_text"), StringType(), clock)
    old = spark.conf.get("spark.sql.session.timeZone")
    offset = F.col("moment_text").rlike(r"\+0000|UTC")  # texts that name their zone are read in it
    moment_cell = cells.to_timestamp_cell(F.col("moment_text"), StringType(), clock)
    return ntz(texts.select(
        "o_orderkey", "day_text", parsed.alias("day"), cells.date_future_rule(parsed, iso, clock).alias("kept_day"),
        cells.to_timestamp_cell(F.col("day_text"), StringType(), clock).alias("midnight"), "moment_text",
        F.when(offset, F.to_utc_timestamp(moment_cell, old)).otherwise(moment_cell).alias("moment"),
    ))


_DAY = "CAST(o_orderdate + to_years((o_orderkey % 41)::INTEGER) AS DATE)"
_MOMENT = f"(CAST({_DAY} AS TIMESTAMP) + to_hours((o_orderkey % 24)::INTEGER) + to_minutes((o_orderkey % 60)::INTEGER))"
SQL_TWO_DIGIT = f"""
SELECT o_orderkey, {_turn([f"strftime({_DAY}, '{p}')" for _, p in TWO_DIGIT])} AS day_text, {_DAY} AS day,
       CASE WHEN {_DAY} <= DATE '{AS_OF[:10]}' THEN {_DAY} END AS kept_day, CAST({_DAY} AS TIMESTAMP) AS midnight,
       {_turn([f"strftime({_MOMENT}, '{p}')" for _, p in MOMENTS])} AS moment_text,
       CASE WHEN o_orderkey % {len(MOMENTS)} = 5 THEN {_MOMENT} + INTERVAL 250 MILLISECOND ELSE {_MOMENT} END AS moment
FROM orders"""

def vote_spec():
    return make_spec("order_days", "DAYS_KEY", [
        ("o_orderkey", "ORDER_KEY", "decimal(38,0)"), ("day_text", "ORDER_DAY", "date"),
        ("us_text", "US_TIME", "timestamp"), ("mixed_text", "MIXED_DAY", "date"),
    ], audit=None)


def q_date_column_vote(spark, sf_dir):
    """Order dates written day first, month first and both ways in one column, each column read as its cells vote."""
    orders = spread_by(read(spark, sf_dir, "orders"), "o_orderkey").select(
        "o_orderkey", F.expr("date_format(o_orderdate, 'd/M/yyyy')").alias("day_text"),
        F.expr("date_format(o_orderdate, 'MM-dd-yy')").alias("us_text"),
        F.expr("date_format(o_orderdate, CASE WHEN o_orderkey % 2 = 0 THEN 'dd.MM.yyyy' ELSE 'MM.dd.yyyy' END)").alias("mixed_text"),
    )
    spec = vote_spec()
    report = C.schema_report(orders, spec, AS_OF, vote_dates=True)
    said = report.agg(F.array_join(F.sort_array(F.collect_list(
        F.concat_ws(":", "column", "reading", "issue"))), ",").alias("readings"))
    read_as = C.conform(orders, spec, AS_OF, day_first=C.day_first_columns(orders, spec))
    return ntz(read_as.select("ORDER_KEY", "ORDER_DAY", "US_TIME")).crossJoin(F.broadcast(said))  # one row


SQL_COLUMN_VOTE = """
SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS ORDER_KEY, CAST(o_orderdate AS DATE) AS ORDER_DAY,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS US_TIME,
       'MIXED_DAY:conflict:day order,ORDER_DAY:day_first:type,ORDER_KEY:type,US_TIME:month_first:type' AS readings
FROM orders"""

QUERIES: dict[str, tuple[Query, str | None]] = {
    "date_two_digit_years": (q_date_two_digit_years, SQL_TWO_DIGIT),
    "date_column_vote": (q_date_column_vote, SQL_COLUMN_VOTE),
}
