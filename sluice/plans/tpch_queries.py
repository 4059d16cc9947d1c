"""Checked queries over the TPC-H-shaped test tables.

Each query exercises one operator over whole tables and has an equivalent
DuckDB SQL text. Dirty source text is derived from clean columns by the same
CASE expressions on both engines (a row's variant is chosen from its own
values; no row is filtered out). LTZ timestamps are returned as
``timestamp_ntz`` (wall clock in the session zone) so the two engines can be
compared without a zone.
"""

from __future__ import annotations

import hashlib
from typing import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, StringType, TimestampType

from sluice.functions import cells
from sluice.functions.keys import hash_key
from sluice.operators import conform as C
from sluice.operators import counts
from sluice.operators import load as L
from sluice.plans import ingest as P
from sluice.plans import lead_oracle, runlog
from sluice.session import compact_files, work_path
from sluice.sources import raw as R
from sluice.spec import make_spec
from sluice.specs import tpch

AS_OF = "2024-06-01 12:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"
MAX_YEAR = 2025
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ntz(df: DataFrame) -> DataFrame:
    """LTZ timestamps to wall-clock NTZ in the session zone (for comparison)."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# ---------------------------------------------------------------------------
# SQL helpers for the oracle (DuckDB dialect)
# ---------------------------------------------------------------------------

# Text shapes of the derived cells below, as this oracle's own strptime patterns.
STRPTIME = ("%m/%d/%Y", "%b %d, %Y", "%B %d, %Y", "%d-%b-%y", "%Y%m%d", "%d/%m/%Y")


def sql_junk(t: str) -> str:
    return f"(length({t}) <= 3 OR NOT regexp_matches({t}, '[0-9]'))"


def sql_ts_parse(t: str) -> str:
    tries = [f"TRY_CAST({t} AS TIMESTAMP)"] + [f"try_strptime({t}, '{f}')" for f in STRPTIME]
    return f"CASE WHEN {sql_junk(t)} THEN NULL ELSE coalesce({', '.join(tries)}) END"


def sql_range(ts: str) -> str:
    return f"CASE WHEN year({ts}) BETWEEN 1900 AND {MAX_YEAR} THEN {ts} END"


def sql_date_parse_raw(t: str) -> str:
    """Date parse without the future rule."""
    tries = [f"TRY_CAST({t} AS DATE)"] + [f"CAST(try_strptime({t}, '{f}') AS DATE)" for f in STRPTIME]
    return f"CASE WHEN {sql_junk(t)} THEN NULL ELSE coalesce({', '.join(tries)}) END"


def sql_date_parse(t: str) -> str:
    fb = sql_date_parse_raw(t)
    return (f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST({t} AS DATE) "
            f"ELSE (CASE WHEN {fb} <= DATE '{AS_OF[:10]}' THEN {fb} END) END")


def sql_number(t: str, typ: str) -> str:
    cleaned = f"trim(replace({t}, ',', ''))"
    return f"CASE WHEN regexp_matches({cleaned}, '^-?[0-9]+(\\.[0-9]+)?$') THEN TRY_CAST({cleaned} AS {typ}) END"


def sql_in(t: str, tokens: tuple[str, ...]) -> str:
    return f"lower({t}) IN ({', '.join(repr(x) for x in tokens)})"


def sql_bool(t: str) -> str:
    return f"CASE WHEN {sql_in(t, ("true", "1", "yes", "t"))} THEN true WHEN {sql_in(t, ("false", "0", "no", "f"))} THEN false END"


def sql_bool_text(t: str) -> str:
    return (f"CASE WHEN {sql_in(t, ("true", "1", "yes", "t"))} THEN 'TRUE' "
            f"WHEN {sql_in(t, ("false", "0", "no", "f"))} THEN 'FALSE' ELSE {t} END")


def sql_audit(source_system: str = "TPCH") -> str:
    return (f"{AS_OF_SQL} AS ETL_CREATED_DATE, {AS_OF_SQL} AS ETL_LAST_UPDATE_DATE, "
            f"'ETL_PROCESS' AS CREATED_BY, true AS TO_PROCESS, '{source_system}' AS EDW_EXTERNAL_SOURCE_SYSTEM")


def sql_key(parts: list[str]) -> str:
    """Every part with its length before it, NULL as a dash."""
    sized = [f"coalesce(length({p}) || ':' || {p}, '-')" for p in parts]
    return f"sha256({' || '.join(sized)})"


# Orders through the orders contract, in SQL.
ORDERS_CONFORMED_SQL = f"""
SELECT {sql_key(["CAST(CAST(o_orderkey AS DECIMAL(38,0)) AS VARCHAR)", "CAST(o_custkey AS VARCHAR)",
                 "o_orderstatus", "CAST(o_totalprice AS VARCHAR)",
                 f"CAST({sql_range('o_orderdate')} AS VARCHAR)", "o_orderpriority"])} AS STG_ORDERS_KEY,
       CAST(o_orderkey AS DECIMAL(38,0)) AS ORDER_KEY, CAST(o_custkey AS VARCHAR) AS CUST_KEY,
       o_orderstatus AS STATUS, o_totalprice AS TOTAL_PRICE, {sql_range('o_orderdate')} AS ORDER_DATE,
       o_orderpriority AS PRIORITY, {sql_audit()}
FROM orders"""


def orders_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.conform(read(spark, sf_dir, "orders"), tpch.orders_spec(), AS_OF)


# ---------------------------------------------------------------------------
# Derived dirty text (same text on both engines)
# ---------------------------------------------------------------------------

QTY = "CAST(CAST(l_quantity AS BIGINT) AS STRING)"
QTY_TEXT = (f"CASE l_linenumber % 7 WHEN 0 THEN ' ' || {QTY} || ' ' WHEN 1 THEN '1,' || {QTY} "
            f"WHEN 2 THEN 'n/a' WHEN 3 THEN '' WHEN 4 THEN '+' || {QTY} WHEN 5 THEN {QTY} || '.5' "
            f"ELSE '-' || {QTY} END")
PRICE_TEXT = ("CASE l_linenumber % 3 WHEN 0 THEN CAST(l_extendedprice AS STRING) "
              "WHEN 1 THEN ' ' || CAST(l_extendedprice AS STRING) "
              "ELSE 'USD ' || CAST(l_extendedprice AS STRING) END")
FLAG_TEXT = "CASE l_returnflag WHEN 'R' THEN 'yes' WHEN 'A' THEN 'No' ELSE l_returnflag END"
STATUS_TEXT = ("CASE WHEN l_linenumber % 5 = 0 THEN 'y' WHEN l_linestatus = 'O' THEN 't' "
               "ELSE 'FALSE' END")
META_TEXT = ("CASE l_linenumber % 3 WHEN 0 THEN '{\"q\": ' || CAST(l_quantity AS STRING) || '}' "
             "WHEN 1 THEN '[' || CAST(l_tax AS STRING) || ']' "
             "ELSE '{\"q\": ' || CAST(l_quantity AS STRING) END")


def _ship_text_spark() -> str:
    return ("CASE l_linenumber % 4 WHEN 0 THEN CAST(l_shipdate AS STRING) "
            "WHEN 1 THEN date_format(l_shipdate, 'MM/dd/yyyy') "
            "WHEN 2 THEN date_format(l_shipdate, 'yyyyMMdd') ELSE 'n/a' END")


SHIP_TEXT_SQL = ("CASE l_linenumber % 4 WHEN 0 THEN CAST(l_shipdate AS VARCHAR) "
                 "WHEN 1 THEN strftime(l_shipdate, '%m/%d/%Y') "
                 "WHEN 2 THEN strftime(l_shipdate, '%Y%m%d') ELSE 'n/a' END")


def _ship_day_spark() -> str:
    return ("CASE l_linenumber % 3 WHEN 0 THEN date_format(l_shipdate, 'yyyy-MM-dd') "
            "WHEN 1 THEN date_format(l_shipdate, 'MMM dd, yyyy') "
            "ELSE date_format(l_shipdate + INTERVAL 25 YEARS, 'MM/dd/yyyy') END")


SHIP_DAY_SQL = ("CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') "
                "WHEN 1 THEN strftime(l_shipdate, '%b %d, %Y') "
                "ELSE strftime(l_shipdate + INTERVAL 25 YEAR, '%m/%d/%Y') END")


def dirty_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as a text-typed extract with messy cells (all rows kept)."""
    return dirty_cells(read(spark, sf_dir, "lineitem"))


def dirty_cells(li: DataFrame) -> DataFrame:
    return li.select(
        "l_orderkey", "l_linenumber", "l_discount",
        F.expr(QTY_TEXT).alias("qty_text"),
        F.expr(PRICE_TEXT).alias("price_text"),
        F.expr(FLAG_TEXT).alias("flag_text"),
        F.expr(STATUS_TEXT).alias("status_text"),
        F.expr(_ship_text_spark()).alias("ship_text"),
        F.expr(_ship_day_spark()).alias("ship_day_text"),
        F.expr(META_TEXT).alias("meta_text"),
    )


DIRTY_LINEITEM_SQL = f"""
SELECT l_orderkey, l_linenumber, l_discount, {QTY_TEXT.replace('STRING', 'VARCHAR')} AS qty_text,
       {PRICE_TEXT.replace('STRING', 'VARCHAR')} AS price_text, {FLAG_TEXT} AS flag_text,
       {STATUS_TEXT} AS status_text, {SHIP_TEXT_SQL} AS ship_text, {SHIP_DAY_SQL} AS ship_day_text,
       {META_TEXT.replace('STRING', 'VARCHAR')} AS meta_text
FROM lineitem"""

LINEITEM_CLEAN_SQL = f"""
SELECT CAST(l_orderkey AS DECIMAL(38,0)) AS ORDER_KEY, CAST(l_linenumber AS DECIMAL(38,0)) AS LINE_NUMBER,
       {sql_number('qty_text', 'DECIMAL(38,0)')} AS QUANTITY, {sql_number('price_text', 'DOUBLE')} AS EXTENDED_PRICE,
       l_discount AS DISCOUNT, {sql_bool_text('flag_text')} AS IS_RETURNED, {sql_bool('status_text')} AS IS_OPEN,
       {sql_range(sql_ts_parse('ship_text'))} AS SHIP_DATE, {sql_date_parse('ship_day_text')} AS SHIP_DAY,
       CASE WHEN json_valid(meta_text) THEN meta_text END AS META,
       qty_text
FROM ({DIRTY_LINEITEM_SQL}) d"""

LINEITEM_KEY_SQL = sql_key([
    "CAST(ORDER_KEY AS VARCHAR)", "CAST(LINE_NUMBER AS VARCHAR)", "CAST(QUANTITY AS VARCHAR)",
    "CAST(EXTENDED_PRICE AS VARCHAR)", "CAST(DISCOUNT AS VARCHAR)", "IS_RETURNED", "CAST(IS_OPEN AS VARCHAR)",
    "CAST(SHIP_DATE AS VARCHAR)", "CAST(SHIP_DAY AS VARCHAR)", "META",
])
LINEITEM_COLS = ("ORDER_KEY, LINE_NUMBER, QUANTITY, EXTENDED_PRICE, DISCOUNT, IS_RETURNED, IS_OPEN, "
                 "SHIP_DATE, SHIP_DAY, META")


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

def q_conform_names(spark, sf_dir):
    return C.conform_names(read(spark, sf_dir, "customer"), tpch.customer_spec())


SQL_CONFORM_NAMES = """
SELECT c_custkey AS CUSTOMER_ID, c_name AS NAME, c_nationkey AS NATION_ID, c_acctbal AS BALANCE,
       c_mktsegment AS SEGMENT, CAST(NULL AS VARCHAR) AS PHONE
FROM customer"""


def q_conform_customer(spark, sf_dir):
    return ntz(C.conform(read(spark, sf_dir, "customer"), tpch.customer_spec(), AS_OF))


SQL_CONFORM_CUSTOMER = f"""
SELECT {sql_key(["CAST(CAST(c_custkey AS DECIMAL(38,0)) AS VARCHAR)", "c_name",
                 "CAST(CAST(c_nationkey AS DECIMAL(38,0)) AS VARCHAR)", "CAST(c_acctbal AS VARCHAR)",
                 "c_mktsegment", "CAST(NULL AS VARCHAR)"])} AS STG_CUSTOMER_KEY,
       CAST(c_custkey AS DECIMAL(38,0)) AS CUSTOMER_ID, c_name AS NAME,
       CAST(c_nationkey AS DECIMAL(38,0)) AS NATION_ID, c_acctbal AS BALANCE, c_mktsegment AS SEGMENT,
       CAST(NULL AS VARCHAR) AS PHONE, {sql_audit()}
FROM customer"""


def q_audit_stamp(spark, sf_dir):
    return ntz(C.with_audit(read(spark, sf_dir, "orders"), tpch.AUDIT, AS_OF))


SQL_AUDIT_STAMP = f"SELECT *, {sql_audit()} FROM orders"


def _orders_text(spark, sf_dir, spark_text: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", F.expr(spark_text).alias("raw"))


JUNK_SPARK = ("CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderdate AS STRING) WHEN 1 THEN 'n/a' WHEN 2 THEN '' "
              "WHEN 3 THEN 'abc' WHEN 4 THEN '999' ELSE 'unknown' END")


def q_ts_junk_to_null(spark, sf_dir):
    df = _orders_text(spark, sf_dir, JUNK_SPARK)
    clock = cells.as_of_col(AS_OF)
    return ntz(df.select("o_orderkey", "raw", cells.is_junk_time_text(F.col("raw")).alias("is_junk"),
                         cells.to_timestamp_cell(F.col("raw"), StringType(), clock).alias("ts")))


SQL_TS_JUNK = f"""
SELECT o_orderkey, raw, {sql_junk('raw')} AS is_junk, {sql_ts_parse('raw')} AS ts
FROM (SELECT o_orderkey, {JUNK_SPARK.replace('STRING', 'VARCHAR')} AS raw FROM orders) d"""

# Shapes of time text: (Spark text, DuckDB text, value kept: whole day, minutes or seconds).
def _shapes(col: str) -> list[tuple[str, str, str]]:
    def both(java: str, c: str, keeps: str = "day", before: str = "", after: str = "") -> tuple[str, str, str]:
        wrap = lambda x: f"'{before}' || {x} || '{after}'"
        return wrap(f"date_format({col}, \"{java}\")"), wrap(f"strftime({col}, '{c}')"), keeps

    return [
        both("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S", "second"), both("MM/dd/yyyy", "%m/%d/%Y"),
        both("M/d/yyyy", "%-m/%-d/%Y"), both("MM/dd/yy", "%m/%d/%y"), both("MM/dd/yyyy HH:mm", "%m/%d/%Y %H:%M", "minute"),
        both("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S", "second"),
        both("MM/dd/yyyy hh:mm:ss a", "%m/%d/%Y %I:%M:%S %p", "second"), both("M/d/yyyy h:mm a", "%-m/%-d/%Y %-I:%M %p", "minute"),
        both("MM-dd-yyyy", "%m-%d-%Y"), both("MM.dd.yyyy", "%m.%d.%Y"), both("yyyy/MM/dd", "%Y/%m/%d"),
        both("yyyy.MM.dd", "%Y.%m.%d"), both("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S", "second"),
        both("MMM dd, yyyy", "%b %d, %Y"), both("MMMM dd, yyyy", "%B %d, %Y"), both("MMM d yyyy", "%b %-d %Y"),
        both("MMMM d, yyyy h:mm a", "%B %-d, %Y %-I:%M %p", "minute"), both("d MMMM yyyy", "%-d %B %Y"),
        both("dd-MMM-yy", "%d-%b-%y"), both("dd-MMM-yyyy", "%d-%b-%Y"), both("dd MMM yyyy HH:mm:ss", "%d %b %Y %H:%M:%S", "second"),
        both("EEE, dd MMM yyyy HH:mm:ss", "%a, %d %b %Y %H:%M:%S", "second"),
        both("EEEE, MMMM d, yyyy", "%A, %B %-d, %Y"), both("yyyyMMdd", "%Y%m%d"),
        both("yyyyMMddHHmmss", "%Y%m%d%H%M%S", "second"), both("yyyyMMdd'T'HHmmss", "%Y%m%dT%H%M%S", "second"),
        both("yyyyMMddHHmm", "%Y%m%d%H%M", "minute"), both("yyyy-MM-dd h:mm a", "%Y-%m-%d %-I:%M %p", "minute"),
        both("yyyy-MMM-dd", "%Y-%b-%d"), both("MMM d, yyyy", "%b %-d, %Y", "day", "", " 00:00"),
    ]


# A time of day for every order, so that the time part matters too.
_TIMED_SPARK = "(o_orderdate + make_interval(0, 0, 0, 0, o_orderkey % 24, o_orderkey % 60, o_custkey % 60))"
_TIMED_SQL = ("(o_orderdate + to_hours((o_orderkey % 24)::INTEGER) + to_minutes((o_orderkey % 60)::INTEGER)"
              " + to_seconds(o_custkey % 60))")


def _shaped_text(spark_side: bool) -> str:
    shapes = _shapes("x")
    cases = " ".join(f"WHEN {i} THEN {s[0] if spark_side else s[1]}" for i, s in enumerate(shapes))
    return f"CASE o_orderkey % {len(shapes)} {cases} END"


def _shaped_frame(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("x", F.expr(_TIMED_SPARK))
    return orders.select("o_orderkey", F.expr(_shaped_text(True)).alias("raw"))


def q_ts_parse_formats(spark, sf_dir):
    df = _shaped_frame(spark, sf_dir)
    clock = cells.as_of_col(AS_OF)
    parsed = cells.to_timestamp_cell(F.col("raw"), StringType(), clock)
    return ntz(df.select("o_orderkey", "raw", cells.timestamp_in_range(parsed, clock).alias("ts")))


# The expected value comes from the clean column, cut to what the shape carries.
_KEPT = " ".join(f"WHEN {i} THEN date_trunc('{s[2]}', x)" for i, s in enumerate(_shapes("x")))
_TIMED_ORDERS = f"(SELECT *, CAST({_TIMED_SQL} AS TIMESTAMP) AS x FROM orders)"
SQL_TS_FORMATS = f"""
SELECT o_orderkey, {_shaped_text(False)} AS raw,
       CAST(CASE o_orderkey % {len(_shapes('x'))} {_KEPT} END AS TIMESTAMP) AS ts
FROM {_TIMED_ORDERS} o"""

FUTURE_SPARK = ("CASE o_orderkey % 2 WHEN 0 THEN CAST(o_orderdate + INTERVAL 24 YEARS AS STRING) "
                "ELSE date_format(o_orderdate + INTERVAL 24 YEARS, 'MM/dd/yyyy') END")
FUTURE_SQL = ("CASE o_orderkey % 2 WHEN 0 THEN CAST(o_orderdate + INTERVAL 24 YEAR AS VARCHAR) "
              "ELSE strftime(o_orderdate + INTERVAL 24 YEAR, '%m/%d/%Y') END")


def _future_frame(spark, sf_dir):
    df = _orders_text(spark, sf_dir, FUTURE_SPARK)
    clock = cells.as_of_col(AS_OF)
    ts = cells.timestamp_in_range(cells.to_timestamp_cell(F.col("raw"), StringType(), clock), clock)
    return df.select("o_orderkey", "raw", ts.alias("ts")), clock


def q_ts_future_policy(spark, sf_dir):
    df, clock = _future_frame(spark, sf_dir)
    return ntz(df.select(
        "o_orderkey", "raw", F.col("ts").alias("kept"),
        cells.apply_future_policy(F.col("ts"), clock, "null").alias("nulled"),
    ))


_FUT_TS = sql_range(sql_ts_parse("raw"))
SQL_TS_FUTURE = f"""
SELECT o_orderkey, raw, ts AS kept, CASE WHEN ts <= {AS_OF_SQL} THEN ts END AS nulled
FROM (SELECT o_orderkey, raw, {_FUT_TS} AS ts FROM (SELECT o_orderkey, {FUTURE_SQL} AS raw FROM orders) d) e"""


def q_clamp_future(spark, sf_dir):
    df, clock = _future_frame(spark, sf_dir)
    return ntz(df.select("o_orderkey", cells.clamp_future(F.col("ts"), clock).alias("clamped")))


SQL_CLAMP = f"""
SELECT o_orderkey, CASE WHEN ts > {AS_OF_SQL} THEN {AS_OF_SQL} ELSE ts END AS clamped
FROM (SELECT o_orderkey, {_FUT_TS} AS ts FROM (SELECT o_orderkey, {FUTURE_SQL} AS raw FROM orders) d) e"""

DATE_SPARK = ("CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate + INTERVAL 24 YEARS, 'yyyy-MM-dd') "
              "WHEN 1 THEN date_format(o_orderdate + INTERVAL 24 YEARS, 'MM/dd/yyyy') "
              "WHEN 2 THEN date_format(o_orderdate, 'MMM dd, yyyy') "
              "WHEN 3 THEN date_format(o_orderdate, 'yyyyMMdd') ELSE 'abc' END")
DATE_SQL = ("CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate + INTERVAL 24 YEAR, '%Y-%m-%d') "
            "WHEN 1 THEN strftime(o_orderdate + INTERVAL 24 YEAR, '%m/%d/%Y') "
            "WHEN 2 THEN strftime(o_orderdate, '%b %d, %Y') "
            "WHEN 3 THEN strftime(o_orderdate, '%Y%m%d') ELSE 'abc' END")


def q_date_parse(spark, sf_dir):
    df = _shaped_frame(spark, sf_dir).withColumn("kind", F.lit("shape")).unionByName(
        _orders_text(spark, sf_dir, DATE_SPARK).withColumn("kind", F.lit("rule")))
    clock = cells.as_of_col(AS_OF)
    return df.select("o_orderkey", "kind", "raw", cells.to_date_cell(F.col("raw"), StringType(), clock).alias("d"))


# ISO text is kept in the future, other future dates are not, the rest is the clean column.
SQL_DATE = f"""
SELECT o_orderkey, 'shape' AS kind, {_shaped_text(False)} AS raw, CAST(x AS DATE) AS d FROM {_TIMED_ORDERS} o
UNION ALL
SELECT o_orderkey, 'rule', {DATE_SQL}, CASE
         WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate + INTERVAL 24 YEAR AS DATE)
         WHEN o_orderkey % 5 = 1 AND o_orderdate + INTERVAL 24 YEAR < DATE '2024-06-02'
           THEN CAST(o_orderdate + INTERVAL 24 YEAR AS DATE)
         WHEN o_orderkey % 5 IN (2, 3) THEN CAST(o_orderdate AS DATE) END
FROM orders"""


def _qty_frame(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.expr(QTY_TEXT).alias("raw"),
                     F.expr(PRICE_TEXT).alias("price_raw"))


def q_decimal_clean(spark, sf_dir):
    df = _qty_frame(spark, sf_dir)
    return df.select("l_orderkey", "l_linenumber", "raw",
                     cells.to_number_cell(F.col("raw"), StringType(), DecimalType(38, 0)).alias("value"),
                     cells.to_number_cell(F.col("price_raw"), StringType(), DecimalType(38, 0)).alias("price"))


_QTY_SRC = (f"SELECT l_orderkey, l_linenumber, {QTY_TEXT.replace('STRING', 'VARCHAR')} AS raw, "
            f"{PRICE_TEXT.replace('STRING', 'VARCHAR')} AS price_raw FROM lineitem")
SQL_DECIMAL = f"""
SELECT l_orderkey, l_linenumber, raw, {sql_number('raw', 'DECIMAL(38,0)')} AS value,
       {sql_number('price_raw', 'DECIMAL(38,0)')} AS price
FROM ({_QTY_SRC}) d"""


def q_double_clean(spark, sf_dir):
    df = _qty_frame(spark, sf_dir)
    return df.select("l_orderkey", "l_linenumber", "raw",
                     cells.to_number_cell(F.col("raw"), StringType(), DoubleType()).alias("value"),
                     cells.to_number_cell(F.col("price_raw"), StringType(), DoubleType()).alias("price"))


SQL_DOUBLE = f"""
SELECT l_orderkey, l_linenumber, raw, {sql_number('raw', 'DOUBLE')} AS value,
       {sql_number('price_raw', 'DOUBLE')} AS price
FROM ({_QTY_SRC}) d"""

BOOL_TEXT = ("CASE l_linenumber % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN l_linestatus "
             "WHEN 3 THEN l_returnflag WHEN 4 THEN ' true' WHEN 5 THEN CAST(l_orderkey % 2 AS STRING) "
             "ELSE 'Yes' END")


def _bool_frame(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.expr(BOOL_TEXT).alias("raw"))


def q_bool_parse(spark, sf_dir):
    return _bool_frame(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "raw", cells.to_boolean_cell(F.col("raw"), StringType()).alias("flag"))


_BOOL_SRC = f"SELECT l_orderkey, l_linenumber, {BOOL_TEXT.replace('STRING', 'VARCHAR')} AS raw FROM lineitem"
SQL_BOOL = f"SELECT l_orderkey, l_linenumber, raw, {sql_bool('raw')} AS flag FROM ({_BOOL_SRC}) d"


def q_bool_string(spark, sf_dir):
    return _bool_frame(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "raw", cells.boolean_text_cell(F.col("raw"), StringType()).alias("flag"))


SQL_BOOL_STRING = f"SELECT l_orderkey, l_linenumber, raw, {sql_bool_text('raw')} AS flag FROM ({_BOOL_SRC}) d"

JSON_TEXT = ("CASE event_id % 7 WHEN 0 THEN props WHEN 1 THEN props || ' x' "
             "WHEN 2 THEN replace(props, '\"', '''') WHEN 3 THEN '' WHEN 4 THEN CAST(user_id AS STRING) "
             "WHEN 5 THEN '[' || props || ']' ELSE '{\"k\": ' || CAST(value AS STRING) END")


def q_json_guard(spark, sf_dir):
    ev = read(spark, sf_dir, "events").select("event_id", F.expr(JSON_TEXT).alias("raw"))
    return ev.select("event_id", "raw", cells.json_text_cell(F.col("raw"), StringType()).alias("json"))


SQL_JSON = f"""
SELECT event_id, raw, CASE WHEN json_valid(raw) THEN raw END AS json
FROM (SELECT event_id, {JSON_TEXT.replace('STRING', 'VARCHAR')} AS raw FROM events) d"""

SHIFT_SPARK = ("CASE event_id % 4 WHEN 0 THEN ts - INTERVAL 130 YEARS WHEN 1 THEN ts - INTERVAL 124 YEARS "
               "WHEN 2 THEN ts + INTERVAL 1 YEARS ELSE ts + INTERVAL 2 YEARS END")
SHIFT_SQL = ("CASE event_id % 4 WHEN 0 THEN ts - INTERVAL 130 YEAR WHEN 1 THEN ts - INTERVAL 124 YEAR "
             "WHEN 2 THEN ts + INTERVAL 1 YEAR ELSE ts + INTERVAL 2 YEAR END")


def q_ts_range_clean(spark, sf_dir):
    ev = read(spark, sf_dir, "events").select("event_id", F.expr(SHIFT_SPARK).alias("shifted"))
    clock = cells.as_of_col(AS_OF)
    ts = cells.to_timestamp_cell(F.col("shifted"), ev.schema["shifted"].dataType, clock)
    kept = cells.timestamp_in_range(ts, clock)
    return ntz(ev.select("event_id", "shifted", kept.alias("cleaned"),
                         cells.etl_default(kept, clock).alias("ETL_SEEN_DATE"),
                         cells.has_timestamp_garbage(kept).alias("garbage")))


SQL_TS_RANGE = f"""
SELECT event_id, shifted, {sql_range('shifted')} AS cleaned,
       coalesce({sql_range('shifted')}, {AS_OF_SQL}) AS ETL_SEEN_DATE,
       regexp_replace(CAST({sql_range('shifted')} AS VARCHAR), '[0-9\\-:. ]', '', 'g') <> ''
           AS garbage
FROM (SELECT event_id, {SHIFT_SQL} AS shifted FROM events) d"""


def q_hash_key_sha256(spark, sf_dir):
    return orders_conformed(spark, sf_dir).select("STG_ORDERS_KEY", "ORDER_KEY")


SQL_HASH_ORDERS = f"SELECT STG_ORDERS_KEY, ORDER_KEY FROM ({ORDERS_CONFORMED_SQL}) c"


def q_hash_key_events(spark, sf_dir):
    ev = read(spark, sf_dir, "events")
    cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return ev.select("event_id", hash_key([F.col(c) for c in cols]).alias("row_key"))


SQL_HASH_EVENTS = f"""
SELECT event_id, {sql_key(["CAST(event_id AS VARCHAR)", "CAST(ts AS VARCHAR)", "CAST(user_id AS VARCHAR)",
                           "event_type", "CAST(value AS VARCHAR)", "props"])} AS row_key
FROM events"""


def q_hash_key_sha3(spark, sf_dir):
    """SHA3-512 keys in the bare joined form, over text columns of few values."""
    parts = [F.col("o_orderpriority"), F.col("o_orderstatus")]
    return read(spark, sf_dir, "orders").select("o_orderkey", hash_key(parts, mode="compat").alias("row_key"))


# DuckDB has no SHA-3: digests of the columns' whole domain, computed here by hashlib.
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_DIGESTS = ", ".join(
    f"('{p}', '{s}', '{hashlib.sha3_512(f'{p}||{s}'.encode()).hexdigest()}')" for p in _PRIORITIES for s in "FOP"
)
SQL_HASH_SHA3 = f"""
SELECT o.o_orderkey, d.digest AS row_key
FROM orders o LEFT JOIN (VALUES {_DIGESTS}) d(p, s, digest) ON o.o_orderpriority = d.p AND o.o_orderstatus = d.s"""


def q_json_guard_large(spark, sf_dir):
    """Numbers of over a thousand digits, long strings and deep nesting are JSON like any other."""
    ev = read(spark, sf_dir, "events").select("event_id", F.expr(LARGE_JSON).alias("raw"))
    kept = cells.json_text_cell(F.col("raw"), StringType())
    return ev.select("event_id", F.length("raw").alias("n"), kept.isNotNull().alias("is_json"))


LARGE_JSON = ("CASE event_id % 6 WHEN 0 THEN repeat('9', 1500) WHEN 1 THEN '\"' || repeat('x', 20000) || '\"' "
              "WHEN 2 THEN repeat('[', 800) || repeat(']', 800) WHEN 3 THEN repeat('9', 1500) || ' 1' "
              "WHEN 4 THEN repeat('[', 800) || repeat(']', 799) ELSE '{\"a\": ' || repeat('7', 1200) || '}' END")
SQL_JSON_LARGE = f"""
SELECT event_id, length(raw)::INTEGER AS n, event_id % 6 IN (0, 1, 2, 5) AS is_json
FROM (SELECT event_id, {LARGE_JSON} AS raw FROM events) e"""


def q_null_shift_insert(spark, sf_dir):
    """Rows that differ only in where a NULL or the separator stands are all inserted."""
    orders = read(spark, sf_dir, "orders")
    spec = make_spec("shift", "SHIFT_KEY", [("a", "A", "string"), ("b", "B", "string"), ("id", "ID", "string")],
                     audit=None, hash_cols=("A", "B"))
    status, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    none = F.lit(None).cast("string")
    left = orders.select(key.alias("a"), none.alias("b"), key.alias("id"))
    right = orders.select(none.alias("a"), key.alias("b"), key.alias("id"))
    apart = orders.select(F.concat(key, F.lit("||"), status).alias("a"), F.lit("x").alias("b"), key.alias("id"))
    across = orders.select(key.alias("a"), F.concat(status, F.lit("||x")).alias("b"), key.alias("id"))
    target = L.Target(path=work_path(spark, "queries", "null_shift"))
    for batch in (left, right, apart.unionByName(across)):
        L.incremental_insert(C.conform(batch, spec, AS_OF), target, spec.key_col, create_if_missing=True)
    return L.read_target(spark, target).select("A", "B", "ID")


SQL_NULL_SHIFT = """
SELECT o_orderkey::VARCHAR AS A, NULL::VARCHAR AS B, o_orderkey::VARCHAR AS ID FROM orders
UNION ALL SELECT NULL, o_orderkey::VARCHAR, o_orderkey::VARCHAR FROM orders
UNION ALL SELECT o_orderkey::VARCHAR || '||' || o_orderpriority, 'x', o_orderkey::VARCHAR FROM orders
UNION ALL SELECT o_orderkey::VARCHAR, o_orderpriority || '||x', o_orderkey::VARCHAR FROM orders"""


def q_ts_range_any_target(spark, sf_dir):
    """Typed timestamps keep the year range whatever the target; dates from them drop the future."""
    spec = make_spec("shifted", "K", [("event_id", "EVENT_ID", "string"), ("s1", "AS_TEXT", "string"),
                                      ("s2", "AS_DAY", "date"), ("s3", "AS_TIME", "timestamp")], audit=None)
    shifted = read(spark, sf_dir, "events").select(
        "event_id", *[F.expr(SHIFT_SPARK).alias(c) for c in ("s1", "s2", "s3")])
    return ntz(C.conform(shifted, spec, AS_OF)).select("EVENT_ID", "AS_TEXT", "AS_DAY", "AS_TIME")


SQL_RANGE_ANY = f"""
SELECT event_id::VARCHAR AS EVENT_ID, kept::VARCHAR AS AS_TEXT,
       CASE WHEN kept::DATE <= DATE '2024-06-01' THEN kept::DATE END AS AS_DAY, kept AS AS_TIME
FROM (SELECT event_id, CASE WHEN year(s) BETWEEN 1900 AND 2025 THEN s END AS kept
      FROM (SELECT event_id, {SHIFT_SQL} AS s FROM events) a) b"""


def q_table_exists(spark, sf_dir):
    """Existence probes of path targets: each given table, and one that is not there."""
    names = [*TABLES, "no_such_table"]
    found = [(t, L.target_exists(spark, L.Target(path=f"{sf_dir.rstrip('/')}/{t}.parquet"))) for t in names]
    # one row a table, beside its count as read
    probes = spark.createDataFrame(found, "table_name string, present boolean")
    return probes.join(q_row_count(spark, sf_dir), "table_name", "left")


SQL_TABLE_EXISTS = """
SELECT table_name, true AS present, n_rows FROM ({counts}) c
UNION ALL SELECT 'no_such_table', false, NULL"""


def q_anti_join_new_rows(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_key")
    shipped = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return L.new_rows(orders, shipped, "order_key")


SQL_ANTI = """
SELECT o_orderkey AS order_key, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""


def _orders_target(spark, sf_dir, tag: str) -> tuple[L.Target, DataFrame]:
    """A fresh target already holding the orders with status F."""
    spec = tpch.orders_spec()
    conformed = orders_conformed(spark, sf_dir)
    target = L.Target(path=work_path(spark, "queries", tag))
    L.create_target(spark, target, spec.schema, spec.key_col)
    L.append_table(conformed.filter(F.col("STATUS") == "F"), target)
    return target, conformed


def q_incremental_insert(spark, sf_dir):
    spec = tpch.orders_spec()
    target, conformed = _orders_target(spark, sf_dir, "incremental")
    L.incremental_insert(conformed, target, spec.key_col)
    L.incremental_insert(conformed, target, spec.key_col)  # re-run: inserts nothing
    return ntz(L.read_target(spark, target))


SQL_INCREMENTAL = ORDERS_CONFORMED_SQL


def q_dedupe_insert(spark, sf_dir):
    """A batch holding every order three times; dedupe loads each once."""
    spec = tpch.orders_spec()
    target, conformed = _orders_target(spark, sf_dir, "dedupe")
    batch = conformed.unionByName(conformed).unionByName(conformed)
    L.incremental_insert(batch, target, spec.key_col, dedupe=True)
    return ntz(L.read_target(spark, target))


def _stream_orders(spark, sf_dir, spec, target, tag: str, **how):
    """The orders file as a stream, run twice: the second run finds no new file."""
    from sluice.streaming.incremental import start_incremental_stream

    ckpt = work_path(spark, "queries", tag)
    # a file stream source needs a directory or a glob, not a single file path
    path = f"{sf_dir.rstrip('/')}/orders*.parquet"
    for _ in range(2):
        q = start_incremental_stream(spark, path, read(spark, sf_dir, "orders").schema, spec, target,
                                     checkpoint_location=ckpt, **how)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def q_stream_incremental_insert(spark, sf_dir):
    """The orders file as a stream source, loaded by micro-batch incremental insert."""
    target, _ = _orders_target(spark, sf_dir, "stream")
    _stream_orders(spark, sf_dir, tpch.orders_spec(), target, "stream_ckpt", options=P.IngestOptions(as_of=AS_OF))
    return ntz(L.read_target(spark, target))


def q_stream_rejects(spark, sf_dir):
    """Streamed rows that break the contract are set aside with their reason, like in a batch."""
    spec = make_spec("orders_strict", "K", [("o_orderkey", "ORDER_KEY", "string"),
                                            ("o_orderstatus", "URGENT", "boolean", False)], audit=None)
    root = work_path(spark, "queries", "stream_rejects")
    good, bad = L.Target(path=f"{root}/good"), L.Target(path=f"{root}/bad")
    _stream_orders(spark, sf_dir, spec, good, "stream_rejects_ckpt", options=P.IngestOptions(as_of=AS_OF),
                   reject_target=bad)
    kept = L.read_target(spark, good).select("ORDER_KEY", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(L.read_target(spark, bad).select("ORDER_KEY", F.col(C.REASON_COL).alias("reason")))


SQL_STREAM_REJECTS = """
SELECT o_orderkey::VARCHAR AS ORDER_KEY,
       CASE WHEN o_orderstatus <> 'F' THEN 'URGENT: null in non-null column' END AS reason
FROM orders"""


def q_reject_rerun(spark, sf_dir):
    """Two ingests of one extract: every row that breaks the contract is set aside once."""
    spec = tpch.lineitem_spec(strict_quantity=True)
    root = work_path(spark, "queries", "reject_rerun")
    job = P.IngestJob(spec, lambda: dirty_lineitem(spark, sf_dir), L.Target(path=f"{root}/good"),
                      L.Target(path=f"{root}/bad"))
    opts = P.IngestOptions(as_of=AS_OF, create_if_missing=True, reject_unparseable=True)
    for _ in range(2):
        P.ingest_table(spark, job, opts)
    return L.read_target(spark, job.reject_target).select("ORDER_KEY", "LINE_NUMBER", C.REASON_COL)


def q_run_log_failed(spark, sf_dir):
    """In stop mode the failed table is logged before the error is raised."""
    log_path = work_path(spark, "queries", "run_log_failed")
    root = work_path(spark, "queries", "failed")
    jobs = [
        P.IngestJob(tpch.orders_spec(), lambda: read(spark, sf_dir, "orders"), L.Target(path=f"{root}/orders")),
        P.IngestJob(tpch.customer_spec(), lambda: read(spark, sf_dir, "no_such_table"), L.Target(path=f"{root}/c")),
        P.IngestJob(tpch.lineitem_spec(), lambda: dirty_lineitem(spark, sf_dir), L.Target(path=f"{root}/l")),
    ]
    try:
        P.ingest_tables(spark, jobs, P.IngestOptions(as_of=AS_OF, create_if_missing=True), run_log=log_path)
    except AnalysisException:
        pass
    return runlog.read_run_log(spark, log_path).select("table", "status", "rows_written")


SQL_RUN_LOG_FAILED = """
SELECT 'orders' AS "table", 'ok' AS status, count(*) AS rows_written FROM orders
UNION ALL SELECT 'customer', 'failed', NULL"""


def q_append_load(spark, sf_dir):
    target, conformed = _orders_target(spark, sf_dir, "append")
    L.append_table(conformed, target)
    return ntz(L.read_target(spark, target))


SQL_APPEND = f"SELECT * FROM ({ORDERS_CONFORMED_SQL}) a WHERE STATUS = 'F' UNION ALL {ORDERS_CONFORMED_SQL}"


def q_historical_reload(spark, sf_dir):
    """The target holds the F orders; a historical load replaces them with all orders."""
    target, conformed = _orders_target(spark, sf_dir, "reload")
    L.load(conformed, target, "STG_ORDERS_KEY", "append", historical=True)
    return ntz(L.read_target(spark, target))


SQL_RELOAD = ORDERS_CONFORMED_SQL


def q_raw_overwrite_roundtrip(spark, sf_dir):
    path = work_path(spark, "queries", "raw_nation")
    job = P.SyncJob("nation", lambda: read(spark, sf_dir, "nation"), path)
    P.sync_tables(spark, [job], audit=tpch.AUDIT, as_of=AS_OF)
    P.sync_tables(spark, [job], audit=tpch.AUDIT, as_of=AS_OF)  # overwrite, not append
    return ntz(R.read_raw(spark, path))


SQL_RAW_ROUNDTRIP = f"SELECT *, {sql_audit()} FROM nation"


def _quarantine(spark, sf_dir):
    spec = tpch.lineitem_spec(strict_quantity=True)
    extract = dirty_cells(R.spread_by(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"))
    conformed = C.conform(extract, spec, AS_OF, with_reason=True, reject_unparseable=True)
    return C.split_rejects(conformed)


def q_quarantine_rejects(spark, sf_dir):
    _, rejects = _quarantine(spark, sf_dir)
    return rejects.select("ORDER_KEY", "LINE_NUMBER", "QUANTITY", "IS_OPEN", "META", C.REASON_COL)


def _reason_sql() -> str:
    parts = [
        "CASE WHEN qty_text IS NOT NULL AND trim(qty_text) <> '' AND QUANTITY IS NULL "
        "THEN 'QUANTITY: unparseable' END",
        "CASE WHEN QUANTITY IS NULL THEN 'QUANTITY: null in non-null column' END",
        "CASE WHEN status_text IS NOT NULL AND trim(status_text) <> '' AND IS_OPEN IS NULL "
        "THEN 'IS_OPEN: unparseable' END",
        "CASE WHEN ship_text IS NOT NULL AND trim(ship_text) <> '' AND SHIP_PARSED IS NULL "
        "THEN 'SHIP_DATE: unparseable' END",
        "CASE WHEN ship_day_text IS NOT NULL AND trim(ship_day_text) <> '' AND SHIP_DAY_PARSED IS NULL "
        "THEN 'SHIP_DAY: unparseable' END",
        "CASE WHEN meta_text IS NOT NULL AND trim(meta_text) <> '' AND META IS NULL "
        "THEN 'META: unparseable' END",
    ]
    price = ("CASE WHEN price_text IS NOT NULL AND trim(price_text) <> '' AND EXTENDED_PRICE IS NULL "
             "THEN 'EXTENDED_PRICE: unparseable' END")
    parts.insert(2, price)
    return f"nullif(concat_ws('; ', {', '.join(parts)}), '')"


QUARANTINE_SQL = f"""
SELECT ORDER_KEY, LINE_NUMBER, QUANTITY, IS_OPEN, META, {_reason_sql()} AS _reject_reason
FROM (
  SELECT CAST(l_orderkey AS DECIMAL(38,0)) AS ORDER_KEY, CAST(l_linenumber AS DECIMAL(38,0)) AS LINE_NUMBER,
         {sql_number('qty_text', 'DECIMAL(38,0)')} AS QUANTITY,
         {sql_number('price_text', 'DOUBLE')} AS EXTENDED_PRICE,
         {sql_bool('status_text')} AS IS_OPEN, {sql_ts_parse('ship_text')} AS SHIP_PARSED,
         {sql_date_parse_raw('ship_day_text')} AS SHIP_DAY_PARSED,
         CASE WHEN json_valid(meta_text) THEN meta_text END AS META,
         qty_text, price_text, status_text, ship_text, ship_day_text, meta_text
  FROM ({DIRTY_LINEITEM_SQL}) d
) c"""

SQL_REJECT_RERUN = (f"SELECT ORDER_KEY, LINE_NUMBER, _reject_reason FROM ({QUARANTINE_SQL}) q "
                    "WHERE _reject_reason IS NOT NULL")
SQL_QUARANTINE_REJECTS = f"SELECT * FROM ({QUARANTINE_SQL}) q WHERE _reject_reason IS NOT NULL"


def q_quarantine_good(spark, sf_dir):
    good, _ = _quarantine(spark, sf_dir)
    return good.select("ORDER_KEY", "LINE_NUMBER", "QUANTITY", "IS_OPEN", "META")


SQL_QUARANTINE_GOOD = (f"SELECT ORDER_KEY, LINE_NUMBER, QUANTITY, IS_OPEN, META FROM ({QUARANTINE_SQL}) q "
                       "WHERE _reject_reason IS NULL")


def q_schema_report(spark, sf_dir):
    return C.schema_report(read(spark, sf_dir, "customer"), tpch.customer_profile_spec(), AS_OF)


def _report_row(i, column, src, expected, actual, present, unparseable, issue="NULL") -> str:
    return (f"SELECT {i} AS ordinal, '{column}' AS \"column\", {src} AS source_column, "
            f"'{expected}' AS expected_type, {actual} AS source_type, {issue} AS issue, "
            f"count(*) AS n_rows, {present} AS n_present, {unparseable} AS n_unparseable FROM customer")


SQL_SCHEMA_REPORT = " UNION ALL ".join([
    _report_row(0, "CUSTOMER_ID", "'c_custkey'", "decimal(38,0)", "'bigint'", "count(c_custkey)",
                "count_if(c_custkey IS NOT NULL AND TRY_CAST(c_custkey AS DECIMAL(38,0)) IS NULL)", issue="'type'"),
    _report_row(1, "NAME", "'c_name'", "string", "'string'",
                "count_if(c_name IS NOT NULL AND trim(c_name) <> '')", "count_if(false)"),
    _report_row(2, "BALANCE", "'c_acctbal'", "decimal(38,0)", "'double'", "count(c_acctbal)",
                "count_if(c_acctbal IS NOT NULL AND TRY_CAST(c_acctbal AS DECIMAL(38,0)) IS NULL)", issue="'type'"),
    _report_row(3, "IS_ACTIVE", "'c_mktsegment'", "boolean", "'string'",
                "count_if(c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> '')",
                f"count_if(c_mktsegment IS NOT NULL AND trim(c_mktsegment) <> '' AND "
                f"({sql_bool('c_mktsegment')}) IS NULL)", issue="'type'"),
    _report_row(4, "SIGNUP_DATE", "'c_nationkey'", "date", "'int'", "count(c_nationkey)",
                f"count_if(c_nationkey IS NOT NULL AND "
                f"({sql_date_parse_raw('CAST(c_nationkey AS VARCHAR)')}) IS NULL)", issue="'type'"),
    _report_row(5, "PHONE", "CAST(NULL AS VARCHAR)", "string", "CAST(NULL AS VARCHAR)", "0", "0",
                issue="'missing'"),
])


def q_row_count(spark, sf_dir):
    return counts.table_counts({t: read(spark, sf_dir, t) for t in TABLES})


SQL_ROW_COUNT = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
)


def q_reconcile(spark, sf_dir):
    conformed = orders_conformed(spark, sf_dir)
    loaded = conformed.filter(F.col("STATUS") == "F")
    return counts.reconcile(conformed, loaded, "STG_ORDERS_KEY", "orders")


SQL_RECONCILE = """
SELECT 'orders' AS table_name, count(*) AS source_rows, count_if(o_orderstatus = 'F') AS target_rows,
       count_if(o_orderstatus <> 'F') AS missing_in_target,
       count(*) - count_if(o_orderstatus = 'F') AS difference
FROM orders"""


def _ingest_jobs(spark, sf_dir, tag: str) -> list[P.IngestJob]:
    root = work_path(spark, "queries", tag)
    return [
        P.IngestJob(tpch.orders_spec(), lambda: read(spark, sf_dir, "orders"),
                    L.Target(path=f"{root}/orders")),
        P.IngestJob(tpch.lineitem_spec(), lambda: dirty_lineitem(spark, sf_dir),
                    L.Target(path=f"{root}/lineitem")),
        P.IngestJob(tpch.customer_spec(), lambda: read(spark, sf_dir, "customer"),
                    L.Target(path=f"{root}/customer")),
    ]


def q_run_log_latest(spark, sf_dir):
    log_path = work_path(spark, "queries", "run_log")
    jobs = _ingest_jobs(spark, sf_dir, "batch")
    opts = P.IngestOptions(mode="incremental_insert", as_of=AS_OF, create_if_missing=True)
    P.ingest_tables(spark, jobs, opts, run_log=log_path)
    P.ingest_tables(spark, jobs, opts, run_log=log_path)  # second run inserts nothing
    latest = runlog.latest_runs(runlog.read_run_log(spark, log_path))
    return latest.select("table", "action", "mode", "rows_in", "rows_written", "rows_rejected", "status")


SQL_RUN_LOG = """
SELECT 'orders' AS "table", 'ingest' AS action, 'incremental_insert' AS mode, count(*) AS rows_in,
       CAST(0 AS BIGINT) AS rows_written, CAST(0 AS BIGINT) AS rows_rejected, 'ok' AS status FROM orders
UNION ALL SELECT 'lineitem', 'ingest', 'incremental_insert', count(*), 0, 0, 'ok' FROM lineitem
UNION ALL SELECT 'customer', 'ingest', 'incremental_insert', count(*), 0, 0, 'ok' FROM customer"""


def q_lineitem_ingest(spark, sf_dir):
    """Flagship: dirty extract -> conform -> incremental insert -> target."""
    spec = tpch.lineitem_spec()
    target = L.Target(path=work_path(spark, "queries", "lineitem_ingest"))
    job = P.IngestJob(spec, lambda: dirty_lineitem(spark, sf_dir), target)
    P.ingest_table(spark, job, P.IngestOptions(as_of=AS_OF, create_if_missing=True))
    return ntz(L.read_target(spark, target))


SQL_LINEITEM_INGEST = f"""
SELECT {LINEITEM_KEY_SQL} AS STG_LINEITEM_KEY, {LINEITEM_COLS}, {sql_audit()}
FROM ({LINEITEM_CLEAN_SQL}) c"""


# ---------------------------------------------------------------------------
# The three lead contracts over the test tables, every source column fed
# ---------------------------------------------------------------------------

# contract -> (columns, key, table, number, day) of its extract
LEAD_FEEDS = {
    "lead_xref": (lead_oracle.LEAD_XREF, "STG_LCR_LEAD_XREF_KEY", "orders", "o_orderkey", "CAST(o_orderdate AS DATE)"),
    "lead_assignment": (lead_oracle.LEAD_ASSIGNMENT, "STG_LCR_LEAD_ASSIGNMENT_KEY", "lineitem",
                        "l_orderkey * 10 + l_linenumber", "CAST(l_shipdate AS DATE)"),
    "lead": (lead_oracle.LEAD, "STG_LCR_LEAD_KEY", "customer", "c_custkey",
             "DATE '1993-01-01' + CAST(c_custkey % 2000 AS INTEGER)"),
}


def _lead_contract(name: str) -> Query:
    listed, _, table, number, day = LEAD_FEEDS[name]

    def query(spark, sf_dir):
        from sluice.specs import lead_specs

        compact_files(spark)
        # a cell of an extract costs far more than its bytes tell: the rows are dealt before it is built
        rows = R.spread_in_order(read(spark, sf_dir, table).selectExpr(f"{number} AS k", f"{day} AS day"), "k")
        base = "SELECT k, CAST(day AS STRING) AS d, CAST(add_months(day, 324) AS STRING) AS f FROM {src}"
        extract = spark.sql(lead_oracle.extract_sql(listed, base).replace("'{\"k\": '", "'{{\"k\": '").replace("'}'", "'}}'"),
                            src=rows)
        return ntz(C.conform(extract, lead_specs(time_zone=None)[name], AS_OF))

    query.__doc__ = f"{table} as a {name} extract through the {name} contract."
    return query


def _lead_sql(name: str) -> str:
    listed, key, table, number, day = LEAD_FEEDS[name]
    base = (f"SELECT {number} AS k, CAST({day} AS VARCHAR) AS d, "
            f"CAST(CAST({day} + INTERVAL 27 YEAR AS DATE) AS VARCHAR) AS f FROM {table}")
    return lead_oracle.oracle_sql(listed, key, base, AS_OF)


QUERIES: dict[str, tuple[Query, str | None]] = {
    "conform_names": (q_conform_names, SQL_CONFORM_NAMES),
    "conform_customer": (q_conform_customer, SQL_CONFORM_CUSTOMER),
    "audit_stamp": (q_audit_stamp, SQL_AUDIT_STAMP),
    "ts_junk_to_null": (q_ts_junk_to_null, SQL_TS_JUNK),
    "ts_parse_formats": (q_ts_parse_formats, SQL_TS_FORMATS),
    "ts_parse_future_policy": (q_ts_future_policy, SQL_TS_FUTURE),
    "clamp_future": (q_clamp_future, SQL_CLAMP),
    "date_parse": (q_date_parse, SQL_DATE),
    "decimal_clean": (q_decimal_clean, SQL_DECIMAL),
    "double_clean": (q_double_clean, SQL_DOUBLE),
    "bool_parse": (q_bool_parse, SQL_BOOL),
    "bool_string": (q_bool_string, SQL_BOOL_STRING),
    "json_guard": (q_json_guard, SQL_JSON),
    "ts_range_clean": (q_ts_range_clean, SQL_TS_RANGE),
    "hash_key_sha256": (q_hash_key_sha256, SQL_HASH_ORDERS),
    "hash_key_events": (q_hash_key_events, SQL_HASH_EVENTS),
    "hash_key_sha3": (q_hash_key_sha3, SQL_HASH_SHA3),
    "json_guard_large": (q_json_guard_large, SQL_JSON_LARGE),
    "null_shift_insert": (q_null_shift_insert, SQL_NULL_SHIFT),
    "ts_range_any_target": (q_ts_range_any_target, SQL_RANGE_ANY),
    "table_exists": (q_table_exists, SQL_TABLE_EXISTS.format(counts=SQL_ROW_COUNT)),
    "reject_rerun": (q_reject_rerun, SQL_REJECT_RERUN),
    "run_log_failed": (q_run_log_failed, SQL_RUN_LOG_FAILED),
    "stream_rejects": (q_stream_rejects, SQL_STREAM_REJECTS),
    "anti_join_new_rows": (q_anti_join_new_rows, SQL_ANTI),
    "incremental_insert": (q_incremental_insert, SQL_INCREMENTAL),
    "dedupe_insert": (q_dedupe_insert, SQL_INCREMENTAL),
    "stream_incremental_insert": (q_stream_incremental_insert, SQL_INCREMENTAL),
    "append_load": (q_append_load, SQL_APPEND),
    "historical_reload": (q_historical_reload, SQL_RELOAD),
    "raw_overwrite_roundtrip": (q_raw_overwrite_roundtrip, SQL_RAW_ROUNDTRIP),
    "quarantine_rejects": (q_quarantine_rejects, SQL_QUARANTINE_REJECTS),
    "quarantine_good": (q_quarantine_good, SQL_QUARANTINE_GOOD),
    "schema_report": (q_schema_report, SQL_SCHEMA_REPORT),
    "row_count": (q_row_count, SQL_ROW_COUNT),
    "reconcile": (q_reconcile, SQL_RECONCILE),
    "run_log_latest": (q_run_log_latest, SQL_RUN_LOG),
    "lineitem_ingest": (q_lineitem_ingest, SQL_LINEITEM_INGEST),
    "lead_xref_contract": (_lead_contract("lead_xref"), _lead_sql("lead_xref")),
    "lead_assignment_contract": (_lead_contract("lead_assignment"), _lead_sql("lead_assignment")),
    "lead_contract": (_lead_contract("lead"), _lead_sql("lead")),
}
