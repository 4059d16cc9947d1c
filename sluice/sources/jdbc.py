"""Relational sources over JDBC.

A whole-table JDBC read without bounds is one task on one executor. Given a
numeric/date partition column, the read is split into ``num_partitions``
range predicates that run in parallel; the bounds can be fetched with one
pushed-down ``min``/``max`` query. Filters, column pruning and aggregates on
the resulting frame are pushed into the source query by Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FETCHSIZE = 10000
# A name part is a plain word, or anything in double quotes (a doubled quote stands for one).
_PART = re.compile(r'\w+|"(?:[^"]|"")+"')
_MISSING_TABLE_STATES = ("42P01", "42X05", "42S02")


def name_parts(table: str) -> list[str]:
    """The dot-separated parts of a table name, quoted ones with their quotes kept."""
    parts, at = [], 0
    while True:
        m = _PART.match(table, at)
        if m is None:
            raise ValueError(f"not a table name: {table!r}")
        parts.append(m.group())
        at = m.end()
        if at == len(table):
            return parts
        if table[at] != ".":
            raise ValueError(f"not a table name: {table!r}")
        at += 1


def valid_table_name(table: str) -> bool:
    """Whether the text is one to three dot-separated identifiers."""
    try:
        return len(name_parts(table)) <= 3
    except ValueError:
        return False


def parse_table_name(table: str, default_schema: str = "public") -> tuple[str, str]:
    """(schema, name) as the source spells them; a catalog part stays with the schema."""
    if not valid_table_name(table):
        raise ValueError(f"not a table name: {table!r}")
    *schema, name = name_parts(table)
    return ".".join(schema) or default_schema, name


def bare_name(part: str) -> str:
    """An identifier without its quotes, for file and table names on this side."""
    return part[1:-1].replace('""', '"') if part.startswith('"') else part


def _reader(spark: SparkSession, url: str, properties: dict | None, fetchsize: int):
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader


def query_scan(spark: SparkSession, url: str, query: str, *, properties: dict | None = None,
               fetchsize: int = DEFAULT_FETCHSIZE) -> DataFrame:
    """Run a query on the source and read its result."""
    return _reader(spark, url, properties, fetchsize).option("query", query).load()


def partition_bounds(spark: SparkSession, url: str, table: str, column: str, *,
                     properties: dict | None = None) -> tuple[object, object]:
    """``(min, max)`` of the partition column, computed by the source."""
    row = query_scan(
        spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}", properties=properties
    ).first()
    values = {k.lower(): v for k, v in row.asDict().items()}
    return values["lo"], values["hi"]


def read_jdbc(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetchsize: int = DEFAULT_FETCHSIZE,
              default_schema: str = "public") -> DataFrame:
    """Read a source table, in parallel when a partition column is given."""
    schema, name = parse_table_name(table, default_schema)
    qualified = f"{schema}.{name}"
    reader = _reader(spark, url, properties, fetchsize).option("dbtable", qualified)
    if partition_column is None:
        return reader.load()
    if lower_bound is None or upper_bound is None:
        lower_bound, upper_bound = partition_bounds(
            spark, url, qualified, partition_column, properties=properties
        )
        if lower_bound is None:  # empty table
            return reader.load()
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", str(lower_bound))
        .option("upperBound", str(upper_bound))
        .option("numPartitions", str(num_partitions or spark.sparkContext.defaultParallelism))
        .load()
    )


def jdbc_table_exists(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
                      default_schema: str = "public") -> bool:
    """Probe with a zero-row query; a missing table is False, other errors raise."""
    schema, name = parse_table_name(table, default_schema)
    try:
        query_scan(spark, url, f"SELECT * FROM {schema}.{name} WHERE 1 = 0", properties=properties).schema
        return True
    except Exception as exc:  # the JDBC driver's error surfaces as a Java exception
        if _sql_state(exc) in _MISSING_TABLE_STATES:
            return False
        raise


def _sql_state(exc: BaseException) -> str | None:
    """SQLSTATE of the driver's exception behind a Spark error, if it has one."""
    cause = getattr(exc, "java_exception", None) or getattr(exc, "_origin", None)
    for _ in range(20):
        if cause is None:
            break
        if hasattr(cause, "getSQLState"):
            try:
                return cause.getSQLState()
            except Exception:  # py4j gives every attribute; only SQLExceptions answer
                pass
        cause = cause.getCause()
    return None


def jdbc_count(spark: SparkSession, url: str, table: str, *, properties: dict | None = None,
               default_schema: str = "public") -> DataFrame:
    """Row count computed by the source (one pushed-down query)."""
    schema, name = parse_table_name(table, default_schema)
    return query_scan(spark, url, f"SELECT COUNT(*) AS ROWS_ FROM {schema}.{name}", properties=properties)
