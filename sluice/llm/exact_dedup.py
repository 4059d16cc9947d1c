"""Exact dedup by distributed most-significant-digit radix partitioning.

Documents are split by successive byte strings of the normalised text. The
first digit is the byte length with the first bytes, so all members of a group
end together; every later digit is the next, 16 times wider, slice of bytes. A
group that becomes a singleton, or whose text has ended, is settled and leaves;
only the rest of the bytes of unsettled documents moves on. Groups are compared
byte by byte: no digest decides equality.

Each round is one grouped count (combined map-side, so a hot group of copies
shrinks to one row per task before the shuffle) and one join back on the digit,
which Spark may split when it is skewed. Rounds grow with the logarithm of the
longest text that has a copy; each byte of a document moves at most once a round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import free_name, lower_ascii, staged, table

FIRST_WIDTH = 32
GROWTH = 16


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    first_width: int = FIRST_WIDTH,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null is the empty
    text. The largest id of a group stays. Repeated rows count each in
    group_size, and all rows that carry the kept id are marked kept. Null ids
    never win over others (a group with null ids only keeps id null, kept true).
    An empty table gives no rows; other columns are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), lower_ascii(F.col(text_col)).alias("t"))
    width = first_width
    n, body = F.octet_length("t"), F.encode("t", "UTF-8")
    digit = F.substring(body, 1, width)
    groups = staged(_groups(base.select("id", n.alias("g"), digit.alias("d"))), "radix-groups")
    rows = base.select(
        "id", F.sha2("t", 256).alias("sha"), n.alias("g"), digit.alias("d"),
        F.substring(body, width + 1, 2147483647).alias("rest"),
    )
    settled = []
    while True:
        joined = rows.join(groups, ["g", "d"]).select(
            "id", "sha", "keep", "size", F.col("new_g").alias("g"),
            F.when((F.col("size") > 1) & (F.octet_length("rest") > 0), F.col("rest")).alias("rest"),
        )
        joined = staged(joined, "radix-rows")
        settled.append(joined.where("rest is null"))
        open_rows = joined.where("rest is not null")
        if not open_rows.select("g").head(1):
            break
        width *= growth
        rows = open_rows.select(
            "id", "sha", "g", F.substring("rest", 1, width).alias("d"),
            F.substring("rest", width + 1, 2147483647).alias("rest"),
        )
        groups = staged(_groups(rows.select("id", "g", "d")), "radix-groups")
    done = reduce(DataFrame.unionByName, settled)
    return done.select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def _groups(digits: DataFrame) -> DataFrame:
    """Groups by (parent group, digit): the id that stays, the size, a new group number."""
    return (
        digits.groupBy("g", "d")
        .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
        .withColumn("new_g", F.monotonically_increasing_id())
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row left of each group of equal texts, all columns kept.

    Of rows with one id and equal texts one stays; rows without an id all stay.
    """
    name, norm = free_name(docs, "gone"), free_name(docs, "normalised")
    verdict = exact_dedup(docs, id_col, text_col)
    dropped = verdict.where(~F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias(name))
    left = docs.join(dropped, docs[id_col].eqNullSafe(F.col(name)), "left_anti")
    repeated = docs.groupBy(id_col).count().where("count > 1")
    if repeated.head(1):  # the same row more than once
        left = left.withColumn(norm, lower_ascii(F.col(text_col))).dropDuplicates([id_col, norm]).drop(norm)
    return left


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t
"""
