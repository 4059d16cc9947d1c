"""Row counts and source-to-target reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame, name: str | None = None) -> DataFrame:
    """One-row frame ``(table_name, n_rows)``; partial counts per task, one merge."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).cast("string").alias("table_name"), "n_rows"
    )


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for several frames, as one union of global counts."""
    parts = [row_count(df, name) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: DataFrame, target: DataFrame, key_col: str | None = None,
              name: str | None = None) -> DataFrame:
    """Source and target counts side by side, as one row.

    With ``key_col`` also the number of source rows whose key is absent from the
    target; a NULL key is absent. Both sides are read once: their keys are tagged,
    unioned and counted per key and side (partial counts on every task, so a hot
    key is one row a task), then the counts are added up.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        key = F.col(key_col) if key_col is not None else F.lit(None)
        return df.select(key.cast("string").alias("key"), F.lit(tag).alias("side"))

    tagged = side(source, "s").unionByName(side(target, "t"))
    if key_col is None:
        per_key = tagged.groupBy("side").count().select(
            F.when(F.col("side") == "s", F.col("count")).alias("s"),
            F.when(F.col("side") == "t", F.col("count")).alias("t"),
            F.lit(None).cast("long").alias("m"),
        )
        missing = F.lit(None).cast("long")
    else:
        per_key = tagged.groupBy("key").agg(
            F.count_if(F.col("side") == "s").alias("s"), F.count_if(F.col("side") == "t").alias("t")
        )
        per_key = per_key.withColumn("m", F.when(F.col("key").isNull() | (F.col("t") == 0), F.col("s")))
        missing = F.coalesce(F.sum("m"), F.lit(0))
    return per_key.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows"),
        missing.alias("missing_in_target"),
    ).select(
        F.lit(name).cast("string").alias("table_name"),
        "source_rows",
        "target_rows",
        "missing_in_target",
        (F.col("source_rows") - F.col("target_rows")).alias("difference"),
    )
