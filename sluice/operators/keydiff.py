"""Source against target by a tree of checksums: which keys are missing, extra or repeated.

Every key hashes to 64 bits, and each side adds up its hashes per prefix of the hash:
sums do not depend on order, and a task passes on one row per prefix, never its keys.
Only prefixes whose sums or counts differ are taken apart further, by 8 more bits a
level, until few rows are left under them or most prefixes differ anyway. The keys
under the prefixes that still differ are compared themselves. So equal sides cost one
scan of the key column each and shuffle no keys, and the answer is exact but for two
sides whose 63-bit sums agree by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import work_path

LEVEL_BITS = 8
DEEPEST = 32
#: Rows under differing prefixes that are compared without going deeper.
LEAF_ROWS = 1_000_000
#: Differing prefixes of one level that are worth going deeper for.
MOST_PREFIXES = 4096


def _keys(df: DataFrame, key_col: str) -> DataFrame:
    key = F.col(key_col).cast("string")
    return df.select(key.alias("key"), F.xxhash64(F.coalesce(key, F.lit("\0null"))).alias("h"))


def _sums(keys: DataFrame, bits: int, side: str) -> DataFrame:
    """Per prefix: rows, and the hash in three parts of 21 bits added up (no sum overflows)."""
    parts = [F.sum(F.shiftrightunsigned("h", 21 * i).bitwiseAND(F.lit((1 << 21) - 1))).alias(f"s{i}") for i in range(3)]
    return keys.groupBy(F.shiftrightunsigned("h", 64 - bits).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), *parts
    ).select("prefix", F.lit(side).alias("side"), "n", "s0", "s1", "s2")


def differing_prefixes(source: DataFrame, target: DataFrame, bits: int) -> DataFrame:
    """(prefix, rows) where the two sides' sums differ."""
    both = _sums(source, bits, "s").unionByName(_sums(target, bits, "t"))
    sign = F.when(F.col("side") == "s", 1).otherwise(-1)
    gaps = [F.sum(F.col(c) * sign).alias(c) for c in ("n", "s0", "s1", "s2")]
    return (
        both.groupBy("prefix").agg(F.sum("n").alias("rows"), *gaps)
        .where("n <> 0 or s0 <> 0 or s1 <> 0 or s2 <> 0").select("prefix", "rows")
    )


def key_diff(source: DataFrame, target: DataFrame, key_col: str, target_key_col: str | None = None, *,
             leaf_rows: int = LEAF_ROWS, work: list | None = None) -> DataFrame:
    """(key, source_rows, target_rows, status) for every key whose numbers of rows differ.

    ``missing``: only the source has it; ``extra``: only the target; ``repeated``: both,
    in different numbers. Keys are compared as text; NULL is a key of its own. Empty
    sides and equal sides give what follows from that. ``work``, if given, gets one
    (bits, differing prefixes, rows under them) for every level gone through.
    """
    spark = source.sparkSession
    s, t = _keys(source, key_col), _keys(target, target_key_col or key_col)
    under = None
    for bits in range(LEVEL_BITS, DEEPEST + 1, LEVEL_BITS):
        path = work_path(spark, "keydiff", str(bits))
        # written: the next level and the comparison read a few rows instead of scanning again
        differing_prefixes(*(_under(x, under, bits - LEVEL_BITS) for x in (s, t)), bits).write.parquet(path)
        under = spark.read.schema("prefix long, rows long").parquet(path)
        n, rows = under.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).first()
        if work is not None:
            work.append((bits, n, rows))
        if rows <= leaf_rows or n > MOST_PREFIXES:
            break
    left = _under(s, under, bits).withColumn("side", F.lit("s")).unionByName(_under(t, under, bits).withColumn("side", F.lit("t")))
    counted = left.groupBy("key").agg(
        F.count_if(F.col("side") == "s").alias("source_rows"), F.count_if(F.col("side") == "t").alias("target_rows")
    )
    status = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("repeated")
    return counted.where("source_rows <> target_rows").withColumn("status", status)


#: Checksums of one side that ``unequal_prefixes`` compares.
PREFIXES = 4096


def hash_prefix(key_col: str) -> Column:
    """The prefix of ``PREFIXES`` that a key's checksum is kept under."""
    return F.xxhash64(key_col).bitwiseAND(F.lit(PREFIXES - 1))


def unequal_prefixes(source: DataFrame, target: DataFrame, key_col: str) -> DataFrame:
    """(prefix) under which the two sides hold different keys, or one in different numbers.

    Each side adds up two 64-bit hashes of its keys per prefix, so that different keys
    pass for equal ones only where 128 bits and the counts agree by chance.
    """
    def sums(df: DataFrame, sign: int) -> DataFrame:
        hashes = df.select(F.xxhash64(key_col).alias("h0"), F.xxhash64(F.lit(1), key_col).alias("h1"))
        halves = [F.col(h).bitwiseAND(F.lit((1 << 32) - 1)) for h in ("h0", "h1")]
        halves += [F.shiftrightunsigned(h, 32) for h in ("h0", "h1")]
        return hashes.groupBy(F.col("h0").bitwiseAND(F.lit(PREFIXES - 1)).alias("prefix")).agg(
            (F.count(F.lit(1)) * sign).alias("n"), *[(F.sum(x) * sign).alias(f"s{i}") for i, x in enumerate(halves)]
        )

    names = ["n", "s0", "s1", "s2", "s3"]
    both = sums(source, 1).unionByName(sums(target, -1)).groupBy("prefix").agg(*[F.sum(c).alias(c) for c in names])
    return both.where(" or ".join(f"{c} <> 0" for c in names)).select("prefix")


def _under(keys: DataFrame, prefixes: DataFrame | None, bits: int) -> DataFrame:
    """The keys under these prefixes of ``bits`` bits (all, without any)."""
    if prefixes is None:
        return keys
    return keys.withColumn("prefix", F.shiftrightunsigned("h", 64 - bits)).join(prefixes.select("prefix"), "prefix", "left_semi").drop("prefix")
