"""Mixing sources to target weights: random keys, range sort, prefix sums, exact cuts.

Every document gets a hash-random key. Within each source the key space is cut
into equal ranges of about ``range_rows`` documents, ranges are summed and
prefix-summed, and a running sum inside each range gives every document the
number of words before it. The mix takes whole epochs while the budget lasts and
cuts the last epoch at the exact word, so a source's taken words equal its
rounded target. Only (id, source, size, key) moves, never the text; a hot source
is spread over as many ranges as it has rows for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import free_name, staged, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
RANGE_ROWS = 8192
WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Targets per source from (source, source_size, n_docs): one row per source.

    ``share`` times all words are dealt by weight; a target stops at
    ``max_epochs`` times its source, and what is over is dealt again among the
    others. Sources reach their stop in order of stop / weight, so the final
    level is found from running sums in that order. The table has one row per
    source, so its ordered windows run over source rows, not documents.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sizes.select(
        "*", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).alias("weight")
    ).select("*", (F.col("source_size") * max_epochs).alias("stop"))
    filling = Window.orderBy(
        (F.col("stop") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    level = weighed.select(
        "*",
        (
            F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("stop").over(filling), F.lit(0))
        ).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))).alias("weights_left"),
    ).select("*", (F.col("left") * F.col("weight") / F.col("weights_left") > F.col("stop")).alias("stopped"))
    # The first source in filling order that does not stop sets the level for itself and all after it.
    place = F.struct(
        (F.col("stop") / F.col("weight")).alias("ratio"), F.col("source").isNull().alias("last"), F.col("source").alias("name")
    )
    first = F.min(F.when(~F.col("stopped"), F.struct(place.alias("place"), "left", "weights_left"))).over(everything)
    level = level.select("*", place.alias("place"), first.alias("first"))
    target = F.when(
        F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("stop").cast("double")
    ).otherwise(F.col("first.left") * F.col("weight") / F.col("first.weights_left"))
    return level.select("source", "source_size", "n_docs", "weight", target.cast("double").alias("target"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    range_rows: int = RANGE_ROWS,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken.

    size counts words of the whole text (null or blank: 0, taken 0). taken is
    the number of words the mix uses, repeats counted: whole epochs, and in the
    last, partial one the words up to the source's budget, the target rounded to
    a whole word. Order is by a hash of (seed, id), ties by id: reruns agree, and
    equal rows are interchangeable. A null source is a source of its own, last
    in order. An empty table gives no rows; other columns are ignored.
    """
    digest = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    sized = staged(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        ),
        "mix-sized",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    plan = source_targets(sizes, weights, share, max_epochs)
    words = F.round("target").cast("long")
    plan = plan.select(
        F.col("source").alias("s"), "source_size", "target",
        F.ceil(F.col("n_docs") / range_rows).cast("long").alias("ranges"),
        F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
        words.alias("words"),
    )
    plan = staged(plan, "mix-plan")
    half = KEY_BITS // 2
    keyed = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "range", F.shiftright(F.shiftright("key", half) * F.col("ranges"), half)
    )
    sums = keyed.groupBy("s", "range").agg(F.sum("size").alias("in_range"))
    before = sums.select(
        F.col("s").alias("bs"), F.col("range").alias("brange"),
        F.coalesce(
            F.sum("in_range").over(
                Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
            ), F.lit(0),
        ).alias("before_range"),
    )
    inside = Window.partitionBy("s", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(before, F.col("s").eqNullSafe(F.col("bs")) & (F.col("range") == F.col("brange")))
    ahead = F.col("before_range") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    partial = F.greatest(
        F.lit(0).cast("long"),
        F.least(F.col("size"), F.col("words") - F.col("epochs") * F.col("source_size") - F.col("ahead")),
    )
    return placed.withColumn("ahead", ahead).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + partial).alias("taken"),
    )


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixed corpus: each document as often as the mix starts it, all columns kept.

    The one document per source that the budget cuts stays whole. Null and blank texts
    hold no words, so the mix never starts them. Rows repeated under one id are each
    repeated as often as the id's most used row; null ids are one id. An empty table
    stays empty.
    """
    name, count, copy = (free_name(docs, x) for x in ("mixed_id", "times", "copy"))
    plan = mix_sources(docs, id_col, text_col, source_col, **how).where("taken > 0")
    times = plan.groupBy(F.col(id_col).alias(name)).agg(
        F.max(F.ceil(F.col("taken") / F.col("size"))).cast("int").alias(count)
    )
    cols = docs.columns
    return (
        docs.join(times, docs[id_col].eqNullSafe(F.col(name)))
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(count))))
        .select(*cols)
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                     WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS stop FROM s),
l AS (SELECT *, row_number() OVER (ORDER BY stop / weight, source NULLS LAST) AS pos,
        1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(stop) OVER (ORDER BY stop / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY stop / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights_left
      FROM w),
f AS (SELECT * FROM l WHERE rest * weight / weights_left <= stop ORDER BY pos LIMIT 1),
t AS (SELECT l.source, l.source_size,
        (CASE WHEN f.pos IS NULL OR l.pos < f.pos THEN l.stop ELSE f.rest * l.weight / f.weights_left END)::DOUBLE AS target
      FROM l LEFT JOIN f ON true),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS words,
        CASE WHEN t.source_size > 0 THEN round(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, words - epochs * source_size - ahead)))::BIGINT AS taken
FROM p
"""
