"""Secret scans: fixed patterns, then character Markov models of what they leave.

Two first-order Markov chains over the characters of tokens are trained from labelled
samples that the corpus itself gives: random strings are the different values that the
fixed patterns find (of assignments those with a digit), ordinary identifiers the
different words of eight or more characters of all texts without those matches, so far
as they change neither between letters and digits nor from small to capital letters. A run of
16 or more token characters that no pattern match overlaps is a secret when the sum of
the log-likelihood ratios of its character pairs, random over ordinary, passes a
threshold. Ratios are whole thousandths, so sums do not depend on their order.

All of it is DataFrame functions. A match's place comes from the lengths of what lies
between matches (``split``) and of the matches, added up by a window over one text's
matches; whether a run overlaps a match, from the matches' furthest end before it and
nearest start after it. The chains are counted by grouped aggregates; the driver sees
one count per pair of an alphabet of 67.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged, table

# --- fixed values: the kinds in their order, as the contract writes them ---
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# --- end of fixed values ---

KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6
RUN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
WORD = r"[A-Za-z0-9+/_-]{8,}"
MIXED = "[A-Za-z][0-9]|[0-9][A-Za-z]|[a-z][A-Z]"
#: What a text must hold for a kind's matches to be looked for.
GATES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""", "access": ACCESS, "hex": HEX, "random": RUN,
}
ALPHABET = 67  # A-Z a-z 0-9 + / _ - =
THRESHOLD = 12.0
#: Parts of a token with the character after each: pairs across parts are kept.
_PART = r"(.{1,4096})(?=(.?))"


def _found(text: Column, kind: str, pattern: str, value: int) -> list[Column]:
    """Lengths between a kind's matches, lengths of the matches, and their values; null without any."""
    there = text.rlike(GATES[kind])
    return [
        F.when(there, F.transform(F.split(text, pattern, -1), F.length)).alias(f"{kind}_between"),
        F.when(there, F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)).alias(f"{kind}_long"),
        F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(value))).alias(f"{kind}_value"),
    ]


def matches(texts: DataFrame) -> DataFrame:
    """(row, kind, start, end, value) of every match of every kind, from a table of ``row`` and ``_found``'s columns."""
    each = None
    for k, kind in enumerate(KINDS):
        part = texts.where(F.size(f"{kind}_long") > 0).select(
            "row", F.lit(k).alias("kind"),
            F.posexplode(F.arrays_zip(
                F.col(f"{kind}_between").alias("between"), F.col(f"{kind}_long").alias("long"), F.col(f"{kind}_value").alias("value")
            )).alias("nth", "m"),
        ).where("m.long is not null").select("row", "kind", "nth", "m.*")  # the last piece has no match after it
        each = part if each is None else each.unionByName(part)
    before = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    return (
        each.withColumn("end", F.sum(F.col("between") + F.col("long")).over(before))
        .select("row", "kind", (F.col("end") - F.col("long")).alias("start"), "end", "value")
    )


def _pairs(token: Column) -> Column:
    """The character pairs of a token in parts of bounded length: arrays of 128 * first + second."""
    parts = F.zip_with(
        F.regexp_extract_all(token, F.lit(_PART), F.lit(1)), F.regexp_extract_all(token, F.lit(_PART), F.lit(2)), lambda a, b: F.concat(a, b)
    )

    def of_part(part: Column) -> Column:
        codes = F.transform(F.split(part, ""), F.ascii)
        firsts = F.slice(codes, F.lit(1), F.size(codes) - 1)
        return F.zip_with(firsts, F.slice(codes, F.lit(2), F.size(codes)), lambda a, b: a * 128 + b)

    return F.transform(parts, of_part)


def train(secrets: DataFrame, words: DataFrame) -> list[int]:
    """Log-likelihood ratios, random over ordinary, in thousandths, by 128 * first + second.

    Both frames have one column of tokens; different tokens count once. Every pair has
    one count more than seen, so without samples all characters are equally likely.
    """
    samples = None
    for label, df in ((1, secrets), (0, words)):
        part = df.select(F.col(df.columns[0]).alias("token")).distinct().select(F.lit(label).alias("random"), "token")
        samples = part if samples is None else samples.unionByName(part)
    counted = (
        samples.select("random", F.explode(F.flatten(_pairs(F.col("token")))).alias("pair"))
        .groupBy("random", "pair").count().collect()  # two counts at most for each pair of the alphabet
    )
    seen = {0: [0] * (128 * 128), 1: [0] * (128 * 128)}
    for r in counted:
        seen[r["random"]][r["pair"]] = r["count"]
    firsts = {k: [sum(v[a * 128 : a * 128 + 128]) for a in range(128)] for k, v in seen.items()}

    def log(label: int, pair: int) -> float:
        return math.log((seen[label][pair] + 1) / (firsts[label][pair // 128] + ALPHABET))

    return [round(1000 * (log(1, i) - log(0, i))) for i in range(128 * 128)]


def log_odds(token: Column, model: list[int]) -> Column:
    """Sum of the ratios of a token's character pairs, in thousandths."""
    ratios = F.split(F.lit(" ".join(map(str, model))), " ").cast("array<int>")  # folded to one literal
    part_sum = lambda pairs: F.aggregate(pairs, F.lit(0).cast("long"), lambda s, x: s + F.get(ratios, x))
    return F.aggregate(_pairs(token), F.lit(0).cast("long"), lambda s, part: s + part_sum(part))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per input row: row, id and ``found``, its spans as structs (start, kind, end), in order; kind counts in ``KINDS``.

    ``row`` tells rows apart, also those of one id. Places are code points, the end is
    exclusive. ``assign``, ``access`` and ``hex`` are the fixed patterns' matches,
    ``random`` what the models add; a ``random`` span overlaps no other one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = staged(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
            *_found(text, "assign", ASSIGN, 2), *_found(text, "access", ACCESS, 0),
            *_found(text, "hex", HEX, 0), *_found(text, "random", RUN, 0),
        ),
        "secret-matches",
    )
    spans = staged(
        matches(rows).where((F.col("kind") != 0) | (F.length("value") >= LEAST_VALUE)), "secret-spans"
    )
    in_order = Window.partitionBy("row").orderBy("start", "kind")
    by_pattern = F.col("kind") < 3
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    after = in_order.rowsBetween(1, Window.unboundedFollowing)
    placed = (
        spans.withColumn("last_end", F.max(F.when(by_pattern, F.col("end"))).over(before))
        .withColumn("next_start", F.min(F.when(by_pattern, F.col("start"))).over(after))
    )
    clear = ~(F.coalesce(F.col("last_end") > F.col("start"), F.lit(False)) | F.coalesce(F.col("next_start") < F.col("end"), F.lit(False)))

    plain = text
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = docs.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("token")).where(~F.col("token").rlike(MIXED))
    secrets = spans.where(by_pattern & ((F.col("kind") != 0) | F.col("value").rlike("[0-9]")))
    token = F.regexp_extract_all(F.col("value"), F.lit(r"[A-Za-z0-9+/_=-]+"), F.lit(0))
    model = train(secrets.select(F.explode(token).alias("token")), words)
    kept = placed.where(by_pattern | (clear & (log_odds(F.col("value"), model) > round(1000 * threshold))))
    found = kept.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    return rows.select("row", F.col("id").alias(id_col)).join(found, "row", "left").withColumn(
        "found", F.coalesce("found", F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)"))
    )


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_random, base_sha256, spans: one row per input row.

    Spans are written ``kind:start:end`` and joined by commas, by start and then kind;
    ``base_sha256`` is the digest of the patterns' alone. Null texts count as empty and
    have no spans; rows repeated, with ties or without an id are scanned each for itself
    (different values count once in training); an empty table gives no rows; other
    columns are ignored. Long texts are scanned whole: their matches and tokens are
    worked off in bounded parts.
    """
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(k: int) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < 3)
    return secret_spans(docs, id_col, text_col, threshold).select(
        id_col, *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
    )


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
