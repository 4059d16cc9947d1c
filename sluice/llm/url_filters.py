"""URL filters: allow and block rules, then naive Bayes over segmented words.

Rules give a verdict to the urls they fit; the longest fitting rule wins. All
other urls are judged by a multinomial naive Bayes classifier trained on the
urls that rules decide. Its tokens are words: host labels and path parts are
split by unigram Viterbi segmentation, so ``cheappills`` counts as ``cheap``
and ``pills``. The unigram counts are taken over the visible words of every page.

Neither table is cut, collected or sent to tasks: each different run of letters is
joined by its substrings to the word counts, each different url by its tokens to the
class counts, and a task holds what one run or one url finds there.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import LOWER, UPPER, staged, table

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
LONGEST_WORD = 24
FLUSH_WORDS = 200_000
KEY_LETTERS = 64
_TAG = re.compile(r"<(?:script|style)\b.*?</(?:script|style)\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_WORD = re.compile(r"[a-z]+")


def url_parts(url: F.Column) -> tuple[F.Column, F.Column]:
    """(host, path) of a url; both empty without ``://``."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*).*$"
    url = F.coalesce(url.cast("string"), F.lit(""))
    host, path = (F.regexp_extract(url, whole, i) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def rule_for(host: F.Column, path: F.Column, rules=RULES) -> tuple[F.Column, F.Column]:
    """(rule, its verdict) of the longest rule that fits; nulls where none does."""
    name = verdict = F.lit(None).cast("string")
    for at, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(start))
        name = F.when(fits, at + start).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits runs of letters into the likeliest words under a unigram model.

    ``total`` is the sum of all counts where ``counts`` holds only some words.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = max(1, sum(counts.values()) if total is None else total)
        self.score = {w: math.log(n / total) for w, n in counts.items()}
        # an unknown word gets rarer by a factor of ten with every letter
        self.unknown = [math.log(1 / total) - math.log(10) * n for n in range(LONGEST_WORD + 1)]

    def split(self, run: str) -> list[str]:
        best, back = [0.0] + [-math.inf] * len(run), [0] * (len(run) + 1)
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - LONGEST_WORD), end):
                s = best[start] + self.score.get(run[start:end], self.unknown[end - start])
                if s > best[end]:
                    best[end], back[end] = s, start
        words, end = [], len(run)
        while end:
            words.append(run[back[end] : end])
            end = back[end]
        words.reverse()
        return words


def _counted(frame: DataFrame, words_of, key: str) -> DataFrame:
    """(key, n): how often ``words_of`` a batch's rows yields each string, summed within tasks first."""

    def rows(held: Counter):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=[key, "n"]
        )

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for words in words_of(batch):
                held.update(words)
                if len(held) >= FLUSH_WORDS:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    return frame.mapInArrow(count, f"{key} string, n long").groupBy(key).agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows of the largest counts ``n``: as many whole classes of counts as ``most`` rows hold.

    A class is an eighth of a doubling, so the driver sees a few hundred class sizes.
    """
    counted = staged(counted, "counts").withColumn("class", F.floor(F.log2("n") * 8))
    left, lowest = most, None
    for r in sorted(counted.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        left -= r["count"]
        if left < 0:
            break
        lowest = r["class"]
    return counted.where(F.lit(False) if lowest is None else F.col("class") >= lowest).drop("class")


def counted_words(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n) of all visible words of all pages."""

    def visible(batch):
        for html in batch.column(0).to_pylist():
            if html:
                yield (w for w in _WORD.findall(_TAG.sub(" ", html).lower()) if len(w) <= LONGEST_WORD)

    return _counted(pages.select(F.col(html_col).cast("string")), visible, "word")


def word_counts(pages: DataFrame, html_col: str = "html") -> dict[str, int]:
    """``counted_words`` in the driver, for small tables."""
    return {r["word"]: r["n"] for r in counted_words(pages, html_col).collect()}


def short_key(text: F.Column) -> F.Column:
    """``text``, or its digest where it is long; no text may start with ``#``."""
    return F.when(F.length(text) <= KEY_LETTERS, text).otherwise(F.concat(F.lit("#"), F.sha2(text, 256)))


def segments(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, split): the likeliest words of every different run under all ``words`` (a written table)."""
    total = words.agg(F.sum("n")).first()[0] or 0
    runs = staged(runs.select(short_key(F.col("run")).alias("key"), "run"), "runs")

    def substrings(batches):
        def rows(held):
            keys, subs = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(subs, pa.string())], names=["key", "word"])

        for batch in batches:
            held: set[tuple[str, str]] = set()
            for key, run in zip(*(batch.column(c).to_pylist() for c in ("key", "run")), strict=True):
                for start in range(len(run)):
                    held.update((key, run[start:end]) for end in range(start + 1, min(len(run), start + LONGEST_WORD) + 1))
                    if len(held) >= FLUSH_WORDS:
                        yield rows(held)
                        held = set()
            if held:
                yield rows(held)

    def split(batches):
        for batch in batches:
            runs_ = batch.column("run").to_pylist()
            known = batch.column("known").to_pylist()
            found = [Segmenter({k["word"]: k["n"] for k in ks}, total).split(r) for r, ks in zip(runs_, known, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(found, pa.list_(pa.string()))], names=["run", "split"])

    known = runs.mapInArrow(substrings, "key string, word string").join(words.hint("merge"), "word")
    return (
        known.select("key", F.lit(None).cast("string").alias("run"), F.struct("word", "n").alias("k"))
        .unionByName(runs.select("key", "run", F.lit(None).cast("struct<word:string,n:bigint>").alias("k")))
        .groupBy("key").agg(F.max("run").alias("run"), F.collect_set("k").alias("known")).select("run", "known")
        .mapInArrow(split, "run string, split array<string>")
    )


def url_tokens(urls: DataFrame, words: DataFrame) -> DataFrame:
    """(key, words) of (key, host, path): the words of host and path in order, each
    marked with where it stands; numbers by their length."""

    def parts(mark, text):
        found = F.regexp_extract_all(text, F.lit("[a-z]+|[0-9]+"), F.lit(0))
        return F.transform(found, lambda p: F.struct(F.lit(mark).alias("mark"), p.alias("part")))

    every = F.concat(parts("h:", F.col("host")), parts("p:", F.translate("path", UPPER, LOWER)))
    pieces = urls.select("key", F.posexplode_outer(every).alias("pos", "p")).select("key", "pos", "p.mark", "p.part")
    pieces = staged(pieces, "url-parts")
    runs = pieces.where(F.col("part") >= "a").select(F.col("part").alias("run")).distinct()
    split = staged(segments(runs, words), "segments").withColumnRenamed("run", "part")
    number = F.when(F.col("part").isNotNull(), F.array(F.translate("part", "0123456789", "#" * 10)))
    number = F.coalesce(number, F.array().cast("array<string>"))
    return (
        pieces.join(split.hint("merge"), "part", "left")
        .select("key", F.struct("pos", "mark", F.coalesce("split", number).alias("split")).alias("p"))
        .groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("p"))
        .select("key", F.flatten(F.transform("p", lambda p: F.transform(p["split"], lambda w: F.concat(p["mark"], w)))).alias("words"))
    )


class HostBayes:
    """Multinomial naive Bayes over tokens, with add-one smoothing.

    ``urls``: urls a class; ``tokens``: their tokens; ``kinds``: different tokens of all.
    """

    def __init__(self, urls: dict[str, int], tokens: dict[str, int], kinds: int):
        self.classes = sorted(urls)
        everything = sum(urls.values())
        self.prior = {c: math.log(urls[c] / everything) for c in self.classes}
        self.total = {c: tokens.get(c, 0) + kinds + 1 for c in self.classes}

    def verdict(self, seen: list[dict[str, int]]) -> str:
        """The likelier class by the counts ``seen`` of each token a class; allow when there is nothing to tell by."""
        if not self.classes:
            return "allow"
        score = {c: self.prior[c] + sum(math.log((t.get(c, 0) + 1) / self.total[c]) for t in seen) for c in self.classes}
        return max(self.classes, key=lambda c: (score[c], c == "allow"))


def judged_tokens(urls: DataFrame, tokens: DataFrame) -> DataFrame:
    """(key, verdict) of the urls that no rule decides, by all tokens of those that one does."""
    counted = staged(
        urls.where(F.col("ruled").isNotNull()).select("key", "ruled", "copies").join(tokens, "key")
        .select("ruled", "copies", F.explode("words").alias("token"))
        .groupBy("token", "ruled").agg(F.sum("copies").alias("n")),
        "class-tokens",
    )
    ruled = urls.where(F.col("ruled").isNotNull()).groupBy("ruled").agg(F.sum("copies")).collect()
    sums = counted.groupBy("ruled").agg(F.sum("n")).collect()
    seen = staged(
        counted.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("ruled", "n"))).alias("seen")), "tokens"
    )
    bayes = HostBayes(dict(map(tuple, ruled)), dict(map(tuple, sums)), seen.count())

    def judge(batches):
        for batch in batches:
            found = [
                bayes.verdict([dict(t["seen"] or ()) for t in sorted(ts, key=lambda t: t["pos"]) if t["pos"] >= 0])
                for ts in batch.column("t").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(found, pa.string())], names=["key", "verdict"])

    # summed in the order of the url's tokens, so that a verdict never changes from run to run; -1: a url without any
    return (
        urls.where(F.col("ruled").isNull()).select("key").join(tokens, "key")
        .select("key", F.posexplode_outer("words").alias("pos", "token"))
        .join(seen.hint("merge"), "token", "left")
        .groupBy("key").agg(F.collect_list(F.struct(F.coalesce("pos", F.lit(-1)).alias("pos"), "seen")).alias("t"))
        .mapInArrow(judge, "key string, verdict string")
    )


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    rules=RULES,
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, words (the segmented tokens).

    A null url, or one without ``://``, has an empty host and path and no rule; it
    gets the likelier class of ruled urls, or allow when no url is ruled. Null or
    empty html adds no words. Repeated rows and null ids give a row each, equal
    urls get equal verdicts; an empty table gives no rows; other columns are ignored.
    """
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, says = rule_for(F.col("host"), F.col("path"), rules)
    parts = parts.select("*", name.alias("rule"), says.alias("ruled"))
    # a host has no slash or # and a path starts with a slash, so the two tell the url's key
    parts = parts.withColumn("key", short_key(F.concat("host", "path")))
    urls = staged(
        parts.groupBy("key").agg(
            F.max("host").alias("host"), F.max("path").alias("path"), F.max("ruled").alias("ruled"), F.count(F.lit(1)).alias("copies")
        ),
        "urls",
    )
    words = staged(counted_words(pages, html_col), "word-counts")
    tokens = staged(url_tokens(urls, words), "url-tokens")
    found = staged(tokens.join(judged_tokens(urls, tokens), "key", "left"), "url-verdicts")
    return parts.join(found.hint("merge"), "key").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", "verdict").alias("verdict"), "words"
    )


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
