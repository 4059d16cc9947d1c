"""Source divergence audit by Gustavson row accumulation.

Each language's sources are compared as smoothed term distributions in whole numbers:
with ``count`` occurrences of a kept term among the group's N, over V kept terms,
p = 1 + floor(10^9 (count + 1) / (N + V)), and a term contributes
f(p, q) = floor((p - q)^2 / q) to the divergence of p from q.

The counts are a sparse matrix, group by term. Its postings are dealt by term, so a
task holds a slice of the term-major index. There each group, as a row, scatters its
terms through the index into one dense accumulator over its peers, and only the
accumulators leave the task: no posting pairs are made. Scattering sees a term only
where both groups have it, while f is not zero elsewhere, so it adds
f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0), with p0 and q0 the values at count zero;
the zero baselines are made good from each group's histogram of p, which is short
since a group of N words has at most sqrt(2 N) different counts:
V f(p0, q0) + sum over the row's terms of f(p, q0) - f(p0, q0) + sum over the peer's
terms of f(p0, q) - f(p0, q0).

Values are exact in 64 bits up to 9 * 10^13 words a group.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged, table

MIN_DOCS = 3
TOP_TERMS = 200
HELD_TERMS = 300_000  # different terms a task counts before it passes them on
BLOCK = 1 << 18  # postings of one index slice in a task
GATHER = 1 << 20  # postings looked at in one step
PEER_BLOCK = 1024
TEXT_CHUNK = 1 << 20

# Bytes that are no letters become spaces, A-Z become a-z; bytes beyond ASCII stay.
_LETTERS = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def term_chunks(text: bytes):
    """The terms of a text in UTF-8, as lists of bytes, a bounded part of the text at a time."""
    at = 0
    while at < len(text):
        part = text[at : at + TEXT_CHUNK].translate(_LETTERS)
        end = len(part)
        if at + end < len(text):
            end = part.rfind(b" ") + 1
            if not end:  # one term longer than the part
                rest = text[at:].translate(_LETTERS)
                end = (rest.find(b" ") + 1) or len(rest)
                part = rest
        yield part[:end].split()
        at += end


def count_terms(batches):
    """(lang, source, term, n, docs) of a task's documents, combined; each group also once without a term."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen: set[tuple[str, str]] = set()
    held = 0

    def emit():
        for (lang, source), (n, docs) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang, pa.string()), len(n)), pa.repeat(pa.scalar(source, pa.string()), len(n)),
                    pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64()),
                    pa.array(list(map(docs.__getitem__, n)), pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    for batch in batches:
        langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        for lang, source, text in zip(langs, sources, batch.column("text"), strict=True):
            key = (lang, source)
            if key not in seen:
                seen.add(key)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([source]), pa.array([None], pa.binary()), pa.array([0]), pa.array([0])],
                    names=["lang", "source", "term", "n", "docs"],
                )
            n, docs = counts.setdefault(key, (Counter(), Counter()))
            held -= len(n)
            mine: set[bytes] = set()
            for terms in term_chunks(text.as_buffer().to_pybytes()):
                n.update(terms)
                mine.update(terms)
            docs.update(mine)
            held += len(n)
            if held > HELD_TERMS:
                yield from emit()
                held = 0
    yield from emit()


def smoothed(count, words, kept) -> Column:
    """1 + floor(10^9 (count + 1) / (words + kept)), in two steps that stay within 64 bits."""
    return F.expr(
        f"1L + ((10000L * ({count} + 1)) div ({words} + {kept})) * 100000L"
        f" + (100000L * ((10000L * ({count} + 1)) % ({words} + {kept}))) div ({words} + {kept})"
    )


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f(p, q) = floor((p - q)^2 / q)."""
    return (p - q) ** 2 // q


def accumulate_rows(term: np.ndarray, group: np.ndarray, p: np.ndarray, p0: np.ndarray, size: int):
    """(row, peers, sums) for every group of an index slice sorted by term.

    ``term`` numbers the terms from 0; ``group``, ``p`` and ``p0`` are the postings'.
    """
    starts = np.searchsorted(term, np.arange(term[-1] + 2))
    by_row = np.argsort(group, kind="stable")
    rows, at = np.unique(group[by_row], return_index=True)
    bounds = np.append(at, len(group))
    total = np.zeros(size, np.int64)
    for k, row in enumerate(rows.tolist()):
        mine = by_row[bounds[k] : bounds[k + 1]]
        widths = starts[term[mine] + 1] - starts[term[mine]]
        part = np.cumsum(widths) // GATHER
        touched = []
        for cut in np.split(np.arange(len(mine)), np.flatnonzero(np.diff(part)) + 1):
            own, width = mine[cut], widths[cut]
            place = np.repeat(starts[term[own]] - np.append(0, np.cumsum(width)[:-1]), width) + np.arange(width.sum())
            own = np.repeat(own, width)
            pg, g0, ps, s0 = p[own], p0[own], p[place], p0[place]
            np.add.at(
                total, group[place],
                divergence(pg, ps) - divergence(pg, s0) - divergence(g0, ps) + divergence(g0, s0),
            )
            touched.append(np.unique(group[place]))
        peers = np.unique(np.concatenate(touched))
        peers = peers[peers != row]
        yield row, peers, total[peers]
        for used in touched:
            total[used] = 0


def _slices(batches):
    """Slices of the index: whole terms of one language, about BLOCK postings."""
    held, n = [], 0

    def done():
        return {c: np.concatenate([h[c] for h in held]) for c in ("nth", "gid", "p", "p0")}, held[0]["lang"], held[0]["size"]

    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        codes, names = lang.indices.to_numpy(), lang.dictionary
        cols = {c: batch.column(c).to_numpy() for c in ("nth", "gid", "p", "p0", "size")}
        new_term = cols["nth"] == 1
        cuts = np.flatnonzero(np.append(False, codes[1:] != codes[:-1]) if len(codes) else [])
        edges = np.unique(np.concatenate([[0], cuts, np.flatnonzero(new_term)[:: 1 << 10], [len(codes)]])).astype(int)
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            name = names[int(codes[s])].as_py()
            if held and new_term[s] and (n >= BLOCK or name != held[0]["lang"]):
                yield done()
                held, n = [], 0
            held.append({c: v[s:e] for c, v in cols.items() if c != "size"} | {"lang": name, "size": int(cols["size"][s])})
            n += e - s
    if held:
        yield done()


_PAIRS = "lang string, a int, b int, value long"


def scatter(batches):
    """Row accumulators of the index slices that a task holds."""
    for cols, lang, size in _slices(batches):
        term = np.cumsum(cols["nth"] == 1) - 1
        for row, peers, sums in accumulate_rows(term, cols["gid"], cols["p"], cols["p0"], size):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(lang, pa.string()), len(peers)), pa.repeat(pa.scalar(row, pa.int32()), len(peers)),
                    pa.array(peers, pa.int32()), pa.array(sums, pa.int64()),
                ],
                names=["lang", "a", "b", "value"],
            )


def baselines(batches):
    """What the zeros add: each group's histogram of p against a block of peers' values at count zero."""
    for batch in batches:
        for r in range(batch.num_rows):
            get = {c: batch.column(c)[r] for c in ("lang", "gid", "p0", "kept", "ps", "hs", "peers", "peer_p0")}
            gid, g0, kept = get["gid"].as_py(), get["p0"].as_py(), get["kept"].as_py()
            ps, hs, peers, s0 = (get[c].values.to_numpy().astype(np.int64) for c in ("ps", "hs", "peers", "peer_p0"))
            there, back = divergence(np.int64(g0), s0), divergence(s0, np.int64(g0))
            to, fro = kept * there, np.zeros(len(peers), np.int64)
            for at in range(0, len(ps), 1024):
                p, h = ps[at : at + 1024, None], hs[at : at + 1024, None]
                to += (h * (divergence(p, s0) - there)).sum(axis=0)
                fro += (h * (divergence(s0, p) - back)).sum(axis=0)
            other = peers != gid
            peers, to, fro = peers[other], to[other], fro[other]
            me = np.full(len(peers), gid)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(get["lang"], 2 * len(peers)), pa.array(np.concatenate([me, peers]), pa.int32()),
                    pa.array(np.concatenate([peers, me]), pa.int32()), pa.array(np.concatenate([to, fro]), pa.int64()),
                ],
                names=["lang", "a", "b", "value"],
            )


def source_divergence(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its language.

    Part ``pair``: every other source, with the divergence over all kept terms (those in
    at least ``min_docs`` documents of the language). Part ``term``: the ``top_terms``
    terms that the source has more of than its language, with their contribution. Terms
    are runs of letters and of all code points beyond ASCII; only A-Z is lower-cased.
    Null text, language and source are empty; repeated rows count as documents of their
    own; a language without kept terms has divergences of 0; a source that is alone in
    its language has no pairs; an empty table gives no rows; other columns are ignored.
    Texts of any length are counted in bounded parts.
    """
    rows = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counts = (
        rows.mapInArrow(count_terms, "lang string, source string, term binary, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    of_term = Window.partitionBy("lang", "term")
    matrix = staged(
        counts.withColumn("df", F.sum("docs").over(of_term)).where(F.col("term").isNull() | (F.col("df") >= min_docs))
        .withColumn("total", F.sum("n").over(of_term))
        .withColumn("nth", F.row_number().over(of_term.orderBy("source")))
        .select("lang", "source", "term", "n", "total", "nth"),
        "divergence-matrix",
    )
    postings = matrix.where("term is not null")
    languages = postings.groupBy("lang").agg(F.sum("n").alias("all_words"), F.count_if(F.col("nth") == 1).alias("kept"))
    per_group = matrix.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    of_lang = Window.partitionBy("lang")
    groups = staged(
        per_group.join(languages, "lang", "left").na.fill(0, ["all_words", "kept"])
        .withColumn("gid", F.row_number().over(of_lang.orderBy("source")) - 1)
        .withColumn("size", F.count(F.lit(1)).over(of_lang))
        .withColumn("p0", F.when(F.col("kept") > 0, smoothed("0", "words", "kept")).otherwise(F.lit(1)).cast("long")),
        "divergence-groups",
    )
    placed = postings.join(groups, ["lang", "source"]).withColumn("p", smoothed("n", "words", "kept"))

    top = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (
        placed.withColumn("q", smoothed("total", "all_words", "kept")).where("n > 0 and p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"),
                F.expr("((p - q) * (p - q)) div q").alias("value"))
        .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= top_terms)
    )

    scattered = (
        placed.select("lang", "term", "nth", "gid", "size", "p", "p0")
        .repartition("lang", "term").sortWithinPartitions("lang", "term", "nth")
        .select("lang", "nth", "gid", F.col("size").cast("int").alias("size"), "p", "p0")
        .mapInArrow(scatter, _PAIRS)
    )
    histogram = (
        placed.where("n > 0").groupBy("lang", "gid", "p").agg(F.count(F.lit(1)).alias("h"))
        .groupBy("lang", "gid").agg(F.collect_list(F.struct("p", "h")).alias("bins"))
    )
    peers = (
        groups.groupBy("lang", F.floor(F.col("gid") / PEER_BLOCK).alias("block"))
        .agg(F.collect_list(F.struct("gid", "p0")).alias("peer"))
        .select("lang", F.col("peer.gid").alias("peers"), F.col("peer.p0").alias("peer_p0"))
    )
    zeros = (
        groups.join(histogram, ["lang", "gid"], "left").withColumn("bins", F.coalesce("bins", F.expr("array()")))
        .select("lang", "gid", "p0", "kept", F.col("bins.p").alias("ps"), F.col("bins.h").alias("hs"))
        .join(peers, "lang").mapInArrow(baselines, _PAIRS)
    )
    named = groups.select("lang", "gid", "source")
    pairs = (
        scattered.unionByName(zeros).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        .join(named.withColumnRenamed("gid", "a"), ["lang", "a"])
        .join(named.select("lang", F.col("gid").alias("b"), F.col("source").alias("item")), ["lang", "b"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        .withColumn("rank", F.row_number().over(top))
    )
    return pairs.unionByName(terms)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
words AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM grp g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
dense AS (
  SELECT k.lang, x.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (x.n + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 1)) // (l.n + l.v) AS q
  FROM kept k JOIN words x USING (lang) JOIN langs l USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.source = x.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT g.lang, g.source, o.source AS item, coalesce(s.value, 0) AS value
  FROM grp g JOIN grp o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source AND s.item = o.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
