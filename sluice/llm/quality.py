"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is a bag of words (runs without white space, A-Z lower-cased) and of shape
terms: 4-grams of character classes (letter cases, digits, white space and each
punctuation mark apart) and a term for words that repeat the word before them. Both
kinds are hashed to ``KIND_TERMS`` columns each, weighted by inverse document frequency
over all documents and projected on the leading singular vectors of a bounded sample of
labelled rows. The labelled vectors (at most ``sample`` of
``dims`` numbers) go to every task; each document's cosine with all of them is
one blocked matrix product, and its nearest ``neighbours`` vote with a weight
that grows with similarity; of equally similar ones the labelled row with the smaller id
(as text) comes first. Scores read the whole text and nothing else.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table, tidy
from sluice.llm.shingles import text_words

KIND_BITS = 10
KIND_TERMS = 1 << KIND_BITS
TERMS = 2 * KIND_TERMS  # shapes, then words
DIMS = 32
SAMPLE = 4096
NEIGHBOURS = 15
SHARPNESS = 4
CUTOFF = 0.3
FOLDS = 5
PART = 1 << 20
BLOCK_TEXTS = 512


def _classes() -> np.ndarray:
    """A class below 64 for each byte: bytes of letters beyond ASCII are lower case."""
    out = np.ones(256, np.int64)
    for b in range(128):
        c = chr(b)
        if c.isupper():
            out[b] = 2
        elif c.isdigit():
            out[b] = 3
        elif c == "\n":
            out[b] = 4
        elif c.isspace():
            out[b] = 5
        elif not c.islower():
            out[b] = 6 + b % 58
    return out


CLASSES = _classes()
REPEATED = 0
REPEAT_WEIGHT = 4


def term_counts(text: str) -> np.ndarray:
    """Counts of the hashed terms of a whole text, part by part."""
    out, shapes = np.zeros(TERMS), np.zeros(KIND_TERMS)
    raw = np.frombuffer(text.encode(), np.uint8)
    for at in range(0, max(0, len(raw) - 3), PART):
        k = CLASSES[raw[at : at + PART + 3]]
        grams = ((k[:-3] * 64 + k[1:-2]) * 64 + k[2:-1]) * 64 + k[3:]
        shapes += np.bincount((grams * 2654435761 & 0xFFFFFFFF) >> (32 - KIND_BITS), minlength=KIND_TERMS)
    out[:KIND_TERMS] = shapes
    with np.errstate(over="ignore"):
        hashes = text_words(raw)
    out[KIND_TERMS:] = np.bincount((hashes >> np.uint64(64 - KIND_BITS)).astype(np.int64), minlength=KIND_TERMS)
    words = text.split()
    out[REPEATED] += REPEAT_WEIGHT * sum(a == b for a, b in zip(words, words[1:], strict=False))
    return out


class LatentVoters:
    """The labelled vectors and the projection that made them.

    ``seen``: how many of how many documents hold each term (without it, of the labelled ones).
    """

    def __init__(
        self, counts: np.ndarray, labels: np.ndarray, dims: int, neighbours: int, seen: tuple[np.ndarray, int] | None = None
    ):
        n = len(labels)
        self.neighbours, self.labels = neighbours, labels
        self.base = float(labels.mean()) if n else 0.5
        if not n:
            return
        holding, all_docs = seen or ((counts > 0).sum(axis=0), n)
        self.idf = np.log((1 + all_docs) / (1 + holding)) + 1
        weighted = self._weighted(counts)  # single precision holds for the fit
        # leading right singular vectors by subspace iteration from a fixed start
        basis = np.random.default_rng(11).standard_normal((weighted.shape[1], min(dims + 16, n, weighted.shape[1])))
        basis = basis.astype(weighted.dtype)
        for _ in range(6):
            basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
        _, _, turn = np.linalg.svd(weighted @ basis, full_matrices=False)
        self.axes = (basis @ turn.T)[:, : min(dims, basis.shape[1])]
        self.voters = (weighted @ self.axes).astype(np.float64)
        self.voters /= np.maximum(np.linalg.norm(self.voters, axis=1, keepdims=True), 1e-12)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        x = np.sqrt(counts)
        x *= self.idf.astype(x.dtype)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return x

    def _latent(self, counts: np.ndarray) -> np.ndarray:
        z = self._weighted(counts) @ self.axes.astype(counts.dtype)
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the base rate where nothing is similar."""
        if not len(self.labels):
            return np.full(len(counts), self.base)
        cosine = np.round(self._latent(counts) @ self.voters.T, 12)  # equal rows come out equal
        k = min(self.neighbours, len(self.labels))
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        above, level = cosine > least, cosine == least
        chosen = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
        near = np.nonzero(chosen)[1].reshape(len(counts), k)
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 0, voted / np.where(total > 0, total, 1), self.base)


def held_out(id_col) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _counted(rows: DataFrame, extra: str) -> DataFrame:
    """Term counts of column ``t`` with one other column."""

    def count(batches):
        for batch in batches:
            counts = [term_counts(t).astype(np.float32).tobytes() for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column(extra), pa.array(counts, pa.binary())], names=["id", extra, "counts"]
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", extra, "t").mapInArrow(count, f"id {kind}, {extra} double, counts binary")


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """How many documents hold each term, and how many there are: a sum a task, added up by term."""

    def count(batches):
        held = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held[:TERMS] += term_counts(text or "") > 0
                held[TERMS] += 1
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(held[used])], names=["term", "n"])

    summed = (
        docs.select(F.col(text_col).cast("string")).mapInArrow(tidy(count), "term int, n long")
        .groupBy("term").agg(F.sum("n").alias("n"))
    )
    out = np.zeros(TERMS + 1, np.int64)
    summed = summed.toArrow()  # at most TERMS + 1 rows, in one job: a local iterator runs one for every partition
    out[summed.column("term").to_numpy()] = summed.column("n").to_numpy()
    return out[:TERMS], int(out[TERMS])


def fit_voters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    dims: int = DIMS,
    neighbours: int = NEIGHBOURS,
) -> LatentVoters:
    """Voters from at most ``sample`` labelled rows outside the held-out fold.

    The sample is the first rows by hash of the id; document frequencies are those of all
    of ``docs``. A document labelled more than
    once counts once, with its mean label; null labels and ids are left out.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("i")).agg(F.avg(label_col).alias("label"))
    )
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    # Labels of rows that this table no longer has don't use up the sample.
    present = rows.select("id").distinct()
    chosen = chosen.join(present, F.col("i") == F.col("id"), "left_semi").orderBy(F.xxhash64("i"), "i").limit(sample)
    labelled = rows.join(F.broadcast(chosen), F.col("id") == F.col("i"))  # at most ``sample`` rows
    found = _counted(labelled, "label").toArrow()
    got = sorted(
        {(str(i), y, c) for i, y, c in zip(*(found.column(x).to_pylist() for x in ("id", "label", "counts")), strict=True)}
    )
    del found
    counts = np.empty((len(got), TERMS), np.float32)
    for i, (_, _, row) in enumerate(got):
        counts[i] = np.frombuffer(row, np.float32)
    seen = document_frequencies(docs, text_col) if got else None
    return LatentVoters(counts, np.array([y for _, y, _ in got], np.float64), dims, neighbours, seen)


def score_texts(docs: DataFrame, voters: LatentVoters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, score from 0 to 1.

    Texts without terms (null, empty, very short) get the labelled rows' mean
    label; without labelled rows every score is 0.5. Equal texts score the same;
    repeated rows and null ids give a row each; an empty table gives no rows.
    Other columns are never read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    kind = rows.schema["id"].dataType.simpleString()

    def score(batches):
        for batch in batches:
            texts, scores = batch.column("t").to_pylist(), []
            for at in range(0, len(texts), BLOCK_TEXTS):
                counts = np.array([term_counts(t) for t in texts[at : at + BLOCK_TEXTS]])
                scores.append(np.round(voters.score(counts), 9))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=["id", "score"]
            )

    return rows.mapInArrow(tidy(score), f"id {kind}, score double").withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """id, held_out, score, predicted (1 if score >= cutoff) for every row of ``docs``."""
    scored = score_texts(docs, fit_voters(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= cutoff).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, all columns kept.

    A row's text alone decides: null and empty texts score the labelled rows' mean label,
    so they stay unless most labels are bad, and repeated rows stay or go together. Null ids
    are judged like others. Without labelled rows every row scores 0.5. An empty table
    stays empty.
    """
    voters = fit_voters(docs, labels, id_col, text_col)
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            good = [
                s >= cutoff
                for b in range(0, len(texts), BLOCK_TEXTS)
                for s in np.round(voters.score(np.array([term_counts(t) for t in texts[b : b + BLOCK_TEXTS]])), 9)
            ]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(tidy(keep), docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
