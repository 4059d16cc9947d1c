"""Token counts by heap-and-linked-list byte-pair merging.

A text is a linked list of symbols. A heap holds every adjacent pair that the
vocabulary joins; the lowest rank (leftmost on ties) is popped, the pair becomes
one symbol and its new neighbours are pushed. The count is the number of initial
symbols minus the merges done (an unknown character counts its UTF-8 bytes); no
identifiers are made. Merges never cross a place that no vocabulary piece spans
(before a run of spaces, around a line break), so a text is counted piece by
piece between such places, and counts of repeated pieces are remembered in a
table of bounded size that turns over by generations.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import table

SPACE = "▁"  # what the vocabulary writes for a space
REMEMBERED = 400_000


def heap_merge(symbols: list, joins: dict, pair) -> tuple[list, int]:
    """Merge ``symbols`` until no adjacent pair joins: (symbols left, merges done).

    ``joins`` has (rank, joined symbol) by ``pair(a, b)`` for the pairs that join.
    Stale heap entries are told by a change of either symbol since the push.
    """
    n, get = len(symbols), joins.get
    symbols = list(symbols)
    heap = [
        (found[0], i, symbols[i], symbols[i + 1], found[1])
        for i, found in enumerate(map(get, map(pair, symbols, symbols[1:])))
        if found is not None
    ]
    if not heap:
        return symbols, 0
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heapq.heapify(heap)
    pop, push, merges = heapq.heappop, heapq.heappush, 0
    while heap:
        _, i, a, b, joined = pop(heap)
        j = after[i]
        if j >= n or symbols[i] != a or symbols[j] != b:
            continue
        symbols[i], symbols[j] = joined, None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            found = get(pair(joined, symbols[k]))
            if found is not None:
                push(heap, (found[0], i, joined, symbols[k], found[1]))
        h = before[i]
        if h >= 0:
            found = get(pair(symbols[h], joined))
            if found is not None:
                push(heap, (found[0], h, symbols[h], joined, found[1]))
    return [s for s in symbols if s is not None], merges


class Remembered(dict):
    """A table of results of bounded size: the older half goes when the newer is full."""

    def __init__(self, compute, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        """Free the table: workers that Spark keeps for other stages should not hold it."""
        self.clear()
        self.old = {}


class PieceVocabulary:
    """The merge ranks of a sentence-piece BPE model, read from its file."""

    def __init__(self, path: str):
        import sentencepiece  # only to read the file: pieces, scores, types

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.joins: dict[str, tuple[float, str]] = {}
        for i in range(model.get_piece_size()):
            if model.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
                piece = model.id_to_piece(i)
                self.joins[piece] = -model.get_score(i), piece
        joined = [p for p in self.joins if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in joined):
            raise ValueError("the vocabulary has pieces across spaces or line breaks")
        self.seen = Remembered(self._count)
        self.runs = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def _count(self, piece: str) -> int:
        """Tokens of one piece between places that merges never cross."""
        left, merges = heap_merge(list(piece), self.joins, add)
        extra = sum([len(s.encode()) - 1 for s in left if s not in self.joins])
        return len(piece) - merges + extra

    def count(self, text: str) -> int:
        """Tokens of a whole text: a leading space is added, spaces become marks."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        seen = self.seen
        return sum([seen[p] for p in self.runs.findall(marked)])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> PieceVocabulary:
    return PieceVocabulary(path)


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens.

    Counts cover the whole text, without begin or end tokens. Null and empty
    texts count 0. Repeated rows and null ids give a row each; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    schema = rows.select("id", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema

    def count(batches):
        vocab = vocabulary(model_path)
        for batch in batches:
            texts = batch.column("t").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([vocab.count(t) for t in texts], pa.int64()),
                ],
                names=["id", "n_bytes", "n_tokens"],
            )

    return rows.mapInArrow(count, schema).withColumnRenamed("id", id_col)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
