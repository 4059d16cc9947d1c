"""The corpus pipeline: documents to encoded training text, in five stages.

Each stage works on all rows that the one before it kept, is written as Parquet
under the shared folder and read back; all but the last return the columns of
``documents``. No SQL can express the classifier, so ``ORACLE_SQL`` is None and
the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.bpe_codec import encode_texts
from sluice.llm.common import staged, table
from sluice.llm.exact_dedup import drop_copies
from sluice.llm.mixing import apply_mix
from sluice.llm.ngram_join import drop_near_copies
from sluice.llm.quality import keep_good
from sluice.session import apply_engine_conf

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources starts it."""
    return apply_mix(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded."""
    return encode_texts(docs, public_tokenizers.path(TOKENIZER))


def _tuned(stage):
    """A stage that sets the engine's session settings first, also when it is called by itself."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_engine_conf(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(f.__name__, _tuned(f)) for f in (quality_classifier, exact_dedup, ngram_join, mixing, bpe_codec)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
