"""Quality classifier: held-out accuracy, brute-force voting, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import quality
from sluice.llm.quality import LatentVoters, classify, fit_voters, keep_good, op7_quality, term_counts

from llm_helpers import make_docs  # noqa: F401

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op7_quality(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.97
    everything = got.collect()
    assert len(everything) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in everything)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in everything)


def test_voting_equals_brute_force():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 5, (60, quality.TERMS)).astype(float)
    labels = rng.integers(0, 2, 60).astype(float)
    voters = LatentVoters(counts, labels, 8, 7)
    tests = rng.integers(0, 5, (20, quality.TERMS)).astype(float)
    for row, score in zip(tests, voters.score(tests), strict=True):
        z = voters._latent(row[None])[0]
        near = sorted(range(60), key=lambda i: -(voters.voters[i] @ z))[:7]
        w = np.array([max(voters.voters[i] @ z, 0) ** quality.SHARPNESS for i in near])
        assert score == pytest.approx((w * labels[near]).sum() / w.sum())


def test_labels_of_the_held_out_fold_and_other_columns_are_not_used(spark, make_docs):
    docs = make_docs([(i, f"Some plain text number {i}, quite good." if i % 2 else "BAD!! " * 20) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("other"))
    assert sorted(classify(docs, labels).collect()) == sorted(classify(changed, flipped).collect())


def test_odd_rows(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "ok"), (4, "Plain words here. " * 5), (4, "Plain words here. " * 5), (None, "x" * 3_000_000), (6, "A B!!")])
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (6, 0, 0), (6, None, 0), (None, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == 7 and all(r["score"] is not None for r in got)
    none = classify(docs, labels.where("false")).collect()
    assert all(r["score"] == 0.5 and r["predicted"] == 1 for r in none)
    assert classify(docs.where("false"), labels).collect() == []
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= 7


def test_whole_text_is_counted(monkeypatch):
    text = "Abc, def! 12 " * 50
    whole = term_counts(text)
    monkeypatch.setattr(quality, "PART", 64)
    assert (term_counts(text) == whole).all()


def test_words_of_equal_shape_score_differently(spark, make_docs):
    good, bad = "The report explains how rivers carry sand.", "Qnx kzwmvb fxqjtyzp wvk qzmxwk xjqzw kvxq."
    assert [len(w) for w in good.split()] == [3, 6, 8, 3, 6, 5, 5] and (term_counts(good) != term_counts(bad)).any()
    docs = make_docs([(i, (good if i % 2 else bad) + " " + (good if i % 2 else bad)) for i in range(80)] + [(100, good), (101, bad)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in classify(docs, labels).collect()}
    assert got[100] == 1 and got[101] == 0


def test_frequencies_are_those_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    holding, n = quality.document_frequencies(docs)
    counts = np.array([term_counts(r["text"] or "") for r in docs.select("text").collect()])
    assert n == len(counts) and (holding == (counts > 0).sum(axis=0)).all()


def test_ties_go_to_the_first_rows():
    counts = np.ones((6, quality.TERMS))
    voters = LatentVoters(counts, np.array([1.0, 1, 0, 0, 0, 0]), 4, 3)
    assert voters.score(np.ones((2, quality.TERMS))) == pytest.approx([2 / 3, 2 / 3])


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    assert len(fit_voters(docs, labels, sample=50).labels) == 50


def test_driver_fetches_in_few_jobs(spark, make_docs):
    """Not in one job for every partition: each leaves something in the driver's memory."""
    docs = make_docs([(i, f"text {i} of some words" * (i % 5 + 1)) for i in range(40)]).repartition(8)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    want = fit_voters(docs, labels)
    conf = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    sc = spark.sparkContext
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("voters", "voters")
        got = fit_voters(docs, labels)
        jobs = len(sc.statusTracker().getJobIdsForGroup("voters"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)
    assert np.array_equal(got.labels, want.labels) and np.array_equal(got.voters, want.voters)
    assert 0 < jobs < 30
