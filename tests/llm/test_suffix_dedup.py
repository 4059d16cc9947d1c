"""Suffix-array dedup against brute force; suffix arrays against plain sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import suffix_arrays, suffix_dedup
from sluice.llm.suffix_dedup import op8_suffix_dedup, remove_repeats, text_anchors

from llm_helpers import make_docs  # noqa: F401


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[: len(t)]
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((doc, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def result(df):
    return sorted(
        repr((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()))
        for r in df.collect()
    )


def corpus(seed, n=60, length=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = []
    for i in range(n):
        t = [" ".join(word() for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t.append(p[a : a + rng.randint(10, 150)])
            t.append(word())
        if i % 3 == 0:
            t = [passages[0], str(i)]  # a third of all rows share one passage
        texts.append(" ".join(t))
    return texts + [texts[1], texts[1], "a" * 300, "ab" * 100, "x" * length, "x" * (length - 1), "", None]


@pytest.mark.parametrize("how", [{}, {"shard_bytes": 500}, {"hot_regions": 1}])
def test_equals_brute_force(spark, make_docs, how):
    rows = list(enumerate(corpus(1))) + [(None, "null id " * 20), (2, corpus(1)[2])]
    rows.append(rows[5])
    assert result(remove_repeats(make_docs(rows), length=40, **how)) == brute(rows, 40)


def test_long_texts_in_parts(spark, make_docs, monkeypatch):
    rows = list(enumerate(corpus(2, 30)))
    want = brute(rows, 40)
    texts = pa.array([t or "" for _, t in rows])
    whole = [sorted({int(s) for lo, hi in zip(a[1], a[2], strict=True) for s in range(lo, hi + 1)}) for a in text_anchors(texts, 40)]
    monkeypatch.setattr(suffix_dedup, "SLAB", 100)
    parts = [sorted({int(s) for lo, hi in zip(a[1], a[2], strict=True) for s in range(lo, hi + 1)}) for a in text_anchors(texts, 40)]
    assert whole == parts  # every window of every text has its anchor
    monkeypatch.undo()
    assert result(remove_repeats(make_docs(rows), length=40)) == want


def test_no_task_gathers_a_crowded_anchor(spark, make_docs, monkeypatch):
    """A short line in thousands of texts, other bytes around it in each."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(12))
    rows = [(i, f"{word()} SPDX-License-Identifier: Apache-2.0 OR MIT, see. {word()}") for i in range(3000)]
    judge = suffix_dedup.region_roles

    def bounded(h, *rest):
        assert np.unique(h, return_counts=True)[1].max(initial=0) <= 2000
        return judge(h, *rest)

    monkeypatch.setattr(suffix_dedup, "region_roles", bounded)
    assert result(remove_repeats(make_docs(rows), length=40)) == brute(rows, 40)


@pytest.mark.parametrize("how", [{"crowd": 1}, {"crowd": 1, "hot_regions": 1}, {"crowd": 5, "shard_bytes": 500}])
def test_crowds_equal_brute_force(spark, make_docs, how):
    rows = list(enumerate(corpus(1))) + [(None, "null id " * 20), (2, corpus(1)[2])]
    assert result(remove_repeats(make_docs(rows), length=40, **how)) == brute(rows, 40)


def test_no_rows(make_docs):
    assert remove_repeats(make_docs([])).collect() == []


def test_given_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(repr(tuple(r)) for r in op8_suffix_dedup(spark, "/root/testdata/sf0.001").collect())
    assert got == brute(rows, 200)


@pytest.mark.parametrize("wide", [0, 2, 512])
def test_suffix_array_and_prefixes(monkeypatch, wide):
    monkeypatch.setattr(suffix_arrays, "WIDE", wide)
    rng = random.Random(wide)
    for _ in range(120):
        kinds = rng.choice([1, 2, 3, 10, 100])
        t = np.array([rng.randint(1, kinds) for _ in range(rng.randint(1, 150))] + [0], np.uint8)
        order = suffix_arrays.suffix_array(t, 256, 10**6)
        plain = t.tolist()
        assert order.tolist() == sorted(range(len(t)), key=lambda i: plain[i:])
        before, common = suffix_arrays.permuted_prefixes(t, order, 10**6, np.array([0]))
        for i in range(len(t)):
            if before[i] >= 0:
                k = 0
                while max(i, before[i]) + k < len(t) and t[i + k] == t[before[i] + k]:
                    k += 1
                assert common[i] == k
